"""Incremental layer runs on Structured Streaming, or over a stored list of read files."""

from layerloom.streaming.incremental import append_new, new_files
from layerloom.streaming.metrics import keep_metrics, kept_metrics
from layerloom.streaming.unread import append_unread

__all__ = ["append_new", "append_unread", "keep_metrics", "kept_metrics", "new_files"]
