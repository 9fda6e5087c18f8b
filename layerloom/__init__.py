"""Layered (bronze, silver, gold) data flows as plain PySpark DataFrame code."""

from layerloom.config import LAYERS, LayerConfig

__all__ = ["LAYERS", "LayerConfig"]
