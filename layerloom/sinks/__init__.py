"""Everything that stores a DataFrame. Each call runs one Spark job and raises on failure."""

from layerloom.sinks.console import show
from layerloom.sinks.files import (
    write_csv,
    write_json_array,
    write_json_arrays_by_key,
    write_json_documents,
    write_json_lines,
    write_json_one_array,
    write_text,
    write_text_files,
)
from layerloom.sinks.tables import write_by_key, write_layer

__all__ = [
    "show",
    "write_by_key",
    "write_csv",
    "write_json_array",
    "write_json_arrays_by_key",
    "write_json_documents",
    "write_json_lines",
    "write_json_one_array",
    "write_layer",
    "write_text",
    "write_text_files",
]
