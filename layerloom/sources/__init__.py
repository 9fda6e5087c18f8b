"""Everything that turns stored data into a DataFrame."""

from layerloom.sources.envelopes import accepted, opened, rejected
from layerloom.sources.files import (
    read_by_key,
    read_csv,
    read_json_array,
    read_json_document,
    read_json_lines,
    read_json_one_array,
    read_landed,
    read_text_lines,
    read_whole_text,
)
from layerloom.sources.inventory import directory_entries, file_inventory
from layerloom.sources.literals import id_range, literal_rows
from layerloom.sources.records import found_schema, records_from_json, schema_paths
from layerloom.sources.split import read_csv_split, read_json_array_split
from layerloom.sources.tables import read_layer

__all__ = [
    "accepted",
    "directory_entries",
    "file_inventory",
    "found_schema",
    "id_range",
    "literal_rows",
    "opened",
    "read_by_key",
    "read_csv",
    "read_csv_split",
    "read_json_array",
    "read_json_array_split",
    "read_json_document",
    "read_json_lines",
    "read_json_one_array",
    "read_landed",
    "read_layer",
    "read_text_lines",
    "read_whole_text",
    "records_from_json",
    "rejected",
    "schema_paths",
]
