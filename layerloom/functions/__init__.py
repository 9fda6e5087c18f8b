"""Column expressions. All of them run inside the JVM."""

from layerloom.functions.arrays import flattened
from layerloom.functions.dates import parsed_date
from layerloom.functions.json import json_field, json_record, json_text
from layerloom.functions.text import captured, is_blank, stripped

__all__ = [
    "captured",
    "flattened",
    "is_blank",
    "json_field",
    "json_record",
    "json_text",
    "parsed_date",
    "stripped",
]
