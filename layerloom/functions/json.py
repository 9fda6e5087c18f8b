from __future__ import annotations

from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Write options for JSON and CSV: Spark's default patterns stop at milliseconds, these keep
# every microsecond. Readers need none, as their default takes any number of digits.
LOSSLESS_TIME = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def json_field(
    body: Column | str, path: str, as_type: str = "string", default: Any = None
) -> Column:
    """One field of a JSON text, cast to ``as_type``.

    A missing field, a null field and a value that cannot be cast give ``default``.
    """
    field = F.get_json_object(body, path).try_cast(as_type)
    return field if default is None else F.coalesce(field, F.lit(default).cast(as_type))


def json_record(body: Column | str, schema: StructType | str) -> Column:
    """JSON text to a struct of an explicit schema; values that do not fit become null."""
    return F.from_json(body, schema)


def json_text(record: Column, pretty: bool = False) -> Column:
    """Struct, array or map to JSON text. Null fields are left out."""
    return F.to_json(record, {**LOSSLESS_TIME, "pretty": str(pretty).lower()})
