from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, NullType, StringType, StructType, VariantType

from layerloom.functions.json import json_record

#: A quoted name, which stays, or the mark of an object's type, which becomes that of a struct.
_OBJECT = re.compile(r"`(?:[^`]|``)*`|\bOBJECT<")


def records_from_json(
    df: DataFrame, body: str, schema: StructType | str | None = None
) -> DataFrame:
    """Rows of nested JSON text to typed columns; nested objects become structs.

    The other columns of ``df`` stay in front of the record's own. Without ``schema`` it is
    found from all bodies first, which reads them once more (see :func:`found_schema`).
    """
    if schema is None:
        schema = found_schema(df, body)
    others = [df[name] for name in df.columns if name != body]
    parsed = df.select(*others, json_record(df[body], schema).alias("_record"))
    return parsed.select(*(name for name in df.columns if name != body), "_record.*")


def found_schema(df: DataFrame, body: str) -> StructType:
    """The schema that all records of the table share, found from every body.

    Each body is parsed and its type merged with the others': within a task first, then between
    tasks, so one type a task is shuffled and none is guessed from a sample. Fields are united
    at every depth. Numbers widen to a decimal that holds them all, or to double. Types that
    nothing holds without loss (a string here, an object there) become ``variant``, and so do
    objects that are always empty. A field that is always null is a string. Objects that are
    used as maps, with ever new names, give a field for each: better name a map for these.

    Bodies that are null, not JSON, no object, or with a name twice in one object have no
    part in the schema. Without any object the schema has no fields.
    """
    parsed = df.select(F.try_parse_json(F.col(body)).alias("body"))
    objects = parsed.filter(F.startswith(F.schema_of_variant("body"), F.lit("OBJECT<")))
    found = objects.agg(F.schema_of_variant_agg("body").alias("type")).first()["type"]
    if not found.startswith("OBJECT<"):
        return StructType()
    struct = _OBJECT.sub(lambda match: "STRUCT<" if match[0] == "OBJECT<" else match[0], found)
    kept = _storable(StructType.fromDDL(f"record {struct}")["record"].dataType)
    return kept if isinstance(kept, StructType) else StructType()


def schema_paths(schema: StructType) -> list[tuple[str, str]]:
    """``(path, type)`` of every leaf: ``a.b`` for a field of a struct, ``a[]`` for an element."""
    return list(_paths("", schema))


def _paths(path: str, kind: DataType) -> Iterator[tuple[str, str]]:
    if isinstance(kind, StructType):
        for field in kind.fields:
            yield from _paths(f"{path}.{field.name}" if path else field.name, field.dataType)
    elif isinstance(kind, ArrayType):
        yield from _paths(f"{path}[]", kind.elementType)
    else:
        yield path, kind.simpleString()


def _storable(kind: DataType) -> DataType:
    """The type with what no table format can store replaced by what reads the same JSON."""
    if isinstance(kind, NullType):
        return StringType()
    if isinstance(kind, ArrayType):
        return ArrayType(_storable(kind.elementType))
    if isinstance(kind, StructType):
        if not kind.fields:
            return VariantType()
        merged = StructType()
        for field in kind.fields:
            merged = merged.add(field.name, _storable(field.dataType))
        return merged
    return kind
