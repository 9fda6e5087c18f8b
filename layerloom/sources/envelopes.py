"""Landed API responses: ``{"results": n, "response": [...]}``, one body per request.

The input is a table with one row per request: its parameters and the response body as
text. A request whose body cannot be read never hides the others: it goes to the rejects.
A request without results adds no element; :func:`opened` still accounts for it.

``element`` is the type of one response element, as a type or DDL field list. Without it
each element stays JSON text, so nothing is lost while the payload's schema is not known.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DoubleType,
    StringType,
    StructType,
)

_CORRUPT = "_corrupt_record"
_OWN = {"element", "outcome", "rejected_body", "_body", "_envelope", "_keys", "_elements"}


def accepted(
    landed: DataFrame, body: str = "body", element: DataType | str | None = None
) -> DataFrame:
    """One row per response element of the readable bodies, beside the request's parameters."""
    return _parsed(landed, body, element).select(
        *_parameters(landed, body),
        F.explode(F.when(~_unreadable(), _elements())).alias("element"),
    )


def rejected(
    landed: DataFrame, body: str = "body", element: DataType | str | None = None
) -> DataFrame:
    """The requests whose body is missing, blank, not JSON or of another shape."""
    # A filter would be moved below the parse and repeat it for each of its conditions.
    return _parsed(landed, body, element).select(
        *_parameters(landed, body),
        F.explode(F.when(_unreadable(), F.array("_body"))).alias("rejected_body"),
    )


def opened(
    landed: DataFrame, body: str = "body", element: DataType | str | None = None
) -> DataFrame:
    """Every request in one parse: for a job that stores all outcomes together.

    ``outcome`` is ``accepted`` (a row per ``element``), ``empty`` (a row per readable
    request without elements) or ``rejected`` (a row per request, with its
    ``rejected_body``), so the requests of the three outcomes are those that landed.
    """
    unreadable = _unreadable()
    nothing = F.coalesce(F.size(_elements()), F.lit(0)) <= 0
    judged = _parsed(landed, body, element).select(
        *_parameters(landed, body),
        F.when(unreadable, "rejected").when(nothing, "empty").otherwise("accepted").alias("outcome"),
        F.when(unreadable, F.col("_body")).alias("rejected_body"),
        F.when(unreadable | nothing, F.array(F.lit(None))).otherwise(_elements()).alias("_elements"),
    )
    # Exploded last, so that an element carries the verdict and not the whole body. The array
    # is never empty, so outer changes no row; without it Spark would filter the array before
    # the explode, and parse each body again for every condition of that filter.
    return judged.select(
        *_parameters(landed, body),
        "outcome",
        "rejected_body",
        F.explode_outer("_elements").alias("element"),
    )


def _parsed(landed: DataFrame, body: str, element: DataType | str | None) -> DataFrame:
    """Beside the parameters: the ``_body`` as it is and the ``_envelope`` read from it.

    Spark's parser stops after the first value and ignores what follows. Inside a list with
    an end mark behind it, a body that is cut, doubled or followed by anything shows. The
    mark is new in every call, so that no body can hold it, and the keys of the whole
    are compared, so that a body that closes the list itself shows too.
    """
    if clashing := _OWN.intersection(_parameters(landed, body)):
        raise ValueError(f"request parameters may not be called {sorted(clashing)}")
    mark = f"end_{uuid.uuid4().hex}"
    text = F.concat(F.lit('{"body": ['), body, F.lit(f'], "{mark}": true}}'))
    options = {
        "columnNameOfCorruptRecord": _CORRUPT,
        "allowSingleQuotes": "false",
        "allowNonNumericNumbers": "false",
    }
    envelope = F.from_json(text, _envelope_schema(element, mark), options)
    own_keys = F.json_object_keys(text) == F.array(F.lit("body"), F.lit(mark))
    return landed.select(
        *_parameters(landed, body),
        F.col(body).alias("_body"),
        envelope.cast(_envelope_schema(element, "end")).alias("_envelope"),
        own_keys.alias("_keys"),
    )


def _parameters(landed: DataFrame, body: str) -> list[str]:
    return [name for name in landed.columns if name != body]


def _unreadable() -> Column:
    one_object = (
        F.col("_keys")
        & F.col(f"_envelope.{_CORRUPT}").isNull()
        & F.col("_envelope.end")
        & (F.size("_envelope.body") == 1)
        & _only_body().isNotNull()
    )
    return ~F.coalesce(one_object, F.lit(False))


def _only_body() -> Column:
    return F.get("_envelope.body", F.lit(0))


def _elements() -> Column:
    return F.when(_only_body()["results"] != 0, _only_body()["response"])


def _envelope_schema(element: DataType | str | None, mark: str) -> StructType:
    if element is None:
        element = StringType()
    elif isinstance(element, str):
        element = StructType.fromDDL(element)
    body = StructType().add("results", DoubleType()).add("response", ArrayType(element))
    return (
        StructType()
        .add("body", ArrayType(body))
        .add(mark, BooleanType())
        .add(_CORRUPT, StringType())
    )
