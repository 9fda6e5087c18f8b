"""DataFrame to DataFrame steps. None of them runs a job."""

from layerloom.operators.aggregate import count_by_key, key_metrics, row_count
from layerloom.operators.combine import request_grid, union_all
from layerloom.operators.filters import named_like, non_blank, where_equal
from layerloom.operators.limits import first_match, first_n
from layerloom.operators.project import add_ingest_metadata, exploded, nested_fields

__all__ = [
    "add_ingest_metadata",
    "count_by_key",
    "exploded",
    "first_match",
    "first_n",
    "key_metrics",
    "named_like",
    "nested_fields",
    "non_blank",
    "request_grid",
    "row_count",
    "union_all",
    "where_equal",
]
