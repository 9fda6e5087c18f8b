from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def flattened(nested: Column | str, null_parts: bool = True) -> Column:
    """Array of arrays to one array, order and duplicates kept; null inner arrays add nothing.

    ``null_parts=False`` is for arrays known to hold no null: it saves a copy of each. A null
    inner array then makes the whole result null.
    """
    inner = F.col(nested) if isinstance(nested, str) else nested
    return F.flatten(F.filter(inner, lambda part: part.isNotNull()) if null_parts else inner)
