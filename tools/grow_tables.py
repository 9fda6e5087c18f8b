"""Write larger, skewed copies of the test tables, to see how the queries grow.

    python tools/grow_tables.py <sf_dir> <factor> <out_dir>

Every row is repeated ``factor`` times with keys of its own, and a third of the rows of
each table gets one and the same value in the columns that queries group or export by.
"""

from __future__ import annotations

import sys
from pathlib import Path

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

OWN_KEYS = {
    "customer": "c_custkey",
    "supplier": "s_suppkey",
    "part": "p_partkey",
    "orders": "o_orderkey",
    "lineitem": "l_orderkey",
    "events": "event_id",
    "documents": "doc_id",
    "pages": "page_id",
    "benchmark": "item_id",
    "labels": "doc_id",
    "conversations": "conv_id",
}
HOT_VALUES = {
    "customer": {"c_nationkey": 3},
    "orders": {"o_custkey": 77, "o_orderpriority": "1-URGENT", "o_orderstatus": "F"},
    "lineitem": {"l_suppkey": 7, "l_returnflag": "A"},
    "events": {"event_type": "error"},
    "documents": {"lang": "en"},
    "pages": {"url": "http://hot.example.com/"},
}


def main(sf_dir: str, factor: int, out_dir: str) -> None:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        df = spark.read.parquet(str(path))
        key = OWN_KEYS.get(path.stem)
        if key is None:
            df.write.parquet(f"{out_dir}/{path.name}")
            continue
        copy = F.explode(F.sequence(F.lit(0), F.lit(factor - 1))).alias("_copy")
        grown = df.repartition(8).select("*", copy)
        stride = df.agg(F.max(key)).first()[0] + 1
        hot = F.pmod(F.xxhash64(key, "_copy"), F.lit(3)) == 0
        grown = grown.withColumn(key, F.col(key) + F.col("_copy") * F.lit(stride))
        for name, value in HOT_VALUES.get(path.stem, {}).items():
            grown = grown.withColumn(name, replaced(hot, name, value, df.schema[name].dataType))
        grown.drop("_copy").write.parquet(f"{out_dir}/{path.name}")
    spark.stop()


def replaced(hot: Column, name: str, value, as_type) -> Column:
    return F.when(hot, F.lit(value).cast(as_type)).otherwise(F.col(name))


if __name__ == "__main__":
    main(sys.argv[1], int(sys.argv[2]), sys.argv[3])
