"""Key operators: keep-first de-duplication and first-occurrence lookups.

No window is partitioned by a business key: a single hot key (say, one id on a
third of the rows) would land in one task. The first row per key is an
aggregate (``min`` / ``min_by``, combined map-side) that is written once. The
join back then has a plain scan and a shuffle on either side, which is the only
shape whose skewed partitions AQE splits (a join directly on the aggregate
would keep the aggregate's partitioning). Only narrow rows (key, row id) take
part, and only keys that occur more than twice: the one copy of a key that occurs
twice is its last row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualis.session import cut


def repeated_keys(df: DataFrame, key: str, order_col: str = "_row_id") -> DataFrame:
    """(key, _first, _last, _cnt) for every non-null key that occurs more than once."""
    return (df.where(F.col(key).isNotNull())
            .groupBy(key)
            .agg(F.min(order_col).alias("_first"), F.max(order_col).alias("_last"), F.count(F.lit(1)).alias("_cnt"))
            .where(F.col("_cnt") > 1))


def copies(df: DataFrame, key: str, order_col: str = "_row_id", rep: DataFrame | None = None) -> DataFrame:
    """(key, order_col) of the 2nd+ occurrences of a non-null key (file order); ``rep``:
    the written ``repeated_keys``, if there already."""
    rep = cut(repeated_keys(df, key, order_col)) if rep is None else rep
    twice = rep.where("_cnt = 2 AND _last <> _first").select(key, F.col("_last").alias(order_col))
    often = rep.where("_cnt > 2").select(key, "_first")
    if often.isEmpty():
        return twice
    return twice.unionByName(df.select(key, order_col).join(often, key)
                             .where(F.col(order_col) != F.col("_first")).drop("_first"))


def first_value(df: DataFrame, key: str, value: str, order_col: str = "_row_id",
                out: str | None = None) -> DataFrame:
    """(key, value of the first row of that key) for non-null keys."""
    return (df.where(F.col(key).isNotNull()).groupBy(key)
            .agg(F.min_by(F.col(value), F.col(order_col)).alias(out or value)))


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(key).isNotNull()).select(key).distinct()
