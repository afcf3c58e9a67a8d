"""Exact median of a column without gathering its values in one task.

Values are counted (a partial aggregate per distinct value) and the two middle
ranks are found by narrowing value ranges: each round splits the range that
holds a rank into ``CELLS`` equal cells, sums the counts per cell and keeps the
cell with the rank. A round returns ``CELLS`` rows at most, whatever the number
of distinct values; a range shrinks ``CELLS``-fold per round, so a handful of
rounds reach a single value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualis.session import cut

CELLS = 4096


def _kth(counts: DataFrame, k: int, lo: float, hi: float) -> float:
    """k-th smallest value (from 0) of (v, n) rows whose finite values span [lo, hi]."""
    below = 0
    while lo < hi:
        half = hi / 2 - lo / 2  # no overflow on wide ranges
        cell = F.least(F.floor((F.col("v") / 2 - F.lit(lo / 2)) / F.lit(half) * CELLS), F.lit(CELLS - 1))
        rows = sorted((r for r in counts.where(F.col("v").between(lo, hi)).groupBy(cell.alias("c"))
                       .agg(F.sum("n").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()),
                      key=lambda r: r["c"])
        for r in rows:
            if below + r["n"] > k:
                lo, hi = r["lo"], r["hi"]
                break
            below += r["n"]
    return lo


def exact_median(values: DataFrame) -> float | None:
    """Interpolated median of the double column ``v`` (no NULL, no NaN), each row counted
    once or, with a column ``n``, n times; None without rows. Infinities rank at the ends."""
    counts = cut(values.groupBy("v").agg((F.sum("n") if "n" in values.columns else F.count(F.lit(1))).alias("n")))
    inf = float("inf")
    finite = counts.where((F.col("v") < inf) & (F.col("v") > -inf))
    t = counts.agg(F.sum("n").alias("n"), F.sum(F.when(F.col("v") == -inf, F.col("n"))).alias("low")).first()
    f = finite.agg(F.sum("n").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    if not t["n"]:
        return None

    def at(k: int) -> float:
        low, mid = t["low"] or 0, f["n"] or 0
        return -inf if k < low else inf if k >= low + mid else _kth(finite, k - low, f["lo"], f["hi"])

    a, b = (t["n"] - 1) // 2, t["n"] // 2
    x = at(a)
    return x if a == b else (x + at(b)) / 2
