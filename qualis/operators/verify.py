"""Verification operators (V1-V7).

V1/V2 compare the findings with a manifest of known defects in both
directions on (table, row_ref, check_id) as multisets. A detector that fires
everywhere fails the second direction.

Two multisets are first compared by fingerprints: rows are dealt into ``CELLS``
cells by a hash, and a cell's fingerprint is its number of rows and the sums of two
64-bit hashes of them, which do not depend on order. Only rows of cells that differ
take part in ``exceptAll``, so equal inputs of any size exchange sums alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qualis.operators.clean import CleaningResult
from qualis.rules import Rules

KEY = ["table", "row_ref", "check_id"]
CELLS = 1 << 12


def _cell(columns: list[str]) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(CELLS))


def fingerprints(df: DataFrame) -> DataFrame:
    """(cell, n, s1, s2): at most ``CELLS`` rows, the same for the same multiset of rows."""
    total = lambda *c: F.sum(F.xxhash64(*c).cast("decimal(20, 0)"))
    return df.groupBy(_cell(df.columns).alias("cell")).agg(
        F.count(F.lit(1)).alias("n"), total(*df.columns).alias("s1"), total(F.lit(1), *df.columns).alias("s2"))


def differing_cells(a: DataFrame, b: DataFrame) -> list[int]:
    """Cells whose rows differ between two tables of the same columns."""
    one, two = fingerprints(a), fingerprints(b).toDF("other", "n_", "s1_", "s2_")
    same = (F.col("n") == F.col("n_")) & (F.col("s1") == F.col("s1_")) & (F.col("s2") == F.col("s2_"))
    both = one.join(two, F.col("cell") == F.col("other"), "full").where(~F.coalesce(same, F.lit(False)))
    return sorted(r["c"] for r in both.select(F.coalesce("cell", "other").alias("c")).collect())


def differences(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of ``a`` beyond those of ``b``, rows of ``b`` beyond those of ``a``), as multisets."""
    b = b.select(*a.columns)
    cells = differing_cells(a, b)
    if not cells:
        return a.limit(0), b.limit(0)
    inside = F.lit(True) if 2 * len(cells) > CELLS else _cell(a.columns).isin(cells)
    a, b = a.where(inside), b.where(inside)
    return a.exceptAll(b), b.exceptAll(a)


def expected_keys(manifest: DataFrame) -> DataFrame:
    return manifest.select("table", "row_ref", F.col("error_class").alias("check_id"))


def natural_duplicates(sales: DataFrame) -> DataFrame:
    """Manifest rows for key copies already present in a baseline: each key once
    less than it occurs, from counts alone (not from the engine's keep-first)."""
    counts = sales.where("sale_id IS NOT NULL").groupBy("sale_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return counts.select(F.lit("sales").alias("table"), F.col("sale_id").alias("row_ref"),
                         F.lit("UNI_001").alias("error_class"), F.lit("sale_id").alias("column"),
                         F.lit("natural duplicate").alias("detail"),
                         F.explode(F.sequence(F.lit(2), F.col("n"))).alias("_k")).drop("_k")


def detection_summary(findings: DataFrame, manifest: DataFrame) -> DataFrame:
    """V1: one row - expected, detected, matched, missed, unexpected, verdict."""
    exp = expected_keys(manifest)
    det = findings.select(*KEY)
    gone, extra = differences(exp, det)
    e = exp.agg(F.count(F.lit(1)).alias("expected"))
    d = det.agg(F.count(F.lit(1)).alias("detected"))
    row = (e.crossJoin(d).crossJoin(gone.agg(F.count(F.lit(1)).alias("missed")))
           .crossJoin(extra.agg(F.count(F.lit(1)).alias("unexpected")))
           .select("expected", "detected", (F.col("expected") - F.col("missed")).alias("matched"), "missed", "unexpected"))
    ok = (F.col("missed") == 0) & (F.col("unexpected") == 0) & (F.col("matched") == F.col("expected"))
    return row.withColumn("verdict", F.when(ok, "VERIFIED").otherwise("FAILED"))


def missed(findings: DataFrame, manifest: DataFrame) -> DataFrame:
    """Expected but not detected (multiset difference)."""
    return differences(expected_keys(manifest), findings.select(*KEY))[0]


def unexpected(findings: DataFrame, manifest: DataFrame) -> DataFrame:
    """U4: detected but not expected."""
    return differences(findings.select(*KEY), expected_keys(manifest))[0]


def by_class(findings: DataFrame, manifest: DataFrame) -> DataFrame:
    """Injected vs detected per class, OK / MISMATCH."""
    i = manifest.groupBy(F.col("error_class").alias("check_id")).agg(F.count(F.lit(1)).alias("injected"))
    d = findings.groupBy("check_id").agg(F.count(F.lit(1)).alias("detected"))
    j = i.join(d, "check_id", "full").select(
        "check_id", F.coalesce("injected", F.lit(0)).alias("injected"),
        F.coalesce("detected", F.lit(0)).alias("detected"))
    return j.withColumn("status", F.when(F.col("injected") == F.col("detected"), "OK").otherwise("MISMATCH"))


def cleaning_balance(findings: DataFrame, res: CleaningResult) -> DataFrame:
    """V3: dropped + fixed + pure flags == findings (exact for disjoint defects
    whose references resolve)."""
    c = res.counts
    pure_flag = (F.col("metric") == "flagged") & (F.col("check_id") != "BIZ_003")
    acted = c.agg(F.coalesce(F.sum(F.when((F.col("metric").isin("dropped", "fixed")) | pure_flag,
                                          F.col("n"))), F.lit(0)).cast("long").alias("acted"))
    total = findings.agg(F.count(F.lit(1)).alias("findings"))
    return total.crossJoin(acted).withColumn("balanced", F.col("findings") == F.col("acted"))


def residual_classes(findings_clean: DataFrame, rules: Rules) -> DataFrame:
    """V4: residual findings per check and whether the check is a FLAG class."""
    flag = [c for c, a in rules.config["cleaning_actions"].items() if a == "FLAG"]
    return (findings_clean.groupBy("check_id").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("is_flag_class", F.col("check_id").isin(*flag)))


def master_integrity(master: DataFrame) -> DataFrame:
    """Gaps in the clean master and revenue recomputation."""
    from qualis.functions import parse as P
    gross = P.round_cents(P.to_number("quantity") * P.to_number("unit_price"))
    return master.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("gross_revenue").isNull()).alias("null_gross"),
        F.count_if(F.col("net_revenue").isNull()).alias("null_net"),
        F.count_if(F.col("customer_id").isNotNull() & F.col("customer_name").isNull()).alias("customer_gaps"),
        F.count_if(F.col("product_id").isNotNull() & F.col("product_name").isNull()).alias("product_gaps"),
        F.count_if(F.length("quality_flag") > 0).alias("flagged_rows"),
        F.count_if(~gross.eqNullSafe(F.col("gross_revenue"))).alias("revenue_mismatch"))
