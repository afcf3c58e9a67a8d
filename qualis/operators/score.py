"""Scoring and finding counts.

All results are tiny aggregates; they stay DataFrames (one row for the score)
so a caller can join, union or write them without pulling data to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qualis.functions import parse as P
from qualis.rules import LAYERS, SEVERITIES, Rules


def table_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """R10/A1 detail: rows and (visible) columns per table."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(t).alias("table"), "rows",
        F.lit(len([c for c in df.columns if not c.startswith("_")])).alias("columns"))
        for t, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def total_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """A1: one row, the summed row count of all checked tables."""
    return table_profile(tables).agg(F.sum("rows").cast("long").alias("total_row_count"))


def score(findings: DataFrame, tables: dict[str, DataFrame], rules: Rules) -> DataFrame:
    """One row with counts per severity, weighted points, score, light."""
    sc = rules.config["scoring"]
    w = {k: float(v) for k, v in sc["weights"].items()}
    norm = float(sc["normalize_per_rows"])
    green, yellow = sc["traffic_light"]["green"], sc["traffic_light"]["yellow"]
    counts = findings.agg(
        F.count_if(F.col("severity") == "CRITICAL").alias("n_critical"),
        F.count_if(F.col("severity") == "MAJOR").alias("n_major"),
        F.count_if(F.col("severity") == "MINOR").alias("n_minor"),
        F.count(F.lit(1)).alias("total_errors"))
    j = total_rows(tables).crossJoin(counts)
    weighted = (F.col("n_critical") * F.lit(w["CRITICAL"]) + F.col("n_major") * F.lit(w["MAJOR"])
                + F.col("n_minor") * F.lit(w["MINOR"]))
    rows = F.col("total_row_count")
    per = F.when(rows <= 0, F.raise_error(F.lit(
        "no rows were checked, so there is nothing to score"))).otherwise(
        F.col("weighted_error_points") / rows * F.lit(norm))
    s = P.round_half_up(F.greatest(F.lit(0.0), F.lit(100.0) - F.col("error_points_per_1000_rows")))
    return (j.withColumn("weighted_error_points", weighted)
            .withColumn("error_points_per_1000_rows", per)
            .withColumn("score", s)
            .withColumn("traffic_light", F.when(F.col("score") >= green, "green")
                        .when(F.col("score") >= yellow, "yellow").otherwise("red"))
            .select("total_row_count", "n_critical", "n_major", "n_minor", "total_errors",
                    "weighted_error_points", "error_points_per_1000_rows", "score", "traffic_light"))


def by_check(findings: DataFrame) -> DataFrame:
    """A3."""
    return findings.groupBy("check_id").agg(F.count(F.lit(1)).alias("n"))


def by_table(findings: DataFrame) -> DataFrame:
    """A4."""
    return findings.groupBy("table").agg(F.count(F.lit(1)).alias("n"))


def by_severity(findings: DataFrame, spark: SparkSession) -> DataFrame:
    """A2/R2: the three severities (absent = 0) with the recommended action."""
    sev = spark.createDataFrame([(s, i) for i, s in enumerate(SEVERITIES)], "severity string, _o int")
    cnt = findings.groupBy("severity").agg(F.count(F.lit(1)).alias("n"))
    return (sev.join(cnt, "severity", "left")
            .select("severity", F.coalesce("n", F.lit(0)).cast("long").alias("n"),
                    P.severity_action("severity").alias("action")))


def by_layer(findings: DataFrame, spark: SparkSession) -> DataFrame:
    """A5: findings per layer, layers without findings shown with 0."""
    lay = spark.createDataFrame([(x, i + 1) for i, x in enumerate(LAYERS)], "check_layer string, layer_no int")
    cnt = findings.groupBy("check_layer").agg(F.count(F.lit(1)).alias("n"))
    return (lay.join(cnt, "check_layer", "left")
            .select("layer_no", "check_layer", F.coalesce("n", F.lit(0)).cast("long").alias("n")))


def top_classes(findings: DataFrame, n: int = 5) -> DataFrame:
    """Most frequent checks; ties keep first-detection order. The limit is
    the feature (a top-n report); input is pre-aggregated to one row per check."""
    agg = findings.groupBy("check_id").agg(F.count(F.lit(1)).alias("n"), F.min("_seq").alias("_first"))
    top = agg.orderBy(F.desc("n"), F.asc("_first")).limit(n)
    # rank over <= n rows
    from pyspark.sql import Window
    return top.select(F.row_number().over(Window.orderBy(F.desc("n"), F.asc("_first"))).alias("rank"),
                      "check_id", "n", F.repeat(F.lit("#"), F.col("n").cast("int")).alias("bar"))
