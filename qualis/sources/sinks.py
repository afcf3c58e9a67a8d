"""Sinks (IO8-IO11): every artefact is a table written with mode overwrite,
so re-running a job replaces its outputs (idempotent rerun)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qualis.operators.findings import ERROR_COLUMNS
from qualis.rules import LAYERS
from qualis.session import shuffles_freed


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> str:
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    with shuffles_freed(df.sparkSession):
        w.save(path)
    return path


def write_findings_by_layer(findings: DataFrame, path: str) -> str:
    """IO9: findings split by validation layer (one folder per layer)."""
    return write_table(findings.select(*ERROR_COLUMNS), path, partition_by=["check_layer"])


def read_findings_layer(spark: SparkSession, path: str, layer: str) -> DataFrame:
    """Read one layer back; an empty layer still has the full schema."""
    schema = ", ".join(f"`{c}` string" for c in ERROR_COLUMNS)
    assert layer in LAYERS
    return (spark.read.schema(schema).parquet(path).where(F.col("check_layer") == layer)
            .select(*ERROR_COLUMNS))


def write_tables(tables: dict[str, DataFrame], landing: str, fmt: str = "parquet") -> dict[str, str]:
    """Land a set of tables (e.g. injected dirty data, IO11)."""
    return {t: write_table(df, f"{landing}/{t}", fmt) for t, df in tables.items()}


def write_manifest(manifest: DataFrame, path: str, seed: int, generated_for: str) -> str:
    """IO11: the manifest as JSON - ``errors/`` holds one entry per line,
    written in parallel by every task (never gathered into one document or one
    task), and ``header/`` one line with seed, scope and the total count (an
    aggregate). ``readers.read_manifest`` reads this layout back."""
    manifest.select("table", "row_ref", "error_class", "column", "detail") \
        .write.mode("overwrite").json(f"{path}/errors")
    header = manifest.agg(F.count(F.lit(1)).alias("total_injected_errors")).select(
        F.lit(seed).cast("long").alias("seed"), F.lit(generated_for).alias("generated_for"),
        F.lit("known injected defects only").alias("scope_note"), "total_injected_errors")
    header.write.mode("overwrite").json(f"{path}/header")
    return path
