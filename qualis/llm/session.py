"""Session helpers of the subpackage: Arrow batches of bounded size, table cuts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from qualis import session as S

__all__ = ["cut", "discard", "settings", "read"]

def settings(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of at most ``rows`` rows (texts may be long)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def cut(df: DataFrame, by: str | None = None) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back; ``by`` names a
    column whose values become folders, so a filter on it reads only these."""
    if by is None:
        out = S.cut(df, frugal=False)
    else:
        path = f"{S.checkpoint_dir(df.sparkSession).rstrip('/')}/qualis-{uuid.uuid4().hex}"
        df.write.partitionBy(by).parquet(path)
        S._CUTS.append(path)
        out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._cut_path = S._CUTS[-1]
    return out


def discard(df: DataFrame) -> None:
    """Delete a cut that no later step reads."""
    path = df._cut_path
    fs, p = S.file_system(df.sparkSession, path)
    fs.delete(p, True)
    S._CUTS.remove(path)
