"""Incremental audit of a landing folder with Structured Streaming.

The reference audits one export at a time; here every new parquet drop of
sales in the landing folder is one export. ``foreachBatch`` runs the batch
findings job on the drop (against the current master tables) and appends the
findings, tagged with the batch id, to a findings table. Uniqueness, keep-first
and row positions are per drop, exactly as for a single export. The stream
checkpoint makes it restartable: a drop is audited once even across failures
(findings of a batch are overwritten by partition, so a replayed batch does
not duplicate them).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from qualis.operators import findings as FD
from qualis.rules import Rules
from qualis.session import mark, release
from qualis.sources.fixture import SALES_COLUMNS
from qualis.sources.readers import empty_to_null
from qualis.sources.rowindex import block_sequence


def audit_landing(spark: SparkSession, landing: str, masters: dict[str, DataFrame], rules: Rules,
                  findings_path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    configured = [*SALES_COLUMNS, *rules.required("sales"), *rules.optional("sales"), *rules.types("sales")]
    schema = ", ".join(f"`{c}` string" for c in dict.fromkeys(configured))
    stream = (spark.readStream.schema(schema).parquet(landing)
              .select("*", F.col("_metadata.file_path").alias("_file"),
                      F.col("_metadata.row_index").alias("_ri")))

    def audit_batch(batch: DataFrame, batch_id: int) -> None:
        # file order inside the drop: (file, row index); blocks = row ranges of a file
        sales = block_sequence(batch, ["_file", "_ri"],
                               [F.col("_file"), F.floor(F.col("_ri") / 65536)]).drop("_file", "_ri")
        since = mark()
        tables = {"sales": empty_to_null(sales), **masters}
        f = FD.report(FD.findings(tables, rules)).withColumn("batch_id", F.lit(batch_id))
        (f.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(findings_path))
        release(spark, since)  # a stream must not pile up its batches' intermediate tables

    w = stream.writeStream.foreachBatch(audit_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
