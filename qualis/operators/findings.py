"""Findings: all layers' records in one DataFrame with ids and rule metadata.

Detection order (W2) is the tuple (_layer, _block, _row, _step); the sequence
id is assigned with ``block_sequence`` on blocks (_layer, _block, _row div W),
so numbering never funnels the findings through one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qualis.functions import parse as P
from qualis.operators import checks as C
from qualis.rules import TABLES, Rules
from qualis.session import cut
from qualis.sources.rowindex import block_sequence

ERROR_COLUMNS = ["error_id", "check_id", "check_layer", "severity", "table", "row_ref", "column",
                 "invalid_value", "rule", "message", "cleaning_action", "detected_at"]
ORDER_COLUMNS = ["_layer", "_block", "_row", "_step"]
ROW_BLOCK = 1 << 18


def rules_table(spark: SparkSession, rules: Rules) -> DataFrame:
    """IO7: the check registry joined with the configured severity/action/weight."""
    return spark.createDataFrame(
        rules.rules_rows(),
        "check_id string, check_layer string, severity string, cleaning_action string, weight double")


def records(tables: dict[str, DataFrame], rules: Rules, layout: C.Layout | None = None,
            repeated: DataFrame | None = None) -> DataFrame:
    """Union of every table's records with rule/message texts (no ids yet)."""
    if layout is None:
        tables, layout = C.align(tables, rules)
    raw, insts = C.table_records(tables, layout, rules, repeated)
    out = raw[TABLES[0]]
    for t in TABLES[1:]:
        out = out.unionByName(raw[t])
    spark = out.sparkSession
    return C.resolve(out, C.definitions_table(spark, insts))


def number(recs: DataFrame, spark: SparkSession, rules: Rules) -> DataFrame:
    """J5 + W2: attach severity/action/layer (broadcast of the fixed-size
    registry) and the detection-order error id."""
    reg = F.broadcast(rules_table(spark, rules).drop("weight"))
    seq = block_sequence(recs, ORDER_COLUMNS,
                         [F.col("_layer"), F.col("_block"), F.floor(F.col("_row") / ROW_BLOCK)],
                         out="_seq", start=1)
    return (seq.join(reg, "check_id")
            .withColumn("error_id", P.error_id("_seq"))
            .withColumn("detected_at", F.lit(rules.run_ts)))


def findings(tables: dict[str, DataFrame], rules: Rules, materialize: bool = True,
             repeated: DataFrame | None = None) -> DataFrame:
    """All findings with the 12 report columns plus the internal order columns
    (_layer, _block, _row, _step, _seq). ``repeated``: the written ``keys.repeated_keys``
    of the sales, if the caller has it already."""
    spark = next(iter(tables.values())).sparkSession
    C.assert_file_level_schema(tables, rules)
    # Records feed the per-block counts, the offsets and the numbered output:
    # written once, so that none of these recomputes the record pass.
    recs = cut(records(tables, rules, repeated=repeated))
    out = number(recs, spark, rules).select(*ERROR_COLUMNS, *ORDER_COLUMNS, "_seq")
    if not materialize:
        return out
    # Findings feed the score, cleaning and every report: write them once.
    return cut(out)


def report(f: DataFrame) -> DataFrame:
    """The public 12-column findings table."""
    return f.select(*ERROR_COLUMNS)
