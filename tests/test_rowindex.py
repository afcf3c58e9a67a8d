"""Block-ranked sequence ids equal a global row_number; positions after removal."""
from pyspark.sql import Window
from pyspark.sql import functions as F

from qualis.sources.rowindex import block_sequence, positions_after_removal


def test_block_sequence_equals_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("k"), (F.col("id") % 3).alias("t"))
    seq = block_sequence(df, ["k", "t"], [F.floor(F.col("k") / 100)], out="s")
    ref = df.withColumn("r", F.row_number().over(Window.orderBy("k", "t")) - 1)
    got = {(r.k, r.t): r.s for r in seq.collect()}
    assert all(got[(r.k, r.t)] == r.r for r in ref.collect())


def test_positions_after_removal(spark):
    removed = spark.createDataFrame([(i,) for i in (0, 3, 4, 70000, 70001)], "_row_id long")
    wanted = spark.createDataFrame([(i,) for i in (1, 5, 69999, 70002, 140000)], "_row_id long")
    got = {r._row_id: r._pos for r in positions_after_removal(removed, wanted, width=65536).collect()}
    assert got == {1: 0, 5: 2, 69999: 69996, 70002: 69997, 140000: 139995}
