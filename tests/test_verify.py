"""Multiset comparison by fingerprints against exceptAll; positions without a shuffle."""
import random
import tempfile

from pyspark.sql import functions as F

from qualis.operators import verify as V
from qualis.sources import readers as R

SCHEMA = "a string, b long, c double"


def rows(rng, n):
    return [(rng.choice(["x", "y", None, "é"]), rng.randrange(9), rng.choice([0.5, None, float("nan"), -0.0])) for _ in range(n)]


def test_equal_multisets_have_equal_fingerprints(spark):
    data = rows(random.Random(1), 500)
    a = spark.createDataFrame(data, SCHEMA)
    b = spark.createDataFrame(data[::-1], SCHEMA).repartition(7)
    assert V.differing_cells(a, b) == []
    assert [d.count() for d in V.differences(a, b)] == [0, 0]


def test_differences_equal_except_all(spark):
    rng = random.Random(2)
    data = rows(rng, 400)
    for other in (data[:-3], data + data[:2], data[5:] + rows(rng, 5), [], data[:200]):
        a, b = (spark.createDataFrame(x, SCHEMA) for x in (data, other))
        got = [sorted(map(str, d.collect())) for d in V.differences(a, b)]
        assert got == [sorted(map(str, a.exceptAll(b).collect())), sorted(map(str, b.exceptAll(a).collect()))]


def test_parquet_positions_move_no_rows(spark):
    d = tempfile.mkdtemp(prefix="qualis-pos-") + "/pq"
    spark.range(5000).withColumn("t", F.col("id").cast("string")).repartition(6).write.parquet(d)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        df = R.with_file_positions(spark.read.parquet(d))
        assert sorted(r["_row_id"] for r in df.collect()) == list(range(5000))
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
