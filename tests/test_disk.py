"""What a job leaves on disk while it runs: no files of ended shuffles, no tables that nothing reads, no spilled sorts."""
import glob
import os

import pytest
from helpers import sale, tables
from pyspark.sql import functions as F

from qualis import session as S
from qualis.operators import clean as CL
from qualis.operators import findings as FD
from qualis.operators import keys as K
from qualis.plans import catalog as Q
from qualis.rules import Rules
from qualis.sources import rowindex as RI
from qualis.sources import sinks as SK

RULES = Rules(audit_date="2024-06-30")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _shuffle_files(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in dirs for f in glob.glob(f"{d}/*/shuffle_*.data")}


@pytest.mark.parametrize("write", [S.cut, lambda df: SK.write_table(df, Q._scratch(df.sparkSession, "t"))])
def test_shuffle_files_go_with_the_job(spark, write):
    before, was = _shuffle_files(spark), spark.conf.get(S.FREED)
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    out = write(df)
    for _ in range(50):  # Spark deletes them beside the next job
        if _shuffle_files(spark) <= before:
            break
        spark.range(1).count()
    assert _shuffle_files(spark) <= before and spark.conf.get(S.FREED) == was
    assert (out if not isinstance(out, str) else spark.read.parquet(out)).count() == 7
    assert df.agg(F.sum("n")).first()[0] == 1000


def test_the_setting_comes_back_after_threads(spark):
    was = spark.conf.get(S.FREED)
    S.together(spark, *[lambda i=i: S.cut(spark.range(10 + i).repartition(3)) for i in range(6)])
    assert spark.conf.get(S.FREED) == was


def test_tables_that_the_fixture_wrote_on_the_way_are_deleted(spark):
    since = S.mark()
    seen = []

    def build():
        first = S.cut(spark.range(10))
        seen.append(first.inputFiles()[0])
        return {"a": first.withColumn("b", F.col("id") + 1), "c": spark.range(3)}

    t = S.landed(build)
    assert sorted(r["b"] for r in t["a"].collect()) == list(range(1, 11)) and t["c"].count() == 3
    assert not os.path.exists(seen[0].removeprefix("file://")) and len(S._CUTS) == since + 2


@pytest.mark.parametrize("blocks", [1 << 17, 1])
def test_rows_are_parted_by_id_without_a_shuffle(spark, monkeypatch, blocks):
    monkeypatch.setattr(RI, "MAP_BLOCKS", blocks)
    ids = [0, 1, 63, 64, 4095, 4096, 4097, 12_287, 99_999]
    df = S.cut(spark.range(0, 100_000, 1, 4).select(F.col("id").alias("_row_id"), F.col("id").alias("a.b"))
               .unionByName(spark.createDataFrame([(None, 5), (64, 6)], "_row_id long, `a.b` long")))
    asked, others = RI.parted(df, spark.createDataFrame([(i,) for i in ids + [63, 500_000]], "_row_id long"))
    if blocks == 1:  # too many to send to the tasks: any row may be asked for
        assert others is None and asked.count() == df.count()
        return
    assert "hashpartitioning" not in _plan(others) and asked.columns == others.columns == df.columns
    assert sorted(r[0] for r in asked.collect()) == sorted([*ids, 64])
    left = [r[0] for r in others.collect()]
    assert len(left) == 100_000 - len(ids) + 1 and not set(ids) & set(left) and None in left


def test_cleaning_shuffles_only_rows_that_change(spark, monkeypatch):
    t = {n: S.cut(df) for n, df in tables(spark, [sale(f"S-{i}", date="2024-01-05") for i in range(500)] + [
        sale("S-7", region="Sued"), sale("S-900", disc="0.9"), sale(None, qty="-1"), sale("S-901", region=None)]).items()}
    plans = []
    monkeypatch.setattr(CL, "cut", lambda df: plans.append(_plan(df) if "quality_flag" in df.columns and "sale_id" in df.columns else "") or S.cut(df))
    res = CL.clean(t, FD.findings(t, RULES), RULES)
    plan = next(p for p in plans if p)
    assert "Union" in plan and "BroadcastHashJoin" in plan
    rows = {r["sale_id"]: (r["quality_flag"], r["discount"], r["region"]) for r in res.cleaned["sales"].collect()}
    assert len(rows) == 503 and rows["S-900"] == ("BIZ_003", "0.5", "North") and rows["S-901"] == ("COM_005", "0.1", None)
    assert rows["S-7"] == ("", "0.1", "North") and None in rows
    monkeypatch.setattr(RI, "MAP_BLOCKS", 0)
    again = CL.clean(t, FD.findings(t, RULES), RULES).cleaned["sales"]
    assert not again.exceptAll(res.cleaned["sales"]).count() and again.schema == res.cleaned["sales"].schema


def test_repeated_keys_are_looked_for_once(spark, monkeypatch):
    t = tables(spark, [sale("S-1"), sale("S-1", qty="6"), sale("S-2"), sale(None), sale(None)])
    own = S.cut(K.repeated_keys(t["sales"], "sale_id"))
    asked = []
    monkeypatch.setattr(K, "repeated_keys", lambda df, key, *a, f=K.repeated_keys: asked.append(key) or f(df, key, *a))
    found = FD.findings(t, RULES, repeated=own)
    res = CL.clean(t, found, RULES, own)
    assert "sale_id" not in asked and found.where("check_id = 'UNI_001'").count() == 1
    assert res.cleaned["sales"].where("sale_id = 'S-1'").count() == 1


def test_no_task_sorts_more_rows_than_it_can_hold(spark, monkeypatch):
    df = S.cut(spark.range(1000).select((F.col("id") * 7 % 1000).alias("_row_id")))
    few, many = Q.in_file_order(df, 8), None
    monkeypatch.setattr(RI, "TASK_ROWS", 50)
    many = Q.in_file_order(df, 8)
    assert few.rdd.getNumPartitions() <= 8
    sizes = many.withColumn("p", F.spark_partition_id()).groupBy("p").agg(F.count(F.lit(1)).alias("n"), F.min("_row_id").alias("a")).orderBy("p").collect()
    assert len(sizes) > 8 and max(r["n"] for r in sizes) < 125 and [r["a"] for r in sizes] == sorted(r["a"] for r in sizes)
