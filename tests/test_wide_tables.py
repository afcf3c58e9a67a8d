"""Wide tables are not sorted or scanned where narrow or few rows do; the results stay whole."""
import pytest
from helpers import sale, tables
from pyspark.sql import functions as F

from qualis.operators import checks as C
from qualis.operators import clean as CL
from qualis.operators import findings as FD
from qualis.operators import keys as K
from qualis.operators import master as MS
from qualis.rules import Rules
from qualis.session import cut
from qualis.sources import fixture as FX
from qualis.sources import rowindex as RI

RULES = Rules(audit_date="2024-06-30")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_copies_of_a_pair_need_no_join(spark):
    pairs = spark.createDataFrame([("a", 0), ("a", 3), ("b", 1), (None, 2), (None, 4)], "k string, _row_id long")
    out = K.copies(pairs, "k")
    assert "Join" not in _plan(out) and [tuple(r) for r in out.collect()] == [("a", 3)]
    more = pairs.unionByName(spark.createDataFrame([("b", 7), ("b", 9), ("c", 5)], pairs.schema))
    assert sorted(map(tuple, K.copies(more, "k").collect())) == [("a", 3), ("b", 7), ("b", 9)]


def test_records_are_made_of_the_odd_rows_alone(spark):
    t = {n: cut(df) for n, df in tables(spark, [sale("S-1"), sale("S-2", qty="-5"), sale("S-3", cust="C-9"), sale("S-3", prod="P-2")]).items()}
    aligned, layout = C.align(t, RULES)
    raw, _ = C.table_records(aligned, layout, RULES)
    assert not set(raw["sales"].inputFiles()) & set(t["sales"].inputFiles())
    found = FD.findings(t, RULES).select("check_id", "row_ref").collect()
    assert sorted(map(tuple, found)) == [("BIZ_001", "S-2"), ("REL_001", "S-3"), ("REL_003", "S-3"), ("UNI_001", "S-3")]


def test_master_never_sorts_the_sales(spark):
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        for k in old:
            spark.conf.set(k, "-1")
        t = {n: cut(df) for n, df in tables(spark, [sale("S-1"), sale("S-2", prod="P-9"), sale("S-3", cust=None)]).items()}
        m = MS.build_master({**t, "sales": t["sales"].withColumn("quality_flag", F.lit(""))})
        assert "SortMergeJoin" not in _plan(m)
        rows = {r.sale_id: (r.customer_name, r.product_name) for r in m.collect()}
        assert rows == {"S-1": ("Ann", "Desk"), "S-2": ("Ann", None), "S-3": (None, "Desk")}
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_findings_act_on_own_rows_first_rows_and_odd_keys(spark):
    rows = [sale("S-1", disc="0.9"), sale("S-1", region="Sued"), sale("S-1", disc="0.8"),  # a copy's finding acts on the first row
            sale("row:9", disc="0.7"), sale(None, disc="0.6"), sale("S-2", region=None)]
    rows += [sale(f"S-1{k}") for k in range(3)] + [sale(None, disc="0.95")]  # 'row:9' names the row whose key that is
    t = tables(spark, rows)
    res = CL.clean(t, FD.findings(t, RULES), RULES)
    log = sorted((r.row_ref, r.check_id, r.original_value, r.fixed_value) for r in res.fix_log.where("check_id = 'BIZ_003'").collect())
    assert [x[:2] for x in log] == [("S-1", "BIZ_003")] * 2 + [("row:9", "BIZ_003")] * 2
    assert [x[2] for x in log] == ["0.5", "0.9", "0.5", "0.7"]
    left = [r.row_ref for r in res.unresolved.collect()]
    assert set(left) == {"row:4"} and "row:9" not in left
    outcome = {(r.check_id, r.outcome) for r in res.outcomes.where("row_ref = 'S-2'").collect()}
    assert outcome == {("COM_005", "FLAG")}


@pytest.mark.parametrize("task_rows", [1 << 18, 3])
def test_late_columns_are_numbered_like_early_ones(spark, monkeypatch, task_rows):
    monkeypatch.setattr(RI, "TASK_ROWS", task_rows)
    rows = cut(spark.range(200).select((F.col("id") * 37 % 90).alias("k"), (F.col("id") % 7).alias("v")))
    block, text = [F.floor(F.col("k") / 8)], F.concat(F.lit("t"), F.col("v").cast("string"))
    late = RI.block_sequence(rows, ["k", "t"], block, late={"t": text})
    early = RI.block_sequence(rows.withColumn("t", text), ["k", "t"], block)
    key = lambda df: sorted(map(tuple, df.select("_row_id", "k", "t").collect()))
    assert key(late) == key(early) and [r[0] for r in key(late)] == list(range(200))


def test_fixture_numbers_rows_before_making_texts(spark, tmp_path, monkeypatch):
    row = {"lineitem": "select id l_orderkey, 1L l_partkey, 1L l_suppkey, 1 l_linenumber, 5.0D l_quantity, 0.05D l_discount, 'A' l_returnflag, timestamp'1998-01-05' l_shipdate from range(50)",
           "orders": "select id o_orderkey, 1L o_custkey from range(50)", "customer": "select 1L c_custkey, 1L c_nationkey",
           "nation": "select 1L n_nationkey, 1L n_regionkey", "region": "select 1L r_regionkey, 'ASIA' r_name",
           "part": "select 1L p_partkey, 10.0D p_retailprice"}
    for t, sql in row.items():
        spark.sql(sql).write.parquet(f"{tmp_path}/{t}.parquet")
    written = []
    monkeypatch.setattr(FX, "cut", lambda df: written.append(df.columns) or cut(df))
    assert FX.sales_raw(spark, str(tmp_path), extended=True).columns == [*FX.sales_columns(True), "_row_id"]
    assert len(written) == 1 and not set(written[0]) & set(FX.sales_columns(True))
