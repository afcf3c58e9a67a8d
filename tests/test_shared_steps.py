"""Steps that many queries share move narrow rows only: numbering of the fixture, injection, its check."""
import pytest
from helpers import sale, tables
from pyspark.sql import functions as F

from qualis.operators import checks as C
from qualis.operators import inject as IJ
from qualis.rules import Rules
from qualis.session import cut, setting
from qualis.sources import fixture as FX


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _inputs(spark, path, lineitem):
    row = {"lineitem": lineitem,
           "orders": "select id o_orderkey, id % 3 o_custkey from range(3000)", "customer": "select id c_custkey, 1L c_nationkey from range(3)",
           "nation": "select 1L n_nationkey, 1L n_regionkey", "region": "select 1L r_regionkey, 'ASIA' r_name",
           "part": "select id p_partkey, 10.0D + id p_retailprice from range(5)"}
    for t, sql in row.items():
        spark.sql(sql).write.parquet(f"{path}/{t}.parquet")
    return str(path)


def _lineitem(n, quantity):
    return (f"select id % 2500 l_orderkey, id % 5 l_partkey, 1L l_suppkey, if(id % 4 = 0, null, 1) l_linenumber, {quantity} l_quantity, "
            f"0.05D l_discount, 'A' l_returnflag, timestamp'1998-01-05' l_shipdate from range({n})")


@pytest.mark.parametrize("extended", [False, True])
def test_texts_of_the_fixture_are_not_shuffled(spark, tmp_path, extended):
    sf = _inputs(spark, tmp_path, _lineitem(2500, "5.0D"))
    sales = FX.sales_raw(spark, sf, extended=extended)
    assert "hashpartitioning" not in _plan(sales) and "SortMergeJoin" not in _plan(sales)
    ids = sorted(r[0] for r in sales.select("_row_id").collect())
    assert ids == list(range(len(ids))) and len(ids) >= 2500
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"


def test_rows_of_equal_keys_are_numbered_by_their_texts(spark, tmp_path):
    # keys of every row occur four times; as texts 10 stands before 9
    sf = _inputs(spark, tmp_path, _lineitem(10000, "double(7 + id div 2500)"))
    rows = FX.sales_raw(spark, sf).orderBy("_row_id").collect()
    assert [r["_row_id"] for r in rows] == list(range(len(rows)))
    of = {}
    for r in rows:
        if r["sale_id"] and r["quantity"] in ("10", "7", "8", "9"):
            of.setdefault(r["sale_id"], []).append(r["quantity"])
    four = ["10", "7", "8", "9"]  # a sale that is emitted twice: the first copies, then the second ones
    assert len(of) > 2000 and all(v in (four, four + four) for v in of.values())


@pytest.mark.parametrize("gap", [0, 7])
def test_copies_are_put_in_without_a_shuffle_of_the_rows(spark, gap):
    n = 5000
    base = cut(spark.range(n).select((F.col("id") + F.when(F.col("id") > 100, gap).otherwise(0)).alias("_row_id"),
                                     F.concat(F.lit("t"), F.col("id").cast("string")).alias("text")))
    dups = cut(base.where("_row_id % 50 = 3"))
    out = IJ._resequence(base, dups, base)
    if not gap:
        assert "Window" not in _plan(out) and "hashpartitioning" not in _plan(out)
    twice = {r["_row_id"] for r in dups.collect()}
    want = [r["text"] for r in sorted(base.collect(), key=lambda r: r["_row_id"]) for _ in range(1 + (r["_row_id"] in twice))]
    assert [tuple(r) for r in out.orderBy("_row_id").select("_row_id", "text").collect()] == list(enumerate(want))


def test_rows_without_a_defect_pass_no_long_code(spark):
    base = {t: cut(df) for t, df in tables(spark, [sale(f"S-{i}", date="2024-01-05") for i in range(4000)]).items()}
    dirty, manifest = IJ.inject(base)
    assert not set(manifest.where("table = 'sales'").inputFiles()) & set(base["sales"].inputFiles())
    named = {r["row_ref"] for r in manifest.where("table = 'sales'").collect()}
    same = dirty["sales"].drop("_row_id").exceptAll(base["sales"].drop("_row_id"))
    assert {r["sale_id"] for r in same.collect()} == named and len(named) == 4000 * 1350 // 20000
    ids = sorted(r[0] for r in dirty["sales"].select("_row_id").collect())
    assert ids == list(range(4000 + manifest.where("error_class = 'UNI_001'").count()))


def test_self_check_shuffles_keys_only(spark):
    base = {t: cut(df) for t, df in tables(spark, [sale(f"S-{i}") for i in range(2000)]).items()}
    dirty, manifest = IJ.inject(base)
    dirty = {t: cut(df) for t, df in dirty.items()}
    rules = Rules(audit_date=IJ.INJECT_AUDIT_DATE).with_overrides(date_min=IJ.INJECT_DATE_MIN)
    with setting(spark, "spark.sql.adaptive.enabled", "false"):
        got = IJ.self_check(base, dirty, cut(manifest), rules)
        wide = [x for x in _plan(got).splitlines() if "Join" in x and ("sale_date" in x or "quantity" in x)]
        joined = _plan(got).split("ShuffledHashJoin")
    assert not wide and len(joined) > 2
    assert not any("sale_date" in part.split("HashAggregate")[0] for part in joined[1:])
    assert {r["error_class"]: r["in_data"] for r in got.where("error_class like 'REL%'").collect()} == {
        r["error_class"]: r["n"] for r in IJ.manifest_counts(manifest).where("error_class like 'REL%'").collect()}


def test_a_column_meets_one_regex(spark):
    rules = Rules(audit_date="2024-06-30")
    aligned, layout = C.align(tables(spark, [sale()]), rules)
    insts, _ = C.instances(layout, rules, 5.0, 50.0)
    text = str(C.unremarkable("sales", [c for c in insts["sales"] if c.layer not in (3, 4)], layout, rules, 50.0))
    assert text.lower().count("rlike(") == 4  # three numbers and a date
