"""Only rows that plain text tests cannot clear are parsed and checked; the joins of the fixture run once."""
from pyspark.sql import functions as F

from qualis.operators import checks as C
from qualis.plans import catalog as Q
from qualis.sources import fixture as FX

GOOD = ["S-1", "1998-01-05", "C-1", "P-1", "3", "12.50", "0.05", "North", "online"]
ODD = {"sale_date": ["1998-1-5", " 1998-01-05", "1998-02-30", "0000-01-01", "1998-01-05\n", "2030-01-01", "1990-01-01", "x", None, "١٩٩٨-01-05"],
       "quantity": ["-5", "0", "nan", "1_000", "1e9", "9999", "abc", " 3", None, "3\n"],
       "unit_price": ["-1", "0", "inf", "12,5", None], "discount": ["0.9", "-0.1", "nan", "0,5", None],
       "region": ["Nord", "north", None], "sales_channel": ["fax", None], "sale_id": [None], "customer_id": [None], "product_id": [None]}


def _sales(spark):
    rows = [GOOD] * 5
    for c, values in ODD.items():
        rows += [[v if name == c else g for name, g in zip(FX.SALES_COLUMNS, GOOD)] for v in values]
    schema = ", ".join(f"{c} string" for c in FX.SALES_COLUMNS) + ", _row_id long, _pos long"
    return spark.createDataFrame([(*r, i, i) for i, r in enumerate(rows)], schema)


def test_no_finding_is_cleared(spark):
    rules, sales = Q.fixture_rules(), _sales(spark)
    layout = C.Layout({"sales": set(sales.columns)})
    for threshold in (0.0, 30.0):
        insts, parsed = C.instances(layout, rules, 3.0, threshold)
        local = [c for c in insts["sales"] if c.layer not in (3, 4)]
        clear = C.unremarkable("sales", local, layout, rules, threshold)
        every = C._emit(sales.withColumns(parsed["sales"].cols), local, "sales")
        some = C._emit(sales.where(~clear).withColumns(parsed["sales"].cols), local, "sales")
        assert every.exceptAll(some).isEmpty() and every.count() == some.count() > 20
        assert sales.where(clear & (F.col("_row_id") < 5)).count() == 5  # ordinary rows are not parsed


def test_fixture_joins_run_once(spark, tmp_path):
    row = {"lineitem": "select id l_orderkey, 1L l_partkey, 1L l_suppkey, 1 l_linenumber, 5.0D l_quantity, 0.05D l_discount, 'A' l_returnflag, timestamp'1998-01-05' l_shipdate from range(3000)",
           "orders": "select id o_orderkey, 1L o_custkey from range(3000)", "customer": "select 1L c_custkey, 1L c_nationkey",
           "nation": "select 1L n_nationkey, 1L n_regionkey", "region": "select 1L r_regionkey, 'ASIA' r_name",
           "part": "select 1L p_partkey, 10.0D p_retailprice"}
    for t, sql in row.items():
        spark.sql(sql).write.parquet(f"{tmp_path}/{t}.parquet")
    out = FX.sales_raw(spark, str(tmp_path))
    assert not [f for f in out.inputFiles() if "lineitem" in f]  # numbered from the written rows
    slots = [(31 * k + 17 + 7 + 1) % 1000 for k in range(3000)]
    assert out.count() == 3000 + sum(s in (41, 42) for s in slots)
    assert sorted(r[0] for r in out.select("_row_id").collect()) == list(range(out.count()))


def test_injection_does_not_build_the_dirty_fixture(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(Q, "load_fixture", lambda *a, **k: asked.append(k) or {})
    Q._Ctx(spark, "/nowhere")
    assert asked == []
