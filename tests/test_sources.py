"""Sources and sinks: CSV/JSON/parquet round trips with file positions, header
gate, input gate, manifest scan, findings split by layer."""
import json
import os
import tempfile

import pytest

from conftest import SF
from qualis.sources import readers as R
from qualis.sources import sinks as SK
from qualis.sources.fixture import SALES_COLUMNS
from qualis.sources.readers import load_fixture

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


@pytest.fixture(scope="module")
def sales(spark):
    return load_fixture(spark, SF)["sales"].cache()


def test_csv_round_trip_keeps_values_and_positions(spark, sales):
    d = tempfile.mkdtemp(prefix="qualis-io-")
    sales.orderBy("_row_id").select(*SALES_COLUMNS).coalesce(1).write.option("header", True) \
        .option("escape", '"').option("emptyValue", "").option("ignoreLeadingWhiteSpace", False) \
        .option("ignoreTrailingWhiteSpace", False).csv(f"{d}/csv")
    back = R.with_text_positions(R.empty_to_null(R.read_csv_text(spark, f"{d}/csv", SALES_COLUMNS)))
    key = lambda t: tuple("" if x is None else str(x) for x in t)
    a = sorted((tuple(r) for r in sales.select(*SALES_COLUMNS, "_row_id").collect()), key=key)
    b = sorted((tuple(r) for r in back.select(*SALES_COLUMNS, "_row_id").collect()), key=key)
    assert a == b


def test_parquet_positions_follow_files(spark, sales):
    d = tempfile.mkdtemp(prefix="qualis-io-")
    sales.orderBy("_row_id").select(*SALES_COLUMNS).coalesce(1).write.parquet(f"{d}/pq")
    back = R.with_file_positions(spark.read.parquet(f"{d}/pq"))
    assert sorted(r._row_id for r in back.collect()) == list(range(sales.count()))


def test_header_gate(spark):
    d = tempfile.mkdtemp(prefix="qualis-io-")
    with open(f"{d}/a.csv", "w") as f:
        f.write("sale_id,sale_date,customer_id\nS-1,2024-01-01,C-1\n")
    with open(f"{d}/b.csv", "w") as f:
        f.write("sale_id,customer_id,product_id\nS-2,C-1,P-1\n")
    got = sorted((os.path.basename(r.file), r.missing_column)
                 for r in R.header_problems(spark, d, ["sale_id", "sale_date", "product_id"]).collect())
    assert got == [("a.csv", "product_id"), ("b.csv", "sale_date")]


def test_input_gate_lists_every_missing_file(spark):
    d = tempfile.mkdtemp(prefix="qualis-io-")
    open(f"{d}/sales.csv", "w").write("x\n1\n")
    with pytest.raises(R.DataLoadError, match="customers.parquet, products.parquet"):
        R.assert_inputs_present(spark, d, {"sales": "sales.csv", "customers": "customers.parquet",
                                           "products": "products.parquet"})


def test_manifest_scan(spark):
    d = tempfile.mkdtemp(prefix="qualis-io-")
    doc = {"seed": 42, "generated_for": "x", "scope_note": "y", "total_injected_errors": 2,
           "errors": [{"table": "sales", "row_ref": "S-1", "error_class": "COM_001", "column": "customer_id",
                       "detail": "d"},
                      {"table": "customers", "row_ref": "C-1", "error_class": "UNI_002", "column": "customer_id",
                       "detail": "d"}]}
    json.dump(doc, open(f"{d}/manifest.json", "w"), indent=2)
    m = R.read_manifest(spark, f"{d}/manifest.json")
    assert sorted((r.table, r.error_class) for r in m.collect()) == [("customers", "UNI_002"), ("sales", "COM_001")]


def test_findings_split_by_layer_keeps_schema(spark):
    from qualis.plans.catalog import Ctx
    d = tempfile.mkdtemp(prefix="qualis-io-")
    f = Ctx(spark, SF).findings
    SK.write_findings_by_layer(f.where("check_layer <> 'UNIQUENESS'"), f"{d}/errors")
    empty = SK.read_findings_layer(spark, f"{d}/errors", "UNIQUENESS")
    assert empty.count() == 0 and len(empty.columns) == 12
    assert SK.read_findings_layer(spark, f"{d}/errors", "SCHEMA").count() > 0


def test_manifest_json_round_trip(spark):
    from qualis.plans.catalog import Ctx
    d = tempfile.mkdtemp(prefix="qualis-io-")
    manifest = Ctx(spark, SF).injected[2]
    SK.write_manifest(manifest, f"{d}/manifest", 42, "sf0.001")
    back = R.read_manifest(spark, f"{d}/manifest")
    assert back.count() == manifest.count()
    assert back.exceptAll(manifest.select(*back.columns)).count() == 0
