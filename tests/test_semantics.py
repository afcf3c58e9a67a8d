"""Edge semantics of SURVEY §2.14: Q7, Q11, Q16."""
import pytest

from helpers import sale, tables
from qualis.operators import clean as CL
from qualis.operators import findings as FD
from qualis.operators import master as MS
from qualis.rules import Rules

RULES = Rules(audit_date="2024-06-30")


@pytest.fixture(scope="module")
def run(spark):
    rows = [
        sale("S-1"),
        sale("S-2", qty="15.03.2024"),        # Q7: numeric SCH_002 repaired by the date handler
        sale("S-3", prod="P-3"),              # Q11: product with NULL status
        sale("S-4", prod="P-4"),              # Q11: padded status
        sale("S-5", disc="nan"),              # Q16: parseable, BIZ_003 fires, clip keeps NaN
        sale("S-6", qty="nan"),               # Q16: no BIZ_001 / BIZ_007 on NaN
        sale("S-7", disc="1_000"),            # Q16: underscores between digits parse
    ]
    prods = [("P-1", "Desk", "Office", "100.00", "active"), ("P-3", "Chair", "Office", "50.00", None),
             ("P-4", "Stand", "Office", "20.00", "Active ")]
    t = tables(spark, rows, products=prods)
    f = FD.findings(t, RULES)
    res = CL.clean(t, f, RULES)
    return [r.asDict() for r in f.collect()], res


def test_q7_numeric_cell_through_date_repair(run):
    found, res = run
    assert any(x["check_id"] == "SCH_002" and x["row_ref"] == "S-2" and x["column"] == "quantity" for x in found)
    log = {(r.row_ref, r.check_id): (r.original_value, r.fixed_value) for r in res.fix_log.collect()}
    assert log[("S-2", "SCH_002")] == ("15.03.2024", "2024-03-15")
    m = {r.sale_id: r for r in MS.build_master(res.cleaned).collect()}
    assert m["S-2"].quantity == "2024-03-15" and m["S-2"].gross_revenue is None


def test_q11_status_null_or_padded_is_not_active(run):
    found, _ = run
    rel3 = {x["row_ref"] for x in found if x["check_id"] == "REL_003"}
    assert rel3 == {"S-3", "S-4"}
    assert any(x["check_id"] == "SCH_003" and x["table"] == "products" and x["column"] == "active_status"
               for x in found)


def test_q16_nan_and_underscores(run):
    found, res = run
    biz3 = {x["row_ref"]: x["message"] for x in found if x["check_id"] == "BIZ_003"}
    assert biz3 == {"S-5": "discount nan outside [0, 0.5]", "S-7": "discount 1000 outside [0, 0.5]"}
    assert not any(x["row_ref"] == "S-6" and x["check_id"] in ("BIZ_001", "BIZ_007", "SCH_002") for x in found)
    log = {(r.row_ref, r.check_id): (r.original_value, r.fixed_value) for r in res.fix_log.collect()}
    assert log[("S-5", "BIZ_003")] == ("nan", "nan")
    assert log[("S-7", "BIZ_003")] == ("1_000", "0.5")
