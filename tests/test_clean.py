"""Cleaning semantics: Q1 unresolved refs, Q2 copies act on the first row,
Q3 repeated repairs, Q6 counting findings, FIX -> DROP escalation."""
import pytest

from helpers import sale, tables
from qualis.operators import clean as CL
from qualis.operators import findings as FD
from qualis.operators import master as MS
from qualis.rules import Rules

RULES = Rules(audit_date="2024-06-30")


@pytest.fixture(scope="module")
def result(spark):
    rows = [
        sale("S-1"),                                   # 0 kept
        sale("S-1", region="Atlantis"),                # 1 copy: dropped; its BIZ_005 acts on row 0 (Q2)
        sale("S-2", date="15.03.2024"),                # 2 date fixed
        sale("S-3", region="Mordor"),                  # 3 escalated -> dropped
        sale("S-4", channel="fax"),                    # 4 escalated -> dropped
        sale("S-5", disc="0.75"),                      # 5 clipped to 0.5 + flag
        sale("S-6", prod="P-2"),                       # 6 flag REL_003
        sale(None),                                    # 7 SCH_003 never resolves (Q1): kept
        sale("S-8", qty="-5", price="-12.50"),         # 8 two DROP findings (Q6)
        sale("S-9", region="Sued"),                    # 9 mapped to South
        sale("S-10", date="5.3.2024"),                 # 10 repeated repair (Q3) ...
        sale("S-10", date="5.3.2024"),                 # 11 ... via its copy
    ]
    t = tables(spark, rows)
    f = FD.findings(t, RULES)
    return t, f, CL.clean(t, f, RULES)


def test_rows_and_flags(result):
    _, _, res = result
    rows = {r["_row_id"]: r.asDict() for r in res.cleaned["sales"].collect()}
    assert sorted(rows) == [0, 2, 5, 6, 7, 9, 10]
    assert rows[0]["region"] == "North" and rows[0]["quality_flag"] == ""
    assert rows[2]["sale_date"] == "2024-03-15"
    assert rows[5]["discount"] == "0.5" and rows[5]["quality_flag"] == "BIZ_003"
    assert rows[6]["quality_flag"] == "REL_003"
    assert rows[9]["region"] == "South"
    assert rows[10]["sale_date"] == "2024-03-05"


def test_counts(result):
    _, _, res = result
    c = {(r.metric, r.check_id): r.n for r in res.counts.collect()}
    assert c[("dropped", "UNI_001")] == 2
    assert c[("dropped", "BIZ_001")] == 1 and c[("dropped", "BIZ_002")] == 1
    assert c[("dropped", "BIZ_005")] == 1 and c[("dropped", "BIZ_006")] == 1
    assert c[("escalated", "BIZ_005")] == 1 and c[("escalated", "BIZ_006")] == 1
    assert c[("fixed", "BIZ_005")] == 2 and c[("fixed", "SCH_002")] == 3 and c[("fixed", "BIZ_003")] == 1
    assert c[("flagged", "BIZ_003")] == 1 and c[("flagged", "REL_003")] == 1
    t = CL.totals(res).first()
    assert t.unresolved_findings == 1


def test_fix_log(result):
    _, _, res = result
    log = sorted((r.row_ref, r.check_id, r.original_value, r.fixed_value)
                 for r in res.fix_log.collect())
    assert ("S-1", "BIZ_005", "North", "North") in log            # Q2: reads the first row
    assert ("S-10", "SCH_002", "5.3.2024", "2024-03-05") in log
    assert ("S-10", "SCH_002", "2024-03-05", "2024-03-05") in log  # Q3: sees the repaired value
    assert ("S-5", "BIZ_003", "0.75", "0.5") in log
    esc = sorted((r.row_ref, r.original_value, r.fixed_value) for r in res.escalations.collect())
    assert esc == [("S-3", "Mordor", "<dropped>"), ("S-4", "fax", "<dropped>")]


def test_master(result):
    _, _, res = result
    m = {r.sale_id: r for r in MS.build_master(res.cleaned).collect()}
    assert m["S-1"].gross_revenue == 50.0 and m["S-1"].net_revenue == 45.0
    assert m["S-1"].customer_name == "Ann" and m["S-6"].active_status == "inactive"
    assert m[None].gross_revenue == 50.0


def test_second_pass_references_new_positions(result, spark):
    _, _, res = result
    f2 = FD.findings(res.cleaned, RULES)
    refs = {(r.check_id, r.row_ref) for r in f2.collect()}
    # the NULL-id row sits at position 5 of the cleaned table (0,2,5,6,7 before it are kept)
    assert ("SCH_003", "row:4") in refs
    assert ("REL_003", "S-6") in refs


def test_master_join_fails_fast_on_duplicate_master_keys(spark):
    from helpers import tables as mk
    t = mk(spark, [sale("S-1")], customers=[("C-1", "Ann", "B2B", "DE", "2021-03-01"),
                                           ("C-1", "Ann2", "B2B", "DE", "2021-03-01")])
    with pytest.raises(Exception, match="key not unique"):
        MS.build_master(t).collect()
