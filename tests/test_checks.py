"""One case per check on a tiny inline table (detection semantics)."""
from collections import Counter

import pytest

from helpers import sale, tables
from qualis.operators import findings as FD
from qualis.rules import Rules

RULES = Rules(audit_date="2024-06-30")


@pytest.fixture(scope="module")
def found(spark):
    rows = [
        sale("S-1"),                                   # 0 clean
        sale("S-2", date="15.03.2024"),                # 1 SCH_002 (parseable)
        sale("S-3", cust=None),                        # 2 COM_001
        sale("S-4", cust="C-9"),                       # 3 REL_001
        sale("S-5", prod="P-2"),                       # 4 REL_003
        sale("S-6", qty="0"),                          # 5 BIZ_001 (not BIZ_007)
        sale("S-7", disc="0.75"),                      # 6 BIZ_003
        sale("S-8", date="2030-01-01"),                # 7 BIZ_004 future
        sale("S-9", region="NORTH "),                  # 8 BIZ_005
        sale("S-1"),                                   # 9 UNI_001 (copy of row 0)
        sale(None),                                    # 10 SCH_003 row:10
        sale("S-12", qty="abc"),                       # 11 SCH_002 numeric only
        sale("S-13", disc=None),                       # 12 COM_005
        sale("S-14", qty="400"),                       # 13 BIZ_007 (median 5 -> threshold 50)
        sale("S-15", channel="fax", prod="P-404"),     # 14 BIZ_006 + REL_002
        sale("S-16", date="2019-12-31", price="-1"),   # 15 BIZ_004 before minimum + BIZ_002
    ]
    t = tables(spark, rows, customers=[("C-1", "Ann", "B2B", "DE", "2021-03-01"),
                                       ("C-1", "Ann2", None, "DE", "01.03.2021")])
    return [r.asDict() for r in FD.findings(t, RULES).orderBy("_seq").collect()]


def test_counts_per_check(found):
    got = Counter(f["check_id"] for f in found)
    assert got == Counter({"SCH_002": 3, "COM_001": 1, "REL_001": 1, "REL_003": 1, "BIZ_001": 1, "BIZ_003": 1,
                           "BIZ_004": 2, "BIZ_005": 1, "UNI_001": 1, "SCH_003": 1, "COM_005": 2,
                           "BIZ_007": 1, "BIZ_006": 1, "REL_002": 1, "BIZ_002": 1, "UNI_002": 1})


def test_detection_order_and_ids(found):
    ids = [f["error_id"] for f in found]
    assert ids == [f"E{i:05d}" for i in range(1, len(found) + 1)]
    layers = [f["check_layer"] for f in found]
    order = ["SCHEMA", "COMPLETENESS", "UNIQUENESS", "RELATIONSHIP", "BUSINESS_RULE"]
    assert layers == sorted(layers, key=order.index)


def _one(found, check, **kw):
    hits = [f for f in found if f["check_id"] == check and all(f[k] == v for k, v in kw.items())]
    assert len(hits) == 1, (check, kw, hits)
    return hits[0]


def test_texts(found):
    f = _one(found, "SCH_002", column="sale_date", table="sales")
    assert f["message"] == "sale_date '15.03.2024' is not ISO 8601 (parseable -> FIX candidate)"
    assert f["severity"] == "MAJOR" and f["cleaning_action"] == "FIX" and f["row_ref"] == "S-2"
    f = _one(found, "BIZ_007")
    assert f["rule"] == "quantity <= 10 x median (50)"
    assert f["message"] == "quantity 400 is an outlier (median 5)"
    f = _one(found, "BIZ_004", row_ref="S-8")
    assert f["message"] == "sale_date 2030-01-01 is in the future"
    f = _one(found, "BIZ_004", row_ref="S-16")
    assert f["message"] == "sale_date 2019-12-31 is before plausibility minimum 2020-01-01"
    f = _one(found, "BIZ_005")
    assert f["rule"] == "region in ['North', 'South', 'East', 'West', 'Central']"
    assert f["message"] == "region 'NORTH ' not in allowed list"
    f = _one(found, "SCH_003")
    assert (f["row_ref"], f["invalid_value"]) == ("row:10", "<empty>")
    f = _one(found, "UNI_001")
    assert (f["row_ref"], f["invalid_value"]) == ("S-1", "S-1")
    f = _one(found, "BIZ_002")
    assert f["message"] == "unit_price -1 is not positive" and f["rule"] == "unit_price >= 0.01"


def test_master_findings(found):
    # the duplicate customer copy has a NULL segment and a non-ISO date
    assert _one(found, "UNI_002")["row_ref"] == "C-1"
    assert _one(found, "COM_005", table="customers")["column"] == "customer_segment"
    assert _one(found, "SCH_002", table="customers")["invalid_value"] == "01.03.2021"
    # relationship sets come from the first occurrence only (REL_001 on C-9 only)
    assert _one(found, "REL_001")["row_ref"] == "S-4"


@pytest.mark.parametrize("values", [
    ["1", "2", "3", "10"], ["5"], ["2", "2", "2", "9"], ["0.1", "1e300", "7", "7.5", "inf"], ["inf", "inf"],
    ["-3", "nan", "abc", "4", "6"], ["abc", "0"], [str(i * 0.37) for i in range(1, 500)]])
def test_median_is_exact(spark, values):
    import statistics
    from qualis.operators.checks import quantity_threshold
    from qualis.rules import Rules as R
    t = tables(spark, [sale(f"S-{i}", qty=q) for i, q in enumerate(values)])
    nums = [float(v) for v in values if v != "abc" and float(v) > 0]
    median, threshold = quantity_threshold(t["sales"], R(audit_date="2024-06-30"))
    assert median == (statistics.median(nums) if nums else 0.0) and threshold == median * 10
