"""Hand-calculated scores and traffic-light boundaries (reference T16-T19)."""
import pytest

from qualis.operators import score as SC
from qualis.rules import Rules


def _score(spark, counts, rows):
    sev = [(s,) for s, n in counts.items() for _ in range(n)]
    f = spark.createDataFrame(sev or [], "severity string")
    t = {"sales": spark.range(rows).withColumnRenamed("id", "_row_id")}
    return SC.score(f, t, Rules(audit_date="2024-06-30")).first()


@pytest.mark.parametrize("counts,rows,score,light", [
    ({"CRITICAL": 2, "MAJOR": 3, "MINOR": 4}, 1000, 96, "green"),
    ({"CRITICAL": 200}, 100, 0, "red"),
    ({"MINOR": 95}, 1000, 91, "green"),
    ({"MINOR": 96}, 1000, 90, "green"),
    ({"MINOR": 106}, 1000, 89, "yellow"),
    ({"MINOR": 296}, 1000, 70, "yellow"),
    ({"MINOR": 306}, 1000, 69, "red"),
    ({}, 10, 100, "green"),
])
def test_score_boundaries(spark, counts, rows, score, light):
    r = _score(spark, counts, rows)
    assert (r.score, r.traffic_light) == (score, light)


def test_weighted_points(spark):
    r = _score(spark, {"CRITICAL": 2, "MAJOR": 3, "MINOR": 4}, 1000)
    assert abs(r.weighted_error_points - 3.6) < 1e-9
    assert (r.n_critical, r.n_major, r.n_minor, r.total_errors) == (2, 3, 4, 9)


def test_zero_rows_is_an_error(spark):
    with pytest.raises(Exception):
        _score(spark, {"MINOR": 1}, 0)
