"""The defect plan gives every class exactly its number of rows, at the ranks of the hash order."""
import random

import pytest

from conftest import SF
from qualis.operators import inject as IJ
from qualis.plans import catalog as Q


@pytest.mark.parametrize("ids", [range(5000), [k * 1000003 for k in range(3000)], [7, 7 + 1000003, 8], []])
def test_boundaries_are_the_rows_at_their_ranks(spark, ids, monkeypatch):
    monkeypatch.setattr(IJ, "CELLS", 16)
    ids = list(ids)
    df = spark.createDataFrame([(k,) for k in ids], "_row_id long")
    key = lambda k: (((k % 1000003) * 2654435761 + 42 * 40503) % 1000003, k)
    order = sorted(map(key, ids))
    ranks = sorted({0, 1, len(ids) // 3, len(ids) // 2, max(0, len(ids) - 1), len(ids), random.Random(1).randrange(len(ids) + 1)})
    assert IJ.boundaries(df, 42, ranks) == [order[r] if r < len(order) else (1000003, 0) for r in ranks]


def test_every_class_has_its_planned_number(spark):
    rows = Q.q_inject_self_check(spark, SF).collect()
    assert len(rows) == 22 and {r["status"] for r in rows} == {"OK"}
    assert all(r["planned"] is None or r["planned"] == r["in_manifest"] for r in rows)
    assert sum(r["planned"] is not None for r in rows) == 19
