"""Operator 3 learns from every learnable label: no sample, no drawn pairs."""
import numpy as np
from llm_cases import frame  # noqa: F401
from pyspark.sql import functions as F

from qualis.llm import bradley_terry as B


def _examples(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, y int, f array<double>")


def test_every_learnable_label_is_an_example(frame, spark, monkeypatch):
    held = []
    monkeypatch.setattr(B, "train", lambda examples, share: held.append((examples.collect(), share)))
    rows = [(k, f"text {k} " * (1 + k % 7)) for k in range(9000)] + [(5, "other text of five"), (9001, None)]
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(9002)] + [(None, 1), (6, None)], "doc_id long, quality int")
    B.fit(B.described(frame(rows, "doc_id long, text string")), labels)
    got, share = held[0]
    open_ = {r["doc_id"] for r in labels.where(B.residue("doc_id", B.MOD) != B.HELD).where("doc_id < 9000").collect()}
    assert len(got) == len(open_) > 6000 and {r["doc_id"] for r in got} == open_
    assert all(r["y"] == int(r["doc_id"] % 3 == 0) for r in got) and 0.6 < share < 0.7


def test_blocks_hold_every_example(spark):
    rng = np.random.default_rng(1)
    rows = [(k, int(k % 40 == 0), [float(k), float(rng.normal())]) for k in range(4000)]
    n = {1: 100, 0: 3900}
    got = B.blocks(_examples(spark, rows), n).collect()
    good = [np.frombuffer(r["good"]).reshape(-1, 2)[:, 0] for r in got]
    bad = [np.frombuffer(r["bad"]).reshape(-1, 2)[:, 0] for r in got]
    assert sorted(np.concatenate(bad)) == [float(k) for k in range(4000) if k % 40]
    assert set(np.concatenate(good)) == {float(k) for k in range(0, 4000, 40)}
    assert min(map(len, good)) > 0 and max(map(len, bad)) < 4 * B.BLOCK


def test_scale_and_weights_equal_plain_sums(spark):
    rng = np.random.default_rng(2)
    y = np.array([1, 0] * 50)
    f = np.column_stack([rng.normal(size=100) + y, rng.integers(0, 3, 100).astype(float)])
    examples = _examples(spark, [(k, int(y[k]), f[k].tolist()) for k in range(100)])
    model = B.scale(examples)
    assert np.allclose(model["mean"], f.mean(axis=0)) and np.allclose(model["dev"], f.std(axis=0))
    for k, edges in enumerate(model["edges"]):  # values of the data; a step holds an eighth of the rows, ties apart
        assert set(edges) <= set(f[:, k])
    assert np.allclose(model["edges"][0], np.quantile(f[:, 0], np.arange(1, 8) / 8, method="inverted_cdf"))
    w = B.weights(B.blocks(examples, {0: 50, 1: 50}), model)
    x = B.expand(f, model)
    diff = (x[y == 1][:, None, :] - x[y == 0][None, :, :]).reshape(2500, -1)
    p = 1 / (1 + np.exp(diff @ w))
    assert np.abs(-(p @ diff) / 2500 + 1e-3 * w).max() < 1e-9  # the gradient over all pairs is zero


def test_quantile_is_exact(spark):
    rng = np.random.default_rng(4)
    s, y = np.round(rng.normal(size=3000), 3), rng.integers(0, 2, 3000)
    n = {0: int((y == 0).sum()), 1: int((y == 1).sum())}
    at = B.quantile(spark.createDataFrame(list(zip(y.tolist(), s.tolist())), "y int, s double"), n, 0.3)
    share = lambda t: 0.3 * (s[y == 0] < t).mean() + 0.7 * (s[y == 1] < t).mean()
    after = s[s > at].min()
    assert share(at) <= 0.3 < share(after + 1e-9)


def test_one_class_scores_zero(frame, spark):
    docs = frame([(k, "some words") for k in range(20)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1) for k in range(20)], "doc_id long, quality int")
    assert [r["score"] for r in B.rank(docs, labels).where(F.col("score") != 0).collect()] == []
