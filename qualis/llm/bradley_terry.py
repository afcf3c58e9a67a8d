"""Operator 3: quality scores by Bradley-Terry pairwise ranking.

The model says that document i is preferred to j with probability
``sigmoid(s_i - s_j)`` for a linear score ``s = w . f``, fitted by logistic loss
on the feature differences ``f_i - f_j`` (no intercept: only differences count).
Features are statistics of the whole text, each standardised and cut into
quantile steps, so the score is a sum of monotone or bent curves.

Every learnable labelled document takes part in the means, the quantile steps, the
pairs and the decision; there is no sample. All pairs of a good and a bad document
would be quadratic, so documents are dealt into blocks by a hash of their id
(``BLOCK`` of the larger class each; a document of the smaller class stands in as
many blocks as give every block about ``PARTNERS`` of them), and the loss runs over
all pairs inside the blocks. Up to ``BLOCK`` documents of a class this is every pair
there is. A Newton step is a scan of the blocks; a task sends one gradient and one
matrix, which are added up in the order of the tasks.

The decision is a quantile of the scores: the cut t is where the share of
scores below t, with classes weighted as they occur in all learnable labels,
is the share of bad labels.  It is found exactly by narrowing score ranges.  The
public score is ``sigmoid(s - t + logit(0.7))``, so ``score >= 0.7`` means "above
the quantile".

Texts are read once: their features are written and serve learning and scoring.
Defined results: null or empty texts get the score of their (zero) features; null
texts are not learned from; an id that repeats is learned once, by its least
features; repeated rows score alike; rows with a null id are scored,
``held_out`` false; without labels of both classes every score is 0.0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualis.llm import quality_rules
from qualis.llm import text as T
from qualis.llm.sample import residue
from qualis.llm.session import cut, settings

BLOCK, PARTNERS = 128, 64
STEPS, CELLS = 8, 4096
NEWTON = 15
MOD, HELD = 4, 2
THRESHOLD = 0.7

FEATURES = ("log_words", "word_length", *quality_rules.CLASSES, "dup_lines", "repeat_windows", "repeat_next",
            "distinct_words", "bars", "bangs", "words_per_line", "line_ends")


def features(column) -> np.ndarray:
    """Statistics of every text (texts x features); zeros for an empty one."""
    raw, off = T.utf8(column)
    got = quality_rules.base(column)
    words, at = T.word_hashes(raw, off)
    n = got["n_words"]
    some, cls = np.maximum(n, 1), got["classes"]
    chars = np.maximum(cls.sum(axis=1), 1)
    again = np.zeros(len(words), np.int64)
    again[1:] = words[1:] == words[:-1]
    first = at[:-1][n > 0]
    again[first] = 0
    lines = T.row_sums((raw == 10).astype(np.int64), off) + (n > 0)
    return np.column_stack([
        np.log1p(n), got["word_chars"] / some, *(cls[:, k] / chars for k in range(cls.shape[1])),
        got["n_dup_lines"] / np.maximum(lines, 1), got["n_repeat_words"] / some, T.row_sums(again, at) / some,
        np.diff(T.distinct(words, at)[1]) / some ** 0.9,
        T.row_sums((raw == 124).astype(np.int64), off) / some, T.row_sums((raw == 33).astype(np.int64), off) / some,
        np.log1p(n / np.maximum(lines, 1)), T.row_sums((raw == 46).astype(np.int64), off) / some])


def expand(f: np.ndarray, model: dict) -> np.ndarray:
    z = np.clip((f - model["mean"]) / model["dev"], -5, 5)
    steps = [f[:, [k]] > model["edges"][k][None, :] for k in range(f.shape[1])]
    return np.concatenate([z, *steps], axis=1).astype(float)


def _partial_sums(table: DataFrame, sums) -> list[np.ndarray]:
    """``sums(batch)`` (a list of arrays) added up over all batches, in the order of the tasks."""
    def run(batches):
        from pyspark import TaskContext
        total = None
        for b in batches:
            got = sums(b)
            total = got if total is None else [x + y for x, y in zip(total, got)]
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([[x.ravel().tolist() for x in total]],
                                                                                  pa.list_(pa.list_(pa.float64())))], ["task", "sums"])
    rows = sorted(table.mapInArrow(run, "task int, sums array<array<double>>").collect(), key=lambda r: r["task"])
    return [sum(np.array(r["sums"][k]) for r in rows) for k in range(len(rows[0]["sums"]))] if rows else []


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def scale(examples: DataFrame) -> dict:
    """Mean, deviation and quantile steps of every feature, over all ``examples`` (y, f)."""
    n, total = _partial_sums(examples.select("f"), lambda b: [np.array([b.num_rows]), _matrix(b.column(0)).sum(axis=0)])
    mean = total / n
    square, = _partial_sums(examples.select("f"), lambda b: [((_matrix(b.column(0)) - mean) ** 2).sum(axis=0)])
    model = {"mean": mean, "dev": np.sqrt(square / n) + 1e-9}
    # counts in cells of every feature: whole numbers, the same in any order
    at = lambda name: F.element_at(F.array(*map(F.lit, model[name].tolist())), F.col("k") + 1)
    values = examples.select(F.posexplode("f").alias("k", "v")).withColumn("z", (F.col("v") - at("mean")) / at("dev"))
    cell = F.floor((F.greatest(F.least("z", F.lit(5.0)), F.lit(-5.0)) + 5) * (CELLS / 10))
    cells = values.groupBy("k", cell.alias("c")).agg(F.count(F.lit(1)).alias("n"), F.max("v").alias("top")).collect()
    edges = []
    for k in range(len(mean)):
        own = sorted((r for r in cells if r["k"] == k), key=lambda r: r["c"])
        below = np.cumsum([r["n"] for r in own])
        picked = np.searchsorted(below, np.arange(1, STEPS) / STEPS * below[-1])
        edges.append(np.unique([own[i]["top"] for i in picked]))
    return model | {"edges": edges}


def blocks(examples: DataFrame, n: dict[int, int]) -> DataFrame:
    """(good, bad): the features of the documents of a block, as bytes."""
    few = min(n, key=n.get)
    count = max(1, -(-n[1 - few] // BLOCK))
    times = min(count, -(-PARTNERS * count // n[few]))
    first = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(count))
    step = F.explode(F.sequence(F.lit(0), F.when(F.col("y") == few, times - 1).otherwise(0)))
    dealt = examples.select("doc_id", "y", "f", first.alias("first"), step.alias("step"))

    def pack(t: pa.Table) -> pa.Table:
        t = t.sort_by("doc_id")
        y, f = t["y"].to_numpy(), _matrix(t["f"].combine_chunks())
        return pa.table({k: pa.array([f[y == v].tobytes()], pa.binary()) for k, v in (("good", 1), ("bad", 0))})

    return (dealt.select(((F.col("first") + F.col("step")) % count).alias("block"), "doc_id", "y", "f")
            .groupBy("block").applyInArrow(pack, "good binary, bad binary"))


def weights(paired: DataFrame, model: dict) -> np.ndarray:
    """Newton steps of the logistic loss on the differences of all pairs of each block, ridge 1e-3."""
    wide = len(model["mean"])
    size = wide + sum(map(len, model["edges"]))
    w = np.zeros(size)
    for _ in range(NEWTON):
        def sums(b, w=w):
            n, grad, hess = 0, np.zeros(size), np.zeros((size, size))
            for good, bad in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                g, c = (expand(np.frombuffer(x).reshape(-1, wide), model) for x in (good, bad))
                p = 1 / (1 + np.exp(np.clip((g @ w)[:, None] - (c @ w)[None, :], -30, 30)))
                q = p * (1 - p)
                cross = g.T @ (q @ c)
                grad += c.T @ p.sum(axis=0) - g.T @ p.sum(axis=1)
                hess += (g * q.sum(axis=1)[:, None]).T @ g + (c * q.sum(axis=0)[:, None]).T @ c - cross - cross.T
                n += p.size
            return [np.array([n]), grad, hess]

        n, grad, hess = _partial_sums(paired, sums)
        n = max(float(n[0]), 1.0)
        w = w - np.linalg.solve(hess.reshape(size, size) / n + 1e-3 * np.eye(size), grad / n + 1e-3 * w)
    return w


def quantile(scores: DataFrame, n: dict[int, int], bad_share: float) -> float:
    """The middle of the two neighbouring scores of (y, s) where the weighted share below passes ``bad_share``."""
    weight = {0: bad_share / n[0], 1: (1 - bad_share) / n[1]}
    ends = scores.agg(F.min("s").alias("lo"), F.max("s").alias("hi")).first()
    lo, hi, before, below = ends["lo"], ends["hi"], {0: 0, 1: 0}, None
    while lo < hi:
        cell = F.least(F.floor((F.col("s") - F.lit(lo)) / F.lit(hi - lo) * CELLS), F.lit(CELLS - 1))
        rows = sorted(scores.where(F.col("s").between(lo, hi)).groupBy(cell.alias("c")).agg(
            F.count_if(F.col("y") == 0).alias("bad"), F.count_if(F.col("y") == 1).alias("good"),
            F.min("s").alias("lo"), F.max("s").alias("hi")).collect(), key=lambda r: r["c"])
        for r in rows:
            after = {0: before[0] + r["bad"], 1: before[1] + r["good"]}
            if sum(weight[k] * after[k] for k in after) > bad_share or r is rows[-1]:
                lo, hi = r["lo"], r["hi"]
                break
            before, below = after, r["hi"]
    return lo if below is None else (below + lo) / 2


def train(examples: DataFrame, bad_share: float) -> dict | None:
    """Fit on all ``examples`` (doc_id, y 0/1, f); ``bad_share`` of label 0 among all learnable labels."""
    n = {r["y"]: r["count"] for r in examples.groupBy("y").count().collect()}
    if len(n) < 2:
        return None
    model = scale(examples)
    w = weights(cut(blocks(examples, n)), model)

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(expand(_matrix(b.column(1)), model) @ w)], ["y", "s"])

    scores = cut(examples.select("y", "f").mapInArrow(run, "y int, s double"))
    return model | {"w": w, "cut": quantile(scores, n, bad_share)}


def predict(f: np.ndarray, model: dict) -> np.ndarray:
    """Scores of feature rows."""
    s = expand(f, model) @ model["w"] - model["cut"] + np.log(THRESHOLD / (1 - THRESHOLD))
    return 1 / (1 + np.exp(-np.clip(s, -500, 500)))


def described(docs: DataFrame) -> DataFrame:
    """(doc_id, known: whether there is a text, f: its features), one row per row of ``docs``."""
    def run(batches):
        for b in batches:
            f = features(b.column(1)).astype(float)
            column = pa.ListArray.from_arrays(pa.array(np.arange(len(f) + 1) * f.shape[1], pa.int32()), pa.array(f.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1).is_valid(), column], ["doc_id", "known", "f"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, known boolean, f array<double>")


def fit(described: DataFrame, labels: DataFrame) -> dict | None:
    """The model of all learnable labels; ``described`` from ``described``, written."""
    open_ = labels.where(residue("doc_id", MOD) != HELD).where("quality is not null")
    share = open_.agg(F.avg((F.col("quality") == 0).cast("double"))).first()[0]
    known = (open_.where("doc_id is not null").groupBy("doc_id").agg(F.max("quality").cast("int").alias("y")))
    examples = (described.where("known").join(known, "doc_id").groupBy("doc_id")
                .agg(F.min("y").alias("y"), F.min("f").alias("f")))
    return train(cut(examples.sortWithinPartitions("doc_id")), share or 0.0)


def rank(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    spark = docs.sparkSession
    settings(spark)
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    known = cut(described(docs))
    model = fit(known, labels)
    if model is None:
        scored = known.select("doc_id", F.lit(0.0).alias("score"))
    else:
        shared = spark.sparkContext.broadcast(model)  # some hundred numbers

        def run(batches):
            for b in batches:
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(predict(_matrix(b.column(1)), shared.value))],
                                                 ["doc_id", "score"])

        scored = known.select("doc_id", "f").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")
    return scored.select("doc_id", (residue("doc_id", MOD) == HELD).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
