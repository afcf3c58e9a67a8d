"""Operator 5: toxicity by subword-bag embeddings and a linear softmax.

A token (run of ASCII letters, digits and bytes >= 0x80, A-Z lowered) is the
bag of its byte 3-, 4- and 5-grams with boundary marks plus the whole token,
each hashed into one of ``BUCKETS`` embedding rows.  A token's vector is the
mean of its rows, a *window* of ``WINDOW`` neighbouring tokens (runs of one token
count once) the mean of its tokens, and a linear softmax over that mean gives the window's class.  A
document scores as its most toxic window, so a few words inside a very long
text are not averaged away and whole texts are used.  Embeddings and softmax
are trained jointly with Adam in numpy: first on random windows that carry
their document's label, then on each document's strongest window.  Misspelled
forms that were never seen share most n-gram rows with the known ones.

Training takes at most ``PER_CLASS`` labelled documents of each class (bounded,
deterministic by hash of the id).  For scoring, embedding rows are projected
on the softmax's class difference, so Spark tasks get one float per bucket
(``4 * BUCKETS`` bytes, a fixed size) and score slices of texts columnwise.

Defined results: a null text or one without tokens scores 0.0; rows with a null id are scored, ``held_out``
false; repeated rows are scored alike; without labels of both classes every
score is 0.0.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualis.llm import text as T
from qualis.llm.sample import labelled_texts, residue
from qualis.llm.session import settings

BITS = 18
BUCKETS = 1 << BITS
GRAMS = (3, 4, 5)
DIM = 8
WINDOW = 16
PER_CLASS = 1500
RATE, DAMP = 0.05, 1e-5  # Adam; the damping keeps rare buckets near plain gradient steps
MOD, HELD = 5, 0
THRESHOLD = 0.5

_BREAK = np.zeros(256, bool)
_BREAK[:128] = True
_BREAK[48:58] = _BREAK[65:91] = _BREAK[97:123] = False
_MAP = T.LOWER.copy()
_MAP[_BREAK] = 1


def _tokens(raw: np.ndarray, offsets: np.ndarray):
    """Text slice with a boundary byte around every document: (bytes, prefix
    hash, inverse powers, token starts, token ends, token offsets by document)."""
    n = len(offsets) - 1
    buf = np.ones(len(raw) + n + 1, np.uint8)
    buf[np.arange(len(raw)) + np.repeat(np.arange(1, n + 1), np.diff(offsets))] = _MAP[raw]
    inside = buf != 1
    starts = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    ends = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
    p, q = T.powers(len(buf) + 1)
    h = np.zeros(len(buf) + 1, T.U)
    np.cumsum((buf.astype(T.U) + T.U(1)) * p[:len(buf)], out=h[1:])
    bounds = offsets + np.arange(n + 1) + 1
    whole = (h[ends + 1] - h[starts - 1]) * q[starts - 1]
    keep = np.ones(len(starts), bool)  # a token that repeats the one before it counts once
    keep[1:] = whole[1:] != whole[:-1]
    first = np.searchsorted(starts, bounds[:-1])
    keep[first[first < len(starts)]] = True
    starts, ends = starts[keep], ends[keep]
    return buf, h, q, starts, ends, np.searchsorted(starts, bounds)


def _bucket(key: np.ndarray) -> np.ndarray:
    return ((key * T.U(0xD6E8FEB86659FD93)) >> T.U(64 - BITS)).astype(np.int64)


def token_grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket ids, their offsets by token, token offsets by text) of a slice of texts."""
    raw, off = T.utf8(pa.array(texts, pa.string()))
    _, h, q, s, e, tok = _tokens(raw, off)
    owner, ids = [np.arange(len(s))], [_bucket((h[e + 1] - h[s - 1]) * q[s - 1])]
    for n in GRAMS:
        count = np.maximum(0, e - s + 3 - n)
        at = T.ranges(s - 1, count)
        owner.append(np.repeat(np.arange(len(s)), count))
        ids.append(_bucket((h[at + n] - h[at]) * q[at] + T.U(n)))
    owner, ids = np.concatenate(owner), np.concatenate(ids)
    order = np.argsort(owner, kind="stable")
    return ids[order], np.searchsorted(owner[order], np.arange(len(s) + 1)), tok


def token_scores(raw: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean projected embedding of every token, and token offsets by document."""
    buf, h, q, s, e, tok = _tokens(raw, offsets)
    total = table[_bucket((h[e + 1] - h[s - 1]) * q[s - 1])].astype(np.float64)
    size = e - s
    parts = np.ones(len(s))
    for n in GRAMS:
        if len(buf) < n:
            continue
        m = len(buf) - n + 1
        value = table[_bucket((h[n:n + m] - h[:m]) * q[:m] + T.U(n))]
        acc = np.zeros(m + 1)
        np.cumsum(value, out=acc[1:])
        count = np.maximum(0, size + 3 - n)
        total += np.where(count > 0, acc[np.minimum(s - 1 + count, m)] - acc[np.minimum(s - 1, m)], 0.0)
        parts += count
    return total / parts, tok


def window_peaks(scores: np.ndarray, tok: np.ndarray, width: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Largest mean of ``width`` neighbouring tokens of each document (0 without
    tokens) and the first token of that window."""
    n = np.diff(tok)
    acc = np.concatenate([[0.0], np.cumsum(scores)])
    best, where = np.zeros(len(n)), tok[:-1].copy()
    short = (n > 0) & (n <= width)
    best[short] = (acc[tok[1:]] - acc[tok[:-1]])[short] / n[short]
    long = np.flatnonzero(n > width)
    if len(long):
        counts = n[long] - width + 1
        at = T.ranges(tok[:-1][long], counts)
        mean = (acc[at + width] - acc[at]) / width
        first = np.concatenate([[0], np.cumsum(counts)[:-1]])
        best[long] = np.maximum.reduceat(mean, first)
        hit = np.flatnonzero(mean == np.repeat(best[long], counts))
        where[long] = at[hit[np.searchsorted(hit, first)]]
    return best, where


def train(rows: list[tuple[str, int]], share: float | None = None, epochs: int = 14, seed: int = 7) -> dict | None:
    """Joint training; ``rows`` (text, label 0/1). None without both classes. ``share``:
    how many of all labels are 1; the score's scale is set for that, not for the sample."""
    rows = sorted(rows, key=lambda r: (r[1], zlib.crc32(r[0].encode())))
    y = np.array([r[1] for r in rows], dtype=np.float64)
    if not len(y) or y.min() == y.max():
        return None
    word, tok, ids, goff = _corpus([r[0] for r in rows])
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    soft = rng.normal(0, 0.3, (2, DIM)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    state = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in (("e", emb), ("w", soft), ("b", bias))}
    length = np.diff(tok)
    usable = np.flatnonzero(length > 0)
    weight = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    t = 0
    for epoch in range(epochs):
        def anywhere(k: int) -> tuple[np.ndarray, np.ndarray]:
            d = np.repeat(usable, k)
            return d, tok[d] + (rng.random(len(d)) * np.maximum(1, length[d] - WINDOW + 1)).astype(np.int64)
        if epoch < 5:
            d, at = anywhere(6)
        else:
            peak = window_peaks(_project(ids, goff, emb @ (soft[1] - soft[0]))[word], tok)[1]
            free, spot = anywhere(3)
            clean = y[free] == 0
            d, at = np.concatenate([usable, free[clean]]), np.concatenate([peak[usable], spot[clean]])
        order = rng.permutation(len(d))
        batch = min(1024, max(16, len(order) // 24))  # small samples take as many steps as large ones
        for lo in range(0, len(order), batch):
            t += 1
            k = order[lo:lo + batch]
            _step(d[k], at[k], y, weight, word, ids, goff, tok, emb, soft, bias, state, t)
    table = (emb @ (soft[1] - soft[0])).astype(np.float32)
    peak = window_peaks(_project(ids, goff, table)[word], tok)[0]
    share = min(max(share if share is not None else float(y.mean()), 1e-3), 1 - 1e-3)
    natural = np.where(y > 0, share / y.mean(), (1 - share) / (1 - y.mean()))
    scale, shift = _platt(peak, y, natural)
    return {"table": table, "scale": scale, "shift": shift}


def _corpus(texts: list[str]):
    """(vocabulary id of every token, token offsets by text, bucket ids and
    their offsets by vocabulary entry)."""
    keys, tok, known, ids, goff = [], [np.zeros(1, np.int64)], np.zeros(0, np.int64), [], [np.zeros(1, np.int64)]
    for lo in range(0, len(texts), 200):
        i, g, k = token_grams(texts[lo:lo + 200])
        key = np.add.reduceat(T.mix(i.astype(T.U)), g[:-1]).view(np.int64) if len(i) else np.zeros(0, np.int64)
        keys.append(key)
        tok.append(k[1:] + tok[-1][-1])
        new, first = np.unique(key, return_index=True)
        fresh = ~np.isin(new, known)
        known = np.concatenate([known, new[fresh]])
        first, size = first[fresh], np.diff(g)[first[fresh]]
        ids.append(i[T.ranges(g[first], size)].astype(np.int32))
        goff.append(np.cumsum(size) + goff[-1][-1])
    order = np.argsort(known)
    word = order[np.searchsorted(known[order], np.concatenate(keys))]
    return word, np.concatenate(tok), np.concatenate(ids), np.concatenate(goff)


def _project(ids: np.ndarray, goff: np.ndarray, table: np.ndarray) -> np.ndarray:
    out = np.empty(len(goff) - 1)
    for lo in range(0, len(out), 200_000):
        hi = min(len(out), lo + 200_000)
        o = goff[lo:hi + 1]
        out[lo:hi] = np.add.reduceat(table[ids[o[0]:o[-1]]].astype(np.float64), o[:-1] - o[0]) / np.diff(o)
    return out


def _step(docs, at, y, weight, word, ids, goff, tok, emb, soft, bias, state, t) -> None:
    n = np.minimum(WINDOW, tok[docs + 1] - at)
    token = word[T.ranges(at, n)]
    grams = goff[token + 1] - goff[token]
    flat = ids[T.ranges(goff[token], grams)]
    share = np.repeat(1.0 / grams / np.repeat(n, n), grams).astype(np.float32)
    row = np.repeat(np.repeat(np.arange(len(docs)), n), grams)
    cut = np.concatenate([[0], np.flatnonzero(np.diff(row)) + 1])
    mean = np.add.reduceat(emb[flat] * share[:, None], cut, axis=0)
    z = mean @ soft.T + bias
    z -= z.max(axis=1, keepdims=True)
    p = np.exp(z)
    p /= p.sum(axis=1, keepdims=True)
    p[np.arange(len(docs)), y[docs].astype(int)] -= 1
    p *= (weight[docs] / len(docs))[:, None]
    p = p.astype(np.float32)
    back = p @ soft
    ge = np.zeros_like(emb)
    contrib = back[row] * share[:, None]
    for c in range(DIM):
        ge[:, c] = np.bincount(flat, contrib[:, c], minlength=BUCKETS)
    for key, value, grad in (("e", emb, ge), ("w", soft, p.T @ mean), ("b", bias, p.sum(axis=0))):
        m, v = state[key]
        m *= 0.9
        m += 0.1 * grad
        v *= 0.99
        v += 0.01 * grad * grad
        value -= RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + DAMP)


def _platt(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Logistic fit y ~ sigmoid(scale * x + shift), slightly regularised."""
    mid, dev = float(x.mean()), float(x.std()) or 1.0
    z = np.stack([(x - mid) / dev, np.ones_like(x)], axis=1)
    w = np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (weight * (p - y)) + 1e-2 * w
        hess = (z * (weight * p * (1 - p))[:, None]).T @ z + np.eye(2) * 1e-2
        w -= np.linalg.solve(hess, grad)
    return float(w[0] / dev), float(w[1] - w[0] * mid / dev)


def predict(column, model: dict) -> np.ndarray:
    """Scores (0 to 1) of an Arrow string column."""
    raw, off = T.utf8(column)
    out = np.empty(len(off) - 1)
    for i, j in T.slices(off):
        s, tok = token_scores(raw[off[i]:off[j]], off[i:j + 1] - off[i], model["table"])
        score = 1 / (1 + np.exp(-np.clip(model["scale"] * window_peaks(s, tok)[0] + model["shift"], -500, 500)))
        out[i:j] = np.where(np.diff(tok) > 0, score, 0.0)
    return out


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> dict | None:
    share = labels.where(residue("doc_id", MOD) != HELD).agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    return train(labelled_texts(docs, labels, "toxic", MOD, HELD, per_class), share)


def score(docs: DataFrame, model: dict | None) -> DataFrame:
    """``docs`` with all its columns plus ``__score`` double (0 to 1)."""
    if model is None:
        return docs.withColumn("__score", F.lit(0.0))
    settings(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size: 4 * BUCKETS bytes
    at = docs.columns.index("text")

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(predict(b.column(at), shared.value))],
                                             [*b.schema.names, "__score"])

    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{fields}, __score double")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    docs = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
    scored = score(docs, fit(docs, labels))
    return scored.select("doc_id", (residue("doc_id", MOD) == HELD).alias("held_out"), F.col("__score").alias("score"),
                         (F.col("__score") >= THRESHOLD).cast("int").alias("predicted"))
