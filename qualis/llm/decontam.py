"""Operator 4: benchmark decontamination by rare n-gram seeds and Smith-Waterman.

Words are runs of ASCII letters, digits and bytes >= 0x80, A-Z lowered, so
punctuation and case do not matter.  Every ``SEED``-word n-gram of a test item
is a seed, however frequent: an edited or shortened copy that recurs in many
documents has nothing but frequent seeds.  The seeds are joined to the passages
of every document: hits of one item on nearby diagonals make one passage, which
is aligned to the whole item with Smith-Waterman over words (match 2, mismatch
-1, gap -1).  The score is the best local alignment divided by that of an
unchanged copy; paraphrased or edited copies keep a high score, a chance seed
does not.  Passages that share too few words with the item (counted with
repeats) to reach the threshold are not aligned; this bound loses nothing.

One seed alone is half of an item of up to ``SEED / threshold`` words (6).  Only
for such items the documents of each seed are counted first: a seed that is
``COMMON`` times more frequent than the rarest of its item (and in over
``COMMON`` documents) is ordinary speech, and a passage with no other seeds must
align better than one seed does.

Seeds and items are sent to the tasks in parts of at most ``PART_WORDS`` item
words (checked); a larger benchmark takes several passes over the documents.
Seed hits are worked on in slices of about ``HITS``.  Documents are never
shuffled, and the only rows that leave a task are its seed counts (at most one
per seed) and its links.

Defined results: null or empty texts on either side, and items of fewer than
``MIN_WORDS`` words, match nothing; a repeated row on either side gives its own
link; rows are (doc_id, item_id) as given, nulls included.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualis.llm import text as T
from qualis.llm.session import cut, settings

SEED = 3
MIN_WORDS = 5
COMMON = 20
MATCH, MISS, GAP = 2, -1, -1
THRESHOLD = 0.5
PART_WORDS = 2_000_000
HITS = 1 << 19  # seed hits and words of passages that are held at once
_CELLS = 1 << 20

_BREAK = np.zeros(256, bool)
_BREAK[:128] = True
_BREAK[48:58] = _BREAK[65:91] = _BREAK[97:123] = False


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    parts, counts = [], np.zeros(len(offsets) - 1, np.int64)
    for i, j in T.slices(offsets):
        piece, o = raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        s, e = T.spans(piece, o, _BREAK)
        parts.append(T.span_hash(piece, s, e, T.LOWER))
        counts[i:j] = np.diff(np.searchsorted(s, o))
    return (np.concatenate(parts) if parts else np.zeros(0, T.U)), np.concatenate([[0], np.cumsum(counts)])


def grams(w: np.ndarray, off: np.ndarray, n: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram hash, position of its first word) of all n-grams inside one text."""
    if len(w) < n:
        return np.zeros(0, T.U), np.zeros(0, np.int64)
    at = T.ranges(off[:-1], np.maximum(0, np.diff(off) - n + 1))
    key = np.zeros(len(at), T.U)
    for k in range(n):
        key = T.mix(key ^ w[at + k], k + 50)
    return key, at


class Items:
    """Seeds of a part of the benchmark: sorted keys with their places."""

    def __init__(self, ids: list, column):
        w, off = words(*T.utf8(column))
        self.ids, self.words, self.off = ids, w, off
        key, at = grams(w, off)
        item = np.searchsorted(off, at, "right") - 1
        ok = np.diff(off)[item] >= MIN_WORDS
        key, at, item = key[ok], at[ok], item[ok]
        order = np.argsort(key, kind="stable")
        self.key, self.item, self.place = key[order], item[order], (at - off[item])[order]
        self.common = np.zeros(len(key), bool)
        # words of each item with their number
        self.vocabulary, code = np.unique(w, return_inverse=True)
        owner = np.repeat(np.arange(len(off) - 1), np.diff(off))
        self.bag, self.often = np.unique(owner * len(self.vocabulary) + code, return_counts=True)

    def short(self, threshold: float) -> np.ndarray:
        """Places of the seeds that alone carry their item over the threshold."""
        return np.flatnonzero(threshold * np.diff(self.off)[self.item] <= SEED)

    def mark_common(self, at: np.ndarray, frequency: dict[int, int]) -> None:
        """Mark the seeds at the places ``at`` that are frequent beside the rarest of their item."""
        df = np.array([frequency.get(k, 0) for k in self.key[at].view(np.int64).tolist()], np.int64)
        low = np.full(len(self.ids), np.iinfo(np.int64).max // COMMON)
        np.minimum.at(low, self.item[at], df)
        self.common[at] = df > np.maximum(COMMON, COMMON * low[self.item[at]])


def probe(keys: np.ndarray, sorted_keys: np.ndarray, sieve: np.ndarray) -> np.ndarray:
    """Positions of ``keys`` that are in ``sorted_keys``; ``sieve`` (64k flags) rules out most."""
    maybe = np.flatnonzero(sieve[(keys >> T.U(44)).astype(np.int64)])
    at = np.minimum(np.searchsorted(sorted_keys, keys[maybe]), len(sorted_keys) - 1)
    return maybe[sorted_keys[at] == keys[maybe]]


def sieve_of(keys: np.ndarray) -> np.ndarray:
    flags = np.zeros(1 << 20, bool)
    flags[(keys >> T.U(44)).astype(np.int64)] = True
    return flags


def align(a: np.ndarray, a_off: np.ndarray, b: np.ndarray, b_off: np.ndarray) -> np.ndarray:
    """Best Smith-Waterman score of each pair of ragged word rows a[i], b[i]."""
    la, lb = np.diff(a_off), np.diff(b_off)
    best = np.zeros(len(la), np.int32)
    order = np.lexsort((la, lb))
    lo = 0
    while lo < len(order):
        hi = min(len(order), lo + max(1, _CELLS // (int(lb[order[lo]]) + 64)))
        while hi > lo + 1 and (hi - lo) * int(lb[order[hi - 1]]) > 2 * _CELLS:
            hi = lo + max(1, (hi - lo) // 2)
        k = order[lo:hi]
        x = _pad(a, a_off[k], la[k], 0)
        y = _pad(b, b_off[k], lb[k], 1)
        drift = np.arange(y.shape[1], dtype=np.int32) * GAP
        h = np.zeros((len(k), y.shape[1] + 1), np.int32)
        top = np.zeros(len(k), np.int32)
        for i in range(x.shape[1]):
            step = np.where(x[:, i, None] == y, MATCH, MISS)
            row = np.maximum(np.maximum(h[:, :-1] + step, h[:, 1:] + GAP), 0)
            row = np.maximum.accumulate(row - drift, axis=1) + drift
            h[:, 1:] = np.maximum(row, 0)
            top = np.maximum(top, h.max(axis=1))
        best[k] = top
        lo = hi
    return best


def _pad(v: np.ndarray, starts: np.ndarray, sizes: np.ndarray, filler: int) -> np.ndarray:
    out = np.full((len(starts), int(sizes.max(initial=1))), filler, T.U)
    rows = np.repeat(np.arange(len(starts)), sizes)
    out[rows, T.ranges(np.zeros(len(starts), np.int64), sizes)] = v[T.ranges(starts, sizes)] | T.U(2)
    return out


def shared_words(code: np.ndarray, lo: np.ndarray, hi: np.ndarray, item: np.ndarray, items: Items) -> np.ndarray:
    """Words (with repeats) that each window lo..hi of a text shares with its item."""
    total = len(items.vocabulary)
    window = np.repeat(np.arange(len(lo)), hi - lo)
    word = code[T.ranges(lo, hi - lo)]
    known = word >= 0
    pair, n = np.unique(window[known] * total + word[known], return_counts=True)
    window, word = np.divmod(pair, total)
    want = item[window] * total + word
    at = np.minimum(np.searchsorted(items.bag, want), len(items.bag) - 1)
    both = np.where(items.bag[at] == want, np.minimum(n, items.often[at]), 0)
    return np.bincount(window, both, len(lo)).astype(np.int64)


def passages(column, items: Items, threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, item, score, seed hits) of the passages of a text column that reach the threshold."""
    out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))]
    w, off = words(*T.utf8(column))
    key, at = grams(w, off)
    if len(items.key) and len(key):
        hit = probe(key, items.key, sieve_of(items.key))
        at = at[hit]
        first = np.searchsorted(items.key, key[hit])
        edge = np.concatenate([[0], np.cumsum(np.searchsorted(items.key, key[hit], "right") - first)])
        rows = np.searchsorted(at, off)  # hits of each document
        code = np.full(len(w), -1, np.int64)
        place = np.minimum(np.searchsorted(items.vocabulary, w), len(items.vocabulary) - 1)
        known = items.vocabulary[place] == w
        code[known] = place[known]
        for i, j in T.slices(edge[rows], HITS):
            lo, hi = rows[i], rows[j]
            split = int((edge[hi] - edge[lo]) // HITS) + 1  # one document of very many hits: its items in turn
            for k in range(split):
                seeds, places = [], []
                for a, b in T.slices(edge[lo:hi + 1], HITS):
                    n = np.diff(edge[lo + a:lo + b + 1])
                    seed, pos = T.ranges(first[lo + a:lo + b], n), np.repeat(at[lo + a:lo + b], n)
                    if split > 1:
                        mine = items.item[seed] % split == k
                        seed, pos = seed[mine], pos[mine]
                    seeds.append(seed)
                    places.append(pos)
                if sum(map(len, seeds)):
                    out.append(_aligned(w, off, code, np.concatenate(seeds), np.concatenate(places), items, threshold))
    return tuple(np.concatenate(c) for c in zip(*out))


def _aligned(w, off, code, seed, pos, items: Items, threshold: float):
    """``passages`` of seed hits: seeds and the positions of their first words."""
    doc, item = np.searchsorted(off, pos, "right") - 1, items.item[seed]
    diag = pos - items.place[seed]
    order = np.lexsort((diag, item, doc))
    doc, item, diag, rare = doc[order], item[order], diag[order], ~items.common[seed[order]]
    size = np.diff(items.off)[item]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (diag[1:] - diag[:-1] > size[1:] // 2 + 4)
    start = np.flatnonzero(new)
    last = np.append(start[1:], len(doc)) - 1
    hits = last - start + 1
    rare = np.logical_or.reduceat(rare, start)
    doc, item, size = doc[start], item[start], size[start]
    slack = 4 + size // 4
    lo = np.maximum(off[doc], diag[start] - slack)
    hi = np.minimum(off[doc + 1], diag[last] + size + slack)
    best = np.zeros(len(doc), np.int64)
    edge = np.concatenate([[0], np.cumsum(hi - lo)])
    for i, j in T.slices(edge, HITS):
        k = np.arange(i, j)
        k = k[shared_words(code, lo[k], hi[k], item[k], items) >= threshold * size[k] - 1e-9]
        best[k] = align(items.words[T.ranges(items.off[item[k]], size[k])], np.concatenate([[0], np.cumsum(size[k])]),
                        w[T.ranges(lo[k], (hi - lo)[k])], np.concatenate([[0], np.cumsum((hi - lo)[k])]))
    score = best / (MATCH * size)
    keep = np.flatnonzero((score >= threshold) & (rare | (best > MATCH * SEED)))
    return doc[keep], item[keep], score[keep], hits[keep]


def _parts(items: DataFrame):
    """The benchmark in parts of at most PART_WORDS words (collected one at a time)."""
    items = items.select(F.col("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = int(total // (2 * PART_WORDS)) + 1  # a word and its gap take two characters at least
    for k in range(n):
        rows = items.where(F.pmod(F.xxhash64("text"), F.lit(n)) == k).orderBy("item_id", "text").collect()
        if rows:
            yield Items([r["item_id"] for r in rows], pa.array([r["text"] for r in rows], pa.string()))


def links(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, score, seeds): documents that hold a copy of a test item."""
    spark = docs.sparkSession
    settings(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .where("text is not null")
    schema = "doc_id long, item_id long, score double, seeds long"
    out = spark.createDataFrame([], schema)
    for part in _parts(items):
        short = part.short(threshold)
        keys = spark.sparkContext.broadcast(np.unique(part.key[short]))

        def count(batches, keys=keys):
            known, total = keys.value, np.zeros(len(keys.value), np.int64)
            sieve = sieve_of(known)
            for b in batches:
                w, off = words(*T.utf8(b.column(0)))
                key, at = grams(w, off)
                if not len(key):
                    continue
                hit = probe(key, known, sieve)
                doc = np.searchsorted(off, at[hit], "right") - 1
                seen = np.unique(doc * len(known) + np.searchsorted(known, key[hit])) % len(known)
                total += np.bincount(seen, minlength=len(known))
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(known[some].view(np.int64)), pa.array(total[some])], ["seed", "n"])

        if len(short):
            df = docs.select("text").mapInArrow(count, "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n"))
            part.mark_common(short, {r["seed"]: r["n"] for r in df.collect()})  # one row per seed of the part at most
        shared = spark.sparkContext.broadcast(part)

        def match(batches, shared=shared):
            own = shared.value
            ids = pa.array(own.ids, pa.int64())
            for b in batches:
                doc, item, score, seeds = passages(b.column(1), own, threshold)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(doc)), ids.take(pa.array(item)), pa.array(score), pa.array(seeds)],
                    ["doc_id", "item_id", "score", "seeds"])

        out = out.union(docs.mapInArrow(match, schema))
    return out


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a copy of a test item (all columns
    kept; rows with a null id are judged by their exact text)."""
    hits = cut(links(docs.where("doc_id is not null"), items).select("doc_id").distinct())
    clean = docs.where("doc_id is not null").join(hits, "doc_id", "left_anti").select(*docs.columns)
    loose = docs.where("doc_id is null")
    tagged = loose.select(F.xxhash64("text").alias("doc_id"), "text")
    bad = links(tagged, items).select(F.col("doc_id").alias("_h")).distinct()
    return clean.unionByName(loose.join(bad, F.xxhash64(loose["text"]) == bad["_h"], "left_anti"))
