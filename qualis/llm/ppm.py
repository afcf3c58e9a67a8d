"""Operator 7: language identification by prediction by partial matching.

Per language a variable-order byte context tree of depth ``DEPTH`` is counted
once on a bounded sample and then frozen.  A byte s after context c costs
``-log2(n(c, s) / (N(c) + d(c)))`` bits where c was followed by s; otherwise it
pays the escape ``-log2(d(c) / (N(c) + d(c)))`` (d: distinct followers, method
C) and the context loses its first byte, down to 8 bits for a byte that the
language never showed.  A context the language never showed costs nothing.
The exact code length of a whole text (A-Z lowered, ``DEPTH`` zero bytes before
it) is the sum over its bytes; the shortest code wins, and the score is the
posterior ``2^-len`` under equal priors.

The trees of all languages are flattened into one hash table per window
length: key = window bytes, value = bits and escape bits per language with all
escapes already followed.  Scoring is one table probe per byte, vectorised; only
windows that no language showed go on to shorter windows.

The sample has at most ``PER_LANG`` whole texts of each language, so what is
sent to the tasks is bounded by it.  Defined results: null text or a text
without a letter: ``und``, score 0; no rows to learn from: ``und`` everywhere;
equal code lengths: the first language in order; null ids: ``held_out`` false.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualis.llm import text as T
from qualis.llm.sample import residue, texts_of, top_by_hash
from qualis.llm.session import cut, settings

DEPTH = 4
PER_LANG = 300
MOD, HELD = 5, 0
UNKNOWN = "und"


def windows(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed window of DEPTH + 1 bytes that ends at every byte of every text
    (last byte lowest), with zero bytes before each text; and its offsets."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    buf = np.zeros(len(raw) + DEPTH * n, np.uint8)
    at = np.arange(len(raw)) + np.repeat(DEPTH * np.arange(1, n + 1), size)
    buf[at] = T.LOWER[raw]
    key = np.zeros(len(buf), T.U)
    for k in range(DEPTH + 1):
        key[k:] |= buf[:len(buf) - k].astype(T.U) << T.U(8 * k)
    return key[at], offsets


class Table:
    """Open-addressing hash table from packed windows to rows of numbers."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 4))))
        self.keys = np.full(1 << self.bits, 0xFFFFFFFFFFFFFFFF, T.U)
        self.row = np.zeros(1 << self.bits, np.int32)
        self.values = np.concatenate([values, np.zeros((1, values.shape[1]))]).astype(np.float32)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            empty = self.keys[slot[left]] == T.U(0xFFFFFFFFFFFFFFFF)
            spot, first = np.unique(slot[left[empty]], return_index=True)
            put = left[empty][first]
            self.keys[spot], self.row[spot] = keys[put], put
            left = np.setdiff1d(left, put, assume_unique=True)
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * T.U(0x9E3779B97F4A7C15)) >> T.U(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key; the row past the last (all zeros) if it is not there."""
        slot = self._slot(keys)
        got = self.keys[slot]
        out = np.where(got == keys, self.row[slot], len(self.values) - 1)
        open_ = np.flatnonzero((got != keys) & (got != T.U(0xFFFFFFFFFFFFFFFF)))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            got = self.keys[slot[open_]]
            hit = got == keys[open_]
            out[open_[hit]] = self.row[slot[open_[hit]]]
            open_ = open_[~hit & (got != T.U(0xFFFFFFFFFFFFFFFF))]
        return out


def train(texts: dict[str, list[str]]) -> dict | None:
    """Frozen trees of the languages in ``texts``, flattened (see module text)."""
    langs = sorted(k for k, v in texts.items() if any(v))
    if not langs:
        return None
    full = [windows(*T.utf8(pa.array(texts[k], pa.string())))[0] for k in langs]
    tables, below = [None], None
    for length in range(1, DEPTH + 2):
        mask = T.U((1 << 8 * length) - 1)
        seen = [np.unique(w & mask, return_counts=True) for w in full]
        keys = np.unique(np.concatenate([np.zeros(1, T.U), *(k for k, _ in seen)]))  # 0: the context of a first byte
        bits = np.empty((len(keys), len(langs)))
        for lang, (own, count) in enumerate(seen):
            # followers of each context: windows are sorted, so contexts are runs
            ctx, start = np.unique(own >> T.U(8), return_index=True)
            total, kinds = np.add.reduceat(count, start), np.diff(np.append(start, len(own)))
            whole = (total + kinds).astype(float)
            at = np.searchsorted(ctx, keys >> T.U(8))
            has = (at < len(ctx)) & (ctx[np.minimum(at, len(ctx) - 1)] == keys >> T.U(8))
            at = np.minimum(at, len(ctx) - 1)
            escape = np.where(has, -np.log2(kinds[at] / whole[at]), 0.0)
            if length == 1:
                lower = np.full(len(keys), 8.0)
            else:
                lower = below[1][np.searchsorted(below[0], keys & T.U((1 << 8 * (length - 1)) - 1)), lang]
            pos = np.minimum(np.searchsorted(own, keys), len(own) - 1)
            there = own[pos] == keys
            bits[:, lang] = np.where(there, -np.log2(count[pos] / whole[at]), escape + lower)
            if length > 1:  # escape bits belong to the context's own entry, one length lower
                spot = np.searchsorted(below[0], ctx)
                ok = (spot < len(below[0])) & (below[0][np.minimum(spot, len(below[0]) - 1)] == ctx)
                below[2][spot[ok], lang] = -np.log2(kinds[ok] / whole[ok])
            else:
                below_root = np.zeros(len(langs)) if lang == 0 else below_root
                below_root[lang] = -np.log2(kinds[0] / whole[0])
        if below is not None:
            tables.append(Table(below[0], np.concatenate([below[1], below[2]], axis=1)))
        below = (keys, bits, np.zeros_like(bits))
    tables.append(Table(below[0], np.concatenate([below[1], below[2]], axis=1)))
    return {"langs": langs, "tables": tables, "root": below_root}


def code_lengths(raw: np.ndarray, offsets: np.ndarray, model: dict) -> np.ndarray:
    """Bits of every text under every language (texts x languages)."""
    n = len(model["langs"])
    out = np.zeros((len(offsets) - 1, n))
    for i, j in T.slices(offsets):
        key, off = windows(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
        top = model["tables"][DEPTH + 1]
        row = top.find(key)
        bits = top.values[row, :n]
        miss = np.flatnonzero(row == len(top.values) - 1)
        bits[miss] = _shorter(key[miss], DEPTH, model, n)
        for lang in range(n):
            out[i:j, lang] = T.row_sums(bits[:, lang].astype(np.float64), off)
    return out


def _shorter(key: np.ndarray, length: int, model: dict, n: int) -> np.ndarray:
    """Bits of windows of ``length + 1`` bytes that no language showed."""
    if not len(key):
        return np.zeros((0, n), np.float32)
    if not length:
        return np.tile((model["root"] + 8).astype(np.float32), (len(key), 1))
    table, mask = model["tables"][length], T.U((1 << 8 * length) - 1)
    escape = table.values[table.find((key >> T.U(8)) & mask), n:]
    row = table.find(key & mask)
    bits = table.values[row, :n]
    miss = np.flatnonzero(row == len(table.values) - 1)
    bits[miss] = _shorter(key[miss], length - 1, model, n)
    return bits + escape


def has_letter(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    fold = raw | 32
    out = T.row_sums(((fold >= 97) & (fold <= 122)).astype(np.int64), offsets) > 0
    for i in np.flatnonzero(~out).tolist():
        out[i] = any(map(str.isalpha, bytes(raw[offsets[i]:offsets[i + 1]]).decode("utf-8", "replace")))
    return out


def predict(column, model: dict | None) -> tuple[list[str], np.ndarray]:
    raw, off = T.utf8(column)
    if model is None:
        return [UNKNOWN] * (len(off) - 1), np.zeros(len(off) - 1)
    bits = code_lengths(raw, off, model)
    best = bits.argmin(axis=1)
    score = 1 / np.exp2(-(bits - bits.min(axis=1, keepdims=True))).sum(axis=1)
    known = has_letter(raw, off)
    return [model["langs"][b] if k else UNKNOWN for b, k in zip(best, known, strict=True)], np.where(known, score, 0.0)


def fit(docs: DataFrame, per_lang: int = PER_LANG) -> dict | None:
    """Learn from rows with text and lang outside the held-out residue."""
    rows = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull()) \
        .where(residue("doc_id", MOD) != HELD)
    ids = cut(top_by_hash(rows, "lang", per_lang))  # languages * per_lang narrow rows
    texts: dict[str, list[str]] = {}
    for r in texts_of(rows, ids, ["doc_id", "lang"]):
        texts.setdefault(r["lang"], []).append(r["text"])
    return train(texts)


def label(docs: DataFrame, model: dict | None) -> DataFrame:
    """``docs`` with all its columns plus ``__lang`` string and ``__score`` double."""
    settings(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches):
        for b in batches:
            lang, score = predict(b.column(at), shared.value)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(lang, pa.string()), pa.array(score)],
                                             [*b.schema.names, "__lang", "__score"])

    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{fields}, __lang string, __score double")


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs``."""
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    return label(docs.select("doc_id", "text"), fit(docs)).select(
        "doc_id", (residue("doc_id", MOD) == HELD).alias("held_out"),
        F.col("__lang").alias("lang_pred"), F.col("__score").alias("score"))
