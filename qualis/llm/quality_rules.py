"""Operator 1: quality rules by distribution divergence.

Base rules count words, symbols, repeated lines and repeated 5-word windows.
The method then compares two histograms of every text with references of each
language by Jensen-Shannon distance (base 2, 0 to 1): character classes, and
the language's ``COMMON`` most frequent words plus one bin for all others
(words A-Z lowered).  A document is held against the language whose word
histogram is nearest, so no label is needed to judge it; it fails if either
distance is over its limit.  Texts of fewer than ``MIN_WORDS`` words have no
steady histogram: the guard passes them (base rules still hold).  A language
with fewer than ``MIN_REFERENCE`` words in all is no reference.

References come from all rows with a language: every task counts its words per
language in numpy and passes on one row per distinct word; Spark sums them and
keeps the top words.  What is collected is ``languages * (COMMON + classes)``
numbers.  Equally frequent words: the smaller word first.

Defined results: null or empty texts have no word, base_failed true, kept
false; rows with a null doc_id or lang are judged like others; without any
reference the base verdict stands; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from qualis.llm import text as T
from qualis.llm.session import cut, settings

COMMON = 40
MIN_WORDS = 40
MIN_REFERENCE = 2000
MAX_CLASS_DISTANCE = 0.28
MAX_WORD_DISTANCE = 0.45
WINDOW = 5

# Character classes by first byte of the character: lower, upper, digit, space,
# symbol, other ASCII punctuation and controls, U+0080 and above.
CLASSES = ("lower", "upper", "digit", "space", "symbol", "punctuation", "wide")
_CLASS = np.full(256, 5, np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[T.SPACE] = 0, 1, 2, 3
_CLASS[[ord(c) for c in "#*$%&|<>"]] = 4
_CLASS[128:] = 6
_CONT = np.zeros(256, bool)
_CONT[0x80:0xC0] = True  # continuation bytes are no characters of their own
_NEWLINE = np.zeros(256, bool)
_NEWLINE[10] = True


def class_counts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Characters of each class (texts x classes)."""
    out = np.zeros((len(offsets) - 1, len(CLASSES)), np.int64)
    for i, j in T.slices(offsets):
        piece, off = raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        real = ~_CONT[piece]
        at = T.owners(off)[real] * len(CLASSES) + _CLASS[piece[real]]
        out[i:j] = np.bincount(at, minlength=(j - i) * len(CLASSES)).reshape(j - i, -1)
    return out


def duplicate_lines(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Lines with a word that equal an earlier line of the text."""
    out = np.zeros(len(offsets) - 1, np.int64)
    for i, j in T.slices(offsets):
        piece, off = raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        s, e = T.spans(piece, off, _NEWLINE)
        filled = np.concatenate([[0], np.cumsum(~T.SPACE[piece])])
        ok = filled[e] > filled[s]
        s, e = s[ok], e[ok]
        rows = np.searchsorted(s, off)
        _, kept = T.distinct(T.span_hash(piece, s, e), rows)
        out[i:j] = np.diff(rows) - np.diff(kept)
    return out


def repeated_words(words: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Words inside 5-word windows that occur twice or more in their text."""
    n = np.diff(offsets)
    out = np.zeros(len(n), np.int64)
    many = np.flatnonzero(n >= WINDOW)
    if not len(many):
        return out
    win, off = T.shingles(words, offsets, WINDOW)
    unique = np.diff(T.distinct(win, off)[1])
    for d in many[unique[many] < n[many] - WINDOW + 1].tolist():
        _, back, count = np.unique(win[off[d]:off[d + 1]], return_inverse=True, return_counts=True)
        mark = np.zeros(n[d] + 1, np.int64)
        again = np.flatnonzero(count[back] > 1)
        np.add.at(mark, again, 1)
        np.add.at(mark, again + WINDOW, -1)
        out[d] = np.count_nonzero(np.cumsum(mark[:-1]))
    return out


def base(column) -> dict[str, np.ndarray]:
    raw, off = T.utf8(column)
    words, at = T.word_hashes(raw, off, T.PLAIN)
    classes = class_counts(raw, off)
    n, repeated = np.diff(at), repeated_words(words, at)
    return {"n_words": n, "word_chars": classes.sum(axis=1) - classes[:, 3], "n_symbols": classes[:, 4],
            "n_dup_lines": duplicate_lines(raw, off), "n_repeat_words": repeated,
            "base_failed": (n < 10) | (100 * repeated > 20 * n), "classes": classes}


def jensen_shannon(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Distance of histogram rows ``p`` to the distribution ``q``."""
    p = p / np.maximum(p.sum(axis=1, keepdims=True), 1)
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0).sum(axis=1)
        right = np.where(q > 0, q * np.log2(q / m), 0).sum(axis=1)
    return np.sqrt(np.clip((left + right) / 2, 0, 1))


def _count(batches):
    """Word and class counts per language of one task: (lang, kind, word, n)."""
    words: dict[str, dict[bytes, int]] = {}
    classes: dict[str, np.ndarray] = {}
    for b in batches:
        langs = np.array(b.column(1).to_pylist(), object)
        for lang in sorted(set(langs.tolist())):
            raw, off = T.utf8(b.column(0).filter(pa.array(langs == lang)))
            classes[lang] = classes.get(lang, 0) + class_counts(raw, off).sum(axis=0)
            own = words.setdefault(lang, {})
            for i, j in T.slices(off):
                piece, o = raw[off[i]:off[j]], off[i:j + 1] - off[i]
                s, e = T.spans(piece, o)
                key, first, n = np.unique(T.span_hash(piece, s, e, T.LOWER), return_index=True, return_counts=True)
                text = bytes(T.LOWER[piece])
                for a, z, k in zip(s[first].tolist(), e[first].tolist(), n.tolist(), strict=True):
                    w = text[a:z]
                    own[w] = own.get(w, 0) + k
    for lang, own in words.items():
        items = [(k.decode(), v) for k, v in own.items()]
        items += [(name, int(v)) for name, v in zip(CLASSES, classes[lang], strict=True)]
        kind = [0] * len(own) + [1] * len(CLASSES)
        for lo in range(0, len(items), 50_000):
            part = items[lo:lo + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(part)), pa.array(kind[lo:lo + 50_000], pa.int32()),
                 pa.array([w for w, _ in part]), pa.array([n for _, n in part], pa.int64())],
                ["lang", "kind", "word", "n"])


def references(docs: DataFrame) -> list[dict]:
    """Per language: common words with their shares, the share of all others, class shares."""
    rows = docs.where("text is not null and lang is not null").select("text", "lang")
    counts = cut(rows.mapInArrow(_count, "lang string, kind int, word string, n long")
                 .groupBy("lang", "kind", "word").agg(F.sum("n").alias("n")))
    total = counts.where("kind = 0").groupBy("lang").agg(F.sum("n").alias("total")).where(f"total >= {MIN_REFERENCE}")
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    top = counts.where("kind = 0").withColumn("k", F.row_number().over(order)).where(f"k <= {COMMON}")
    classes = {(r["lang"], r["word"]): r["n"] for r in counts.where("kind = 1").collect()}
    out: dict[str, dict] = {r["lang"]: {"lang": r["lang"], "total": r["total"], "words": {}} for r in total.collect()}
    for r in top.collect():
        if r["lang"] in out:
            out[r["lang"]]["words"][r["word"]] = r["n"] / out[r["lang"]]["total"]
    for lang, ref in out.items():
        n = np.array([classes.get((lang, c), 0) for c in CLASSES], float)
        ref["classes"] = n / n.sum()
    return [out[k] for k in sorted(out)]


class Judge:
    """References as arrays; ``distances`` of a text column to the nearest language."""

    def __init__(self, refs: list[dict]):
        vocab = sorted({w for r in refs for w in r["words"]})
        raw, off = T.utf8(pa.array(vocab, pa.string()))
        key = T.span_hash(raw, off[:-1], off[1:], T.LOWER)
        self.key, self.id = key[np.argsort(key)], np.argsort(key)
        place = {w: i for i, w in enumerate(vocab)}
        self.refs = [(np.array([place[w] for w in r["words"]]), np.array([*r["words"].values()]), r["classes"]) for r in refs]

    def distances(self, column, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw, off = T.utf8(column)
        n, size = len(off) - 1, max(1, len(self.key))
        if not self.refs:
            return np.zeros(n), np.zeros(n)
        words, at = T.word_hashes(raw, off)
        pos = np.minimum(np.searchsorted(self.key, words), size - 1)
        hit = self.key[pos] == words
        counts = np.bincount(T.owners(at)[hit] * size + self.id[pos[hit]], minlength=n * size).reshape(n, size)
        both = []
        for ids, share, ref in self.refs:
            own = counts[:, ids]
            hist = np.column_stack([own, np.diff(at) - own.sum(axis=1)])
            both.append((jensen_shannon(hist, np.append(share, 1 - share.sum())), jensen_shannon(classes, ref)))
        word = np.stack([w for w, _ in both])
        best = word.argmin(axis=0)
        return word[best, np.arange(n)], np.stack([c for _, c in both])[best, np.arange(n)]


def assess(docs: DataFrame) -> DataFrame:
    """doc_id, base counts, base_failed, word_distance, class_distance, kept for every row."""
    spark = docs.sparkSession
    settings(spark)
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    judge = spark.sparkContext.broadcast(Judge(references(docs)))

    def run(batches):
        for b in batches:
            got = base(b.column(1))
            word, cls = judge.value.distances(b.column(1), got.pop("classes"))
            apart = (got["n_words"] >= MIN_WORDS) & ((word > MAX_WORD_DISTANCE) | (cls > MAX_CLASS_DISTANCE))
            got |= {"word_distance": word, "class_distance": cls, "kept": ~got["base_failed"] & ~apart}
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(v) for v in got.values())], ["doc_id", *got])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
             "base_failed boolean, word_distance double, class_distance double, kept boolean")
