"""Operator 6: packing by power-of-two decomposition.

A document of n tokens (its ids and the end id) is cut along the binary digits
of n: pieces of ``MAX`` tokens, then one piece for each set bit of the rest,
largest first.  Every piece is a sequence of its own; sequences of one length
form a bucket, so batches are made of equal lengths, no sequence crosses
documents, and nothing is ever padded.  The plan is one pass without a shuffle.

Tokenization keeps the public tokenizer's result but does its work once per
distinct unit.  A word of ASCII letters, digits, plain punctuation and the
letters U+00C0-U+00FF falls apart into letter runs, single digits and
punctuation runs exactly where the tokenizer's own pattern cuts; any other word
(apostrophes, control characters, other alphabets, ``<|``) is one unit.  Units
never cross white space, where this tokenizer cuts as well.  Each Python worker
keeps the ids of up to ``CACHE`` units by 64-bit hash in arrays; units that are
not there go to the tokenizer.

Defined results: a null or empty text is the end id alone (one piece of length
1); rows that repeat are packed each; a null doc_id is carried.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualis.llm import text as T
from qualis.llm.session import settings

MAX = 2048
END = 1
CACHE = 3_000_000
TOKENIZER = "word_bpe_49k.json"

# Byte classes: 0 white space, 1 letter, 2 digit, 3 punctuation, 4 second byte of U+00C0-U+00FF, 5 opaque
_KIND = np.full(256, 5, np.uint8)
_KIND[T.SPACE] = 0
_KIND[65:91] = _KIND[97:123] = 1
_KIND[48:58] = 2
_KIND[33:48] = _KIND[58:65] = _KIND[91:97] = _KIND[123:127] = 3
_KIND[39] = 5  # apostrophe: contractions


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER)


def units(raw: np.ndarray, offsets: np.ndarray):
    """(lower-cased bytes, unit starts, unit ends, unit is simple) of a slice of texts."""
    low = T.LOWER[raw]
    kind = _KIND[raw]
    lead = np.flatnonzero(raw[:-1] == 0xC3) if len(raw) > 1 else np.zeros(0, np.int64)
    second = raw[lead + 1]
    ok = (second >= 0x80) & (second < 0xC0) & (second != 0x97) & (second != 0xB7)
    lead, second = lead[ok], second[ok]
    kind[lead] = kind[lead + 1] = 1
    low[lead + 1] = np.where(second < 0x9F, second + 32, second)
    bad = kind == 5
    pair = np.flatnonzero((raw[:-1] == 60) & (raw[1:] == 124)) if len(raw) > 1 else np.zeros(0, np.int64)
    bad[pair] = True
    s, e = T.spans(raw, offsets)
    acc = np.concatenate([[0], np.cumsum(bad)])
    opaque = acc[e] > acc[s]
    inner = np.zeros(len(raw), bool)  # a unit starts here
    if len(raw):
        inner[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
    mark = np.zeros(len(raw) + 1, np.int32)
    mark[s[opaque]] += 1
    mark[e[opaque]] -= 1
    inside = np.cumsum(mark[:-1]) > 0
    inner[inside] = False
    inner[s] = True
    inner[T.SPACE[raw]] = False
    starts = np.flatnonzero(inner)
    # a unit ends where its word ends or the next unit starts
    word = np.searchsorted(s, starts, "right") - 1
    ends = np.minimum(e[word], np.append(starts[1:], len(raw)))
    return low, starts, ends, ~opaque[word]


class Ids:
    """Token ids of units by hash: open addressing over flat arrays, bounded."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tool = Tokenizer.from_file(path)
        vocab = self.tool.get_vocab()
        self.last = np.zeros(max(vocab.values()) + 1, bool)
        self.last[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.clear(1 << 16)

    def clear(self, size: int) -> None:
        self.keys, self.at = np.zeros(size, T.U), np.zeros(size, np.int64)
        self.flat, self.off = np.zeros(1 << 16, np.uint16), np.zeros(1 << 15, np.int64)
        self.count, self.used = 0, 0

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Entry of each key, -1 if it is not there (key 0 is never used)."""
        mask = len(self.keys) - 1
        slot = (keys >> T.U(20)).astype(np.int64) & mask
        got = self.keys[slot]
        out = np.where(got == keys, self.at[slot], -1)
        go = np.flatnonzero((got != keys) & (got != 0))
        while len(go):
            slot[go] = (slot[go] + 1) & mask
            got = self.keys[slot[go]]
            hit = got == keys[go]
            out[go[hit]] = self.at[slot[go[hit]]]
            go = go[~hit & (got != 0)]
        return out

    def _put(self, keys: np.ndarray, entry: np.ndarray) -> None:
        mask = len(self.keys) - 1
        slot = (keys >> T.U(20)).astype(np.int64) & mask
        left = np.arange(len(keys))
        while len(left):
            free = self.keys[slot[left]] == 0
            spot, first = np.unique(slot[left[free]], return_index=True)
            put = left[free][first]
            self.keys[spot], self.at[spot] = keys[put], entry[put]
            done = np.zeros(len(keys), bool)
            done[put] = True
            left = left[~done[left]]
            slot[left] = (slot[left] + 1) & mask

    def add(self, keys: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        n = self.count
        while (n + len(keys)) * 2 > len(self.keys):
            old, at = self.keys[self.keys != 0], self.at[self.keys != 0]
            self.keys, self.at = np.zeros(len(self.keys) * 4, T.U), np.zeros(len(self.keys) * 4, np.int64)
            self._put(old, at)
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while n + len(keys) + 1 > len(self.off):
            self.off = np.concatenate([self.off, np.zeros_like(self.off)])
        self.flat[self.used:self.used + len(ids)] = ids
        self.off[n + 1:n + 1 + len(keys)] = self.used + np.cumsum(sizes)
        self.used += len(ids)
        self.count += len(keys)
        self._put(keys, np.arange(n, self.count))

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a slice, and their offsets by text."""
        low, s, e, simple = units(raw, offsets)
        if self.count > CACHE:
            self.clear(1 << 16)
        key = T.span_hash(low, s, e) | T.U(1)
        entry = self._find(key)
        miss = np.flatnonzero(entry < 0)
        if len(miss):
            new, first = np.unique(key[miss], return_index=True)
            first = miss[first]
            text = bytes(low)
            ids, sizes = self._tokenize([text[a:b].decode() for a, b in zip(s[first].tolist(), e[first].tolist(), strict=True)],
                                        simple[first])
            base = self.count
            self.add(new, ids, sizes)
            entry[miss] = base + np.searchsorted(new, key[miss])
        size = self.off[entry + 1] - self.off[entry]
        flat = self.flat[T.ranges(self.off[entry], size)]
        total = np.concatenate([[0], np.cumsum(size)])
        return flat, total[np.searchsorted(s, offsets)]

    def _tokenize(self, texts: list[str], simple: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct units. Simple units are one BPE word each: many go in one
        call, parted after the ids that end a word."""
        got: list = [None] * len(texts)
        easy = np.flatnonzero(simple).tolist()
        for lo in range(0, len(easy), 256):
            part = easy[lo:lo + 256]
            ids = np.array(self.tool.encode(" ".join(texts[i] for i in part), add_special_tokens=False).ids, np.uint16)
            ends = np.flatnonzero(self.last[ids])
            if len(ends) == len(part) and (not len(ids) or ends[-1] == len(ids) - 1):
                for i, x in zip(part, np.split(ids, ends[:-1] + 1), strict=True):
                    got[i] = x
        rest = [i for i, x in enumerate(got) if x is None]
        for i, x in zip(rest, self.tool.encode_batch([texts[i] for i in rest], add_special_tokens=False), strict=True):
            got[i] = np.array(x.ids, np.uint16)
        sizes = np.array([len(x) for x in got], np.int64)
        return np.concatenate(got), sizes


_LOADED: dict[str, Ids] = {}


def loaded(path: str) -> Ids:
    if path not in _LOADED:
        _LOADED[path] = Ids(path)
    return _LOADED[path]


def pieces(n: int, most: int = MAX) -> list[int]:
    """Lengths of the pieces of n tokens: full sequences, then the binary digits of the rest."""
    out = [most] * (n // most)
    rest = n % most
    return out + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def _pack(path: str, with_ids: bool):
    def run(batches):
        tool = loaded(path)
        for b in batches:
            raw, off = T.utf8(b.column(1))
            doc, start, length, crc, total, kept = [], [], [], [], [], []
            for i, j in T.slices(off, T.SLICE // 2):
                ids, cut = tool.encode(raw[off[i]:off[j]], off[i:j + 1] - off[i])
                for k in range(j - i):
                    own = np.append(ids[cut[k]:cut[k + 1]], END).astype("<u4")
                    data, at = own.tobytes(), 0
                    for size in pieces(len(own)):
                        doc.append(i + k)
                        start.append(at)
                        length.append(size)
                        crc.append(zlib.crc32(data[4 * at:4 * (at + size)]))
                        total.append(len(own))
                        if with_ids:
                            kept.append(own[at:at + size].astype(np.int32))
                        at += size
            cols = [b.column(0).take(pa.array(doc, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc, total))]
            if with_ids:
                cols.append(pa.array(kept, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(
                cols, ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids)
    return run


def pack(docs: DataFrame, path: str | None = None, with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length (= bucket), ids_crc32, doc_tokens,
    sequence_id, offset (always 0) and, if asked, the ids themselves.

    ``sequence_id`` holds the bucket (log2 of the length) above the row's place in
    its scan task: unique, and the sequences of a bucket are one range of ids."""
    settings(docs.sparkSession)
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = "doc_id {}, start long, length long, ids_crc32 long, doc_tokens long{}".format(
        docs.schema["doc_id"].dataType.simpleString(), ", ids array<int>" if with_ids else "")
    rows = docs.mapInArrow(_pack(path or default_path(), with_ids), schema)
    bucket = F.log2("length").cast("long")
    return rows.withColumn("sequence_id", F.shiftleft(bucket, 58) + F.monotonically_increasing_id()) \
        .withColumn("offset", F.lit(0).cast("long"))
