"""Operator 13: phrase collocations by dynamic itemset counting.

The documents are dealt into ``SHARDS`` shards that are scanned in a cycle (Brin,
Motwani, Ullman, Tsur 1997).  Single words are counted from the first shard on.
Whenever a shard is done, phrases whose count so far reaches ``LEAST`` are marked
with that step; from then on every longer phrase whose first part (all but the
last word) and rest (all but the first word) are both marked is counted, lengths
side by side in one scan, until it has seen each shard once.  The scans end when
no phrase has shards left: lengths overlap by half a pass, and a length that is
late only for rare phrases costs a scan that counts little.

What tasks know of the marks is a table of 2^``SLOT_BITS`` hash slots, of fixed size
at any scale: a phrase marked at step t sets bit t of two slots, and has the bits
that both of its slots have. Phrases that share slots make a task count more than it has to, never less: counts
are kept by shard, a shard is counted whole or not at all for a phrase, and a
phrase of ``LEAST`` occurrences has its full window, so all results are exact.
A phrase is named by the 64-bit hashes of its words; hashes are checked against
the words of the whole corpus, and a collision starts over with another seed.

Scores, containment and the ranking are joins and aggregates over the frequent
phrases, with decimal arithmetic.

Defined results: a null text is empty, a null language ``und``; an empty table
and a language without candidates give no rows; repeated rows count each;
further columns are ignored; null ids do not matter.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from qualis.llm import text as T
from qualis.llm.byte_tokens import joined
from qualis.llm.session import cut, discard, settings

LEAST = 30  # occurrences of a candidate
LONGEST = 4  # words of a phrase
SHARDS = 2  # more start longer phrases earlier, and bring what is counted together more often
TOP = 2000  # rows of a language
SCALE = 2_000_000
COVERED = 80  # percent of a phrase's occurrences inside a longer one
SLOT_BITS = 24
SLICE = 1 << 21

_CUT = np.zeros(256, bool)  # ends a piece
_CUT[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_BREAK = _CUT.copy()  # ends a word
_BREAK[[0x20, 0x09]] = True


class _Words:
    """The words of a run of texts: hash, piece number, language; and their byte spans.
    ``piece`` is the number of pieces that ended before this run in its (single) text."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, lang: np.ndarray, seed: int, piece: int = 0):
        self.raw = raw
        self.start, self.end = T.spans(raw, offsets, _BREAK)
        self.hash = T.mix(T.span_hash(raw, self.start, self.end, T.LOWER), seed)
        doc = np.searchsorted(offsets, self.start, "right") - 1
        ended = np.cumsum(_CUT[raw])
        self.piece = ended[self.start] + doc + piece
        self.next_piece = piece + (int(ended[-1]) if len(raw) else 0)
        self.lang = lang[doc]
        self.carried = 0  # words in front that an earlier run has counted

    def follow(self, before: _Words) -> None:
        """Put the last words of the same text in front."""
        k = min(LONGEST - 1, len(before.hash))
        if k:
            self.piece = np.concatenate([before.piece[-k:], self.piece])
            self.hash = np.concatenate([before.hash[-k:], self.hash])
            self.lang = np.concatenate([before.lang[-k:], self.lang])
            self.carried = k


def _runs(raw: np.ndarray, offsets: np.ndarray, lang: np.ndarray, seed: int, limit: int = SLICE):
    """Word runs of bounded size; a very long text comes in several that overlap by words."""
    for i, j in T.slices(offsets, limit):
        lo, hi = int(offsets[i]), int(offsets[j])
        if hi - lo <= 2 * limit or j > i + 1:
            yield _Words(raw[lo:hi], offsets[i:j + 1] - lo, lang[i:j], seed)
            continue
        before = None
        while lo < hi:  # one long text: cut behind the last break of each stretch
            end = min(hi, lo + limit)
            gaps = np.flatnonzero(_BREAK[raw[lo:end]])
            while not len(gaps) and end < hi:
                end = min(hi, end + limit)
                gaps = np.flatnonzero(_BREAK[raw[lo:end]])
            if end < hi:
                end = lo + int(gaps[-1]) + 1
            words = _Words(raw[lo:end], np.array([0, end - lo]), lang[i:j], seed, before.next_piece if before else 0)
            if before is not None:
                words.follow(before)
            yield words
            before, lo = words, end


def _codes(column) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct languages of a column, their hashes, and each row's index."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    d = column.dictionary_encode()
    raw, off = T.utf8(d.dictionary)
    return d.dictionary, T.mix(T.span_hash(raw, off[:-1], off[1:]), 7), d.indices.to_numpy(zero_copy_only=False)


def _identity(words: list[np.ndarray], lang_hash: np.ndarray) -> np.ndarray:
    """Hash of phrases given by the hashes of their words and language."""
    h = lang_hash
    for k, w in enumerate(words):
        h = T.mix(h ^ w, k + 1)
    return h


def _slots(words: list[np.ndarray], lang_hash: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two slots of each phrase: upper and lower bits of its hash."""
    h = _identity(words, lang_hash)
    return (h >> T.U(64 - SLOT_BITS)).astype(np.int64), (h & T.U((1 << SLOT_BITS) - 1)).astype(np.int64)


def _marks_of(table: np.ndarray, words: list[np.ndarray], lang_hash: np.ndarray) -> np.ndarray:
    one, two = _slots(words, lang_hash)
    return table[one] & table[two]


_HELD: dict = {}


def _table(marks, key: tuple) -> np.ndarray:
    """The broadcast marks: 2^SLOT_BITS numbers, mostly zeros, sent compressed; a worker
    unpacks those of a step once."""
    if _HELD.get("key") != key:
        _HELD.update(key=key, table=np.frombuffer(zlib.decompress(marks.value), np.uint16))
    return _HELD["table"]


def _open(first: np.ndarray, rest: np.ndarray, step: int) -> np.ndarray:
    """Whether phrases are counted at ``step``, by the marks of their two parts."""
    recent = ((1 << (step + 1)) - 1) & ~((1 << max(0, step + 1 - SHARDS)) - 1)
    return (first != 0) & (rest != 0) & (((first | rest) & np.uint16(recent)) != 0)


def _phrases(hashes: np.ndarray, at: np.ndarray, k: int) -> pa.Array:
    """The keys (hashes of k words) of the phrases that start at ``at``."""
    data = np.ascontiguousarray(hashes[at[:, None] + np.arange(k)])
    return pa.Array.from_buffers(pa.binary(), len(at), [
        None, pa.py_buffer((np.arange(len(at) + 1) * 8 * k).astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])


def _strings(words: _Words, at: np.ndarray) -> pa.Array:
    s, n = words.start[at], words.end[at] - words.start[at]
    data = T.LOWER[words.raw[T.ranges(s, n)]]
    off = np.concatenate([[0], np.cumsum(n)]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(off.tobytes()), pa.py_buffer(data.tobytes())]).cast(pa.string())


def _groups(order_by: np.ndarray, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(first member, size) of the runs of equal ``columns`` in the order of a hash of them.
    Two contents with one hash may give a content several runs, never a wrong one."""
    order = np.argsort(order_by, kind="stable")
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in columns:
        v = c[order]
        new[1:] |= v[1:] != v[:-1]
    first = np.flatnonzero(new)
    return order[first], np.diff(np.append(first, len(order)))


def _count(marks, run_id: str, step: int, seed: int):
    """Rows (lang, key, n, word) of the phrases of a task's texts that are counted at ``step``."""
    def run(batches):
        table = _table(marks, (run_id, step)) if marks is not None else None
        for part in joined(batches, SLICE):
            names, name_hash, lang = _codes(part.column(0))
            raw, off = T.utf8(part.column(1))
            for w in _runs(raw, off, lang, seed):
                c = w.carried
                if len(w.hash) == c:
                    continue
                if step < SHARDS:
                    at, n = _groups(w.hash[c:], [w.hash[c:], w.lang[c:]])
                    yield _rows(names, w, at + c, n, 1, _strings(w, at))
                if table is None:
                    continue
                mark = _marks_of(table, [w.hash], name_hash[w.lang])
                for k in range(2, min(LONGEST, len(w.hash)) + 1):
                    m = len(w.hash) - k + 1
                    at = np.flatnonzero((w.piece[:m] == w.piece[k - 1:]) & (mark[:m] != 0) & (mark[1:m + 1] != 0))
                    if not len(at):
                        break
                    go = at[_open(mark[at], mark[at + 1], step) & (at + k > c)]
                    if len(go):
                        cols = [w.hash[go + i] for i in range(k)]
                        first, n = _groups(_identity(cols, name_hash[w.lang[go]]), [*cols, w.lang[go]])
                        yield _rows(names, w, go[first], n, k, None)
                    mark = np.zeros(m, np.uint16)  # the marks of these phrases, for the next length
                    mark[at] = _marks_of(table, [w.hash[at + i] for i in range(k)], name_hash[w.lang[at]])
    return run


def _rows(names: pa.Array, w: _Words, at: np.ndarray, n: np.ndarray, k: int, word: pa.Array | None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [names.take(pa.array(w.lang[at])), _phrases(w.hash, at, k), pa.array(n.astype(np.int64)),
         word if word is not None else pa.nulls(len(at), pa.string())], ["lang", "key", "n", "word"])


def _by_length(batch: pa.RecordBatch):
    """(k, row numbers, word hashes as k arrays, language hashes) for each phrase length of a batch."""
    names, name_hash, lang = _codes(batch.column(0))
    raw, off = T.utf8(_as_text(batch.column(1)))
    size = np.diff(off) // 8
    for k in np.unique(size).tolist():
        at = np.flatnonzero(size == k)
        data = raw[T.ranges(off[at], np.full(len(at), 8 * k))].view(T.U).reshape(-1, k)
        yield k, at, [data[:, i] for i in range(k)], name_hash[lang[at]]


def _as_text(column) -> pa.Array:
    """A binary column under a string type (the bytes are not looked at)."""
    col = column.cast(pa.large_binary())
    return pa.Array.from_buffers(pa.large_string(), len(col), col.buffers(), offset=col.offset)


def _slots_of(batches):
    """The hash slots of phrases (lang, key)."""
    for b in batches:
        found = [x for _, _, words, lh in _by_length(b) for x in _slots(words, lh)]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(found)))], ["slot"])


def _still_open(marks, run_id: str, step: int, names: list[str]):
    """The phrases of two words and more that have shards left at ``step``."""
    def run(batches):
        table = _table(marks, (run_id, step))
        for b in batches:
            keep = np.zeros(b.num_rows, bool)
            for _, at, words, lh in _by_length(b):
                keep[at] = _open(_marks_of(table, words[:-1], lh), _marks_of(table, words[1:], lh), step)
            yield b.select(names).filter(pa.array(keep))
    return run


def frequent(docs: DataFrame, least: int = LEAST, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(lang, key, words, f, word) of all phrases of up to ``LONGEST`` words with f >= least
    (``word`` for single words), and (lang, n) with the number of all words."""
    spark = docs.sparkSession
    settings(spark)
    slot = F.pmod(F.monotonically_increasing_id(), F.lit(SHARDS)).cast("int")
    texts = cut(docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                            F.col("text").cast("string").alias("text"), slot.alias("shard")), "shard")
    counts, run_id = [f"c{s}" for s in range(SHARDS)], uuid.uuid4().hex
    total = sum((F.coalesce(F.col(c), F.lit(0)) for c in counts), F.lit(0))
    names = ["lang", "key", "word", *counts, "mark", "first"]
    schema = "lang string, key binary, word string, " + ", ".join(f"{c} long" for c in counts) + ", mark int, first int"
    marks, table = None, np.zeros(1 << SLOT_BITS, np.uint16)
    state, settled, marked, words = None, [], [], None
    last = -1  # last step at which a phrase that can be part of another was marked
    for step in range(LONGEST * SHARDS):
        if step >= SHARDS and step - last >= SHARDS:
            break
        now = f"c{step % SHARDS}"
        rows = (texts.where(F.col("shard") == step % SHARDS).select("lang", "text")
                .mapInArrow(_count(marks, run_id, step, seed), "lang string, key binary, n long, word string")
                .select("lang", "key", "word", "n", *[F.lit(None).cast("long").alias(c) for c in counts],
                        F.lit(None).cast("int").alias("mark"), F.lit(step).alias("first")))
        if state is not None:
            seen = F.col("first") > step - SHARDS  # counted for less than a cycle
            old = state.where(~seen & (F.octet_length("key") > 8)).mapInArrow(_still_open(marks, run_id, step, names), schema)
            kept = state.where(seen).unionByName(old)
            rows = rows.unionByName(kept.withColumn("n", F.lit(None).cast("long")))
        rows = rows.groupBy("lang", "key", "word").agg(
            F.sum("n").alias("n"), *[F.max(c).alias(c) for c in counts], F.max("mark").alias("mark"), F.min("first").alias("first"))
        rows = rows.withColumn(now, F.coalesce("n", now)).drop("n")
        before, state = state, cut(rows.withColumn("mark", F.coalesce("mark", F.when(total >= least, step + 1))))
        if before is not None:
            discard(before)
        settled.append(cut(state.where(F.col("mark").isNotNull()).select("lang", "key", "word", *counts, "mark")))
        if step == SHARDS - 1:
            single = state.where(F.octet_length("key") == 8)
            if not single.groupBy("lang", "key").count().where("count > 1").isEmpty():  # two words with one hash
                return frequent(docs, least, seed + 1)
            words = cut(single.groupBy("lang").agg(F.sum(total).alias("n")))
        fresh = settled[-1].where((F.col("mark") == step + 1) & (F.octet_length("key") < 8 * LONGEST)).select("lang", "key")
        for m in marked:  # a slot's other marks may have a settled phrase counted again
            fresh = fresh.join(m, ["lang", "key"], "left_anti")
        fresh = cut(fresh)
        marked.append(fresh)
        new = fresh.mapInArrow(_slots_of, "slot long").distinct().toArrow()["slot"].to_numpy()  # 2^SLOT_BITS numbers at most
        if len(new):
            last = step + 1
            table[new] |= np.uint16(1 << (step + 1))
        if marks is not None:
            marks.destroy()
        marks = spark.sparkContext.broadcast(zlib.compress(table.tobytes(), 1))
    found = settled[0]
    for s in settled[1:]:
        found = found.unionByName(s)
    found = found.groupBy("lang", "key", "word").agg(*[F.max(c).alias(c) for c in counts])
    out = cut(found.select("lang", "key", (F.octet_length("key") / 8).cast("int").alias("words"), total.alias("f"), "word"))
    for df in (state, texts, *settled, *marked):
        discard(df)
    return out, words


def _part(k, n=None):
    """Words k+1 .. k+n of a key (to the end without n)."""
    at = F.lit(1) + 8 * k
    return F.substring("key", at, F.lit(8) * (n if n is not None else F.lit(LONGEST)))


def mine(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` phrases of every language."""
    known, sizes = frequent(docs, least)
    longer = known.where("words > 1").select("lang", "key", "words", F.col("f").alias("a"))
    side = known.select("lang", "key", "f")
    cutting = longer.select("lang", "key", "a", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cutting = cutting.withColumn("first", _part(F.lit(0), F.col("k"))).withColumn("rest", _part(F.col("k")))
    cutting = (cutting.join(side.select("lang", F.col("key").alias("first"), F.col("f").alias("l")), ["lang", "first"])
               .join(side.select("lang", F.col("key").alias("rest"), F.col("f").alias("r")), ["lang", "rest"]))
    whole = "cast({} as decimal(19, 0))"
    score = F.expr(f"cast(cast({SCALE} as decimal(10, 0)) * {whole.format('a')} div "
                   f"({whole.format('l')} + {whole.format('r')}) as long)")
    best = (cutting.select("lang", "key", "a", F.struct(score.alias("score"), "k", "l", "r").alias("cut"))
            .groupBy("lang", "key").agg(F.first("a").alias("a"), F.min("cut").alias("cut")))
    # the largest count of a longer candidate around each phrase
    inner = longer.where("words > 2").select("lang", "key", "a", F.explode(F.expr(
        "flatten(transform(sequence(2, words - 1), m -> transform(sequence(0, words - m), i -> struct(i, m))))")).alias("at"))
    around = (inner.select("lang", _part(F.col("at.i"), F.col("at.m")).alias("key"), "a")
              .groupBy("lang", "key").agg(F.max("a").alias("over")))
    hundred = "cast({} as decimal(3, 0)) * cast({} as decimal(19, 0))"
    left = cut(best.join(around, ["lang", "key"], "left")
               .where(F.col("over").isNull() | F.expr(f"{hundred.format(100, '`over`')} < {hundred.format(COVERED, 'a')}"))
               .select("lang", "key", "a", "cut.*"))
    spelled = (left.select("lang", "key", F.explode(F.sequence(F.lit(0), (F.octet_length("key") / 8).cast("int") - 1)).alias("i"))
               .withColumn("one", _part(F.col("i"), F.lit(1)))
               .join(known.where("words = 1").select("lang", F.col("key").alias("one"), "word"), ["lang", "one"])
               .groupBy("lang", "key").agg(F.array_join(F.transform(
                   F.array_sort(F.collect_list(F.struct("i", "word"))), lambda x: x["word"]), " ").alias("phrase")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (left.join(spelled, ["lang", "key"]).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .join(sizes, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
