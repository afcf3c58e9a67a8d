"""Operator 12: best-fit packing with matching of the large items.

A document is its ids and the end id.  Documents over the capacity are cut into
full pieces, the first piece taking what is left over; every piece is an item.
Items above a third of the capacity (large) share a sequence with at most one
other large item: from the largest down, an item is matched with the largest
partner that fits.  Smaller items then go, from the largest down, into the
sequence with the smallest gap that holds them, and open a new one if none does.

Items of one length are alike, so the packing is decided on the number of items
of each length - at most ``capacity`` numbers at any scale - and is exactly what
the item-by-item procedure gives.  The plan is a list of runs: from item g on,
the items of this length go ``per`` at a time to the sequences from ``first`` on,
at this offset.  A run ends with a length or with a set of equal gaps, so their
number follows the capacity, never the input.  Items get their place g in the
order (length, task that tokenized them, place in that task) from a two-level
prefix sum over counts; their rows are joined with one offset for each (length,
task) and looked up in the plan.  No sort of the items, no window over them.

Defined results: a null or empty text is the end id alone; a repeated row is
packed again; a null doc_id is carried; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualis.llm import byte_tokens as B
from qualis.llm import text as T
from qualis.llm.session import cut, settings
from qualis.sources.rowindex import prefix_offsets

CAPACITY = 1024
END = 2


def cuts(n: int, most: int = CAPACITY) -> list[int]:
    """Piece lengths of n tokens: full pieces, the first one may be shorter."""
    return ([n % most] if n % most else []) + [most] * (n // most)


class _Gaps:
    """Ranges of sequences (first, number) by the space that is left in them."""

    def __init__(self) -> None:
        self.sizes: list[int] = []
        self.of: dict[int, list[tuple[int, int]]] = {}

    def add(self, gap: int, first: int, n: int) -> None:
        if gap not in self.of:
            insort(self.sizes, gap)
            self.of[gap] = []
        self.of[gap].append((first, n))

    def take(self, least: int) -> tuple[int, int, int] | None:
        """A range with the smallest gap of ``least`` or more."""
        at = bisect_left(self.sizes, least)
        if at == len(self.sizes):
            return None
        gap = self.sizes[at]
        first, n = self.of[gap].pop()
        if not self.of[gap]:
            del self.of[gap]
            self.sizes.pop(at)
        return gap, first, n


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Runs (length, rank of its first item within the length, first sequence, items
    a sequence, offset) and the number of sequences."""
    left = {size: n for size, n in counts.items() if n > 0}
    used = dict.fromkeys(left, 0)
    runs, gaps, total = [], _Gaps(), 0

    def put(size: int, n: int, first: int, per: int, offset: int) -> None:
        runs.append((size, used[size], first, per, offset))
        used[size] += n
        left[size] -= n

    large = sorted((s for s in left if 3 * s > capacity), reverse=True)
    for a in large:
        while left[a]:
            b = next((s for s in large if s <= min(a, capacity - a) and left[s] > (s == a)), None)
            n = left[a] if b is None else left[a] // 2 if b == a else min(left[a], left[b])
            put(a, n, total, 1, 0)
            if b is not None:
                put(b, n, total, 1, a)
            gaps.add(capacity - a - (b or 0), total, n)
            total += n
    for size in sorted((s for s in left if 3 * s <= capacity), reverse=True):
        while left[size]:
            gap, first, n = gaps.take(size) or (capacity, total, -(-left[size] // (capacity // size)))
            total = max(total, first + n)
            per = gap // size
            whole = min(n, left[size] // per)
            if whole:
                put(size, whole * per, first, per, capacity - gap)
                gaps.add(gap - per * size, first, whole)
            rest = left[size]
            if rest and whole < n:  # fewer than a sequence takes
                put(size, rest, first + whole, rest, capacity - gap)
                gaps.add(gap - rest * size, first + whole, 1)
                whole += 1
            if whole < n:
                gaps.add(gap, first + whole, n - whole)
    return runs, total


def _tokenize(paths: tuple[str, str], capacity: int, with_ids: bool):
    def run(batches):
        tool = B.loaded(*paths, plain_specials=False)
        nth = np.zeros(capacity + 1, np.int64)  # items of each length that this task has seen
        for table in B.joined(batches):
            raw, off = T.utf8(table.column(1))
            for i, j in T.slices(off):
                out: list[list] = [[] for _ in range(7)]
                for k, ids in enumerate(tool.encode(raw[off[i]:off[j]], off[i:j + 1] - off[i]), i):
                    own = np.append(ids, END).astype("<u4")
                    data, at = own.tobytes(), 0
                    for piece, size in enumerate(cuts(len(own), capacity)):
                        row = (k, piece, at, size, zlib.crc32(data[4 * at:4 * (at + size)]), nth[size],
                               own[at:at + size].astype(np.int32) if with_ids else None)
                        for col, x in zip(out, row, strict=True):
                            col.append(x)
                        nth[size] += 1
                        at += size
                doc = pa.array(out[0], pa.int64())
                cols = [table.column(0).take(doc).combine_chunks(), pa.array(out[1], pa.int32()),
                        *(pa.array(x, pa.int64()) for x in out[2:6]), table.column(2).take(doc).combine_chunks()]
                if with_ids:
                    cols.append(pa.array(out[6], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(
                    cols, ["doc_id", "piece", "start", "length", "ids_crc32", "nth", "part"] + ["ids"] * with_ids)
    return run


def _place(starts: np.ndarray, first: np.ndarray, per: np.ndarray, offset: np.ndarray, keep: list[str]):
    """Looks every item's place g up in the plan; ``keep`` names the columns that stay."""
    def run(batches):
        for b in batches:
            g = b.column("g").to_numpy(zero_copy_only=False)
            size = b.column("length").to_numpy(zero_copy_only=False)
            at = np.searchsorted(starts, g, "right") - 1
            since = g - starts[at]
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in keep] + [pa.array(first[at] + since // per[at]),
                                               pa.array(offset[at] + since % per[at] * size)],
                [*keep, "sequence_id", "offset"])
    return run


def pack(docs: DataFrame, paths: tuple[str, str] | None = None, capacity: int = CAPACITY,
         with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, (ids,) sequence_id, offset."""
    settings(docs.sparkSession)
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.spark_partition_id().alias("part"))
    schema = "doc_id {}, piece int, start long, length long, ids_crc32 long, nth long, part int{}".format(
        docs.schema["doc_id"].dataType.simpleString(), ", ids array<int>" * with_ids)
    items = cut(docs.mapInArrow(_tokenize(paths or B.default_paths(), capacity, with_ids), schema))
    counts = cut(items.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")))
    by_size = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    base, total = {}, 0  # g of the first item of each length, as prefix_offsets counts
    for size in sorted(by_size):
        base[size] = total
        total += by_size[size]
    runs, _ = plan(by_size, capacity)
    table = np.array(sorted((base[s] + rank, first, per, offset) for s, rank, first, per, offset in runs),
                     np.int64).reshape(-1, 4)
    keep = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    places = prefix_offsets(counts, ["length", "part"], "n", out="before")
    rows = (items.join(places, ["length", "part"])
            .select(*keep, (F.col("before") + F.col("nth")).cast("long").alias("g")))
    out = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInArrow(_place(*(table[:, k].copy() for k in range(4)), keep), out + ", sequence_id long, offset long")
