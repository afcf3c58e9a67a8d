"""CSV with line breaks in quoted cells, read by many tasks.

Whether a line starts a record depends on all quotes before it in the file. Each
split is summed up once for both cases - it starts at a record, or inside a
quoted cell: the records that start in it, whether it ends inside a cell, and
the text that belongs to a record of an earlier or a later split. A pass over
these rows (one per split) in file order settles which case holds and gives every
split the number of its first record. The second scan then yields the records of
each split with their dense position, without moving any of them; only records
that cross a split's end are put together from their parts by a small aggregate.

What the tasks of the second scan share is one flag and one number per split (17
bytes; 100 TB in splits of 128 MB are 14 MB). Both scans must see the same splits;
a split that the first one did not see is an error. Texts of a crossing record that
are over ``HELD`` bytes in one split are not kept with the sums: they are read again.

Records: a quote opens a cell at its start only, is doubled inside, and after the
closing one text is literal up to the separator. ``\\n`` ends a line, one ``\\r``
before it goes; lines of blanks between records are no records. The first record
of a file is its header.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qualis.session import cut, together

HELD = 1 << 16

SUMMARY = ("file string, blk long, n0 long, open0 boolean, tail0 string, long0 boolean, "
           "n1 long, open1 boolean, head1 string, tail1 string, long1 boolean")


def ends_open(line: str, inside: bool, sep: str) -> bool:
    """Whether a line ends inside a quoted cell; it starts inside one or at a record."""
    at, cell = 0, sep + '"'
    if not inside:
        if line[:1] != '"':
            at = line.find(cell)
            if at < 0:
                return False
            at += len(sep)
        at += 1
    while True:
        at = line.find('"', at)
        if at < 0:
            return True
        if line[at + 1:at + 2] == '"':
            at += 2
            continue
        at = line.find(sep, at + 1)  # literal text behind the closing quote
        if at < 0:
            return False
        if line[at + len(sep):at + len(sep) + 1] != '"':
            at = line.find(cell, at)
            if at < 0:
                return False
        at += len(sep) + 1


class Walk:
    """The records of one split, from a known start state."""

    def __init__(self, inside: bool, first: int, sep: str, held: int | None = None):
        self.open, self.next, self.sep, self.limit = inside, first, sep, held
        self.id: int | None = None  # of the open record, None if an earlier split started it
        self.parts: list = []
        self.size, self.long = 0, False
        self.head: str | None = None
        self.head_long = False

    def _hold(self, lines: list[str]) -> None:
        self.size += sum(map(len, lines))
        if self.limit is not None and self.size > self.limit:
            self.long, self.parts = True, []
        if not self.long:
            self.parts += lines

    def _ended(self) -> str:
        text = "\n".join(self.parts)
        self.parts, self.size, self.open = [], 0, False
        return text

    def feed(self, lines: pa.Array, solid: np.ndarray, quoted: list[tuple[int, str]]):
        """(numbers of the lines that are whole records, their ids), [(text, id)] of longer records."""
        rows, ids, texts = [], [], []
        at = 0
        for i, line in [*quoted, (len(lines), None)]:
            if i > at:  # lines without a quote
                if self.open:
                    self._hold(_texts(lines.slice(at, i - at)))
                else:
                    own = np.flatnonzero(solid[at:i]) + at
                    rows.append(own)
                    ids.append(np.arange(self.next, self.next + len(own)))
                    self.next += len(own)
            if line is None:
                break
            if self.open:
                self._hold([line])
                if not ends_open(line, True, self.sep):
                    was, long = self.id, self.long
                    text = self._ended()
                    if was is None:
                        self.head, self.head_long = text, long
                    elif self.limit is None:
                        texts.append((text, was))
                    self.long = False
            elif ends_open(line, False, self.sep):
                self.open, self.id = True, self.next
                self.next += 1
                self._hold([line])
            else:
                rows.append(np.array([i]))
                ids.append(np.array([self.next]))
                self.next += 1
            at = i + 1
        empty = np.zeros(0, np.int64)
        return (np.concatenate(rows) if rows else empty), (np.concatenate(ids) if ids else empty), texts

    def rest(self) -> str | None:
        """Text of the record that is open at the end of the split."""
        return "\n".join(self.parts) if self.open else None


def _texts(lines: pa.Array) -> list[str]:
    return [x.decode("utf-8", "surrogateescape") for x in lines.cast(pa.binary()).to_pylist()]


def _strings(texts: list[str]) -> pa.Array:
    return pa.array([None if t is None else t.encode("utf-8", "surrogateescape") for t in texts], pa.binary()) \
        .cast(pa.string(), safe=False)


def _splits(batches, quotes: bool):
    """(file, split start, lines, which are not blank, the quoted ones) in order."""
    for b in batches:
        if not b.num_rows:
            continue
        file = b.column(1).dictionary_encode()
        blk = b.column(2).to_numpy()
        code = file.indices.to_numpy()
        ends = np.flatnonzero((code[1:] != code[:-1]) | (blk[1:] != blk[:-1])) + 1
        for i, j in zip([0, *ends.tolist()], [*ends.tolist(), b.num_rows]):
            lines = b.column(0).slice(i, j - i)
            solid = ~pc.match_substring_regex(lines, r"^[ \t]*\r?$").to_numpy(zero_copy_only=False)
            at = np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False)) if quotes else []
            quoted = list(zip(at.tolist(), _texts(lines.take(pa.array(at))))) if len(at) else []
            yield file.dictionary[code[i]].as_py(), int(blk[i]), lines, solid, quoted


def _summarize(sep: str, quotes: bool, held: int | None):
    def run(batches):
        key, walks = None, ()
        for file, blk, *lines in _splits(batches, quotes):
            if key != (file, blk):
                if key:
                    yield _row(key, *walks)
                key, walks = (file, blk), (Walk(False, 0, sep, held), Walk(True, 0, sep, held))
            for w in walks:
                w.feed(*lines)
        if key:
            yield _row(key, *walks)
    return run


def _row(key: tuple[str, int], a: Walk, b: Walk) -> pa.RecordBatch:
    started = b.id is not None and b.open
    head = b.head if b.head is not None else (b.rest() if not started else None)
    long1 = b.head_long or (b.open and b.long)
    cols = [[key[0]], [key[1]], [a.next], [a.open], _strings([a.rest()]), [a.open and a.long],
            [b.next], [b.open], _strings([head]), _strings([b.rest() if started else None]), [long1]]
    names = ["file", "blk", "n0", "open0", "tail0", "long0", "n1", "open1", "head1", "tail1", "long1"]
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in cols], names)


class Places:
    """Start state and first record number of every split, by file and split start."""

    def __init__(self, table: pa.Table):
        self.files: dict[str, tuple[int, np.ndarray, np.ndarray, np.ndarray]] = {}
        total = 0
        t = table.sort_by([("file", "ascending"), ("blk", "ascending")])
        cols = [t[c].to_pylist() for c in ("file", "blk", "n0", "open0", "n1", "open1")]
        rows = list(zip(*cols))
        i = 0
        while i < len(rows):
            j, inside, nxt, states, firsts = i, False, total - 1, [], []  # the header is record total - 1
            while j < len(rows) and rows[j][0] == rows[i][0]:
                states.append(inside)
                firsts.append(nxt)
                nxt += rows[j][4] if inside else rows[j][2]
                inside = rows[j][5] if inside else rows[j][3]
                j += 1
            self.files[rows[i][0]] = (total, np.array([r[1] for r in rows[i:j]]), np.array(states), np.array(firsts))
            total = max(total, nxt)
            i = j

    def of(self, file: str, blk: int) -> tuple[int, bool, int]:
        """(first row of the file, whether the split starts inside a cell, its first record)."""
        if file in self.files:
            total, blks, states, firsts = self.files[file]
            at = int(np.searchsorted(blks, blk))
            if at < len(blks) and blks[at] == blk:
                return total, bool(states[at]), int(firsts[at])
        raise RuntimeError(f"{file} is split differently than before (at {blk}); keep the number of cores while it is read, or set "
                           "spark.sql.files.minPartitionNum")


def _records(places, sep: str, quotes: bool):
    def run(batches):
        key, walk, total = None, None, 0
        for file, blk, lines, solid, quoted in _splits(batches, quotes):
            if key != (file, blk):
                key = file, blk
                total, inside, first = places.value.of(file, blk)
                walk = Walk(inside, first, sep)
            rows, ids, texts = walk.feed(lines, solid, quoted)
            text = pa.concat_arrays([lines.take(pa.array(rows)), _strings([t for t, _ in texts])])
            at = np.concatenate([ids, np.array([k for _, k in texts], np.int64)])
            own = at >= total  # no header
            yield pa.RecordBatch.from_arrays([pa.array(at[own]), text.filter(pa.array(own))], ["_row_id", "text"])
    return run


def _crossing(places):
    """(file, id, blk, text) parts of the records that cross a split's end; text is NULL where
    it was too long to be kept."""
    def run(batches):
        for b in batches:
            out: list[tuple] = []
            for r in b.to_pylist():
                total, inside, first = places.value.of(r["file"], r["blk"])
                n, tail, long = (r["n1"], r["tail1"], r["long1"]) if inside else (r["n0"], r["tail0"], r["long0"])
                if inside:
                    out.append((first - 1, r["blk"], None if long else r["head1"], r["file"], total))
                if (r["open1"] if inside else r["open0"]) and n:
                    out.append((first + n - 1, r["blk"], None if long else tail, r["file"], total))
            out = [x for x in out if x[0] >= x[4]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()),
                 pa.array([x[2] for x in out], pa.string()), pa.array([x[3] for x in out], pa.string())], ["id", "blk", "text", "file"])
    return run


def _again(places, wanted, sep: str, quotes: bool):
    """The parts of crossing records of the wanted splits, whole."""
    def run(batches):
        key, walk, total, mine = None, None, 0, False

        def parts():
            if mine and walk is not None:
                rows = [] if walk.head is None else [(first - 1, walk.head)]
                if walk.open:
                    rows.append((first - 1 if walk.id is None else walk.id, walk.rest()))
                rows = [r for r in rows if r[0] >= total]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int64()), pa.array([key[1]] * len(rows), pa.int64()),
                     _strings([r[1] for r in rows])], ["id", "blk", "text"])
        first = 0
        for file, blk, *lines in _splits(batches, quotes):
            if key != (file, blk):
                yield from parts()
                key, mine = (file, blk), (file, blk) in wanted
                if mine:
                    total, inside, first = places.value.of(file, blk)
                    walk = Walk(inside, first, sep)
            if mine:
                walk.feed(*lines)
        yield from parts()
    return run


def lines(spark: SparkSession, files: list[str]) -> DataFrame:
    return spark.read.text(files, lineSep="\n").select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("blk"))


def records(spark: SparkSession, groups: list[list[str]], sep: str = ",", quotes: bool = True, held: int = HELD) -> list[DataFrame]:
    """For each group of CSV files (_row_id, text): the records behind the files' headers,
    numbered from 0 in the order of all file paths. Without ``quotes`` every line is a record."""
    raws = [lines(spark, files) for files in groups]
    sums = together(spark, *[lambda raw=raw: cut(raw.mapInArrow(_summarize(sep, quotes, held), SUMMARY)) for raw in raws])
    places = spark.sparkContext.broadcast(Places(pa.concat_tables(
        [s.select("file", "blk", "n0", "open0", "n1", "open1").toArrow() for s in sums])))
    return [_group(spark, raw, summed, places, sep, quotes) for raw, summed in zip(raws, sums)]


def _group(spark: SparkSession, raw: DataFrame, sums: DataFrame, places, sep: str, quotes: bool) -> DataFrame:
    whole = raw.mapInArrow(_records(places, sep, quotes), "_row_id long, text string")
    if not quotes:
        return whole
    crossing = sums.mapInArrow(_crossing(places), "id long, blk long, text string, file string")
    long = {(r["file"], r["blk"]) for r in crossing.where("text is null").select("file", "blk").distinct().collect()}
    parts = crossing
    if long:  # splits with a part that was not kept; one name each
        parts = crossing.join(spark.createDataFrame(sorted(long), "file string, blk long"), ["file", "blk"], "left_anti")
    parts = parts.select("id", "blk", "text")
    if long:
        parts = parts.unionByName(raw.mapInArrow(_again(places, long, sep, quotes), "id long, blk long, text string"))
    joined = parts.groupBy("id").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("blk", "text"))), lambda x: x["text"]), "\n").alias("text"))
    return whole.unionByName(joined.select(F.col("id").alias("_row_id"), "text"))
