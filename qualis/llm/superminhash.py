"""Operator 2: near-duplicate groups by SuperMinHash, banding, verification, union-find.

SuperMinHash (O. Ertl, 2017) gives every element a random *permutation* of the
``m`` signature slots; the element offers ``j + r_j`` to the slot that stands
j-th in its permutation.  Ranks of one element are correlated, which lowers the
variance against independent minima, and because offers of step j lie in
[j, j + 1), a document stops as soon as every slot is below j + 1.  Steps run
in lock step over all elements of a slice of documents with numpy; a document
of a few hundred shingles needs one or two steps.

Plan: one pass over the texts makes, per document, the size and a 128-bit
fingerprint of its shingle set, and the signature.  Equal sets become one class
(partial aggregate), so thousands of exact copies cost one representative.
Bands of ``ROWS`` signature values put representatives into buckets.  Each
representative is first checked against one other, of the least members of its
buckets that with which it shares most buckets (one link each at most, never all
pairs): signatures first, on narrow rows, then the full sets of the pairs that
pass.  Only their texts are moved (``sieve``).  Components of the confirmed links
are formed by union-find.  Buckets whose members then still lie in
several components are compared exactly, in blocks: the bucket's largest
component meets only the members outside it, a block pair is one group of
bounded size. Signatures pick the members of a block pair that are close to one
outside their component; only these bring their text, and their whole shingle
sets are compared, skipping pairs that are already connected and emitting only
the links that join components.  All links are
confirmed on the full sets (``100 * inter >= 75 * union``).

Defined results: null, empty or white-space text: empty set, ``n_shingles`` 0,
linked with nothing.  Rows that repeat a doc_id count as one document.  Rows
with a null doc_id never name a group: their component is that of their exact
copies with an id, else null, and then they are kept.  Ties: the smallest id.
Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualis.llm import text as T
from qualis.llm.components import components
from qualis.llm.session import cut, discard, settings
from qualis.llm.sieve import moved

SLOTS, ROWS = 128, 4
BANDS = SLOTS // ROWS
SHINGLE, PERCENT = 5, 75
BLOCK = 256  # representatives of one block of a bucket
CLOSE = 0.5  # least share of equal signature slots of pairs that are compared exactly (at 0.75 one pair in 3e9 has less)
_FRACTION = 25  # bits of r in a slot value; the step is above them


def signatures(sets: np.ndarray, offsets: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash signatures (documents x slots, uint32) of ragged element sets."""
    rows = len(offsets) - 1
    out = np.full((rows, slots), 0xFFFFFFFF, np.uint32)
    for i, j in T.slices(offsets, 100_000):
        _fill(out[i:j], sets[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], slots)
    return out


def _fill(sig: np.ndarray, elements: np.ndarray, offsets: np.ndarray, slots: int) -> None:
    owner = T.owners(offsets)
    flat = sig.reshape(-1)
    perm = None
    for step in range(slots):
        if not len(owner):
            return
        draw = T.mix(elements, step + 1)
        swap = step + ((draw >> T.U(32)) % T.U(slots - step)).astype(np.int64)
        if step:
            each = np.arange(len(owner))
            slot = perm[each, swap].astype(np.int64)
            perm[each, swap] = perm[:, step]
            perm[:, step] = slot
        else:
            slot = swap
        offer = (draw & T.U((1 << _FRACTION) - 1)).astype(np.uint32) | np.uint32(step << _FRACTION)
        np.minimum.at(flat, owner * slots + slot, offer)
        open_ = sig.max(axis=1) >= np.uint32((step + 1) << _FRACTION) if step < slots - 1 else np.zeros(len(sig), bool)
        keep = open_[owner]
        if not step:
            owner, elements, first = owner[keep], elements[keep], swap[keep]
            perm = np.tile(np.arange(slots, dtype=np.uint8), (len(owner), 1))
            each = np.arange(len(owner))
            perm[each, first] = 0
            perm[:, 0] = first
        elif not keep.all():
            owner, elements, perm = owner[keep], elements[keep], perm[keep]


def bands(sig: np.ndarray) -> np.ndarray:
    """Bucket keys (documents x bands, int64)."""
    key = np.zeros((len(sig), sig.shape[1] // ROWS), T.U)
    for r in range(ROWS):
        key = T.mix(key ^ sig[:, r::ROWS].astype(T.U), r)
    return T.mix(key + np.arange(key.shape[1], dtype=T.U)[None, :], 99).view(np.int64)


def _sketch(batches):
    for b in batches:
        sets, off = T.shingle_sets(b.column(1), SHINGLE)
        sig = signatures(sets, off)
        size = np.diff(off)
        marks = [T.row_sums(T.mix(sets, 1000 + k), off).view(np.int64) for k in (0, 1)]
        empty = size == 0
        cols = [b.column(0), pa.array(size), *(pa.array(m, mask=empty) for m in marks),
                pa.FixedSizeListArray.from_arrays(pa.array(bands(sig).reshape(-1)), BANDS).cast(pa.list_(pa.int64())),
                pa.array([row.tobytes() for row in (sig & 0xFF).astype(np.uint8)], pa.binary())]
        yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_shingles", "f1", "f2", "bands", "sig"])


def _alike(batches):
    """Pairs (a, b, sa, sb) with enough equal signature slots."""
    for b in batches:
        sa, sb = (_signature_rows(b.column(k)) for k in (2, 3))
        keep = pa.array((sa == sb).mean(axis=1) >= CLOSE) if b.num_rows else pa.array([], pa.bool_())
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).filter(keep)


def _signature_rows(column) -> np.ndarray:
    return np.array([np.frombuffer(x, np.uint8) for x in column.to_pylist()])


def _confirm(batches):
    """Pairs (a, b, ta, tb) whose whole shingle sets reach the threshold; sets are held for
    slices of bounded size."""
    for b in batches:
        ends = np.cumsum([b.column(k).nbytes / max(1, b.num_rows) for k in (2, 3)])[-1]
        step = max(1, int(T.SLICE // max(1, ends)))
        for i in range(0, b.num_rows, step):
            part = b.slice(i, step)
            hit = [jaccard(x, y) for x, y in zip(_sets(part.column(2)), _sets(part.column(3)), strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], ["a", "b"]).filter(pa.array(hit, pa.bool_()))


def _sets(column) -> list[np.ndarray]:
    sets, off = T.shingle_sets(column, SHINGLE)
    return [sets[off[i]:off[i + 1]] for i in range(len(off) - 1)]


def jaccard(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sorted distinct sets reach the threshold (empty sets never do)."""
    if not len(x) or not len(y) or 100 * min(len(x), len(y)) < PERCENT * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= PERCENT * (len(x) + len(y) - both)


def _cell(table: pa.Table):
    """Arrays of one block pair, and a function that gives the members close to member i:
    in another component, on the other side (any, if there is one block only), with
    enough equal signature slots. Major members (side -1) are one component."""
    rep, comp, side = (table[c].to_numpy() for c in ("rep", "comp", "side"))
    sig = _signature_rows(table["sig"])
    _, group = np.unique(comp, return_inverse=True)
    one_block = (side == side[0]).all()

    def close(i: int) -> np.ndarray:
        other = np.flatnonzero((group != group[i]) & (one_block | (side != side[i])))
        return other[(sig[other] == sig[i]).mean(axis=1) >= CLOSE]
    minors = np.flatnonzero(side >= 0)
    return rep, group, minors[np.argsort(rep[minors], kind="stable")].tolist(), close


def _near(table: pa.Table) -> pa.Table:
    """The members of a block pair that are close to one of another component."""
    _, _, minors, close = _cell(table)
    keep = np.zeros(table.num_rows, bool)
    for i in minors:
        found = close(i)
        keep[found] = True
        keep[i] |= len(found) > 0
    return table.filter(pa.array(keep))


def _block_links(table: pa.Table) -> pa.Table:
    """Links between components inside one block pair of one bucket."""
    rep, group, minors, close = _cell(table)
    sets = _sets(table["text"])
    a, b = [], []
    for i in minors:
        for j in close(i).tolist():
            if group[j] != group[i] and jaccard(sets[i], sets[j]):
                a.append(rep[i])
                b.append(rep[j])
                group[group == group[j]] = group[i]
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def link(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, n_shingles, component_id, kept for every row."""
    spark = docs.sparkSession
    settings(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    marks = cut(docs.mapInArrow(_sketch, "doc_id long, n_shingles long, f1 long, f2 long, bands array<long>, sig binary"))
    classes = cut(marks.where("f1 is not null").groupBy("f1", "f2")
                  .agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("size"),
                       F.first("bands").alias("bands"), F.first("sig").alias("sig")).where("rep is not null"))

    members = classes.select("rep", F.explode("bands").alias("bucket"))
    crowded = members.groupBy("bucket").agg(F.min("rep").alias("least"), F.max("rep").alias("most")).where("least < most")
    members = cut(members.join(cut(crowded), "bucket"))  # only buckets of two or more
    docs = docs.where("text is not null and doc_id is not null")
    # each representative with the least of a bucket that it shares most buckets with; signatures decide
    # which of these pairs are worth their texts
    shared = members.where("rep > least").groupBy(F.col("rep").alias("a"), F.col("least").alias("b")).agg(F.count(F.lit(1)).alias("n"))
    stars = cut(shared.groupBy("a").agg(F.max(F.struct("n", (-F.col("b")).alias("b"))).alias("top")).select("a", (-F.col("top.b")).alias("b")))
    sides = classes.select("rep", "sig")
    stars = cut(stars.join(sides.select(F.col("rep").alias("a"), F.col("sig").alias("sa")), "a")
                .join(sides.select(F.col("rep").alias("b"), F.col("sig").alias("sb")), "b")
                .select("a", "b", "sa", "sb").mapInArrow(_alike, "a long, b long"))
    texts = cut(moved(docs, stars.select(F.col("a").alias("id")).union(stars.select(F.col("b").alias("id")))))
    pairs = (texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")).join(stars, "a")
             .join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", "tb"))
    links = cut(pairs.mapInArrow(_confirm, "a long, b long"))
    discard(texts)
    comps = components(links)

    placed = cut(members.select("bucket", "rep").join(
        comps.select(F.col("node").alias("rep"), F.col("component").alias("comp")), "rep", "left")
        .select("bucket", "rep", F.coalesce("comp", "rep").alias("comp")))
    # buckets of several components: the largest one is the major, pairs inside it are settled
    mixed = cut(placed.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("n")).groupBy("bucket")
                .agg(F.max(F.struct("n", "comp")).alias("top"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds"))
                .where("kinds > 1")
                .select("bucket", F.col("top.comp").alias("major"), F.ceil(F.col("top.n") / BLOCK).alias("majors"),
                        F.ceil((F.col("n") - F.col("top.n")) / BLOCK).alias("minors")))
    rest = placed.join(mixed, "bucket").withColumn(
        "own", F.pmod(F.xxhash64("rep"), F.when(F.col("comp") == F.col("major"), F.col("majors")).otherwise(F.col("minors"))))

    def cells(kind: str, blocks: str, low, high, side):
        return F.transform(F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1), lambda k: F.struct(
            F.xxhash64(F.col("bucket"), F.lit(kind), low(k), high(k)).alias("cell"), side.alias("side")))

    own, other = F.col("own"), F.lit(-1).cast("long")
    # a major block meets every minor block, minor blocks meet each other: no row is doubled by the major's size
    goes = F.when(F.col("comp") == F.col("major"), cells("major", "minors", lambda k: k, lambda k: own, other)).otherwise(
        F.concat(cells("major", "majors", lambda k: own, lambda k: k, own),
                 cells("minor", "minors", lambda k: F.least(own, k), lambda k: F.greatest(own, k), own)))
    dealt = (rest.select("rep", "comp", F.explode(goes).alias("to")).select("rep", "comp", "to.side", "to.cell")
             .join(classes.select("rep", "sig"), "rep"))
    # signatures alone tell which members need their text there
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    near = cut(dealt.repartition(tasks, "cell").groupBy("cell")
               .applyInArrow(_near, "rep long, comp long, side long, cell long, sig binary"))
    more = cut(near.join(moved(docs, near.select(F.col("rep").alias("id"))).select(F.col("doc_id").alias("rep"), "text"), "rep")
               .repartition(tasks, "cell").groupBy("cell").applyInArrow(_block_links, "a long, b long"))
    if not more.isEmpty():
        comps = components(links.union(more))
    for df in (members, stars, placed, near):
        discard(df)

    known = cut(classes.select("f1", "f2", "rep").join(
        comps.select(F.col("node").alias("rep"), "component"), "rep", "left")
        .select("f1", "f2", F.coalesce("component", "rep").alias("component_id")))
    own = F.coalesce("component_id", "doc_id")
    return (marks.select("doc_id", "n_shingles", "f1", "f2").join(known, ["f1", "f2"], "left")
            .select("doc_id", "n_shingles", own.alias("component_id"),
                    F.coalesce(F.col("doc_id") == own, own.isNull()).alias("kept")))
