"""Operator 11: cross-tokenizer alignment by byte offsets, Arrow-native.

Every text is encoded by tokenizer A (byte-level BPE, space + text) and B
(sentence pieces, which add the space themselves).  The tokens of a batch are
flattened with their parent (document) indices; token ends in bytes are
cumulative sums restarted at each document; an Acero hash join of the two
(document, end) tables finds the offsets where a token of A and one of B both
end.  The exclusive running sum of those marks is the group number of each
token.  All A-B pairs of a group are links.

Counting: a task puts documents of about ``BLOCK`` bytes into one block and adds
up, with ``Table.group_by``, in how many of its documents each id pair is
linked; Spark sums the blocks' partial counts and takes the highest count of each
A id (at most one row per id of A's vocabulary, the only broadcast).  Counts go
back to the blocks that asked for them - once per block, not per link - and each
block, bounded in bytes, adds them up for its documents.

Defined results: a text that is null or empty, or whose joined token bytes of A
or B are not space + text (say a text with U+2581), has no tokens: zeros and an
empty hash.  Repeated rows and ids count as documents of their own; null ids are
carried; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualis.llm import byte_tokens as B
from qualis.llm import text as T
from qualis.llm.session import cut, settings

PIECES = "piece_bpe_32k.model"
BLOCK = 1 << 22  # bytes of text of a block (a longer text is a block of its own)
PAIRS = 1 << 20  # links that are made at once
WIDE = 256  # links of a group from which equal ids of a group are put together first
STRIDE = 32_000  # a pair's code: A id * STRIDE + B id; it must hold B's ids, and all codes must be under 2^32


def default_paths() -> tuple[str, str, str]:
    import public_tokenizers
    return *B.default_paths(), public_tokenizers.path(PIECES)


class _Vocabulary:
    """The bytes of every token of a vocabulary."""

    def __init__(self, tokens: list[bytes]):
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.bytes = np.empty(len(tokens), object)
        self.bytes[:] = tokens
        self.names = pa.array([str(i) for i in range(len(tokens))])

    def spells(self, rows: list[np.ndarray], data: bytes, offsets: np.ndarray) -> np.ndarray:
        """For each text of a slice whether the bytes of its tokens are a space and the text."""
        counts = np.array([len(x) for x in rows])
        ids = np.concatenate(rows)
        long = T.row_sums(self.size[ids], np.concatenate([[0], np.cumsum(counts)]))
        out = long == np.diff(offsets) + 1
        got = b"".join(self.bytes[ids if out.all() else ids[np.repeat(out, counts)]].tolist())
        want = b"".join([b" " + data[i:j] for i, j in zip(offsets[:-1][out].tolist(), offsets[1:][out].tolist(), strict=True)])
        if got != want:
            other = np.frombuffer(got, np.uint8) != np.frombuffer(want, np.uint8)
            out[out] = T.row_sums(other, np.concatenate([[0], np.cumsum(long[out])])) == 0
        return out


class Pair:
    """Both tokenizers of a worker."""

    def __init__(self, json_path: str, ranks_path: str, model_path: str):
        import sentencepiece
        self.a = B.loaded(json_path, ranks_path, plain_specials=True)
        self.b = sentencepiece.SentencePieceProcessor(model_file=model_path)
        pieces = []
        for i in range(self.b.get_piece_size()):
            p = self.b.id_to_piece(i)
            pieces.append(bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode())
        self.vocab_a, self.vocab_b = _Vocabulary(self.a.token_bytes), _Vocabulary(pieces)

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[pa.ListArray, pa.ListArray, np.ndarray]:
        """Id lists of A and B for the texts of a slice (none where the bytes do not
        come back), and which texts have tokens."""
        a = self.a.encode(raw, offsets, " ")
        data = raw.tobytes()
        b = self.b.encode([data[i:j].decode() for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)],
                          num_threads=1)
        b = [np.asarray(array("I", x)) for x in b]
        good = np.diff(offsets) > 0
        for ids, vocab in ((a, self.vocab_a), (b, self.vocab_b)):
            good &= vocab.spells(ids, data, offsets)
        return *(_lists([x if g else x[:0] for x, g in zip(ids, good, strict=True)]) for ids in (a, b)), good


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    off = np.concatenate([[0], np.cumsum([len(x) for x in rows])])
    return pa.LargeListArray.from_arrays(pa.array(off, pa.int64()), pa.array(np.concatenate(rows), pa.uint32()))


_LOADED: dict[tuple, Pair] = {}


def loaded(paths: tuple[str, str, str]) -> Pair:
    if paths not in _LOADED:
        _LOADED[paths] = Pair(*paths)
    return _LOADED[paths]


def _ends(lists: pa.ListArray, sizes: np.ndarray) -> pa.Table:
    """All tokens of a slice: doc, id, at (place in the slice), and key, the document's
    number in the slice above the byte offset inside it where the token ends."""
    ids, doc = pc.list_flatten(lists), pc.list_parent_indices(lists).cast(pa.int64())
    run = pc.cumulative_sum(pc.take(pa.array(sizes), ids))
    count = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    before = np.concatenate([[0], run.to_numpy(zero_copy_only=False)])[np.cumsum(count) - count]
    # segment restart: take off what stood before the document
    end = pc.subtract(run, pc.take(pa.array(before), doc))
    key = pc.bit_wise_or(pc.shift_left(doc, 32), end)
    return pa.table({"key": key, "doc": doc, "id": ids, "at": pa.array(np.arange(len(ids)))})


def _grouped(a: pa.Table, b: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The tokens of A that end where one of B ends, and the group of each token of A and of B
    (groups are numbered through the slice)."""
    both = a.select(["key", "at"]).join(b.select(["key", "at"]).rename_columns(["key", "other"]), keys="key",
                                        join_type="inner", use_threads=False)
    out = []
    for table, column in ((a, "at"), (b, "other")):
        mark = np.zeros(table.num_rows, np.int64)
        mark[both[column].to_numpy()] = 1
        out.append(mark)
    groups = [pc.subtract(pc.cumulative_sum(pa.array(m)), pa.array(m)).to_numpy() for m in out]
    return np.flatnonzero(out[0]), *groups


def _starts(group: np.ndarray, n: int) -> np.ndarray:
    """Where each of ``n`` groups starts among tokens in the order of their groups, and the end of the last."""
    return np.concatenate([[0], np.cumsum(np.bincount(group, minlength=n)[:n])])


def _text_of(groups: list[tuple[np.ndarray, pa.Array, pa.Array]], docs: np.ndarray, rows: int) -> pa.Array:
    """``a1,a2|b1;a3|b2,b3`` for each document: per side (group of each token, ids, names)."""
    n = len(docs)
    sides = []
    for group, ids, names in groups:
        off = _starts(group, n)
        words = pa.LargeListArray.from_arrays(pa.array(off, pa.int64()), pc.take(names, ids).cast(pa.large_string()))
        sides.append(pc.binary_join(words, pa.scalar(",", pa.large_string())))
    both = pc.binary_join_element_wise(*sides, pa.scalar("|", pa.large_string()))
    by_doc = pa.LargeListArray.from_arrays(pa.array(np.searchsorted(docs, np.arange(rows + 1)), pa.int64()), both)
    return pc.binary_join(by_doc, pa.scalar(";", pa.large_string()))


def _links(groups: list[tuple[np.ndarray, pa.Array]], docs: np.ndarray) -> pa.Table:
    """(key, n), sorted: how often each id pair is linked in each document; the key is the
    document's number in the slice above the pair's code."""
    off = [_starts(g, len(docs)) for g, _ in groups]
    times = None
    if len(docs) and (np.diff(off[0]) * np.diff(off[1])).max() > WIDE:  # equal ids of a group once, with their number
        groups = [_repeats(*side) for side in groups]
        off = [_starts(g, len(docs)) for g, _, _ in groups]
        times = [n for _, _, n in groups]
    (ga, ia), (gb, ib) = ((g[0], g[1].to_numpy(zero_copy_only=False).astype(np.int64)) for g in groups)
    partners = np.diff(off[1])[ga]  # for each A id of a group: how many B ids it meets
    done = np.concatenate([[0], np.cumsum(partners)])
    parts, i = [], 0
    while i < len(ga):  # bounded products
        j = max(i + 1, int(np.searchsorted(done, done[i] + PAIRS, "right")) - 1)
        a = np.repeat(np.arange(i, j), partners[i:j])
        b = T.ranges(off[1][ga[i:j]], partners[i:j])
        t = pa.table({"key": docs[ga[a]] << 32 | ia[a] * STRIDE + ib[b],
                      "n": times[0][a] * times[1][b] if times else np.ones(len(a), np.int64)})
        parts.append(_sums(t))
        i = j
    t = parts[0] if len(parts) == 1 else _sums(pa.concat_tables(parts)) if parts else \
        pa.table({"key": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
    return t.sort_by("key").combine_chunks()


def _sums(t: pa.Table) -> pa.Table:
    return t.group_by("key", use_threads=False).aggregate([("n", "sum")]).rename_columns(["key", "n"])


def _repeats(group: np.ndarray, ids: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    t = pa.table({"group": group, "id": ids}).group_by(["group", "id"], use_threads=False).aggregate([([], "count_all")])
    t = t.sort_by("group").combine_chunks()
    return t["group"].to_numpy(), t["id"].combine_chunks(), t["count_all"].to_numpy()


def _slice(tool: Pair, ids: pa.Array, raw: np.ndarray, offsets: np.ndarray) -> tuple[pa.Table, pa.Table, np.ndarray]:
    """Digest columns of each document, the slice's links, and where each document's links start."""
    la, lb, good = tool.encode(raw, offsets)
    rows = len(offsets) - 1
    ta, tb = _ends(la, tool.vocab_a.size), _ends(lb, tool.vocab_b.size)
    ends, ga, gb = _grouped(ta, tb)
    docs = ta["doc"].to_numpy()[ends]  # of each group
    a, b = ta["id"].combine_chunks(), tb["id"].combine_chunks()
    texts = _text_of([(ga, a, tool.vocab_a.names), (gb, b, tool.vocab_b.names)], docs, rows)
    links = _links([(ga, a), (gb, b)], docs)
    off = np.searchsorted(links["key"].to_numpy(), np.arange(rows + 1) << 32)
    digest = [hashlib.sha256(t.encode()).hexdigest() if g else "" for t, g in zip(texts.to_pylist(), good.tolist(), strict=True)]
    n_a, n_b = (pc.list_value_length(x).cast(pa.int64()) for x in (la, lb))
    return pa.table({
        "doc_id": ids, "n_a": n_a, "n_b": n_b, "n_groups": pa.array(np.bincount(docs, minlength=rows), pa.int64()),
        "n_links": pa.array(T.row_sums(links["n"].to_numpy(), off), pa.int64()), "groups_sha256": pa.array(digest),
        "groups": texts}), links, off


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers under 2^32, byte planes first so that small ones cost little."""
    return zlib.compress(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _align(paths: tuple[str, str, str], with_groups: bool):
    def run(batches):
        tool = loaded(paths)
        block = 0
        for table in B.joined(batches, BLOCK):
            raw, off = T.utf8(table.column(1))
            ids = table.column(0)
            task = int(table.column(2)[0].as_py()) << 32
            for lo, hi in T.slices(off, BLOCK):
                done = []
                for i, j in T.slices(off[lo:hi + 1], T.SLICE):
                    i, j = i + lo, j + lo
                    done.append(_slice(tool, ids.slice(i, j - i), raw[off[i]:off[j]], off[i:j + 1] - off[i]))
                yield from _block(task + block, done, ids.type, with_groups)
                block += 1
    return run


def _block(block: int, done: list, id_type: pa.DataType, with_groups: bool):
    """The rows of a block: its documents, whose links name the block's pairs by their place
    among its sorted codes, and its pairs with the number of its documents that have them."""
    code = np.concatenate([links["key"].to_numpy() for _, links, _ in done]) & ((1 << 32) - 1)
    pairs = pa.array(code).dictionary_encode()
    known, which = pairs.dictionary.to_numpy(), pairs.indices.to_numpy()
    order = np.argsort(known)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    places, docs, at = rank[which], np.bincount(which, minlength=len(known))[order], 0
    for rows, links, off in done:
        place, times = places[at:at + links.num_rows], links["n"].to_numpy()
        at += links.num_rows
        low, high = times & 0xFFFFFFFF, times >> 32
        steps = np.diff(place, prepend=0)  # ascending in a document: the steps are small
        starts = off[:-1][np.diff(off) > 0]
        steps[starts] = place[starts]
        held = [None if i == j else _packed(np.concatenate([steps[i:j], low[i:j], high[i:j]]))
                for i, j in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
        yield from _out(rows.append_column("links", pa.array(held, pa.binary())), block, id_type, with_groups)
    yield from _out(pa.table({"code": known[order], "docs": docs}), block, id_type, with_groups)


_COLUMNS = [("doc_id", None), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
            ("groups_sha256", pa.string()), ("groups", pa.large_string()), ("links", pa.binary()),
            ("code", pa.int64()), ("docs", pa.int64())]


def _out(table: pa.Table, block: int, id_type: pa.DataType, with_groups: bool):
    """Rows of one of the two kinds: a document with its links, or a block's count of a pair."""
    n = table.num_rows
    cols = {"block": pa.array(np.full(n, block, np.int64))}
    for name, kind in _COLUMNS:
        if name == "groups" and not with_groups:
            continue
        cols[name] = table[name] if name in table.column_names else pa.nulls(n, kind or id_type)
    cols = {k: pc.cast(v, pa.string()) if k == "groups" else v for k, v in cols.items()}
    yield from pa.table(cols).combine_chunks().to_batches()


def _total(rows: pa.Table, known: pa.Table) -> pa.Table:
    """The documents of a block with the sums over their links (``known``: code, n, best
    of all the block's pairs)."""
    known = known.sort_by("code")
    out = np.zeros((rows.num_rows, 2), np.int64)
    values = [known[c].to_numpy() for c in ("best", "n")]
    for i, data in enumerate(rows["links"].to_pylist()):
        if data is not None:
            steps, low, high = _unpacked(data).reshape(3, -1)
            place = np.cumsum(steps)
            out[i] = [int(((high << 32 | low) * v[place]).sum()) for v in values]
    cols = {c: rows[c] for c in rows.column_names if c not in ("block", "links")}
    return pa.table(cols | {"n_best": pa.array(out[:, 0]), "count_sum": pa.array(out[:, 1])})


def pair_counts(partial: DataFrame) -> DataFrame:
    """(code, a, b, n): in how many documents each A id is linked with each B id."""
    return (partial.groupBy("code").agg(F.sum("docs").alias("n"))
            .select("code", (F.col("code") / STRIDE).cast("long").alias("a"), (F.col("code") % STRIDE).alias("b"), "n"))


def align(docs: DataFrame, paths: tuple[str, str, str] | None = None, with_groups: bool = False) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256, (groups,) n_best, count_sum for every row of ``docs``."""
    settings(docs.sparkSession)
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.spark_partition_id().alias("part"))
    head = (f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_a long, n_b long, n_groups long, n_links long, "
            "groups_sha256 string" + ", groups string" * with_groups)
    rows = cut(docs.mapInArrow(_align(paths or default_paths(), with_groups),
                               f"block long, {head}, links binary, code long, docs long"))
    partial = rows.where("code is not null").select("block", "code", "docs")
    counts = cut(pair_counts(partial))
    top = counts.groupBy("a").agg(F.max("n").alias("top"))  # one row per id of A's vocabulary
    known = (counts.join(F.broadcast(top), "a")
             .select("code", "n", (F.col("n") == F.col("top")).cast("long").alias("best")))
    asked = partial.select(F.col("block").alias("asker"), "code").join(known, "code")
    return (rows.where("code is null").drop("code", "docs").groupBy("block").cogroup(asked.groupBy("asker"))
            .applyInArrow(_total, f"{head}, n_best long, count_sum long"))
