"""Operators 11 to 13 against plain Python: token groups, item-by-item packing, phrase counts."""
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import MID, frame, have_data  # noqa: F401
from tokenizers import Tokenizer

from qualis.llm import alignment as A
from qualis.llm import bestfit as P
from qualis.llm import byte_tokens as B
from qualis.llm import collocation as C
from qualis.llm import text as T

DOCS = "doc_id long, text string"
ODD = [None, "", " ", "  ", "\n\n", "a▁b", "<|endoftext|> </s> <s> <unk> <0x41>", "日本語 テキスト😀 ﬁ  x\n\n\ty\x00z é é",
       " lead  and trail  ", "a" * 1500 + "  " * 300, "it's we'll I'D", "naïve café Ünï÷×", "x\x1fy\x85z w", "1234567 890,12"]


def tool(plain):
    t = Tokenizer.from_file(B.default_paths()[0])
    t.encode_special_tokens = plain
    return t


def fast(texts, plain, prefix=""):
    raw, off = T.utf8(pa.array(texts, pa.string()))
    return [x.tolist() for x in B.loaded(*B.default_paths(), plain).encode(raw, off, prefix)]


@pytest.mark.parametrize("plain", [True, False])
def test_byte_ids_equal_the_tokenizer(spark, have_data, plain):
    texts = [r.text for r in spark.read.parquet(f"{MID}/documents.parquet").select("text").collect()][:400] + ODD
    texts = [t or "" for t in texts]
    assert fast(texts, plain) == [x.ids for x in tool(plain).encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n'.,<|>aZé÷1\t\xa0ß"), st.characters(codec="utf-8")), max_size=40))
def test_byte_ids_of_any_text(text):
    assert fast([text], True, " ") == [tool_plain.encode(" " + text, add_special_tokens=False).ids]


tool_plain = tool(True)


def plain_alignment(rows):
    pair = A.loaded(A.default_paths())
    spell = {c: i for i, c in B_UNICODE.items()}
    names = {i: t for t, i in tool_plain.get_vocab().items()}
    out, pairs = [], Counter()
    for doc, text in rows:
        text = text or ""
        ia, ib = tool_plain.encode(" " + text, add_special_tokens=False).ids, pair.b.encode(text)
        ba = [bytes(spell[c] for c in names[i]) for i in ia]
        bb = [bytes([int(pair.b.id_to_piece(i)[3:5], 16)]) if pair.b.is_byte(i) else pair.b.id_to_piece(i).replace("▁", " ").encode()
              for i in ib]
        if not text or {b"".join(ba), b"".join(bb)} != {(" " + text).encode()}:
            out.append((doc, [], [], []))
            continue
        ea, eb = (np.cumsum([len(x) for x in s]).tolist() for s in (ba, bb))
        groups, lo = [], 0
        for c in sorted(set(ea) & set(eb)):
            groups.append(tuple([i for i, e in zip(ids, ends) if lo < e <= c] for ids, ends in ((ia, ea), (ib, eb))))
            lo = c
        pairs.update({(x, y) for g in groups for x in g[0] for y in g[1]})
        out.append((doc, ia, ib, groups))
    best = defaultdict(int)
    for (x, _), n in pairs.items():
        best[x] = max(best[x], n)
    want = []
    for doc, ia, ib, groups in out:
        links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        mark = ";".join("|".join(",".join(map(str, s)) for s in g) for g in groups)
        want.append((doc, len(ia), len(ib), len(groups), len(links), sum(pairs[x] == best[x[0]] for x in links),
                     sum(pairs[x] for x in links), hashlib.sha256(mark.encode()).hexdigest() if ia else ""))
    return want


def _byte_unicode():
    """The public byte-to-character map of byte-level vocabularies: printable bytes stand
    for themselves, the others for the characters from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


B_UNICODE = _byte_unicode()


def key(row):
    return tuple((x is None, x if x is not None else 0) for x in row)


def test_alignment_equals_plain_python(spark, frame, have_data):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{MID}/documents.parquet").limit(60).collect()]
    rows += [(5000 + k, t) for k, t in enumerate(ODD)] + [(None, "the the of"), (5001, "of of"), (5001, "of of")]
    got = A.align(frame(rows, DOCS).repartition(6), with_groups=True).collect()
    assert all(r.groups_sha256 == (hashlib.sha256(r.groups.encode()).hexdigest() if r.n_a else "") for r in got)
    got = [(r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in got]
    assert sorted(got, key=key) == sorted(plain_alignment(rows), key=key)


def test_tokens_spell_a_space_and_the_text():
    vocab = A._Vocabulary([b" a", b"b", b" ", b"xyz", b"\xc3\xa4"])
    cases = [([0, 1], "ab", True), ([0, 4], "ab", False), ([0, 3], "ab", False), ([], "", False), ([2], "", True),
             ([2, 4], "\u00e4", True), ([1, 0], "ab", False), ([2, 3, 1], "xyzb", True), ([0, 1], "bb", False)]
    for some in (cases, [c for c in cases if c[2]], [c for c in cases if not c[2]], [([], "", False)]):
        data = [t.encode() for _, t, _ in some]
        off = np.concatenate([[0], np.cumsum([len(t) for t in data])])
        got = vocab.spells([np.array(ids, np.uint32) for ids, _, _ in some], b"".join(data), off)
        assert got.tolist() == [good for _, _, good in some]


def test_pairs_of_a_block_are_counted_once_a_document():
    key = [(0, 7), (0, 9), (2, 5), (2, 7), (2, 1 << 31)], [(0, 7)], []
    done = []
    for keys, rows in zip(key, (3, 1, 2)):
        links = pa.table({"key": pa.array([d << 32 | c for d, c in keys], pa.int64()), "n": pa.array([(1 << 33) + 2] * len(keys), pa.int64())})
        off = np.array([sum(d < k for d, _ in keys) for k in range(rows + 1)])
        done.append((pa.table({"doc_id": pa.array(range(rows), pa.int64())}), links, off))
    out = [r for b in A._block(4, done, pa.int64(), False) for r in b.to_pylist()]
    assert [(r["code"], r["docs"]) for r in out if r["code"] is not None] == [(5, 1), (7, 3), (9, 1), (1 << 31, 1)]
    held = [r["links"] for r in out if r["code"] is None]
    assert [h is None for h in held] == [False, True, False, False, True, True]
    steps, low, high = A._unpacked(held[2]).reshape(3, -1).tolist()
    assert (steps, low, high) == ([0, 1, 2], [2] * 3, [2] * 3)


def test_alignment_of_no_rows(frame):
    assert A.align(frame([], DOCS)).collect() == []


@pytest.mark.parametrize("wide", [0, 1 << 30])
def test_many_partners_in_one_group_are_all_linked(monkeypatch, wide):
    monkeypatch.setattr(A, "PAIRS", 7)
    monkeypatch.setattr(A, "WIDE", wide)
    rng = random.Random(3)
    groups = [([rng.randrange(9) for _ in range(rng.randint(1, 12))], [rng.randrange(9) for _ in range(rng.randint(1, 12))])
              for _ in range(40)]
    docs = np.sort(np.array([rng.randrange(5) for _ in groups]))
    sides = [(np.repeat(np.arange(40), [len(g[s]) for g in groups]), pa.array([x for g in groups for x in g[s]], pa.uint32()))
             for s in (0, 1)]
    want = Counter(int(d) << 32 | x * A.STRIDE + y for d, g in zip(docs, groups) for x in g[0] for y in g[1])
    got = A._links(sides, docs)
    assert {r["key"]: r["n"] for r in got.to_pylist()} == dict(want)
    assert got["key"].to_pylist() == sorted(got["key"].to_pylist())


def item_by_item(items, capacity):
    items = sorted(items, reverse=True)
    large, small, gaps = [x for x in items if 3 * x > capacity], [x for x in items if 3 * x <= capacity], []
    while large:
        a = large.pop(0)
        b = next((x for x in large if x <= capacity - a), 0)
        if b:
            large.remove(b)
        gaps.append(capacity - a - b)
    for x in small:
        fit = min((g for g in gaps if g >= x), default=None)
        if fit is None:
            gaps.append(capacity - x)
        else:
            gaps[gaps.index(fit)] -= x
    return len(gaps)


@pytest.mark.parametrize("capacity", [7, 10, 30, 64, 101])
def test_plan_equals_packing_item_by_item(capacity):
    rng = random.Random(capacity)
    for _ in range(150):
        items = [rng.randint(1, capacity if rng.random() < 0.6 else capacity // 4 + 1) for _ in range(rng.randint(0, 80))]
        counts = Counter(items)
        runs, total = P.plan(counts, capacity)
        assert total == item_by_item(items, capacity)
        taken = defaultdict(list)
        by_size = defaultdict(list)
        for size, rank, first, per, offset in sorted(runs):
            by_size[size].append((rank, first, per, offset))
        for size, n in counts.items():
            starts = by_size[size] + [(n, 0, 1, 0)]
            for (rank, first, per, offset), (end, *_) in zip(starts, starts[1:]):
                for g in range(end - rank):
                    taken[first + g // per].append((offset + g % per * size, size))
        assert sorted(taken) == list(range(total))
        for parts in taken.values():
            at = 0
            for offset, size in sorted(parts):
                assert offset == at
                at += size
            assert at <= capacity


def test_number_of_runs_follows_the_capacity_not_the_items():
    counts = {s: 10 ** 9 + 7 * s for s in range(1, 1025)}
    runs, total = P.plan(counts)
    assert len(runs) < 20_000
    assert total * 1024 < 1.01 * sum(s * n for s, n in counts.items())


def test_bestfit_packs_every_token_once(spark, frame, have_data):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{MID}/documents.parquet").limit(200).collect()]
    rows += [(5000 + k, t) for k, t in enumerate(ODD)] + [(None, "no id"), (5001, "again"), (5002, "lone " * 9000)]
    got = P.pack(frame(rows, DOCS).repartition(5)).collect()
    ids = {}
    for doc, text in rows:
        ids.setdefault(doc, []).append(tool(False).encode(text or "", add_special_tokens=False).ids + [P.END])
    held = defaultdict(list)
    for r in got:
        assert r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        held[r.doc_id].append((r.piece, r.start, r.ids))
    for doc, want in ids.items():
        assert Counter(tuple(x) for _, _, x in held[doc]) == Counter(
            tuple(w[a:b]) for w in want for a, b in zip(*[iter(_cuts(w))] * 2))
        if len(want) == 1:
            parts = sorted(held[doc])
            assert [p[0] for p in parts] == list(range(len(parts)))
            assert [p[1] for p in parts] == [sum(len(x[2]) for x in parts[:i]) for i in range(len(parts))]
            assert all(len(p[2]) == P.CAPACITY for p in parts[1:])
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for parts in places.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= P.CAPACITY
    assert len(places) == item_by_item([r.length for r in got], P.CAPACITY)


def _cuts(w):
    at = 0
    for n in P.cuts(len(w)):
        yield at
        at += n
        yield at


def test_bestfit_of_no_rows(frame):
    assert P.pack(frame([], DOCS), with_ids=False).collect() == []


LANGS = "doc_id long, text string, lang string"


def plain_phrases(rows, least, top):
    f, size = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            size[lang] += len(w)
            for k in range(1, 5):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, count in f.items():
        cand = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        rows_ = []
        for p, a in cand.items():
            if any(100 * b >= 80 * a for q, b in cand.items() if len(q) > len(p)
                   and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))):
                continue
            score, k = min((2_000_000 * a // (count[p[:k]] + count[p[k:]]), k) for k in range(1, len(p)))
            rows_.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        out += [(lang, n + 1, p.decode(), -a, x, y, size[lang], -s) for n, (s, a, p, x, y) in enumerate(sorted(rows_)[:top])]
    return sorted(out)


def phrase_rows(rng, n):
    vocab = [f"w{k}" for k in range(25)] + ["É", "ZEBRA", "ß"]
    fixed = [["new", "york", "stock", "exchange"], ["as", "well", "as"], ["of", "the"], ["La", "la", "la", "la", "la"]]
    rows = []
    for d in range(n):
        words = []
        for _ in range(rng.randint(0, 30)):
            words += rng.choice(fixed) if rng.random() < 0.3 else [rng.choice(vocab)]
            if rng.random() < 0.2:
                words[-1] += rng.choice(".,;:!?\n")
        text = "".join(w + rng.choice([" ", "  ", "\t", " "]) for w in words)
        rows.append((d, rng.choice([text, text.upper()]), rng.choice(["en", "en", "en", "de", None])))
    return rows + [(None, None, "en"), (n, "", "fr"), (n, " . , ", "de"), (3, "as well as", "as well as"), (3, "a\x00b c", "x")]


@pytest.mark.parametrize("least,top", [(6, 2000), (2, 25), (30, 2000)])
def test_phrases_equal_plain_counts(frame, least, top):
    rows = phrase_rows(random.Random(least), 300)
    got = C.mine(frame(rows, LANGS).repartition(7), least, top).collect()
    assert sorted(tuple(r) for r in got) == plain_phrases(rows, least, top)


def test_phrases_of_nothing(frame):
    assert C.mine(frame([], LANGS)).collect() == []
    assert C.mine(frame([(1, None, None), (2, "", "en")], LANGS)).collect() == []


@pytest.mark.parametrize("limit", [3, 8, 50])
def test_runs_of_a_long_text_hold_every_phrase_once(limit):
    rng = random.Random(limit)
    text = "".join(rng.choice(["ab ", "c", "de. ", "  ", "f\n", "ghijklmnop "]) for _ in range(400))
    raw, off = T.utf8(pa.array(["x y", text, "z"]))

    def grams(runs):
        out = Counter()
        for w in runs:
            for k in (1, 2, 3, 4):
                for i in range(len(w.hash) - k + 1):
                    if i + k > w.carried and w.piece[i] == w.piece[i + k - 1]:
                        out[tuple(w.hash[i:i + k].tolist())] += 1
        return out
    lang = np.zeros(3, np.int64)
    assert grams(C._runs(raw, off, lang, 0, limit)) == grams(C._runs(raw, off, lang, 0))


@pytest.mark.parametrize("step", range(13))
def test_a_window_stays_open_whatever_else_marks_its_slots(step):
    """Marks of other phrases in a slot may open a window, they never close one."""
    rng = np.random.default_rng(step)
    first, rest = rng.integers(0, step + 1, (2, 3000))
    start = np.maximum(first, rest)
    alone = (np.uint16(1) << first.astype(np.uint16)) * (first > 0), (np.uint16(1) << rest.astype(np.uint16)) * (rest > 0)
    due = (first > 0) & (rest > 0) & (start <= step) & (step < start + C.SHARDS)
    assert np.array_equal(C._open(*alone, step), due)
    noise = rng.integers(0, 1 << (step + 1), (2, 3000)).astype(np.uint16) & np.uint16(0xFFFE)
    assert C._open(alone[0] | noise[0], alone[1] | noise[1], step)[due].all()
