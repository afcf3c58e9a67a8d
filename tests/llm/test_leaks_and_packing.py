"""Operators 4 and 6: Smith-Waterman in plain Python, planted copies, exact token round trips."""
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import frame, have_data  # noqa: F401
from tokenizers import Tokenizer

from qualis.llm import decontam as D
from qualis.llm import packing as K
from qualis.llm import text as T

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def plain_score(a, b):
    h, best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)], 0
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            h[i + 1][j + 1] = max(0, h[i][j] + (D.MATCH if x == y else D.MISS), h[i][j + 1] + D.GAP, h[i + 1][j] + D.GAP)
            best = max(best, h[i + 1][j + 1])
    return best


@pytest.mark.parametrize("cells", [64, 1 << 20])
def test_alignment_equals_plain_smith_waterman(monkeypatch, cells):
    monkeypatch.setattr(D, "_CELLS", cells)
    rng = np.random.default_rng(4)
    a = [rng.integers(0, 5, rng.integers(1, 14)) for _ in range(150)]
    b = [rng.integers(0, 5, rng.integers(1, 25)) for _ in range(150)]
    flat = lambda rows: (np.concatenate(rows).astype(np.uint64) * np.uint64(16),
                         np.concatenate([[0], np.cumsum([len(r) for r in rows])]))
    assert D.align(*flat(a), *flat(b)).tolist() == [plain_score(x.tolist(), y.tolist()) for x, y in zip(a, b, strict=True)]


@pytest.fixture(scope="module")
def leaks(spark, frame):
    rng = random.Random(8)
    vocab = [f"term{k}" for k in range(2000)]
    items = [[rng.choice(vocab) for _ in range(rng.choice([12, 30, 60]))] for _ in range(15)]
    say = lambda n: [rng.choice(vocab) for _ in range(n)]
    docs, want = [], set()
    for d in range(120):
        k, kind = rng.randrange(len(items)), d % 6
        if kind == 0:  # whole copy, other case and punctuation
            body = say(50) + [w.upper() + "," for w in items[k]] + say(30)
        elif kind == 1:  # every eighth word replaced
            body = say(20) + [w if i % 8 else "other" for i, w in enumerate(items[k])]
        elif kind == 2:  # words dropped and put in
            body = [x for i, w in enumerate(items[k]) for x in ([] if i % 9 == 4 else [w, "plus"] if i % 9 == 7 else [w])]
        elif kind == 3:  # a few words only: no copy
            body = say(40) + items[k][:4] + say(40)
        else:
            body = say(80)
        if kind < 3:
            want.add((d, k))
        docs.append((d, " ".join(body)))
    docs += [(900 + n, " ".join(say(9) + items[0] + say(9))) for n in range(200)]  # one item in very many documents
    want |= {(900 + n, 0) for n in range(200)}
    return frame(docs, DOCS), spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], ITEMS), want, items


def test_planted_copies_are_found_and_nothing_else(leaks):
    docs, items, want, _ = leaks
    got = D.links(docs.repartition(3), items).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want)
    assert all(r.score == 1.0 for r in got if r.doc_id >= 900) and min(r.score for r in got) >= D.THRESHOLD


@pytest.mark.parametrize("times", [21, 1000])
def test_recurring_edited_and_short_copies_are_found(spark, frame, times):
    rng = random.Random(5)
    say = lambda n: [f"w{rng.randrange(50_000)}" for _ in range(n)]
    items = [say(40), say(40), say(5)]
    edited = [w if i % 8 else "other" for i, w in enumerate(items[0])]
    half, near = items[1][:20], items[2][:3] + ["other"] + items[2][4:]
    docs = [(3 * d + k, " ".join(say(30) + copy + say(30))) for d in range(times) for k, copy in enumerate((edited, half, near))]
    docs.append((-1, " ".join(say(30) + items[0] + say(30))))
    got = {(r.doc_id, r.item_id) for r in D.links(frame(docs, DOCS), spark.createDataFrame(
        [(k, " ".join(w)) for k, w in enumerate(items)], ITEMS)).collect()}
    assert got == {(3 * d + k, k) for d in range(times) for k in range(3)} | {(-1, 0)}


def test_ordinary_words_are_no_copy_of_a_short_item(spark, frame):
    say = lambda d: f"a{d} b{d} one of the c{d} d{d}"
    docs = [(d, say(d)) for d in range(100)] + [(200, "x one of the green hills y")]
    items = spark.createDataFrame([(1, "one of the green hills"), (2, "one of the red green hills far away from here")], ITEMS)
    assert {(r.doc_id, r.item_id) for r in D.links(frame(docs, DOCS), items).collect()} == {(200, 1)}


@pytest.mark.parametrize("hits", [1, 40])
def test_hits_in_slices_give_the_same(leaks, monkeypatch, hits):
    docs, items, want, _ = leaks
    monkeypatch.setattr(D, "HITS", hits)
    d, own = docs.where("doc_id < 920").toPandas(), items.toPandas()
    seeds = D.Items(own["item_id"].tolist(), pa.array(own["text"]))
    row, item, score, _ = D.passages(pa.array(d["text"]), seeds)
    assert {(int(d["doc_id"][r]), seeds.ids[k]) for r, k in zip(row, item)} == {x for x in want if x[0] < 920}


def test_benchmark_in_parts_gives_the_same(leaks, monkeypatch):
    docs, items, want, _ = leaks
    monkeypatch.setattr(D, "PART_WORDS", 700)
    assert {(r.doc_id, r.item_id) for r in D.links(docs, items).collect()} == want


def test_leak_edge_rows(spark, frame, leaks):
    words = leaks[3][1]
    text = " ".join(words)
    docs = frame([(1, text), (1, text), (None, text), (2, None), (3, ""), (4, "short one"), (None, "clean text")], DOCS)
    items = spark.createDataFrame([(7, text), (7, text), (None, text), (8, None), (9, ""), (10, "a b c d")], ITEMS)
    got = sorted(((r.doc_id, r.item_id) for r in D.links(docs, items).collect()), key=str)
    assert got == sorted([(a, b) for a in (1, 1, None) for b in (7, 7, None)], key=str)
    left = D.decontaminate(docs, items)
    assert left.columns == docs.columns
    assert sorted(map(str, (r.doc_id for r in left.collect()))) == ["2", "3", "4", "None"]
    assert D.links(docs, items.limit(0)).count() == 0 and D.links(docs.limit(0), items).count() == 0


ODD = ["", None, "Hello World's it'll don't", "é È ß Ÿ ÿ × ÷ ñ", "a<|endoftext|>b x", "<|startoftext|> hi", "1 23a4,5..6 _ - ''",
       "\x00\x01 \x1c x\x1fy \x7f", "日本語 テスト ΑΣ Σ", "é àb", " nb sp\u0085z", "ª º µ ¼ ²", "🙂 🙂x",
       "İI ıi", "%%% the&&& *** |", "À'S d'é", "\xc3\xa9 Ã ã", "x" * 300]


@pytest.fixture(scope="module")
def tool():
    return Tokenizer.from_file(K.default_path())


def test_ids_equal_the_tokenizer(tool, monkeypatch):
    rng = random.Random(2)
    texts = ODD + [" ".join(rng.choice(["The", "ing", "A1b", "don't", "éé!", "…", "x,y", "#"]) for _ in range(60)) for _ in range(40)]
    own = K.Ids(K.default_path())
    for cache in (3_000_000, 20):  # a tiny cache is cleared all the time
        monkeypatch.setattr(K, "CACHE", cache)
        raw, off = T.utf8(pa.array(texts))
        for i, j in T.slices(off, 200):
            ids, cut = own.encode(raw[off[i]:off[j]], off[i:j + 1] - off[i])
            for k in range(j - i):
                want = tool.encode(texts[i + k] or "", add_special_tokens=False).ids
                assert ids[cut[k]:cut[k + 1]].tolist() == want, texts[i + k]


def test_pieces_are_binary_digits():
    for n in [1, 2, 3, 7, 2047, 2048, 2049, 5000, 10_000]:
        p = K.pieces(n)
        assert sum(p) == n and all(x & (x - 1) == 0 and x <= K.MAX for x in p) and p == sorted(p, reverse=True)
        assert len([x for x in p if x < K.MAX]) == bin(n % K.MAX).count("1")


def test_round_trip_of_whole_documents(spark, frame, tool):
    rows = [(k, t) for k, t in enumerate(ODD)] + [(50, "many words here " * 2000), (None, "no id"), (3, "again"), (3, "again")]
    got = K.pack(frame(rows, DOCS).repartition(3)).collect()
    seqs = [r.sequence_id for r in got]
    assert len(set(seqs)) == len(seqs) and all(r.offset == 0 and r.length & (r.length - 1) == 0 for r in got)
    assert all(r.sequence_id >> 58 == r.length.bit_length() - 1 for r in got)
    for r in got:
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and len(r.ids) == r.length
    docs = {}
    for r in sorted(got, key=lambda r: (str(r.doc_id), r.start)):
        docs.setdefault(r.doc_id, []).append(r)
    for k, t in rows:
        want = tool.encode(t or "", add_special_tokens=False).ids + [K.END]
        own = docs[k]
        if k == 3:
            assert sorted(r.doc_tokens for r in own if r.start == 0) == sorted(
                len(tool.encode(x or "", add_special_tokens=False).ids) + 1 for i, x in rows if i == 3)
            continue
        assert [x for r in own for x in r.ids] == want and all(r.doc_tokens == len(want) for r in own)
        assert [r.start for r in own] == list(np.cumsum([0] + [r.length for r in own])[:-1])
    assert K.pack(frame([], DOCS)).count() == 0
