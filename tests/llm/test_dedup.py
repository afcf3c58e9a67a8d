"""SuperMinHash groups against all pairs in plain Python."""
import random

import numpy as np
import pytest
from llm_cases import frame, have_data  # noqa: F401
from test_text import plain_words

from qualis.llm import superminhash as S
from qualis.llm.components import components

SCHEMA = "doc_id long, text string"


def brute(rows):
    sets = {}
    for i, t in rows:
        w = plain_words(t)
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}
    ids = sorted(sets)
    comp = {i: {i} for i in ids}
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            inter = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * inter >= 75 * len(sets[a] | sets[b]):
                both = comp[a] | comp[b]
                for z in both:
                    comp[z] = both
    return {i: (len(sets[i]), min(comp[i]), min(comp[i]) == i) for i in ids}


def edited(rng, words, share):
    return " ".join(w if rng.random() > share else f"x{rng.randint(0, 99999)}" for w in words)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(11)
    vocab = [f"w{k}" for k in range(900)]
    rows, n = [], 0
    for _ in range(14):
        base = [rng.choice(vocab) for _ in range(rng.choice([6, 40, 200]))]
        rows.append(" ".join(base))
        rows += [" ".join(base)] * rng.choice([0, 3])  # exact copies
        rows += [edited(rng, base, s) for s in (0.01, 0.02, 0.03, 0.05, 0.2)]
        chain = base  # each near the one before, ends far apart
        for _ in range(5):
            chain = chain[3:] + [rng.choice(vocab) for _ in range(3)]
            rows.append(" ".join(chain).upper())
    rows += [None, "", "  ", "a b", "A  b", "a b c", "one two three four five"]
    rng.shuffle(rows)
    return [(3 * n + 1, t) for n, t in enumerate(rows)]


@pytest.mark.parametrize("block", [4, S.BLOCK])
def test_components_equal_all_pairs(spark, frame, corpus, monkeypatch, block):
    monkeypatch.setattr(S, "BLOCK", block)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept)
           for r in S.link(frame(corpus, SCHEMA).repartition(4)).collect()}
    assert got == brute(corpus)


def test_nulls_repeats_and_empty_table(spark, frame):
    t = "one two three four five six seven"
    rows = [(5, t), (5, t), (None, t), (2, t.upper()), (None, "lonely words here"), (9, None), (9, None), (None, None)]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in S.link(frame(rows, SCHEMA)).collect()), key=str)
    assert got == sorted([(5, 3, 2, False), (5, 3, 2, False), (None, 3, 2, False), (2, 3, 2, True), (None, 1, None, True),
                          (9, 0, 9, True), (9, 0, 9, True), (None, 0, None, True)], key=str)
    assert S.link(frame([], SCHEMA)).count() == 0


def test_signature_estimates_similarity_with_low_error():
    rng = np.random.default_rng(0)
    got = []
    for _ in range(200):
        a = np.unique(rng.integers(0, 1 << 62, 320).astype(np.uint64))
        x, y = a[:280], a[40:]
        sig = S.signatures(np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)]))
        got.append((sig[0] == sig[1]).mean())
    assert abs(np.mean(got) - 0.75) < 0.01 and np.std(got) < (0.75 * 0.25 / S.SLOTS) ** 0.5
    one = S.signatures(np.array([42], np.uint64), np.array([0, 1]))[0]
    assert sorted((one >> 25).tolist()) == list(range(S.SLOTS))  # one element visits every slot once


def test_components_of_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(0, 40)] + [(1000, k) for k in range(1001, 1200)] + [(1500, 1001), (7, 7)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(7)
    got = {r.node: r.component for r in components(df).collect()}
    assert {got[k] for k in range(41)} == {0} and {got[k] for k in range(1000, 1200)} == {1000} and got[1500] == 1000
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_signatures_of_mixed_buckets_lose_less_than_the_bands():
    from math import comb

    import pyarrow as pa
    m, p = S.SLOTS, S.PERCENT / 100
    lost = sum(comb(m, k) * p**k * (1 - p)**(m - k) for k in range(m + 1) if k / m < S.CLOSE)
    assert lost < 1e-3 * (1 - p**S.ROWS)**S.BANDS
    text = " ".join(f"w{k}" for k in range(60))
    sig = np.zeros((2, m), np.uint8)
    sig[1, :int(m * 0.45)] = 1  # 55 % of the slots are equal
    cell = pa.table({"rep": [1, 2], "comp": [1, 2], "side": [0, 0], "sig": [x.tobytes() for x in sig], "text": [text, text + " end"]})
    assert S._near(cell).num_rows == 2 and S._block_links(cell).num_rows == 1
