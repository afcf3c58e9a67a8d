"""Columnar helpers against plain Python."""
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from qualis.llm import text as T
from qualis.llm.components import union

ODD = ["", None, " \t\n", "a", "A b\tc\x0bd e f g", "word" * 50, "é ü x  ÿ\n\ny", "a b c d", "a b c d e"]


def plain_words(t, lower=True):
    t = t or ""
    t = "".join(c.lower() if "A" <= c <= "Z" else c for c in t) if lower else t
    return re.findall(r"[^\x20\x09-\x0D]+", t)


@pytest.mark.parametrize("slice_bytes", [8, 64, 1 << 20])
def test_words_and_shingles_equal_plain_python(monkeypatch, slice_bytes):
    monkeypatch.setattr(T, "SLICE", slice_bytes)
    rng = random.Random(3)
    texts = ODD + [" ".join(rng.choice(["ab", "B", "c,", "dé", "\n", "x" * 40]) for _ in range(rng.randint(0, 60)))
                   for _ in range(60)]
    words, off = T.word_hashes(*T.utf8(pa.array(texts)))
    names = {}
    for i, t in enumerate(texts):
        own = plain_words(t)
        assert off[i + 1] - off[i] == len(own)
        for h, w in zip(words[off[i]:off[i + 1]].tolist(), own, strict=True):
            assert names.setdefault(h, w) == w
    assert len(set(names.values())) == len(names)
    sets, soff = T.shingle_sets(pa.array(texts))
    seen = {}
    for i, t in enumerate(texts):
        w = plain_words(t)
        want = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}
        assert soff[i + 1] - soff[i] == len(want)
        seen.setdefault(frozenset(sets[soff[i]:soff[i + 1]].tolist()), set()).add(frozenset(want))
    assert all(len(v) == 1 for v in seen.values())


def test_sliced_and_chunked_columns():
    a = pa.chunked_array([["x y", None], ["z"]])
    raw, off = T.utf8(a)
    assert bytes(raw) == b"x yz" and off.tolist() == [0, 3, 3, 4]
    raw, off = T.utf8(pa.array(["aa", "b", "ccc"]).slice(1, 2))
    assert bytes(raw) == b"bccc" and off.tolist() == [0, 1, 4]


def test_union_find_on_random_graphs():
    rng = np.random.default_rng(1)
    for n in (1, 5, 40):
        a, b = rng.integers(0, 30, n), rng.integers(0, 30, n)
        comp = {x: {x} for x in set(a.tolist()) | set(b.tolist())}
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            both = comp[x] | comp[y]
            for z in both:
                comp[z] = both
        nodes, roots = union(a, b)
        assert dict(zip(nodes.tolist(), roots.tolist(), strict=True)) == {k: min(v) for k, v in comp.items()}
