"""Operators 1, 3, 5, 7: brute force on small texts, held-out accuracy on the given tables."""
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import frame, have_data  # noqa: F401
from test_text import ODD, plain_words

from qualis.llm import bradley_terry, ppm, quality_rules, toxicity
from qualis.llm import text as T

MID, LARGE = "/root/testdata/sf0.01", "/root/testdata/sf0.1"  # toxic words of four languages need some hundred labels
DOCS = "doc_id long, text string, lang string, source string"


def brute_base(t):
    t = t or ""
    w = plain_words(t, lower=False)
    wins = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    c, cover = Counter(wins), set()
    for i, x in enumerate(wins):
        if c[x] > 1:
            cover.update(range(i, i + 5))
    lines = [x for x in t.split("\n") if plain_words(x)]
    return len(w), sum(map(len, w)), sum(t.count(s) for s in "#*$%&|<>"), len(lines) - len(set(lines)), len(cover)


def test_base_rules_equal_plain_python():
    texts = ODD + ["a b c d e f a b c d e f", "x\nx\n x\n\n\ny|y #%", "a a a a a a a", "l1 w\nl2\nl1 w\n" * 3]
    g = quality_rules.base(pa.array(texts))
    for i, t in enumerate(texts):
        assert tuple(int(g[k][i]) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) \
            == brute_base(t)


def test_jensen_shannon_distance():
    p, q = np.array([[3, 1, 0], [0, 0, 5], [0, 0, 0]]), np.array([0.5, 0.25, 0.25])

    def plain(a, b):
        m = [(x + y) / 2 for x, y in zip(a, b)]
        kl = lambda u: sum(x * math.log2(x / z) for x, z in zip(u, m) if x > 0)
        return math.sqrt((kl(a) + kl(b)) / 2)
    got = quality_rules.jensen_shannon(p, q)
    assert abs(got[0] - plain([0.75, 0.25, 0], q)) < 1e-12 and abs(got[1] - plain([0, 0, 1], q)) < 1e-12


def test_divergence_verdicts(spark, frame):
    rng = np.random.default_rng(2)
    common = "the of and to in a is that it was for on are as with".split()
    say = lambda n: " ".join(str(rng.choice(common)) if rng.random() < 0.6 else f"w{rng.integers(0, 5000)}" for _ in range(n))
    unlike = " ".join(f"{chr(65 + k % 26)}Q{k}Z" for k in range(60))
    rows = [(k, say(200), "en", "s") for k in range(40)]
    good = say(120)
    rows += [(100, good, None, None), (101, unlike, "en", None), (102, None, "en", None), (103, "", None, None),
             (104, "too short", "en", None), (None, unlike, None, None), (104, "too short", "en", None)]
    got = [(r.doc_id, r.n_words, r.base_failed, r.kept) for r in quality_rules.assess(frame(rows, DOCS)).collect()]
    by = {x[0]: x for x in got}
    assert len(got) == len(rows)
    assert by[100][3] and not by[101][3] and not by[101][2] and not by[None][3]
    assert by[102] == (102, 0, True, False) and by[104][2:] == (True, False)
    assert quality_rules.assess(frame([], DOCS)).count() == 0


def held_out(rows, mod, residue):
    return [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % mod == residue]


@pytest.mark.parametrize("op", ["quality", "toxic"])
def test_held_out_accuracy(spark, have_data, op):
    docs, labels = spark.read.parquet(f"{LARGE}/documents.parquet"), spark.read.parquet(f"{LARGE}/labels.parquet")
    run, mod, res = ((bradley_terry.rank, 4, 2) if op == "quality" else (toxicity.classify, 5, 0))
    got = run(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    truth = {r.doc_id: r[op] for r in labels.collect()}
    mine = [r for r in held_out(got, mod, res) if r.doc_id in truth]
    assert all(r.held_out for r in mine) and sum(r.held_out for r in got) == len(held_out(got, mod, res))
    limit = 0.7 if op == "quality" else 0.5
    assert all(r.predicted == int(r.score >= limit) for r in got)
    assert sum(r.predicted == truth[r.doc_id] for r in mine) >= 0.95 * len(mine)
    bad = [r for r in mine if not truth[r.doc_id]] if op == "quality" else [r for r in mine if truth[r.doc_id]]
    assert sum(r.predicted == truth[r.doc_id] for r in bad) >= (0.9 if op == "quality" else 0.6) * len(bad)  # some toxic labels have no trace in their text


@pytest.mark.parametrize("op", [lambda d, x: bradley_terry.rank(d, x), lambda d, x: toxicity.classify(d, x)])
def test_models_on_odd_rows(spark, frame, op):
    rows = [(k, f"plain words number {k} here and there {k}", "en", "s") for k in range(20)] + \
        [(k, f"vile idiot words {k} *** ### idiots {k}", "en", "s") for k in range(20, 40)] + \
        [(None, "idiot", None, None), (50, None, None, None), (51, "", None, None), (51, "", None, None), (52, "!?" * 9, "x", "y")]
    labels = spark.createDataFrame([(k, int(k < 20), int(k >= 20)) for k in range(40)] + [(None, 1, 1), (50, None, None), (3, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    got = op(frame(rows, DOCS), labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    none = op(frame(rows, DOCS), labels.where("quality > 5")).collect()
    assert {r.score for r in none} == {0.0}
    assert op(frame([], DOCS), labels).count() == 0


def test_subwords_catch_unseen_spellings():
    rng = np.random.default_rng(5)
    filler = [f"{a}{b}{c}" for a in ("tor", "mel", "san") for b in ("ina", "olu", "ero") for c in ("k", "st", "ly")]
    text = lambda extra: " ".join(list(rng.choice(filler, 60)) + extra)
    forms = ["idiot", "idiots", "idiotic", "idiott", "moron", "morons", "moronic"]
    rows = [(text([rng.choice(forms)]), 1) for _ in range(150)] + [(text([]), 0) for _ in range(150)]
    model = toxicity.train(rows)
    score = toxicity.predict(pa.array([text(["idiotz"]), text(["moronz"]), text([]), text(["sanolu"]), "", None]), model)
    assert score[0] > 0.5 and score[1] > 0.5 and score[2] < 0.5 and score[3] < 0.5 and score[4] == score[5]


def test_token_scores_two_ways():
    table = np.random.default_rng(0).random(toxicity.BUCKETS).astype(np.float32)
    texts = ["hello wOrld a", "", "x1 x1 x1 é", "a-b_c"]
    ids, goff, tok = toxicity.token_grams(texts)
    raw, off = T.utf8(pa.array(texts))
    score, tok2 = toxicity.token_scores(raw, off, table)
    want = [table[ids[goff[k]:goff[k + 1]]].astype(float).mean() for k in range(len(goff) - 1)]
    assert tok.tolist() == tok2.tolist() == [0, 3, 3, 5, 8] and np.allclose(score, want)
    peak, at = toxicity.window_peaks(np.array([1.0, 5, 0, 2, 9]), np.array([0, 3, 3, 5]), 2)
    assert peak.tolist() == [3.0, 0.0, 5.5] and at.tolist() == [0, 3, 3]


def brute_bits(train, text, depth=ppm.DEPTH):
    cnt = [defaultdict(Counter) for _ in range(depth + 1)]
    low = lambda s: bytes(depth) + bytes(T.LOWER[np.frombuffer(s.encode(), np.uint8)])
    for t in train:
        b = low(t)
        for i in range(depth, len(b)):
            for k in range(depth + 1):
                cnt[k][b[i - k:i]][b[i]] += 1
    b, bits = low(text), 0.0
    for i in range(depth, len(b)):
        for k in range(depth, -2, -1):
            if k < 0:
                bits += 8
                break
            c = cnt[k].get(b[i - k:i])
            if c:
                total, kinds = sum(c.values()), len(c)
                if b[i] in c:
                    bits -= math.log2(c[b[i]] / (total + kinds))
                    break
                bits -= math.log2(kinds / (total + kinds))
    return bits


def test_code_lengths_are_exact():
    train = {"a": ["hello world hello there", "the Cat"], "b": ["bonjour le monde", "été à", ""]}
    texts = ["hello", "zzz le mond été~", "", "H", "world bonjour ñ", "the the there"]
    got = ppm.code_lengths(*T.utf8(pa.array(texts)), ppm.train(train))
    want = [[brute_bits(train[k], t) for k in "ab"] for t in texts]
    assert np.allclose(got, want, atol=1e-3)


def test_language_held_out_and_odd_rows(spark, frame, have_data):
    docs = spark.read.parquet(f"{MID}/documents.parquet")
    got = ppm.identify(docs).collect()
    lang = {r.doc_id: r.lang for r in docs.collect()}
    mine = [r for r in held_out(got, 5, 0) if r.lang_pred != "und"]
    assert len(mine) > 150 and sum(r.lang_pred == lang[r.doc_id] for r in mine) >= 0.95 * len(mine)
    rows = [(k, "hello there world", "en", "s") for k in range(9)] + [(k, "bonjour le monde", "fr", "s") for k in range(9, 18)]
    rows += [(20, None, "en", "s"), (21, "", None, None), (22, "123 !?", "en", "s"), (None, "Hello world", None, None), (23, "語", "en", "")]
    by = {(r.doc_id): r for r in ppm.identify(frame(rows, DOCS)).collect()}
    assert by[20].lang_pred == by[21].lang_pred == by[22].lang_pred == "und" and by[20].score == 0
    assert by[None].lang_pred == "en" and not by[None].held_out and by[23].lang_pred in ("en", "fr")
    assert ppm.identify(frame([], DOCS)).count() == 0
    assert {r.lang_pred for r in ppm.identify(frame([(1, "x", None, None)], DOCS)).collect()} == {"und"}
