"""The registered queries against their SQL, and the pipeline against its operators one by one."""
import duckdb
import pytest
from llm_cases import frame, have_data  # noqa: F401
from test_leaks_and_packing import D

import __spark_entry__ as E
import corpus_pipeline as C
from qualis.llm import packing, ppm, superminhash, toxicity
from qualis.llm.queries import ORACLE_SQL, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, have_data, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    res = con.execute(ORACLE_SQL[name])
    cols = [d[0] for d in res.description]
    rows = QUERIES[name](spark, SMALL).select(*cols).collect()
    assert sorted(map(repr, (tuple(r) for r in rows))) == sorted(map(repr, res.fetchall()))


def test_every_operator_is_registered():
    names = list(E.queries())
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10 and "pipeline" in names


def test_stages_do_what_their_operators_say(spark, have_data):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    at, kept = docs, []
    for name, stage in C.STAGES[:-1]:
        before = {r.doc_id for r in at.collect()}
        after = C.cut(stage(spark, at, SMALL))
        assert after.columns == docs.columns
        gone = before - {r.doc_id for r in after.collect()}
        if name == "toxicity":
            want = {r.doc_id for r in toxicity.classify(at, labels).collect() if r.predicted}
        elif name == "language":
            want = {r.doc_id for r in ppm.identify(at).collect() if r.lang_pred == "und" or r.score < 0.5}
        elif name == "near_dedup":
            want = {r.doc_id for r in superminhash.link(at).collect() if not r.kept}
        else:
            want = {r.doc_id for r in D.links(at, items).collect()}
        assert gone == want, name
        kept.append(len(gone))
        at = after
    assert len(C.STAGES) == 5 and sum(kept) > 0
    got = C.run(spark, SMALL).select("doc_id", "start", "length", "ids_crc32").collect()
    want = packing.pack(at, with_ids=False).select("doc_id", "start", "length", "ids_crc32").collect()
    assert sorted(got) == sorted(want)


def test_stages_take_odd_tables(spark, frame, have_data):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    words = " ".join(f"w{k}" for k in range(30))
    rows = [(1, words, "en", "s", 1), (1, words, "en", "s", 1), (2, words + " x", None, None, None), (None, words, "en", "s", 1),
            (3, None, "en", "s", 0), (4, "", None, "s", 0), (5, "other text with a few words", "fr", "s", 9)]
    for table in (rows, []):
        at = frame(table, schema)
        cols = at.columns
        for _, stage in C.STAGES[:-1]:
            at = C.cut(stage(spark, at, SMALL))
            assert at.columns == cols
        out = C.STAGES[-1][1](spark, at, SMALL)
        assert {r.doc_id for r in out.collect()} == ({1, 5} if table else set())


def test_near_dedup_keeps_one_row_of_each_group(spark, frame):
    schema = "doc_id long, text string"
    say = lambda k: [f"w{k}x{n}" for n in range(60)]
    text = [" ".join(say(k)) for k in range(5)]
    rows = [(1, text[0]), (None, text[0]), (2, text[0] + " end"), (None, text[0] + " more"),  # copies of document 1
            (None, text[1]), (None, text[1]), (None, text[1] + " end"),  # a group without ids
            (3, text[2]), (3, text[2]), (3, text[2]), (None, text[3]), (4, text[4]), (None, None), (5, None), (6, "")]
    got = C.near_dedup(spark, frame(rows, schema).repartition(3), SMALL)
    assert got.columns[:2] == ["doc_id", "text"] and len(got.columns) == len(frame(rows, schema).columns)
    left = [(r.doc_id, r.text) for r in got.collect()]
    lone = [t for d, t in left if d is None and t is not None]
    assert sorted(d for d, _ in left if d is not None) == [1, 3, 4, 5, 6] and (None, None) in left
    assert len(lone) == 2 and text[3] in lone and sum(t.startswith(text[1]) for t in lone) == 1


def test_near_dedup_moves_only_what_goes_or_repeats(spark, frame, monkeypatch):
    parts = []

    def spy(*args, real=C.sieve.parted):
        parts.extend(real(*args))
        return parts
    monkeypatch.setattr(C.sieve, "parted", spy)
    text = lambda k: " ".join(f"w{k}x{n}" for n in range(30))
    rows = [(k, text(k)) for k in range(300)] + [(900, text(7)), (8, text(8)), (None, text(9))]
    got = C.near_dedup(spark, frame(rows, "doc_id long, text string").repartition(3), SMALL)
    assert sorted(r.doc_id for r in got.collect()) == list(range(300))
    asked, single = (df.count() for df in parts)
    assert asked < 10 and asked + single == len(rows)  # the two that go, the two that repeat
