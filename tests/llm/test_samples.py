"""Samples hold one text of an id, whatever repeats it, and classes count ids."""
from llm_cases import frame  # noqa: F401

from qualis.llm import ppm, sample
from qualis.llm.sample import labelled_texts, texts_of, top_by_hash

ROWS = "doc_id long, text string, lang string"


def test_repeated_ids_count_once(spark, frame):
    rows = [(7, f"text {k}", "en") for k in range(5000)] + [(k, f"own {k}", "en") for k in range(100, 150)] + [(1, "x", "de")]
    docs = frame(rows, ROWS)
    ids = top_by_hash(docs, "lang", 30)
    assert sorted(r["n"] for r in ids.groupBy("lang").agg({"doc_id": "count"}).toDF("lang", "n").collect()) == [1, 30]
    every = texts_of(docs, top_by_hash(docs, "lang", 300), ["doc_id", "lang"])
    assert len(every) == 52
    assert {r["doc_id"]: r["text"] for r in every}[7] == min(f"text {k}" for k in range(5000))


def test_labels_of_repeated_rows(spark, frame):
    docs = frame([(k % 5, f"t{k}", "en") for k in range(400)] + [(None, "n", "en")], ROWS)
    labels = spark.createDataFrame([(k, k % 2) for k in range(5)] * 300 + [(None, 1), (3, None)], "doc_id long, quality int")
    got = labelled_texts(docs, labels, "quality", 4, 99, 50)
    assert sorted(got) == sorted((min(f"t{i}" for i in range(k, 400, 5)), k % 2) for k in range(5))


def test_a_language_is_learned_from_all_its_ids(frame, monkeypatch):
    held = []
    monkeypatch.setattr(ppm, "train", lambda texts: held.append(texts))
    rows = [(7, f"same {k}", "en") for k in range(5000)] + [(k, f"own {k}", "en") for k in range(100, 160)]
    ppm.fit(frame(rows, ROWS))
    outside = sum(1 for k in [7, *range(100, 160)] if sample_residue(k) != ppm.HELD)
    assert len(held[0]["en"]) == outside


def sample_residue(k):
    import zlib
    assert sample.residue is not None
    return zlib.crc32(str(k).encode()) % ppm.MOD
