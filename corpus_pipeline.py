"""Corpus pipeline: toxicity, language, near duplicates, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``; all stages but the last
return the columns of ``documents``.  Models learn from the stage's own docs
(and ``labels``).  Null ids, texts and languages pass through every stage by
the rules of the operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qualis.llm import decontam, packing, ppm, sieve, superminhash, toxicity
from qualis.llm.session import cut, read


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of 0.5 or more go."""
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).where(F.col("__score") < toxicity.THRESHOLD).select(*docs.columns)


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language cannot be told (no letter, or no language with a
    posterior of 0.5) go."""
    named = ppm.label(docs, ppm.fit(docs))
    return named.where((F.col("__lang") != ppm.UNKNOWN) & (F.col("__score") >= 0.5)).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group stays (the smallest id; rows that
    repeat an id are one document, of which the least row stays).  Rows with a
    null id stand under a mark of their text, above all ids below 2^62."""
    mark = F.lit(1 << 62) + F.shiftrightunsigned(F.xxhash64("text"), 2)
    named = docs.select(F.coalesce(F.col("doc_id").cast("long"), mark).alias("__id"), F.struct(*docs.columns).alias("__row"))
    linked = superminhash.link(named.select(F.col("__id").alias("doc_id"), "__row.text"))
    found = cut(linked.groupBy(F.col("doc_id").alias("__id")).agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
                .where("not kept or n > 1"))
    # rows of ids that go or repeat meet them in a join, all others stay where they are
    asked, single = sieve.parted(named, "__id", found.select(F.col("__id").alias("id")))
    met = (asked.join(found, "__id", "left").where("kept is null or kept")
           .groupBy("__id").agg(F.min("__row").alias("__row")))
    return single.unionByName(met).select(*(F.col("__row").getField(c).alias(c) for c in docs.columns))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a copy of a benchmark item go."""
    return decontam.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Power-of-two pieces of the documents that are left."""
    return packing.pack(docs, with_ids=False)


STAGES = [
    ("toxicity", drop_toxic),
    ("language", keep_known_language),
    ("near_dedup", near_dedup),
    ("decontamination", drop_benchmark),
    ("packing", pack),
]

#: toxicity, language and decontamination are learned or aligned: not SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
