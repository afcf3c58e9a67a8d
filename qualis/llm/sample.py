"""Bounded, deterministic samples of labelled rows for the trained operators.

A sample takes the ``per_class`` ids of each class with the smallest hash and one
text of each, so its size is ``classes * per_class`` rows at any scale; texts are whole.  Rows of the
held-out residue, with null ids, texts or labels are never in it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qualis.llm.session import cut


def residue(doc_id, mod: int) -> Column:
    """crc32 of the doc_id as text, modulo ``mod`` (-1 for a null id)."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(mod)), F.lit(-1))


def top_by_hash(rows: DataFrame, label: str, per_class: int) -> DataFrame:
    """(doc_id, label): the ``per_class`` ids of each class with the smallest hash, each once.
    Class sizes (distinct ids, estimated by a sketch) give a hash bound that leaves about
    twice as many ids of a class, so the ranking sees a number of rows that does not follow
    the table, however often an id repeats."""
    rows = rows.select("doc_id", label)
    sizes = {r[label]: r["n"] for r in rows.groupBy(label).agg(F.approx_count_distinct("doc_id").alias("n")).collect()}
    key, near = F.xxhash64(F.col("doc_id")), F.lit(False)
    for value, n in sizes.items():
        share = (2 * per_class + 100) / n
        bound = F.lit(True) if share >= 1 else key <= int(-(2 ** 63) + share * 2 ** 64)
        near = near | ((F.col(label) == value) & bound)
    order = Window.partitionBy(label).orderBy(key, "doc_id")
    return rows.where(near).distinct().withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= per_class).drop("_n")


def texts_of(rows: DataFrame, picked: DataFrame, by: list[str]) -> list:
    """One row (*by, text) for each picked id, however many rows repeat it: the least text."""
    return (rows.where(F.col("text").isNotNull()).select(*by, "text").join(F.broadcast(picked), by)
            .groupBy(*by).agg(F.min("text").alias("text")).orderBy(*by).collect())


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, mod: int, held: int,
                   per_class: int) -> list[tuple[str, int]]:
    """(text, label) rows to learn from; ``labels`` (doc_id, label 0/1)."""
    known = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
             .where(residue("doc_id", mod) != held)
             .groupBy("doc_id").agg(F.max(label).alias("label")))
    picked = cut(top_by_hash(known, "label", per_class))  # at most 2 * per_class narrow rows
    of = {r["doc_id"]: int(r["label"]) for r in picked.collect()}
    return [(r["text"], of[r["doc_id"]]) for r in texts_of(docs, picked.select("doc_id"), ["doc_id"])]
