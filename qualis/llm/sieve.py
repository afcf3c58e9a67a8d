"""Move only the wide rows that a set of ids asks for.

A join of whole documents with a set of ids shuffles every text.  Here the ids
first set bits of a bitmap of fixed size (2^``BITS`` bits, the only broadcast); the
scan of the documents keeps the rows whose bit is set, and only these meet the
ids in a join, which removes the few that share a bit.  With more ids than bits
the bitmap lets everything pass and the join alone decides: results are exact at
every size, only the saving ends.  ``parted`` is the other way round: rows whose
bit is not set are surely not asked for and stay where they are.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS, PART = 24, 13  # bits of the bitmap, bits of one group's part of it


def _part(table: pa.Table) -> pa.Table:
    bits = np.zeros(1 << PART, bool)
    bits[table["bit"].to_numpy() & ((1 << PART) - 1)] = True
    return pa.table({"part": table["part"].slice(0, 1), "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})


def _kept(bitmap, wanted: bool = True):
    def run(batches):
        bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap.value), np.uint8)).view(bool)
        for b in batches:
            keep = pa.array(bits[b.column(b.num_columns - 1).to_numpy()] == wanted)
            yield b.select(b.schema.names[:-1]).filter(keep)
    return run


def _bitmap(ids: DataFrame):
    """The broadcast bits of ``ids`` (id long, distinct)."""
    bit = F.shiftrightunsigned(F.xxhash64(F.col("id")), 64 - BITS)
    parts = (ids.select(bit.alias("bit")).distinct().withColumn("part", F.shiftright("bit", PART))
             .groupBy("part").applyInArrow(_part, "part long, bits binary").collect())  # 2^(BITS - 3) bytes at most
    whole = bytearray(1 << (BITS - 3))
    size = 1 << (PART - 3)
    for r in parts:
        whole[r["part"] * size:(r["part"] + 1) * size] = r["bits"]
    return ids.sparkSession.sparkContext.broadcast(zlib.compress(bytes(whole), 1))


def _sieved(docs: DataFrame, key: str, bitmap, wanted: bool) -> DataFrame:
    bit = F.shiftrightunsigned(F.xxhash64(F.col(key)), 64 - BITS)
    return docs.withColumn("bit", bit).mapInArrow(_kept(bitmap, wanted), docs.schema)


def moved(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` (doc_id long, not null, ...) whose id is among ``ids`` (id long, repeats allowed)."""
    ids = ids.distinct()
    found = _sieved(docs, "doc_id", _bitmap(ids), True)
    return found.join(ids.withColumnRenamed("id", "doc_id"), "doc_id", "left_semi")


def parted(rows: DataFrame, key: str, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` (``key`` long, not null) in two parts: all rows of the ``ids`` (id long, repeats allowed)
    with the few that share a bit with one, and the others; neither part is moved."""
    bitmap = _bitmap(ids.distinct())
    return _sieved(rows, key, bitmap, True), _sieved(rows, key, bitmap, False)
