"""Row positions and global sequence numbers without a single-partition sort.

``block_sequence`` numbers rows 0..n-1 (or from ``start``) in a total order.
The caller supplies *block* columns that are monotone in that order (e.g.
``key div 4096``): rows are ranked inside their block by a window partitioned
on the block (bounded work per task), and each block is shifted by the number
of rows in all earlier blocks (a table with one row per block). Everything is
deterministic, so a lost executor recomputes exactly the same numbers.

``positions_after_removal`` re-numbers rows after some were removed from a
table whose ids are dense positions, for the rows that need it only (those
whose reference falls back to the position), by counting removed ids per block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qualis.session import cut

FANOUT = 4096
TASK_ROWS = 1 << 18  # most rows that a task sorts when they are numbered, unless blocks are larger


def prefix_offsets(counts: DataFrame, block_cols: list[str], n_col: str, out: str = "_off",
                   fanout: int = FANOUT) -> DataFrame:
    """Exclusive prefix sum of ``n_col`` over blocks in order, in two levels so
    that no task sees more than ``fanout`` blocks or groups: blocks are ranked
    inside coarse groups (consecutive runs of ``fanout`` blocks by block order),
    then the few group totals are summed. The block columns must be ordered
    lexicographically; the last one must be numeric (it is coarsened)."""
    *lead, last = block_cols
    coarse = lead + ["_grp"]
    c = counts.withColumn("_grp", F.floor(F.col(last) / F.lit(fanout)))
    inner = Window.partitionBy(*coarse).orderBy(*block_cols).rowsBetween(Window.unboundedPreceding, -1)
    c = c.withColumn("_o1", F.coalesce(F.sum(n_col).over(inner), F.lit(0)))
    groups = c.groupBy(*coarse).agg(F.sum(n_col).alias("_gn"))
    outer = Window.orderBy(*coarse).rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select(*coarse, F.coalesce(F.sum("_gn").over(outer), F.lit(0)).alias("_o2"))
    return (c.join(groups, coarse).select(*block_cols, (F.col("_o1") + F.col("_o2")).alias(out)))


def tasks_of(df: DataFrame) -> int:
    return df.count() // TASK_ROWS + 1


def dealt(df: DataFrame, tasks: int, *cols: str) -> DataFrame:
    """``df`` shuffled by ``cols``, over more tasks than the session's if they would sort too many rows."""
    few = tasks <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(*cols) if few else df.repartition(tasks, *cols)


def block_ranks(df: DataFrame, block: str, order_cols: list[str]) -> DataFrame:
    """``df`` with ``_rn``, the row number inside a block, and ``_rk``, the same for rows that tie."""
    w = Window.partitionBy(block).orderBy(*order_cols)
    return df.withColumns({"_rn": F.row_number().over(w).cast("long"), "_rk": F.rank().over(w).cast("long")})


def numbered(ranked: DataFrame, block: str, tie_cols: list[str], late: dict[str, Column], out: str = "_row_id") -> DataFrame:
    """Rows of the written ``block_ranks`` with the columns ``late`` and their number ``out``; rows that tie
    are numbered by ``tie_cols``. A block shifts its rows by one number: the rows are not shuffled again
    as long as the numbers of all blocks (a few bytes for hundreds of rows) are small enough to broadcast."""
    counts = ranked.groupBy(block).agg(F.count(F.lit(1)).alias("_n"))
    offsets = cut(prefix_offsets(counts, [block], "_n"))
    ties = cut(ranked.where("_rk <> _rn").select(block, "_rk").distinct())

    if ties.isEmpty():
        return ranked.join(offsets, block).withColumns(late).withColumn(out, F.col("_off") + F.col("_rn") - 1)
    inside = Window.partitionBy(block, "_rk").orderBy(*tie_cols)
    alone = ranked.join(ties, [block, "_rk"], "left_anti").withColumns(late)
    equal = (ranked.join(ties, [block, "_rk"], "left_semi").withColumns(late)
             .withColumn("_rn", F.col("_rk") + F.row_number().over(inside) - 1))
    return alone.unionByName(equal).join(offsets, block).withColumn(out, F.col("_off") + F.col("_rn") - 1)


def block_sequence(df: DataFrame, order_cols: list[Column | str], block_cols: list[Column],
                   out: str = "_row_id", start: int = 0, late: dict[str, Column] | None = None) -> DataFrame:
    """``late``: columns computed behind the shuffle, for a written ``df`` (counted first) of narrow rows."""
    blk_names = [f"_blk{i}" for i in range(len(block_cols))]
    d = df.withColumns(dict(zip(blk_names, block_cols)))
    counts = d.groupBy(*blk_names).agg(F.count(F.lit(1)).alias("_n"))
    # One row per block, hashed: the rows are shuffled by block once and sorted only for their numbers.
    offsets = prefix_offsets(counts, blk_names, "_n").hint("shuffle_hash")
    if late:
        d = dealt(d, tasks_of(df), *blk_names).withColumns(late)
    inner = Window.partitionBy(*blk_names).orderBy(*order_cols)
    return (d.join(offsets, blk_names)
            .withColumn(out, F.col("_off") + F.row_number().over(inner) - F.lit(1 - start))
            .drop(*blk_names, "_off"))


ID_BLOCK = 12       # ids of a block of the map in ``parted``: 2^12, one bit each
MAP_BLOCKS = 1 << 17  # blocks of a map that is broadcast (512 bytes each): ids up to 2^29 if they are dense


def parted(df: DataFrame, ids: DataFrame, id_col: str = "_row_id") -> tuple[DataFrame, DataFrame | None]:
    """(rows of ``df`` whose id is among ``ids``, the others): ``df`` is not shuffled, a map of one bit for
    each position meets it in the scan. If the map is too large to broadcast, (``df``, None): any row may be asked for."""
    at = F.col(id_col)
    words = (ids.select(F.shiftright(at, ID_BLOCK).alias("_ib"), F.shiftright(at, 6).bitwiseAND(F.lit((1 << ID_BLOCK - 6) - 1)).alias("_iw"),
                        F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int")).alias("_bit"))
             .groupBy("_ib", "_iw").agg(F.bit_or("_bit").alias("_bit")))
    own = F.map_from_entries(F.collect_list(F.struct(F.col("_iw").cast("int").alias("_iw"), "_bit")))
    blocks = cut(words.groupBy("_ib").agg(own.alias("_own")).select("_ib", F.transform(
        F.sequence(F.lit(0), F.lit((1 << ID_BLOCK - 6) - 1)), lambda i: F.coalesce(F.col("_own")[i], F.lit(0).cast("long"))).alias("_bits")))
    if blocks.count() > MAP_BLOCKS:
        return df, None
    both = df.join(F.broadcast(blocks), F.shiftright(at, ID_BLOCK) == F.col("_ib"), "left")
    word = F.col("_bits")[F.shiftright(at, 6).bitwiseAND(F.lit((1 << ID_BLOCK - 6) - 1)).cast("int")]
    bit = F.call_function("shiftright", word, at.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1).cast("long"))
    asked = F.coalesce(bit == 1, F.lit(False))
    cols = [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]
    return both.where(asked).select(*cols), both.where(~asked).select(*cols)


def positions_after_removal(removed_ids: DataFrame, wanted_ids: DataFrame, id_col: str = "_row_id",
                            width: int = 1 << 16, out: str = "_pos") -> DataFrame:
    """New dense position of each id in ``wanted_ids`` once ``removed_ids`` are gone.

    Only the removed ids and the wanted ids are shuffled (two narrow columns),
    never the table itself.
    """
    rem = removed_ids.select(F.col(id_col).alias("_id"), F.lit(1).alias("_gone"))
    want = wanted_ids.select(F.col(id_col).alias("_id"), F.lit(0).alias("_gone"))
    u = rem.unionByName(want).withColumn("_b", F.floor(F.col("_id") / F.lit(width)))
    # Every block that holds a wanted or removed id, with its removed count
    # (0 for blocks without removals, so later blocks still see the prefix).
    per_block = u.groupBy("_b").agg(F.sum("_gone").alias("_nb"))
    offsets = prefix_offsets(per_block, ["_b"], "_nb", out="_prev")
    running = Window.partitionBy("_b").orderBy("_id", "_gone").rowsBetween(Window.unboundedPreceding, 0)
    return (u.withColumn("_gone_before", F.sum("_gone").over(running))
            .where(F.col("_gone") == 0)
            .join(offsets, "_b", "left")
            .select(F.col("_id").alias(id_col),
                    (F.col("_id") - F.coalesce(F.col("_prev"), F.lit(0)) - F.col("_gone_before")).alias(out)))
