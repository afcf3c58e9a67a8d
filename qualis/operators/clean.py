"""Cleaning: FIX / DROP / FLAG decided from the findings, as joins and aggregates.

Semantics (decision table of the rule set):
- masters and sales lose their 2nd+ key copies mechanically (keep-first);
- every other *sales* finding is resolved to the surviving first row whose
  sale_id equals its row_ref (a finding raised on a copy acts on the first
  row; ``row:<i>`` references never resolve); findings of other tables are
  reported only;
- DROP findings drop the row, FLAG findings append their check id to the
  row's ``quality_flag`` (detection order, repeats kept), FIX findings repair
  the cell or - when the value cannot be repaired - escalate to DROP;
- counters count findings, not rows.

Repeated repairs of one cell see the already repaired value. Per cell the
repair sequence is always "date repairs (schema layer) first, then the business
repairs of that column". Date repairs and the discount cap are idempotent;
a synonym map may chain (a target that is itself a key), so its n-th repair is
looked up in the path that the map spells out from the first value (paths are
made on the driver from the rules, cycles included). So every finding's outcome
follows from its rank in the cell, without a sequential loop.

Columns are those the sales table has: whatever else it carries stays, and any
configured column can be repaired. A finding brings the text of its own cell, so
the wide table is joined once, by row id, to one table of actions (repairs, flags,
drops, new positions), and read for the first rows that findings on copies act on.
Only rows that have an action are shuffled for that join; the others are copied.
Every join has scans or shuffles on both sides, so AQE can split a hot key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qualis.functions import parse as P
from qualis.operators import keys as K
from qualis.operators.checks import align, bq, empty_cell
from qualis.rules import Rules, fmt_g, synonym_paths
from qualis.session import cut, together
from qualis.sources.rowindex import parted, positions_after_removal

# Texts of the fix log that must match.
FIXLOG_COLUMNS = ["table", "row_ref", "check_id", "column", "original_value", "fixed_value", "note"]
ESCALATION_NOTE = "FIX impossible (no parse / no synonym) -> escalated to DROP"
FLAG_SEGMENT = 1 << 12


@dataclass
class CleaningResult:
    """Lazy DataFrames of one cleaning pass."""
    cleaned: dict[str, DataFrame]      # cleaned tables (sales with quality_flag), with _row_id/_pos
    outcomes: DataFrame                # one row per resolved sales finding with its outcome
    fix_log: DataFrame                 # successful repairs
    escalations: DataFrame             # FIX -> DROP escalations
    counts: DataFrame                  # (metric, check_id, n): dropped / flagged / fixed / escalated
    rows: DataFrame                    # (table, rows_before, rows_after)
    unresolved: DataFrame              # sales findings whose row_ref names no surviving row


def _cell_value(columns: list[str]) -> Column:
    """The current text of the cell named by the finding's ``column``."""
    expr = F.lit(None).cast("string")
    for c in reversed(columns):
        expr = F.when(F.col("column") == c, F.col(bq(f"_c_{c}"))).otherwise(expr)
    return expr


def _ranked(df: DataFrame, keys: list[str], out: str) -> DataFrame:
    """``out``: rank from 1 by ``_seq`` inside ``keys``, in two levels: a window sees
    at most FLAG_SEGMENT rows of a key, or one row per such segment."""
    d = df.withColumn("_sg", (F.col("_seq") / FLAG_SEGMENT).cast("long"))
    before = Window.partitionBy(*keys).orderBy("_sg").rowsBetween(Window.unboundedPreceding, -1)
    segs = (d.groupBy(*keys, "_sg").agg(F.count(F.lit(1)).alias("_n"))
            .select(*keys, "_sg", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_b")))
    inside = Window.partitionBy(*keys, "_sg").orderBy("_seq")
    return (d.join(segs, [*keys, "_sg"]).withColumn(out, F.col("_b") + F.row_number().over(inside))
            .drop("_sg", "_b"))


def _mapped(synonyms: dict[str, str], v: Column, n: Column) -> tuple[Column, Column]:
    """(value after n >= 1 lookups or NULL if the n-th fails, value of the cell then)."""
    none = F.lit(None).cast("string")
    paths = synonym_paths(synonyms)
    if not paths:
        return none, v
    pairs = [x for k, (path, turn) in paths.items()
             for x in (F.lit(k), F.struct(F.array(*map(F.lit, path)).alias("p"), F.lit(turn).alias("t")))]
    # a missing value reads as the text 'nan', as in the log
    hit = F.try_element_at(F.create_map(*pairs), F.coalesce(P.norm_key(v), F.lit("nan")))
    path, turn, size = hit["p"], hit["t"], F.size(hit["p"])
    at = F.when(n <= size, n).when(turn > 0, turn + F.pmod(n - turn, size - turn + 1)).cast("int")
    value = F.when(hit.isNotNull() & at.isNotNull(), F.try_element_at(path, at))
    return value, F.when(n <= 0, v).otherwise(F.coalesce(value, F.element_at(path, -1), v))


def _date_fix(v: str) -> Column:
    return F.date_format(P.parse_date(v), "yyyy-MM-dd")


def _capped(v: str, max_d: float) -> Column:
    """Discount clipped to [0, max]; unparseable -> 0; NaN stays NaN."""
    d = P.parse_float(v)
    return (F.when(d.isNull(), F.lit(0.0)).when(F.isnan(d), d)
            .otherwise(F.least(F.greatest(d, F.lit(0.0)), F.lit(max_d))))


def _business_fix(check: Column, v: Column, n: Column, rules: Rules) -> tuple[Column, Column]:
    """(value that the n-th business repair writes or NULL if it fails, cell after n
    repairs); expects the clipped discount as column ``_cap`` (see ``_capped``)."""
    region, region_cell = _mapped(rules.region_synonyms(), v, n)
    channel, channel_cell = _mapped(rules.channel_synonyms(), v, n)
    cap = P.fmt_g("_cap")
    return (F.when(check == "BIZ_003", cap).when(check == "BIZ_005", region).when(check == "BIZ_006", channel),
            F.when(check == "BIZ_003", F.when(n <= 0, v).otherwise(cap))
            .when(check == "BIZ_005", region_cell).when(check == "BIZ_006", channel_cell))


def _notes(rules: Rules) -> Column:
    c = F.col("check_id")
    return (F.when(c == "SCH_002", "date normalised to ISO 8601")
            .when(c == "BIZ_003", f"discount clipped to [0, {fmt_g(float(rules.business['max_discount']))}]")
            .when(c == "BIZ_005", "region mapped").when(c == "BIZ_006", "channel mapped"))


def _flag_text(flags: DataFrame) -> DataFrame:
    """(_tgt, quality_flag): flag check ids of a row joined by ';' in detection
    order. Two levels: contiguous sequence segments first (bounded lists), then
    the few segment texts per row."""
    seg = (flags.groupBy("_tgt", (F.col("_seq") / FLAG_SEGMENT).cast("long").alias("_sg"))
           .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_seq", "check_id"))),
                                         lambda x: x["check_id"]), ";").alias("_part")))
    return (seg.groupBy("_tgt")
            .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_sg", "_part"))),
                                          lambda x: x["_part"]), ";").alias("quality_flag")))


def clean(tables: dict[str, DataFrame], findings: DataFrame, rules: Rules, repeated: DataFrame | None = None) -> CleaningResult:
    """``repeated``: the written ``keys.repeated_keys`` of the sales, if the caller has it already."""
    # Q14: a pass rewrites quality_flag, it never merges an earlier one.
    # Positions of an earlier pass are recomputed here. Absent optional columns
    # read as NULL, as for the checks, and stay absent in the result.
    tables, layout = align({t: df.drop("quality_flag", "_pos") if t == "sales" else df.drop("_pos") if t != "targets" else df
                       for t, df in tables.items()}, rules)
    given = {t: [c for c in df.columns if c in layout.present[t] and not c.startswith("_")] for t, df in tables.items()}
    sales, customers, products = tables["sales"], tables["customers"], tables["products"]
    columns = given["sales"]

    # K1/K2/K3: mechanical keep-first on every keyed table.
    # Sales findings (except the duplicates' own) name the rows they act on.
    recs = findings.where((F.col("table") == "sales") & (F.col("check_id") != "UNI_001")).select(
        "check_id", "row_ref", "column", "invalid_value", "cleaning_action", "_seq", "_row")
    repeated, cust_dups, prod_dups = together(
        sales.sparkSession,
        lambda: cut(K.repeated_keys(sales, "sale_id")) if repeated is None else repeated,
        lambda: cut(K.copies(customers, "customer_id").select("_row_id")),
        lambda: cut(K.copies(products, "product_id").select("_row_id")))
    sales_dups = cut(K.copies(sales, "sale_id", rep=repeated).select("_row_id"))
    cust_kept = customers.join(cust_dups, "_row_id", "left_anti")
    prod_kept = products.join(prod_dups, "_row_id", "left_anti")

    # Resolved to surviving rows: the finding's own row, which holds the cell that the finding
    # shows, or the first row of a repeated key. A reference ``row:<i>`` stands for a row without
    # a key, but may be the key of another one.
    keyed = ~F.col("row_ref").startswith("row:")
    placed = cut(recs.where(keyed).join(repeated.select(F.col("sale_id").alias("row_ref"), "_first"), "row_ref", "left")
                 .withColumn("_tgt", F.coalesce("_first", "_row")).drop("_first"))
    own_row = F.col("_tgt") == F.col("_row")
    firsts = cut(placed.where(~own_row).select("_tgt").distinct())
    cells_of = lambda df: df.select(F.col("sale_id").alias("row_ref"), F.col("_row_id").alias("_tgt"),
                                    *[F.col(bq(c)).alias(f"_c_{c}") for c in columns])
    first_cells = cells_of(sales.join(firsts, F.col("_row_id") == F.col("_tgt"), "left_semi")).drop("row_ref")
    odd_refs = recs.where(~keyed)
    odd_cells = cut(cells_of(sales.where(F.col("sale_id").startswith("row:")).join(sales_dups, "_row_id", "left_anti")))
    shown = F.when(~empty_cell("check_id"), F.col("invalid_value"))
    to = [*recs.columns, "_tgt", "_v0"]
    resolved = cut(placed.where(own_row).withColumn("_v0", shown).select(*to)
                   .unionByName(placed.where(~own_row).join(first_cells, "_tgt").withColumn("_v0", _cell_value(columns)).select(*to))
                   .unionByName(odd_refs.join(odd_cells, "row_ref").withColumn("_v0", _cell_value(columns)).select(*to)))
    unresolved = odd_refs.join(odd_cells.select("row_ref"), "row_ref", "left_anti").drop("_row")

    # Per repaired cell: which repairs it gets, and its value after the date repairs.
    fixes = resolved.where(F.col("cleaning_action") == "FIX")
    is_date = F.col("check_id") == "SCH_002"
    cells = fixes.groupBy("_tgt", "column").agg(
        F.max(is_date).alias("_has_date"),
        F.min(F.when(is_date, F.col("_seq"))).alias("_first_date"),
        F.max(F.when(~is_date, F.col("check_id"))).alias("_biz"),
        F.count_if(~is_date).alias("_n_biz"),
        F.max("_v0").alias("_v0"))                     # the same text on every finding of the cell
    max_d = float(rules.business["max_discount"])
    cells = (cells
             .withColumn("_dval", F.when(F.col("_has_date"), _date_fix("_v0")))
             .withColumn("_va", F.coalesce(F.col("_dval"), F.col("_v0")))
             .withColumn("_cap", _capped("_va", max_d)))
    cells = cut(cells.withColumn("_final", F.when(F.col("_biz").isNull(), F.col("_va")).otherwise(
        _business_fix(F.col("_biz"), F.col("_va"), F.col("_n_biz"), rules)[1])))

    # Outcome of every resolved finding: date repairs from the cell alone, business
    # repairs by their rank in the cell.
    own = ["_tgt", "check_id", "row_ref", "column", "invalid_value", "cleaning_action", "_seq"]
    dates = fixes.where(is_date).drop("_v0").join(cells, ["_tgt", "column"]).select(
        *own, F.when(F.col("_seq") == F.col("_first_date"), F.col("_v0")).otherwise(F.col("_dval")).alias("_from"),
        F.col("_dval").alias("_to"))
    ranked = _ranked(fixes.where(~is_date).drop("_v0"), ["_tgt", "column"], "_n").join(cells, ["_tgt", "column"])
    check, va, n = F.col("check_id"), F.col("_va"), F.col("_n")
    business = ranked.select(*own, _business_fix(check, va, n - 1, rules)[1].alias("_from"),
                             _business_fix(check, va, n, rules)[0].alias("_to"))
    ok = F.col("_to").isNotNull()
    fx = dates.unionByName(business).select(
        *own, F.when(ok, "FIX").otherwise("ESCALATED").alias("outcome"),
        # a missing original is logged as the text of a missing value
        F.when(ok, F.coalesce("_from", F.lit("nan"))).otherwise(F.col("invalid_value")).alias("original_value"),
        F.when(ok, F.col("_to")).otherwise(F.lit("<dropped>")).alias("fixed_value"))
    other = resolved.where(F.col("cleaning_action") != "FIX").select(
        *own, F.col("cleaning_action").alias("outcome"),
        F.lit(None).cast("string").alias("original_value"), F.lit(None).cast("string").alias("fixed_value"))
    outcomes = cut(fx.unionByName(other))

    fix_log = outcomes.where(F.col("outcome") == "FIX").select(
        F.lit("sales").alias("table"), "row_ref", "check_id", F.coalesce("column", F.lit("")).alias("column"),
        "original_value", "fixed_value", _notes(rules).alias("note"), "_seq")
    escalations = outcomes.where(F.col("outcome") == "ESCALATED").select(
        F.lit("sales").alias("table"), "row_ref", "check_id", F.coalesce("column", F.lit("")).alias("column"),
        "original_value", "fixed_value", F.lit(ESCALATION_NOTE).alias("note"), "_seq")

    # One action row per sales row that changes: dropped, flagged, repaired, renumbered.
    flagged = (F.col("outcome") == "FLAG") | ((F.col("outcome") == "FIX") & (F.col("check_id") == "BIZ_003"))
    flags = _flag_text(outcomes.where(flagged).select("_tgt", "_seq", "check_id"))
    repaired = [c for c in columns if c in rules.types("sales") or c in ("discount", "region", "sales_channel")]
    finals = cells.groupBy("_tgt").agg(*[F.max(F.when(F.col("column") == c, F.col("_final"))).alias(f"_fix_{c}")
                                         for c in repaired])
    gone = cut(sales_dups.unionByName(outcomes.where(F.col("outcome").isin("DROP", "ESCALATED"))
                                      .select(F.col("_tgt").alias("_row_id"))).distinct())
    nameless = sales.where("sale_id IS NULL").select("_row_id").join(gone, "_row_id", "left_anti")
    actions = cut(finals.join(flags, "_tgt", "full").withColumnRenamed("_tgt", "_row_id")
                  .join(gone.withColumn("_drop", F.lit(True)), "_row_id", "full")
                  .join(positions_after_removal(gone, nameless), "_row_id", "full"))
    # a hash join: the rows that change are shuffled, never sorted, and the others stay where they are
    changing, same = parted(sales, actions.select("_row_id"))
    cleaned_sales = (changing.join(actions.hint("shuffle_hash"), "_row_id", "left").where(F.col("_drop").isNull())
                     .select(*[F.coalesce(F.col(bq(f"_fix_{c}")), F.col(bq(c))).alias(c) if c in repaired
                               else F.col(bq(c)) for c in columns],  # others keep their metadata
                             F.coalesce(F.col("quality_flag"), F.lit("")).alias("quality_flag"), "_row_id", "_pos"))
    if same is not None:
        cleaned_sales = cleaned_sales.unionByName(same.select(
            *[F.col(bq(c)) for c in columns], F.lit("").alias("quality_flag"), "_row_id", F.lit(None).cast("long").alias("_pos")))

    # A8 counters (findings, not rows) + mechanical duplicate drops.
    dup_counts = (sales_dups.select(F.lit("UNI_001").alias("check_id"))
                  .unionByName(cust_dups.select(F.lit("UNI_002").alias("check_id")))
                  .unionByName(prod_dups.select(F.lit("UNI_003").alias("check_id")))
                  .withColumn("metric", F.lit("dropped")))
    rec_metrics = outcomes.select("check_id", F.explode(F.array(
        F.when(F.col("outcome").isin("DROP", "ESCALATED"), "dropped"),
        F.when(flagged, "flagged"),
        F.when(F.col("outcome") == "FIX", "fixed"),
        F.when(F.col("outcome") == "ESCALATED", "escalated"))).alias("metric")).where("metric IS NOT NULL")
    counts = (rec_metrics.unionByName(dup_counts).groupBy("metric", "check_id")
              .agg(F.count(F.lit(1)).alias("n")))

    # Second-pass row references: positions after removal (only for rows that
    # need one: those whose key is NULL).
    def with_pos(kept: DataFrame, removed_ids: DataFrame, key: str) -> DataFrame:
        need = kept.where(F.col(key).isNull()).select("_row_id")
        pos = positions_after_removal(removed_ids, need)
        return kept.join(pos, "_row_id", "left")

    # The cleaned tables are re-validated, enriched and counted: written once.
    done = together(
        sales.sparkSession, lambda: cut(cleaned_sales),
        lambda: cut(with_pos(cust_kept, cust_dups, "customer_id").select(*map(bq, given["customers"]), "_row_id", "_pos")),
        lambda: cut(with_pos(prod_kept, prod_dups, "product_id").select(*map(bq, given["products"]), "_row_id", "_pos")))
    cleaned = dict(zip(("sales", "customers", "products"), done)) | {
        "targets": tables["targets"].select(*map(bq, given["targets"]), "_row_id")}
    rows = None
    for t in ("sales", "customers", "products", "targets"):
        r = (tables[t].agg(F.count(F.lit(1)).alias("rows_before"))
             .crossJoin(cleaned[t].agg(F.count(F.lit(1)).alias("rows_after")))
             .select(F.lit(t).alias("table"), "rows_before", "rows_after"))
        rows = r if rows is None else rows.unionByName(r)
    return CleaningResult(cleaned, outcomes, fix_log, escalations, counts, rows, unresolved)


def totals(res: CleaningResult) -> DataFrame:
    """R5 headline: one row of totals."""
    c = res.counts
    agg = c.agg(*[F.coalesce(F.sum(F.when(F.col("metric") == m, F.col("n"))), F.lit(0)).cast("long")
                  .alias(f"total_{m}") for m in ("dropped", "fixed", "flagged", "escalated")])
    return agg.crossJoin(res.unresolved.agg(F.count(F.lit(1)).alias("unresolved_findings")))
