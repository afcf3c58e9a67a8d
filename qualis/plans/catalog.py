"""Registered queries over the dirty fixture: Spark builders and oracle SQL.

Every query reads the given tables through the fixture recipe, so its work
grows with the scale factor; nothing runs on made-up input.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qualis.functions import parse as P
from qualis.operators import clean as CL
from qualis.operators import findings as FD
from qualis.operators import inject as IJ
from qualis.operators import keys as K
from qualis.operators import reports as RP
from qualis.operators import verify as VF
from qualis.operators import master as MS
from qualis.operators import score as SC
from qualis.plans.oracle import Oracle, clean_base, clean_ctes, fixture_ctes, inject_ctes
from qualis.sources.fixture import SALES_COLUMNS
from qualis.plans import sqlfn as S
from qualis.rules import LAYERS, Rules
from qualis.sources import fixture as FX
from qualis.session import checkpoint_dir, cut, landed, shuffles_freed
from qualis.sources import readers as RD
from qualis.sources import rowindex as RI
from qualis.sources import sinks as SK
from qualis.sources.readers import load_fixture


def fixture_rules() -> Rules:
    """Reference rule set with the fixture overrides (date_min, audit date)."""
    return Rules(audit_date=FX.FIXTURE_AUDIT_DATE).with_overrides(date_min=FX.FIXTURE_DATE_MIN)


def extended_rules() -> Rules:
    """Rules of the extended fixture: one more date column, a chain of synonyms
    whose last target is no key itself."""
    r = fixture_rules()
    r.config["column_types"]["sales"]["ship_date"] = "date"
    r.config["optional_columns"]["sales"].append("ship_date")
    r.config["allowed_values"]["region_synonyms"] = dict(FX.EXTRA_SYNONYMS)
    return Rules(r.config, r.audit_date, r.run_ts)


_CTX: dict[tuple[str, str, bool], "_Ctx"] = {}


def Ctx(spark: SparkSession, sf_dir: str, extended: bool = False) -> "_Ctx":  # noqa: N802
    """Shared building blocks per (application, scale factor, fixture).

    Queries of one application reuse the same written fixture and findings, so a
    registered query only adds its own small plan on top.
    """
    key = (spark.sparkContext.applicationId, sf_dir, extended)
    if key not in _CTX:
        _CTX[key] = _Ctx(spark, sf_dir, extended)
    return _CTX[key]


class _Ctx:
    """Lazy building blocks for queries over one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str, extended: bool = False):
        self.spark, self.sf_dir = spark, sf_dir
        self.rules = extended_rules() if extended else fixture_rules()
        self.extended = extended
        self._tables: dict[str, DataFrame] | None = None
        self._repeated: DataFrame | None = None
        self._findings: DataFrame | None = None
        self._cleaning: CL.CleaningResult | None = None
        self._findings_clean: DataFrame | None = None
        self._injected = None
        self._findings_injected: DataFrame | None = None

    @property
    def tables(self) -> dict[str, DataFrame]:
        """The fixture is derived by joins + ranking and read by several branches of a
        query: landed once (like the files of a real landing area), if a query reads it."""
        if self._tables is None:
            self._tables = landed(lambda: load_fixture(self.spark, self.sf_dir, extended=self.extended))
        return self._tables

    @property
    def repeated(self) -> DataFrame:
        """Repeated sale ids: both the checks and the cleaning ask for them."""
        if self._repeated is None:
            self._repeated = cut(K.repeated_keys(self.tables["sales"], "sale_id"))
        return self._repeated

    @property
    def findings(self) -> DataFrame:
        if self._findings is None:
            self._findings = FD.findings(self.tables, self.rules, repeated=self.repeated)
        return self._findings

    @property
    def cleaning(self) -> CL.CleaningResult:
        if self._cleaning is None:
            self._cleaning = CL.clean(self.tables, self.findings, self.rules, self.repeated)
        return self._cleaning

    # -- injected baseline (N1-N13, V1-V3) --------------------------------
    @property
    def injected(self):
        if self._injected is None:
            base = landed(lambda: load_fixture(self.spark, self.sf_dir, clean=True))
            dirty, manifest = IJ.inject(base)
            dirty = {t: cut(df) for t, df in dirty.items()}
            manifest = cut(manifest)
            expected = manifest.unionByName(VF.natural_duplicates(base["sales"]))
            rules = Rules(audit_date=IJ.INJECT_AUDIT_DATE).with_overrides(date_min=IJ.INJECT_DATE_MIN)
            self._injected = (base, dirty, manifest, expected, rules)
        return self._injected

    @property
    def findings_injected(self) -> DataFrame:
        if self._findings_injected is None:
            _, dirty, _, _, rules = self.injected
            self._findings_injected = FD.findings(dirty, rules)
        return self._findings_injected

    @property
    def findings_clean(self) -> DataFrame:
        if self._findings_clean is None:
            self._findings_clean = FD.findings(self.cleaning.cleaned, self.rules)
        return self._findings_clean


# ----------------------------------------------------------------------- spark
def q_findings(spark, sf):
    return FD.report(Ctx(spark, sf).findings)


def q_score_raw(spark, sf):
    c = Ctx(spark, sf)
    return SC.score(c.findings, c.tables, c.rules)


def q_by_check(spark, sf):
    return SC.by_check(Ctx(spark, sf).findings)


def q_by_table(spark, sf):
    return SC.by_table(Ctx(spark, sf).findings)


def q_by_severity(spark, sf):
    return SC.by_severity(Ctx(spark, sf).findings, spark)


def q_by_layer(spark, sf):
    return SC.by_layer(Ctx(spark, sf).findings, spark)


def q_top_classes(spark, sf):
    return SC.top_classes(Ctx(spark, sf).findings, 5)


def q_table_profile(spark, sf):
    return SC.table_profile(Ctx(spark, sf).tables)


def q_fn_parse_date(spark, sf):
    s = Ctx(spark, sf).tables["sales"]
    return s.select("_row_id", "sale_date", P.parse_date("sale_date").alias("parsed_date"),
                    F.coalesce(P.is_iso_date("sale_date"), F.lit(False)).alias("is_iso"),
                    F.date_format(P.parse_date("sale_date"), "yyyy-MM-dd").alias("iso_text"))


def q_fn_parse_float(spark, sf):
    s = Ctx(spark, sf).tables["sales"]
    return s.select("_row_id", "quantity", "discount",
                    P.parse_float("quantity").alias("q"), P.parse_float("discount").alias("d"),
                    P.fmt_g(P.parse_float("quantity")).alias("q_text"),
                    P.fmt_g(P.parse_float("discount")).alias("d_text"))


def q_cleaned_sales(spark, sf):
    return Ctx(spark, sf).cleaning.cleaned["sales"].select(*SALES_COLUMNS, "quality_flag")


def q_fix_log(spark, sf):
    return Ctx(spark, sf).cleaning.fix_log.select(*CL.FIXLOG_COLUMNS)


def q_escalations(spark, sf):
    return Ctx(spark, sf).cleaning.escalations.select(*CL.FIXLOG_COLUMNS)


def q_cleaning_counts(spark, sf):
    return Ctx(spark, sf).cleaning.counts


def q_cleaning_totals(spark, sf):
    return CL.totals(Ctx(spark, sf).cleaning)


def q_rows_before_after(spark, sf):
    return Ctx(spark, sf).cleaning.rows


def q_clean_master(spark, sf):
    return MS.build_master(Ctx(spark, sf).cleaning.cleaned)


def q_findings_clean(spark, sf):
    return FD.report(Ctx(spark, sf).findings_clean)


def q_score_clean(spark, sf):
    c = Ctx(spark, sf)
    return SC.score(c.findings_clean, c.cleaning.cleaned, c.rules)


def q_inject_manifest(spark, sf):
    return Ctx(spark, sf).injected[2]


def q_inject_counts(spark, sf):
    return IJ.manifest_counts(Ctx(spark, sf).injected[2])


def q_inject_self_check(spark, sf):
    base, dirty, manifest, _, rules = Ctx(spark, sf).injected
    return IJ.self_check(base, dirty, manifest, rules)


def q_inject_dirty_sales(spark, sf):
    return Ctx(spark, sf).injected[1]["sales"].select(*SALES_COLUMNS, "_row_id")


def q_detect_summary(spark, sf):
    c = Ctx(spark, sf)
    return VF.detection_summary(c.findings_injected, c.injected[3])


def q_detect_by_class(spark, sf):
    c = Ctx(spark, sf)
    return VF.by_class(c.findings_injected, c.injected[3])


def q_detect_matched(spark, sf):
    c = Ctx(spark, sf)
    return VF.expected_keys(c.injected[3]).intersectAll(c.findings_injected.select(*VF.KEY))


def q_detect_missed(spark, sf):
    c = Ctx(spark, sf)
    return VF.missed(c.findings_injected, c.injected[3])


def q_detect_unexpected(spark, sf):
    c = Ctx(spark, sf)
    return VF.unexpected(c.findings_injected, c.injected[3])


def q_baseline_check(spark, sf):
    """V7: the clean baseline yields no findings beyond its natural key copies."""
    c = Ctx(spark, sf)
    base, _, _, _, rules = c.injected
    f = FD.findings(base, rules)
    rows = SC.total_rows(base)
    nat = VF.natural_duplicates(base["sales"]).agg(F.count(F.lit(1)).alias("natural_duplicates"))
    return rows.crossJoin(f.agg(F.count(F.lit(1)).alias("baseline_findings"))).crossJoin(nat)


def q_cleaning_balance(spark, sf):
    c = Ctx(spark, sf)
    _, dirty, _, _, rules = c.injected
    res = CL.clean(dirty, c.findings_injected, rules)
    return VF.cleaning_balance(c.findings_injected, res)


def q_residual_classes(spark, sf):
    c = Ctx(spark, sf)
    return VF.residual_classes(c.findings_clean, c.rules)


def q_idempotence(spark, sf):
    """V5: cleaning the cleaned tables again drops and fixes nothing."""
    c = Ctx(spark, sf)
    again = CL.clean(c.cleaning.cleaned, c.findings_clean, c.rules)
    t = CL.totals(again)
    return t.select("total_dropped", "total_fixed")


def q_master_integrity(spark, sf):
    return VF.master_integrity(MS.build_master(Ctx(spark, sf).cleaning.cleaned))


def q_errors_summary(spark, sf):
    c = Ctx(spark, sf)
    return RP.errors_summary(c.findings, c.findings_clean, spark, c.rules)


def q_findings_per_check(spark, sf):
    return RP.findings_per_check(Ctx(spark, sf).findings)


def q_residual_split(spark, sf):
    return RP.residual_split(Ctx(spark, sf).cleaning)


def q_before_after(spark, sf):
    c = Ctx(spark, sf)
    return RP.before_after(SC.score(c.findings, c.tables, c.rules),
                           SC.score(c.findings_clean, c.cleaning.cleaned, c.rules))


def q_data_dictionary(spark, sf):
    c = Ctx(spark, sf)
    return RP.data_dictionary(c.tables, c.rules)


def q_findings_head_per_layer(spark, sf):
    """First 3 findings of every layer (detection order)."""
    f = Ctx(spark, sf).findings
    return RP.head_per_group(f, "check_layer", "_seq", 3).select(*FD.ERROR_COLUMNS)


def q_fix_examples(spark, sf):
    """First 2 repairs per check."""
    fl = Ctx(spark, sf).cleaning.fix_log
    return RP.head_per_group(fl, "check_id", "_seq", 2).select(*CL.FIXLOG_COLUMNS)


def q_flagged_master(spark, sf):
    """Master rows that carry a quality flag."""
    m = MS.build_master(Ctx(spark, sf).cleaning.cleaned)
    return m.where(F.length("quality_flag") > 0)


def q_sample_rows(spark, sf):
    """P5: sales rows named by the first finding of selected classes."""
    c = Ctx(spark, sf)
    picks = RP.head_per_group(c.findings.where(F.col("check_id").isin("COM_001", "SCH_002", "BIZ_003",
                                                                      "BIZ_005", "REL_001")),
                              "check_id", "_seq", 1).select(F.col("row_ref").alias("sale_id"))
    return c.tables["sales"].join(picks, "sale_id", "left_semi").select(*SALES_COLUMNS)


def q_clean_baseline_rows(spark, sf):
    """Sales rows referenced by no finding (the clean part of the data)."""
    c = Ctx(spark, sf)
    refs = c.findings.where(F.col("table") == "sales").select(F.col("row_ref").alias("sale_id"))
    return c.tables["sales"].join(refs, "sale_id", "left_anti").select(*SALES_COLUMNS)


def q_master_head(spark, sf):
    """The first 6 master rows in file order (a head listing; the limit is the feature)."""
    m = MS.build_master(Ctx(spark, sf).cleaning.cleaned, keep_internal=True)
    return m.orderBy("_row_id").limit(6).select(*MS.MASTER_ORDER, "active_status")


def q_rerun_identical(spark, sf):
    """A second, independent run gives the same findings (multiset both ways)."""
    c = Ctx(spark, sf)
    again = FD.findings(landed(lambda: load_fixture(spark, sf)), c.rules)
    a, b = VF.differences(FD.report(c.findings), FD.report(again))
    return (a.agg(F.count(F.lit(1)).alias("only_first"))
            .crossJoin(b.agg(F.count(F.lit(1)).alias("only_second"))))


# -- verifier meta checks (T08, T09): tampered data must be told from the manifest
def _tampered(spark, sf, column: str, value: Column, pick: DataFrame) -> DataFrame:
    """Findings after one cell of the injected sales is overwritten."""
    c = Ctx(spark, sf)
    _, dirty, _, _, rules = c.injected
    one = pick.agg(F.min("_row_id").alias("_hit"))
    sales = dirty["sales"].crossJoin(F.broadcast(one))  # one row
    sales = sales.withColumn(column, F.when(F.col("_row_id") == F.col("_hit"), value).otherwise(F.col(column))).drop("_hit")
    return FD.findings({**dirty, "sales": cut(sales)}, rules)


def q_detect_repaired(spark, sf):
    """The first unknown customer is repaired in the data: one miss, no false alarm."""
    c = Ctx(spark, sf)
    _, dirty, _, expected, _ = c.injected
    known = dirty["customers"].agg(F.min("customer_id")).first()[0]
    unknown = dirty["sales"].where("customer_id IS NOT NULL").join(
        dirty["customers"].select("customer_id").distinct(), "customer_id", "left_anti")
    found = _tampered(spark, sf, "customer_id", F.lit(known), unknown)
    return VF.missed(found, expected).withColumn("kind", F.lit("missed")).unionByName(
        VF.unexpected(found, expected).withColumn("kind", F.lit("unexpected")))


def q_detect_added(spark, sf):
    """The first row without a finding gets an unknown region: one false alarm, no miss."""
    c = Ctx(spark, sf)
    _, dirty, _, expected, _ = c.injected
    named = expected.where(F.col("table") == "sales").select(F.col("row_ref").alias("sale_id")).distinct()
    found = _tampered(spark, sf, "region", F.lit("Narnia"), dirty["sales"].join(named, "sale_id", "left_anti"))
    return VF.missed(found, expected).withColumn("kind", F.lit("missed")).unionByName(
        VF.unexpected(found, expected).withColumn("kind", F.lit("unexpected")))


# -- sources and gates over a CSV landing of the fixture -----------------------
def _scratch(spark, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _write_csv(df: DataFrame, path: str) -> None:
    with shuffles_freed(df.sparkSession):
        (df.write.option("header", True).option("escape", '"').option("emptyValue", "")
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def in_file_order(df: DataFrame, files: int) -> DataFrame:
    """``df`` in the order of its positions for ``files`` files, or for more if a task would have
    to sort more than ``rowindex.TASK_ROWS`` rows (it would spill all of them to disk)."""
    return df.repartitionByRange(max(files, RI.tasks_of(df)), "_row_id").sortWithinPartitions("_row_id")


def _csv_landing(spark, sf) -> str:
    """All sales as CSV under two headers: every second row in the usual order, the
    others in reverse order without discount and with a note of two lines."""
    s, path = Ctx(spark, sf).tables["sales"], _scratch(spark, "csv")
    odd = F.col("_row_id") % 2 == 1
    _write_csv(s.where(~odd).select(*SALES_COLUMNS), f"{path}/a")
    note = F.concat(F.lit('a "quoted"\nnote, '), F.col("_row_id").cast("string"))
    _write_csv(s.where(odd).select(note.alias("order_note"), *[c for c in reversed(SALES_COLUMNS) if c != "discount"]),
               f"{path}/b")
    return path


def q_csv_scan(spark, sf):
    """IO1: columns bound by header name, absent column NULL, extra column kept."""
    df = RD.read_csv_text(spark, f"{_csv_landing(spark, sf)}/*", SALES_COLUMNS)
    return RD.empty_to_null(df).select(*SALES_COLUMNS, "order_note")


def q_text_positions(spark, sf):
    """IO5: positions of CSV rows in file order are the positions they were written with."""
    path = _scratch(spark, "csv")
    s = Ctx(spark, sf).tables["sales"]
    _write_csv(in_file_order(s, 8).select(*SALES_COLUMNS, F.col("_row_id").alias("written")), path)
    df = RD.with_text_positions(RD.read_csv_text(spark, path, SALES_COLUMNS))
    return df.select(F.col("written").cast("long").alias("written"), "_row_id")


def q_parquet_positions(spark, sf):
    """IO2/IO5: a parquet table read as text, numbered by file and row index."""
    path = _scratch(spark, "parquet")
    s = Ctx(spark, sf).tables["sales"]
    with shuffles_freed(spark):
        in_file_order(s.select("_row_id", "sale_date"), 8).select(
            F.col("_row_id").alias("written"), F.col("sale_date").try_cast("date").alias("sale_date")).write.parquet(path)
    return RD.read_any_text(spark, path, "parquet").select(F.col("written").cast("long").alias("written"), "sale_date", "_row_id")


def q_header_gate(spark, sf):
    """P1/SCH_001: columns that some file's own header lacks."""
    return RD.header_problems(spark, f"{_csv_landing(spark, sf)}/*", SALES_COLUMNS).select("missing_column").distinct()


def q_input_gate(spark, sf):
    """IO4: rows of the inputs that a landing holds, and the names that it lacks."""
    path = _scratch(spark, "landing")
    SK.write_tables({t: df for t, df in Ctx(spark, sf).tables.items() if t != "targets"}, path)
    names = {t: t for t in ("sales", "customers", "products", "targets")}
    gone = RD.missing_inputs(spark, path, names)
    out = None
    for t in names:
        n = spark.range(0).agg(F.count(F.lit(1)).alias("rows")) if t in gone else \
            spark.read.parquet(f"{path}/{t}").agg(F.count(F.lit(1)).alias("rows"))
        one = n.select(F.lit(t).alias("name"), F.lit(t not in gone).alias("present"), "rows")
        out = one if out is None else out.unionByName(one)
    return out


def q_manifest_scan(spark, sf):
    """IO6/IO11: the injected manifest written as JSON and read back."""
    path = _scratch(spark, "manifest")
    SK.write_manifest(Ctx(spark, sf).injected[2], path, 42, "fixture")
    return RD.read_manifest(spark, path)


def q_findings_by_layer_files(spark, sf):
    """IO9: findings written as one folder per layer and read back layer by layer."""
    path = _scratch(spark, "errors")
    SK.write_findings_by_layer(Ctx(spark, sf).findings, path)
    out = None
    for layer in LAYERS:
        one = SK.read_findings_layer(spark, path, layer)
        out = one if out is None else out.unionByName(one)
    return out


# -- extended fixture: extra columns, odd numbers, synonym chains ---------------
def q_ext_findings(spark, sf):
    return FD.report(Ctx(spark, sf, True).findings)


def q_clean_extra_columns(spark, sf):
    """Every sales column survives cleaning; any configured date is repaired."""
    return Ctx(spark, sf, True).cleaning.cleaned["sales"].select(*FX.sales_columns(True), "quality_flag")


def q_ext_fix_log(spark, sf):
    return Ctx(spark, sf, True).cleaning.fix_log.select(*CL.FIXLOG_COLUMNS)


def q_ext_escalations(spark, sf):
    return Ctx(spark, sf, True).cleaning.escalations.select(*CL.FIXLOG_COLUMNS)


def q_ext_master(spark, sf):
    return MS.build_master(Ctx(spark, sf, True).cleaning.cleaned)


def q_ext_master_integrity(spark, sf):
    return VF.master_integrity(q_ext_master(spark, sf))


def q_ext_errors_summary(spark, sf):
    c = Ctx(spark, sf, True)
    return RP.errors_summary(c.findings, c.findings_clean, spark, c.rules)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "findings": q_findings,
    "score_raw": q_score_raw,
    "findings_by_check": q_by_check,
    "findings_by_table": q_by_table,
    "findings_by_severity": q_by_severity,
    "findings_by_layer": q_by_layer,
    "top_error_classes": q_top_classes,
    "table_profile": q_table_profile,
    "fn_parse_date": q_fn_parse_date,
    "fn_parse_float": q_fn_parse_float,
    "cleaned_sales": q_cleaned_sales,
    "fix_log": q_fix_log,
    "escalations": q_escalations,
    "cleaning_counts": q_cleaning_counts,
    "cleaning_totals": q_cleaning_totals,
    "rows_before_after": q_rows_before_after,
    "clean_master": q_clean_master,
    "findings_clean": q_findings_clean,
    "score_clean": q_score_clean,
    "inject_manifest": q_inject_manifest,
    "inject_counts": q_inject_counts,
    "inject_self_check": q_inject_self_check,
    "inject_dirty_sales": q_inject_dirty_sales,
    "detect_summary": q_detect_summary,
    "detect_by_class": q_detect_by_class,
    "detect_matched": q_detect_matched,
    "detect_missed": q_detect_missed,
    "detect_unexpected": q_detect_unexpected,
    "baseline_check": q_baseline_check,
    "cleaning_balance": q_cleaning_balance,
    "residual_classes": q_residual_classes,
    "idempotence": q_idempotence,
    "master_integrity": q_master_integrity,
    "errors_summary": q_errors_summary,
    "findings_per_check": q_findings_per_check,
    "residual_split": q_residual_split,
    "before_after": q_before_after,
    "data_dictionary": q_data_dictionary,
    "findings_head_per_layer": q_findings_head_per_layer,
    "fix_examples": q_fix_examples,
    "flagged_master": q_flagged_master,
    "sample_rows": q_sample_rows,
    "clean_baseline_rows": q_clean_baseline_rows,
    "master_head": q_master_head,
    "rerun_identical": q_rerun_identical,
    "detect_repaired": q_detect_repaired,
    "detect_added": q_detect_added,
    "csv_scan": q_csv_scan,
    "text_positions": q_text_positions,
    "parquet_positions": q_parquet_positions,
    "header_gate": q_header_gate,
    "input_gate": q_input_gate,
    "manifest_scan": q_manifest_scan,
    "findings_by_layer_files": q_findings_by_layer_files,
    "ext_findings": q_ext_findings,
    "clean_extra_columns": q_clean_extra_columns,
    "ext_fix_log": q_ext_fix_log,
    "ext_escalations": q_ext_escalations,
    "ext_master": q_ext_master,
    "ext_master_integrity": q_ext_master_integrity,
    "ext_errors_summary": q_ext_errors_summary,
}


# ---------------------------------------------------------------------- oracle
def _score_sql(rules: Rules, findings: str, tables: dict[str, str]) -> str:
    sc = rules.config["scoring"]
    w = sc["weights"]
    rows = " + ".join(f"(SELECT count(*) FROM {v})" for v in tables.values())
    g, y = sc["traffic_light"]["green"], sc["traffic_light"]["yellow"]
    return f"""SELECT *, CASE WHEN score >= {g} THEN 'green' WHEN score >= {y} THEN 'yellow' ELSE 'red' END
        AS traffic_light FROM (
      SELECT *, CAST(floor(greatest(0.0, 100.0 - error_points_per_1000_rows) + 0.5) AS INTEGER) AS score FROM (
        SELECT *, weighted_error_points / total_row_count * {float(sc['normalize_per_rows'])}
          AS error_points_per_1000_rows FROM (
          SELECT total_row_count, n_critical, n_major, n_minor, total_errors,
            n_critical * {float(w['CRITICAL'])} + n_major * {float(w['MAJOR'])} + n_minor * {float(w['MINOR'])}
              AS weighted_error_points FROM (
            SELECT CAST({rows} AS BIGINT) AS total_row_count,
              count(*) FILTER (WHERE severity = 'CRITICAL') AS n_critical,
              count(*) FILTER (WHERE severity = 'MAJOR') AS n_major,
              count(*) FILTER (WHERE severity = 'MINOR') AS n_minor,
              count(*) AS total_errors FROM {findings}))))"""


def oracle_sql() -> dict[str, str]:
    rules = fixture_rules()
    o = Oracle(rules)
    base = o.base()
    w = lambda body: Oracle.with_(base, body)
    fx = Oracle.with_  # fixture-only queries
    from qualis.plans.oracle import fixture_ctes
    cols = ", ".join(f'"{c}"' if c in ("table", "column") else c for c in FD.ERROR_COLUMNS)
    four = {t: t for t in ("sales", "customers", "products", "targets")}
    out = {
        "findings": w(f"SELECT {cols} FROM findings"),
        "score_raw": w(_score_sql(rules, "findings", four)),
        "findings_by_check": w("SELECT check_id, count(*) AS n FROM findings GROUP BY check_id"),
        "findings_by_table": w('SELECT "table", count(*) AS n FROM findings GROUP BY "table"'),
        "findings_by_severity": w("""SELECT s.severity, COALESCE(n, 0) AS n,
              CASE s.severity WHEN 'CRITICAL' THEN 'ACT' WHEN 'MAJOR' THEN 'CHECK' ELSE 'OBSERVE' END AS action
            FROM (VALUES ('CRITICAL'), ('MAJOR'), ('MINOR')) s(severity)
            LEFT JOIN (SELECT severity, count(*) AS n FROM findings GROUP BY severity) c ON s.severity = c.severity"""),
        "findings_by_layer": w("""SELECT l.layer_no, l.check_layer, COALESCE(n, 0) AS n
            FROM (VALUES (1, 'SCHEMA'), (2, 'COMPLETENESS'), (3, 'UNIQUENESS'), (4, 'RELATIONSHIP'),
                         (5, 'BUSINESS_RULE')) l(layer_no, check_layer)
            LEFT JOIN (SELECT check_layer, count(*) AS n FROM findings GROUP BY check_layer) c
              ON l.check_layer = c.check_layer"""),
        "top_error_classes": w("""SELECT row_number() OVER (ORDER BY n DESC, f) AS rank, check_id, n,
              repeat('#', CAST(n AS INTEGER)) AS bar
            FROM (SELECT check_id, count(*) AS n, min(_seq) AS f FROM findings GROUP BY check_id)
            ORDER BY n DESC, f LIMIT 5"""),
        "table_profile": fx(fixture_ctes(), """SELECT 'sales' AS "table", count(*) AS rows, 9 AS columns FROM sales
            UNION ALL SELECT 'customers', count(*), 5 FROM customers
            UNION ALL SELECT 'products', count(*), 5 FROM products
            UNION ALL SELECT 'targets', count(*), 3 FROM targets"""),
        "fn_parse_date": fx(fixture_ctes(), f"""SELECT _row_id, sale_date, {S.parse_date('sale_date')} AS parsed_date,
            COALESCE({S.is_iso('sale_date')}, false) AS is_iso,
            strftime({S.parse_date('sale_date')}, '%Y-%m-%d') AS iso_text FROM sales"""),
        "fn_parse_float": fx(fixture_ctes(), f"""SELECT _row_id, quantity, discount, q, d,
            {S.fmt_g('q')} AS q_text, {S.fmt_g('d')} AS d_text FROM (SELECT *,
            {S.parse_float('quantity')} AS q, {S.parse_float('discount')} AS d FROM sales)"""),
    }
    cb = clean_base(o)
    wc = lambda body: Oracle.with_(cb, body)
    flcols = 'table, row_ref, check_id, "column", original_value, fixed_value, note'.replace("table", '"table"', 1)
    mcols = ", ".join(MS.MASTER_ORDER + ["active_status"])
    out.update({
        "cleaned_sales": wc(f"SELECT {', '.join(SALES_COLUMNS)}, quality_flag FROM cs"),
        "fix_log": wc(f"SELECT {flcols} FROM fix_log"),
        "escalations": wc(f"SELECT {flcols} FROM escalations"),
        "cleaning_counts": wc("SELECT metric, check_id, n FROM clean_counts"),
        "cleaning_totals": wc("""SELECT
              CAST(COALESCE(sum(n) FILTER (WHERE metric = 'dropped'), 0) AS BIGINT) AS total_dropped,
              CAST(COALESCE(sum(n) FILTER (WHERE metric = 'fixed'), 0) AS BIGINT) AS total_fixed,
              CAST(COALESCE(sum(n) FILTER (WHERE metric = 'flagged'), 0) AS BIGINT) AS total_flagged,
              CAST(COALESCE(sum(n) FILTER (WHERE metric = 'escalated'), 0) AS BIGINT) AS total_escalated,
              (SELECT count(*) FROM findings f WHERE f."table" = 'sales' AND f.check_id <> 'UNI_001'
                 AND NOT EXISTS (SELECT 1 FROM sv WHERE sv.sale_id = f.row_ref)) AS unresolved_findings
            FROM clean_counts"""),
        "rows_before_after": wc("""SELECT 'sales' AS "table", (SELECT count(*) FROM sales) AS rows_before,
              (SELECT count(*) FROM cs) AS rows_after
            UNION ALL SELECT 'customers', (SELECT count(*) FROM customers), (SELECT count(*) FROM cc)
            UNION ALL SELECT 'products', (SELECT count(*) FROM products), (SELECT count(*) FROM cp)
            UNION ALL SELECT 'targets', (SELECT count(*) FROM targets), (SELECT count(*) FROM targets)"""),
        "clean_master": wc(f"SELECT {mcols} FROM clean_master"),
        "findings_clean": wc(f"SELECT {cols} FROM c2_findings"),
        "score_clean": wc(_score_sql(rules, "c2_findings",
                                     {"s": "cs", "c": "cc", "p": "cp", "t": "targets"})),
    })
    reports = _report_sql(rules, wc, cols)
    out.update(reports)
    out.update(_inject_sql(cols))
    out.update(_source_sql(fx, cols, w))
    xo = Oracle(extended_rules(), extended=True)
    xc = clean_base(xo)
    wx = lambda body: Oracle.with_(xc, body)
    xreports = _report_sql(xo.rules, wx, cols)
    out.update({
        "ext_findings": Oracle.with_(xo.base(), f"SELECT {cols} FROM findings"),
        "clean_extra_columns": wx(f"SELECT {', '.join(xo.columns)}, quality_flag FROM cs"),
        "ext_fix_log": wx(f"SELECT {flcols} FROM fix_log"),
        "ext_escalations": wx(f"SELECT {flcols} FROM escalations"),
        "ext_master": wx(f"SELECT {mcols}, {', '.join(FX.EXTRA_COLUMNS)} FROM clean_master"),
        "ext_master_integrity": xreports["master_integrity"],
        "ext_errors_summary": xreports["errors_summary"],
    })
    out["rerun_identical"] = w("""SELECT (SELECT count(*) FROM (SELECT * FROM findings EXCEPT ALL SELECT * FROM findings))
          AS only_first, (SELECT count(*) FROM (SELECT * FROM findings EXCEPT ALL SELECT * FROM findings)) AS only_second""")
    again = cb + clean_ctes(o, {"sales": "cs", "customers": "cc", "products": "cp", "findings": "c2_findings"}, "r_")
    out["idempotence"] = Oracle.with_(again, """SELECT
          CAST(COALESCE(sum(n) FILTER (WHERE metric = 'dropped'), 0) AS BIGINT) AS total_dropped,
          CAST(COALESCE(sum(n) FILTER (WHERE metric = 'fixed'), 0) AS BIGINT) AS total_fixed FROM r_clean_counts""")
    return out


def _source_sql(fx, cols: str, w) -> dict[str, str]:
    ctes = fixture_ctes()
    four = " UNION ALL ".join(f"SELECT {S.q(t)} AS name, {str(t != 'targets').lower()} AS present, "
                              + (f"count(*) AS rows FROM {t}" if t != "targets" else "0 AS rows")
                              for t in ("sales", "customers", "products", "targets"))
    scan = ", ".join("CASE WHEN _row_id % 2 = 0 THEN discount END AS discount" if c == "discount" else c for c in SALES_COLUMNS)
    return {
        "csv_scan": fx(ctes, f"""SELECT {scan}, CASE WHEN _row_id % 2 = 1 THEN 'a "quoted"' || chr(10) || 'note, '
              || CAST(_row_id AS VARCHAR) END AS order_note FROM sales"""),
        "text_positions": fx(ctes, "SELECT _row_id AS written, _row_id FROM sales"),
        "parquet_positions": fx(ctes, """SELECT _row_id AS written, CASE WHEN regexp_matches(sale_date, '^\\s*\\d{4}-\\d{2}-\\d{2}$')
              THEN strftime(try_cast(trim(sale_date) AS DATE), '%Y-%m-%d') END AS sale_date, _row_id FROM sales"""),
        "header_gate": fx(ctes, "SELECT DISTINCT 'discount' AS missing_column FROM sales WHERE _row_id % 2 = 1"),
        "input_gate": fx(ctes, f"SELECT * FROM ({four})"),
        "findings_by_layer_files": w(f"SELECT {cols} FROM findings"),
    }


def _report_sql(rules: Rules, wc, cols: str) -> dict[str, str]:
    from qualis.operators import reports as RPm
    reg = ", ".join(f"({S.q(c)}, {S.q(l)}, {S.q(sv)}, {S.q(a)})" for c, l, sv, a, _ in rules.rules_rows())
    flag = [c for c, a in rules.config["cleaning_actions"].items() if a == "FLAG"]
    four = {"s": "sales", "c": "customers", "p": "products", "t": "targets"}
    clean4 = {"s": "cs", "c": "cc", "p": "cp", "t": "targets"}
    meaning = " ".join(f"WHEN {S.q(k)} THEN {S.q(v)}" for k, v in {**RPm.FIX_NOTE_CHECKS, **RPm.RESIDUAL_CHECKS}.items())
    # data dictionary / column profile
    prof = []
    for t in ("sales", "customers", "products", "targets"):
        req, opt, types = rules.required(t), rules.optional(t), rules.types(t)
        cl = list(req) + [c for c in opt if c not in req]
        for i, c in enumerate(cl):
            typ = types.get(c, "string")
            bad = (f"{c} IS NOT NULL AND {S.parse_date(c)} IS NULL" if typ == "date" else
                   f"{c} IS NOT NULL AND {S.parse_float(c)} IS NULL" if typ == "numeric" else "false")
            desc = RPm.PK_DESCRIPTIONS.get((t, c), RPm.DESCRIPTIONS.get(c, ""))
            prof.append(f"""SELECT {S.q(t)} AS "table", {i} AS ord, {S.q(c)} AS "column", {S.q(typ)} AS type,
                {S.q('required' if c in req else 'optional')} AS required, {S.q(desc)} AS description,
                count(*) AS rows, count(*) FILTER (WHERE {c} IS NULL) AS nulls,
                count(*) FILTER (WHERE {bad}) AS unparseable FROM {t}""")
    for i, (c, text) in enumerate(RPm.DERIVED):
        prof.append(f"""SELECT 'clean_master', {i}, {S.q(c)}, 'derived', '', {S.q(text)}, NULL, NULL, NULL""")
    stack = lambda sc: f"""SELECT 'Quality score' AS metric, CAST(score AS BIGINT) AS v FROM ({sc})
        UNION ALL SELECT 'Critical', n_critical FROM ({sc}) UNION ALL SELECT 'Major', n_major FROM ({sc})
        UNION ALL SELECT 'Minor', n_minor FROM ({sc}) UNION ALL SELECT 'Total issues', total_errors FROM ({sc})"""
    fl = 'f."table", row_ref, check_id, "column", original_value, fixed_value, note'
    return {
        "residual_classes": wc(f"""SELECT check_id, count(*) AS n,
            check_id IN ({', '.join(S.q(x) for x in flag)}) AS is_flag_class FROM c2_findings GROUP BY check_id"""),
        "master_integrity": wc(f"""SELECT count(*) AS rows,
            count(*) FILTER (WHERE gross_revenue IS NULL) AS null_gross,
            count(*) FILTER (WHERE net_revenue IS NULL) AS null_net,
            count(*) FILTER (WHERE customer_id IS NOT NULL AND customer_name IS NULL) AS customer_gaps,
            count(*) FILTER (WHERE product_id IS NOT NULL AND product_name IS NULL) AS product_gaps,
            count(*) FILTER (WHERE length(quality_flag) > 0) AS flagged_rows,
            count(*) FILTER (WHERE {S.round_cents(f"{S.to_number('quantity')} * {S.to_number('unit_price')}")}
                             IS DISTINCT FROM gross_revenue) AS revenue_mismatch FROM clean_master"""),
        "errors_summary": wc(f"""WITH_REG AS (SELECT 1) SELECT r.check_id, g.layer, g.severity, g.cleaning_action,
              r.found_raw, COALESCE(c.n, 0) AS remaining_after_clean
            FROM (SELECT check_id, count(*) AS found_raw FROM findings GROUP BY check_id) r
            JOIN (SELECT * FROM (VALUES {reg}) t(check_id, layer, severity, cleaning_action)) g ON r.check_id = g.check_id
            LEFT JOIN (SELECT check_id, count(*) AS n FROM c2_findings GROUP BY check_id) c ON r.check_id = c.check_id
            UNION ALL SELECT 'TOTAL', '', '', '', (SELECT count(*) FROM findings),
              (SELECT count(*) FROM c2_findings)""")
        .replace("WITH_REG AS (SELECT 1) ", ""),
        "findings_per_check": wc("SELECT check_id, cleaning_action, count(*) AS found FROM findings "
                                 "GROUP BY check_id, cleaning_action"),
        "residual_split": wc(f"""SELECT CASE WHEN check_id IN ({', '.join(S.q(x) for x in RPm.FIX_NOTE_CHECKS)})
              THEN 'documented_fix' ELSE 'residual' END AS kind, check_id, n,
              CASE check_id {meaning} ELSE '' END AS meaning FROM clean_counts WHERE metric = 'flagged'"""),
        "before_after": wc(f"""SELECT b.metric, b.v AS before, a.v AS after
            FROM ({stack(_score_sql(rules, 'findings', four))}) b
            JOIN ({stack(_score_sql(rules, 'c2_findings', clean4))}) a ON a.metric = b.metric"""),
        "data_dictionary": wc("\nUNION ALL\n".join(prof)),
        "findings_head_per_layer": wc(f"""SELECT {cols} FROM (SELECT *, row_number() OVER
            (PARTITION BY check_layer ORDER BY _seq) AS rk FROM findings) WHERE rk <= 3"""),
        "fix_examples": wc(f"""SELECT {fl} FROM (SELECT *, row_number() OVER (PARTITION BY check_id ORDER BY _seq)
            AS rk FROM fix_log) f WHERE rk <= 2"""),
        "flagged_master": wc(f"SELECT {', '.join(MS.MASTER_ORDER + ['active_status'])} FROM clean_master "
                             "WHERE length(quality_flag) > 0"),
        "sample_rows": wc(f"""SELECT {', '.join(SALES_COLUMNS)} FROM sales WHERE sale_id IN (
            SELECT row_ref FROM (SELECT row_ref, row_number() OVER (PARTITION BY check_id ORDER BY _seq) AS rk
              FROM findings WHERE check_id IN ('COM_001', 'SCH_002', 'BIZ_003', 'BIZ_005', 'REL_001')) WHERE rk = 1)"""),
        "master_head": wc(f"""SELECT {', '.join(MS.MASTER_ORDER + ['active_status'])} FROM clean_master
            ORDER BY _row_id LIMIT 6"""),
        "clean_baseline_rows": wc(f"""SELECT {', '.join(SALES_COLUMNS)} FROM sales s WHERE NOT EXISTS (
            SELECT 1 FROM findings f WHERE f."table" = 'sales' AND f.row_ref = s.sale_id)"""),
    }


def _tamper(base: list[str], o: Oracle, replaced: str) -> list[str]:
    src = {"sales": "tsales", "customers": "icustomers", "products": "iproducts", "targets": "targets"}
    return base + [f"tsales AS (SELECT * REPLACE ({replaced}) FROM isales)"] + o.finding_ctes(src, "t_")


def _self_check_sql(rules: Rules) -> str:
    b, plan = rules.business, IJ.InjectionPlan()
    num = S.parse_float
    tests = {
        "SCH_002": f"sale_date IS NOT NULL AND NOT COALESCE({S.is_iso('sale_date')}, false)",
        "COM_001": "customer_id IS NULL", "COM_002": "product_id IS NULL", "COM_003": "sale_date IS NULL",
        "REL_001": "customer_id IS NOT NULL AND customer_id NOT IN (SELECT customer_id FROM icustomers WHERE customer_id IS NOT NULL)",
        "REL_002": "product_id IS NOT NULL AND product_id NOT IN (SELECT product_id FROM iproducts WHERE product_id IS NOT NULL)",
        "REL_003": "product_id IN (SELECT product_id FROM iproducts GROUP BY product_id HAVING NOT bool_or(active_status = 'active'))",
        "BIZ_001": f"{num('quantity')} < {float(b['min_quantity'])}", "BIZ_002": f"{num('unit_price')} < {float(b['min_unit_price'])}",
        "BIZ_003": f"NOT ({num('discount')} BETWEEN 0 AND {float(b['max_discount'])})",
        "BIZ_004": f"{S.parse_date('sale_date')} > DATE {S.q(rules.audit_date)}",
        "BIZ_005": f"region NOT IN ({', '.join(map(S.q, rules.allowed['regions']))})",
        "BIZ_006": f"sales_channel NOT IN ({', '.join(map(S.q, rules.allowed['sales_channels']))})",
        "BIZ_007": f"{num('quantity')} >= {IJ.OUTLIER_FROM}",
    }
    rows = [f"SELECT {S.q(k)} AS error_class, count(*) FILTER (WHERE {v}) AS in_data FROM isales" for k, v in tests.items()]
    rows += ["SELECT 'COM_004', count(*) * 2 - count(quantity) - count(unit_price) FROM isales",
             "SELECT 'COM_005', count(*) * 3 - count(discount) - count(region) - count(sales_channel) FROM isales"]
    ranges = [(k, "sales", lo, hi) for k, lo, hi in plan.ranges()] + [
        ("UNI_002", "customers", 0, plan.master_rates["UNI_002"]), ("UNI_003", "products", 0, plan.master_rates["UNI_003"])]
    totals = []
    for t, key, cid, more in (("sales", "sale_id", "UNI_001", 0), ("customers", "customer_id", "UNI_002", 0),
                              ("products", "product_id", "UNI_003", IJ.N_INACTIVE)):
        rows += [f"SELECT {S.q(cid)}, (SELECT count(*) - count(DISTINCT {key}) FROM i{t}) "
                 f"- (SELECT count(*) - count(DISTINCT {key}) FROM {t})",
                 f"SELECT 'ROWS_{t}', (SELECT count(*) FROM i{t})"]
        totals.append(f"SELECT 'ROWS_{t}', (SELECT count(*) FROM {t}) + {more} + "
                      f"(SELECT count(*) FROM imanifest WHERE error_class = {S.q(cid)})")
    planned = " UNION ALL ".join(f"SELECT {S.q(k)} AS error_class, (SELECT count(*) * {hi} // {IJ.BUCKETS} "
                                 f"- count(*) * {lo} // {IJ.BUCKETS} FROM {t}) AS planned" for k, t, lo, hi in ranges)
    logged = "SELECT error_class, count(*) AS n FROM imanifest GROUP BY error_class UNION ALL " + " UNION ALL ".join(totals)
    return f"""SELECT x.error_class, CAST(x.in_data AS BIGINT) AS in_data, COALESCE(m.n, 0) AS in_manifest, p.planned,
          CASE WHEN x.in_data = COALESCE(m.n, 0) AND (p.planned IS NULL OR COALESCE(m.n, 0) = p.planned)
            THEN 'OK' ELSE 'MISMATCH' END AS status
        FROM ({' UNION ALL '.join(rows)}) x LEFT JOIN ({logged}) m ON m.error_class = x.error_class
        LEFT JOIN ({planned}) p ON p.error_class = x.error_class"""


def _inject_sql(cols: str) -> dict[str, str]:
    irules = Rules(audit_date=IJ.INJECT_AUDIT_DATE).with_overrides(date_min=IJ.INJECT_DATE_MIN)
    io = Oracle(irules)
    src = {"sales": "isales", "customers": "icustomers", "products": "iproducts", "targets": "targets"}
    base = fixture_ctes(clean=True) + inject_ctes(io) + io.finding_ctes(src, "i_")
    wi = lambda body: Oracle.with_(base, body)
    ibase = base + clean_ctes(io, {"sales": "isales", "customers": "icustomers", "products": "iproducts",
                                   "findings": "i_findings"}, "ic_")
    e = """SELECT "table", row_ref, error_class AS check_id FROM iexpected"""
    d = """SELECT "table", row_ref, check_id FROM i_findings"""
    bsrc = {t: t for t in ("sales", "customers", "products", "targets")}
    t = """SELECT "table", row_ref, check_id FROM t_findings"""
    both = f"""SELECT *, 'missed' AS kind FROM ({e} EXCEPT ALL {t}) UNION ALL
        SELECT *, 'unexpected' AS kind FROM ({t} EXCEPT ALL {e})"""
    return {
        "inject_manifest": wi('SELECT "table", row_ref, error_class, "column", detail FROM imanifest'),
        "inject_counts": wi("SELECT error_class, count(*) AS n FROM imanifest GROUP BY error_class"),
        "inject_self_check": wi(_self_check_sql(irules)),
        "manifest_scan": wi('SELECT "table", row_ref, error_class, "column", detail FROM imanifest'),
        "detect_repaired": Oracle.with_(_tamper(base, io, """CASE WHEN _row_id = (SELECT min(_row_id) FROM isales s
              WHERE customer_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM icustomers c WHERE c.customer_id = s.customer_id))
              THEN (SELECT min(customer_id) FROM icustomers) ELSE customer_id END AS customer_id"""), both),
        "detect_added": Oracle.with_(_tamper(base, io, """CASE WHEN _row_id = (SELECT min(_row_id) FROM isales s
              WHERE sale_id IS NULL OR NOT EXISTS (SELECT 1 FROM iexpected e WHERE e."table" = 'sales' AND e.row_ref = s.sale_id))
              THEN 'Narnia' ELSE region END AS region"""), both),
        "inject_dirty_sales": wi(f"SELECT {', '.join(SALES_COLUMNS)}, _row_id FROM isales"),
        "detect_summary": wi(f"""SELECT *, CASE WHEN missed = 0 AND unexpected = 0 AND matched = expected
              THEN 'VERIFIED' ELSE 'FAILED' END AS verdict FROM (SELECT
              (SELECT count(*) FROM ({e})) AS expected, (SELECT count(*) FROM ({d})) AS detected,
              (SELECT count(*) FROM ({e} INTERSECT ALL {d})) AS matched,
              (SELECT count(*) FROM ({e} EXCEPT ALL {d})) AS missed,
              (SELECT count(*) FROM ({d} EXCEPT ALL {e})) AS unexpected)"""),
        "detect_by_class": wi("""SELECT COALESCE(i.check_id, d.check_id) AS check_id, COALESCE(i.n, 0) AS injected,
              COALESCE(d.n, 0) AS detected, CASE WHEN COALESCE(i.n, 0) = COALESCE(d.n, 0) THEN 'OK'
              ELSE 'MISMATCH' END AS status
            FROM (SELECT error_class AS check_id, count(*) AS n FROM iexpected GROUP BY error_class) i
            FULL OUTER JOIN (SELECT check_id, count(*) AS n FROM i_findings GROUP BY check_id) d
              ON i.check_id = d.check_id"""),
        "cleaning_balance": Oracle.with_(ibase, """SELECT findings, acted, findings = acted AS balanced FROM (
              SELECT (SELECT count(*) FROM i_findings) AS findings,
                (SELECT CAST(COALESCE(sum(n), 0) AS BIGINT) FROM ic_clean_counts
                 WHERE metric IN ('dropped', 'fixed') OR (metric = 'flagged' AND check_id <> 'BIZ_003')) AS acted)"""),
        "detect_matched": wi(f"{e} INTERSECT ALL {d}"),
        "detect_missed": wi(f"{e} EXCEPT ALL {d}"),
        "detect_unexpected": wi(f"{d} EXCEPT ALL {e}"),
        "baseline_check": Oracle.with_(fixture_ctes(clean=True) + inject_ctes(io) + io.finding_ctes(bsrc, "b_"),
            """SELECT CAST((SELECT count(*) FROM sales) + (SELECT count(*) FROM customers)
                 + (SELECT count(*) FROM products) + (SELECT count(*) FROM targets) AS BIGINT) AS total_row_count,
               (SELECT count(*) FROM b_findings) AS baseline_findings,
               (SELECT count(*) FROM natural_dups) AS natural_duplicates"""),
    }
