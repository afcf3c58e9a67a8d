"""Registered queries of exact names, exact number text, Unicode digits, and tables read back,
with their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qualis.functions import parse as P
from qualis.operators import clean as CL
from qualis.operators import findings as FD
from qualis.operators import master as MS
from qualis.operators import reports as RP
from qualis.operators import score as SC
from qualis.plans import catalog as Q
from qualis.plans import sqlfn as S
from qualis.plans.oracle import Oracle, clean_ctes, fixture_ctes
from qualis.sources import names as NM
from qualis.sources import readers as RD
from qualis.sources import sinks as SK
from qualis.sources.fixture import SALES_COLUMNS

OTHER = [c for c in SALES_COLUMNS if c != "discount"]


def csv_case_names(spark: SparkSession, sf: str) -> DataFrame:
    """IO1: ``Sale_ID`` is no ``sale_id``, ``Discount`` no ``discount``, and a repeated name is numbered."""
    s, path = Q.Ctx(spark, sf).tables["sales"], Q._scratch(spark, "csv")
    cell = lambda c: F.when(F.col(c).isNull(), "").otherwise(
        F.concat(F.lit('"'), F.replace(F.col(c), F.lit('"'), F.lit('""')), F.lit('"')))
    rows = s.select("_row_id", F.concat_ws(",", *map(cell, ["sale_id", "discount", "region", "sale_date", "quantity"])).alias("value"))
    head = F.lit("Sale_ID,discount,Discount,x,x")
    # the header stands in front of the first line of every file
    files = Q.in_file_order(rows, 4)
    first = (F.monotonically_increasing_id() % (1 << 33)) == 0
    files.select(F.when(first, F.concat(head, F.lit("\n"), "value")).otherwise(F.col("value")).alias("value")).write.text(path)
    df = RD.empty_to_null(RD.read_csv_text(spark, path, ["sale_id"]))
    name = {own: F.col(f"`{c}`") for c, own in NM.own_names(df).items()}
    return df.select("_row_id", name["sale_id"].alias("lower_id"), name["Sale_ID"].alias("upper_id"), name["discount"].alias("discount"),
                     name["Discount"].alias("other_discount"), name["x"].alias("x0"), name["x.1"].alias("x1"))


def _renamed(spark: SparkSession, sf: str):
    c = Q.Ctx(spark, sf)
    tables = dict(c.tables)
    tables["sales"] = tables["sales"].withColumnRenamed("discount", "Discount")
    found = FD.findings(tables, c.rules)
    return found, CL.clean(tables, found, c.rules)


def clean_case_names(spark: SparkSession, sf: str) -> DataFrame:
    """A sales table with ``Discount`` has no ``discount``: no check reads it, its values stay."""
    _, res = _renamed(spark, sf)
    return NM.restore(res.cleaned["sales"]).select(*OTHER, F.col("Discount").alias("kept"), "quality_flag")


def findings_case_names(spark: SparkSession, sf: str) -> DataFrame:
    return SC.by_check(_renamed(spark, sf)[0])


def fn_format_g(spark: SparkSession, sf: str) -> DataFrame:
    """F8: decimals of seven digits that end in 5 (ties, or just beside one), and plain quotients."""
    rows = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    six = F.lit(100000) + (F.col("l_orderkey").cast("long") * 7919 + F.col("l_linenumber").cast("long") * 104729) % 900000
    k = (F.col("l_orderkey").cast("long") + F.col("l_linenumber").cast("long")) % 12
    return rows.select(
        F.col("l_orderkey").cast("long").alias("a"), F.col("l_linenumber").cast("long").alias("b"),
        P.fmt_g((six * 10 + 5).cast("double") / F.pow(F.lit(10.0), k.cast("double"))).alias("tie"),
        P.fmt_g((six * 10 + 5).cast("double") * F.pow(F.lit(10.0), k.cast("double"))).alias("large"),
        P.fmt_g(F.col("l_extendedprice").cast("double") / (F.col("l_quantity").cast("double") + 7)).alias("quotient"))


def fn_unicode_digits(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers and dates in other decimal digits; a month must be ASCII."""
    rows = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    arabic = lambda x: F.translate(x, "0123456789", "٠١٢٣٤٥٦٧٨٩")
    day = F.col("l_shipdate").cast("date").cast("string")
    return rows.select(
        F.col("l_orderkey").cast("long").alias("a"), F.col("l_linenumber").cast("long").alias("b"),
        arabic(F.col("l_orderkey").cast("string")).alias("_n"),
        F.concat(arabic(F.substring(day, 1, 4)), F.substring(day, 5, 6)).alias("_y"), arabic(day).alias("_all")).select(
        "a", "b", P.parse_float("_n").alias("n"), P.parse_date("_y").alias("y"), P.is_iso_date("_y").alias("iso"),
        P.parse_date("_all").alias("none"), P.is_iso_date("_all").alias("no_iso"))


def score_empty_findings(spark: SparkSession, sf: str) -> DataFrame:
    """Rows without any finding score 100."""
    c = Q.Ctx(spark, sf)
    return SC.score(c.findings.where(F.lit(False)), c.tables, c.rules)


def master_read_back(spark: SparkSession, sf: str) -> DataFrame:
    """IO8: the master as it was written."""
    path = Q._scratch(spark, "master")
    SK.write_table(MS.build_master(Q.Ctx(spark, sf).cleaning.cleaned), path)
    return spark.read.parquet(path)


def reports_read_back(spark: SparkSession, sf: str) -> DataFrame:
    """IO10: a report table written twice over the same place and read back once."""
    path = Q._scratch(spark, "summary")
    c = Q.Ctx(spark, sf)
    for _ in range(2):
        SK.write_table(RP.errors_summary(c.findings, c.findings_clean, spark, c.rules), path)
    return spark.read.parquet(path)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    csv_case_names, clean_case_names, findings_case_names, fn_format_g, fn_unicode_digits, score_empty_findings,
    master_read_back, reports_read_back)}


def oracle_sql() -> dict[str, str]:
    rules = Q.fixture_rules()
    o = Oracle(rules)
    own = Q.oracle_sql()
    # without a discount column nothing is found about it: as if every cell were a good one
    src = {"sales": "nsales", "customers": "customers", "products": "products", "targets": "targets"}
    blank = fixture_ctes() + ["nsales AS (SELECT * REPLACE ('0' AS discount) FROM sales)"] + o.finding_ctes(src, "n_")
    cleaned = blank + clean_ctes(o, {"sales": "nsales", "customers": "customers", "products": "products", "findings": "n_findings"}, "n_")
    six = "(100000 + (CAST(l_orderkey AS BIGINT) * 7919 + CAST(l_linenumber AS BIGINT) * 104729) % 900000)"
    k = "((CAST(l_orderkey AS BIGINT) + CAST(l_linenumber AS BIGINT)) % 12)"
    tie, power = f"CAST({six} * 10 + 5 AS DOUBLE)", f"pow(10.0::DOUBLE, CAST({k} AS DOUBLE))"
    four = {t: t for t in ("sales", "customers", "products", "targets")}
    return {
        "csv_case_names": Oracle.with_(fixture_ctes(), """SELECT _row_id, CAST(NULL AS VARCHAR) AS lower_id, sale_id AS upper_id,
            discount, region AS other_discount, sale_date AS x0, quantity AS x1 FROM sales"""),
        "clean_case_names": Oracle.with_(cleaned, f"""SELECT {', '.join(f'n.{c}' for c in OTHER)}, s.discount AS kept, n.quality_flag
            FROM n_cs_raw n JOIN sales s ON s._row_id = n._old"""),
        "findings_case_names": Oracle.with_(blank, "SELECT check_id, count(*) AS n FROM n_findings GROUP BY check_id"),
        "fn_format_g": f"""SELECT CAST(l_orderkey AS BIGINT) AS a, CAST(l_linenumber AS BIGINT) AS b, {S.fmt_g('tie')} AS tie,
            {S.fmt_g('large')} AS large, {S.fmt_g('quotient')} AS quotient
            FROM (SELECT l_orderkey, l_linenumber, {tie} / {power} AS tie, {tie} * {power} AS large,
              CAST(l_extendedprice AS DOUBLE) / (CAST(l_quantity AS DOUBLE) + 7) AS quotient FROM lineitem)""",
        "fn_unicode_digits": """SELECT CAST(l_orderkey AS BIGINT) AS a, CAST(l_linenumber AS BIGINT) AS b, CAST(l_orderkey AS DOUBLE) AS n,
            CAST(l_shipdate AS DATE) AS y, true AS iso, CAST(NULL AS DATE) AS none, false AS no_iso FROM lineitem""",
        "score_empty_findings": Oracle.with_(
            o.base() + ["no_findings AS (SELECT * FROM findings WHERE false)"],
            "SELECT * REPLACE (CAST(weighted_error_points AS DOUBLE) AS weighted_error_points) FROM ("
            + Q._score_sql(rules, "no_findings", four) + ")"),
        "master_read_back": own["clean_master"],
        "reports_read_back": own["errors_summary"],
    }


