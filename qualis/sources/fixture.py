"""The dirty audit fixture, derived by Spark from the TPC-H-like test tables.

Four all-text tables (sales, customers, products, targets) with defects placed
by a deterministic slot per line item, so that every check has work at every
scale and the DuckDB oracle can rebuild the same rows from the same parquet.
Each table carries ``_row_id``: its row position in the configured order
columns (the file order of a real landing file).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qualis.session import cut, setting
from qualis.sources import rowindex as RI
from qualis.sources.rowindex import block_sequence

# Fixed values of the fixture recipe.
SALES_COLUMNS = ["sale_id", "sale_date", "customer_id", "product_id", "quantity", "unit_price",
                 "discount", "region", "sales_channel"]
CUSTOMER_COLUMNS = ["customer_id", "customer_name", "customer_segment", "country", "signup_date"]
PRODUCT_COLUMNS = ["product_id", "product_name", "category", "standard_price", "active_status"]
TARGET_COLUMNS = ["month", "region", "target_revenue"]

# Rule overrides that go with the fixture (natural BIZ_004 on both sides).
FIXTURE_DATE_MIN = "1995-03-01"
FIXTURE_AUDIT_DATE = "2001-09-30"

BLOCK_WIDTH = 512  # a window keeps up to 4,096 rows of a block in plain memory


def _s(c: Column) -> Column:
    return c.cast("string")


def _in(slot: Column, *vals: int) -> Column:
    return slot.isin(*vals)


# The extended fixture: two more sales columns, and slots 43-51 for values that
# the base fixture does not reach (see FIXTURES.md for the base slots).
EXTRA_COLUMNS = ["order_note", "ship_date"]
EXTRA_DOUBLED = [45, 47, 49]
EXTRA_SYNONYMS = {"nord": "North", "norden": "nord"}


def sales_raw(spark: SparkSession, sf_dir: str, clean: bool = False, extended: bool = False) -> DataFrame:
    rd = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    li = rd("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                               "l_discount", "l_returnflag", "l_shipdate")
    o = rd("orders").select("o_orderkey", "o_custkey")
    c = rd("customer").select("c_custkey", "c_nationkey")
    n = rd("nation").select("n_nationkey", "n_regionkey")
    r = rd("region").select("r_regionkey", "r_name")
    p = rd("part").select("p_partkey", "p_retailprice")
    # Customers are joined to the fewer orders. The line items stay numbers; they meet their orders
    # dealt by block, so the shuffle of that join serves the ranks inside the blocks too. Texts are
    # made when the rows are numbered, behind any shuffle.
    oc = (o.join(c.hint("shuffle_hash"), F.col("o_custkey") == c.c_custkey)
          .join(n, F.col("c_nationkey") == n.n_nationkey)
          .join(r, F.col("n_regionkey") == r.r_regionkey).select("o_orderkey", "o_custkey", "r_name"))
    tasks = RI.tasks_of(li)
    by_block = lambda df, key: RI.dealt(df.withColumn("_blk", F.floor(F.col(key) / BLOCK_WIDTH)), tasks, "_blk")
    j = (by_block(li.join(p.hint("shuffle_hash"), F.col("l_partkey") == p.p_partkey), "l_orderkey")
         .join(by_block(oc.withColumnRenamed("o_orderkey", "l_orderkey"), "l_orderkey").hint("shuffle_hash"),
               ["_blk", "l_orderkey"]))
    slot = (F.col("l_orderkey") * 31 + F.col("l_partkey") * 17 + F.col("l_suppkey") * 7
            + F.col("l_linenumber")) % 1000
    # clean=True: the baseline without placed defects (every slot clean).
    j = j.withColumn("slot", F.lit(-1).cast("long") if clean else slot)
    # Slots 41 and 42 (and the extended doubles) are emitted twice: copy 1 is a duplicate sale.
    twice = [41, 42] + (EXTRA_DOUBLED if extended else [])
    # One pass over the joins gives both copies.
    rows = j.withColumn("copy_no", F.explode(F.when(F.col("slot").isin(*twice), F.array(F.lit(0), F.lit(1)))
                                             .otherwise(F.array(F.lit(0)))))
    s = F.col("slot")
    d = F.to_date("l_shipdate")
    iso = F.date_format(d, "yyyy-MM-dd")
    ok, ln, pk, sk = (_s(F.col(x)) for x in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    sale_id = F.when(s == 40, "").otherwise(F.concat_ws("-", F.lit("S"), ok, ln, pk, sk))
    sale_date = (F.when(_in(s, 0, 31), F.date_format(d, "dd.MM.yyyy"))
                 .when(s == 1, F.date_format(d, "yyyy/MM/dd"))
                 .when(s == 2, F.date_format(d, "dd-MM-yyyy"))
                 .when(s == 3, F.concat(F.lit(" "), iso))
                 .when(s == 4, "")
                 .when(s == 5, "garbage")
                 .when(s == 6, "2030-06-15")
                 .when(s == 7, "1990-02-30")
                 .otherwise(iso))
    customer_id = (F.when(_in(s, 8, 32), "")
                   .when(s == 9, F.concat(F.lit("C-"), _s(F.col("o_custkey") + 90000000)))
                   .otherwise(F.concat(F.lit("C-"), _s(F.col("o_custkey")))))
    product_id = (F.when(s == 10, "")
                  .when(s == 11, F.concat(F.lit("P-"), _s(F.col("l_partkey") + 90000000)))
                  .otherwise(F.concat(F.lit("P-"), pk)))
    quantity = (F.when(_in(s, 12, 30), "-5")
                .when(s == 13, _s(F.col("l_linenumber") + 400))
                .when(s == 14, "")
                .when(s == 15, "abc")
                .otherwise(_s(F.col("l_quantity").cast("long"))))
    unit_price = (F.when(s == 16, "").when(_in(s, 17, 30), "-12.50")
                  .otherwise(_s(F.col("p_retailprice").cast("decimal(12,2)"))))
    discount = (F.when(s == 18, "").when(s == 19, "-0.1").when(_in(s, 20, 31), "0.75")
                .when(s == 21, "0,5").otherwise(_s(F.col("l_discount").cast("decimal(6,2)"))))
    rn = F.col("r_name")
    region_clean = (F.when(rn == "AFRICA", "North").when(rn == "AMERICA", "South")
                    .when(rn == "ASIA", "East").when(rn == "EUROPE", "West").otherwise("Central"))
    region = (F.when(s == 22, "").when(s == 23, "NORTH ").when(s == 24, "Sued")
              .when(_in(s, 25, 32), "Atlantis")
              .when((s == 42) & (F.col("copy_no") == 1), "Atlantis")
              .otherwise(region_clean))
    rf = F.col("l_returnflag")
    channel = (F.when(s == 26, "").when(s == 27, "Webshop").when(s == 28, "STORE ")
               .when(s == 29, "fax")
               .otherwise(F.when(rf == "A", "online").when(rf == "N", "retail").when(rf == "R", "partner")))
    extra = {}
    if extended:
        discount = (F.when(s == 43, "nan").when((s == 45) & (F.col("copy_no") == 0), "").when(s == 45, "0.9")
                    .otherwise(discount))
        quantity = F.when(s == 44, "1_000").otherwise(quantity)
        region = F.when(_in(s, 46, 47), "Norden").when(s == 49, "NORD ").otherwise(region)
        extra = {"order_note": F.concat(F.lit("note "), ok),
                 "ship_date": F.when(s == 50, F.date_format(d, "dd.MM.yyyy")).when(s == 51, "garbage").otherwise(iso)}
    texts = dict(zip(SALES_COLUMNS, (sale_id, sale_date, customer_id, product_id, quantity, unit_price,
                                     discount, region, channel)))
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "copy_no"]
    rows = rows.select("_blk", *keys, "slot", "l_quantity", "l_discount", "l_returnflag", "l_shipdate", "o_custkey",
                       "r_name", "p_retailprice")
    with setting(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false"):
        out = cut(RI.block_ranks(rows, "_blk", keys))  # counted and numbered below: the joins run once
    seq = RI.numbered(out, "_blk", list(SALES_COLUMNS), texts | extra)
    return seq.select(*sales_columns(extended), "_row_id")


def customers_raw(spark: SparkSession, sf_dir: str, clean: bool = False) -> DataFrame:
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_name", "c_nationkey",
                                                                 "c_mktsegment")
    n = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", "n_name")
    j = c.join(n, c.c_nationkey == n.n_nationkey)
    rows = (j.withColumn("copy_no", F.lit(0))
            .unionByName(j.where((F.col("c_custkey") % 50 == 3) & F.lit(not clean)).withColumn("copy_no", F.lit(1))))
    k = F.col("c_custkey")
    bad = F.lit(not clean)
    seg = F.col("c_mktsegment")
    out = rows.select(
        "c_custkey", "copy_no",
        F.concat(F.lit("C-"), _s(k)).alias("customer_id"),
        F.when(F.col("copy_no") == 1, F.concat(F.col("c_name"), F.lit(" (dup)")))
        .otherwise(F.col("c_name")).alias("customer_name"),
        F.when(seg.isin("BUILDING", "MACHINERY"), "B2B").when(seg == "HOUSEHOLD", "B2C")
        .otherwise("Enterprise").alias("customer_segment"),
        F.col("n_name").alias("country"),
        F.when(bad & (k % 97 == 0), "").when(bad & (k % 97 == 1), "05.03.2021")
        .otherwise(F.concat(F.lit("2021-03-"), F.lpad(_s(k % 28 + 1), 2, "0"))).alias("signup_date"),
    )
    seq = block_sequence(out, ["c_custkey", "copy_no"], [F.floor(k / BLOCK_WIDTH)])
    return seq.select(*CUSTOMER_COLUMNS, "_row_id")


def products_raw(spark: SparkSession, sf_dir: str, clean: bool = False) -> DataFrame:
    p = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_name", "p_type",
                                                             "p_retailprice")
    rows = (p.withColumn("copy_no", F.lit(0))
            .unionByName(p.where((F.col("p_partkey") % 50 == 4) & F.lit(not clean)).withColumn("copy_no", F.lit(1))))
    k = F.col("p_partkey")
    out = rows.select(
        "p_partkey", "copy_no",
        F.concat(F.lit("P-"), _s(k)).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        _s(F.col("p_retailprice").cast("decimal(12,2)")).alias("standard_price"),
        F.when(F.lit(not clean) & ((F.col("copy_no") == 1) | (k % 100 == 7)), "inactive").otherwise("active")
        .alias("active_status"),
    )
    seq = block_sequence(out, ["p_partkey", "copy_no"], [F.floor(k / BLOCK_WIDTH)])
    return seq.select(*PRODUCT_COLUMNS, "_row_id")


def targets_raw(spark: SparkSession, sf_dir: str, clean: bool = False) -> DataFrame:
    n = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", "n_regionkey")
    r = spark.read.parquet(f"{sf_dir}/region.parquet").select("r_regionkey", "r_name")
    k = F.col("n_nationkey")
    out = n.join(r, n.n_regionkey == r.r_regionkey).select(
        "n_nationkey",
        F.concat(F.lit("2000-"), F.lpad(_s(k % 12 + 1), 2, "0")).alias("month"),
        F.col("r_name").alias("region"),
        F.when(F.lit(not clean) & (k == 3), "").when(F.lit(not clean) & (k == 4), "n/a")
        .otherwise(_s(k * 1000 + 50000)).alias("target_revenue"),
    )
    seq = block_sequence(out, ["n_nationkey"], [F.lit(0)])
    return seq.select(*TARGET_COLUMNS, "_row_id")


def sales_columns(extended: bool = False) -> list[str]:
    return SALES_COLUMNS + (EXTRA_COLUMNS if extended else [])


def raw_tables(spark: SparkSession, sf_dir: str, clean: bool = False, extended: bool = False) -> dict[str, DataFrame]:
    """The four raw text tables (empty strings still present); ``clean`` gives
    the defect-free baseline of the same rows, ``extended`` more columns and cases."""
    return {"sales": sales_raw(spark, sf_dir, clean, extended), "customers": customers_raw(spark, sf_dir, clean),
            "products": products_raw(spark, sf_dir, clean), "targets": targets_raw(spark, sf_dir, clean)}
