"""Defect injection as a Spark job (N1-N13): clean tables -> dirty tables +
manifest of every injected defect.

Rows are assigned to defect classes *disjointly and in exact numbers*: rows are
ordered by a multiplicative hash of their position (portable integer arithmetic,
so the SQL oracle can rebuild the same assignment) and then by position, and
consecutive rank ranges belong to the classes of the plan. Nothing is sorted: the
rows at the few ranks where a range ends are found by narrowing hash ranges (a
bounded number of counts a round), and a row's class then follows from comparing
its own hash and position with them. A second hash picks the variant inside a
class (format, column, bad value). Every other step is a row-local expression or
a union, so the job scales with the table and has no hot group. Only the few rows
that get a defect pass the long expressions; they are written once.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qualis.functions import parse as P
from qualis.rules import Rules
from qualis.session import cut
from qualis.sources.rowindex import block_sequence, prefix_offsets

# The reference demo's injection plan (findings per 2,000 sales
# rows; masters: duplicates per 200 customers / 50 products), its bad values,
# and its variant lists.
REFERENCE_PLAN = {
    "SCH_002": 9, "COM_001": 8, "COM_002": 8, "COM_003": 6, "COM_004": 8, "COM_005": 13,
    "UNI_001": 6, "REL_001": 11, "REL_002": 8, "REL_003": 7, "BIZ_001": 8, "BIZ_002": 7,
    "BIZ_003": 10, "BIZ_004": 6, "BIZ_005": 8, "BIZ_006": 7, "BIZ_007": 5,
}
REFERENCE_MASTER_DUPS = {"UNI_002": (4, 200), "UNI_003": (3, 50)}
DATE_FORMATS = ["dd.MM.yyyy", "yyyy/MM/dd", "dd-MM-yyyy"]
OPTIONAL_SALES = ["discount", "region", "sales_channel"]
BAD_QUANTITIES = [-5, -3, -1, 0]
BAD_REGIONS = ["NORTH ", "Sued", "ZENTRAL", "west ", "EAST", "Atlantis", "Mordor", "Springfield"]
BAD_CHANNELS = ["Webshop", "STORE ", "Reseller", "WEB", "Online ", "fax", "carrier-pigeon"]
N_INACTIVE = 5

# Rules that go with the injected baseline: every clean date is plausible.
INJECT_DATE_MIN = "1992-01-01"
INJECT_AUDIT_DATE = "2025-12-31"

OUTLIER_FROM = 350  # least injected outlier quantity; the baseline has none
BUCKETS = 10000
BLOCK = 2048  # rows that share one shift when copies are put between them
_P1, _P2 = 1000003, 999983


def row_hash(pos: Column, seed: int, mod: int = _P1, mult: int = 2654435761) -> Column:
    """Multiplicative hash of a row position, in [0, mod)."""
    return ((pos % F.lit(mod)) * F.lit(mult) + F.lit(seed * 40503)) % F.lit(mod)


CELLS = 4096


def boundaries(df: DataFrame, seed: int, ranks: list[int]) -> list[tuple[int, int]]:
    """(hash, position) of the rows at the given ranks (from 0) in the order of hash and
    position; behind the last row for ranks beyond it."""
    rows = df.select(row_hash(F.col("_row_id"), seed).alias("h"), F.col("_row_id").alias("id"))

    def find(counted: list, rank: int):
        """(row of ``counted`` that holds a rank, rank inside it)."""
        for r in counted:
            if rank < r["n"]:
                return r, rank
            rank -= r["n"]
        return None, rank

    def cells(of: DataFrame, key: Column) -> list:
        return sorted(of.groupBy(key.alias("c")).agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("lo"), F.max("id").alias("hi"))
                      .collect(), key=lambda r: r["c"])

    wide = F.floor(F.col("h") / 256)
    at = [find(coarse, rank) for coarse in [cells(rows, wide)] for rank in ranks]
    fine = cells(rows.where(wide.isin(sorted({c["c"] for c, _ in at if c}))), F.col("h"))  # 256 hashes of each cell
    out = []
    for cell, rest in at:
        if cell is None:
            out.append((_P1, 0))
            continue
        one, rest = find([r for r in fine if r["c"] // 256 == cell["c"]], rest)
        lo, hi = one["lo"], one["hi"]
        while rest:  # rows of one hash, by position
            width = (hi - lo) // CELLS + 1
            inside = rows.where((F.col("h") == one["c"]) & F.col("id").between(lo, hi))
            part, rest = find(cells(inside, F.floor((F.col("id") - lo) / width)), rest)
            lo, hi = part["lo"], part["hi"]
        out.append((one["c"], lo))
    return out


def _from(b: tuple[int, int]) -> Column:
    """Whether a row (hash ``_b``) stands at a boundary or behind it."""
    return (F.col("_b") > b[0]) | ((F.col("_b") == b[0]) & (F.col("_row_id") >= b[1]))


@dataclass
class InjectionPlan:
    seed: int = 42
    # class -> rows out of 10,000 sales rows (disjoint ranges, plan order)
    rates: dict[str, int] = field(default_factory=lambda: {
        k: v * BUCKETS // 2000 for k, v in REFERENCE_PLAN.items()})
    # master duplicate rates out of 10,000 master rows
    master_rates: dict[str, int] = field(default_factory=lambda: {
        k: n * BUCKETS // d for k, (n, d) in REFERENCE_MASTER_DUPS.items()})

    def ranges(self) -> list[tuple[str, int, int]]:
        out, lo = [], 0
        for k, w in self.rates.items():
            out.append((k, lo, lo + w))
            lo += w
        assert lo <= BUCKETS, "plan exceeds 100% of rows"
        return out


def _pick(values: list, k: Column) -> Column:
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (k % F.lit(len(values))).cast("int") + 1)


def inject(tables: dict[str, DataFrame], plan: InjectionPlan | None = None
           ) -> tuple[dict[str, DataFrame], DataFrame]:
    """(dirty tables, manifest(table, row_ref, error_class, column, detail))."""
    plan = plan or InjectionPlan()
    sales, customers, products = tables["sales"], tables["customers"], tables["products"]
    n_rows = sales.count()
    ends = [0, *(n_rows * hi // BUCKETS for _, _, hi in plan.ranges())]
    marks = boundaries(sales, plan.seed, ends)
    k = row_hash(F.col("_row_id"), plan.seed + 1, _P2, 40503)
    cls = F.lit(None).cast("string")
    for (name, _, _), lo, hi in reversed(list(zip(plan.ranges(), marks, marks[1:]))):
        cls = F.when(_from(lo) & ~_from(hi), F.lit(name)).otherwise(cls)
    hashed = sales.withColumn("_b", row_hash(F.col("_row_id"), plan.seed))
    plain = hashed.where(_from(marks[-1])).select(*sales.columns)  # the classes' ranks start at 0
    s = hashed.where(~_from(marks[-1])).withColumn("_k", k).withColumn("_cls", cls)
    c, kk = F.col("_cls"), F.col("_k")
    d = F.to_date("sale_date")
    opt_col = _pick(OPTIONAL_SALES, kk)
    qp_col = F.when(kk % 2 == 0, "quantity").otherwise("unit_price")
    price_bad = F.format_string("%.2f", -(F.lit(1.0) + (kk % 7901).cast("double") / 100.0))
    disc_bad = F.when(kk % 5 == 0, "-0.1").otherwise(
        F.format_string("%.2f", F.lit(0.55) + (kk % 41).cast("double") / 100.0))
    future = F.date_format(F.date_add(F.lit("2030-01-01").cast("date"), (kk % 365).cast("int")), "yyyy-MM-dd")
    wrong_date = F.when(kk % 3 == 0, F.date_format(d, DATE_FORMATS[0])) \
        .when(kk % 3 == 1, F.date_format(d, DATE_FORMATS[1])).otherwise(F.date_format(d, DATE_FORMATS[2]))
    inactive_id = F.concat(F.lit("P-I"), ((kk % N_INACTIVE) + 1).cast("string"))
    new = {
        "sale_date": (F.when(c == "SCH_002", wrong_date).when(c == "COM_003", F.lit(None))
                      .when(c == "BIZ_004", future).otherwise(F.col("sale_date"))),
        "customer_id": (F.when(c == "COM_001", F.lit(None))
                        .when(c == "REL_001", F.concat(F.lit("C-"), (F.col("_row_id") + 90000000).cast("string")))
                        .otherwise(F.col("customer_id"))),
        "product_id": (F.when(c == "COM_002", F.lit(None))
                       .when(c == "REL_002", F.concat(F.lit("P-"), (F.col("_row_id") + 90000000).cast("string")))
                       .when(c == "REL_003", inactive_id).otherwise(F.col("product_id"))),
        "quantity": (F.when((c == "COM_004") & (qp_col == "quantity"), F.lit(None))
                     .when(c == "BIZ_001", _pick(BAD_QUANTITIES, kk).cast("string"))
                     .when(c == "BIZ_007", (F.lit(350) + kk % 351).cast("string"))
                     .otherwise(F.col("quantity"))),
        "unit_price": (F.when((c == "COM_004") & (qp_col == "unit_price"), F.lit(None))
                       .when(c == "BIZ_002", price_bad).otherwise(F.col("unit_price"))),
        "discount": (F.when((c == "COM_005") & (opt_col == "discount"), F.lit(None))
                     .when(c == "BIZ_003", disc_bad).otherwise(F.col("discount"))),
        "region": (F.when((c == "COM_005") & (opt_col == "region"), F.lit(None))
                   .when(c == "BIZ_005", _pick(BAD_REGIONS, kk)).otherwise(F.col("region"))),
        "sales_channel": (F.when((c == "COM_005") & (opt_col == "sales_channel"), F.lit(None))
                          .when(c == "BIZ_006", _pick(BAD_CHANNELS, kk)).otherwise(F.col("sales_channel"))),
    }
    column = (F.when(c.isin("SCH_002", "COM_003", "BIZ_004"), "sale_date")
              .when(c.isin("COM_001", "REL_001"), "customer_id")
              .when(c.isin("COM_002", "REL_002", "REL_003"), "product_id")
              .when(c == "COM_004", qp_col).when(c == "COM_005", opt_col)
              .when(c.isin("BIZ_001", "BIZ_007"), "quantity").when(c == "BIZ_002", "unit_price")
              .when(c == "BIZ_003", "discount").when(c == "BIZ_005", "region")
              .when(c == "BIZ_006", "sales_channel").when(c == "UNI_001", "sale_id"))
    injected = cut(s.withColumns({**new, "_col": column}).select(*sales.columns, "_cls", "_col"))
    value = F.coalesce(*[F.when(F.col("_col") == x, F.col(x)) for x in new], F.lit("<empty>"))
    detail = F.when(c == "UNI_001", F.concat(F.lit("duplicate sale_id "), F.col("sale_id"))) \
        .otherwise(F.concat(F.col("_col"), F.lit(" -> '"), value, F.lit("'")))
    manifest_sales = injected.where(c.isNotNull()).select(
        F.lit("sales").alias("table"), F.col("sale_id").alias("row_ref"), c.alias("error_class"),
        F.col("_col").alias("column"), detail.alias("detail"))
    # Duplicate sales rows (copies follow their original).
    dirty_sales = _resequence(plain.unionByName(injected.select(*sales.columns)),
                              injected.where(c == "UNI_001").select(*sales.columns), sales)

    def master_dups(df: DataFrame, key: str, cid: str, rate: int) -> tuple[DataFrame, DataFrame]:
        end, = boundaries(df, plan.seed + 7, [df.count() * rate // BUCKETS])
        dups = df.withColumn("_b", row_hash(F.col("_row_id"), plan.seed + 7)).where(~_from(end)).select(*df.columns)
        out = _resequence(df, dups, df)
        man = dups.select(F.lit(df_name[key]).alias("table"), F.col(key).alias("row_ref"),
                                          F.lit(cid).alias("error_class"), F.lit(key).alias("column"),
                                          F.concat(F.lit(f"duplicate {key} "), F.col(key)).alias("detail"))
        return out, man

    df_name = {"customer_id": "customers", "product_id": "products"}
    dirty_customers, man_c = master_dups(customers, "customer_id", "UNI_002", plan.master_rates["UNI_002"])
    dirty_products, man_p = master_dups(products, "product_id", "UNI_003", plan.master_rates["UNI_003"])
    # Inactive products referenced by REL_003 rows, appended to the master.
    n = dirty_products.agg(F.count(F.lit(1)).alias("_n"))
    extra = (dirty_products.sparkSession.range(1, N_INACTIVE + 1).crossJoin(F.broadcast(n))
             .select(F.concat(F.lit("P-I"), F.col("id").cast("string")).alias("product_id"),
                     F.concat(F.lit("Inactive product "), F.col("id").cast("string")).alias("product_name"),
                     F.lit("Inactive").alias("category"), F.lit("10.00").alias("standard_price"),
                     F.lit("inactive").alias("active_status"), (F.col("_n") + F.col("id") - 1).alias("_row_id")))
    dirty_products = dirty_products.unionByName(extra.select(*dirty_products.columns))
    keep = [x for x in sales.columns]
    dirty = {"sales": dirty_sales.select(*keep), "customers": dirty_customers.select(*customers.columns),
             "products": dirty_products, "targets": tables["targets"]}
    return dirty, manifest_sales.unionByName(man_c).unionByName(man_p)


def _resequence(rows: DataFrame, doubled: DataFrame, base: DataFrame) -> DataFrame:
    """``rows`` (the positions of ``base``) and a copy right after each of ``doubled``, on new dense positions.

    A row moves by the number of copies before it. Dense positions need no ranks for that: each block
    has the copies of earlier blocks and the positions of its own, a small table that the rows meet
    without a shuffle of their own as long as it is small enough to broadcast."""
    both = rows.withColumn("_copy", F.lit(0)).unionByName(doubled.withColumn("_copy", F.lit(1)))
    block = F.floor(F.col("_row_id") / BLOCK)
    n, lo, hi = base.agg(F.count(F.lit(1)), F.min("_row_id"), F.max("_row_id")).first()
    if not n or (lo, hi) != (0, n - 1):
        out = block_sequence(both, ["_row_id", "_copy"], [block], out="_new")
    else:
        own = doubled.groupBy(block.alias("_blk")).agg(F.array_sort(F.collect_list("_row_id")).alias("_ids"))
        blocks = (base.sparkSession.range(hi // BLOCK + 1).select(F.col("id").alias("_blk")).join(own, "_blk", "left")
                  .withColumn("_ids", F.coalesce("_ids", F.array().cast("array<bigint>"))))
        earlier = prefix_offsets(blocks.select("_blk", F.size("_ids").alias("_n")), ["_blk"], "_n")
        before = F.size(F.filter("_ids", lambda x: x < F.col("_row_id")))
        out = (both.withColumn("_blk", block).join(cut(blocks.join(earlier, "_blk")), "_blk")
               .withColumn("_new", F.col("_row_id") + F.col("_off") + before + F.col("_copy")).drop("_blk", "_off", "_ids"))
    return out.drop("_row_id", "_copy").withColumnRenamed("_new", "_row_id")


def manifest_counts(manifest: DataFrame) -> DataFrame:
    """Injected findings per class."""
    return manifest.groupBy("error_class").agg(F.count(F.lit(1)).alias("n"))


def self_check(base: dict[str, DataFrame], dirty: dict[str, DataFrame], manifest: DataFrame,
               rules: Rules, plan: InjectionPlan | None = None) -> DataFrame:
    """Bookkeeping check of every class and of the row totals.

    ``in_data`` is measured on the dirty tables by plain predicates (not by the
    checks), ``in_manifest`` is what was logged, ``planned`` the plan's number of rows;
    the three must be equal. Row totals: base rows plus logged copies (plus the
    appended inactive products)."""
    plan = plan or InjectionPlan()
    s, b = dirty["sales"], rules.business
    customers = dirty["customers"].where("customer_id IS NOT NULL").select("customer_id").distinct()
    products = dirty["products"].where("product_id IS NOT NULL").groupBy("product_id") \
        .agg(F.max(F.col("active_status") == "active").alias("_active"))
    # only the keys are shuffled
    unknown = (s.where("customer_id IS NOT NULL").select("customer_id").join(customers.hint("shuffle_hash"), "customer_id", "left_anti")
               .agg(F.count(F.lit(1)).alias("REL_001")))
    status = (s.where("product_id IS NOT NULL").select("product_id").join(products.hint("shuffle_hash"), "product_id", "left")
              .agg(F.count_if(F.col("_active").isNull()).alias("REL_002"), F.count_if(~F.col("_active")).alias("REL_003")))
    number = lambda c: P.parse_float(c)
    col, missing = F.col, lambda c: F.col(c).isNull().cast("long")
    outlier = number("quantity") >= OUTLIER_FROM
    tests = {
        "SCH_002": col("sale_date").isNotNull() & ~F.coalesce(P.is_iso_date("sale_date"), F.lit(False)),
        "COM_001": missing("customer_id"), "COM_002": missing("product_id"), "COM_003": missing("sale_date"),
        "COM_004": missing("quantity") + missing("unit_price"),
        "COM_005": missing("discount") + missing("region") + missing("sales_channel"),
        "BIZ_001": number("quantity") < float(b["min_quantity"]),
        "BIZ_002": number("unit_price") < float(b["min_unit_price"]),
        "BIZ_003": ~number("discount").between(0.0, float(b["max_discount"])),
        "BIZ_004": P.parse_date("sale_date") > F.lit(rules.audit_date).cast("date"),
        "BIZ_005": ~col("region").isin(rules.allowed["regions"]),
        "BIZ_006": ~col("sales_channel").isin(rules.allowed["sales_channels"]),
        "BIZ_007": outlier,
    }
    # copies are injected rows of class UNI_001 with no other defect, so they add to no other class
    aggs = [F.coalesce(F.sum(t.cast("long")), F.lit(0)).alias(k) for k, t in tests.items()]
    counted = s.agg(*aggs, F.count(F.lit(1)).alias("ROWS_sales")).crossJoin(unknown).crossJoin(status)
    for table, key, cid in (("sales", "sale_id", "UNI_001"), ("customers", "customer_id", "UNI_002"),
                            ("products", "product_id", "UNI_003")):
        gap = lambda t: t[table].agg((F.count(F.lit(1)) - F.count_distinct(key)).alias("_g"))  # noqa: E731, B023
        counted = counted.crossJoin(gap(dirty).withColumnRenamed("_g", "_d").crossJoin(gap(base)).select(
            (col("_d") - col("_g")).alias(cid)))
    for t in ("customers", "products"):
        counted = counted.crossJoin(dirty[t].agg(F.count(F.lit(1)).alias(f"ROWS_{t}")))
    names = [*tests, "REL_001", "REL_002", "REL_003", "UNI_001", "UNI_002", "UNI_003", "ROWS_sales", "ROWS_customers", "ROWS_products"]
    data = counted.select(F.explode(F.array(*[F.struct(F.lit(n).alias("error_class"), F.col(n).alias("in_data"))
                                              for n in names])).alias("x")).select("x.*")

    sizes = {t: base[t].agg(F.count(F.lit(1)).alias("_n")) for t in ("sales", "customers", "products")}
    logged = manifest_counts(manifest)
    ranges = [(k, "sales", lo, hi) for k, lo, hi in plan.ranges()] + [
        ("UNI_002", "customers", 0, plan.master_rates["UNI_002"]), ("UNI_003", "products", 0, plan.master_rates["UNI_003"])]
    spark = s.sparkSession
    plan_rows = spark.createDataFrame(ranges, "error_class string, _t string, _lo long, _hi long")
    base_rows = None
    for t, one in sizes.items():
        one = one.select(F.lit(t).alias("_t"), "_n")
        base_rows = one if base_rows is None else base_rows.unionByName(one)
    planned = plan_rows.join(base_rows, "_t").select(
        "error_class", F.expr(f"_n * _hi div {BUCKETS} - _n * _lo div {BUCKETS}").alias("planned"))
    totals = base_rows.join(
        logged.join(spark.createDataFrame([("UNI_001", "sales"), ("UNI_002", "customers"), ("UNI_003", "products")],
                                          "error_class string, _t string"), "error_class"), "_t", "left") \
        .select(F.concat(F.lit("ROWS_"), "_t").alias("error_class"),
                (col("_n") + F.coalesce("n", F.lit(0)) + F.when(col("_t") == "products", N_INACTIVE).otherwise(0)).alias("n"))
    out = data.join(logged.unionByName(totals), "error_class", "left").join(planned, "error_class", "left")
    in_manifest = F.coalesce("n", F.lit(0)).cast("long")
    exact = col("planned").isNull() | (in_manifest == col("planned"))
    return out.select("error_class", "in_data", in_manifest.alias("in_manifest"), "planned",
                      F.when((col("in_data") == in_manifest) & exact, "OK").otherwise("MISMATCH").alias("status"))
