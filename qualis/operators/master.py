"""Clean master dataset (K13/J4): cleaned sales enriched with the first
occurrence of each customer and product, plus revenue.

Both joins are many-to-one; that is checked beforehand by a count per key, so the
enrichment joins have plain scans on both sides and AQE can split a hot foreign
key (or the NULL keys). A NULL foreign key enriches to NULL (SQL equality). The
master sides are narrowed to the enrichment columns; all sales columns stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualis.functions import parse as P
from qualis.operators.checks import bq
from qualis.sources import names as NM

MASTER_ORDER = ["sale_id", "sale_date", "customer_id", "customer_name", "customer_segment", "country",
                "product_id", "product_name", "category", "quantity", "unit_price", "discount", "region",
                "sales_channel", "gross_revenue", "net_revenue", "quality_flag"]
CUSTOMER_ENRICH = ["customer_id", "customer_name", "customer_segment", "country"]
PRODUCT_ENRICH = ["product_id", "product_name", "category", "active_status"]


def assert_unique(df: DataFrame, key: str, what: str) -> None:
    """Stop if a non-NULL key occurs more than once on the master side (the
    join would multiply sales rows)."""
    twice = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1)
    for r in twice.collect():
        raise ValueError(f"{what}: key not unique: {r[key]}")


def build_master(cleaned: dict[str, DataFrame], keep_internal: bool = False, validate: bool = True) -> DataFrame:
    sales, customers, products = cleaned["sales"], cleaned["customers"], cleaned["products"]
    cust = customers.select(*[c for c in CUSTOMER_ENRICH if c in customers.columns])
    prod = products.select(*[c for c in PRODUCT_ENRICH if c in products.columns])
    if validate:
        assert_unique(cust, "customer_id", "customers")
        assert_unique(prod, "product_id", "products")
    # hash joins: the wide sales are shuffled, never sorted
    m = sales.join(cust.hint("shuffle_hash"), "customer_id", "left").join(prod.hint("shuffle_hash"), "product_id", "left")
    if "discount" not in m.columns:
        m = m.withColumn("discount", F.lit(None).cast("string"))
    qty, price = P.to_number("quantity"), P.to_number("unit_price")
    disc = F.coalesce(P.to_number("discount"), F.lit(0.0))
    m = m.withColumn("gross_revenue", P.round_cents(qty * price))
    m = m.withColumn("net_revenue", P.round_cents(F.col("gross_revenue") * (F.lit(1.0) - disc)))
    present = [c for c in MASTER_ORDER if c in m.columns]
    rest = [c for c in m.columns if c not in present and (keep_internal or not c.startswith("_"))]
    return NM.restore(m.select(*present, *map(bq, rest)))
