from qualis.sources.fixture import CUSTOMER_COLUMNS, PRODUCT_COLUMNS, SALES_COLUMNS, TARGET_COLUMNS


def table(spark, columns, rows):
    """Small all-text table with _row_id = list position (NULL stays NULL)."""
    data = [tuple(r) + (i,) for i, r in enumerate(rows)]
    schema = ", ".join(f"{c} string" for c in columns) + ", _row_id long"
    return spark.createDataFrame(data, schema)


def sale(sale_id="S-1", date="2024-01-05", cust="C-1", prod="P-1", qty="5", price="10.00", disc="0.1",
         region="North", channel="online"):
    return (sale_id, date, cust, prod, qty, price, disc, region, channel)


def tables(spark, sales, customers=None, products=None, targets=None):
    customers = customers or [("C-1", "Ann", "B2B", "DE", "2021-03-01"), ("C-2", "Bob", "B2C", "AT", "2021-03-02")]
    products = products or [("P-1", "Desk", "Office", "100.00", "active"),
                            ("P-2", "Lamp", "Office", "20.00", "inactive")]
    targets = targets or [("2024-01", "North", "50000")]
    return {"sales": table(spark, SALES_COLUMNS, sales), "customers": table(spark, CUSTOMER_COLUMNS, customers),
            "products": table(spark, PRODUCT_COLUMNS, products), "targets": table(spark, TARGET_COLUMNS, targets)}
