"""The two small trade data sets whose results are known by hand."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal
from types import SimpleNamespace

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from stockwright.functions.expressions import line_total

NOON = datetime(2025, 1, 25, 12)


def _table(spark, schema, rows):
    amounts = ["decimal" in part for part in schema.replace("decimal(12,2)", "decimal").split(",")]
    plain = [
        tuple(Decimal(str(v)) if is_amount and v is not None else v for v, is_amount in zip(row, amounts))
        for row in rows
    ]
    return spark.createDataFrame(plain, schema)


MONEY = "decimal(12,2)"
PRODUCT = (
    f"id bigint, sku string, name string, category_id bigint, unit_id bigint, default_price {MONEY}, "
    f"min_stock_level {MONEY}, max_stock_level {MONEY}, is_active boolean"
)
OFFER = (
    f"product_id bigint, supplier_id bigint, supplier_sku string, lead_time_days int, last_purchase_price {MONEY}, "
    "is_preferred boolean"
)
LINE = f"seq bigint, purchase_invoice_id bigint, product_id bigint, qty {MONEY}, unit_price {MONEY}, warehouse_id bigint"
MOVEMENT = (
    f"seq bigint, product_id bigint, warehouse_id bigint, movement_type string, qty {MONEY}, related_type string, "
    "related_id bigint, note string, created_at timestamp_ntz"
)
PURCHASE = f"id bigint, supplier_id bigint, invoice_no string, date date, status string, total_amount {MONEY}"
SALE = f"id bigint, customer_name string, invoice_no string, date date, status string, total_amount {MONEY}"


def second_version(spark: SparkSession) -> SimpleNamespace:
    """The rows of the second schema version, before any scenario."""
    t = SimpleNamespace()
    t.category = spark.createDataFrame(
        [(n, f"Category {n}") for n in range(1, 7)],
        "id bigint, name string",
    )
    t.unit = spark.createDataFrame([(1, "Unit 1"), (2, "Unit 2")], "id bigint, name string")
    t.supplier = spark.createDataFrame(
        [(n, f"Supplier {n}", f"s{n}@example.com", f"000-{n}", True) for n in range(1, 4)],
        "id bigint, name string, contact_email string, phone string, is_active boolean",
    )
    t.warehouse = spark.createDataFrame(
        [(n, f"Warehouse {n}", True) for n in range(1, 4)],
        "id bigint, name string, is_active boolean",
    )
    t.product = _table(
        spark,
        PRODUCT,
        [
            (1, "P1", "Product 1", 2, 1, 55000, 3, 20, True),
            (2, "P2", "Product 2", 2, 1, 65000, 2, 15, True),
            (3, "P3", "Product 3", 3, 1, 15000, 5, 30, True),
            (4, "P4", "Product 4", 3, 1, 25000, 3, 20, True),
            (5, "P5", "Product 5", 5, 1, 1200, 10, 100, True),
            (6, "P6", "Product 6", 6, 1, 1100, 10, 100, True),
            (7, "P7", "Product 7", 3, 1, 5000, 8, 50, True),
            (8, "P8", "Product 8", 3, 1, 4500, 10, 60, True),
        ],
    )
    t.product_supplier = _table(
        spark,
        OFFER,
        [
            (1, 1, "S1-P1", 5, 52000, True),
            (2, 1, "S1-P2", 7, 62000, True),
            (3, 1, "S1-P3", 3, 14000, True),
            (4, 1, "S1-P4", 4, 23000, True),
            (5, 2, "S2-P5", 2, 1000, True),
            (6, 2, "S2-P6", 2, 950, True),
            (7, 1, "S1-P7", 4, 4500, True),
            (8, 1, "S1-P8", 5, 4000, True),
        ],
    )
    t.purchase_invoice = _table(
        spark,
        PURCHASE,
        [
            (1, 1, "PUR-1", date(2025, 1, 10), "CONFIRMED", 0),
            (2, 1, "PUR-2", date(2025, 1, 12), "CONFIRMED", 0),
            (3, 2, "PUR-3", date(2025, 1, 15), "CONFIRMED", 0),
        ],
    ).withColumn("created_at", F.col("date").cast("timestamp_ntz"))
    lines = [
        (1, 1, 1, 5, 52000, 1),
        (2, 1, 3, 10, 14000, 1),
        (3, 2, 2, 3, 62000, 1),
        (4, 2, 4, 5, 23000, 1),
        (5, 2, 7, 15, 4500, 2),
        (6, 2, 8, 20, 4000, 2),
        (7, 3, 5, 50, 1000, 1),
        (8, 3, 6, 40, 950, 1),
    ]
    t.purchase_line = t.purchase_items = _table(spark, LINE, lines).withColumn("line_total", line_total())
    t.sales_invoice = _table(
        spark,
        SALE,
        [
            (1, "Customer 1", "SALE-1", date(2025, 1, 20), "CONFIRMED", 0),
            (2, "Customer 2", "SALE-2", date(2025, 1, 21), "CONFIRMED", 0),
            (3, "Customer 3", "SALE-3", date(2025, 1, 22), "CONFIRMED", 0),
        ],
    ).withColumn("created_at", F.col("date").cast("timestamp_ntz"))
    t.sales_line = t.sales_items = _table(
        spark, LINE.replace("purchase_invoice_id", "sales_invoice_id"), []
    ).withColumn("line_total", line_total())
    t.inventory_movement = movements(
        spark, [(line[2], line[5], "IN", line[3], "purchase", line[1]) for line in lines]
    )
    return t


def movements(spark: SparkSession, rows, first: int = 1):
    """Movements (product, warehouse, type, qty[, related type, related id]) in order of arrival."""
    full = [
        (first + i, row[0], row[1], row[2], row[3], *(row[4:6] if len(row) > 4 else ("test", None)), "", NOON)
        for i, row in enumerate(rows)
    ]
    return _table(spark, MOVEMENT, full)


def first_version(spark: SparkSession) -> SimpleNamespace:
    """The rows of the first schema version after its changes. OUT quantities are negative."""
    t = SimpleNamespace()
    t.category = spark.createDataFrame(
        [(n, f"Category {n}") for n in range(1, 4)], "id bigint, name string"
    )
    t.supplier = spark.createDataFrame(
        [(n, f"Supplier {n}") for n in range(1, 4)], "id bigint, name string"
    )
    t.warehouse = spark.createDataFrame(
        [(n, f"Warehouse {n}") for n in range(1, 4)], "id bigint, name string"
    )
    t.product = _table(
        spark,
        f"id bigint, sku string, name string, category_id bigint, default_price {MONEY}",
        [
            (1, "P1", "Product 1", 2, 55000),
            (2, "P2", "Product 2", 3, 2000),
            (3, "P3", "Product 3", 1, 15000),
            (4, "P4", "Product 4", 1, 3000),
        ],
    )
    t.product_supplier = spark.createDataFrame(
        [(1, 1, "S1-P1", 5), (2, 2, "S2-P2", 3), (3, 1, "S1-P3", 7)],
        "product_id bigint, supplier_id bigint, supplier_sku string, lead_time_days int",
    )
    t.purchase_invoice = _table(
        spark,
        f"id bigint, supplier_id bigint, invoice_no string, date date, total_amount {MONEY}",
        [
            (1, 1, "PUR-1", date(2025, 11, 1), 65000),
            (2, 2, "PUR-2", date(2025, 11, 5), 2000),
            (3, 1, "PUR-3", date(2025, 11, 10), 15000),
        ],
    )
    t.purchase_items = _table(
        spark,
        f"purchase_invoice_id bigint, product_id bigint, qty {MONEY}, unit_price {MONEY}",
        [(1, 1, 1, 50000), (1, 3, 1, 15000), (2, 2, 1, 2000)],
    ).withColumn("line_total", line_total())
    t.sales_invoice = _table(
        spark,
        f"id bigint, customer_name string, invoice_no string, date date, total_amount {MONEY}",
        [
            (1, "Customer 1", "SALE-1", date(2025, 12, 1), 52000),
            (3, "Customer 3", "SALE-3", date(2025, 12, 10), 3000),
        ],
    )
    t.sales_items = _table(
        spark,
        f"sales_invoice_id bigint, product_id bigint, qty {MONEY}, unit_price {MONEY}",
        [(1, 1, 1, 50000), (1, 2, 1, 2000), (3, 4, 1, 3000)],
    ).withColumn("line_total", line_total())
    t.inventory_movement = movements(
        spark,
        [
            (1, 1, "IN", 1),
            (3, 1, "IN", 1),
            (2, 2, "IN", 1),
            (1, 1, "OUT", -1),
            (2, 2, "OUT", -1),
            (3, 1, "IN", 1),
            (3, 1, "OUT", -1),
        ],
    )
    return t
