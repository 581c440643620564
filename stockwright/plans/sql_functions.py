"""The routines of the trade model as SQL functions, to be called from any query.

Scalar functions are subqueries with a parameter, table functions are queries with parameters. Spark rewrites both into
joins with an aggregate over the whole argument set, so a call per row is a set operation, not a lookup per row.
Arguments that name nothing raise an error, as the routines do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockwright.operators.ledger import CELL, current_stock
from stockwright.plans import reports

_KNOWN = "(SELECT MAX(known.id) FROM trade_{table} known WHERE known.id = {value}) IS NULL"


def _unknown(table: str, value: str) -> str:
    return _KNOWN.format(table=table, value=value)


# Table functions join the one row that their argument names; the remainder by one makes that a hash join.
_STOCK = "COALESCE(cell.stock, 0)"

FUNCTIONS = [
    f"""GetCurrentStock(product BIGINT, warehouse BIGINT) RETURNS DECIMAL(22,2) RETURN
  CASE WHEN {_unknown('product', 'product')} THEN raise_error('Product not found')
    WHEN {_unknown('warehouse', 'warehouse')} THEN raise_error('Warehouse not found')
    ELSE COALESCE((SELECT MAX(cell.stock) FROM trade_stock cell
      WHERE cell.product_id = product AND cell.warehouse_id = warehouse), 0) END""",
    """CheckProductAvailability(product BIGINT, warehouse BIGINT, required DECIMAL(12,2)) RETURNS BOOLEAN RETURN
  COALESCE(GetCurrentStock(product, warehouse) >= required, FALSE)""",
    f"""GetWarehouseTotalValue(warehouse BIGINT) RETURNS DECIMAL(24,2) RETURN
  CASE WHEN {_unknown('warehouse', 'warehouse')} THEN raise_error('Warehouse not found')
    ELSE COALESCE((SELECT SUM(cell.stock * p.default_price) FROM trade_stock cell JOIN trade_product p ON p.id = cell.product_id
      WHERE p.is_active AND cell.warehouse_id = warehouse), 0) END""",
    f"""GetProductStockReport(warehouse BIGINT, category STRING, only_low BOOLEAN) RETURNS TABLE (
    sku STRING, product_name STRING, category_name STRING, unit_name STRING, current_stock DECIMAL(22,2),
    min_stock_level DECIMAL(12,2), max_stock_level DECIMAL(12,2), default_price DECIMAL(12,2), total_value DECIMAL(24,2),
    stock_status STRING, availability STRING) RETURN
  SELECT p.sku, p.name, c.name, u.name, {_STOCK}, p.min_stock_level, p.max_stock_level, p.default_price,
    CAST(ROUND({_STOCK} * p.default_price, 2) AS DECIMAL(24,2)),
    CASE WHEN {_STOCK} <= p.min_stock_level THEN 'LOW' WHEN {_STOCK} >= p.max_stock_level * 0.9 THEN 'HIGH' ELSE 'NORMAL' END,
    CASE WHEN {_STOCK} >= 1 THEN 'AVAILABLE' ELSE 'OUT OF STOCK' END
  FROM trade_product p
  LEFT JOIN trade_stock cell ON cell.product_id = p.id AND cell.warehouse_id = warehouse
  LEFT JOIN trade_warehouse known ON known.id = warehouse AND pmod(known.id, 1) = pmod(p.id, 1)
  LEFT JOIN trade_category c ON c.id = p.category_id LEFT JOIN trade_unit u ON u.id = p.unit_id
  WHERE p.is_active AND (category IS NULL OR p.category_id = category)
    AND CASE WHEN known.id IS NULL THEN raise_error('Warehouse not found')
      ELSE NOT only_low OR {_STOCK} <= p.min_stock_level END""",
    """GetSupplierReport(supplier BIGINT) RETURNS TABLE (
    supplier_id BIGINT, supplier_name STRING, contact_email STRING, phone STRING, is_active BOOLEAN, total_products BIGINT,
    total_invoices BIGINT, total_purchase_amount DECIMAL(38,2), avg_purchase_price DOUBLE, min_lead_time INT,
    max_lead_time INT) RETURN
  SELECT r.supplier_id, r.supplier_name, r.contact_email, r.phone, r.is_active, r.total_products, r.total_invoices,
    r.total_purchase_amount, r.avg_purchase_price, r.min_lead_time, r.max_lead_time
  FROM trade_supplier_report r LEFT JOIN trade_supplier known ON known.id = supplier AND pmod(known.id, 1) = pmod(r.supplier_id, 1)
  WHERE CASE WHEN supplier IS NULL THEN TRUE WHEN known.id IS NULL THEN raise_error('Supplier not found')
    ELSE r.supplier_id = supplier END""",
]


def register_functions(t) -> None:
    """Makes the functions, and the views they read, known to the session for the tables of ``t``."""
    views = {name: getattr(t, name) for name in ("product", "warehouse", "category", "unit", "supplier")}
    views["stock"] = current_stock(t.inventory_movement)
    views["supplier_report"] = reports.supplier_report(t)
    for name, rows in views.items():
        rows.createOrReplaceTempView(f"trade_{name}")
    for function in FUNCTIONS:
        t.spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {function}")


def called(t, query: str) -> DataFrame:
    register_functions(t)
    return t.spark.sql(query)


def requested_cells(t) -> DataFrame:
    """A cell of every product, by name of a view as well."""
    cells = t.product.select(F.col("id").alias(CELL[0]), (F.col("id") % 5).alias(CELL[1]))
    cells.createOrReplaceTempView("trade_cells")
    return cells
