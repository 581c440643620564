"""Queries on keys, versions and routines, with their SQL for a second engine."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockwright.functions import wording as W
from stockwright.functions.expressions import alike, contains_text, line_total
from stockwright.operators import audit, changes, rules
from stockwright.operators.keys import CASCADE, RESTRICT, SET_NULL, ForeignKey, KeyGraph
from stockwright.operators.ordered import global_rank
from stockwright.operators.snapshots import changed_rows, updates
from stockwright.operators.upkeep import signed_changes, touched_sums
from stockwright.plans.oracle_model import percent
from stockwright.plans.rule_oracles import D, first_failure
from stockwright.plans.sql_functions import called, requested_cells
from stockwright.sources.monthly import MonthlyTable
from stockwright.sources.tables import new_folder

# The keys of the trade model.
KEYS = [
    ForeignKey("product", "category_id", "category", SET_NULL),
    ForeignKey("product", "unit_id", "unit", SET_NULL),
    ForeignKey("product_supplier", "product_id", "product", CASCADE),
    ForeignKey("product_supplier", "supplier_id", "supplier", CASCADE),
    ForeignKey("purchase_invoice", "supplier_id", "supplier", RESTRICT),
    ForeignKey("purchase_line", "purchase_invoice_id", "purchase_invoice", CASCADE),
    ForeignKey("purchase_line", "product_id", "product", RESTRICT),
    ForeignKey("purchase_line", "warehouse_id", "warehouse", RESTRICT),
    ForeignKey("sales_line", "sales_invoice_id", "sales_invoice", CASCADE),
    ForeignKey("sales_line", "product_id", "product", RESTRICT),
    ForeignKey("sales_line", "warehouse_id", "warehouse", RESTRICT),
    ForeignKey("inventory_movement", "product_id", "product", CASCADE),
    ForeignKey("inventory_movement", "warehouse_id", "warehouse", CASCADE),
    ForeignKey("price_audit_log", "product_id", "product", CASCADE),
    ForeignKey("low_stock_alerts", "product_id", "product", CASCADE),
    ForeignKey("low_stock_alerts", "warehouse_id", "warehouse", CASCADE),
]

# Documents before this day are archived, so that their lines hold nothing back.
OPEN_SINCE = date(2001, 9, 1)


def key_graph(t, since: date = OPEN_SINCE) -> KeyGraph:
    """The tables with the documents since a day, and the keys between them."""

    def recent(lines: DataFrame) -> DataFrame:
        return lines.filter(F.col("seq.l_shipdate") >= F.lit(since))

    names = {key.child for key in KEYS} | {key.parent for key in KEYS}
    tables = {name: getattr(t, name) for name in names}
    tables |= {name: recent(tables[name]) for name in ("purchase_line", "sales_line")}
    tables["purchase_invoice"] = tables["purchase_invoice"].filter(F.col("date") >= F.lit(since))
    return KeyGraph(tables, KEYS)


def deleted_products(t) -> DataFrame:
    """What every table holds after products, a category and suppliers are deleted, and which of them must stay."""
    asked = {
        "product": t.product.filter(~F.col("is_active") | (F.col("id") % 3 == 0)),
        "category": t.category.filter(F.col("id") == "Brand#2"),
        "supplier": t.supplier.filter(~F.col("is_active")),
    }
    done = key_graph(t).delete(asked)
    parts = []

    def add(name: str, rows: DataFrame, key: Column, reference: Column) -> None:
        parts.append(
            rows.groupBy(key.cast("string").alias("row_key"), reference.cast("string").alias("reference"))
            .agg(F.count(F.lit(1)).alias("held"))
            .select(F.lit(name).alias("table_name"), "row_key", "reference", "held")
        )

    none = F.lit(None)
    for name, ids in done.refused.items():
        add(f"{name} refused", ids, F.col("id"), none)
    tables = done.tables
    add("product", tables["product"], F.col("id"), F.col("category_id"))
    for name in ("supplier", "category"):
        add(name, tables[name], F.col("id"), none)
    add("product_supplier", tables["product_supplier"], F.col("product_id"), F.col("supplier_id"))
    for name in ("inventory_movement", "low_stock_alerts"):
        add(name, tables[name], F.col("product_id"), F.col("warehouse_id"))
    for name in ("purchase_line", "sales_line", "price_audit_log"):
        add(name, tables[name], F.col("product_id"), none)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def product_versions(t) -> tuple[DataFrame, DataFrame]:
    """The product table before and after the requested price changes, with a few rows gone and a few new."""
    columns = ("id", "sku", "default_price", "max_stock_level", "is_active")
    before = t.product.select(*columns).filter(F.col("id") % 89 != 5)
    wanted = {"default_price": "new_price", "max_stock_level": "new_max", "is_active": "new_active"}
    after = changes.apply_updates(t.product.select(*columns), t.product_changes, "id", wanted)
    return before, after.filter(F.col("id") % 97 != 7)


def product_differences(t) -> DataFrame:
    before, after = product_versions(t)
    rows = changed_rows(before, after, ["id"])
    return rows.select(
        "id",
        "change",
        *[F.col(f"{side}.{c}").alias(f"{side}_{c}") for side in ("old", "new") for c in ("sku", "default_price", "max_stock_level", "is_active")],
    )


def price_audit_of_versions(t) -> DataFrame:
    """The price audit, from two versions of the product table alone."""
    before, after = product_versions(t)
    asked = updates(before, after, "id", {"default_price": "new_price"})
    pairs = asked.select(F.col("id").alias("product_id"), F.col("default_price").alias("old_price"), "new_price")
    return audit.audit_rows(pairs, "product_id")


def purchase_status_of_versions(t) -> DataFrame:
    """The verdicts on changed purchase documents, from two versions of their table alone."""
    asked = t.purchase_status_changes
    before = asked.select("id", "invoice_no", "status", "supplier_id")
    after = asked.select("id", "invoice_no", F.col("new_status").alias("status"), F.col("new_supplier_id").alias("supplier_id"))
    found = updates(before, after, "id", {"status": "new_status", "supplier_id": "new_supplier_id"})
    return rules.validate_purchase_status(found).select(
        "id", "status", "new_status", "supplier_id", "new_supplier_id", "reason"
    )


CLOSED_ON = date(2000, 1, 1)


def totals_kept(t) -> DataFrame:
    """New totals of the purchase documents that a batch touches: newer lines come, every third line of the old ones goes, of
    every fifth one unit more is bought."""
    lines = t.purchase_items.select(
        F.col("purchase_invoice_id").alias("id"), "qty", "unit_price", F.col("line_total").alias("total_amount"), "seq"
    )
    is_new = F.col("seq.l_shipdate") >= F.lit(CLOSED_ON)
    place = F.col("seq.l_linenumber")
    stored = lines.filter(~is_new).groupBy("id").agg(
        F.sum("total_amount").alias("total_amount"), F.count(F.lit(1)).alias("rows")
    )
    was = F.struct("id", "total_amount")
    more = F.struct("id", line_total(F.col("qty") + 1).alias("total_amount"))
    batch = lines.filter(is_new | place.isin(3, 5)).select(
        F.when(~is_new, was).alias("old"), F.when(is_new, was).when(place == 5, more).alias("new")
    )
    signed = signed_changes(batch, ["id"], "total_amount")
    return touched_sums(stored, signed, ["id"], "total_amount").withColumnRenamed("rows", "lines_count")


def ledger_of_days(t) -> DataFrame:
    """Movements of a few days, from the ledger laid out by month."""
    ledger = MonthlyTable(t.spark, new_folder(t.spark, "ledger"), "created_at")
    ledger.append(t.inventory_movement.drop("seq"))
    return ledger.between(date(1998, 1, 10), date(1998, 2, 5))


def _names(t) -> DataFrame:
    """Products with names as people type them: in capitals, with accents, with blanks at the end."""
    key, name = F.col("id"), F.col("name")
    typed = F.when(key % 3 == 0, F.upper(name)).when(key % 3 == 1, F.translate(name, "aeio", "áéíó"))
    return t.product.withColumn("name", typed.otherwise(F.concat(name, F.lit("  "))))


def names_grouped(t) -> DataFrame:
    rows = _names(t).groupBy(alike("name").alias("name")).agg(
        F.min("id").alias("first_id"), F.count(F.lit(1)).alias("products"), F.sum("default_price").alias("price")
    )
    return rows.drop("name")


def names_repeated(t) -> DataFrame:
    """Names that more than one product has, under the collation and as they are written."""
    names = _names(t)
    by_name = rules.unique_violations(names.select(alike("name").alias("name")), ["name"])
    as_written = rules.unique_violations(names, ["name"])
    rule = F.lit("alike").alias("rule")
    return by_name.select(rule, "violations").unionByName(as_written.select(F.lit("as written").alias("rule"), "violations"))


def cell_stock(t) -> DataFrame:
    requested_cells(t)
    return called(
        t,
        "SELECT product_id, warehouse_id, GetCurrentStock(product_id, warehouse_id) AS stock, "
        "CheckProductAvailability(product_id, warehouse_id, 10) AS available FROM trade_cells",
    )


BUILDERS: dict[str, Callable] = {
    "key_graph_delete": deleted_products,
    "snapshot_product_changes": product_differences,
    "snapshot_price_audit": price_audit_of_versions,
    "snapshot_purchase_status": purchase_status_of_versions,
    "totals_kept": totals_kept,
    "ledger_of_days": ledger_of_days,
    "price_ranks": lambda t: global_rank(t.product.select("id", "default_price"), "default_price", "price_rank"),
    "names_grouped": names_grouped,
    "names_repeated": names_repeated,
    "names_found": lambda t: _names(t).filter(contains_text("name", "rÌng")).select("id", "name"),
    "sql_current_stock": cell_stock,
    "sql_warehouse_value": lambda t: called(
        t, "SELECT id AS warehouse_id, name AS warehouse_name, GetWarehouseTotalValue(id) AS total_value FROM trade_warehouse"
    ),
    "sql_stock_report": lambda t: called(t, "SELECT * FROM GetProductStockReport(1, NULL, FALSE)"),
    "sql_stock_report_low": lambda t: called(t, "SELECT * FROM GetProductStockReport(1, NULL, TRUE)"),
    "sql_supplier_report": lambda t: called(t, "SELECT * FROM GetSupplierReport(NULL)"),
    "sql_supplier_report_one": lambda t: called(t, "SELECT * FROM GetSupplierReport(1)"),
}

_OPEN = f"DATE '{OPEN_SINCE}'"
# Everything by its definition: who must stay, who goes, what is left.
_DELETED = f"""
, lines_in AS (SELECT * FROM m_purchase_line WHERE l_shipdate >= {_OPEN}),
want_product AS (SELECT id FROM m_product WHERE NOT is_active OR id % 3 = 0),
stay_product AS (
  SELECT id FROM want_product
  WHERE id IN (SELECT product_id FROM lines_in) OR id IN (SELECT product_id FROM m_line WHERE l_returnflag = 'A' AND l_shipdate >= {_OPEN})
), want_supplier AS (SELECT id FROM m_supplier WHERE NOT is_active),
stay_supplier AS (SELECT id FROM want_supplier WHERE id IN (SELECT supplier_id FROM m_purchase_invoice WHERE date >= {_OPEN})),
no_product AS (SELECT id FROM want_product EXCEPT SELECT id FROM stay_product),
no_supplier AS (SELECT id FROM want_supplier EXCEPT SELECT id FROM stay_supplier)
SELECT table_name, CAST(row_key AS VARCHAR) AS row_key, CAST(reference AS VARCHAR) AS reference, COUNT(*) AS held FROM (
  SELECT 'product refused' AS table_name, CAST(id AS VARCHAR) AS row_key, CAST(NULL AS VARCHAR) AS reference FROM stay_product
  UNION ALL SELECT 'supplier refused', CAST(id AS VARCHAR), NULL FROM stay_supplier
  UNION ALL SELECT 'product', CAST(id AS VARCHAR), NULLIF(category_id, 'Brand#2') FROM m_product
    WHERE id NOT IN (SELECT id FROM no_product)
  UNION ALL SELECT 'supplier', CAST(id AS VARCHAR), NULL FROM m_supplier WHERE id NOT IN (SELECT id FROM no_supplier)
  UNION ALL SELECT 'category', id, NULL FROM m_category WHERE id <> 'Brand#2'
  UNION ALL SELECT 'product_supplier', CAST(product_id AS VARCHAR), CAST(supplier_id AS VARCHAR) FROM m_product_supplier
    WHERE product_id NOT IN (SELECT id FROM no_product) AND supplier_id NOT IN (SELECT id FROM no_supplier)
  UNION ALL SELECT 'inventory_movement', CAST(product_id AS VARCHAR), CAST(warehouse_id AS VARCHAR) FROM m_movement
    WHERE product_id NOT IN (SELECT id FROM no_product)
  UNION ALL SELECT 'low_stock_alerts', CAST(product_id AS VARCHAR), CAST(warehouse_id AS VARCHAR) FROM m_alert
    WHERE product_id NOT IN (SELECT id FROM no_product)
  UNION ALL SELECT 'purchase_line', CAST(product_id AS VARCHAR), NULL FROM lines_in
  UNION ALL SELECT 'sales_line', CAST(product_id AS VARCHAR), NULL FROM m_line WHERE l_returnflag = 'A' AND l_shipdate >= {_OPEN}
  UNION ALL SELECT 'price_audit_log', CAST(id AS VARCHAR), NULL FROM m_change
    WHERE old_price <> new_price AND id NOT IN (SELECT id FROM no_product)
) GROUP BY ALL
"""

_NAMES = """
, typed AS (
  SELECT id, default_price, CASE id % 3 WHEN 0 THEN upper(name) WHEN 1 THEN translate(name, 'aeio', 'áéíó')
    ELSE name || '  ' END AS name FROM m_product
)"""
_CELLS = "(SELECT id AS product_id, id % 5 AS warehouse_id FROM m_product)"

SQL: dict[str, str] = {
    "key_graph_delete": _DELETED,
    "snapshot_product_changes": f"""
, both_versions AS (
  SELECT p.id, p.sku, p.default_price, p.max_stock_level, p.is_active, c.new_price, c.new_max, c.new_active,
    p.id % 89 <> 5 AS was, p.id % 97 <> 7 AS is_
  FROM m_product p JOIN m_change c ON c.id = p.id
)
SELECT id, CASE WHEN NOT was THEN 'insert' WHEN NOT is_ THEN 'delete' ELSE 'update' END AS change,
  CASE WHEN was THEN sku END AS old_sku, CAST(CASE WHEN was THEN default_price END AS DOUBLE) AS old_default_price,
  CAST(CASE WHEN was THEN max_stock_level END AS DOUBLE) AS old_max_stock_level, CASE WHEN was THEN is_active END AS old_is_active,
  CASE WHEN is_ THEN sku END AS new_sku, CAST(CASE WHEN is_ THEN new_price END AS DOUBLE) AS new_default_price,
  CAST(CASE WHEN is_ THEN new_max END AS DOUBLE) AS new_max_stock_level, CASE WHEN is_ THEN new_active END AS new_is_active
FROM both_versions
WHERE (was OR is_) AND (NOT was OR NOT is_ OR default_price <> new_price OR max_stock_level IS DISTINCT FROM new_max
  OR is_active <> new_active)""",
    "snapshot_price_audit": f"""
SELECT id AS product_id, {D('old_price', 'old_price')}, {D('new_price', 'new_price')},
  {percent('old_price', 'new_price')} AS change_percent, FALSE AS out_of_range
FROM m_change WHERE old_price <> new_price AND id % 89 <> 5 AND id % 97 <> 7""",
    "snapshot_purchase_status": f"""
SELECT id, status, new_status, supplier_id, new_supplier_id, {first_failure(
    (W.PURCHASE_FIXED, "status <> 'DRAFT' AND new_status <> status"),
    (W.SUPPLIER_FIXED, "status <> 'DRAFT' AND new_supplier_id <> supplier_id"))} AS reason
FROM m_purchase_change WHERE status <> new_status OR supplier_id <> new_supplier_id""",
    "totals_kept": f"""
, changed_line AS (
  SELECT *, l_shipdate >= DATE '{CLOSED_ON}' AS is_new, l_linenumber AS place FROM m_purchase_line
), after_batch AS (
  SELECT purchase_invoice_id AS id,
    CASE WHEN is_new OR place <> 5 THEN line_total ELSE CAST((qty + 1) * unit_price AS DECIMAL(12,2)) END AS total
  FROM changed_line WHERE is_new OR place <> 3
), touched AS (SELECT DISTINCT purchase_invoice_id AS id FROM changed_line WHERE is_new OR place IN (3, 5))
SELECT id, CAST(COALESCE(SUM(total), 0) AS DOUBLE) AS total_amount, COUNT(total) AS lines_count
FROM touched LEFT JOIN after_batch USING (id) GROUP BY id""",
    "ledger_of_days": f"""
SELECT product_id, warehouse_id, movement_type, {D('qty', 'qty')}, related_type, related_id, note,
  CAST(created_at AS VARCHAR) AS created_at
FROM m_movement WHERE CAST(created_at AS DATE) BETWEEN DATE '1998-01-10' AND DATE '1998-02-05'""",
    "price_ranks": f"SELECT id, {D('default_price', 'default_price')}, RANK() OVER (ORDER BY default_price DESC) AS price_rank FROM m_product",
    "names_grouped": f"""
{_NAMES}
SELECT MIN(id) AS first_id, COUNT(*) AS products, {D('SUM(default_price)', 'price')}
FROM typed GROUP BY rtrim(strip_accents(lower(name)))""",
    "names_repeated": f"""
{_NAMES}
SELECT 'alike' AS rule, COUNT(*) AS violations FROM (
  SELECT 1 FROM typed GROUP BY rtrim(strip_accents(lower(name))) HAVING COUNT(*) > 1)
UNION ALL SELECT 'as written', COUNT(*) FROM (SELECT 1 FROM typed GROUP BY name HAVING COUNT(*) > 1)""",
    "names_found": f"{_NAMES} SELECT id, name FROM typed WHERE contains(strip_accents(lower(name)), 'ring')",
    "sql_current_stock": f"""
SELECT c.product_id, c.warehouse_id, {D('COALESCE(s.stock, 0)', 'stock')}, COALESCE(s.stock, 0) >= 10 AS available
FROM {_CELLS} c LEFT JOIN m_stock s ON s.product_id = c.product_id AND s.warehouse_id = c.warehouse_id""",
}
# The functions give what the reports of the same names give.
SAME_AS = {
    "sql_warehouse_value": "warehouse_total_value",
    "sql_stock_report": "stock_report",
    "sql_stock_report_low": "stock_report_low",
    "sql_supplier_report": "supplier_report",
    "sql_supplier_report_one": "supplier_report_one",
}
