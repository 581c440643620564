"""Reports over the trade data model.

Each function takes a table provider (attributes named as the tables) and returns a DataFrame.
Dimension joins carry no hints: sizes are unknown here, so Catalyst and AQE choose by statistics.
Facts are aggregated by key before they meet their dimensions.
"""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stockwright.functions import wording as W
from stockwright.functions.expressions import (
    BALANCE,
    MONEY,
    contains_text,
    count_if,
    half_up_quotient,
    mean,
    month_of,
    percent_change,
    signed_qty,
    stock_status,
)
from stockwright.operators.ledger import CELL, current_stock, stock_in


def named(table: DataFrame, prefix: str, *columns: str) -> DataFrame:
    """A dimension with its id as ``<prefix>_id`` and its columns as ``<prefix>`` or ``<prefix>_<column>``."""
    return table.select(
        F.col("id").alias(f"{prefix}_id"),
        *[F.col(c).alias(prefix if c == "name" else f"{prefix}_{c}") for c in columns],
    )


# Filters and look-ups


def purchases_in_date_range(t, first: date, last: date) -> DataFrame:
    return t.purchase_invoice.filter(F.col("date").between(first, last)).orderBy(F.desc("date"), "id")


def products_name_contains(t, text: str) -> DataFrame:
    return t.product.filter(contains_text("name", text)).orderBy("name", "id")


def invoices_customer_contains(t, text: str) -> DataFrame:
    return t.sales_invoice.filter(contains_text("customer_name", text))


def active_products_price_range(t, low: Decimal, high: Decimal, descending: bool = True) -> DataFrame:
    price = F.col("default_price")
    return t.product.filter(F.col("is_active") & price.between(low, high)).orderBy(
        price.desc() if descending else price.asc(), "id"
    )


def recent_confirmed_sales(t, limit: int = 10) -> DataFrame:
    return t.sales_invoice.filter(F.col("status") == "CONFIRMED").orderBy(F.desc("created_at"), "id").limit(limit)


def movements_by_document(t, documents: DataFrame) -> DataFrame:
    """Movements of many documents at once; documents have (related_type, related_id)."""
    return t.inventory_movement.join(documents, ["related_type", "related_id"], "left_semi")


def first_products(t, limit: int = 3) -> DataFrame:
    return t.product.select("id", "sku", "name").orderBy("id").limit(limit)


# Joins


def products_with_category_unit(t) -> DataFrame:
    return (
        t.product.join(named(t.category, "category", "name"), "category_id")
        .join(named(t.unit, "unit", "name"), "unit_id")
        .select("id", F.col("name").alias("product"), "category", "unit")
    )


def suppliers_with_products(t) -> DataFrame:
    offers = t.product_supplier.select("supplier_id", "product_id")
    return (
        named(t.supplier, "supplier", "name")
        .join(offers, "supplier_id", "left")
        .join(named(t.product, "product", "name"), "product_id", "left")
        .select("supplier_id", "supplier", "product_id", "product")
    )


def movements_with_purchase_invoice(t) -> DataFrame:
    invoice = t.purchase_invoice.select(
        F.col("id").alias("related_id"), F.col("invoice_no").alias("related_invoice"), F.lit("purchase").alias("related_type")
    )
    return t.inventory_movement.join(invoice, ["related_type", "related_id"], "left").select(
        "product_id", "movement_type", "qty", "related_id", "related_invoice"
    )


def sales_detail(t) -> DataFrame:
    invoice = t.sales_invoice.select(F.col("id").alias("sales_invoice_id"), "customer_name")
    return (
        t.sales_items.join(invoice, "sales_invoice_id")
        .join(named(t.product, "product", "name"), "product_id")
        .select("customer_name", "product", "qty", "line_total")
    )


def purchase_detail(t) -> DataFrame:
    invoice = t.purchase_invoice.select(F.col("id").alias("purchase_invoice_id"), "invoice_no", "date", "supplier_id")
    return (
        t.purchase_items.join(invoice, "purchase_invoice_id")
        .join(named(t.supplier, "supplier", "name"), "supplier_id")
        .join(named(t.product, "product", "name"), "product_id")
        .select("invoice_no", "date", "supplier", "product", "qty", "unit_price", "line_total")
        .orderBy(F.desc("date"), "invoice_no")
    )


def sales_with_warehouse(t) -> DataFrame:
    """Sales lines with every warehouse that ever shipped the product.

    The plain join on the product pairs each line with each shipment. Shipments are counted per
    (product, warehouse) first, so a line meets a warehouse once and ``shipments`` holds the repeats.
    """
    shipments = (
        t.inventory_movement.filter(F.col("movement_type") == "OUT")
        .groupBy(*CELL)
        .agg(F.count(F.lit(1)).alias("shipments"))
    )
    invoice = t.sales_invoice.select(F.col("id").alias("sales_invoice_id"), "customer_name", "invoice_no", "date")
    return (
        t.sales_items.select("sales_invoice_id", "product_id", "qty")
        .join(invoice, "sales_invoice_id")
        .join(shipments, "product_id")
        .join(named(t.product, "product", "name"), "product_id")
        .join(named(t.warehouse, "warehouse", "name"), "warehouse_id")
        .select("customer_name", "invoice_no", "date", "product", "qty", "warehouse", "shipments")
        .orderBy(F.desc("date"))
    )


def products_with_supplier_or_default(t, default: str = W.NO_SUPPLIER) -> DataFrame:
    offers = t.product_supplier.select("product_id", "supplier_id", "supplier_sku", "lead_time_days")
    return (
        t.product.select(F.col("id").alias("product_id"), "sku", F.col("name").alias("product"))
        .join(offers, "product_id", "left")
        .join(named(t.supplier, "supplier", "name"), "supplier_id", "left")
        .select("sku", "product", F.coalesce("supplier", F.lit(default)).alias("supplier"), "supplier_sku", "lead_time_days")
    )


def product_sample_dims(t, limit: int = 3) -> DataFrame:
    # Limit first: the joins are to unique ids, so they keep the row count.
    sample = t.product.orderBy("id").limit(limit)
    return (
        sample.join(named(t.category, "category", "name"), "category_id", "left")
        .join(named(t.unit, "unit", "name"), "unit_id", "left")
        .select("id", "sku", "name", "category", "unit", "default_price")
    )


def known_name(table: DataFrame, id_, what: str) -> str:
    """Name of the row with an id, looked up before a report starts; unknown ids are an error."""
    row = table.filter(F.col("id") == id_).select("name").first()
    if row is None:
        raise ValueError(f"{what} not found")
    return row["name"]


def stock_of_products(t, product_ids: list, warehouse_id: int) -> DataFrame:
    """Stock and status of chosen products in one active warehouse, 0 where nothing moved."""
    site = known_name(t.warehouse.filter("is_active"), warehouse_id, "Warehouse")
    chosen = t.product.filter(F.col("id").isin(product_ids) & F.col("is_active"))
    return (
        stock_in(chosen, t.inventory_movement, warehouse_id)
        .select(
            "sku",
            F.col("name").alias("product_name"),
            F.lit(site).alias("warehouse_name"),
            "current_stock",
            "min_stock_level",
            "max_stock_level",
            stock_status("current_stock").alias("stock_status"),
        )
        .orderBy("product_name", "sku")
    )


def confirmed_sales_lines(t) -> DataFrame:
    """Sales lines whose invoice is confirmed."""
    confirmed = t.sales_invoice.filter(F.col("status") == "CONFIRMED").select(F.col("id").alias("sales_invoice_id"))
    return t.sales_items.join(confirmed, "sales_invoice_id", "left_semi")


def alerts_to_raise(t, open_alerts: DataFrame) -> DataFrame:
    """Low cells of active products that have no open alert yet."""
    active = t.product.filter("is_active").select(F.col("id").alias("product_id"), "min_stock_level")
    return (
        current_stock(t.inventory_movement)
        .join(active, "product_id")
        .filter(F.col("stock") <= F.col("min_stock_level"))
        .join(open_alerts.filter(~F.col("is_resolved")), CELL, "left_anti")
        .select(*CELL, F.col("stock").alias("current_stock"), "min_stock_level")
    )


def price_audit_detail(t) -> DataFrame:
    return (
        t.price_audit_log.join(
            t.product.select(F.col("id").alias("product_id"), "sku", F.col("name").alias("product_name")), "product_id"
        )
        .select("sku", "product_name", "old_price", "new_price", "change_percent", "changed_at")
        .orderBy(F.desc("changed_at"), "sku")
    )


def alerts_detail(t, limit: int | None = None) -> DataFrame:
    alerts = t.low_stock_alerts
    order = [F.desc("alert_date"), "product_id", "warehouse_id"]
    if limit is not None:
        alerts = alerts.orderBy(*order).limit(limit)
    return (
        alerts.join(named(t.product, "product", "name"), "product_id")
        .join(named(t.warehouse, "warehouse", "name"), "warehouse_id")
        .orderBy(*order)
        .select(
            "product_id",
            F.col("product").alias("product_name"),
            F.col("warehouse").alias("warehouse_name"),
            "current_stock",
            "min_stock_level",
            "alert_date",
            "is_resolved",
        )
    )


# Aggregations


def _purchases_by_supplier_id(t, *more: str) -> DataFrame:
    """Purchase amounts and line counts per supplier (and more line columns).

    Lines are summed per document first: only one row per document meets the headers.
    """
    per_document = t.purchase_items.groupBy("purchase_invoice_id", *more).agg(
        F.sum("line_total").alias("_total"), F.count(F.lit(1)).alias("_lines")
    )
    header = t.purchase_invoice.select(F.col("id").alias("purchase_invoice_id"), "supplier_id")
    return (
        per_document.join(header, "purchase_invoice_id")
        .groupBy("supplier_id", *more)
        .agg(F.sum("_total").alias("_total"), F.sum("_lines").alias("_lines"))
    )


def purchases_by_supplier(t) -> DataFrame:
    return (
        _purchases_by_supplier_id(t)
        .join(named(t.supplier, "supplier", "name"), "supplier_id")
        .groupBy("supplier")
        .agg(F.sum("_total").alias("total_purchases"))
        .orderBy(F.desc("total_purchases"), "supplier")
    )


def purchases_by_supplier_product(t) -> DataFrame:
    return (
        _purchases_by_supplier_id(t, "product_id")
        .join(named(t.supplier, "supplier", "name"), "supplier_id")
        .join(named(t.product, "product", "name"), "product_id")
        .groupBy("supplier", "product")
        .agg(F.sum("_total").alias("total_purchase"))
    )


def supplier_purchase_counts(t) -> DataFrame:
    """Counts lines, as the count runs over the header joined to its lines."""
    return (
        _purchases_by_supplier_id(t)
        .join(named(t.supplier, "supplier", "name"), "supplier_id")
        .select("supplier_id", "supplier", F.col("_lines").alias("invoice_count"), F.col("_total").alias("total_purchases"))
        .orderBy(F.desc("total_purchases"), "supplier_id")
    )


def _prices_by_category(t) -> DataFrame:
    prices = t.product.groupBy("category_id").agg(
        F.count(F.lit(1)).alias("product_count"), mean("default_price").alias("avg_price")
    )
    return prices.join(named(t.category, "category", "name"), "category_id")


def avg_price_by_category_having(t, above: float = 10000) -> DataFrame:
    return _prices_by_category(t).filter(F.col("avg_price") > above).select("category", "avg_price").orderBy(
        F.desc("avg_price"), "category"
    )


def category_price_counts_having(t, above: float = 10000) -> DataFrame:
    return (
        _prices_by_category(t)
        .filter(F.col("avg_price") > above)
        .select("category", "product_count", "avg_price")
        .orderBy(F.desc("avg_price"), "category")
    )


def movement_stats_by_warehouse(t) -> DataFrame:
    stats = t.inventory_movement.groupBy("warehouse_id").agg(
        F.count(F.lit(1)).alias("movement_count"), F.min("qty").alias("min_qty"), F.max("qty").alias("max_qty")
    )
    return stats.join(named(t.warehouse, "warehouse", "name"), "warehouse_id").drop("warehouse_id")


def sales_line_totals(t) -> DataFrame:
    return t.sales_items.agg(F.count(F.lit(1)).alias("total_sales_lines"), F.sum("qty").alias("total_qty_sold"))


def sales_by_customer_having(t, above: Decimal = Decimal(10000)) -> DataFrame:
    per_document = t.sales_items.groupBy("sales_invoice_id").agg(F.sum("line_total").alias("_total"))
    header = t.sales_invoice.select(F.col("id").alias("sales_invoice_id"), "customer_name")
    return (
        per_document.join(header, "sales_invoice_id")
        .groupBy("customer_name")
        .agg(F.sum("_total").alias("total_sales"))
        .filter(F.col("total_sales") > above)
        .orderBy(F.desc("total_sales"), "customer_name")
    )


def sales_by_month(t) -> DataFrame:
    """Counts lines, as the count runs over the header joined to its lines."""
    per_document = t.sales_items.groupBy("sales_invoice_id").agg(
        F.count(F.lit(1)).alias("_lines"), F.sum("line_total").alias("_total")
    )
    header = t.sales_invoice.select(F.col("id").alias("sales_invoice_id"), "date")
    return (
        per_document.join(header, "sales_invoice_id")
        .groupBy(month_of("date").alias("month"))
        .agg(F.sum("_lines").alias("sales_count"), F.sum("_total").alias("revenue"))
        .orderBy("month")
    )


def products_sold_having(t) -> DataFrame:
    sold = t.sales_items.groupBy("product_id").agg(F.sum("qty").alias("sold"), F.sum("line_total").alias("revenue"))
    return (
        sold.filter(F.col("sold") > 0)
        .join(named(t.product, "product", "name"), "product_id")
        .select("product_id", "product", "sold", "revenue")
        .orderBy(F.desc("revenue"), "product_id")
    )


def top_customers_by_revenue(t, limit: int = 5) -> DataFrame:
    return (
        t.sales_invoice.groupBy("customer_name")
        .agg(F.count(F.lit(1)).alias("order_count"), F.sum("total_amount").alias("total_amount"))
        .orderBy(F.desc("total_amount"), "customer_name")
        .limit(limit)
    )


def top_products_by_sales(t, limit: int = 10) -> DataFrame:
    header = t.sales_invoice.select(F.col("id").alias("sales_invoice_id"), "date")
    sold = (
        t.sales_items.join(header, "sales_invoice_id")
        .groupBy("product_id")
        .agg(
            F.sum("line_total").alias("total_turnover"),
            F.sum("qty").alias("total_qty"),
            F.max("date").alias("last_sale_date"),
        )
    )
    # All sold products exist, so the name joins onto the ten rows only.
    known = sold.join(t.product.select(F.col("id").alias("product_id")), "product_id", "left_semi")
    return (
        known.orderBy(F.desc("total_turnover"), "product_id")
        .limit(limit)
        .join(named(t.product, "product", "name"), "product_id")
        .select(F.col("product_id").alias("id"), F.col("product").alias("name"), "total_turnover", "total_qty", "last_sale_date")
        .orderBy(F.desc("total_turnover"), "id")
    )


def _category_sales(t) -> DataFrame:
    """Active and inactive products with the number and total of their sales lines."""
    sold = t.sales_items.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("_lines"), F.sum("line_total").alias("_total")
    )
    return t.product.select(F.col("id").alias("product_id"), "category_id", "default_price").join(
        sold, "product_id", "left"
    )


def category_summary(t) -> DataFrame:
    """Products weighted by their sales lines, as in the join of product with sales line.

    A product with n lines appears max(n, 1) times; that weight stands in for the repeated rows.
    """
    weight = F.greatest(F.coalesce("_lines", F.lit(0)), F.lit(1))
    sums = (
        _category_sales(t)
        .groupBy("category_id")
        .agg(
            F.sum(weight).alias("product_count"),
            F.sum(F.col("default_price") * weight.cast("decimal(18,0)")).alias("_prices"),
            F.sum("_total").alias("total_sales"),
        )
    )
    return _summary(t, sums)


def category_summary_exact(t) -> DataFrame:
    sums = (
        _category_sales(t)
        .groupBy("category_id")
        .agg(
            F.count(F.lit(1)).alias("product_count"),
            F.sum("default_price").alias("_prices"),
            F.sum("_total").alias("total_sales"),
        )
    )
    return _summary(t, sums)


def _summary(t, sums: DataFrame) -> DataFrame:
    return (
        named(t.category, "category", "name")
        .join(sums, "category_id", "left")
        .select(
            F.col("category_id").alias("id"),
            F.col("category").alias("name"),
            F.coalesce("product_count", F.lit(0)).alias("product_count"),
            (F.col("_prices").cast("double") / F.col("product_count")).alias("avg_price"),
            "total_sales",
        )
    )


def warehouse_activity_last_month(t, as_of: date, out_is_negative: bool = False) -> DataFrame:
    """Movements of the month up to ``as_of``. ``out_is_negative``: OUT quantities are stored with a minus sign."""
    qty = F.col("qty")
    shipped = -qty if out_is_negative else qty
    none = F.lit(0).cast(MONEY)
    kind = F.col("movement_type")
    activity = (
        t.inventory_movement.filter(F.col("created_at") >= F.add_months(F.lit(as_of), -1))
        .groupBy("warehouse_id")
        .agg(
            F.count(F.lit(1)).alias("movements_count"),
            F.sum(F.when(kind == "IN", qty).otherwise(none)).alias("total_in"),
            F.sum(F.when(kind == "OUT", shipped).otherwise(none)).alias("total_out"),
            F.max("created_at").alias("last_activity"),
        )
    )
    return activity.join(named(t.warehouse, "warehouse", "name"), "warehouse_id").select(
        F.col("warehouse_id").alias("id"), F.col("warehouse").alias("name"), "movements_count", "total_in", "total_out", "last_activity"
    )


def stock_grid_positive(t) -> DataFrame:
    """Cells with positive stock, every movement but IN counted as going out.

    Cells without movements are zero and drop out, so the product by warehouse grid is never built.
    """
    qty = F.col("qty")
    stock = t.inventory_movement.groupBy(*CELL).agg(
        F.sum(F.when(F.col("movement_type") == "IN", qty).otherwise(-qty)).alias("stock")
    )
    return (
        stock.filter(F.col("stock") > 0)
        .join(named(t.product, "product", "name"), "product_id")
        .join(named(t.warehouse, "warehouse", "name"), "warehouse_id")
        .select("product_id", "product", "warehouse", "stock")
        .orderBy(F.desc("stock"), "product_id", "warehouse")
    )


def products_per_category(t) -> DataFrame:
    return (
        t.product.groupBy("category_id")
        .agg(F.count(F.lit(1)).alias("product_count"), mean("default_price").alias("avg_price"))
        .orderBy(F.desc("product_count"), "category_id")
    )


def product_purchase_totals(t, limit: int | None = None) -> DataFrame:
    bought = (
        t.purchase_items.groupBy("product_id")
        .agg(F.sum("qty").alias("total_purchased"), mean("unit_price").alias("avg_purchase_price"))
        .filter(F.col("total_purchased") > 0)
        .join(t.product.select(F.col("id").alias("product_id"), "name", "sku"), "product_id")
        .orderBy(F.desc("total_purchased"), "product_id")
    )
    bought = bought if limit is None else bought.limit(limit)
    return bought.select("name", "sku", "total_purchased", "avg_purchase_price")


def monthly_sales_analysis(t, since: date) -> DataFrame:
    active = t.product.filter("is_active").select(F.col("id").alias("product_id"))
    header = t.sales_invoice.filter((F.col("status") == "CONFIRMED") & (F.col("date") >= since)).select(
        F.col("id").alias("sales_invoice_id"), "customer_name", "date"
    )
    # One row per invoice before the month is grouped: the distinct counts then run over invoices, not lines.
    per_invoice = (
        t.sales_items.join(active, "product_id", "left_semi")
        .join(header, "sales_invoice_id")
        .groupBy("sales_invoice_id", "customer_name", month_of("date").alias("month"))
        .agg(
            F.count(F.lit(1)).alias("_lines"),
            F.sum("qty").alias("_qty"),
            F.sum("line_total").alias("_total"),
            F.sum("unit_price").alias("_prices"),
        )
    )
    # One row per (month, customer) next, so the last step is a plain sum.
    per_customer = per_invoice.groupBy("month", "customer_name").agg(
        F.count(F.lit(1)).alias("_invoices"),
        *[F.sum(c).alias(c) for c in ("_lines", "_qty", "_total", "_prices")],
    )
    return (
        per_customer.groupBy("month")
        .agg(
            F.sum("_invoices").alias("invoices_count"),
            F.sum("_lines").alias("lines_count"),
            F.sum("_qty").alias("total_qty_sold"),
            F.sum("_total").alias("total_revenue"),
            (F.sum("_prices").cast("double") / F.sum("_lines")).alias("avg_price"),
            F.count("customer_name").alias("unique_customers"),
        )
        .orderBy(F.desc("month"))
    )


def movement_analysis(t, since: date) -> DataFrame:
    """Movements since a day next to the stock of the whole ledger, in one pass over the ledger."""
    qty, kind = F.col("qty"), F.col("movement_type")
    recent = F.col("created_at") >= F.lit(since)

    def moved(of: str):
        return F.sum(F.when(recent & (kind == of), qty).otherwise(F.lit(0).cast(MONEY)))

    cells = (
        t.inventory_movement.groupBy(*CELL)
        .agg(
            moved("IN").alias("total_in"),
            moved("OUT").alias("total_out"),
            moved("ADJUST").alias("total_adjust"),
            F.sum(signed_qty()).cast(BALANCE).alias("current_stock"),
            count_if(recent).alias("_recent"),
        )
        .filter(F.col("_recent") > 0)
        .filter(
            (F.col("total_in") + F.col("total_out") + F.col("total_adjust") > 0) | (F.col("current_stock") > 0)
        )
    )
    product = t.product.filter("is_active").select(
        F.col("id").alias("product_id"), "sku", F.col("name").alias("product_name"), "min_stock_level", "max_stock_level"
    )
    site = t.warehouse.filter("is_active").select(F.col("id").alias("warehouse_id"), F.col("name").alias("warehouse_name"))
    return (
        cells.join(product, "product_id")
        .join(site, "warehouse_id")
        .select(
            "sku",
            "product_name",
            "warehouse_name",
            "total_in",
            "total_out",
            "total_adjust",
            "current_stock",
            "min_stock_level",
            "max_stock_level",
            stock_status("current_stock").alias("stock_status"),
        )
        .orderBy("product_name", "warehouse_name", "sku")
    )


# Tables whose sizes the overview reports show.
COUNTED_TABLES = (
    "category",
    "unit",
    "supplier",
    "warehouse",
    "product",
    "product_supplier",
    "purchase_invoice",
    "purchase_items",
    "inventory_movement",
    "sales_invoice",
)


def table_counts_long(t) -> DataFrame:
    """One (table, rows) row per table."""
    counts = [
        getattr(t, name).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name in COUNTED_TABLES
    ]
    result = counts[0]
    for one in counts[1:]:
        result = result.unionByName(one)
    return result


def table_row_counts(t) -> DataFrame:
    """All table sizes in one row."""
    columns = [F.max(F.when(F.col("table_name") == name, F.col("row_count"))).alias(name) for name in COUNTED_TABLES]
    return table_counts_long(t).agg(*columns)


def operations_dashboard(t) -> DataFrame:
    """Six counts in one row, gathered as (label, count) rows so that no frames are crossed."""
    every = F.lit(True)
    parts = [
        ("total_products", t.product, every),
        ("active_products", t.product, F.col("is_active")),
        ("movements", t.inventory_movement, every),
        ("confirmed_sales", t.sales_invoice, F.col("status") == "CONFIRMED"),
        ("confirmed_purchases", t.purchase_invoice, F.col("status") == "CONFIRMED"),
        ("open_alerts", t.low_stock_alerts, ~F.col("is_resolved")),
    ]
    rows = None
    for label, table, condition in parts:
        one = table.agg(count_if(condition).alias("n")).select(F.lit(label).alias("label"), "n")
        rows = one if rows is None else rows.unionByName(one)
    return rows.agg(*[F.max(F.when(F.col("label") == label, F.col("n"))).alias(label) for label, _, _ in parts])


def suppliers_per_product(t, separator: str = ", ") -> DataFrame:
    """Names of the suppliers of each product as one text, in name order."""
    return (
        t.product_supplier.select("product_id", "supplier_id")
        .join(named(t.supplier, "supplier", "name"), "supplier_id")
        .groupBy("product_id")
        .agg(
            F.count(F.lit(1)).alias("supplier_count"),
            F.expr(f"listagg(supplier, '{separator}') within group (order by supplier)").alias("suppliers"),
        )
        .orderBy("product_id")
    )


def product_profile(t) -> DataFrame:
    return t.product.agg(
        F.count(F.lit(1)).alias("total_products"),
        F.count_distinct("category_id").alias("categories"),
        count_if(F.col("is_active")).alias("active_products"),
        count_if(F.col("max_stock_level").isNull()).alias("without_maximum"),
        count_if(F.col("default_price") > 950).alias("expensive_products"),
    )


# Rankings and top lists


def _product_sales(t, fan_out: bool) -> DataFrame:
    """Confirmed sales and average purchase price per active product.

    ``fan_out`` keeps the result of joining sales lines and purchase lines of a product to each other:
    every sales line then counts once per purchase line, which is a factor, not a join.
    """
    sold = (
        confirmed_sales_lines(t)
        .groupBy("product_id")
        .agg(F.sum("qty").alias("_sold"), F.sum("line_total").alias("_revenue"))
    )
    bought = t.purchase_items.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("unit_price").alias("_prices")
    )
    times = F.greatest(F.coalesce("_n", F.lit(0)), F.lit(1)) if fan_out else F.lit(1)
    times = times.cast("decimal(16,0)")
    return (
        t.product.filter("is_active")
        .select(F.col("id").alias("product_id"), "sku", "name", "default_price")
        .join(sold, "product_id")
        .join(bought, "product_id", "left")
        .select(
            F.col("product_id").alias("id"),
            "sku",
            "name",
            "default_price",
            (F.col("_sold") * times).cast("decimal(38,2)").alias("total_sold"),
            (F.col("_revenue") * times).cast("decimal(38,2)").alias("total_revenue"),
            F.coalesce(F.col("_prices").cast("double") / F.col("_n"), F.col("default_price").cast("double")).alias(
                "avg_purchase_price"
            ),
            "_n",
            "_prices",
        )
        .filter(F.col("total_sold") > 0)
    )


def product_ranking(t, limit: int = 15, fan_out: bool = True) -> DataFrame:
    """Products by revenue with both ranks over all products, best first.

    No product outside the list is ahead of one in it by revenue, so the revenue rank follows from the list itself. For
    the volume rank all products are counted by how many of the listed amounts they exceed: at most ``limit + 1`` counts.
    """
    sales = _product_sales(t, fan_out)
    top = sales.orderBy(F.desc("total_revenue"), "id").limit(limit)
    listed_sold = top.agg(F.collect_set("total_sold")).scalar()
    in_order = F.sort_array(F.array_append(listed_sold, F.col("total_sold")))
    exceeded = F.array_position(in_order, F.col("total_sold")) - 1
    counts = sales.groupBy(exceeded.alias("_exceeded")).agg(F.count(F.lit(1)).alias("_products"))
    above = Window.orderBy(F.desc("_exceeded")).rowsBetween(Window.unboundedPreceding, -1)
    ahead = counts.select("_exceeded", (F.coalesce(F.sum("_products").over(above), F.lit(0)) + 1).alias("volume_rank"))
    ranked = (
        top.withColumn("revenue_rank", F.rank().over(Window.orderBy(F.desc("total_revenue"))).cast("bigint"))
        .withColumn("_exceeded", exceeded)
        .join(ahead, "_exceeded")
    )
    # Against the exact average: (price - sum / n) / (sum / n) = (price * n - sum) / sum.
    spent = F.coalesce("_prices", F.col("default_price"))
    listed = F.col("default_price") * F.coalesce("_n", F.lit(1)).cast("decimal(16,0)")
    per_unit = half_up_quotient(F.col("total_revenue"), F.col("total_sold"))
    return (
        ranked.orderBy("revenue_rank", "id")
        .limit(limit)
        .select(
            "id",
            "sku",
            "name",
            "default_price",
            "total_sold",
            "total_revenue",
            "avg_purchase_price",
            per_unit.alias("avg_sale_price"),
            half_up_quotient((listed - spent) * 100, spent).alias("markup_percent"),
            "revenue_rank",
            "volume_rank",
            per_unit.alias("price_per_unit"),
        )
    )


def product_ranking_top(t, limit: int = 5) -> DataFrame:
    return product_ranking(t, limit).select("sku", "name", "total_sold", "total_revenue", "revenue_rank", "volume_rank")


def last_movements(t, limit: int = 10) -> DataFrame:
    latest = t.inventory_movement.orderBy(F.desc("created_at"), F.desc("seq")).limit(limit)
    return (
        latest.join(named(t.product, "product", "name"), "product_id")
        .join(named(t.warehouse, "warehouse", "name"), "warehouse_id")
        .orderBy(F.desc("created_at"), F.desc("seq"))
        .select("created_at", "product", "warehouse", "movement_type", "qty", "note")
    )


def product_movement_history(t, product_id: int, warehouse_id: int, limit: int = 3) -> DataFrame:
    return (
        t.inventory_movement.filter((F.col("product_id") == product_id) & (F.col("warehouse_id") == warehouse_id))
        .orderBy(F.desc("created_at"), F.desc("seq"))
        .limit(limit)
        .select("product_id", "movement_type", "qty", "note", "created_at")
    )


def markup_top(t, warehouse_id: int, limit: int = 10) -> DataFrame:
    active = t.product.filter("is_active").select(
        "id", "sku", F.col("name").alias("product_name"), "category_id", "default_price"
    )
    in_stock = stock_in(active, t.inventory_movement, warehouse_id).filter(F.col("current_stock") > 0)
    supplier = t.supplier.filter("is_active").select(
        F.col("id").alias("supplier_id"), F.col("name").alias("supplier_name")
    )
    offers = t.product_supplier.filter(F.col("last_purchase_price").isNotNull()).select(
        F.col("product_id").alias("id"), "supplier_id", "last_purchase_price", "lead_time_days"
    )
    return (
        offers.join(in_stock, "id")
        .join(supplier, "supplier_id")
        .join(named(t.category, "category", "name"), "category_id")
        .select(
            "sku",
            "product_name",
            F.col("category").alias("category_name"),
            "supplier_name",
            "last_purchase_price",
            "lead_time_days",
            F.col("current_stock").alias("stock_main_warehouse"),
            F.col("default_price").alias("current_price"),
            percent_change("last_purchase_price", "default_price").alias("markup_percent"),
        )
        .orderBy(F.desc("markup_percent"), "sku", "supplier_name")
        .limit(limit)
    )


# Journals

JOURNAL_ORDER = ("date", "invoice_no", "product_name", "qty", "unit_price", "warehouse_name")


def _journal(t, kind: str, lines: DataFrame, header: DataFrame, first: date, last: date, key: str) -> DataFrame:
    active = t.product.filter("is_active").select(F.col("id").alias("product_id"), F.col("name").alias("product_name"))
    wanted = header.filter((F.col("status") == "CONFIRMED") & F.col("date").between(first, last))
    return (
        lines.join(wanted.withColumnRenamed("id", key), key)
        .join(active, "product_id")
        .join(t.warehouse.select(F.col("id").alias("warehouse_id"), F.col("name").alias("warehouse_name")), "warehouse_id")
        .select(
            F.lit(kind).alias("type"),
            "date",
            "invoice_no",
            "partner_name",
            "product_name",
            "qty",
            "unit_price",
            "line_total",
            "warehouse_name",
        )
    )


def _purchase_journal_rows(t, first: date, last: date) -> DataFrame:
    header = t.purchase_invoice.join(
        t.supplier.select(F.col("id").alias("supplier_id"), F.col("name").alias("partner_name")), "supplier_id"
    ).select("id", "invoice_no", "date", "status", "partner_name")
    return _journal(t, "PURCHASE", t.purchase_line, header, first, last, "purchase_invoice_id")


def trade_journal(t, first: date, last: date, limit: int = 20) -> DataFrame:
    sales_header = t.sales_invoice.select("id", "invoice_no", "date", "status", F.col("customer_name").alias("partner_name"))
    sales = _journal(t, "SALE", t.sales_line, sales_header, first, last, "sales_invoice_id")
    return _purchase_journal_rows(t, first, last).unionByName(sales).orderBy(*JOURNAL_ORDER).limit(limit)


def purchase_journal(t, first: date, last: date, limit: int = 5) -> DataFrame:
    return _purchase_journal_rows(t, first, last).orderBy(*JOURNAL_ORDER).limit(limit)


# Parameterised report procedures


def stock_report(t, warehouse_id: int, category_id=None, low_only: bool = False, by_status_text: bool = False) -> DataFrame:
    """Stock, value and status of the active products in one warehouse.

    Filters are added only when asked for. ``by_status_text`` selects the shorter report that is ordered
    by the status text; the longer one shows low stock first.
    """
    known_name(t.warehouse, warehouse_id, "Warehouse")
    product = t.product.filter("is_active")
    if category_id is not None:
        product = product.filter(F.col("category_id") == category_id)
    stock = F.col("current_stock")
    rows = stock_in(product, t.inventory_movement, warehouse_id)
    if low_only:
        rows = rows.filter(stock <= F.col("min_stock_level"))
    value = F.round(stock * F.col("default_price"), 2).cast("decimal(24,2)")
    rows = rows.join(named(t.category, "category", "name"), "category_id", "left").withColumn(
        "stock_status", stock_status("current_stock")
    )
    if by_status_text:
        return rows.select(
            "sku",
            F.col("name").alias("product_name"),
            F.col("category").alias("category_name"),
            "current_stock",
            "default_price",
            value.alias("stock_value"),
            "min_stock_level",
            "max_stock_level",
            "stock_status",
        ).orderBy("stock_status", "product_name", "sku")
    low_first = F.when(F.col("stock_status") == "LOW", 1).otherwise(2)
    return (
        rows.join(named(t.unit, "unit", "name"), "unit_id", "left")
        .orderBy(low_first, "name", "sku")
        .select(
            "sku",
            F.col("name").alias("product_name"),
            F.col("category").alias("category_name"),
            F.col("unit").alias("unit_name"),
            "current_stock",
            "min_stock_level",
            "max_stock_level",
            "default_price",
            value.alias("total_value"),
            "stock_status",
            F.when(stock >= 1, "AVAILABLE").otherwise("OUT OF STOCK").alias("availability"),
        )
    )


def supplier_report(t, supplier_id: int | None = None, fan_out: bool = True) -> DataFrame:
    """Offers and purchases per supplier.

    ``fan_out`` keeps the amounts of the join of offers with invoices, where each invoice counts once per
    offer: a factor on the total. An average is not changed by it.
    """
    supplier, offers, invoices = t.supplier, t.product_supplier, t.purchase_invoice
    if supplier_id is not None:
        known_name(supplier, supplier_id, "Supplier")
        supplier = supplier.filter(F.col("id") == supplier_id)
        offers = offers.filter(F.col("supplier_id") == supplier_id)
        invoices = invoices.filter(F.col("supplier_id") == supplier_id)
    offered = offers.groupBy("supplier_id").agg(
        F.count(F.lit(1)).alias("_offers"),
        mean("last_purchase_price").alias("_price"),
        F.min("lead_time_days").alias("min_lead_time"),
        F.max("lead_time_days").alias("max_lead_time"),
    )
    invoiced = invoices.groupBy("supplier_id").agg(
        F.count(F.lit(1)).alias("_invoices"), F.sum("total_amount").alias("_amount")
    )
    times = F.greatest(F.coalesce("_offers", F.lit(0)), F.lit(1)) if fan_out else F.lit(1)
    amount = F.coalesce(F.col("_amount").cast("decimal(26,2)") * times.cast("decimal(11,0)"), F.lit(0))
    return (
        supplier.withColumnRenamed("id", "supplier_id")
        .join(offered, "supplier_id", "left")
        .join(invoiced, "supplier_id", "left")
        .select(
            "supplier_id",
            F.col("name").alias("supplier_name"),
            "contact_email",
            "phone",
            "is_active",
            F.coalesce("_offers", F.lit(0)).alias("total_products"),
            F.coalesce("_invoices", F.lit(0)).alias("total_invoices"),
            amount.cast("decimal(38,2)").alias("total_purchase_amount"),
            F.coalesce("_price", F.lit(0.0)).alias("avg_purchase_price"),
            "min_lead_time",
            "max_lead_time",
        )
        .orderBy(F.desc("total_purchase_amount"), "supplier_id")
    )


def supplier_products_report(t, supplier_id: int) -> DataFrame:
    """Active products one supplier offers, with what was bought from it; an error row for an unknown supplier."""
    bought = (
        t.purchase_items.join(
            t.purchase_invoice.filter(F.col("supplier_id") == supplier_id).select(
                F.col("id").alias("purchase_invoice_id")
            ),
            "purchase_invoice_id",
            "left_semi",
        )
        .groupBy("product_id")
        .agg(F.count(F.lit(1)).alias("_count"), F.sum("qty").alias("total_purchased_qty"))
    )
    active = t.product.filter("is_active").select(F.col("id").alias("product_id"), "sku", F.col("name").alias("product_name"))
    offers = (
        t.product_supplier.filter(F.col("supplier_id") == supplier_id)
        .join(active, "product_id")
        .join(bought, "product_id", "left")
        .withColumn("purchase_count", F.coalesce("_count", F.lit(0)))
    )
    known = t.supplier.filter(F.col("id") == supplier_id).select(F.col("id").alias("supplier_id"))
    asked = t.supplier.sparkSession.createDataFrame([(supplier_id,)], "supplier_id bigint")
    error = asked.join(known, "supplier_id", "left_anti").select(F.lit("Supplier not found").alias("error"))
    return (
        offers.join(known, "supplier_id", "left_semi")
        .select(
            "sku",
            "product_name",
            "supplier_sku",
            "last_purchase_price",
            "lead_time_days",
            "is_preferred",
            "purchase_count",
            "total_purchased_qty",
        )
        .unionByName(error, allowMissingColumns=True)
        .orderBy("product_name", "sku")
    )


def register_views(t, as_of: date) -> None:
    """Names the three standing reports for use from SQL."""
    top_products_by_sales(t).createOrReplaceTempView("top_products_by_sales")
    category_summary(t).createOrReplaceTempView("category_summary")
    warehouse_activity_last_month(t, as_of).createOrReplaceTempView("warehouse_activity_last_month")
