"""Table changes as pure functions from the old version of a table to the new one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockwright.functions import wording as W
from stockwright.functions.expressions import BALANCE, MONEY, cents, from_cents
from stockwright.operators.audit import close_alerts
from stockwright.operators.ledger import CELL, current_stock
from stockwright.operators.ordered import OrderedChunks
from stockwright.operators.rules import cancelled_now, confirmed_now

OFFER = ["product_id", "supplier_id"]


def append(table: DataFrame, rows: DataFrame) -> DataFrame:
    """Table with more rows; columns the rows lack are NULL."""
    return table.unionByName(rows, allowMissingColumns=True)


def apply_updates(table: DataFrame, changes: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    """Sets ``columns`` (target: source) on the rows whose key has a change; a NULL source is a value."""
    incoming = changes.select(
        key, *[F.col(source).alias(f"_new_{target}") for target, source in columns.items()], F.lit(True).alias("_set")
    )
    joined = table.join(incoming, key, "left")
    return joined.select(
        *[
            F.when(F.col("_set"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
            for c in table.columns
        ]
    )


def delete_where(table: DataFrame, condition: Column) -> DataFrame:
    """Rows that do not meet the condition; a condition that is NULL keeps its row."""
    return table.filter(~F.coalesce(condition, F.lit(False)))


def delete_parents(children: DataFrame, deleted: DataFrame, column: str, action: str) -> DataFrame:
    """What the children become when parents (id) go.

    CASCADE drops them, SET NULL clears the reference, RESTRICT returns the parents that must stay.
    """
    gone = deleted.select(F.col("id").alias(column))
    if action == "CASCADE":
        return children.join(gone, column, "left_anti")
    if action == "SET NULL":
        marked = children.join(gone.withColumn("_gone", F.lit(True)), column, "left")
        return marked.withColumn(column, F.when(F.col("_gone").isNull(), F.col(column))).select(*children.columns)
    if action == "RESTRICT":
        return deleted.join(children.select(F.col(column).alias("id")), "id", "left_semi")
    raise ValueError(f"unknown action {action}")


def with_defaults(table: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Fills columns that are missing or NULL with their declared defaults."""
    filled = {}
    for name, value in defaults.items():
        default = value if isinstance(value, Column) else F.lit(value)
        filled[name] = F.coalesce(F.col(name), default) if name in table.columns else default
    return table.withColumns(filled)


def invoice_totals(invoice: DataFrame, lines: DataFrame, key: str) -> DataFrame:
    """Headers with the sum of their lines as total, 0 without lines."""
    totals = lines.groupBy(F.col(key).alias("id")).agg(F.sum("line_total").alias("_total"))
    return (
        invoice.drop("total_amount")
        .join(totals, "id", "left")
        .withColumn("total_amount", F.coalesce("_total", F.lit(0).cast(MONEY)))
        .drop("_total")
    )


# Movements of documents


def movements_of_purchases(invoice: DataFrame, lines: DataFrame, supplier: DataFrame) -> DataFrame:
    """An IN movement per line of the given documents."""
    names = supplier.select(F.col("id").alias("supplier_id"), F.col("name").alias("_supplier"))
    header = invoice.join(names, "supplier_id").select(
        F.col("id").alias("purchase_invoice_id"),
        F.concat(F.lit(W.PURCHASE_NOTE), F.col("_supplier"), F.lit(W.INVOICE_NOTE), F.col("invoice_no")).alias("note"),
    )
    return lines.join(header, "purchase_invoice_id").select(
        *CELL,
        F.lit("IN").alias("movement_type"),
        "qty",
        F.lit("purchase").alias("related_type"),
        F.col("purchase_invoice_id").alias("related_id"),
        "note",
    )


def movements_of_sales(invoice: DataFrame, lines: DataFrame) -> DataFrame:
    """An OUT movement per line of the given documents."""
    header = invoice.select(
        F.col("id").alias("sales_invoice_id"),
        F.concat(
            F.lit(W.SALE_NOTE), F.col("customer_name"), F.lit(W.INVOICE_NOTE), F.col("invoice_no")
        ).alias("note"),
    )
    return lines.join(header, "sales_invoice_id").select(
        *CELL,
        F.lit("OUT").alias("movement_type"),
        "qty",
        F.lit("sale").alias("related_type"),
        F.col("sales_invoice_id").alias("related_id"),
        "note",
    )


def not_yet_moved(movements: DataFrame, ledger: DataFrame) -> DataFrame:
    """Movements that the ledger does not hold yet.

    Equal movements are counted on both sides, so a document line that is booked once more than its twin
    still yields exactly the missing one.
    """
    same = [*CELL, "movement_type", "qty", "related_type", "related_id"]
    due = movements.groupBy(*same, "note").agg(F.count(F.lit(1)).alias("_due"))
    booked = ledger.groupBy(*same).agg(F.count(F.lit(1)).alias("_booked"))
    missing = F.col("_due") - F.coalesce("_booked", F.lit(0))
    return (
        due.join(booked, same, "left")
        .withColumn("_missing", missing)
        .filter(F.col("_missing") > 0)
        .transform(repeat_rows, "_missing")
        .select(*same, "note")
    )


def repeat_rows(rows: DataFrame, times: str, block: int = 100_000) -> DataFrame:
    """Each row as often as ``times`` says, in blocks that are spread over the tasks."""
    one = F.lit(1).cast("bigint")
    blocks = rows.withColumn("_from", F.explode(F.sequence(one, F.col(times), F.lit(block).cast("bigint"))))
    last = F.least(F.col(times), F.col("_from") + block - 1)
    return (
        blocks.repartition("_from", *rows.columns)
        .withColumn("_copy", F.explode(F.sequence(F.col("_from"), last)))
        .drop("_from", "_copy")
    )


# Supplier prices


def line_prices(invoice: DataFrame, lines: DataFrame) -> DataFrame:
    """Price of the latest line per (product, supplier) of the given documents."""
    header = invoice.select(F.col("id").alias("purchase_invoice_id"), "supplier_id")
    return lines.join(header, "purchase_invoice_id").groupBy(*OFFER).agg(F.max_by("unit_price", "seq").alias("_price"))


def refresh_last_purchase_price(product_supplier: DataFrame, invoice: DataFrame, lines: DataFrame) -> DataFrame:
    """Known offers with the price of their latest line."""
    return (
        product_supplier.join(line_prices(invoice, lines), OFFER, "left")
        .withColumn("last_purchase_price", F.coalesce("_price", "last_purchase_price"))
        .drop("_price")
    )


def upsert_product_supplier(product_supplier: DataFrame, invoice: DataFrame, lines: DataFrame) -> DataFrame:
    """Offers with the price of their latest line, adding the offers that were not known."""
    return (
        product_supplier.join(line_prices(invoice, lines), OFFER, "full")
        .withColumns(
            {
                "last_purchase_price": F.coalesce("_price", "last_purchase_price"),
                "is_preferred": F.coalesce("is_preferred", F.lit(False)),
            }
        )
        .drop("_price")
    )


# Alerts


def upsert_alerts(alerts: DataFrame, low: DataFrame, at) -> DataFrame:
    """One alert per cell: low cells reopen theirs or get a new one.

    ``low`` has (cell, current_stock, min_stock_level), ``alerts`` one row per cell.
    """
    incoming = low.select(
        *CELL, F.col("current_stock").alias("_stock"), F.col("min_stock_level").alias("_min"), F.lit(True).alias("_low")
    )
    is_low = F.coalesce("_low", F.lit(False))
    return alerts.join(incoming, CELL, "full").select(
        *CELL,
        F.when(is_low, F.col("_stock")).otherwise(F.col("current_stock")).alias("current_stock"),
        F.coalesce("min_stock_level", "_min").alias("min_stock_level"),
        F.when(is_low, F.lit(at)).otherwise(F.col("alert_date")).alias("alert_date"),
        F.when(is_low, False).otherwise(F.col("is_resolved")).alias("is_resolved"),
        F.when(~is_low, F.col("resolved_at")).alias("resolved_at"),
        F.when(~is_low, F.col("resolved_by")).alias("resolved_by"),
    )


def resolve_by_purchase(alerts: DataFrame, lines: DataFrame, at, by: str = W.PURCHASE_CONFIRMED) -> DataFrame:
    """Alerts after closing the open ones of the cells that the lines fill."""
    filled = lines.select(*CELL).distinct().withColumn("_filled", F.lit(True))
    marked = alerts.join(filled, CELL, "left")
    return close_alerts(marked, F.coalesce("_filled", F.lit(False)), F.lit(at), by).drop("_filled")


# Effects of status changes. ``changes`` are validated: (id, ..., status, new_status, reason).


def purchases_confirmed(changes: DataFrame) -> DataFrame:
    """Documents confirmed by the changes, with the supplier they now have."""
    return changes.filter(confirmed_now()).select("id", F.col("new_supplier_id").alias("supplier_id"), "invoice_no")


def lines_of(lines: DataFrame, documents: DataFrame, key: str) -> DataFrame:
    return lines.join(documents.select(F.col("id").alias(key)), key, "left_semi")


def sales_confirmed(changes: DataFrame) -> DataFrame:
    return changes.filter(confirmed_now()).select("id", "customer_name", "invoice_no")


def sales_cancelled(changes: DataFrame) -> DataFrame:
    return changes.filter(cancelled_now()).select("id")


def drop_cancelled_movements(movement: DataFrame, cancelled: DataFrame) -> DataFrame:
    documents = cancelled.select(F.lit("sale").alias("related_type"), F.col("id").alias("related_id"))
    return movement.join(documents, ["related_type", "related_id"], "left_anti")


def drop_cancelled_alerts(alerts: DataFrame, cancelled: DataFrame, lines: DataFrame) -> DataFrame:
    """Drops the alerts of every product on a cancelled document, in all warehouses."""
    products = lines_of(lines, cancelled, "sales_invoice_id").select("product_id").distinct()
    return alerts.join(products, "product_id", "left_anti")


def alerts_of_sales(
    confirmed: DataFrame,
    lines: DataFrame,
    movement: DataFrame,
    product: DataFrame,
    open_alerts: DataFrame | None = None,
) -> DataFrame:
    """An alert per line of the confirmed documents that leaves its cell low, with the stock it leaves.

    Lines are booked in the order of ``seq``. With ``open_alerts`` given, a cell has one open alert at most: the first
    line that leaves it low raises it, unless one is open already.
    """
    sold = lines_of(lines, confirmed, "sales_invoice_id").select(*CELL, "seq", "qty")
    levels = product.select(F.col("id").alias("product_id"), "min_stock_level")
    rows = (
        sold.join(current_stock(movement), CELL, "left")
        .join(levels, "product_id")
        .withColumn("_before", F.coalesce(cents("stock"), F.lit(0)))
        .drop("stock")
    )
    ordered = OrderedChunks(rows, CELL, ["seq"])
    booked = ordered.running(sums={"_sold": cents("qty")}).withColumn(
        "current_stock", from_cents(F.col("_before") - F.col("_sold"), BALANCE)
    )
    low = booked.filter(F.col("current_stock") <= F.col("min_stock_level"))
    if open_alerts is not None:
        first = low.groupBy(*CELL).agg(
            F.min_by(F.struct("current_stock", "min_stock_level"), "seq").alias("_alert")
        )
        low = first.select(*CELL, "_alert.*").join(
            open_alerts.filter(~F.col("is_resolved")).select(*CELL), CELL, "left_anti"
        )
    return low.select(*CELL, "current_stock", "min_stock_level")
