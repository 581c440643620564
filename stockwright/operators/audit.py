"""Price audit and low-stock alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockwright.functions import wording as W
from stockwright.functions.expressions import BALANCE, MONEY, cents, changed, from_cents, percent_change, signed_qty
from stockwright.operators.ledger import CELL
from stockwright.operators.ordered import OrderedChunks
from stockwright.sources.tables import stage

PERCENT = "decimal(5,2)"


def audit_rows(changes: DataFrame, *carry: str, zero_is_full: bool = False) -> DataFrame:
    """Audit rows of (old_price, new_price) pairs that really changed.

    A change too large for the stored percent type is kept with ``out_of_range`` set.
    ``zero_is_full`` records a rise from zero as 100 percent; otherwise its percent is unknown.
    """
    percent = percent_change("old_price", "new_price")
    if zero_is_full:
        percent = F.when(F.col("old_price") == 0, F.lit(100).cast("decimal(20,2)")).otherwise(percent)
    return (
        changes.filter(changed("old_price", "new_price"))
        .withColumn("_percent", percent)
        .select(
            *carry,
            "old_price",
            "new_price",
            F.col("_percent").try_cast(PERCENT).alias("change_percent"),
            (F.col("_percent").isNotNull() & F.col("_percent").try_cast(PERCENT).isNull()).alias("out_of_range"),
        )
    )


def price_audit(product: DataFrame, changes: DataFrame) -> DataFrame:
    """Audit rows of list price changes; changes have (id, new_price)."""
    pairs = product.select("id", F.col("default_price").alias("old_price")).join(
        changes.select("id", "new_price"), "id"
    )
    return audit_rows(pairs.withColumnRenamed("id", "product_id"), "product_id")


def signed(rows: DataFrame, changed_by: str, reason: str | None = None) -> DataFrame:
    """Audit rows with who made the change and why, which the caller knows and Spark does not."""
    return rows.withColumns({"changed_by": F.lit(changed_by), "reason": F.lit(reason).cast("string")})


def supplier_price_audit(before: DataFrame, after: DataFrame) -> DataFrame:
    """Audit rows of purchase price changes between two versions of the product-supplier table."""
    pair = ["product_id", "supplier_id"]
    pairs = before.select(*pair, F.col("last_purchase_price").alias("old_price")).join(
        after.select(*pair, F.col("last_purchase_price").alias("new_price")), pair
    )
    return audit_rows(pairs, *pair, zero_is_full=True)


def price_history_audit(prices: DataFrame, last_prices: DataFrame | None = None) -> DataFrame:
    """Audit rows of a price history (product_id, price, changed_at, seq).

    ``last_prices`` (product_id, price) holds the prices before the history starts.
    """
    chunks = OrderedChunks(prices, ["product_id"], ["seq"])
    # In a struct, so that a price that was unknown differs from a history that has only begun.
    steps = chunks.running(previous={"_before": F.struct("price")})
    before = F.col("_before.price")
    if last_prices is not None:
        steps = steps.join(last_prices.select("product_id", F.col("price").alias("_last")), "product_id", "left")
        before = F.when(F.col("_before").isNull(), F.col("_last")).otherwise(before)
    steps = steps.withColumn("old_price", before)
    return audit_rows(steps.withColumnRenamed("price", "new_price"), "product_id", "changed_at")


class StockTimeline:
    """Every movement of an active product with the stock right after it and the level it is measured against, in cents.

    ``product`` has (id, min_stock_level, is_active). ``opening`` (cell, stock) is the stock before the first
    movement, zero where missing.
    """

    def __init__(
        self, movement: DataFrame, product: DataFrame, opening: DataFrame | None = None, chunks: int | None = None
    ):
        levels = product.filter("is_active").select(F.col("id").alias("product_id"), cents("min_stock_level").alias("_min"))
        # Everything a row needs is joined before the rows are put in order, so that the windows share one shuffle.
        moves = movement.select(*CELL, "created_at", "seq", cents(signed_qty()).alias("_delta")).join(levels, "product_id")
        before = F.lit(0).cast("bigint")
        if opening is not None:
            moves = moves.join(opening.select(*CELL, cents("stock").alias("_opening")), CELL, "left")
            before = F.coalesce("_opening", before)
        self.chunks = OrderedChunks(moves.withColumn("_before", before), CELL, ["seq"], chunks)
        one = F.lit(1).cast("bigint")
        rows = self.chunks.running(sums={"_moved": F.col("_delta"), "_position": one}, totals={"_size": one})
        rows = rows.withColumn("_stock", F.col("_before") + F.col("_moved"))
        low, was_low = F.col("_stock") <= F.col("_min"), F.col("_stock") - F.col("_delta") <= F.col("_min")
        # What matters is few: movements that leave the cell low, and those that end a low period, for all before them.
        rows = rows.withColumns({"is_low": low, "_was_low": was_low}).filter("is_low OR _was_low")
        self.marked = stage(rows.drop("_before", "_moved", "_delta"), "marked")
        ended = F.when(~F.col("is_low"), F.struct("created_at", "_position"))
        self.rows = self.chunks.next_known(self.marked, ended, "_recovery")

    def alerts(self) -> DataFrame:
        """An alert per movement that leaves a product low, closed by the next one that does not."""
        return self.rows.filter("is_low").select(
            *CELL,
            "seq",
            from_cents("_stock", BALANCE).alias("current_stock"),
            from_cents("_min", MONEY).alias("min_stock_level"),
            F.col("created_at").alias("alert_date"),
            F.col("_recovery").isNotNull().alias("is_resolved"),
            F.col("_recovery.created_at").alias("resolved_at"),
            F.when(F.col("_recovery").isNotNull(), W.REPLENISHED).alias("resolved_by"),
        )

    def episodes(self) -> DataFrame:
        """Low periods: one alert stays open until the stock recovers."""
        goes_low = F.col("is_low") & ((F.col("_position") == 1) | ~F.col("_was_low"))
        # A period that never ends runs to the last movement of its cell.
        end = F.coalesce(F.col("_recovery._position"), F.col("_size") + 1)
        return self.rows.filter(goes_low).select(
            *CELL,
            F.col("created_at").alias("opened_at"),
            from_cents("_stock", BALANCE).alias("stock_at_opening"),
            from_cents("_min", MONEY).alias("min_stock_level"),
            (end - F.col("_position")).alias("movements"),
            F.col("_recovery.created_at").alias("closed_at"),
        )


def resolve_on_deactivation(alerts: DataFrame, deactivated: DataFrame, at) -> DataFrame:
    """Alerts after closing the open ones of deactivated products; ``deactivated`` has (product_id)."""
    marked = alerts.join(
        deactivated.select("product_id").distinct().withColumn("_off", F.lit(True)), "product_id", "left"
    )
    return close_alerts(marked, F.coalesce("_off", F.lit(False)), F.lit(at), W.DEACTIVATED).drop("_off")


def close_alerts(alerts: DataFrame, condition, at, by: str) -> DataFrame:
    """Alerts after closing the open ones that meet a condition."""
    closing = condition & ~F.col("is_resolved")
    return alerts.withColumns(
        {
            "is_resolved": F.col("is_resolved") | closing,
            "resolved_at": F.when(closing, at).otherwise(F.col("resolved_at")),
            "resolved_by": F.when(closing, F.lit(by)).otherwise(F.col("resolved_by")),
        }
    )
