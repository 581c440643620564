"""Batches of requests that book documents and movements.

Each function returns the requests with ``reason`` (NULL when accepted) and the stock after the request.
Rules that need no sequence come first; the rest compete for the stock in request order, see ``allocation``.
Requests carry ``seq``, unique and in the order they were made. ``opening`` is the stock (cell, stock) before
the batch.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockwright.functions import wording as W
from stockwright.functions.expressions import BALANCE, first_failure, line_total, signed_qty
from stockwright.operators.allocation import ENTRY, Competition, allocate
from stockwright.operators.audit import close_alerts
from stockwright.operators.changes import (
    invoice_totals,
    movements_of_purchases,
    not_yet_moved,
    upsert_product_supplier,
)
from stockwright.operators.ledger import CELL
from stockwright.operators.ordered import ROW
from stockwright.operators.rules import qty_and_price, with_dimensions, with_status
from stockwright.sources.tables import stage



def _level(opening: DataFrame) -> DataFrame:
    return opening.select(*CELL, F.col("stock").alias("level"))


def _book(
    checked: DataFrame,
    delta: Column,
    guarded: Column,
    opening: DataFrame | None,
    refusal: Column | str,
    chunks: int | None,
    keep_seq: bool = True,
) -> DataFrame:
    """Runs the requests without a reason against the stock; the others pass through as they are."""
    open_ = F.col("reason").isNull()
    taken = allocate(checked, CELL, ["seq"], F.when(open_, delta), guarded, opening, chunks, keep_seq)
    refusal = F.lit(refusal) if isinstance(refusal, str) else refusal
    after = F.when(F.col("accepted"), F.col("level")).cast(BALANCE)
    reason = F.coalesce("reason", F.when(~F.col("accepted"), refusal))
    return taken.withColumns({"stock_after": after, "reason": reason}).drop("accepted", "level")


@dataclass
class SaleBatch:
    """What a batch of sale requests books."""

    outcome: DataFrame

    @classmethod
    def staged(cls, outcome: DataFrame) -> SaleBatch:
        """For writing several parts: the requests are settled once and each part reads the result."""
        return cls(stage(outcome, "sales"))

    @property
    def accepted(self) -> DataFrame:
        return self.outcome.filter("reason IS NULL")

    def invoices(self) -> DataFrame:
        return self.accepted.select(
            "invoice_no",
            "customer_name",
            line_total().alias("total_amount"),
            F.lit("CONFIRMED").alias("status"),
            "issued_by",
        )

    def lines(self) -> DataFrame:
        return self.accepted.select(
            "invoice_no", "product_id", "warehouse_id", "qty", "unit_price", line_total().alias("line_total")
        )

    def movements(self) -> DataFrame:
        note = F.concat(F.lit(W.SALE_NOTE), "customer_name", F.lit(W.INVOICE_NOTE), "invoice_no")
        return self.accepted.select(
            *CELL,
            F.lit("OUT").alias("movement_type"),
            "qty",
            F.lit("sale").alias("related_type"),
            F.col("invoice_no").alias("related_id"),
            note.alias("note"),
            "seq",
        )

    def alerts(self) -> DataFrame:
        """An alert per sale that leaves its cell below the minimum."""
        return self.accepted.filter(F.col("stock_after") < F.col("min_stock_level")).select(
            *CELL, F.col("stock_after").alias("current_stock"), "min_stock_level"
        )


def process_sales(
    requests: DataFrame,
    product: DataFrame,
    warehouse: DataFrame,
    opening: DataFrame,
    used_numbers: DataFrame,
    chunks: int | None = None,
) -> DataFrame:
    """One sale per request: (seq, customer_name, invoice_no, product_id, warehouse_id, qty, unit_price, issued_by).

    ``used_numbers`` has the (invoice_no) of existing documents. Within the batch a number belongs to the first request
    that is accepted with it; a request that the stock refuses leaves its number free.

    Who gets a number depends on the stock, and the stock on who got a number. Only numbers that are asked for more than
    once can change hands: their first sound request tries for the stock, the others are barred. Then those that no
    accepted earlier request bars try as well, and so on, until nothing changes. A decision rests on earlier ones only, so
    there is one such outcome, and each round settles at least the earliest decision that was still wrong. A round walks
    the changed cells from their first changed request on, on narrow rows; the requests as a whole are put in order once
    and booked once, at the end.
    """
    checked = with_dimensions(requests, product, warehouse).withColumn(
        "_refused",
        first_failure(
            [
                *qty_and_price(),
                (W.PRODUCT_INACTIVE, ~F.coalesce("product_active", F.lit(False))),
                (W.WAREHOUSE_INACTIVE, ~F.coalesce("warehouse_active", F.lit(False))),
            ]
        ),
    )
    used = used_numbers.select("invoice_no").distinct().withColumn("_used", F.lit(True))
    checked = checked.join(used, "invoice_no", "left").withColumn(
        "_refused", F.coalesce("_refused", first_failure([(W.NUMBER_TAKEN, F.coalesce("_used", F.lit(False)))]))
    )
    asked = checked.drop("_used", "product_active", "warehouse_active", "max_stock_level")
    sound = F.col("_refused").isNull()
    competition = Competition(asked, CELL, ["seq"], F.when(sound, -F.col("qty")), F.lit(True), _level(opening), chunks)
    taken = competition.outcome(_barred(competition))
    reason = F.when(F.col("_barred"), W.NUMBER_TAKEN).when(~F.col("accepted"), W.NO_STOCK)
    return taken.withColumns(
        {
            "reason": F.coalesce("_refused", reason),
            "stock_after": F.when(F.col("accepted"), F.col("level")).cast(BALANCE),
        }
    ).drop("_refused", "_barred", "accepted", "level")


def _barred(competition: Competition) -> DataFrame:
    """The sound requests whose number an earlier one gets."""
    sound = competition.rows.filter("_refused IS NULL").select(*CELL, ROW, "seq", "invoice_no")
    first = sound.groupBy("invoice_no").agg(F.count(F.lit(1)).alias("_asked"), F.min("seq").alias("_holder"))
    rivals = sound.join(first.filter("_asked > 1"), "invoice_no").select(
        *CELL, ROW, "seq", "invoice_no", (F.col("seq") > F.col("_holder")).alias("_barred")
    )
    rivals = stage(rivals, "rivals")
    narrow = competition.rows.select(*competition.ordered.groups, ROW, "_delta", "_guarded", "_opening")
    at_rivals = rivals.select(*CELL).distinct()
    # Requests to walk: at first all of the cells that rivals ask for.
    walked = narrow.join(at_rivals, CELL, "left_semi")
    settled = None
    while True:
        tried = walked.join(rivals.drop(*CELL), ROW, "left")
        tried = tried.withColumn("_delta", F.when(~F.coalesce("_barred", F.lit(False)), F.col("_delta")))
        moved = F.when(F.col("accepted"), F.col("_delta")).otherwise(0)
        now = competition.settle(tried).filter("invoice_no IS NOT NULL").select(
            *CELL, ROW, "seq", "invoice_no", "_barred", "accepted", (F.col("_level") - moved).alias("_before")
        )
        if settled is not None:
            now = now.unionByName(settled)
        decided = stage(now, "decided")
        holders = decided.groupBy("invoice_no").agg(F.min(F.when(F.col("accepted"), F.col("seq"))).alias("_holder"))
        bars = F.coalesce(F.col("seq") > F.col("_holder"), F.lit(False))
        after = stage(decided.join(holders, "invoice_no").withColumn("_bars", bars).drop("_holder"), "rivals")
        # The first request of a cell whose right to try has changed, and the level it finds.
        first = after.filter("_bars <> _barred").groupBy(*CELL).agg(
            F.min(ROW).alias("_from"), F.min_by("_before", ROW).alias("_found")
        )
        if first.isEmpty():
            return rivals.filter("_barred")
        rivals = after.select(*CELL, ROW, "seq", "invoice_no", F.col("_bars").alias("_barred"))
        first = stage(first, "first")
        suffix = narrow.drop("_opening").join(first, CELL).filter(F.col(ROW) >= F.col("_from"))
        walked = suffix.withColumnRenamed("_found", "_opening").drop("_from")
        earlier = F.col("_from").isNull() | (F.col(ROW) < F.col("_from"))
        settled = after.join(first.drop("_found"), CELL, "left").filter(earlier).drop("_from", "_bars")


def safe_decrease_stock(requests: DataFrame, opening: DataFrame, chunks: int | None = None) -> DataFrame:
    """Takes stock out as long as it lasts: (seq, product_id, warehouse_id, qty)."""
    unknown = F.col("product_id").isNull() | F.col("warehouse_id").isNull()
    checked = requests.withColumn("reason", first_failure([(W.NO_PRODUCT, unknown)]))
    return _book(checked, -F.col("qty"), F.lit(True), _level(opening), W.NO_STOCK, chunks)


def add_purchase_lines(
    requests: DataFrame,
    invoice: DataFrame,
    product: DataFrame,
    warehouse: DataFrame,
    opening: DataFrame,
    lines_only: bool = False,
    chunks: int | None = None,
) -> DataFrame:
    """Purchase lines that are received at once, up to the maximum level of the product.

    ``lines_only`` is the rule set that only adds the line: no quantity, price or level is checked and no
    stock moves.
    """
    rows = with_dimensions(with_status(requests, invoice, "purchase_invoice_id"), product, warehouse)
    no_invoice = (W.NO_INVOICE, F.col("invoice_status").isNull())
    no_product = (W.PRODUCT_UNUSABLE, ~F.coalesce("product_active", F.lit(False)))
    no_warehouse = (W.WAREHOUSE_UNUSABLE, ~F.coalesce("warehouse_active", F.lit(False)))
    not_draft = (W.LINE_CLOSED, F.col("invoice_status") != "DRAFT")
    if lines_only:
        return rows.withColumn("reason", first_failure([no_invoice, not_draft, no_product, no_warehouse]))
    checked = rows.withColumn(
        "reason", first_failure([*qty_and_price(), no_invoice, no_product, no_warehouse, not_draft])
    )
    # The level is the room left below the maximum; without a maximum it is not guarded.
    limit = F.coalesce("max_stock_level", F.lit(0))
    entered = checked.join(opening.select(*CELL, F.col("stock").alias("_stock")), CELL, "left").withColumn(
        ENTRY, limit - F.coalesce("_stock", F.lit(0))
    )
    booked = _book(
        entered.drop("_stock"), -F.col("qty"), F.col("max_stock_level").isNotNull(), None, W.OVER_MAX, chunks
    )
    return booked.withColumn("stock_after", (limit - F.col("stock_after")).cast(BALANCE))


def purchase_movements(outcome: DataFrame) -> DataFrame:
    """IN movements of the accepted purchase lines."""
    return outcome.filter("reason IS NULL").select(
        *CELL,
        F.lit("IN").alias("movement_type"),
        "qty",
        F.lit("purchase").alias("related_type"),
        F.col("purchase_invoice_id").alias("related_id"),
    )


@dataclass
class ReceiptBatch:
    """What a batch of purchase lines that are received at once changes."""

    outcome: DataFrame

    @classmethod
    def staged(cls, outcome: DataFrame) -> ReceiptBatch:
        return cls(stage(outcome, "receipts"))

    @property
    def accepted(self) -> DataFrame:
        return self.outcome.filter("reason IS NULL")

    def movements(self) -> DataFrame:
        return purchase_movements(self.outcome)

    def totals(self, invoice: DataFrame, lines: DataFrame) -> DataFrame:
        """Documents with the total of the lines they had and of those they got."""
        columns = ["purchase_invoice_id", "line_total"]
        got = self.accepted.select("purchase_invoice_id", line_total().alias("line_total"))
        return invoice_totals(invoice, lines.select(*columns).unionByName(got), "purchase_invoice_id")

    def prices(self, product_supplier: DataFrame, invoice: DataFrame) -> DataFrame:
        """Offers with the price of the latest line received, new ones added."""
        lines = self.accepted.select("purchase_invoice_id", "product_id", "unit_price", "seq")
        return upsert_product_supplier(product_supplier, invoice, lines)

    def alerts(self, alerts: DataFrame, at) -> DataFrame:
        """Alerts after closing the open ones of cells that a receipt brought to the minimum or above."""
        return resolve_by_adjustment(alerts, self.outcome, at, W.RECEIVED)


def adjust_inventory(
    requests: DataFrame,
    product: DataFrame,
    warehouse: DataFrame,
    opening: DataFrame,
    active_only: bool = False,
    chunks: int | None = None,
) -> DataFrame:
    """Corrections (seq, product_id, warehouse_id, qty) that may not lead below zero.

    ``active_only`` is the rule set that asks for active products and warehouses instead of a stock of zero
    and above.
    """
    rows = with_dimensions(requests, product, warehouse)
    product_ok, warehouse_ok = F.col("product_active"), F.col("warehouse_active")
    if not active_only:
        product_ok, warehouse_ok = product_ok.isNotNull(), warehouse_ok.isNotNull()
    checked = rows.withColumn(
        "reason",
        first_failure(
            [
                (W.NO_PRODUCT, ~F.coalesce(product_ok, F.lit(False))),
                (W.NO_WAREHOUSE, ~F.coalesce(warehouse_ok, F.lit(False))),
            ]
        ),
    )
    return _book(checked, F.col("qty"), F.lit(not active_only), _level(opening), W.UNDER_ZERO, chunks)


def adjustment_alerts(outcome: DataFrame, inclusive: bool = False, open_alerts: DataFrame | None = None) -> DataFrame:
    """Alerts of accepted corrections: below the minimum, or at it as well when ``inclusive``.

    With ``open_alerts`` given, a cell has one open alert at most: the first correction that leaves it low
    raises it.
    """
    stock, minimum = F.col("stock_after"), F.col("min_stock_level")
    low = outcome.filter("reason IS NULL").filter(stock <= minimum if inclusive else stock < minimum)
    alerts = low.select(*CELL, "seq", stock.alias("current_stock"), "min_stock_level")
    if open_alerts is not None:
        first = alerts.groupBy(*CELL).agg(
            F.min_by(F.struct("current_stock", "min_stock_level"), "seq").alias("_alert")
        )
        alerts = first.select(*CELL, "_alert.*").join(
            open_alerts.filter(~F.col("is_resolved")).select(*CELL), CELL, "left_anti"
        )
    return alerts.select(*CELL, "current_stock", "min_stock_level")


def resolve_by_adjustment(alerts: DataFrame, outcome: DataFrame, at, by: str) -> DataFrame:
    """Alerts after closing the open ones of cells that an accepted request brought to the minimum or above."""
    restored = (
        outcome.filter("reason IS NULL")
        .filter(F.col("stock_after") >= F.col("min_stock_level"))
        .select(*CELL)
        .distinct()
        .withColumn("_restored", F.lit(True))
    )
    marked = alerts.join(restored, CELL, "left")
    return close_alerts(marked, F.coalesce("_restored", F.lit(False)), F.lit(at), by).drop("_restored")


def validate_movements(
    requests: DataFrame,
    product: DataFrame,
    warehouse: DataFrame,
    opening: DataFrame,
    strict: bool = False,
    chunks: int | None = None,
    keep_seq: bool = True,
) -> DataFrame:
    """Movements (seq, product_id, warehouse_id, movement_type, qty) in the order they arrive.

    Without ``keep_seq`` the outcome has no ``seq``: it is not carried on once the requests are in order.

    ``strict`` is the rule set that takes positive quantities of active products only and lets no correction
    lower the stock.
    """
    rows = with_dimensions(requests, product, warehouse)
    kind, qty = F.col("movement_type"), F.col("qty")
    inactive = ~F.col("product_active")
    closed = (W.MOVE_CLOSED_SITE, ~F.col("warehouse_active"))
    if strict:
        rules = [
            (W.MOVE_INACTIVE, inactive),
            closed,
            (W.MOVE_KIND, ~kind.isin("IN", "OUT", "ADJUST")),
            (W.NO_QTY, qty <= 0),
        ]
        guarded = kind == "OUT"
    else:
        rules = [(W.MOVE_INACTIVE, inactive & (kind != "ADJUST")), closed]
        guarded = kind.isin("OUT", "ADJUST")
    # What the rules let through because nothing is known about it fails the key checks.
    rules += [
        (W.NO_PRODUCT, F.col("product_active").isNull()),
        (W.NO_WAREHOUSE, F.col("warehouse_active").isNull()),
        (W.NO_QTY, qty.isNull()),
    ]
    refusal = F.when(kind == "OUT", W.NO_STOCK).otherwise(W.UNDER_ZERO)
    checked = rows.withColumn("reason", first_failure(rules))
    return _book(checked, signed_qty(), guarded, _level(opening), refusal, chunks, keep_seq)


def confirm_purchases(requests: DataFrame, invoice: DataFrame) -> DataFrame:
    """Confirmation of purchase documents by (id), with the document's columns."""
    known = invoice.select("id", "supplier_id", "invoice_no", "status")
    return requests.select("id").distinct().join(known, "id", "left").withColumn(
        "reason",
        first_failure(
            [
                (W.NO_INVOICE, F.col("status").isNull()),
                (W.IS_CONFIRMED, F.col("status") == "CONFIRMED"),
                (W.IS_CANCELLED, F.col("status") == "CANCELLED"),
            ]
        ),
    )


def confirmation_movements(outcome: DataFrame, lines: DataFrame, supplier: DataFrame, ledger: DataFrame) -> DataFrame:
    """IN movements of the confirmed documents, each line booked once even if it was received before."""
    confirmed = outcome.filter("reason IS NULL").select("id", "supplier_id", "invoice_no")
    return not_yet_moved(movements_of_purchases(confirmed, lines, supplier), ledger)
