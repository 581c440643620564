"""All queries over the stored tables, by name."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from stockwright.operators import audit, changes, commands, ledger, rules
from stockwright.operators.ordered import assign_ids
from stockwright.plans import integrity
from stockwright.plans import reports as R
from stockwright.plans.report_oracles import ORACLES as REPORT_ORACLES
from stockwright.plans.oracle_model import MODEL
from stockwright.plans.rule_oracles import ORACLES as RULE_ORACLES
from stockwright.sources.tables import SCHEMAS, load_tables, new_folder, stage
from stockwright.sources.trade import AS_OF, PURCHASE, SALE, TradeData, movements_of_events, prices_of_events
from stockwright.streaming.jobs import PriceStream, StockStream, run_to_end

Query = Callable[[SparkSession, str], DataFrame]


def portable(df: DataFrame) -> DataFrame:
    """Amounts as double and dates as text, so that any engine shows the same values."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            column = column.cast("string")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def over(build: Callable[..., DataFrame], *args, **kwargs) -> Query:
    """A query that builds its result from the trade tables of a folder."""
    return lambda spark, directory: portable(build(TradeData(spark, directory), *args, **kwargs))


def counted(build: Callable[..., DataFrame], *args) -> Query:
    return over(lambda t: build(t, *args).agg(F.count(F.lit(1)).alias("total_rows")))


MONTH = (date(1998, 1, 1), date(1998, 1, 31))
DAYS = (date(1998, 1, 10), date(1998, 1, 15))
PRICES = (Decimal(920), Decimal(980))
# An earlier state of the ledger.
EARLIER = date(2000, 1, 1)


def _now() -> Column:
    """Time at which changes are made."""
    return F.lit(AS_OF).cast("timestamp_ntz")


def _movements_by_document(t: TradeData) -> DataFrame:
    shipped = t.sales_invoice.filter(F.col("status") == "SHIPPED").select(
        F.lit("sale").alias("related_type"), F.col("id").alias("related_id")
    )
    cancelled = t.purchase_invoice.filter(F.col("status") == "CANCELLED").select(
        F.lit("purchase").alias("related_type"), F.col("id").alias("related_id")
    )
    return R.movements_by_document(t, shipped.unionByName(cancelled)).drop("seq", "note")


def _loaded(spark: SparkSession, directory: str) -> DataFrame:
    """Rows of every stored table."""
    counts = [
        table.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, table in load_tables(spark, directory).items()
    ]
    return reduce(DataFrame.unionByName, counts)


REPORTS: dict[str, Query] = {
    "load_tables": _loaded,
    "purchases_in_date_range": over(R.purchases_in_date_range, *DAYS),
    "purchases_in_date_range_count": counted(R.purchases_in_date_range, *DAYS),
    "products_name_contains": over(R.products_name_contains, "RING"),
    "products_name_contains_count": counted(R.products_name_contains, "RING"),
    "invoices_customer_contains": over(R.invoices_customer_contains, "#00000012"),
    "active_products_price_range": over(R.active_products_price_range, *PRICES),
    "active_products_price_range_ascending": over(R.active_products_price_range, *PRICES, descending=False),
    "active_products_price_range_count": counted(R.active_products_price_range, *PRICES),
    "recent_confirmed_sales": over(R.recent_confirmed_sales),
    "movements_by_document": over(_movements_by_document),
    "first_products": over(R.first_products),
    "products_with_category_unit": over(R.products_with_category_unit),
    "suppliers_with_products": over(R.suppliers_with_products),
    "movements_with_purchase_invoice": over(R.movements_with_purchase_invoice),
    "sales_detail": over(R.sales_detail),
    "purchase_detail": over(R.purchase_detail),
    "sales_with_warehouse": over(R.sales_with_warehouse),
    "products_with_supplier_or_default": over(R.products_with_supplier_or_default),
    "product_sample_dims": over(R.product_sample_dims),
    "confirmed_sales_lines": over(
        lambda t: R.confirmed_sales_lines(t).select("sales_invoice_id", "product_id", "qty", "line_total")
    ),
    "alerts_to_raise": over(lambda t: R.alerts_to_raise(t, _earlier_alerts(t))),
    "price_audit_detail": over(R.price_audit_detail),
    "alerts_detail": over(R.alerts_detail),
    "latest_alerts": over(R.alerts_detail, 5),
    "purchases_by_supplier": over(R.purchases_by_supplier),
    "avg_price_by_category_having": over(R.avg_price_by_category_having, 950),
    "movement_stats_by_warehouse": over(R.movement_stats_by_warehouse),
    "sales_line_totals": over(R.sales_line_totals),
    "sales_by_customer_having": over(R.sales_by_customer_having, Decimal(500000)),
    "purchases_by_supplier_product": over(R.purchases_by_supplier_product),
    "supplier_purchase_counts": over(R.supplier_purchase_counts),
    "category_price_counts_having": over(R.category_price_counts_having, 950),
    "sales_by_month": over(R.sales_by_month),
    "products_sold_having": over(R.products_sold_having),
    "top_customers_by_revenue": over(R.top_customers_by_revenue),
    "top_products_by_sales": over(R.top_products_by_sales),
    "category_summary": over(R.category_summary),
    "category_summary_exact": over(R.category_summary_exact),
    "warehouse_activity_last_month": over(R.warehouse_activity_last_month, AS_OF),
    "stock_grid_positive": over(R.stock_grid_positive),
    "products_per_category": over(R.products_per_category),
    "product_purchase_totals": over(R.product_purchase_totals),
    "product_purchase_totals_top": over(R.product_purchase_totals, 5),
    "monthly_sales_analysis": over(R.monthly_sales_analysis, date(1998, 1, 1)),
    "movement_analysis": over(R.movement_analysis, date(1998, 1, 1)),
    "stock_status_sample": over(R.stock_of_products, [1, 2, 3], 1),
    "table_row_counts": over(R.table_row_counts),
    "table_row_counts_union": over(R.table_counts_long),
    "operations_dashboard": over(R.operations_dashboard),
    "ordered_string_agg": over(R.suppliers_per_product),
    "conditional_profile": over(R.product_profile),
    "product_ranking": over(R.product_ranking),
    "product_ranking_exact": over(R.product_ranking, fan_out=False),
    "product_ranking_top5": over(R.product_ranking_top, 5),
    "last_movements": over(R.last_movements),
    "product_movement_history": over(R.product_movement_history, 5, 1),
    "markup_top": over(R.markup_top, 1),
    "trade_journal": over(R.trade_journal, *MONTH),
    "purchase_journal": over(R.purchase_journal, *MONTH),
    "stock_report": over(R.stock_report, 1),
    "stock_report_low": over(R.stock_report, 1, low_only=True),
    "stock_report_category": over(R.stock_report, 1, category_id="Brand#2"),
    "stock_report_v4": over(R.stock_report, 1, by_status_text=True),
    "supplier_report": over(R.supplier_report),
    "supplier_report_one": over(R.supplier_report, 1),
    "supplier_report_exact": over(R.supplier_report, fan_out=False),
    "supplier_products_report": over(R.supplier_products_report, 1),
}

def _append(t: TradeData) -> DataFrame:
    booked = _confirmed_purchase_movements(t)
    return (
        changes.append(t.inventory_movement, booked)
        .groupBy("related_type")
        .agg(F.count(F.lit(1)).alias("movements"), F.sum("qty").alias("qty"))
    )


def _confirmed(invoice: DataFrame) -> DataFrame:
    return invoice.filter(F.col("status") == "CONFIRMED")


def _confirmed_purchase_movements(t: TradeData) -> DataFrame:
    return changes.movements_of_purchases(_confirmed(t.purchase_invoice), t.purchase_line, t.supplier)


def _apply_updates(t: TradeData) -> DataFrame:
    wanted = t.product_changes.filter("new_active")
    columns = {"default_price": "new_price", "min_stock_level": "new_min", "max_stock_level": "new_max"}
    return changes.apply_updates(t.product, wanted, "id", columns).select("id", "sku", *columns)


def _refreshed(t: TradeData) -> DataFrame:
    return changes.refresh_last_purchase_price(t.product_supplier, _confirmed(t.purchase_invoice), t.purchase_items)


def _upserted_offers(t: TradeData) -> DataFrame:
    return changes.upsert_product_supplier(
        t.product_supplier, _confirmed(t.purchase_invoice), t.purchase_items
    ).drop("supplier_sku")


def _earlier_alerts(t: TradeData) -> DataFrame:
    return t.low_stock_alerts_before(EARLIER)


def _upserted_alerts(t: TradeData) -> DataFrame:
    low = t.low_stock_alerts.filter(~F.col("is_resolved"))
    return changes.upsert_alerts(_earlier_alerts(t), low, _now())


def _deleted(t: TradeData) -> DataFrame:
    return changes.delete_where(t.inventory_movement, F.col("note").like("sale 1%")).drop("seq", "created_at")


def _purchase_changes(t: TradeData) -> DataFrame:
    return rules.validate_purchase_status(t.purchase_status_changes)


def _sales_changes(t: TradeData) -> DataFrame:
    return rules.validate_sales_confirm(t.sales_status_changes, t.sales_line, t.inventory_movement)


def _cancelled(t: TradeData) -> DataFrame:
    # Stock only decides about confirmations, so cancelling reads no lines and no ledger.
    return changes.sales_cancelled(rules.validate_sales_confirm(t.sales_status_changes))


def _ids(t: TradeData) -> DataFrame:
    numbered = assign_ids(t.purchase_items, ["seq"], after=t.product.select("id"))
    return numbered.select("id", "product_id", "qty", "line_total")


def _line_totals(t: TradeData) -> DataFrame:
    priced = t.purchase_items.select("purchase_invoice_id", "product_id", "qty", "unit_price", "line_total")
    return changes.with_defaults(priced, {"status": "DRAFT"})


def _requested_cells(t: TradeData) -> DataFrame:
    key = F.col("p_partkey")
    return t.base("part").select(
        F.when(key % 50 == 0, -1).otherwise(key).cast("bigint").alias("product_id"), (key % 7).alias("warehouse_id")
    )


def _stock_of(t: TradeData) -> DataFrame:
    return ledger.stock_of(_requested_cells(t), t.inventory_movement, t.product, t.warehouse)


def _availability(t: TradeData) -> DataFrame:
    wanted = t.sales_line.select("product_id", "warehouse_id", F.col("qty").alias("required"))
    return ledger.availability(wanted, t.inventory_movement, t.product, t.warehouse).drop("reason")


def _sale_requests(t: TradeData) -> DataFrame:
    number = F.concat_ws("-", F.lit("S"), F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    return t.line_requests(SALE).select(
        "seq",
        F.concat(F.lit("Customer of order "), F.col("l_orderkey").cast("string")).alias("customer_name"),
        number.alias("invoice_no"),
        "product_id",
        "warehouse_id",
        "qty",
        "unit_price",
        F.lit("sales").alias("issued_by"),
    )


def _sales(t: TradeData) -> DataFrame:
    return commands.process_sales(
        _sale_requests(t), t.product, t.warehouse, t.opening_stock, t.sales_invoice.select("invoice_no")
    )


def _sale_outcome(t: TradeData) -> DataFrame:
    return _sales(t).select("invoice_no", "product_id", "warehouse_id", "qty", "unit_price", "reason", "stock_after")


def _safe_decrease(t: TradeData) -> DataFrame:
    wanted = t.sales_line.select("seq", "sales_invoice_id", "product_id", "warehouse_id", "qty")
    return commands.safe_decrease_stock(wanted, t.opening_stock).drop("seq")


def _added_lines(t: TradeData, lines_only: bool = False) -> DataFrame:
    outcome = commands.add_purchase_lines(
        t.line_requests(PURCHASE),
        t.purchase_invoice,
        t.product,
        t.warehouse,
        ledger.current_stock(t.inventory_movement),
        lines_only,
    )
    columns = ["purchase_invoice_id", "product_id", "warehouse_id", "qty", "unit_price", "reason"]
    return outcome.select(*columns, *([] if lines_only else ["stock_after"]))


def _adjusted(t: TradeData, active_only: bool = False) -> DataFrame:
    wanted = t.inventory_movement.filter(F.col("movement_type") == "ADJUST").select(
        "seq", "product_id", "warehouse_id", "qty", "related_id"
    )
    return commands.adjust_inventory(wanted, t.product, t.warehouse, t.opening_stock, active_only)


def _adjust_outcome(t: TradeData, active_only: bool = False) -> DataFrame:
    return _adjusted(t, active_only).select("product_id", "warehouse_id", "related_id", "qty", "reason", "stock_after")


def _strict_adjust_alerts(t: TradeData) -> DataFrame:
    return commands.adjustment_alerts(_adjusted(t, True), inclusive=True, open_alerts=_earlier_alerts(t))


def _adjust_closed(t: TradeData) -> DataFrame:
    return _resolved(commands.resolve_by_adjustment(_earlier_alerts(t), _adjusted(t), _now(), "stocktaking"))


def _received(t: TradeData) -> commands.ReceiptBatch:
    outcome = commands.add_purchase_lines(
        t.line_requests(PURCHASE),
        t.purchase_invoice,
        t.product,
        t.warehouse,
        ledger.current_stock(t.inventory_movement),
    )
    return commands.ReceiptBatch(outcome)


def _confirmations(t: TradeData) -> DataFrame:
    unknown = t.spark.createDataFrame([("-1/-1",)], "id string")
    return commands.confirm_purchases(t.urgent_purchases.unionByName(unknown), t.purchase_invoice)


def _confirmation_movements(t: TradeData) -> DataFrame:
    booked = t.inventory_movement.filter(F.col("created_at") < F.lit(EARLIER))
    return commands.confirmation_movements(_confirmations(t), t.purchase_line, t.supplier, booked)


def _checked_purchase_lines(t: TradeData) -> DataFrame:
    return rules.validate_purchase_lines(
        t.line_requests(PURCHASE), t.purchase_invoice, t.product, t.warehouse, t.inventory_movement
    ).select("purchase_invoice_id", "product_id", "warehouse_id", "qty", "unit_price", "reason")


def _checked_sales_lines(t: TradeData, drafts_only: bool = False) -> DataFrame:
    lines = t.line_requests(SALE).withColumnRenamed("purchase_invoice_id", "sales_invoice_id")
    return rules.validate_sales_lines(
        lines, t.sales_invoice, t.product, t.warehouse, t.inventory_movement, drafts_only
    ).select("sales_invoice_id", "product_id", "warehouse_id", "qty", "unit_price", "reason")


def _checked_products(t: TradeData) -> DataFrame:
    return rules.validate_product_updates(
        t.product, t.product_changes, t.purchase_items, t.purchase_invoice, t.sales_items, t.sales_invoice
    ).select("id", "old_price", "new_price", "reason", "reduction")


def _checked_movements(t: TradeData, strict: bool = False) -> DataFrame:
    asked = t.movement_requests.select("seq", "product_id", "warehouse_id", "movement_type", "qty", "related_id")
    nothing = t.opening_stock.filter(F.lit(False))
    return commands.validate_movements(asked, t.product, t.warehouse, nothing, strict, keep_seq=False).select(
        "product_id", "warehouse_id", "movement_type", "related_id", "qty", "reason", "stock_after"
    )


def _checked_deletes(lines: DataFrame, invoice: DataFrame, key: str) -> DataFrame:
    return rules.validate_line_deletes(lines.filter(F.col("qty") < 10), invoice, key).select(
        key, "product_id", "qty", "reason"
    )


def _constraints(t: TradeData) -> DataFrame:
    def among(column: str, *values: str) -> Column:
        return ~F.col(column).isin(*values)

    active = F.col("is_active")
    checks = [
        rules.Unique("product", "unique sku", ("sku",)),
        rules.Holds("product", "not null name, price", F.col("name").isNull() | F.col("default_price").isNull()),
        rules.Holds("product", "name up to 8 characters", F.length("name") > 8),
        rules.Exists("product", "category exists", "category_id", "category"),
        rules.Unique("product_supplier", "unique pair", tuple(changes.OFFER)),
        rules.Unique("purchase_invoice", "unique number", ("invoice_no",)),
        rules.Holds("purchase_invoice", "status DRAFT or CONFIRMED", among("status", "DRAFT", "CONFIRMED")),
        rules.Exists("purchase_line", "invoice exists", "purchase_invoice_id", "purchase_invoice"),
        rules.Unique("purchase_line", "product once per invoice", ("purchase_invoice_id", "product_id")),
        rules.Holds("inventory_movement", "movement type", among("movement_type", "IN", "OUT", "ADJUST")),
        rules.Exists("inventory_movement", "product exists", "product_id", "product", active),
        rules.Exists("inventory_movement", "warehouse exists", "warehouse_id", "warehouse", active),
        rules.Unique("sales_invoice", "unique number", ("invoice_no",)),
        rules.Holds(
            "sales_invoice", "status DRAFT, CONFIRMED or CANCELLED", among("status", "DRAFT", "CONFIRMED", "CANCELLED")
        ),
        rules.Exists("sales_line", "invoice exists", "sales_invoice_id", "sales_invoice"),
        rules.Exists("sales_line", "product exists", "product_id", "product"),
        rules.Unique("unit", "unique code", ("name",)),
    ]
    names = {c.table for c in checks} | {c.parent for c in checks if isinstance(c, rules.Exists)}
    tables = {name: getattr(t, name) for name in sorted(names)}
    # The warehouse of a line costs a join that no rule on lines asks for.
    tables |= {"purchase_line": t.purchase_items, "sales_line": t.sales_items}
    return rules.constraint_report(tables, checks)


def _confirmed_prices(t: TradeData) -> DataFrame:
    confirmed = changes.purchases_confirmed(_purchase_changes(t))
    return changes.refresh_last_purchase_price(t.product_supplier, confirmed, t.purchase_items).select(
        *changes.OFFER, "last_purchase_price"
    )


def _resolved(alerts: DataFrame) -> DataFrame:
    return alerts.select("product_id", "warehouse_id", "is_resolved", "resolved_at", "resolved_by")


def _purchase_confirm_alerts(t: TradeData) -> DataFrame:
    confirmed = changes.purchases_confirmed(_purchase_changes(t))
    lines = changes.lines_of(t.purchase_line, confirmed, "purchase_invoice_id")
    return _resolved(changes.resolve_by_purchase(_earlier_alerts(t), lines, _now()))


def _sale_alerts(t: TradeData, once: bool = False) -> DataFrame:
    confirmed = changes.sales_confirmed(_sales_changes(t))
    return changes.alerts_of_sales(
        confirmed, t.sales_line, t.inventory_movement, t.product, _earlier_alerts(t) if once else None
    )


def _deactivated(t: TradeData) -> DataFrame:
    gone = t.product.filter("is_active").join(t.product_changes.filter("NOT new_active"), "id", "left_semi")
    return _resolved(
        audit.resolve_on_deactivation(_earlier_alerts(t), gone.select(F.col("id").alias("product_id")), _now())
    )


def _active_timeline(t: TradeData) -> audit.StockTimeline:
    return audit.StockTimeline(t.inventory_movement, t.product)


ALERT_COLUMNS = [
    "product_id",
    "warehouse_id",
    "current_stock",
    "min_stock_level",
    "alert_date",
    "is_resolved",
    "resolved_at",
]


# Parts that the stored events are replayed in.
REPLAYED = 3


def _replay(t: TradeData, feed: Callable[[DataFrame], DataFrame], start: Callable[[DataFrame], DataStreamWriter]) -> None:
    """The stored events as they arrive: part by part of the time, the stream taking each part up where it left off.

    Events without a time come first. A part has as many files as Spark writes.
    """
    events = t.base("events")
    cuts = events.agg(F.percentile_approx("ts", [i / REPLAYED for i in range(1, REPLAYED)], 10000)).first()[0] or []
    folder = new_folder(t.spark, "events")
    for low, high in zip([None, *cuts], [*cuts, None]):
        from_low = F.lit(True) if low is None else F.col("ts") > F.lit(low)
        to_high = F.lit(True) if high is None else F.col("ts") <= F.lit(high)
        timed = F.coalesce(from_low & to_high, F.lit(low is None))
        events.filter(timed).write.mode("append").parquet(folder)
        run_to_end(start(feed(t.spark.readStream.schema(SCHEMAS["events"]).parquet(folder))))


def _stock_stream(t: TradeData) -> DataFrame:
    users = t.base("events").select(F.col("user_id").alias("id")).distinct()
    product = users.select(
        "id", (F.col("id") % 40).cast("decimal(12,2)").alias("min_stock_level"), F.lit(True).alias("is_active")
    )
    stream = StockStream(t.spark, new_folder(t.spark, "stock-stream"), stage(product, "levels"))
    _replay(t, movements_of_events, stream.start)
    return stream.alerts()


def _price_stream(t: TradeData) -> DataFrame:
    stream = PriceStream(t.spark, new_folder(t.spark, "price-stream"))
    _replay(t, prices_of_events, stream.start)
    return stream.audited()


JOBS: dict[str, Query] = {
    # Table changes
    "append_rows": over(_append),
    "movements_from_confirmed_purchases": over(_confirmed_purchase_movements),
    "movements_from_confirmed_sales": over(
        lambda t: changes.movements_of_sales(_confirmed(t.sales_invoice), t.sales_line)
    ),
    "apply_updates": over(_apply_updates),
    "refresh_last_purchase_price": over(lambda t: _refreshed(t).drop("supplier_sku", "is_preferred")),
    "upsert_product_supplier": over(_upserted_offers),
    "upsert_alerts": over(_upserted_alerts),
    "delete_where": over(_deleted),
    "cancel_sales": over(
        lambda t: changes.drop_cancelled_movements(t.inventory_movement, _cancelled(t)).drop("seq", "created_at")
    ),
    "cancel_sales_alerts": over(
        lambda t: changes.drop_cancelled_alerts(t.low_stock_alerts, _cancelled(t), t.sales_items).select(
            "product_id", "warehouse_id", "current_stock", "is_resolved"
        )
    ),
    "assign_ids": over(_ids),
    "line_totals": over(_line_totals),
    "invoice_totals": over(
        lambda t: changes.invoice_totals(
            t.purchase_invoice, t.purchase_items, "purchase_invoice_id"
        ).select("id", "invoice_no", "total_amount")
    ),
    "cascade_delete": over(
        lambda t: changes.delete_parents(
            t.product_supplier, t.product.filter("NOT is_active"), "product_id", "CASCADE"
        ).select(*changes.OFFER, "last_purchase_price")
    ),
    "set_null_delete": over(
        lambda t: changes.delete_parents(
            t.product, t.category.filter(F.col("id") == "Brand#2"), "category_id", "SET NULL"
        ).select("id", "sku", "category_id")
    ),
    "restrict_delete": over(
        lambda t: changes.delete_parents(
            t.purchase_invoice, t.supplier.filter("NOT is_active"), "supplier_id", "RESTRICT"
        ).select("id", "name")
    ),
    # Stock functions
    "current_stock": over(_stock_of),
    "check_availability": over(_availability),
    "warehouse_total_value": over(lambda t: ledger.warehouse_value(t.inventory_movement, t.product, t.warehouse)),
    # Commands
    "process_sales": over(_sale_outcome),
    "process_sales_alerts": over(lambda t: commands.SaleBatch(_sales(t)).alerts()),
    "process_sales_documents": over(
        lambda t: commands.SaleBatch(_sales(t)).invoices().select("invoice_no", "total_amount", "status")
    ),
    "process_sales_lines": over(lambda t: commands.SaleBatch(_sales(t)).lines()),
    "process_sales_movements": over(lambda t: commands.SaleBatch(_sales(t)).movements().drop("seq")),
    "safe_decrease_stock": over(_safe_decrease),
    "add_purchase_lines": over(_added_lines),
    "add_purchase_lines_v4": over(_added_lines, lines_only=True),
    "add_purchase_lines_movements": over(lambda t: _received(t).movements()),
    "add_purchase_lines_prices": over(
        lambda t: _received(t).prices(t.product_supplier, t.purchase_invoice).select(
            *changes.OFFER, "last_purchase_price"
        )
    ),
    "add_purchase_lines_totals": over(
        lambda t: _received(t).totals(t.purchase_invoice, t.purchase_items).select("id", "total_amount")
    ),
    "add_purchase_lines_alerts": over(lambda t: _resolved(_received(t).alerts(_earlier_alerts(t), _now()))),
    "adjust_inventory": over(_adjust_outcome),
    "adjust_inventory_closed_alerts": over(_adjust_closed),
    "adjust_inventory_alerts": over(lambda t: commands.adjustment_alerts(_adjusted(t))),
    "adjust_inventory_v4": over(_adjust_outcome, active_only=True),
    "adjust_inventory_v4_alerts": over(_strict_adjust_alerts),
    "confirm_purchases": over(lambda t: _confirmations(t).select("id", "reason")),
    "confirm_purchases_movements": over(_confirmation_movements),
    # Rules
    "validate_purchase_lines": over(_checked_purchase_lines),
    "validate_sales_lines": over(_checked_sales_lines),
    "validate_sales_lines_v4": over(_checked_sales_lines, drafts_only=True),
    "validate_purchase_status": over(lambda t: _purchase_changes(t).drop("invoice_no")),
    "validate_sales_confirm": over(lambda t: _sales_changes(t).drop("invoice_no", "customer_name")),
    "validate_sales_confirm_v4": over(
        lambda t: rules.validate_sales_confirm(t.sales_status_changes).drop("invoice_no", "customer_name")
    ),
    "validate_product_updates": over(_checked_products),
    "validate_movements": over(_checked_movements),
    "validate_movements_v4": over(_checked_movements, strict=True),
    "validate_purchase_line_deletes": over(
        lambda t: _checked_deletes(t.purchase_items, t.purchase_invoice, "purchase_invoice_id")
    ),
    "validate_sales_line_deletes": over(lambda t: _checked_deletes(t.sales_items, t.sales_invoice, "sales_invoice_id")),
    "constraint_checks": over(_constraints),
    # Effects of status changes
    "purchase_confirm_movements": over(
        lambda t: changes.movements_of_purchases(
            changes.purchases_confirmed(_purchase_changes(t)), t.purchase_line, t.supplier
        )
    ),
    "purchase_confirm_prices": over(_confirmed_prices),
    "purchase_confirm_alerts": over(_purchase_confirm_alerts),
    "sales_confirm_movements": over(
        lambda t: changes.movements_of_sales(changes.sales_confirmed(_sales_changes(t)), t.sales_line)
    ),
    "sales_confirm_alerts": over(_sale_alerts),
    "sales_confirm_alerts_v4": over(_sale_alerts, once=True),
    # Alerts and audits
    "low_stock_alerts": over(lambda t: _active_timeline(t).alerts().select(*ALERT_COLUMNS)),
    "alert_episodes": over(lambda t: _active_timeline(t).episodes()),
    "price_audit": over(lambda t: audit.price_audit(t.product, t.product_changes)),
    "price_audit_signed": over(
        lambda t: audit.signed(audit.price_audit(t.product, t.product_changes), "purchasing", "Price update")
    ),
    "supplier_price_audit": over(lambda t: audit.supplier_price_audit(t.product_supplier, _refreshed(t))),
    "resolve_on_deactivation": over(_deactivated),
    # Streams
    "stream_stock_and_alerts": over(_stock_stream),
    "stream_price_audit": over(_price_stream),
}

INTEGRITY: dict[str, Query] = {name: over(build) for name, build in integrity.BUILDERS.items()}

QUERIES: dict[str, Query] = {**REPORTS, **JOBS, **INTEGRITY}
_SQL = {**REPORT_ORACLES, **RULE_ORACLES, **integrity.SQL}
_SQL |= {name: _SQL[same] for name, same in integrity.SAME_AS.items()}
ORACLES: dict[str, str] = {name: MODEL + sql for name, sql in _SQL.items()}
