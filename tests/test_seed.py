"""Results known by hand on the two small data sets."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stockwright.operators import audit, changes, commands, ledger, rules
from stockwright.plans import reports as R
from tests import seed


@pytest.fixture(scope="module")
def first(spark):
    return seed.first_version(spark)


@pytest.fixture(scope="module")
def second(spark):
    return seed.second_version(spark)


def rows(df, *columns):
    return [tuple(row) for row in (df.select(*columns) if columns else df).collect()]


def stock(movement, product, warehouse):
    cell = ledger.current_stock(movement).filter(f"product_id = {product} AND warehouse_id = {warehouse}").first()
    return int(cell["stock"]) if cell else 0


# First version: reports after the changes


def test_purchases_by_supplier(first):
    assert rows(R.purchases_by_supplier(first)) == [("Supplier 1", 65000), ("Supplier 2", 2000)]


def test_supplier_purchase_counts_are_lines(first):
    assert rows(R.supplier_purchase_counts(first), "supplier", "invoice_count") == [
        ("Supplier 1", 2),
        ("Supplier 2", 1),
    ]


def test_average_price_having(first):
    assert rows(R.avg_price_by_category_having(first)) == [("Category 2", 55000.0)]


def test_movement_stats(first):
    found = {row[0]: row[1:] for row in rows(R.movement_stats_by_warehouse(first), "warehouse", "movement_count", "min_qty", "max_qty")}
    assert found == {"Warehouse 1": (5, -1, 1), "Warehouse 2": (2, -1, 1)}


def test_sales_totals(first):
    assert rows(R.sales_line_totals(first)) == [(3, 3)]
    assert rows(R.sales_by_customer_having(first)) == [("Customer 1", 52000)]


def test_products_without_supplier_get_the_default(first):
    assert ("Product 4", "Нет поставщика") in rows(
        R.products_with_supplier_or_default(first), "product", "supplier"
    )


def test_suppliers_without_products_stay(first):
    assert ("Supplier 3", None) in rows(R.suppliers_with_products(first), "supplier", "product")


def test_category_summary_keeps_categories_without_sales(first):
    found = {row[0]: row[1:] for row in rows(R.category_summary(first), "name", "product_count", "avg_price", "total_sales")}
    assert found["Category 1"] == (2, 9000.0, 3000)
    assert found["Category 2"] == (1, 55000.0, 50000)


def test_warehouse_activity_with_negative_out(first, spark):
    activity = R.warehouse_activity_last_month(first, date(2025, 2, 1), out_is_negative=True)
    assert set(rows(activity, "name", "total_in", "total_out")) == {("Warehouse 1", 3, 2), ("Warehouse 2", 1, 1)}
    assert rows(R.warehouse_activity_last_month(first, date(2025, 3, 1), True)) == []


def test_stock_grid_adds_negative_out(first):
    # OUT is stored negative here, and the grid turns its sign: sold pieces count as stock.
    found = set(rows(R.stock_grid_positive(first), "product", "stock"))
    assert found == {("Product 1", 2), ("Product 2", 2), ("Product 3", 3)}


# Second version: functions


def test_current_stock(second):
    assert [stock(second.inventory_movement, *cell) for cell in ((1, 1), (3, 1), (5, 1), (1, 2))] == [5, 10, 50, 0]


def test_unknown_cells_get_a_reason(second, spark):
    asked = spark.createDataFrame([(1, 1), (1, 3), (9999, 1), (1, 99), (None, 1)], "product_id bigint, warehouse_id bigint")
    found = ledger.stock_of(asked, second.inventory_movement, second.product, second.warehouse)
    assert set(rows(found, "product_id", "warehouse_id", "stock", "reason")) == {
        (1, 1, 5, None),
        (1, 3, 0, None),
        (9999, 1, None, "Product not found"),
        (1, 99, None, "Warehouse not found"),
        (None, 1, None, "Product not found"),
    }


def test_availability(second, spark):
    asked = spark.createDataFrame(
        [(1, 1, 2), (1, 1, 10), (3, 1, 10), (3, 2, 2)], "product_id bigint, warehouse_id bigint, required int"
    )
    found = ledger.availability(asked, second.inventory_movement, second.product, second.warehouse)
    assert set(rows(found, "product_id", "warehouse_id", "required", "available")) == {
        (1, 1, 2, True),
        (1, 1, 10, False),
        (3, 1, 10, True),
        (3, 2, 2, False),
    }


def test_warehouse_value(second):
    found = ledger.warehouse_value(second.inventory_movement, second.product, second.warehouse)
    assert dict(rows(found, "warehouse_id", "total_value")) == {1: 849000, 2: 165000, 3: 0}


def test_supplier_report(second):
    report = R.supplier_report(second, 1).first()
    assert (report.total_products, report.total_invoices, report.total_purchase_amount) == (6, 2, 0)
    assert report.avg_purchase_price == pytest.approx(26583.333333)
    assert (report.min_lead_time, report.max_lead_time) == (3, 7)
    nobody = R.supplier_report(second, 3).first()
    assert (nobody.total_products, nobody.total_invoices, nobody.avg_purchase_price) == (0, 0, 0)


def test_supplier_products_report(second):
    report = {row.sku: row for row in R.supplier_products_report(second, 1).collect()}
    assert len(report) == 6
    assert (report["P4"].purchase_count, report["P4"].total_purchased_qty) == (1, 5)
    error = R.supplier_products_report(second, 77).collect()
    assert [(row.sku, row.error) for row in error] == [(None, "Supplier not found")]


def test_stock_report(second):
    report = R.stock_report(second, 1)
    found = {row.sku: (row.current_stock, row.stock_status, row.availability) for row in report.collect()}
    assert found["P1"] == (5, "NORMAL", "AVAILABLE")
    assert found["P7"] == (0, "LOW", "OUT OF STOCK")
    assert [row.sku for row in R.stock_report(second, 1, low_only=True).collect()] == ["P7", "P8"]
    assert {row.stock_status for row in R.stock_report(second, 1, category_id=2).collect()} == {"NORMAL"}
    assert [row.stock_status for row in R.stock_report(second, 1, by_status_text=True).collect()][:2] == ["LOW", "LOW"]


def test_reports_on_unknown_ids_fail(second):
    with pytest.raises(ValueError, match="Warehouse not found"):
        R.stock_report(second, 99)
    with pytest.raises(ValueError, match="Supplier not found"):
        R.supplier_report(second, 99)


def test_ranking_without_sales_is_empty(second):
    assert rows(R.product_ranking(second)) == []


# Second version: scenarios


def sale(spark, second, product, qty, price, warehouse=1, number="SALE-9", **tables):
    asked = spark.createDataFrame(
        [(1, "Customer 9", number, product, warehouse, Decimal(qty), Decimal(price), "clerk")],
        "seq bigint, customer_name string, invoice_no string, product_id bigint, warehouse_id bigint, "
        "qty decimal(12,2), unit_price decimal(12,2), issued_by string",
    )
    return commands.SaleBatch(
        commands.process_sales(
            asked,
            tables.get("products", second.product),
            tables.get("warehouses", second.warehouse),
            ledger.current_stock(tables.get("movement", second.inventory_movement)),
            second.sales_invoice,
        )
    )


def reason(batch):
    return batch.outcome.first()["reason"]


def test_sale(second, spark):
    batch = sale(spark, second, 3, 2, 15500)
    assert rows(batch.invoices(), "total_amount", "status") == [(31000, "CONFIRMED")]
    assert rows(batch.lines(), "line_total") == [(31000,)]
    assert rows(batch.movements(), "movement_type", "qty") == [("OUT", 2)]
    assert rows(batch.outcome, "stock_after") == [(8,)]
    assert rows(batch.alerts()) == []


def test_refused_sales(second, spark):
    assert reason(sale(spark, second, 1, 100, 56000)) == "Insufficient stock"
    assert reason(sale(spark, second, 9999, 2, 100)) == "Product is not active"
    assert reason(sale(spark, second, 1, 0, 100)) == "Quantity must be greater than 0"
    assert reason(sale(spark, second, 1, 1, 0)) == "Price must be greater than 0"
    assert reason(sale(spark, second, 1, 1, 1, number="SALE-1")) == "Invoice number is taken"
    inactive = changes.apply_updates(
        second.product, spark.createDataFrame([(7, False)], "id bigint, active boolean"), "id", {"is_active": "active"}
    )
    assert reason(sale(spark, second, 7, 2, 4500, 2, products=inactive)) == "Product is not active"
    closed = changes.apply_updates(
        second.warehouse, spark.createDataFrame([(2, False)], "id bigint, active boolean"), "id", {"is_active": "active"}
    )
    assert reason(sale(spark, second, 7, 2, 4500, 2, warehouses=closed)) == "Warehouse is not active"


def added(spark, second, invoice, product, qty, price, warehouse):
    drafts = changes.append(
        second.purchase_invoice,
        spark.createDataFrame([(4, 1, "PUR-9", "DRAFT")], "id bigint, supplier_id bigint, invoice_no string, status string"),
    )
    asked = spark.createDataFrame(
        [(1, invoice, product, warehouse, Decimal(qty), Decimal(price))],
        "seq bigint, purchase_invoice_id bigint, product_id bigint, warehouse_id bigint, qty decimal(12,2), unit_price decimal(12,2)",
    )
    opening = ledger.current_stock(second.inventory_movement)
    return drafts, commands.add_purchase_lines(asked, drafts, second.product, second.warehouse, opening)


def test_purchase_line_and_confirmation(second, spark):
    drafts, outcome = added(spark, second, 4, 2, 3, 63000, 1)
    assert rows(outcome, "reason", "stock_after") == [(None, 6)]
    lines = outcome.withColumn("line_total", F.col("qty") * F.col("unit_price"))
    totals = changes.invoice_totals(drafts, lines, "purchase_invoice_id")
    assert rows(totals.filter("id = 4"), "total_amount") == [(189000,)]
    booked = changes.append(second.inventory_movement, commands.purchase_movements(outcome))
    assert stock(booked, 2, 1) == 6
    # Confirming books nothing again, as the line was received when it was added.
    confirmed = commands.confirm_purchases(spark.createDataFrame([(4,), (1,), (99,)], "id bigint"), drafts)
    assert dict(rows(confirmed, "id", "reason")) == {
        4: None,
        1: "Invoice is already confirmed",
        99: "Purchase invoice not found",
    }
    again = commands.confirmation_movements(confirmed, lines, second.supplier, booked)
    assert rows(again) == []
    fresh = commands.confirmation_movements(confirmed, lines, second.supplier, second.inventory_movement)
    assert rows(fresh, "product_id", "qty", "note") == [(2, 3, "Purchase from Supplier 1, invoice PUR-9")]
    offers = changes.upsert_product_supplier(second.product_supplier, drafts.filter("id = 4"), lines.withColumn("seq", F.lit(1)))
    assert rows(offers.filter("product_id = 2"), "last_purchase_price") == [(63000,)]


@pytest.mark.parametrize(
    ("request_", "expected"),
    [
        ((4, 2, -2, 63000, 1), "Quantity must be greater than 0"),
        ((4, 2, 2, 0, 1), "Price must be greater than 0"),
        ((77, 2, 2, 1, 1), "Purchase invoice not found"),
        ((4, 99, 2, 1, 1), "Product not found or not active"),
        ((4, 2, 2, 1, 9), "Warehouse not found or not active"),
        ((1, 2, 2, 1, 1), "Cannot add line to confirmed or cancelled invoice"),
        ((4, 2, 13, 1, 1), "Exceeds maximum stock level"),
        ((4, 2, 12, 1, 1), None),
        ((4, 2, 15, 1, 3), None),
        ((4, 2, 16, 1, 3), "Exceeds maximum stock level"),
    ],
)
def test_purchase_line_rules(second, spark, request_, expected):
    _, outcome = added(spark, second, *request_)
    assert rows(outcome, "reason") == [(expected,)]


def test_full_cycle(second, spark):
    drafts, outcome = added(spark, second, 4, 8, 10, 4200, 2)
    booked = changes.append(second.inventory_movement, commands.purchase_movements(outcome))
    batch = sale(spark, second, 8, 5, 4800, 2, movement=booked)
    assert stock(changes.append(booked, batch.movements().drop("related_id", "seq")), 8, 2) == 25


def adjusted(spark, second, qty, **options):
    asked = spark.createDataFrame(
        [(1, 5, 1, Decimal(qty))], "seq bigint, product_id bigint, warehouse_id bigint, qty decimal(12,2)"
    )
    opening = ledger.current_stock(second.inventory_movement)
    return commands.adjust_inventory(asked, second.product, second.warehouse, opening, **options)


def test_adjustments(second, spark):
    assert rows(adjusted(spark, second, -3), "reason", "stock_after") == [(None, 47)]
    assert rows(adjusted(spark, second, -100), "reason") == [("Would result in negative stock",)]
    assert rows(adjusted(spark, second, -100, active_only=True), "reason", "stock_after") == [(None, -50)]
    assert rows(commands.adjustment_alerts(adjusted(spark, second, -40))) == []
    assert rows(commands.adjustment_alerts(adjusted(spark, second, -40), inclusive=True)) == [(5, 1, 10, 10)]
    assert rows(commands.adjustment_alerts(adjusted(spark, second, -41))) == [(5, 1, 9, 10)]


def test_safe_decrease(spark):
    opening = spark.createDataFrame([(1, 1, Decimal(30))], "product_id bigint, warehouse_id bigint, stock decimal(12,2)")
    asked = spark.createDataFrame(
        [(1, 1, 1, Decimal(3)), (2, 1, 1, Decimal(25)), (3, 1, 1, Decimal(25)), (4, 1, 1, Decimal(2))],
        "seq bigint, product_id bigint, warehouse_id bigint, qty decimal(12,2)",
    )
    outcome = commands.safe_decrease_stock(asked, opening)
    assert sorted(rows(outcome, "seq", "reason", "stock_after")) == [
        (1, None, 27),
        (2, None, 2),
        (3, "Insufficient stock", None),
        (4, None, 0),
    ]


def test_price_rules_and_audit(second, spark):
    def change(price):
        asked = spark.createDataFrame(
            [(1, Decimal(price))], "id bigint, new_price decimal(12,2)"
        ).selectExpr("id", "new_price", "3BD as new_min", "20BD as new_max", "true as new_active")
        checked = rules.validate_product_updates(
            second.product, asked, second.purchase_items, second.purchase_invoice, second.sales_items, second.sales_invoice
        )
        return checked.first(), audit.price_audit(second.product, asked).collect()

    refused, _ = change(40000)
    assert (refused.reason, refused.reduction) == ("Cannot reduce price by more than 20%", Decimal("27.27"))
    accepted, log = change(53000)
    assert accepted.reason is None
    assert [(row.old_price, row.new_price, row.change_percent) for row in log] == [(55000, 53000, Decimal("-3.64"))]
    _, unchanged = change(55000)
    assert unchanged == []


def test_confirmed_documents_take_no_lines(second, spark):
    asked = spark.createDataFrame(
        [(1, 1, 1, Decimal(2), Decimal(52000))],
        "purchase_invoice_id bigint, product_id bigint, warehouse_id bigint, qty decimal(12,2), unit_price decimal(12,2)",
    )
    checked = rules.validate_purchase_lines(
        asked, second.purchase_invoice, second.product, second.warehouse, second.inventory_movement
    )
    assert rows(checked, "reason") == [("Cannot add line to confirmed or cancelled invoice",)]


def test_draft_sales_skip_the_stock_until_confirmed(second, spark):
    documents = spark.createDataFrame(
        [(10, "CONFIRMED", "CONFIRMED"), (11, "DRAFT", "CONFIRMED")], "id bigint, status string, new_status string"
    )
    lines = spark.createDataFrame(
        [(10, 1, 1, Decimal(1000), Decimal(56000)), (11, 1, 1, Decimal(1000), Decimal(56000))],
        "sales_invoice_id bigint, product_id bigint, warehouse_id bigint, qty decimal(12,2), unit_price decimal(12,2)",
    )
    checked = rules.validate_sales_lines(
        lines, documents, second.product, second.warehouse, second.inventory_movement
    )
    assert dict(rows(checked, "sales_invoice_id", "reason")) == {10: "Insufficient stock", 11: None}
    confirm = rules.validate_sales_confirm(documents, lines, second.inventory_movement)
    assert dict(rows(confirm, "id", "reason")) == {
        10: None,
        11: "Cannot confirm invoice: insufficient stock for some products",
    }


def test_low_stock_alert_and_recovery(second, spark):
    moves = changes.append(
        second.inventory_movement,
        seed.movements(spark, [(5, 1, "ADJUST", -3), (5, 1, "OUT", 45), (6, 1, "OUT", 35), (6, 1, "IN", 40)], first=9),
    )
    alerts = audit.StockTimeline(moves, second.product).alerts()
    found = {row.seq: (row.product_id, row.current_stock, row.is_resolved, row.resolved_by) for row in alerts.collect()}
    assert found[10] == (5, 2, False, None)
    assert found[11] == (6, 5, True, "Stock replenished")
    assert stock(moves, 6, 1) == 45


def test_movement_rules(second, spark):
    closed = changes.apply_updates(
        second.warehouse, spark.createDataFrame([(3, False)], "id bigint, active boolean"), "id", {"is_active": "active"}
    )
    inactive = changes.apply_updates(
        second.product, spark.createDataFrame([(7, False)], "id bigint, active boolean"), "id", {"is_active": "active"}
    )
    asked = seed.movements(
        spark,
        [
            (1, 1, "OUT", 6),
            (1, 1, "OUT", 5),
            (1, 1, "OUT", 1),
            (1, 1, "IN", 2),
            (1, 1, "ADJUST", -2),
            (1, 1, "ADJUST", -1),
            (7, 2, "IN", 1),
            (7, 2, "ADJUST", -1),
            (2, 3, "IN", 1),
            (99, 1, "IN", 1),
            (None, 1, "IN", 1),
            (2, None, "IN", 1),
            (2, 1, "MOVE", 1),
            (2, 1, "IN", None),
            (2, 1, "IN", -1),
        ],
    )
    opening = ledger.current_stock(second.inventory_movement)

    def checked(**options):
        outcome = commands.validate_movements(asked, inactive, closed, opening, **options)
        return [row.reason for row in outcome.orderBy("seq").collect()]

    plain = [
        "Insufficient stock",
        None,
        "Insufficient stock",
        None,
        None,
        "Would result in negative stock",
        "Cannot add movement for inactive product",
        None,
        "Cannot add movement to inactive warehouse",
        "Product not found",
        "Product not found",
        "Warehouse not found",
        None,
        "Quantity must be greater than 0",
        None,
    ]
    assert checked() == checked(chunks=6) == plain
    low = "Quantity must be greater than 0"
    assert checked(strict=True) == [
        *plain[:4], low, low, plain[6], plain[6], *plain[8:12], "Invalid movement type", low, low
    ]
