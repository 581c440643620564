"""The routines called from SQL: values, errors, and plans that are joins over the whole argument set."""

import pytest

from stockwright.plans.sql_functions import called, register_functions, requested_cells
from stockwright.sources.trade import TradeData


@pytest.fixture(scope="module")
def trade(spark):
    t = TradeData(spark, "/root/testdata/sf0.001")
    register_functions(t)
    return t


def test_single_calls(spark, trade):
    stock = {(r.product_id, r.warehouse_id): r.stock for r in spark.table("trade_stock").collect()}
    (cell, most) = max(stock.items(), key=lambda x: x[1])
    query = "SELECT GetCurrentStock({0}, {1}) AS s, CheckProductAvailability({0}, {1}, {2}) AS a, CheckProductAvailability({0}, {1}, {3}) AS b"
    row = spark.sql(query.format(*cell, most, most + 1)).first()
    assert (row.s, row.a, row.b) == (most, True, False)
    assert spark.sql("SELECT CheckProductAvailability(1, 1, NULL) AS a").first().a is False


@pytest.mark.parametrize(
    "call, text",
    [
        ("SELECT GetCurrentStock(999999, 1)", "Product not found"),
        ("SELECT GetCurrentStock(1, 99)", "Warehouse not found"),
        ("SELECT GetCurrentStock(NULL, 1)", "Product not found"),
        ("SELECT GetWarehouseTotalValue(99)", "Warehouse not found"),
        ("SELECT * FROM GetProductStockReport(99, NULL, FALSE)", "Warehouse not found"),
        ("SELECT * FROM GetSupplierReport(99999)", "Supplier not found"),
    ],
)
def test_unknown_arguments(spark, trade, call, text):
    with pytest.raises(Exception, match=text):
        spark.sql(call).collect()


def test_calls_over_a_table_are_joins(spark, trade):
    """However many rows call it, a function reads its tables once; nothing runs row by row in Python."""
    requested_cells(trade)
    rows = called(trade, "SELECT product_id, GetCurrentStock(product_id, warehouse_id) AS stock FROM trade_cells")
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    ledger = [line for line in plan.splitlines() if "FileScan" in line and "l_quantity" in line]
    assert len(ledger) == 1
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan


def test_table_functions_take_arguments(spark, trade):
    of_brand = spark.sql("SELECT * FROM GetProductStockReport(1, 'Brand#2', FALSE)").collect()
    assert of_brand and {r.category_name for r in of_brand} == {"Brand#2"}
    low = spark.sql("SELECT * FROM GetProductStockReport(1, NULL, TRUE)").collect()
    assert {r.stock_status for r in low} == {"LOW"}
    assert [r.supplier_id for r in spark.sql("SELECT * FROM GetSupplierReport(2)").collect()] == [2]
    assert spark.sql("SELECT * FROM GetSupplierReport(NULL)").count() == trade.supplier.count()
