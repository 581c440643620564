"""Every registered query against its SQL, and the shape of its plan."""

import re

import pytest

from stockwright.plans.catalog import ORACLES, QUERIES, REPORTS
from stockwright.plans.reports import register_views
from stockwright.sources import tables
from stockwright.sources.trade import AS_OF, TradeData
from tests.checking import compare, oracle_connection

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SMALL)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    df = QUERIES[name](spark, SMALL)
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan(df))
    assert compare(df, connection, ORACLES[name]) is None


def test_filters_and_columns_reach_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    text = QUERIES["purchases_by_supplier"](spark, SMALL)._jdf.queryExecution().toString()
    lines = [line for line in text.splitlines() if "FileScan" in line and "lineitem" in line]
    assert lines
    for line in lines:
        assert "EqualTo(l_returnflag,N)" in line
        schema = re.search(r"ReadSchema: struct<([^>]*)>", line).group(1)
        assert {column.split(":")[0] for column in schema.split(",")} <= {
            "l_orderkey",
            "l_suppkey",
            "l_quantity",
            "l_extendedprice",
            "l_returnflag",
        }


@pytest.mark.parametrize("name", ["last_movements", "recent_confirmed_sales", "top_products_by_sales", "markup_top"])
def test_top_lists_sort_no_whole_table(spark, name):
    assert "TakeOrderedAndProject" in plan(REPORTS[name](spark, SMALL))


def test_views_answer_sql(spark):
    t = TradeData(spark, SMALL)
    register_views(t, AS_OF)
    assert spark.sql("SELECT * FROM top_products_by_sales").count() == 10
    assert spark.sql("SELECT SUM(product_count) FROM category_summary").first()[0] >= t.product.count()
    assert spark.sql("SELECT name, total_in FROM warehouse_activity_last_month").columns == ["name", "total_in"]


@pytest.fixture(scope="module")
def hot(tmp_path_factory):
    """The small tables with a third of all ledger rows on one product of one supplier."""
    folder = str(tmp_path_factory.mktemp("hot"))
    source = oracle_connection(SMALL)
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "events"):
        source.execute(f"COPY {name} TO '{folder}/{name}.parquet'")
    source.execute(
        f"""COPY (SELECT * REPLACE (CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_partkey END AS l_partkey,
        CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_suppkey END AS l_suppkey) FROM lineitem)
        TO '{folder}/lineitem.parquet'"""
    )
    return folder


@pytest.mark.parametrize(
    "name",
    [
        "low_stock_alerts",
        "alert_episodes",
        "process_sales",
        "safe_decrease_stock",
        "add_purchase_lines",
        "adjust_inventory",
        "validate_movements",
        "assign_ids",
        "product_ranking",
        "sales_with_warehouse",
        "category_summary",
        "stream_stock_and_alerts",
    ],
)
def test_hot_product(spark, hot, name):
    assert compare(QUERIES[name](spark, hot), oracle_connection(hot), ORACLES[name]) is None


def test_received_prices_stage_their_lines_once(spark, tmp_path):
    """The outcome is read once, so only the requests in their order are written."""
    for name, schema in tables.SCHEMAS.items():
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    with tables.recorded_stages() as staged:
        assert QUERIES["add_purchase_lines_prices"](spark, str(tmp_path)).count() == 0
    assert [path.rsplit("/", 1)[1].split("-")[0] for path in staged] == ["chunks"]
