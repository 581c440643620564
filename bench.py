"""Times the headline queries, warm, and prints one JSON line.

Every query runs twice, from reading the files to the last row of its result; the second run counts.

BENCH_SF_DIR  folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_QUERIES comma-separated names, or "all" (default: the headline queries)
"""

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from stockwright.plans.catalog import QUERIES  # noqa: E402
from stockwright.sources.tables import drop_staged  # noqa: E402

HEADLINE = (
    "purchases_by_supplier",
    "purchases_by_supplier_product",
    "sales_by_month",
    "sales_by_customer_having",
    "top_products_by_sales",
    "top_customers_by_revenue",
    "category_summary",
    "monthly_sales_analysis",
    "movement_analysis",
    "movements_with_purchase_invoice",
    "purchase_detail",
    "sales_with_warehouse",
    "stock_grid_positive",
    "stock_report",
    "supplier_report",
    "markup_top",
    "trade_journal",
    "product_ranking",
    "check_availability",
    "warehouse_total_value",
    "process_sales",
    "add_purchase_lines",
    "adjust_inventory",
    "validate_movements",
    "validate_purchase_lines",
    "validate_product_updates",
    "cancel_sales",
    "upsert_product_supplier",
    "assign_ids",
    "low_stock_alerts",
    "alert_episodes",
    "price_audit",
    "stream_stock_and_alerts",
)


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    asked = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if asked == "all" else asked.split(",") if asked else list(HEADLINE)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        run(spark, name, directory)
        seconds[name] = run(spark, name, directory)
    drop_staged(spark)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": directory.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


def run(spark: SparkSession, name: str, directory: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, directory).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


if __name__ == "__main__":
    main()
