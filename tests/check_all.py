"""Command line: check the named queries (default all) against their SQL and print the differences."""

import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, ".")
from stockwright.plans.catalog import ORACLES, QUERIES  # noqa: E402
from tests.checking import DATA, compare, oracle_connection  # noqa: E402


def main() -> None:
    wanted = sys.argv[1:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection()
    bad = 0
    for name in wanted:
        start = time.time()
        try:
            df = QUERIES[name](spark, DATA)
            problem = compare(df, connection, ORACLES[name]) if name in ORACLES else f"no oracle, rows {df.count()}"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{len(wanted) - bad} of {len(wanted)} agree")


if __name__ == "__main__":
    main()
