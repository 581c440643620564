"""Streams over several micro-batches give what the batch operators give on everything at once."""

import pytest
from pyspark.sql import functions as F

from stockwright.operators.audit import StockTimeline, price_history_audit
from stockwright.plans.catalog import ALERT_COLUMNS, QUERIES
from stockwright.sources.tables import SCHEMAS, read_table
from stockwright.sources.trade import movements_of_events, prices_of_events
from stockwright.streaming.jobs import PriceStream, StockStream, run_to_end

EVENTS = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def events(spark):
    return read_table(spark, EVENTS, "events").cache()


@pytest.fixture(scope="module")
def product(events):
    users = events.select(F.col("user_id").alias("id")).distinct()
    return users.select(
        "id", (F.col("id") % 40).cast("decimal(12,2)").alias("min_stock_level"), (F.col("id") % 5 != 0).alias("is_active")
    ).cache()


@pytest.fixture(scope="module")
def feed(spark, events, tmp_path_factory):
    """The events as five files, one per slice of time, in order of arrival."""
    folder = str(tmp_path_factory.mktemp("feed"))
    bounds = events.approxQuantile("event_id", [0.0, 0.2, 0.4, 0.6, 0.8, 1.0], 0.0)
    for n, (low, high) in enumerate(zip(bounds, bounds[1:])):
        part = events.filter((F.col("event_id") >= low) & ((F.col("event_id") < high) | (F.lit(n == 4))))
        part.coalesce(1).write.mode("append").parquet(folder)
    return folder


def stream_of(spark, folder):
    return (
        spark.readStream.schema(SCHEMAS["events"]).option("maxFilesPerTrigger", 1).parquet(folder)
    )


def bag(df):
    return sorted(map(repr, df.collect()))


def test_slices_arrive_in_time_order(events):
    assert events.orderBy("event_id").select("ts").collect() == events.orderBy("ts").select("ts").collect()


PRICE_COLUMNS = ["product_id", "changed_at", "old_price", "new_price", "change_percent", "out_of_range"]


def state_of(spark, stream, name):
    """The values Spark's state store holds."""
    reader = spark.read.format("statestore").option("stateVarName", name)
    return reader.load(f"{stream.folder}/progress").select("key.*", "value.*")


def test_stock_stream_equals_batch(spark, events, product, feed, tmp_path):
    stream = StockStream(spark, str(tmp_path / "out"), product)
    run_to_end(stream.start(movements_of_events(stream_of(spark, feed))))
    batch = StockTimeline(movements_of_events(events), product).alerts()
    assert bag(stream.alerts().select(*ALERT_COLUMNS)) == bag(batch.select(*ALERT_COLUMNS))
    moved = movements_of_events(events).groupBy("product_id").agg(
        F.sum(F.when(F.col("movement_type") == "OUT", -F.col("qty")).otherwise(F.col("qty"))).alias("stock")
    )
    kept = {row.product_id: row.stock for row in state_of(spark, stream, "cell").collect()}
    assert kept == {row.product_id: int(row.stock * 100) for row in moved.collect()}


def test_price_stream_equals_batch(spark, events, feed, tmp_path):
    stream = PriceStream(spark, str(tmp_path / "out"))
    run_to_end(stream.start(prices_of_events(stream_of(spark, feed))))
    batch = price_history_audit(prices_of_events(events))
    assert bag(stream.audited().select(*PRICE_COLUMNS)) == bag(batch.select(*PRICE_COLUMNS))


def test_restarted_stream_goes_on(spark, events, product, tmp_path):
    """A stream that stops after each delivery, taken up by new objects: state and results are those of one run."""
    folder, out = str(tmp_path / "feed"), str(tmp_path / "out")
    for low in range(0, 1000, 250):
        part = events.filter((F.col("event_id") >= low) & ((F.col("event_id") < low + 250) | F.lit(low == 750)))
        part.repartition(3).write.mode("append").parquet(folder)
        source = spark.readStream.schema(SCHEMAS["events"]).parquet(folder)
        run_to_end(StockStream(spark, f"{out}/stock", product).start(movements_of_events(source)))
        run_to_end(PriceStream(spark, f"{out}/price").start(prices_of_events(source)))
    # Nothing new: nothing is given twice.
    run_to_end(StockStream(spark, f"{out}/stock", product).start(movements_of_events(source)))
    alerts = StockTimeline(movements_of_events(events), product).alerts()
    assert bag(StockStream(spark, f"{out}/stock", product).alerts().select(*ALERT_COLUMNS)) == bag(alerts.select(*ALERT_COLUMNS))
    audited = price_history_audit(prices_of_events(events)).select(*PRICE_COLUMNS)
    assert bag(PriceStream(spark, f"{out}/price").audited().select(*PRICE_COLUMNS)) == bag(audited)


def test_replayed_batch_changes_nothing(spark, events, product, feed, tmp_path):
    """A batch whose commit was lost runs again from the state before it; its rows are not doubled."""
    stream = StockStream(spark, str(tmp_path / "out"), product)
    run_to_end(stream.start(movements_of_events(stream_of(spark, feed))))
    once = bag(stream.alerts())
    for name in ("4", ".4.crc"):
        (tmp_path / "out" / "progress" / "commits" / name).unlink()
    run_to_end(stream.start(movements_of_events(stream_of(spark, feed))))
    assert bag(stream.alerts()) == once


def test_nothing_arrived(spark, product, tmp_path):
    assert StockStream(spark, str(tmp_path / "stock"), product).alerts().count() == 0
    assert PriceStream(spark, str(tmp_path / "price")).audited().count() == 0


def test_unknown_levels_and_products(spark, tmp_path):
    """No minimum: never low. Inactive: no alerts. Without a product: no row. A quantity of nothing moves nothing."""
    product = spark.createDataFrame(
        [(1, None, True), (2, 5, False), (3, 5, True), (4, 5, None)], "id long, min_stock_level int, is_active boolean"
    ).withColumn("min_stock_level", F.col("min_stock_level").cast("decimal(12,2)"))
    rows = [(c, 1, k, q, n) for n, (k, q) in enumerate([("IN", 9), ("OUT", 6), ("IN", None), (None, 3), ("ADJUST", 4)]) for c in range(1, 6)]
    frame = spark.createDataFrame(rows, "product_id long, warehouse_id long, movement_type string, qty int, seq long")
    frame = frame.withColumn("qty", F.col("qty").cast("decimal(12,2)")).withColumn("created_at", F.expr("timestamp_ntz'2001-01-01' + make_dt_interval(0, 0, 0, seq)"))
    frame.write.parquet(str(tmp_path / "feed"))
    stream = StockStream(spark, str(tmp_path / "out"), product)
    run_to_end(stream.start(spark.readStream.schema(frame.schema).parquet(str(tmp_path / "feed"))))
    batch = StockTimeline(frame, product).alerts()
    got = bag(stream.alerts().select(*ALERT_COLUMNS))
    assert got == bag(batch.select(*ALERT_COLUMNS)) and len(got) == 3


def test_events_without_a_time_arrive(spark, events, tmp_path):
    folder = str(tmp_path)
    odd = events.withColumn("ts", F.when(F.col("event_id") % 5 != 0, F.col("ts")))
    odd.write.parquet(f"{folder}/events.parquet")
    users = events.select(F.col("user_id").alias("id")).distinct()
    product = users.select("id", (F.col("id") % 40).cast("decimal(12,2)").alias("min_stock_level"), F.lit(True).alias("is_active"))
    batch = StockTimeline(movements_of_events(odd), product).alerts()
    got = QUERIES["stream_stock_and_alerts"](spark, folder)
    names = ["product_id", "current_stock", "alert_date", "resolved_at"]

    def plain(df):
        texts = [F.col("current_stock").cast("double"), F.col("alert_date").cast("string"), F.col("resolved_at").cast("string")]
        return bag(df.select("product_id", *texts).toDF(*names))

    assert plain(got) == plain(batch)
    assert got.filter("alert_date IS NULL").count() > 0
    audited = price_history_audit(prices_of_events(odd)).select(F.col("product_id"), F.col("changed_at").cast("string"))
    assert bag(QUERIES["stream_price_audit"](spark, folder).select("product_id", "changed_at")) == bag(audited.toDF("product_id", "changed_at"))
