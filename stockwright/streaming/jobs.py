"""Structured Streaming jobs: stock with low-stock alerts, and price audit.

What has to be remembered between micro-batches (stock and open low period of a cell, last price of a product) is keyed
state of Spark's own: a value per key in the RocksDB state store, which Spark partitions, snapshots and restores. Results
leave through the file sink, which lists each batch's files once, so a restarted stream gives every row once. Rows are
ordered within a micro-batch; across batches the order of arrival counts. A task holds one key's rows of one
micro-batch, which the source's limits (``maxFilesPerTrigger``, ``maxBytesPerTrigger``) bound.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle

from stockwright.functions.expressions import BALANCE, MONEY, cents, from_cents, signed_qty
from stockwright.operators.audit import audit_rows
from stockwright.operators.ledger import CELL

_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

RAISED, RECOVERED = "raised", "recovered"

ALERT = Row("kind", *CELL, "period", "stock", "minimum", "created_at")
STEP = Row("product_id", "changed_at", "old_price", "new_price")


def _in_order(rows: Iterator[Row]) -> list[Row]:
    """Rows by ``seq``, which is a value or a struct of values; unknown ones first."""

    def key(row: Row) -> list[tuple]:
        parts = row.seq.values() if isinstance(row.seq, dict) else (row.seq,)
        return [(part is not None, part) for part in parts]

    return sorted(rows, key=key)


class StockCell(StatefulProcessor):
    """Stock of a cell in cents, the number of its low period, and whether that has begun.

    Each movement that leaves the cell low is an alert of the period. The first one after it that does not ends the
    period.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.cell = handle.getValueState("cell", "stock bigint, period bigint, is_open boolean")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        stock, period, is_open = self.cell.get() if self.cell.exists() else (0, 0, False)
        for row in _in_order(rows):
            stock += row.delta or 0
            low = row.minimum is not None and stock <= row.minimum
            if low and row.is_active:
                is_open = True
                yield ALERT(RAISED, *key, period, stock, row.minimum, row.created_at)
            elif not low and row.is_active and is_open:
                yield ALERT(RECOVERED, *key, period, None, None, row.created_at)
                period, is_open = period + 1, False
        self.cell.update((stock, period, is_open))

    def close(self) -> None:
        pass


class LastPrice(StatefulProcessor):
    """Price of a product before each quotation; none before the first."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", f"price {MONEY}")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        old = self.last.get()[0] if self.last.exists() else None
        for row in _in_order(rows):
            yield STEP(*key, row.changed_at, old, row.price)
            old = row.price
        self.last.update((old,))

    def close(self) -> None:
        pass


class _Job:
    """A stream into files: ``folder`` holds its progress, its state and its results."""

    schema: str

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _writer(self, results: DataFrame) -> DataStreamWriter:
        self.spark.conf.set(_STORE, _ROCKSDB)
        return (
            results.writeStream.format("parquet")
            .option("path", f"{self.folder}/results")
            .option("checkpointLocation", f"{self.folder}/progress")
        )

    def _results(self) -> DataFrame:
        path = f"{self.folder}/results"
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        if not hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(path)


class StockStream(_Job):
    """Keeps the stock per cell and raises and closes alerts as movements arrive.

    Alerts belong to a numbered low period of their cell; the movement that ends it logs the time. ``alerts()`` joins the
    two. ``product`` has (id, min_stock_level, is_active) and is read anew with every micro-batch.
    """

    schema = (
        "kind string, product_id bigint, warehouse_id bigint, period bigint, stock bigint, minimum bigint, "
        "created_at timestamp_ntz"
    )

    def __init__(self, spark: SparkSession, folder: str, product: DataFrame):
        super().__init__(spark, folder)
        self.product = product

    def start(self, movement: DataFrame) -> DataStreamWriter:
        levels = self.product.select(
            F.col("id").alias("product_id"), cents("min_stock_level").alias("minimum"), "is_active"
        )
        moves = movement.select(*CELL, "created_at", "seq", cents(signed_qty()).alias("delta"))
        found = (
            moves.join(levels, "product_id")
            .groupBy(*CELL)
            .transformWithState(StockCell(), self.schema, outputMode="Append", timeMode="None")
        )
        return self._writer(found)

    def alerts(self) -> DataFrame:
        """All alerts so far, closed as far as a recovery was seen."""
        rows = self._results()
        ended = rows.filter(F.col("kind") == RECOVERED).select(*CELL, "period", F.col("created_at").alias("resolved_at"))
        raised = rows.filter(F.col("kind") == RAISED).join(ended, [*CELL, "period"], "left")
        return raised.select(
            *CELL,
            from_cents("stock", BALANCE).alias("current_stock"),
            from_cents("minimum", MONEY).alias("min_stock_level"),
            F.col("created_at").alias("alert_date"),
            F.col("resolved_at").isNotNull().alias("is_resolved"),
            "resolved_at",
        )


class PriceStream(_Job):
    """Audits price changes as quotations arrive."""

    schema = f"product_id bigint, changed_at timestamp_ntz, old_price {MONEY}, new_price {MONEY}"

    def start(self, prices: DataFrame) -> DataStreamWriter:
        steps = (
            prices.select("product_id", "price", "changed_at", "seq")
            .groupBy("product_id")
            .transformWithState(LastPrice(), self.schema, outputMode="Append", timeMode="None")
        )
        # What changed is a filter on each step; it runs in the same job.
        return self._writer(steps)

    def audited(self) -> DataFrame:
        return audit_rows(self._results(), "product_id", "changed_at")


def run_to_end(writer: DataStreamWriter) -> None:
    """Processes everything that is there and stops."""
    writer.trigger(availableNow=True).start().awaitTermination()
