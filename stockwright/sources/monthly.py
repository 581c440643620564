"""A table of dated rows laid out by month, so that a range of dates reads the folders of its months only."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockwright.sources.tables import stage

MONTH = "month"  # first day of the month; also the name of the folders


class MonthlyTable:
    """Rows in folders by the month of the date or time column ``at``; rows without one have a folder of their own.

    Rows are range-partitioned by time before they are written, so a month has as many files as it has data, each for a
    stretch of time, and a month that holds most rows is written by many tasks. Late rows are added to their months as
    further files; ``rewrite`` merges a month's files when there are many.
    """

    def __init__(self, spark: SparkSession, path: str, at: str):
        self.spark, self.path, self.at = spark, path, at

    def append(self, rows: DataFrame) -> None:
        """Adds rows; the first call makes the table."""
        self._write(rows, "append")

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path).drop(MONTH)

    def between(self, first: date, last: date) -> DataFrame:
        """Rows of the days ``first`` to ``last``, both included; only folders of their months are listed for reading."""
        rows = self.spark.read.parquet(self.path)
        months = F.col(MONTH).between(F.lit(first.replace(day=1)), F.lit(last.replace(day=1)))
        day = F.col(self.at)
        return rows.filter(months & (day >= F.lit(first)) & (day < F.date_add(F.lit(last), 1))).drop(MONTH)

    def rewrite(self, first: date, last: date) -> None:
        """Writes the months that hold ``first`` to ``last`` anew, sorted and in few files; other months stay."""
        rows = self.spark.read.parquet(self.path)
        months = F.col(MONTH).between(F.lit(first.replace(day=1)), F.lit(last.replace(day=1)))
        # Spark does not overwrite what it reads in the same job, so the rows go through a folder of their own.
        self._write(stage(rows.filter(months).drop(MONTH), "months"), "overwrite")

    def _write(self, rows: DataFrame, mode: str) -> None:
        month: Column = F.trunc(F.to_date(self.at), "month")
        placed = rows.withColumn(MONTH, month)
        placed = placed.repartitionByRange(MONTH, self.at).sortWithinPartitions(MONTH, self.at)
        placed.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(self.path)
