"""Running values, ids and ranks over a total order, without putting a group or the table in one task.

Rows are range-partitioned by (keys, order) into chunks, so a hot key spans as many chunks as its rows need. Within
a chunk a window does the work; what earlier (or later) chunks contribute to a key is carried over from a
summary. A chunk border cuts at most one key, so only the first and the last key of a chunk are summarised: two rows a chunk
is the proven bound of the broadcasts below. Spark chooses the number of chunks by the size of the
rows (adaptive coalescing of the range partitions).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockwright.sources.tables import stage

CHUNK = "_chunk"
ROW = "_row"  # place in the whole order, with gaps between chunks


class OrderedChunks:
    """Rows in the order (keys, order), cut into chunks. ``order`` must be unique within a key.

    ``chunks`` forces a number of chunks. ``within`` goes over the rows of each chunk in their order before they are
    written; it must keep their columns and their order. Without ``keep_order`` the rows lose the columns of ``order``, for
    callers that only need them to put the rows in order.
    """

    def __init__(
        self,
        rows: DataFrame,
        keys: list[str],
        order: list[str | Column],
        chunks: int | None = None,
        within: Callable[[DataFrame], DataFrame] | None = None,
        keep_order: bool = True,
    ):
        self.keys = keys
        by = [*[F.col(key) for key in keys], *[F.col(c) if isinstance(c, str) else c for c in order]]
        ranges = rows.repartitionByRange(*by) if chunks is None else rows.repartitionByRange(chunks, *by)
        # Numbers of partitions and rows are only stable once written. Later sorts compare one number, whatever the order is.
        numbered = ranges.sortWithinPartitions(*by).withColumns(
            {CHUNK: F.spark_partition_id(), ROW: F.monotonically_increasing_id()}
        )
        if not keep_order:
            numbered = numbered.drop(*[c for c in order if isinstance(c, str)])
        self.rows = stage(numbered if within is None else within(numbered), "chunks")

    @property
    def groups(self) -> list[str]:
        """Columns that name a set of rows one task may hold."""
        return [*self.keys, CHUNK]

    def cut_keys(self) -> DataFrame | None:
        """The keys that lie in several chunks, NULL keys left out; None when there are none. At most one a chunk border."""
        ends = self.rows.groupBy(CHUNK).agg(F.min(ROW).alias("_a"), F.max(ROW).alias("_z"))
        ends = ends.select(F.explode(F.array_distinct(F.array("_a", "_z"))).alias(ROW))
        ends = self.rows.select(*self.groups, ROW).join(F.broadcast(ends), ROW, "left_semi").select(*self.groups).distinct()
        cut = ends.dropna(subset=self.keys).groupBy(*self.keys).count().filter("count > 1").drop("count")
        found = [tuple(row) for row in cut.collect()]
        return cut.sparkSession.createDataFrame(found, cut.schema) if found else None

    def edges(self, rows: DataFrame, summaries: dict[str, Column]) -> DataFrame:
        """Summaries of the first and the last key of every chunk; no other key can lie in two chunks.

        ``rows`` derives from ``self.rows``. One pass, two rows a chunk.
        """
        key, whole = F.struct(*self.keys), F.struct(*self.keys, *summaries)
        each = rows.groupBy(*self.groups).agg(*[value.alias(name) for name, value in summaries.items()])
        ends = each.groupBy(CHUNK).agg(F.min_by(whole, key).alias("_a"), F.max_by(whole, key).alias("_z"))
        both = F.explode(F.array_distinct(F.array("_a", "_z"))).alias("_edge")
        return ends.select(CHUNK, both).select(CHUNK, "_edge.*")

    def running(
        self,
        sums: dict[str, Column] | None = None,
        totals: dict[str, Column] | None = None,
        previous: dict[str, Column] | None = None,
    ) -> DataFrame:
        """``self.rows`` with running values, all of them from one summary of the chunks and one set of windows.

        ``sums`` run over the key up to and including the row, ``totals`` over the whole key, ``previous`` is the value of
        the row before, NULL on the first row of a key.
        """
        sums, totals, previous = sums or {}, totals or {}, previous or {}
        held = {name: F.struct(value.alias("v")) for name, value in previous.items()}
        summaries = {f"_e_{name}": F.sum(value) for name, value in {**sums, **totals}.items()}
        summaries |= {f"_e_{name}": F.max_by(value, ROW) for name, value in held.items()}
        of_key = Window.partitionBy(*self.keys)
        earlier = of_key.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        carried = [F.sum(f"_e_{name}").over(earlier).alias(f"_c_{name}") for name in sums]
        carried += [F.sum(f"_e_{name}").over(of_key).alias(f"_c_{name}") for name in totals]
        carried += [F.lag(f"_e_{name}").over(of_key.orderBy(CHUNK)).alias(f"_c_{name}") for name in previous]
        rows = self._carry(self.rows, self.edges(self.rows, summaries).select(*self.groups, *carried))
        # Frames of one order, so that one operator evaluates them all.
        here = self._window()
        so_far = here.rowsBetween(Window.unboundedPreceding, 0)
        chunk = here.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        out = {name: F.sum(value).over(so_far) + F.coalesce(f"_c_{name}", F.lit(0)) for name, value in sums.items()}
        out |= {name: F.coalesce(f"_c_{name}", F.sum(value).over(chunk)) for name, value in totals.items()}
        out |= {name: F.coalesce(F.lag(value).over(here), f"_c_{name}")["v"] for name, value in held.items()}
        return rows.withColumns(out).drop(*[f"_c_{name}" for name in out])

    def next_known(self, rows: DataFrame, value: Column, out: str) -> DataFrame:
        """First non-NULL ``value`` among the rows after each row, NULL when there is none."""
        # Read backwards, so that the frame only grows and each row is visited once.
        backwards = self._window(descending=True).rowsBetween(Window.unboundedPreceding, -1)
        here = F.last(value, ignorenulls=True).over(backwards)
        first = F.min_by(value, F.when(value.isNotNull(), F.col(ROW)))
        later = Window.partitionBy(*self.keys).orderBy(F.desc(CHUNK)).rowsBetween(Window.unboundedPreceding, -1)
        carried = self.edges(rows, {"_first": first}).select(
            *self.groups, F.last("_first", ignorenulls=True).over(later).alias("_carried")
        )
        return self._carry(rows, carried).withColumn(out, F.coalesce(here, F.col("_carried"))).drop("_carried")

    def _carry(self, rows: DataFrame, carried: DataFrame) -> DataFrame:
        return _with_small(rows, carried, self.groups)

    def _window(self, descending: bool = False):
        return Window.partitionBy(*self.groups).orderBy(F.desc(ROW) if descending else F.asc(ROW))


def _with_small(rows: DataFrame, small: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Rows with the columns of a table that has at most a few rows per chunk; NULL keys match."""
    renamed = small.withColumnsRenamed({key: f"_small_{key}" for key in keys})
    same = reduce(Column.__and__, [F.col(key).eqNullSafe(F.col(f"_small_{key}")) for key in keys])
    return rows.join(F.broadcast(renamed), same, how).drop(*[f"_small_{key}" for key in keys])


def assign_ids(rows: DataFrame, order: list[str | Column], out: str = "id", after: DataFrame | None = None) -> DataFrame:
    """Consecutive ids in the given order, starting after the largest ``out`` of the table ``after``."""
    tagged = stage(rows.repartitionByRange(*order).withColumn(CHUNK, F.spark_partition_id()), "ids")
    sizes = tagged.groupBy(CHUNK).agg(F.count(F.lit(1)).alias("_rows"))
    # One row per chunk, however many rows the table has.
    offsets = sizes.select(
        CHUNK,
        F.coalesce(
            F.sum("_rows").over(Window.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_offset"),
    )
    local = F.row_number().over(Window.partitionBy(CHUNK).orderBy(*order))
    numbered = tagged.join(F.broadcast(offsets), CHUNK).withColumn(out, F.col("_offset") + local)
    if after is not None:
        last = after.agg(F.max(out)).first()[0]
        numbered = numbered.withColumn(out, F.col(out) + F.lit(last or 0))
    return numbered.drop(CHUNK, "_offset")


def global_rank(rows: DataFrame, by: str, out: str) -> DataFrame:
    """``RANK() OVER (ORDER BY by DESC)`` over the whole table.

    Ranks the distinct values with their counts, so equal values cost one row however many there are,
    and joins the rank back on the value.
    """
    values = rows.groupBy(by).agg(F.count(F.lit(1)).alias("_rows"))
    tagged = stage(
        values.repartitionByRange(F.col(by).desc()).withColumn(CHUNK, F.spark_partition_id()), "ranks"
    )
    before = Window.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        tagged.groupBy(CHUNK)
        .agg(F.sum("_rows").alias("_rows"))
        .select(CHUNK, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    above = F.sum("_rows").over(
        Window.partitionBy(CHUNK).orderBy(F.col(by).desc()).rowsBetween(Window.unboundedPreceding, -1)
    )
    ranks = tagged.join(F.broadcast(offsets), CHUNK).select(
        F.col(by).alias("_by"), (F.col("_offset") + F.coalesce(above, F.lit(0)) + 1).alias(out)
    )
    return rows.join(ranks, F.col(by).eqNullSafe(F.col("_by"))).drop("_by")
