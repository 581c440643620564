"""Sequential acceptance of requests against a level, spread over the cluster.

Requests of a key are taken in order. A guarded request is accepted if the level stays at zero or above,
an accepted request moves the level, a rejected one does not. This is not a prefix sum, so the requests are walked one by
one; but they are walked in many places at once:

* requests are put in order and cut into chunks, a key with very many of them into several, see ``ordered``;
* every chunk is walked in a task of its own as it is written, each key from its opening level.

That is the outcome of a key in one chunk; its rows are not moved again. For a key cut by chunk borders (two keys a chunk
at most) the entry levels are settled in rounds over one summary row a chunk: a chunk whose lowest running sum keeps the level above
zero is accepted whole, one whose every request is out of reach is rejected whole, and neither is walked. The others
are walked at once from a presumed entry level, and walked again only where the level that really arrives turns out
different. When no presumption changes, all are right.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from functools import cached_property, reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockwright.functions.expressions import BALANCE, cents, from_cents
from stockwright.operators.ordered import CHUNK, ROW, OrderedChunks
from stockwright.sources.tables import stage

# Column of the requests with the level of their key, where there is no table of opening levels.
ENTRY = "_entry"


def allocate(
    requests: DataFrame,
    keys: list[str],
    order: list[str],
    delta: Column,
    guarded: Column,
    opening: DataFrame | None,
    chunks: int | None = None,
    keep_order: bool = True,
) -> DataFrame:
    """Requests with ``accepted`` and ``level`` (after the request).

    ``delta`` is what a request adds to the level, at two decimals; a row whose delta is NULL asks for nothing
    and is returned as not accepted. ``opening`` has (keys, level), zero where missing; without it the requests carry
    the level, the same for a key, in ``ENTRY``. ``order`` must be unique
    within a key, and requests must have a key. ``chunks`` and ``keep_order`` are those of ``OrderedChunks``.
    """
    competition = Competition(requests, keys, order, delta, guarded, opening, chunks, keep_order)
    return competition.outcome()


class Competition:
    """Requests in order, to be settled as often as it takes; ``rows`` carry what a request asks for in cents.

    The chunks are written once, walked as if every key entered them at its opening level. Keys cut by chunk borders, and
    keys whose requests have other wishes, are settled from them, reading the columns it takes.
    """

    def __init__(
        self,
        requests: DataFrame,
        keys: list[str],
        order: list[str],
        delta: Column,
        guarded: Column,
        opening: DataFrame | None,
        chunks: int | None = None,
        keep_order: bool = True,
    ):
        wanted = cents(delta)
        prepared = requests.withColumns(
            {"_delta": wanted, "_guarded": F.when(wanted.isNotNull(), F.coalesce(guarded, F.lit(True)))}
        )
        if opening is None:
            prepared = prepared.withColumn("_opening", cents(F.col(ENTRY))).drop(ENTRY)
        else:
            prepared = prepared.join(opening.select(*keys, cents(F.col("level")).alias("_opening")), keys, "left")
        prepared = prepared.withColumn("_opening", F.coalesce("_opening", F.lit(0)))
        walked = [*keys, CHUNK]
        self.ordered = OrderedChunks(
            prepared, keys, order, chunks, lambda rows: _take(rows, walked, "_opening"), keep_order
        )
        self._walked = self.ordered.rows
        self.rows = self._walked.drop("accepted", "_level")

    @cached_property
    def cut_keys(self) -> DataFrame | None:
        return self.ordered.cut_keys()

    def settle(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``accepted`` and ``_level`` (in cents, after the request).

        ``rows`` are those of ``self.rows`` or, of some keys, those from some place on, with the level there in ``_opening``.
        A request whose ``_delta`` is NULL asks for nothing. Rows that have ``accepted`` and ``_level`` of the chunk's walk keep
        them; of a key all do, or none, for which ``accepted`` is NULL.
        """
        kept = None
        if "accepted" in rows.columns:
            kept = rows.filter("accepted IS NOT NULL")
            # Read several times below.
            rows = stage(rows.filter("accepted IS NULL").drop("accepted", "_level"), "again")
        groups = self.ordered.groups
        entries = None
        if self.cut_keys is not None:
            cut = rows.join(F.broadcast(self.cut_keys), self.ordered.keys, "left_semi")
            entries = _settle_cut_keys(self.ordered, cut)
        if entries is None:
            rows = rows.withColumn("_enter", F.col("_opening"))
        else:
            rows = rows.join(F.broadcast(entries), groups, "left").withColumn("_enter", F.coalesce("_enter", "_opening"))
        settled = _walk(rows, groups).drop("_enter")
        return settled if kept is None else kept.unionByName(settled)

    def outcome(self, barred: DataFrame | None = None) -> DataFrame:
        """The columns of the requests with ``accepted`` and ``level``.

        ``barred`` has (keys, ROW) of requests that may not try; with it, the requests also say whether they are ``_barred``.
        """
        keys = self.ordered.keys
        rows = self._walked
        again = []
        if self.cut_keys is not None:
            again.append(F.broadcast(self.cut_keys))
        if barred is not None:
            again.append(barred.select(*keys).distinct())
            rows = rows.join(barred.select(ROW, F.lit(True).alias("_barred")), ROW, "left")
            rows = rows.withColumn("_delta", F.when(F.col("_barred").isNull(), F.col("_delta")))
        for changed in again:
            rows = rows.join(changed.withColumn("_again", F.lit(True)), keys, "left")
            rows = rows.withColumn("accepted", F.when(F.col("_again").isNull(), F.col("accepted"))).drop("_again")
        if again:
            rows = self.settle(rows)
        return rows.withColumn("level", from_cents("_level", BALANCE)).drop(
            "_delta", "_guarded", "_opening", "_level", CHUNK, ROW
        )


def _summary() -> dict[str, Column]:
    """What decides whether a chunk must be walked: sum, lowest guarded running sum, easiest guarded request."""
    guarded = F.col("_guarded")
    return {
        "_total": F.sum("_delta"),
        "_low": F.min(F.when(guarded, F.col("_prefix"))),
        "_best": F.max(F.when(guarded, F.col("_delta"))),
        "_all_guarded": F.bool_and("_guarded"),
    }


def _walk(rows: DataFrame, groups: list[str]) -> DataFrame:
    """Takes the requests of each group one by one from its entry level."""
    return _take(rows.repartition(*groups).sortWithinPartitions(*groups, ROW), groups, "_enter")


def _take(rows: DataFrame, groups: list[str], entry: str) -> DataFrame:
    """Takes the requests one by one; those of a group must follow each other in one partition."""
    schema = T.StructType(
        [*rows.schema.fields, T.StructField("accepted", T.BooleanType()), T.StructField("_level", T.LongType())]
    )

    def starts(batch: pa.RecordBatch, before: tuple | None) -> list[bool]:
        """Which rows have another group than the row before."""
        new = np.zeros(batch.num_rows, bool)
        for name in groups:
            here, last = batch.column(name)[1:], batch.column(name)[:-1]
            differs = pc.coalesce(pc.not_equal(here, last), pc.xor(here.is_null(), last.is_null()))
            new[1:] |= differs.to_numpy(zero_copy_only=False)
        new[0] = before != tuple(batch.column(name)[0].as_py() for name in groups)
        return new.tolist()

    def take_in_order(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, before = 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            wanted = batch.column("_delta")
            enters, deltas = (c.fill_null(0).to_numpy().tolist() for c in (batch.column(entry), wanted))
            free = pc.coalesce(batch.column("_guarded"), pa.scalar(False))
            masks = (m.to_numpy(zero_copy_only=False).tolist() for m in (wanted.is_valid(), pc.invert(free)))
            accepted, levels = [], []
            for new, enter, delta, known, unguarded in zip(starts(batch, before), enters, deltas, *masks):
                if new:
                    level = enter
                take = known and (unguarded or level + delta >= 0)
                if take:
                    level += delta
                accepted.append(take)
                levels.append(level)
            before = tuple(batch.column(name)[-1].as_py() for name in groups)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(accepted, pa.bool_()), pa.array(levels, pa.int64())],
                names=[*batch.schema.names, "accepted", "_level"],
            )

    return rows.mapInArrow(take_in_order, schema)


def _settle_cut_keys(ordered: OrderedChunks, rows: DataFrame) -> DataFrame | None:
    """Entry level of every chunk of the keys that span several chunks.

    What comes to the driver is one summary row for the first and the last key of each chunk.
    """
    keys = ordered.groups
    in_order = Window.partitionBy(*keys).orderBy(ROW).rowsBetween(Window.unboundedPreceding, 0)
    numbered = rows.select(*keys, ROW, "_delta", "_guarded", "_opening").withColumn(
        "_prefix", F.coalesce(F.sum("_delta").over(in_order), F.lit(0))
    )
    edges = ordered.edges(numbered, {**_summary(), "_enter": F.first("_opening")})
    # Rows without a key ask for nothing and need no level.
    known = [row.asDict() for row in edges.dropna(subset=ordered.keys).collect()]
    held = Counter(tuple(part[k] for k in ordered.keys) for part in known)
    parts = sorted(
        (part for part in known if held[tuple(part[k] for k in ordered.keys)] > 1), key=lambda p: [p[k] for k in keys]
    )
    if not parts:
        return None
    spark = edges.sparkSession
    schema = T.StructType([*[edges.schema[k] for k in keys], T.StructField("_enter", T.LongType())])
    results: dict[tuple, int] = {}
    while True:
        entries, open_parts = _chain(parts, ordered.keys, results)
        if not open_parts:
            return spark.createDataFrame(entries, schema)
        todo = spark.createDataFrame(open_parts, schema)
        requests = rows.select(*keys, ROW, "_delta", "_guarded").join(F.broadcast(todo), keys)
        ends = _walk(requests, keys).groupBy(*keys, "_enter").agg(F.max_by("_level", ROW).alias("_end"))
        for row in ends.collect():
            results[tuple(row[:-1])] = row["_end"]


def _chain(parts: list[dict], keys: list[str], results: dict[tuple, int]) -> tuple[list[tuple], list[tuple]]:
    """Entry levels along the chunks of each key, and the chunks still to be walked from theirs."""
    entries, open_parts = [], []
    for _, chunks in groupby(parts, key=lambda p: [p[k] for k in keys]):
        level = None
        for part in chunks:
            level = part["_enter"] if level is None else level
            entry = (*[part[k] for k in keys], part[CHUNK], level)
            entries.append(entry)
            total, low, best = part["_total"], part["_low"], part["_best"]
            if low is None or level + low >= 0:
                level += total or 0
            elif part["_all_guarded"] and level + best < 0:
                pass
            elif entry in results:
                level = results[entry]
            else:
                open_parts.append(entry)
                # Presumed outcome: drained, or where the sum leads.
                level = level + total if level + total >= 0 else min(level, max(0, -best - 1))
    return entries, open_parts
