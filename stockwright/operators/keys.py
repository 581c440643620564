"""Deleting rows along declared foreign keys, over any number of tables and levels.

A row asked to go takes with it the rows that refer to it by CASCADE, and those that refer to these. It must stay when a row
refers to it, or to any row it would take with it, by RESTRICT. References by SET NULL are cleared. Only ids travel:
they are followed downwards from the rows asked for, what must stay is followed upwards among them, and each table
is then read once for its new state. A table that refers to itself is followed until nothing new is found.
"""

from __future__ import annotations

from dataclasses import dataclass
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockwright.sources.tables import stage

CASCADE, SET_NULL, RESTRICT = "CASCADE", "SET NULL", "RESTRICT"


@dataclass(frozen=True)
class ForeignKey:
    """``column`` of ``child`` holds ids (column ``id``) of ``parent``; NULL refers to nothing."""

    child: str
    column: str
    parent: str
    on_delete: str


@dataclass
class Deletion:
    """New state of every table, and by table the ids that were asked to go and must stay."""

    tables: dict[str, DataFrame]
    refused: dict[str, DataFrame]


class KeyGraph:
    """Tables by name and the keys between them. Tables may refer to themselves, but not to each other in a circle."""

    def __init__(self, tables: dict[str, DataFrame], keys: list[ForeignKey]):
        unknown = {k.on_delete for k in keys} - {CASCADE, SET_NULL, RESTRICT}
        if unknown:
            raise ValueError(f"unknown action {', '.join(sorted(unknown))}")
        self.tables, self.keys = tables, keys
        above: dict[str, set[str]] = {name: set() for name in tables}
        for key in keys:
            if key.child != key.parent:
                above[key.child].add(key.parent)
        # Parents before children.
        self.order = list(TopologicalSorter(above).static_order())
        self.parents = {key.parent for key in keys}

    def delete(self, asked: dict[str, DataFrame]) -> Deletion:
        """Deletes the rows whose ``id`` is in the frames of ``asked``, as far as the keys let them go."""
        asked = {name: stage(rows.select("id").distinct(), "asked") for name, rows in asked.items()}
        reached = self._reached(asked)
        kept = self._kept(reached)
        going = {
            name: ids.join(kept[name], "id", "left_anti") if name in kept else ids for name, ids in asked.items()
        }
        gone = self._reached(going) if kept else reached
        refused = {
            name: ids.join(kept[name], "id", "left_semi") if name in kept else ids.limit(0)
            for name, ids in asked.items()
        }
        return Deletion({name: self._after(name, gone) for name in self.tables}, refused)

    def _of(self, *, child: str | None = None, parent: str | None = None, action: str) -> list[ForeignKey]:
        return [
            k for k in self.keys if k.on_delete == action and child in (None, k.child) and parent in (None, k.parent)
        ]

    def _reached(self, start: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """Ids of the tables others refer to that go when the rows of ``start`` do."""
        found: dict[str, DataFrame] = {}
        for name in self.order:
            if name not in self.parents and name not in start:
                continue
            parts = [start[name]] if name in start else []
            keys = self._of(child=name, action=CASCADE)
            for key in keys:
                if key.parent != name and key.parent in found:
                    parts.append(self._ids(key, found[key.parent]))
            if not parts:
                continue
            ids = parts[0]
            for part in parts[1:]:
                ids = ids.unionByName(part)
            found[name] = self._closed(ids, [k for k in keys if k.parent == name], self._ids)
        return found

    def _kept(self, reached: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """Ids among the reached ones that must stay, only for tables where there are any."""
        kept: dict[str, DataFrame] = {}
        for name in reversed(self.order):
            if name not in reached:
                continue
            parts = []
            for key in self._of(parent=name, action=RESTRICT):
                parts.append(self.tables[key.child].select(F.col(key.column).alias("id")))
            cascades = self._of(parent=name, action=CASCADE)
            for key in cascades:
                if key.child != name and key.child in kept:
                    parts.append(self._owners(key, kept[key.child]))
            if not parts:
                continue
            ids = parts[0]
            for part in parts[1:]:
                ids = ids.unionByName(part)
            ids = reached[name].join(ids, "id", "left_semi")
            ids = self._closed(
                ids,
                [k for k in cascades if k.child == name],
                lambda key, below: self._owners(key, below).join(reached[key.parent], "id", "left_semi"),
            )
            if not ids.isEmpty():
                kept[name] = ids
        return kept

    def _ids(self, key: ForeignKey, parents: DataFrame) -> DataFrame:
        """Ids of the rows of the child that refer to ``parents``."""
        rows = self.tables[key.child].select("id", F.col(key.column).alias("_parent"))
        return rows.join(parents.select(F.col("id").alias("_parent")), "_parent", "left_semi").select("id")

    def _owners(self, key: ForeignKey, children: DataFrame) -> DataFrame:
        """Ids that the rows ``children`` of the child refer to."""
        rows = self.tables[key.child].select("id", key.column).join(children, "id", "left_semi")
        return rows.select(F.col(key.column).alias("id")).dropna()

    def _closed(self, ids: DataFrame, own: list[ForeignKey], step) -> DataFrame:
        """``ids`` with all that ``step`` finds from them along the keys of a table to itself."""
        found = stage(ids.distinct(), "ids")
        new = found
        while own:
            parts = [step(key, new) for key in own]
            more = parts[0]
            for part in parts[1:]:
                more = more.unionByName(part)
            new = stage(more.distinct().join(found, "id", "left_anti"), "ids")
            if new.isEmpty():
                break
            found = found.unionByName(new)
        return found

    def _after(self, name: str, gone: dict[str, DataFrame]) -> DataFrame:
        rows = self.tables[name]
        columns = rows.columns
        if name in gone:
            rows = rows.join(gone[name], "id", "left_anti")
        for key in self._of(child=name, action=CASCADE):
            # Rows of a table with ids are among the reached ones already.
            if key.parent in gone and name not in gone:
                rows = rows.join(gone[key.parent].withColumnRenamed("id", key.column), key.column, "left_anti")
        for key in self._of(child=name, action=SET_NULL):
            if key.parent in gone:
                cleared = gone[key.parent].select(F.col("id").alias(key.column), F.lit(True).alias("_gone"))
                rows = rows.join(cleared, key.column, "left").withColumn(
                    key.column, F.when(F.col("_gone").isNull(), F.col(key.column))
                ).drop("_gone")
        return rows.select(*columns)
