"""What changed between two versions of a table.

Rows are told apart by a hash of all their other columns, so that only keys and hashes of the two versions meet; the
images are then fetched for the changed keys alone. Keys must be unique in each version; a NULL in a key is a value.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INSERT, UPDATE, DELETE = "insert", "update", "delete"


def changed_rows(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, ``change`` (insert, update or delete), ``old`` and ``new`` (structs of the other columns) of every changed
    key. Columns that only one version has are not compared; NULL equals NULL."""
    values = [c for c in before.columns if c in after.columns and c not in keys]
    a, b = (_hashed(rows, keys, values, side) for rows, side in ((before, "old"), (after, "new")))
    met = a.join(b, _same(keys, "old", "new"), "full")
    change = (
        F.when(F.col("_hash_old").isNull(), INSERT)
        .when(F.col("_hash_new").isNull(), DELETE)
        .when(F.col("_hash_old") != F.col("_hash_new"), UPDATE)
    )
    # A key that only one version has comes from that one; a NULL key is told from a missing row by the hash.
    of = [F.when(F.col("_hash_new").isNull(), F.col(f"_old_{k}")).otherwise(F.col(f"_new_{k}")).alias(k) for k in keys]
    changed = met.select(*of, change.alias("change")).filter("change IS NOT NULL")
    for rows, side in ((before, "old"), (after, "new")):
        image = rows.select(*[F.col(k).alias(f"_{side}_{k}") for k in keys], F.struct(*values).alias(side))
        changed = changed.join(image, reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{side}_{k}")) for k in keys]), "left")
    return changed.select(*keys, "change", "old", "new")


def updates(before: DataFrame, after: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    """Updated rows as a table of requested changes: ``key``, the old values, and new ones under the names in ``columns``
    (column: name of its new value). Rows that came or went are none."""
    rows = changed_rows(before, after, [key]).filter(F.col("change") == UPDATE)
    return rows.select(key, "old.*", *[F.col(f"new.{column}").alias(name) for column, name in columns.items()])


def _hashed(rows: DataFrame, keys: list[str], values: list[str], side: str) -> DataFrame:
    # Null flags first, so that a value that moves to the next column changes the hash.
    flags = [F.col(v).isNull() for v in values]
    row = F.xxhash64(*flags, *[F.col(v) for v in values]) if values else F.lit(0).cast("bigint")
    return rows.select(*[F.col(k).alias(f"_{side}_{k}") for k in keys], row.alias(f"_hash_{side}"))


def _same(keys: list[str], left: str, right: str) -> Column:
    return reduce(Column.__and__, [F.col(f"_{left}_{k}").eqNullSafe(F.col(f"_{right}_{k}")) for k in keys])
