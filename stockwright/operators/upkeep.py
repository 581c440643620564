"""Stored sums kept up to date by what changed, instead of being summed anew.

A change of a row takes its old amount from the sum it was in and adds its new amount to the sum it is in now; the two may be
different sums. Changes are added up per sum before they meet the stored ones, so a sum that a third of all changes
touch is no heavy key, and of the stored sums only the touched ones come back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def signed_changes(changes: DataFrame, keys: list[str], amount: str) -> DataFrame:
    """``keys, amount, rows``: what to add to every touched sum.

    ``changes`` has ``old`` and ``new``, structs with ``keys`` and ``amount``: an inserted row has no ``old``, a deleted one no
    ``new``. An amount that is NULL counts as zero, but its row counts.
    """

    def side(name: str, sign: int) -> Column:
        value = F.coalesce(F.col(f"{name}.{amount}"), F.lit(0)) * sign
        fields = [F.col(f"{name}.{k}").alias(k) for k in keys]
        return F.when(F.col(name).isNotNull(), F.struct(*fields, value.alias(amount), F.lit(sign).cast("bigint").alias("rows")))

    each = changes.select(F.explode(F.array_compact(F.array(side("old", -1), side("new", 1)))).alias("c")).select("c.*")
    return each.groupBy(*keys).agg(F.sum(amount).alias(amount), F.sum("rows").alias("rows"))


def touched_sums(stored: DataFrame, signed: DataFrame, keys: list[str], amount: str) -> DataFrame:
    """New state of the touched sums: ``keys, amount, rows``. A sum whose last row went stays with zero rows; a sum that was
    not stored begins at zero."""
    kind = stored.schema[amount].dataType
    change = signed.withColumnsRenamed({amount: "_amount", "rows": "_rows"})
    met = change.join(stored.select(*keys, amount, "rows"), keys, "left")
    return met.select(
        *keys,
        (F.coalesce(F.col(amount), F.lit(0)) + F.col("_amount")).cast(kind).alias(amount),
        (F.coalesce("rows", F.lit(0)) + F.col("_rows")).alias("rows"),
    )


def merged_sums(stored: DataFrame, touched: DataFrame, keys: list[str]) -> DataFrame:
    """All sums after the change; those without a row are gone."""
    rest = stored.join(touched.select(*keys), keys, "left_anti")
    return rest.unionByName(touched.filter("rows > 0"), allowMissingColumns=True)
