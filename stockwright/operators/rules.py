"""Business rules as one pass over a batch: every row gets the reason of the first rule it breaks.

The rules of a batch are checked against the state before the batch. Rules whose state changes with each
accepted row are in ``allocation``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockwright.functions import wording as W
from stockwright.functions.expressions import BALANCE, changed, count_if, first_failure, percent_change
from stockwright.operators.ledger import CELL, current_stock



def qty_and_price() -> list[tuple[str, Column]]:
    return [(W.NO_QTY, F.col("qty") <= 0), (W.NO_PRICE, F.col("unit_price") <= 0)]


def with_status(rows: DataFrame, invoice: DataFrame, key: str) -> DataFrame:
    """Rows with the status of their document as ``invoice_status``, NULL where it is unknown."""
    return rows.join(invoice.select(F.col("id").alias(key), F.col("status").alias("invoice_status")), key, "left")


def with_dimensions(rows: DataFrame, product: DataFrame, warehouse: DataFrame) -> DataFrame:
    """Rows with activity and levels of their product and activity of their warehouse, NULL where unknown."""
    levels = product.select(
        F.col("id").alias("product_id"), F.col("is_active").alias("product_active"), "min_stock_level", "max_stock_level"
    )
    sites = warehouse.select(F.col("id").alias("warehouse_id"), F.col("is_active").alias("warehouse_active"))
    return rows.join(levels, "product_id", "left").join(sites, "warehouse_id", "left")


def with_stock(rows: DataFrame, movement: DataFrame) -> DataFrame:
    """Rows with the stock of their cell, 0 where nothing moved."""
    return rows.join(current_stock(movement), CELL, "left").withColumn(
        "stock", F.coalesce("stock", F.lit(0).cast(BALANCE))
    )


def validate_purchase_lines(
    lines: DataFrame, invoice: DataFrame, product: DataFrame, warehouse: DataFrame, movement: DataFrame
) -> DataFrame:
    """Purchase lines asked for. An unknown document has no status and is left to the key check."""
    rows = with_stock(with_dimensions(with_status(lines, invoice, "purchase_invoice_id"), product, warehouse), movement)
    return rows.withColumn(
        "reason",
        first_failure(
            [
                (W.LINE_CLOSED, F.col("invoice_status") != "DRAFT"),
                (W.BUY_INACTIVE, ~F.col("product_active")),
                (W.BUY_CLOSED_SITE, ~F.col("warehouse_active")),
                *qty_and_price(),
                (W.OVER_MAX, F.col("stock") + F.col("qty") > F.col("max_stock_level")),
            ]
        ),
    )


def validate_sales_lines(
    lines: DataFrame,
    invoice: DataFrame,
    product: DataFrame,
    warehouse: DataFrame,
    movement: DataFrame,
    drafts_only: bool = False,
) -> DataFrame:
    """Sales lines asked for.

    By default drafts take any line and other documents need stock and active dimensions.
    ``drafts_only`` takes lines for drafts only, keeps the minimum level and checks every line.
    """
    rows = with_stock(with_dimensions(with_status(lines, invoice, "sales_invoice_id"), product, warehouse), movement)
    not_draft = F.col("invoice_status") != "DRAFT"
    short = F.col("stock") < F.col("qty")
    if drafts_only:
        rules = [
            (W.LINE_CLOSED, not_draft),
            (W.SELL_INACTIVE, ~F.col("product_active")),
            (W.SELL_CLOSED_SITE, ~F.col("warehouse_active")),
            *qty_and_price(),
            (W.NO_STOCK, short),
            (W.UNDER_MIN, F.col("stock") - F.col("qty") < F.col("min_stock_level")),
        ]
    else:
        rules = [
            (W.NO_STOCK, not_draft & short),
            (W.SELL_INACTIVE, not_draft & ~F.col("product_active")),
            (W.SELL_CLOSED_SITE, not_draft & ~F.col("warehouse_active")),
            *qty_and_price(),
        ]
    return rows.withColumn("reason", first_failure(rules))


def validate_purchase_status(changes: DataFrame) -> DataFrame:
    """Status and supplier changes of purchase documents: (status, new_status, supplier_id, new_supplier_id)."""
    fixed = F.col("status") != "DRAFT"
    return changes.withColumn(
        "reason",
        first_failure(
            [
                (
                    W.PURCHASE_FIXED,
                    fixed & (F.col("new_status") != F.col("status")),
                ),
                (
                    W.SUPPLIER_FIXED,
                    fixed & (F.col("new_supplier_id") != F.col("supplier_id")),
                ),
            ]
        ),
    )


def validate_sales_confirm(
    changes: DataFrame, lines: DataFrame | None = None, movement: DataFrame | None = None
) -> DataFrame:
    """Status changes of sales documents: (id, status, new_status).

    With lines and ledger given, a draft is confirmed only if the stock covers each of its lines, one by one.
    """
    rules = [
        (
            W.SALE_FIXED,
            (F.col("status") != "DRAFT") & (F.col("new_status") != F.col("status")),
        )
    ]
    if lines is None:
        return changes.withColumn("reason", first_failure(rules))
    confirming = changes.filter((F.col("status") == "DRAFT") & (F.col("new_status") == "CONFIRMED")).select(
        F.col("id").alias("sales_invoice_id")
    )
    short = (
        with_stock(lines.join(confirming, "sales_invoice_id", "left_semi"), movement)
        .groupBy(F.col("sales_invoice_id").alias("id"))
        .agg(count_if(F.col("stock") < F.col("qty")).alias("short_lines"))
    )
    rules.append((W.SALE_SHORT, F.col("short_lines") > 0))
    return changes.join(short, "id", "left").withColumn("reason", first_failure(rules))


def validate_product_updates(
    product: DataFrame,
    changes: DataFrame,
    purchase_line: DataFrame,
    purchase_invoice: DataFrame,
    sales_line: DataFrame,
    sales_invoice: DataFrame,
) -> DataFrame:
    """Changes (id, new_price, new_min, new_max, new_active) of products."""
    rows = product.select("id", F.col("default_price").alias("old_price"), F.col("is_active").alias("old_active")).join(
        changes, "id"
    )
    leaving = F.col("old_active") & ~F.col("new_active")
    wanted = rows.filter(leaving).select(F.col("id").alias("product_id"))

    def on_drafts(lines: DataFrame, invoice: DataFrame, key: str, flag: str) -> DataFrame:
        drafts = invoice.filter(F.col("status") == "DRAFT").select(F.col("id").alias(key))
        return (
            lines.select(key, "product_id")
            .join(wanted, "product_id", "left_semi")
            .join(drafts, key, "left_semi")
            .select(F.col("product_id").alias("id"))
            .distinct()
            .withColumn(flag, F.lit(True))
        )

    bought = on_drafts(purchase_line, purchase_invoice, "purchase_invoice_id", "_bought")
    sold = on_drafts(sales_line, sales_invoice, "sales_invoice_id", "_sold")
    too_cheap = F.col("new_price") < F.col("old_price") * F.lit("0.8").cast("decimal(2,1)")
    return (
        rows.join(bought, "id", "left")
        .join(sold, "id", "left")
        .withColumn(
            "reason",
            first_failure(
                [
                    (W.PRICE_DROP, too_cheap),
                    (W.MIN_NEGATIVE, F.col("new_min") < 0),
                    (
                        W.MAX_TOO_LOW,
                        F.col("new_max") <= F.col("new_min"),
                    ),
                    (
                        W.ON_DRAFT_PURCHASE,
                        leaving & F.col("_bought"),
                    ),
                    (W.ON_DRAFT_SALE, leaving & F.col("_sold")),
                ]
            ),
        )
        .withColumn("reduction", F.when(too_cheap, -percent_change("old_price", "new_price")))
        .drop("_bought", "_sold")
    )


def validate_line_deletes(lines: DataFrame, invoice: DataFrame, key: str) -> DataFrame:
    """Lines to delete: only those of drafts may go."""
    return with_status(lines, invoice, key).withColumn(
        "reason",
        first_failure([(W.DELETE_CLOSED, F.col("invoice_status") != "DRAFT")]),
    )


# Table constraints as a report


def unique_violations(table: DataFrame, columns: list[str]) -> DataFrame:
    """Number of values that occur more than once; NULLs are never equal."""
    known = table.dropna(subset=columns)
    return known.groupBy(*columns).count().filter(F.col("count") > 1).agg(F.count(F.lit(1)).alias("violations"))


@dataclass(frozen=True)
class Holds:
    """No row of ``table`` may meet ``broken``."""

    table: str
    rule: str
    broken: Column


@dataclass(frozen=True)
class Unique:
    """No two rows of ``table`` may have equal ``columns``; NULLs are never equal."""

    table: str
    rule: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class Exists:
    """``column`` of ``table`` must be the ``id`` of a row of ``parent`` (one that meets ``where``), or NULL."""

    table: str
    rule: str
    column: str
    parent: str
    where: Column | None = None


def constraint_report(tables: dict[str, DataFrame], constraints: list[Holds | Unique | Exists]) -> DataFrame:
    """``table_name, rule, violations``: rows that break a condition, values that occur twice, rows without a parent.

    Each table is read once, whatever the number of its rules and of the rules that refer to it: a row becomes an entry
    (rule, key) for every rule it takes part in, as a child or as a parent, and one aggregate over the entries of all tables
    answers all rules.
    """
    entries = None
    for name, table in tables.items():
        own = [entry for n, c in enumerate(constraints) for entry in _entries(n, c, name)]
        if own:
            rows = table.select(F.explode(F.array_compact(F.array(*own))).alias("e")).select("e.*")
            entries = rows if entries is None else entries.unionByName(rows)
    keys = entries.groupBy("number", "key").agg(F.sum("child").alias("children"), F.max("parent").alias("parent"))
    kinds = {Holds: "holds", Unique: "unique", Exists: "exists"}
    spark = entries.sparkSession
    named = spark.createDataFrame(
        [(n, c.table, c.rule, kinds[type(c)]) for n, c in enumerate(constraints)],
        "number int, table_name string, rule string, kind string",
    )
    kind, children = F.col("kind"), F.col("children")
    broken = (
        F.when(kind == "unique", (children > 1).cast("bigint"))
        .when((kind == "exists") & (F.col("parent") == 1), F.lit(0))
        .otherwise(children)
    )
    counted = keys.join(F.broadcast(named), "number").groupBy("number").agg(F.sum(broken).alias("violations"))
    return named.join(counted, "number", "left").select(
        "table_name", "rule", F.coalesce("violations", F.lit(0)).cast("bigint").alias("violations")
    )


def _entries(number: int, constraint: Holds | Unique | Exists, table: str) -> list[Column]:
    """What a row of ``table`` says about a constraint: structs, NULL where it says nothing."""

    def entry(key: Column, child: int) -> Column:
        return F.struct(
            F.lit(number).alias("number"), key.alias("key"), F.lit(child).alias("child"), F.lit(1 - child).alias("parent")
        )

    out = []
    if isinstance(constraint, Holds):
        if constraint.table == table:
            out.append(F.when(constraint.broken, entry(F.lit(None).cast("string"), 1)))
    elif isinstance(constraint, Unique):
        if constraint.table == table:
            known = [F.col(c).isNotNull() for c in constraint.columns]
            # Lengths first, so that no two lists of values are spelt alike.
            texts = [F.col(c).cast("string") for c in constraint.columns]
            parts = [p for text in texts for p in (F.length(text).cast("string"), F.lit(":"), text)]
            out.append(F.when(reduce(Column.__and__, known), entry(F.concat(*parts), 1)))
    else:
        if constraint.table == table:
            column = F.col(constraint.column)
            out.append(F.when(column.isNotNull(), entry(column.cast("string"), 1)))
        if constraint.parent == table:
            meets = F.lit(True) if constraint.where is None else constraint.where
            out.append(F.when(meets, entry(F.col("id").cast("string"), 0)))
    return out


def confirmed_now() -> Column:
    """Accepted changes that turn a document into a confirmed one."""
    return F.col("reason").isNull() & changed("status", "new_status") & (F.col("new_status") == "CONFIRMED")


def cancelled_now() -> Column:
    """Accepted changes that turn a document into a cancelled one."""
    return F.col("reason").isNull() & changed("status", "new_status") & (F.col("new_status") == "CANCELLED")
