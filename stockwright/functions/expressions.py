"""Column expressions shared by reports, rules and change jobs."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"
# Sums of amounts: a busy cell outgrows the type of a single amount.
BALANCE = "decimal(22,2)"
# Wide enough for sums over any number of documents.
CENTS = "decimal(30,0)"


def money(column: str | Column) -> Column:
    return _col(column).cast(MONEY)


def line_total(qty: str | Column = "qty", unit_price: str | Column = "unit_price") -> Column:
    """The stored generated column: quantity times price at two decimals."""
    return (_col(qty) * _col(unit_price)).cast(MONEY)


def signed_qty(movement_type: str | Column = "movement_type", qty: str | Column = "qty") -> Column:
    """Effect of one movement on stock: OUT lowers it, IN adds, ADJUST carries its own sign."""
    kind, amount = _col(movement_type), _col(qty)
    return (
        F.when(kind == "IN", amount)
        .when(kind == "OUT", -amount)
        .when(kind == "ADJUST", amount)
        .otherwise(F.lit(0).cast(MONEY))
    )


def stock_status(
    stock: str | Column, minimum: str | Column = "min_stock_level", maximum: str | Column = "max_stock_level"
) -> Column:
    stock, minimum, maximum = _col(stock), _col(minimum), _col(maximum)
    return (
        F.when(stock <= minimum, "LOW")
        .when(stock >= maximum * F.lit(Decimal("0.9")), "HIGH")
        .otherwise("NORMAL")
    )


def mean(column: str | Column) -> Column:
    """Average of a decimal column: exact sum, one division."""
    column = _col(column)
    return F.sum(column).cast("double") / F.count(column)


def count_if(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def cents(amount: str | Column) -> Column:
    """An amount at two decimals as a whole number: running sums over longs cost a fraction of those over decimals."""
    return (_col(amount) * 100).cast("bigint")


def from_cents(number: str | Column, kind: str) -> Column:
    return (_col(number) * F.lit("0.01").cast("decimal(3,2)")).cast(kind)


def in_cents(column: str | Column) -> Column:
    return (_col(column) * 100).cast(CENTS)


def half_up_quotient(numerator: Column, denominator: Column) -> Column:
    """``ROUND(numerator / denominator, 2)`` of two-decimal amounts, exact; NULL on division by zero.

    Done on whole cents, so no intermediate rounding can move a tie.
    """
    top, bottom = in_cents(numerator), F.nullif(in_cents(denominator), F.lit(0))
    size = F.call_function(
        "div",
        (F.abs(top) * 200 + F.abs(bottom)).cast("decimal(38,0)"),
        (F.abs(bottom) * 2).cast("decimal(38,0)"),
    )
    sign = F.when((top < 0) != (bottom < 0), -1).otherwise(1)
    return (sign * size * F.lit(Decimal("0.01"))).cast("decimal(20,2)")


def percent_change(old: str | Column, new: str | Column) -> Column:
    """Change from old to new in percent at two decimals; NULL when old is zero or NULL."""
    old, new = _col(old), _col(new)
    return half_up_quotient((new - old) * 100, old)


def month_of(column: str | Column) -> Column:
    return F.date_format(_col(column), "yyyy-MM")


# Names are compared without case and accents; trailing blanks do not count where names are equal.
ALIKE, ALIKE_INSIDE = "UNICODE_CI_AI_RTRIM", "UNICODE_CI_AI"


def alike(name: str | Column) -> Column:
    """A name as a collated column: equality, grouping, distinct rows, joins and order ignore case, accents and trailing
    blanks."""
    return F.collate(_col(name), ALIKE)


def contains_text(column: str | Column, text: str) -> Column:
    """Substring search that ignores case and accents, with the text taken literally."""
    return F.contains(F.collate(_col(column), ALIKE_INSIDE), F.collate(F.lit(text), ALIKE_INSIDE))


def first_failure(rules: Sequence[tuple[str, Column]]) -> Column:
    """Reason of the first rule that fires, NULL when none does.

    A condition that evaluates to NULL does not fire.
    """
    return F.coalesce(*[F.when(condition, F.lit(reason)) for reason, condition in rules], F.lit(None).cast("string"))


def changed(old: str | Column, new: str | Column) -> Column:
    """True only for two known, different values (NULL on either side is not a change)."""
    return F.coalesce(_col(old) != _col(new), F.lit(False))


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column
