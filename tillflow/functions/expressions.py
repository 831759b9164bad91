"""Column expressions shared by the operators (all JVM-side built-ins)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillflow.schema import FOLD_SEPARATOR, MONEY

# Fixed value: the top seller of a store and month earns 1% of the month's sales.
INCENTIVE_RATE = Decimal("0.01")


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: str | Column) -> Column:
    return _c(c).cast(MONEY)


def full_name(first: str | Column, last: str | Column) -> Column:
    """``first + ' ' + last``; NULL when either part is NULL."""
    return F.concat(_c(first), F.lit(" "), _c(last))


def month_of(d: str | Column) -> Column:
    """``yyyy-MM`` text of a date (the first seven characters of its ISO form)."""
    return F.date_format(_c(d), "yyyy-MM")


def fold_columns(cols: list[str | Column]) -> Column:
    """Extra columns folded into one text: values as text, NULLs skipped,
    all-NULL gives ''.  No extras at all gives a typed NULL."""
    if not cols:
        return F.lit(None).cast("string")
    return F.concat_ws(FOLD_SEPARATOR, *[
        (F.col(f"`{c}`") if isinstance(c, str) else c).cast("string") for c in cols])


def incentive(total: str | Column, is_top: Column) -> Column:
    """Exact decimal incentive, rounded half up to cents; 0 for non-top sellers.
    A NULL total at the top stays NULL."""
    paid = F.round(_c(total) * F.lit(INCENTIVE_RATE), 2)
    return F.when(is_top, paid).otherwise(F.lit(0)).cast(MONEY)
