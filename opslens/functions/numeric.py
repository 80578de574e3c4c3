"""Ratios, means and roundings that agree to the last digit between runs.

Whole numbers are divided as DECIMAL wide enough for them, so halves round away from zero and the order in which
partial sums meet does not matter.  DECIMAL with digits behind the point is divided with a stated ``scale``, by
``opslens.functions.wide``: Spark's own quotient of wide DECIMAL keeps six digits.  DOUBLE stays DOUBLE.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from opslens.functions._col import as_col
from opslens.functions.wide import wide, wide_ratio


def _as_decimal(c: Column | str, factor: int = 1) -> Column:
    """``factor`` times a number: the product with a DECIMAL literal makes a whole type wide enough for all its values."""
    return as_col(c) * F.lit(Decimal(factor))


def exact_ratio(numerator: Column | str, denominator: Column | str, factor: int = 1, scale: int | None = None) -> Column:
    """``factor * numerator / denominator``; NULL when the denominator is zero.

    For whole numbers no scale is needed.  With one the parts may be any DECIMAL, ``factor`` is a power of ten, and the
    result is DECIMAL(38, scale), rounded once.
    """
    if scale is not None:
        return wide_ratio(wide(numerator), wide(denominator), factor, scale)
    return _as_decimal(numerator, factor) / F.nullif(_as_decimal(denominator), F.lit(0))


def percent(part: Column | str, whole: Column | str, scale: int | None = None) -> Column:
    """100 · part / whole; NULL when the whole is zero."""
    return exact_ratio(part, whole, 100, scale)


def percent_rounded(part: Column | str, whole: Column | str, digits: int = 1) -> Column:
    """100 · part / whole of whole numbers, rounded."""
    return F.round(percent(part, whole), digits)


def average(total: Column | str, count: Column | str, scale: int | None = None) -> Column:
    """A mean from its two mergeable halves; NULL for an empty group."""
    return exact_ratio(total, count, 1, scale)


def round_to_long(c: Column | str) -> Column:
    """Round half away from zero, then BIGINT (a bare cast would truncate)."""
    return F.round(as_col(c), 0).cast("bigint")


def tier(rules: Sequence[tuple[Column, str]], default: str) -> Column:
    """The label of the first rule that holds; NULL conditions do not hold."""
    result = None
    for condition, label in rules:
        result = F.when(condition, F.lit(label)) if result is None else result.when(condition, F.lit(label))
    return F.lit(default) if result is None else result.otherwise(F.lit(default))
