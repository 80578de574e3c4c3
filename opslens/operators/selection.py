"""Exact order statistics by counting, without sorting or moving the values.

The range that holds a position is cut into equal bins, each task counts its rows per bin, and the bin that holds the
position is the next range.  What is shuffled is one row per bin and task; a range always loses its other end, and
usually shrinks a thousandfold, so a few passes over the column reach a single value.  Each pass reads the column
anew: give a stored table, not a long computation.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bins of a pass.
BINS = 2048


def _bin(x: Column, low, high, kind: T.DataType) -> Column:
    """The bin of ``x`` between two values, never falling as ``x`` grows; NULL where the ends cannot be told apart."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        x, low, width = x.cast("double") / 2, low / 2, high / 2 - low / 2
        above = x - F.lit(low)
    else:
        # In the column's own digits, so that neighbours far from zero stay apart.
        wide = x.cast("decimal(38,0)") if isinstance(kind, T.IntegralType) else x
        above = (wide - F.lit(Decimal(low)).cast("decimal(38,0)" if isinstance(kind, T.IntegralType) else kind)).cast("double")
        width = float(Decimal(high) - Decimal(low))
    place = F.floor(above / F.nullif(F.lit(float(width)), F.lit(0.0)) * BINS)
    return F.least(F.greatest(place, F.lit(0)), F.lit(BINS - 1))


def values_at(df: DataFrame, column: str, positions: Sequence[int], ends: tuple) -> list:
    """The values at ``positions`` (from 0, of the rows in ascending order); NULL and non-finite rows must be gone.

    ``ends`` are the column's least and largest value.  Positions that are still in one range share a pass.
    """
    kind, value = df.schema[column].dataType, F.col(column)
    brackets = {p: (*ends, 0) for p in positions}  # least, largest, rows before
    while wide := {b for b in brackets.values() if b[0] != b[1]}:
        found = {}
        for low, high, before in wide:
            inside = df.filter(value.between(F.lit(low).cast(kind), F.lit(high).cast(kind)))

            def counted(key: Column, inside: DataFrame = inside) -> list:
                rows = inside.groupBy(key.alias("bin")).agg(
                    F.count(F.lit(1)).alias("n"), F.min(value).alias("low"), F.max(value).alias("high")
                )
                return sorted(rows.collect(), key=lambda r: r["low"])

            bins = counted(_bin(value, low, high, kind))
            # Ends that differ by less than a quotient can tell have a few values between them: those are the bins.
            found[low, high, before] = bins if len(bins) > 1 else counted(value)
        for p, bracket in brackets.items():
            at = bracket[2]
            for row in found.get(bracket, ()):
                if p < at + row["n"]:
                    brackets[p] = (row["low"], row["high"], at)
                    break
                at += row["n"]
    return [brackets[p][0] for p in positions]


def median(df: DataFrame, column: str) -> float | None:
    """The median of a numeric column, as DOUBLE; NULL is left out, NaN is above all.  None without values."""
    kind, x = df.schema[column].dataType, F.col(column)
    rows = df.filter(x.isNotNull()).select(column)
    below = above = F.lit(False)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        below, above = x == -math.inf, F.isnan(x) | (x == math.inf)
    finite = F.when(~below & ~above, x)
    low, high, n, n_below, n_nan = rows.agg(
        F.min(finite), F.max(finite), F.count(F.lit(1)), F.count_if(below), F.count_if(F.isnan(x.cast("double")))
    ).first()
    if not n:
        return None
    middle = sorted({(n - 1) // 2, n // 2})
    n_finite = rows.filter(~below & ~above).count() if low is not None and isinstance(kind, (T.DoubleType, T.FloatType)) else n
    if low is None:
        n_finite = 0
    inner = [p - n_below for p in middle if n_below <= p < n_below + n_finite]
    known = dict(zip(inner, values_at(rows.filter(~below & ~above), column, inner, (low, high)) if inner else [], strict=True))

    def at(p: int) -> float:
        if p < n_below:
            return -math.inf
        if p - n_below in known:
            return float(known[p - n_below])
        return math.nan if p >= n - n_nan else math.inf

    return (at(middle[0]) + at(middle[-1])) / 2
