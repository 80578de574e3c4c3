"""Distributions, pivots and censuses."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opslens.functions.wide import wide_mean, wide_sum
from opslens.operators.ranking import share_of_total
from opslens.operators.selection import median


def value_share(df: DataFrame, column: str, digits: int = 1) -> DataFrame:
    """``(column, n, pct)`` per value, most frequent first; NULL is left out."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return share_of_total(counts, "n", "pct", digits).orderBy(F.col("n").desc(), F.col(column).asc())


def categories(df: DataFrame, column: str) -> list:
    """The values of a category column, sorted: the columns of a pivot, so as many as the result is wide."""
    rows = df.select(column).filter(F.col(column).isNotNull()).distinct().collect()
    return sorted(r[0] for r in rows)


def pivot_fill(
    df: DataFrame,
    keys: Sequence[str],
    category: str,
    measure: Column,
    values: Sequence | None = None,
) -> DataFrame:
    """One column per category holding the sum of ``measure``; empty cells are 0.

    With ``values`` the columns are exactly these, in this order, also where
    the data has none of a category; without, they are the categories found.
    Rows with a NULL key or category are left out, but a row whose categories
    are all outside ``values`` stays, with zeros.  Categories of any type name
    their column by their text.
    """
    columns = list(values) if values is not None else categories(df, category)
    present = df.filter(F.col(category).isNotNull())
    for key in keys:
        present = present.filter(F.col(key).isNotNull())
    cells = [
        F.coalesce(F.sum(F.when(F.col(category) == value, measure)), F.lit(0)).alias(str(value)) for value in columns
    ]
    return present.groupBy(*keys).agg(*cells)


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """``(bin, lo, hi, n)`` over equal widths from minimum to maximum.

    The last bin is closed, empty bins are kept, and a column with one value
    only gets a range half a unit wide on either side.  Two passes: the edges
    (two numbers) are read first and are literals in the second.  NaN and
    infinite values give no finite range and are refused.
    """
    x = F.col(column).cast("double")
    values = df.filter(F.col(column).isNotNull()).select(x.alias("x"))
    low, high = values.agg(F.min("x"), F.max("x")).first()
    spark = df.sparkSession
    if low is None:
        return spark.createDataFrame([], "bin bigint, lo double, hi double, n bigint")
    if not (math.isfinite(low) and math.isfinite(high)):
        raise ValueError(f"the range of {column} is not finite")
    if low == high:
        low, high = low - 0.5, high + 0.5
    index = F.floor((F.col("x") - low) * bins / (high - low))
    counted = (
        values.select(F.least(index, F.lit(bins - 1)).alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    )
    width = (high - low) / bins
    return (
        spark.range(bins)
        .withColumnRenamed("id", "bin")
        .join(counted, "bin", "left")
        .select(
            (F.col("bin") + 1).alias("bin"),
            (low + F.col("bin") * width).alias("lo"),
            (low + (F.col("bin") + 1) * width).alias("hi"),
            F.coalesce("n", F.lit(0)).alias("n"),
        )
    )


def distribution_stats(df: DataFrame, column: str) -> DataFrame:
    """One row, ``(mean, median, max)``; NULL is left out.

    The mean of whole numbers and DECIMAL is DECIMAL with 18 digits behind the point, exact, that of DOUBLE is DOUBLE.
    The median is found by counting (``selection``): the built-in one keeps every distinct value in the memory of one
    task, and sorting would move them all.  The column is read a few times and nothing but counts is shuffled.
    """
    present, value = df.filter(F.col(column).isNotNull()).select(column), F.col(column)
    kind = df.schema[column].dataType
    floating = isinstance(kind, (T.DoubleType, T.FloatType))
    # Sums of up to 20 digits have room for 10^18 rows in the widest DECIMAL.
    digits, scale = (20, 0) if isinstance(kind, T.IntegralType) else (getattr(kind, "precision", 0), getattr(kind, "scale", 0))
    narrow = digits <= 20 and scale <= 18
    total = F.sum(value.cast("double")) if floating else F.sum(value.cast(f"decimal(38,{scale})")) if narrow else wide_sum(value)
    found = present.agg(total.alias("total"), F.count(value).alias("n"), F.max(value).alias("max")).first()
    mean = None
    if found["n"]:
        mean = found["total"] / found["n"] if floating else wide_mean(found["total"], found["n"])
    return df.sparkSession.range(1).select(
        F.lit(mean).cast("double" if floating else "decimal(38,18)").alias("mean"),
        F.lit(median(present, column)).cast("double").alias("median"),
        F.lit(found["max"]).cast(kind).alias("max"),
    )


def null_census(df: DataFrame) -> DataFrame:
    """``(column_name, n_null)`` for the columns that have NULLs, in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], list(df.columns), "column_name", "n_null").filter(F.col("n_null") > 0)
