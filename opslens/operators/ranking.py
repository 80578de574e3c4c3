"""Rank, running count and share over a whole relation, without one big task.

An unpartitioned window sends every row to one task.  Here the distinct rank
keys are counted, range-partitioned into buckets and staged; each bucket counts
on its own, and the few bucket totals (their number is a parameter) are added
up on the side.  Ties, gaps and NULL positions are those of ``rank()``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opslens.functions.numeric import percent_rounded
from opslens.functions.wide import UNIT, ratio_to, wide_sum, wide_units
from opslens.sources.staging import stage


def _sort_column(name: str, descending: bool) -> Column:
    return F.col(name).desc_nulls_first() if descending else F.col(name).asc_nulls_last()


def running_counts(
    df: DataFrame,
    keys: Sequence[str],
    descending: bool = False,
    buckets: int | None = None,
) -> DataFrame:
    """Per distinct key: ``key_rows`` and ``rows_before`` it in key order.

    Keys are counted first, so a key held by a third of all rows is one row
    from here on and every bucket gets about the same number of keys.
    """
    order = [_sort_column(k, descending) for k in keys]
    ahead = [Window.unboundedPreceding, -1]
    counted = stage(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("key_rows")), "key-counts")
    buckets = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The bucket is the range partition a key fell into; staging freezes it.
    placed = stage(
        counted.repartitionByRange(buckets, *order).withColumn("__bucket", F.spark_partition_id()),
        "key-buckets",
    )
    totals = placed.groupBy("__bucket").agg(F.sum("key_rows").alias("__bucket_rows"))
    # At most `buckets` rows: a window over all of them and a broadcast are bounded.
    before = F.sum("__bucket_rows").over(Window.orderBy("__bucket").rowsBetween(*ahead))
    offsets = totals.select("__bucket", F.coalesce(before, F.lit(0)).alias("__offset"))
    inside = F.sum("key_rows").over(Window.partitionBy("__bucket").orderBy(*order).rowsBetween(*ahead))
    return (
        placed.withColumn("__inside", F.coalesce(inside, F.lit(0)))
        .join(F.broadcast(offsets), "__bucket")
        .select(*keys, "key_rows", (F.col("__offset") + F.col("__inside")).alias("rows_before"))
    )


def global_rank(
    df: DataFrame,
    keys: Sequence[str],
    name: str,
    descending: bool = True,
    staged: bool = False,
    buckets: int | None = None,
) -> DataFrame:
    """``rank()`` over the whole relation, added as column ``name``.

    The input is staged (unless the caller has done so): key counts and ranks
    both read it.  rank = 1 + rows with a key strictly ahead.
    """
    table = df if staged else stage(df, "to-rank")
    places = running_counts(table, keys, descending, buckets).select(
        *[F.col(k).alias(f"__rank_{k}") for k in keys],
        (F.col("rows_before") + 1).alias(name),
    )
    same = [F.col(k).eqNullSafe(F.col(f"__rank_{k}")) for k in keys]
    return table.join(places, same, "inner").select(*table.columns, name)


def is_whole(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.IntegralType) or (isinstance(dtype, T.DecimalType) and dtype.scale == 0)


def grand_total(df: DataFrame, column: str) -> Column:
    """The sum of a column of whole numbers (as DECIMAL) or of DOUBLE over the relation, as a scalar subquery."""
    kind = "decimal(38,0)" if is_whole(df.schema[column].dataType) else "double"
    return df.agg(F.sum(F.col(column).cast(kind))).scalar()


def share_of_total(df: DataFrame, column: str, name: str, digits: int = 1, staged: bool = False) -> DataFrame:
    """Add 100 · column / total, rounded, without a window over all rows.

    The input is staged (unless the caller has done so): total and shares both read it, and what it was computed from
    is read once.  Shares of DECIMAL are exact whatever the size of the total, which is summed as a wide number and
    read; a total of zero gives NULL.  DOUBLE is summed and divided as DOUBLE.
    """
    table = df if staged else stage(df, "to-share")
    dtype = table.schema[column].dataType
    if isinstance(dtype, T.DecimalType) and dtype.scale:
        found = table.agg(wide_sum(column).alias("total"), F.min(column).alias("low"), F.max(column).alias("high")).first()
        largest = max(abs(int(found[end] or 0)) + 1 for end in ("low", "high"))
        return table.withColumn(name, ratio_to(column, wide_units(found["total"]), 100, digits, largest * UNIT))
    return table.withColumn(name, percent_rounded(column, grand_total(table, column), digits))


def top_k(df: DataFrame, measure: str, tie_break: Sequence[str], k: int) -> DataFrame:
    """The ``k`` largest by a measure; ties go to the lowest tie-break values."""
    return df.orderBy(F.col(measure).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tie_break]).limit(k)
