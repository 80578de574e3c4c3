"""Operators that keep or drop whole rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "__row_in_key"


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def reject_incomplete(
    df: DataFrame,
    required: Sequence[str],
    not_empty: Sequence[str] = (),
    not_blank: Sequence[str] = (),
) -> DataFrame:
    """Keep rows whose mandatory fields are there.

    ``not_empty`` refuses the empty text only, ``not_blank`` also refuses text
    made of spaces.  All of it is plain predicates and reaches the scan.
    """
    tests = [F.col(c).isNotNull() for c in required]
    tests += [F.col(c) != "" for c in not_empty]
    tests += [F.trim(F.col(c)) != "" for c in not_blank]
    return df.filter(_all(tests))


def drop_null_subset(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(columns))


def dedup_first(df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column | str]) -> DataFrame:
    """Keep the first row of each key in a stated order; NULL keys form a group.

    ``order`` must be total within a key.  The filter on the row number lets
    Spark cut every key to one row per input task before the exchange, so a
    key holding a third of all rows costs one row per task, not one huge group.
    """
    orders = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order]
    window = Window.partitionBy(*keys).orderBy(*orders)
    return df.withColumn(_RN, F.row_number().over(window)).filter(F.col(_RN) == 1).drop(_RN)


def dedup_exact(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows over the given columns (all of them by default)."""
    return (df if columns is None else df.select(*columns)).dropDuplicates()


def distinct_groups(df: DataFrame, columns: Sequence[Column | str]) -> DataFrame:
    """One row per combination of columns: grouping with nothing to aggregate."""
    return df.select(*columns).distinct()


def ref_filter(
    df: DataFrame,
    dimension: DataFrame,
    on: Mapping[str, str],
    where: Column | None = None,
) -> DataFrame:
    """Keep rows whose key exists in a dimension (among rows meeting ``where``).

    A semi join: it cannot multiply rows, needs nothing but the key column of
    the dimension, and its left side can be split when a key is hot.  Whether
    the keys are broadcast is left to their measured size.
    """
    if where is not None:
        dimension = dimension.filter(where)
    keys = dimension.select(*[F.col(theirs).alias(ours) for ours, theirs in on.items()])
    return df.join(keys, list(on), "left_semi").select(*df.columns)
