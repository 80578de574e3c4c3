"""Exact distinct counts that can be merged.

Several distinct counts in one aggregate copy every row once per count.  Here each distinct value gets a number, and
the values of a group are kept as sets of numbers, one row per group and 32,768 numbers: a list where few are set, a
bitmap otherwise, so a row has 4 KB at most.  Sets roll up to any coarser grouping without the rows they were made of.
Numbers, not sets, are what a hot group shuffles, and no group and bucket has more than 32,768 of them in one task.

As in COUNT(DISTINCT a, b), a value with a NULL part does not count.  Groups may have NULL keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslens.sources.staging import stage

#: Numbers of a row that are kept as a list; a bitmap has the size of 1,024.
FEW = 512

_NUMBER = "__number"
_ALL = "__all"


def number_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The distinct values of the columns that have no NULL part, each with a number as ``__number``.

    Numbers follow each other within a task from the start of a bucket of its own, so each task leaves one bucket that
    is not full; writing the table fixes them.
    """
    filled = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    values = df.filter(filled).select(*columns).distinct()
    return stage(values.withColumn(_NUMBER, F.monotonically_increasing_id() + 1), "numbers")


def _packed(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sets from rows of (keys, bucket, position, bits), of which position or bits is NULL; one row of bits per set at most."""
    group = [*keys, "bucket"]
    # A task sends one list per set.  Over many groups most sets are a few numbers: only larger ones become bitmaps, since
    # an aggregate of bitmaps keeps 4 KB for every group, also where it finds nothing.
    listed = cells.groupBy(*group).agg(
        F.collect_set("position").alias("few"), F.first("bits", ignorenulls=True).alias("bits")
    )
    # A bitmap that came in has more than FEW numbers, so a small set is whole in its list.
    small = F.col("bits").isNull() & (F.size("few") <= FEW)
    none = F.lit(None).cast("binary")
    lists = listed.filter(small).select(*group, F.size("few").cast("bigint").alias("n"), "few", none.alias("bits"))
    one_by_one = F.transform("few", lambda p: F.struct(p.alias("position"), none.alias("bits")))
    came = F.array(F.struct(F.lit(None).cast("bigint").alias("position"), F.col("bits")))
    # All of this runs where the rows are: both branches read the one exchange above.
    both = (
        listed.filter(~small)
        .select(*group, F.inline(F.concat(one_by_one, came)))
        .groupBy(*group)
        .agg(F.array(F.bitmap_construct_agg("position"), F.bitmap_or_agg("bits")).alias("parts"))
    )
    whole = both.select(*group, F.explode("parts").alias("bits")).groupBy(*group).agg(F.bitmap_or_agg("bits").alias("bits"))
    bitmaps = whole.select(*group, F.bitmap_count("bits").alias("n"), F.lit(None).cast("array<bigint>").alias("few"), "bits")
    return bitmaps.unionByName(lists)


def value_sets(df: DataFrame, keys: Sequence[str], columns: Sequence[str], numbers: DataFrame | None = None) -> DataFrame:
    """Per group and bucket the set of its values: keys, bucket, n, few, bits.

    Sets can be merged with others made with the same ``numbers`` (by default those of ``df`` itself, which is then read
    twice).  A group without values has no row.
    """
    numbers = number_values(df, columns) if numbers is None else numbers
    theirs = numbers.select(*[F.col(c).alias(f"__value_{c}") for c in columns], _NUMBER)
    same = [F.col(c) == F.col(f"__value_{c}") for c in columns]
    # Few values are broadcast, and rows are cut to one list per set and task before any exchange; of many values the fact
    # leads the join, so a hot value is split.
    found = df.select(*dict.fromkeys([*keys, *columns])).join(theirs, same)
    cells = found.select(
        *keys,
        F.bitmap_bucket_number(_NUMBER).alias("bucket"),
        F.bitmap_bit_position(_NUMBER).alias("position"),
        F.lit(None).cast("binary").alias("bits"),
    )
    return _packed(cells, keys)


def merge_sets(sets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The sets of a coarser grouping, by ``keys`` out of those of ``sets``.  All sets of a table, with no keys, are one."""
    group = [*keys, "bucket"]
    few = sets.filter("bits IS NULL").select(*group, F.explode("few").alias("position"))
    many = sets.filter("bits IS NOT NULL").groupBy(*group).agg(F.bitmap_or_agg("bits").alias("bits"))
    cells = few.withColumn("bits", F.lit(None).cast("binary")).unionByName(
        many.withColumn("position", F.lit(None).cast("bigint")).select(*few.columns, "bits")
    )
    return _packed(cells, keys)


def set_counts(sets: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """keys and ``name``, the number of distinct values of each group of ``sets``; ``keys`` are all of its keys."""
    return sets.groupBy(*keys).agg(F.sum("n").alias(name))


def distinct_counts(df: DataFrame, levels: Sequence[Sequence[str]], counts: Mapping[str, Sequence[str]]) -> DataFrame:
    """Distinct counts of several column sets at several levels of grouping, as GROUPING SETS has them.

    ``levels`` lists groupings; the first has the columns of all others, which are rolled up from its sets, each from
    the level before it where that has its columns.  One row per group of each level: the columns of the first level
    (NULL where a level lacks one), ``level`` (place in the list) and a count per name, 0 where a group has no value.
    No rows give no groups, but for a level without columns, which is one row always.
    """
    finest = list(levels[0])
    if any(set(level) - set(finest) for level in levels):
        raise ValueError("the first level must have the columns of all levels")
    finer = [None] + [
        next(k for k in range(place - 1, -1, -1) if set(level) <= set(levels[k])) for place, level in enumerate(levels[1:], 1)
    ]
    needed = dict.fromkeys([*finest, *[c for columns in counts.values() for c in columns]])
    # Read once for the groups, and for each count by its numbers and its sets.  Each of these cuts repeated rows itself.
    table = stage(df.select(*needed), "to-count")
    every = stage(table.select(*finest).distinct(), "groups") if finest else table
    known: dict[str, list[DataFrame]] = {}
    for name, columns in counts.items():
        known[name] = []
        for place, level in enumerate(levels):
            sets = merge_sets(known[name][finer[place]], level) if place else value_sets(table, finest, columns)
            # Only what is read again is written.
            known[name].append(stage(sets, "sets") if place in finer else sets)
    rows = []
    for place, level in enumerate(levels):
        level = list(level)
        # A level without columns is a group of its own constant, and there even without rows.
        key = level or [_ALL]
        groups = every.select(*level).distinct() if level else table.sparkSession.range(1).select(F.lit(0).alias(_ALL))
        for name in counts:
            sets = known[name][place] if level else known[name][place].withColumn(_ALL, F.lit(0))
            own = set_counts(sets, key, name).select(*[F.col(k).alias(f"__{k}") for k in key], name)
            groups = groups.join(own, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in key], "left").select(*groups.columns, name)
        rows.append(
            groups.select(
                *[(F.col(c) if c in level else F.lit(None).cast(table.schema[c].dataType)).alias(c) for c in finest],
                F.lit(place).alias("level"),
                *[F.coalesce(name, F.lit(0).cast("bigint")).alias(name) for name in counts],
            )
        )
    return reduce(DataFrame.unionByName, rows)
