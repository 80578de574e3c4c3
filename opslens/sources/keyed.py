"""Facts stored by key, so that grouping and joining on that key needs no exchange.

A keyed table is bucketed Parquet: rows of one key are in one bucket, and two tables of the same number of buckets
line up.  The exchange is paid once, when the table is stored, instead of once per report.

A bucket is read by one task, which Spark cannot split.  So keys of more rows than an average bucket are stored apart,
as plain Parquet that is read in splits of even size.  There are fewer such keys than buckets, whatever the data: that
bounds what is broadcast to tell them apart.

Cases: rows without a key are rows of the key NULL, which may be a hot one; joins drop them as any equality join does.
An empty table has an empty even part and no hot one.  Repeated rows are kept.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslens.sources.staging import catalogued, new_path, stage

#: Below this number of rows a key is never stored apart.
LEAST_HOT = 10_000
#: Keys are counted in so many slots first; only keys of slots that are hot as a whole are counted one by one.
SLOTS = 1 << 16


@dataclass(frozen=True)
class KeyedTable:
    """Rows of frequent keys in ``hot`` (None: there are none), all others in ``even``, which is bucketed by ``key``."""

    key: str
    even: DataFrame
    hot: DataFrame | None = None

    @property
    def rows(self) -> DataFrame:
        return self.even if self.hot is None else self.even.unionByName(self.hot)


def _bucketed(df: DataFrame, key: str, label: str, buckets: int, placed: bool = False) -> DataFrame:
    spark = df.sparkSession
    path, name = new_path(spark, label), f"default.opslens_{uuid.uuid4().hex}"
    # Partitioned as the buckets are, so that a bucket is one file.
    dealt = df if placed else df.repartition(buckets, F.col(key))
    dealt.write.format("parquet").bucketBy(buckets, key).option("path", path).saveAsTable(name)
    catalogued(path, name)
    return spark.table(name)


def store_keyed(
    df: DataFrame, key: str, label: str, buckets: int | None = None, unique: bool = False, stored: bool = False,
    least_hot: int = LEAST_HOT, placed: bool = False,
) -> KeyedTable:
    """Store ``df`` by ``key`` in ``buckets`` (the session's shuffle partitions by default).

    ``unique`` tells that no key repeats: rows then go to their buckets without being counted.  ``stored`` tells that
    ``df`` is read from a stored table with little work, and need not be stored before it is read more than once.
    ``placed`` tells that ``df`` was grouped by ``key`` alone, so its rows lie in the buckets of the session's shuffle
    partitions already and are written where they lie; a wrong word costs files, not rows.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    if unique:
        return KeyedTable(key, _bucketed(df, key, label, buckets, placed))
    landed = df if stored else stage(df, f"landed-{label}")
    limit = max(landed.count() / buckets, least_hot)
    slot = F.pmod(F.xxhash64(key), F.lit(SLOTS))
    slots = landed.groupBy(slot.alias("slot")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > limit)
    # Fewer than ``buckets``, as each has more rows than the table has per bucket.
    crowded = [row["slot"] for row in slots.collect()]
    if not crowded:
        return KeyedTable(key, _bucketed(landed, key, label, buckets))
    # One row per key and task reaches the exchange.
    counts = landed.filter(slot.isin(crowded)).groupBy(F.col(key).alias("_hot")).agg(F.count(F.lit(1)).alias("n"))
    hot_keys = stage(counts.filter(F.col("n") > limit).select("_hot"), f"hot-keys-{label}")
    if hot_keys.isEmpty():
        return KeyedTable(key, _bucketed(landed, key, label, buckets))
    # Fewer than ``buckets`` rows: each key has more rows than the table has per bucket.
    same = landed[key].eqNullSafe(F.col("_hot"))
    even = landed.join(F.broadcast(hot_keys), same, "left_anti")
    hot = landed.join(F.broadcast(hot_keys), same, "left_semi")
    return KeyedTable(key, _bucketed(even, key, label, buckets), stage(hot, f"{label}-hot"))


def per_key(facts: DataFrame | KeyedTable, key: str, *aggregates: Column, also: tuple[str, ...] = ()) -> KeyedTable:
    """Aggregates per ``key`` and the columns ``also``.  Of a table keyed by ``key``, even keys are grouped in place."""
    if not isinstance(facts, KeyedTable):
        return KeyedTable(key, facts.groupBy(key, *also).agg(*aggregates))
    if facts.key != key:
        return KeyedTable(key, facts.rows.groupBy(key, *also).agg(*aggregates))
    even = facts.even.groupBy(key, *also).agg(*aggregates)
    hot = None if facts.hot is None else facts.hot.groupBy(key, *also).agg(*aggregates)
    return KeyedTable(key, even, hot)


def with_groups(parents: DataFrame, groups: KeyedTable, how: str = "inner") -> DataFrame:
    """``parents`` joined with what ``per_key`` found for them; with ``how`` = "right" groups without a parent stay.

    Parents that are stored in as many buckets meet the even groups in place, without an exchange.
    """
    if how not in ("inner", "right"):
        raise ValueError("how must be inner or right")
    found = parents.join(groups.even, groups.key, how)
    if groups.hot is None:
        return found
    # Parents are cut to those of hot keys first, by the bounded list of these keys.
    theirs = parents.join(F.broadcast(groups.hot.select(groups.key).distinct()), groups.key, "left_semi")
    few = theirs.join(groups.hot, groups.key, how)
    return found.unionByName(few)
