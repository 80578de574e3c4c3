"""Join shapes used by the reports.

No join is forced to broadcast: dimensions here may grow with the data, so
Spark decides from their size, before and during the run.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def look_up(
    fact: DataFrame,
    dimension: DataFrame,
    on: Mapping[str, str],
    columns: Mapping[str, str],
    how: str = "inner",
) -> DataFrame:
    """Add dimension columns to a fact.

    ``on`` maps fact column to dimension key, ``columns`` maps dimension column
    to its name in the result, so one dimension can be joined in two roles.
    """
    picked = dimension.select(
        *[F.col(theirs).alias(ours) for ours, theirs in on.items()],
        *[F.col(theirs).alias(ours) for theirs, ours in columns.items()],
    )
    return fact.join(picked, list(on), how).select(*fact.columns, *columns.values())


def left_detail(parent: DataFrame, detail: DataFrame, key: str) -> DataFrame:
    """Every parent with its details, or with NULLs where it has none.

    Same rows as a left outer join from a parent unique on ``key``.  In a left
    outer join Spark cannot split the detail side, so one parent holding a
    third of the details would land in one task; an inner join led by the
    detail side can be split, and the parents without details are added.
    """
    matched = detail.join(parent, key, "inner")
    # Distinct keys on the right, cut to one row per key and task before the exchange: a hot key is one row there.
    lonely = parent.join(detail.select(key).distinct(), key, "left_anti")
    extra = [f for f in detail.schema.fields if f.name != key]
    filled = lonely.withColumns({f.name: F.lit(None).cast(f.dataType) for f in extra})
    names = [key, *[c for c in parent.columns if c != key], *[f.name for f in extra]]
    return matched.select(*names).unionByName(filled.select(*names))


def full_merge(left: DataFrame, right: DataFrame, on: Sequence[str], fill: int | None = 0) -> DataFrame:
    """Full outer join on shared key names; missing measures become ``fill``."""
    merged = left.join(right, list(on), "full_outer")
    if fill is None:
        return merged
    measures = [c for c in merged.columns if c not in on]
    return merged.na.fill(fill, subset=measures)
