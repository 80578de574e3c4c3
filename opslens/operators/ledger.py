"""Why rows go: every row is tagged with the first rule it fails, and the tags add up to a ledger.

The rules of a cleaning pipeline run in one order: tests of the row itself, then repeated rows, then references to other
tables.  ``tag_rows`` applies the first two in one aggregation, ``tag_reference`` adds a reference.  What they return is
written once; kept rows and ledger are both read from there, so they cannot disagree.

A row that fails a test of its own is only counted: all such rows are one row per reason and task before the exchange.
A key of a third of all rows is one row per task as well, with the number of its copies.

Cases: a test that is NULL does not fail.  NULL keys form a group.  An empty table has an empty ledger.  Names that
begin with two underscores are the operator's own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A reason, and the test that is true for rows it rejects.
Rule = tuple[str, Column]
KEPT, DUPLICATE = "kept", "duplicate"
_REASON, _ROWS, _COPIES = "__reason", "__rows", "__copies"


def tag_rows(
    df: DataFrame,
    rules: Sequence[Rule],
    columns: Sequence[str],
    keys: Sequence[Column | str] | None = None,
    order: Sequence[str] = (),
) -> DataFrame:
    """``columns`` of the first row of each key by ``order`` (NULL last), with the number of its further copies.

    Rows that fail a rule take no part in that, and stand as one row per reason.  Without ``keys`` no row is a copy.
    """
    reason = F.coalesce(F.lit(None).cast("string"), *[F.when(fails, F.lit(name)) for name, fails in rules])
    fine = F.col(_REASON).isNull()
    if keys is None:
        return df.select(reason.alias(_REASON), F.lit(1).cast("long").alias(_ROWS), F.lit(0).cast("long").alias(_COPIES), *columns)
    names = [f"__key{i}" for i in range(len(keys))]
    places = [f(F.col(c)) for c in order for f in (F.isnull, lambda c: c)]
    # A column that is a key is carried once: the rows that are sorted and exchanged here are the widest of a build.
    known = {k: F.col(n) for k, n in zip(keys, names, strict=True) if isinstance(k, str)}
    carried = [c for c in columns if c not in known] or list(columns)
    row = [known.get(c, F.col("__row")[c]).alias(c) for c in columns]
    tagged = df.select(
        reason.alias(_REASON),
        *[(F.col(k) if isinstance(k, str) else k).alias(n) for k, n in zip(keys, names, strict=True)],
        F.struct(*carried).alias("__row"),
        F.struct(*[p.alias(f"p{i}") for i, p in enumerate(places)]).alias("__place"),
    ).withColumns({n: F.when(fine, F.col(n)) for n in [*names, "__row"]})
    # Without rules the groups are those of the keys alone, so their rows lie by these keys afterwards.
    group = [_REASON, *names] if rules else names
    groups = tagged.groupBy(*group).agg(
        F.count(F.lit(1)).alias("__n"), F.min_by("__row", "__place").alias("__row")
    )
    if not rules:
        return groups.select(
            reason.alias(_REASON),
            F.lit(1).cast("long").alias(_ROWS),
            (F.col("__n") - 1).cast("long").alias(_COPIES),
            *row,
        )
    return groups.select(
        _REASON,
        F.when(fine, F.lit(1)).otherwise(F.col("__n")).cast("long").alias(_ROWS),
        F.when(fine, F.col("__n") - 1).otherwise(0).cast("long").alias(_COPIES),
        *row,
    )


def tag_reference(
    tagged: DataFrame,
    dimension: DataFrame,
    on: Mapping[str, str],
    missing: str,
    where: Column | None = None,
    refused: str | None = None,
    tag: str = _REASON,
) -> DataFrame:
    """Tag rows whose key is not in a dimension as ``missing``, and where no row of that key meets ``where`` as ``refused``.

    The dimension is cut to a row per key first, so the join multiplies nothing; its left side can be split.  ``tag`` is
    the column of tags, which a row keeps that has one.
    """
    fits = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    keys = dimension.select(*[F.col(theirs).alias(ours) for ours, theirs in on.items()], fits.alias("__fits"))
    joined = tagged.join(keys.groupBy(*on).agg(F.max("__fits").alias("__fits")), list(on), "left")
    why = F.when(F.col("__fits").isNull(), F.lit(missing)).when(~F.col("__fits"), F.lit(refused or missing))
    return joined.withColumn(tag, F.coalesce(tag, why)).select(*tagged.columns)


def kept_rows(tagged: DataFrame) -> DataFrame:
    """Rows that failed no rule, without their tags."""
    return tagged.filter(F.col(_REASON).isNull()).drop(_REASON, _ROWS, _COPIES)


def reject_ledger(tagged: DataFrame) -> DataFrame:
    """``(reason, n_rows)``: input rows by the first rule they failed, copies as ``duplicate``, others as ``kept``.

    The numbers add up to the rows that were tagged.
    """
    own = F.struct(F.coalesce(_REASON, F.lit(KEPT)).alias("reason"), F.col(_ROWS).alias("n"))
    copies = F.struct(F.lit(DUPLICATE).alias("reason"), F.col(_COPIES).alias("n"))
    entries = tagged.select(F.inline(F.array(own, copies))).filter("n > 0")
    return entries.groupBy("reason").agg(F.sum("n").alias("n_rows"))
