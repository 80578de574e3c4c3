"""Tagged rows against plain Python: reasons, copies, references, hot keys and NULLs."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from opslens.operators.ledger import kept_rows, reject_ledger, tag_reference, tag_rows

SCHEMA = "id long, code string, place long, link string"


def rules():
    return [("no code", F.col("code").isNull()), ("odd code", F.col("code") == "?")]


def tag(df, dims):
    tagged = tag_rows(df, rules(), df.columns, ["code"], ["place", "id"])
    return tag_reference(tagged, dims, {"link": "name"}, "unknown", F.col("open") == 1, "closed")


def expected(rows, dims):
    """Reasons in the order of the rules, copies before references; kept ids."""
    dims = [d for d in dims if d[0] is not None]  # NULL is equal to nothing
    known, opened = {d[0] for d in dims}, {d[0] for d in dims if d[1] == 1}
    reasons, first = Counter(), {}
    for row in rows:
        if row[1] is None or row[1] == "?":
            reasons["no code" if row[1] is None else "odd code"] += 1
            continue
        place = (row[2] is None, row[2] or 0, row[0])
        if row[1] not in first or place < first[row[1]][0]:
            first[row[1]] = place, row
        reasons["duplicate"] += 1
    kept = set()
    for _, row in first.values():
        reasons["duplicate"] -= 1
        why = "kept" if row[3] in opened else "closed" if row[3] in known else "unknown"
        reasons[why] += 1
        if why == "kept":
            kept.add(row)
    return {k: n for k, n in reasons.items() if n}, kept


@pytest.mark.parametrize("seed", range(4))
def test_random_tables(spark, seed):
    draw = random.Random(seed)
    dims = [("a", 1), ("b", 0), ("c", 1), ("c", 0), ("d", None), (None, 1)]
    rows = []
    for i in range(600):
        # A third of the rows has one code.
        code = "hot" if draw.random() < 0.33 else draw.choice([None, "?", *map(str, range(120))])
        rows.append((i, code, draw.choice([None, 1, 2, 3]), draw.choice(["a", "b", "c", "d", "e", None])))
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    tagged = tag(df, spark.createDataFrame(dims, "name string, open int"))
    reasons, kept = expected(rows, dims)
    assert {r.reason: r.n_rows for r in reject_ledger(tagged).collect()} == reasons
    got = kept_rows(tagged)
    assert got.columns == df.columns and {tuple(r) for r in got.collect()} == kept
    assert sum(reasons.values()) == len(rows)


def test_rows_without_keys_are_no_copies(spark):
    df = spark.createDataFrame([(1, "x", 1, "a"), (1, "x", 1, "a"), (2, None, 1, "a")], SCHEMA)
    tagged = tag_rows(df, rules(), df.columns)
    assert {tuple(r) for r in reject_ledger(tagged).collect()} == {("kept", 2), ("no code", 1)}
    assert kept_rows(tagged).count() == 2


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    tagged = tag(df, spark.createDataFrame([], "name string, open int"))
    assert reject_ledger(tagged).count() == 0 and kept_rows(tagged).count() == 0


def test_rejected_rows_and_copies_are_merged_before_the_exchange(spark):
    """Of a hot key, and of a reason, a task sends one row."""
    df = spark.range(0, 10_000, 1, 5).select(
        F.col("id"), F.when(F.col("id") % 2 == 0, "hot").alias("code"), F.col("id").alias("place"), F.lit("a").alias("link")
    )
    tagged = tag_rows(df, rules(), df.columns, ["code"], ["place"])
    plan = tagged._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_min_by") > plan.index("Exchange")  # below it, printed from the top
    assert {tuple(r) for r in reject_ledger(tagged).collect()} == {("kept", 1), ("duplicate", 4999), ("no code", 5000)}
