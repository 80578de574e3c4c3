"""Distinct counts by bitmaps against plain sets."""

import random

import pytest

from opslens.operators import bitmaps as bm

SCHEMA = "a string, b long, x long, y string"


def rows(n, values, seed=0):
    rng = random.Random(seed)
    pick = lambda options: rng.choice([None, *options])
    return [
        # A third of all rows are of one group.
        ("hot" if rng.random() < 0.34 else pick("pqr"), pick([1, 2]), rng.choice([None, rng.randrange(values)]), pick("uvw"))
        for _ in range(n)
    ]


def brute(data, keys, columns):
    at = [SCHEMA.replace(",", "").split()[::2].index(c) for c in columns]
    key_at = [SCHEMA.replace(",", "").split()[::2].index(k) for k in keys]
    found = {}
    for row in data:
        own = found.setdefault(tuple(row[i] for i in key_at), set())
        if all(row[i] is not None for i in at):
            own.add(tuple(row[i] for i in at))
    return {k: len(v) for k, v in found.items()}


LEVELS = [["a", "b"], ["a"], ["b"], []]


@pytest.mark.parametrize(("n", "values", "few"), [(300, 40, 512), (3000, 2000, 100), (3000, 2000, 0)])
def test_counts_equal_sets(spark, monkeypatch, n, values, few):
    """Lists alone, lists and bitmaps, bitmaps alone."""
    monkeypatch.setattr(bm, "FEW", few)
    data = rows(n, values)
    df = spark.createDataFrame(data + data[:20], SCHEMA)
    got = bm.distinct_counts(df, LEVELS, {"xs": ["x"], "pairs": ["x", "y"], "bs": ["b"]}).collect()
    for place, level in enumerate(LEVELS):
        mine = [r for r in got if r["level"] == place]
        for name, columns in {"xs": ["x"], "pairs": ["x", "y"], "bs": ["b"]}.items():
            want = brute(data, level, columns)
            assert {tuple(r[c] for c in level): r[name] for r in mine} == want
            assert len(mine) == len(want)
        assert all(r[c] is None for r in mine for c in {"a", "b"} - set(level))


def test_sets_over_many_buckets(spark):
    """Numbers beyond 32,768 make further rows, of at most 4 KB."""
    df = spark.range(100_000).selectExpr("id % 7 AS a", "id * 3 AS x").unionAll(spark.range(10).selectExpr("7L AS a", "id * 30000 AS x"))
    sets = bm.value_sets(df, ["a"], ["x"]).persist()
    assert {r.a: r.n for r in bm.set_counts(sets, ["a"], "n").collect()} == {a: 14286 if a < 5 else 14285 for a in range(7)} | {7: 10}
    assert sets.filter("n > 512 AND (bits IS NULL OR few IS NOT NULL OR bitmap_count(bits) != n)").count() == 0
    assert sets.filter("n <= 512 AND (bits IS NOT NULL OR size(few) != n)").count() == 0
    assert sets.filter("bits IS NOT NULL").count() > 0 and sets.filter("a = 7 AND bits IS NOT NULL").count() == 0
    assert sets.selectExpr("max(length(bits)) AS m").first().m == 4096
    # The list of group 7 falls into the bitmaps of the others.
    whole = bm.merge_sets(sets, [])
    assert whole.selectExpr("sum(n) AS n").first().n == 100_000 and whole.count() >= 4
    assert whole.groupBy("bucket").count().filter("count > 1").count() == 0
    sets.unpersist()


def test_sets_of_two_tables_merge(spark):
    """Yesterday's and today's sets, made apart with the same numbers."""
    old, new = spark.range(0, 900).selectExpr("id % 2 AS a", "id AS x"), spark.range(600, 1500).selectExpr("id % 2 AS a", "id AS x")
    numbers = bm.number_values(old.unionAll(new), ["x"])
    both = bm.value_sets(old, ["a"], ["x"], numbers).unionAll(bm.value_sets(new, ["a"], ["x"], numbers))
    merged = bm.merge_sets(both, ["a"])
    assert {r.a: r.n for r in bm.set_counts(merged, ["a"], "n").collect()} == {0: 750, 1: 750}


def test_nothing_to_count(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert [r.asDict() for r in bm.distinct_counts(empty, [["a"], []], {"xs": ["x"]}).collect()] == [{"a": None, "level": 1, "xs": 0}]
    nulls = spark.createDataFrame([(None, None, None, None), ("p", None, None, None)], SCHEMA)
    got = bm.distinct_counts(nulls, [["a"]], {"xs": ["x"]}).collect()
    assert sorted((r.a or "", r.xs) for r in got) == [("", 0), ("p", 0)]
    with pytest.raises(ValueError, match="first level"):
        bm.distinct_counts(nulls, [["a"], ["b"]], {"xs": ["x"]})


def test_rows_are_not_expanded(spark):
    df = spark.createDataFrame(rows(50, 9), SCHEMA)
    plan = bm.distinct_counts(df, LEVELS, {"xs": ["x"], "pairs": ["x", "y"]})._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "CartesianProduct" not in plan
    # Sets are built after the exchange of numbers, with no exchange of bitmaps.
    plan = bm.value_sets(df, ["a"], ["x"])._jdf.queryExecution().executedPlan().toString()
    assert "bitmap" in plan.split("Exchange hashpartitioning(a")[0] and "bitmap_construct" not in plan.split("Exchange hashpartitioning(a")[1]


def test_small_sets_are_never_bitmaps(spark):
    """An aggregate of lists and bitmaps kept 4 KB for every group of one value, and sorted them."""
    df = spark.range(3000).selectExpr("id % 1000 AS a", "id AS x").unionAll(spark.range(2000).selectExpr("-1L AS a", "id AS x"))
    numbers = bm.number_values(df, ["x"])
    sets = bm.value_sets(df, ["a"], ["x"], numbers)
    merged = bm.merge_sets(sets, ["a"])
    for made in (sets, merged):
        assert {r.a: r.n for r in bm.set_counts(made, ["a"], "n").collect()} == {a: 3 for a in range(1000)} | {-1: 2000}
        made.collect()
        plan = made._jdf.queryExecution().executedPlan().toString()
        lists = [line for line in plan.splitlines() if "collect_set" in line]
        assert lists and not any("bitmap_construct" in line or "bitmap_or" in line for line in lists)
        # Lists and bitmaps are made of one exchange.
        assert "ReusedExchange" in plan
