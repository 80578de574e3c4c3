import itertools
import random
from collections import Counter, defaultdict
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from opslens import operators as op
from opslens.operators import network, selection


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def hot(spark):
    """3,000 rows, a third of them on one key; values repeat and some are NULL."""
    rng = random.Random(5)
    data = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else f"k{rng.randrange(200)}"
        value = None if rng.random() < 0.02 else (7 if rng.random() < 0.4 else rng.randrange(500))
        data.append((i, key, value, rng.choice(["a", "b", None])))
    return spark.createDataFrame(data, "id bigint, key string, value bigint, tag string").repartition(6).cache()


def test_reject_incomplete(spark):
    df = spark.createDataFrame([("a", "x"), ("", "x"), (" ", "x"), ("a", " "), ("a", None), (None, "x")], "c string, n string")
    kept = op.reject_incomplete(df, ["c", "n"], not_empty=["c"], not_blank=["n"])
    assert rows(kept) == [(" ", "x"), ("a", "x")]


def test_dedup_first_keeps_the_first_and_cuts_before_the_exchange(hot):
    kept = op.dedup_first(hot, ["key", "tag"], ["id"])
    best = {}
    for r in hot.collect():
        k = (r["key"], r["tag"])
        if k not in best or r["id"] < best[k]:
            best[k] = r["id"]
    assert {(r["key"], r["tag"]): r["id"] for r in kept.collect()} == best
    assert kept.columns == hot.columns
    text = plan(kept)
    assert "WindowGroupLimit" in text and "Partial" in text


def test_ref_filter_does_not_multiply(spark, hot):
    dim = spark.createDataFrame([("hot", "on"), ("hot", "on"), ("k1", "off"), (None, "on")], "code string, state string")
    kept = op.ref_filter(hot, dim, {"key": "code"}, F.col("state") == "on")
    assert kept.count() == 1000 and kept.columns == hot.columns


def test_exact_dedup_and_null_subset(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "a"), (2, None)], "n int, s string")
    assert op.dedup_exact(df).count() == 3
    assert op.dedup_exact(df, ["s"]).count() == 2
    assert rows(op.drop_null_subset(df, ["n"])) == [(1, "a"), (1, "a"), (2, None)]
    assert op.distinct_groups(df, ["n", "s"]).count() == 3


def test_left_detail_equals_left_outer_join(spark, hot):
    parent = spark.createDataFrame([("hot", 1), ("k1", 2), ("none", 3), (None, 4)], "key string, p int")
    detail = hot.select("key", "id", "value")
    want = parent.join(detail, "key", "left").select("key", "p", "id", "value")
    assert rows(op.left_detail(parent, detail, "key")) == rows(want)


def test_full_merge(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2)], "k string, x bigint")
    right = spark.createDataFrame([("b", 5), ("c", 6)], "k string, y bigint")
    assert rows(op.full_merge(left, right, ["k"])) == [("a", 1, 0), ("b", 2, 5), ("c", 0, 6)]
    assert rows(op.full_merge(left, right, ["k"], fill=None))[0] == ("a", 1, None)


@pytest.mark.parametrize("keys", [["value"], ["value", "tag"], ["key"]])
@pytest.mark.parametrize("descending", [True, False])
def test_distributed_rank_equals_rank(hot, keys, descending):
    order = [F.col(k).desc_nulls_first() if descending else F.col(k).asc_nulls_last() for k in keys]
    want = hot.withColumn("r", F.rank().over(Window.orderBy(*order)).cast("bigint"))
    small = op.global_rank(hot, keys, "r", descending, buckets=1)
    large = op.global_rank(hot, keys, "r", descending, buckets=7)
    assert rows(small) == rows(want)
    assert rows(large) == rows(want)


def test_running_counts(hot):
    values = sorted(r["value"] for r in hot.collect() if r["value"] is not None)
    got = op.running_counts(hot.filter("value is not null"), ["value"], buckets=4)
    counts = Counter(values)
    seen = 0
    want = {}
    for value in sorted(counts):
        want[value] = (counts[value], seen)
        seen += counts[value]
    assert {r["value"]: (r["key_rows"], r["rows_before"]) for r in got.collect()} == want


def test_share_of_total_sums_to_all(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", None)], "k string, x bigint")
    got = {r["k"]: r["pct"] for r in op.share_of_total(df, "x", "pct").collect()}
    assert (float(got["a"]), float(got["b"]), got["c"]) == (33.3, 66.7, None)
    assert "CartesianProduct" not in plan(op.share_of_total(df, "x", "pct"))


def test_top_k_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("d", 1), ("b", 1), ("a", 3), ("c", 1)], "k string, x bigint")
    assert [r["k"] for r in op.top_k(df, "x", ["k"], 3).collect()] == ["a", "b", "c"]


def test_value_share_leaves_null_out(hot):
    got = [(r["tag"], r["n"], float(r["pct"])) for r in op.value_share(hot, "tag").collect()]
    counts = Counter(r["tag"] for r in hot.collect() if r["tag"])
    whole = sum(counts.values())
    assert got == [(t, n, round(100 * n / whole, 1)) for t, n in counts.most_common()]


def test_pivot_fill(spark):
    data = [("x", "Low", 2), ("x", "High", 1), ("y", "odd", 5), (None, "Low", 1), ("x", None, 9), ("z", "Low", None)]
    df = spark.createDataFrame(data, "k string, s string, n bigint")
    fixed = op.pivot_fill(df, ["k"], "s", F.col("n"), ["Low", "Medium", "High"])
    assert fixed.columns == ["k", "Low", "Medium", "High"]
    assert rows(fixed) == [("x", 2, 0, 1), ("y", 0, 0, 0), ("z", 0, 0, 0)]
    found = op.pivot_fill(df, ["k"], "s", F.col("n"))
    assert found.columns == ["k", "High", "Low", "odd"]


@pytest.mark.parametrize("values", [[25, 150, 45, 45, 30, 70, 30], [4, 4, 4], [1.5, 2.25, 9.75, 3.0], list(range(100))])
def test_histogram_equals_numpy(spark, values):
    df = spark.createDataFrame([(float(x),) for x in values] + [(None,)], "x double")
    counts, edges = np.histogram(values, bins=8)
    got = op.histogram(df, "x", 8).orderBy("bin").collect()
    assert [r["n"] for r in got] == counts.tolist()
    assert np.allclose([r["lo"] for r in got] + [got[-1]["hi"]], edges)


def test_histogram_of_nothing_is_empty(spark):
    assert op.histogram(spark.createDataFrame([(None,)], "x double"), "x", 8).count() == 0


@pytest.mark.parametrize("size", [1, 2, 7, 100])
def test_distribution_stats(spark, size):
    rng = random.Random(size)
    values = [rng.randrange(20) for _ in range(size)]
    df = spark.createDataFrame([(x,) for x in values] + [(None,)], "x bigint")
    got = op.distribution_stats(df, "x").first()
    assert float(got["mean"]) == pytest.approx(np.mean(values))
    assert (got["median"], got["max"]) == (float(np.median(values)), max(values))


def test_distribution_stats_of_nothing(spark):
    got = op.distribution_stats(spark.createDataFrame([(None,)], "x bigint"), "x").first()
    assert tuple(got) == (None, None, None)


def test_null_census(spark):
    df = spark.createDataFrame([(1, None, None), (2, "a", None)], "a int, b string, c string")
    assert rows(op.null_census(df)) == [("b", 1), ("c", 2)]


def brute_force_levels(nodes, edges, root, hops):
    out = set()
    paths = [(root,)] if root in nodes else []
    for level in range(hops + 1):
        out |= {(level, p[-1], root) for p in paths}
        paths = [p + (d,) for p in paths for s, d in edges if s == p[-1] and d in nodes and d not in p]
    return out


@pytest.mark.parametrize("seed", range(4))
def test_hop_network_equals_all_paths(spark, seed):
    rng = random.Random(seed)
    nodes = [f"v{i}" for i in range(6)]
    edges = [(rng.choice([*nodes, "gone"]), rng.choice([*nodes, "gone", None])) for _ in range(18)]
    hops = 1 + seed % 4
    nodes_df = spark.createDataFrame([(n,) for n in nodes], "code string")
    edges_df = spark.createDataFrame(edges, "o string, d string")
    got = op.hop_network(nodes_df, edges_df, "v0", hops, "code", "o", "d")
    assert {tuple(r) for r in got.collect()} == brute_force_levels(set(nodes), set(edges), "v0", hops)
    assert got.count() == got.distinct().count()


@pytest.mark.parametrize("seed", range(3))
def test_hop_network_of_five_hops(spark, seed):
    rng = random.Random(50 + seed)
    nodes = [f"v{i}" for i in range(9)]
    edges = [(rng.choice(nodes), rng.choice(nodes)) for _ in range((14, 22, 40)[seed])]
    got = op.hop_network(
        spark.createDataFrame([(n,) for n in nodes], "code string"), spark.createDataFrame(edges, "o string, d string"),
        "v0", 5, "code", "o", "d",
    )
    assert {tuple(r) for r in got.collect()} == brute_force_levels(set(nodes), set(edges), "v0", 5)


@pytest.mark.parametrize(("size", "hops_left"), [(1, 3), (2, 2), (3, 1), (2, 0)])
def test_representatives_stand_for_all_sets(spark, size, hops_left):
    """Whatever vertices follow, if one set allows them a kept set does; few are kept of very many."""
    names = [f"v{i}" for i in range(8)]
    rng = random.Random(size * 10 + hops_left)
    every = [list(c) for c in itertools.combinations(names, size)]
    sets = [("x", s) for s in every] + [("y", s) for s in rng.sample(every, min(4, len(every)))]
    kept = defaultdict(list)
    for r in network.representatives(spark.createDataFrame(sets, "vertex string, between array<string>"), hops_left).collect():
        kept[r.vertex].append(set(r.between))
    for vertex in "xy":
        mine = [set(s) for v, s in sets if v == vertex]
        assert all(k in mine for k in kept[vertex])
        assert len(kept[vertex]) <= network.state_bound(size + 1, size + 1 + hops_left)
        for follow in itertools.combinations(names, hops_left):
            assert any(s.isdisjoint(follow) for s in mine) == any(s.isdisjoint(follow) for s in kept[vertex])


def test_hop_network_is_not_shortest_distance(spark):
    nodes = spark.createDataFrame([("a",), ("b",), ("c",)], "code string")
    edges = spark.createDataFrame([("a", "b"), ("a", "c"), ("b", "c"), ("a", "b")], "o string, d string")
    got = op.hop_network(nodes, edges, "a", 2, "code", "o", "d")
    assert rows(got) == [(0, "a", "a"), (1, "b", "a"), (1, "c", "a"), (2, "c", "a")]


def test_hop_network_unknown_root(spark):
    nodes = spark.createDataFrame([("a",)], "code string")
    edges = spark.createDataFrame([("x", "a")], "o string, d string")
    assert op.hop_network(nodes, edges, "x", 2, "code", "o", "d").count() == 0


def test_no_python_in_plans(hot):
    for df in (
        op.dedup_first(hot, ["key"], ["id"]),
        op.value_share(hot, "tag"),
        op.null_census(hot),
        op.global_rank(hot, ["value"], "r"),
    ):
        assert not any(word in plan(df) for word in ("PythonUDF", "MapInPandas", "ArrowEvalPython"))


def test_rank_sends_no_rows_to_one_task(hot):
    """Only the bucket totals may go through a single partition."""
    text = plan(op.global_rank(hot, ["value"], "r"))
    singles = [line for line in text.splitlines() if "SinglePartition" in line]
    assert len(singles) <= 1
    for line in itertools.islice(singles, 1):
        assert "Exchange" in line


def test_fractions_keep_their_digits(spark):
    values = ["0.4", "0.4", "0.4", "1.4"]
    for dtype in ("decimal(5,2)", "decimal(38,20)", "double"):
        df = spark.createDataFrame([(v,) for v in values], "x string").select(F.col("x").cast(dtype).alias("x"))
        stats = op.distribution_stats(df, "x").first()
        assert (round(float(stats["mean"]), 9), float(stats["median"]), float(stats["max"])) == (0.65, 0.4, 1.4)
        assert sorted(float(r["pct"]) for r in op.share_of_total(df, "x", "pct").collect()) == [15.4] * 3 + [53.8]
    large = spark.range(40).select(F.lit(9 * 10**18).alias("x"))  # a sum above 1e20
    assert float(op.distribution_stats(large, "x").first()["mean"]) == 9e18
    assert {float(r["pct"]) for r in op.share_of_total(large, "x", "pct").collect()} == {2.5}


def test_pivot_of_many_and_of_numbers(spark):
    df = spark.range(1500).select(F.lit("a").alias("k"), F.col("id").alias("c"))
    got = op.pivot_fill(df, ["k"], "c", F.lit(1))
    assert len(got.columns) == 1501 and "1499" in got.columns and got.first()["7"] == 1


def test_histogram_refuses_an_endless_range(spark):
    for bad in (float("nan"), float("inf")):
        with pytest.raises(ValueError):
            op.histogram(spark.createDataFrame([(1.0,), (bad,)], "x double"), "x", 4)


def test_hot_key_is_one_row_in_the_anti_join(spark):
    """The keys that the anti join gets are grouped before their exchange."""
    parent = spark.range(50).withColumnRenamed("id", "k")
    detail = spark.range(1000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 40).alias("k"), F.col("id").alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = op.left_detail(parent, detail, "k")
        text = plan(df)
        assert rows(df) == rows(parent.join(detail, "k", "left"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    anti = text[text.index("LeftAnti") :]
    assert anti.index("HashAggregate") < anti.rindex("Exchange")


@pytest.mark.parametrize(
    ("dtype", "values"),
    [
        ("bigint", [2**63 - 1, 2**63 - 2, -(2**63), 2**63 - 3, 0, 5, 5]),
        ("int", [7]),
        ("double", [1e308, -1e308, 1e-300, 2e-300, 5e-324, 0.0, float("inf"), float("-inf")]),
        ("double", [float("nan"), float("nan"), 1.0]),
        ("double", [float("inf"), float("-inf")]),
        ("decimal(38,18)", [Decimal("1e-18"), Decimal("2e-18"), Decimal("99999999999999999999"), Decimal("3e-18"), Decimal("-4")]),
        ("decimal(38,18)", [Decimal("99999999999999999999.000000000000000001"), Decimal("99999999999999999999.000000000000000003")]),
        ("decimal(10,2)", [Decimal("1.10"), Decimal("1.30"), None, Decimal("2.50"), Decimal("9.99")]),
        ("float", [0.5, 1.5, 1.5, 4.0]),
    ],
)
def test_median_by_counting(spark, dtype, values):
    df = spark.createDataFrame([(v,) for v in values * 3], f"x {dtype}").repartition(3)
    want = df.select(F.expr("median(x)")).first()[0]
    ordered = sorted((v for v in values * 3 if v is not None), key=lambda v: (v != v, v))
    middle = [float(ordered[(len(ordered) - 1) // 2]), float(ordered[len(ordered) // 2])]
    got = op.distribution_stats(df, "x").first()["median"]
    assert got == sum(middle) / 2 or got != got and sum(middle) != sum(middle)
    assert got != got or abs(got) > 1e300 or got == pytest.approx(float(want))


def test_median_moves_counts_only(spark, monkeypatch):
    """Many distinct values, few bins: several passes, equal to the sorted middle."""
    monkeypatch.setattr(selection, "BINS", 8)
    rng = random.Random(4)
    values = [rng.randrange(10**12) for _ in range(5001)]
    df = spark.createDataFrame([(v,) for v in values], "x bigint")
    assert selection.median(df, "x") == sorted(values)[2500]
    assert selection.median(df.limit(0), "x") is None
    assert tuple(op.distribution_stats(df.limit(0), "x").first()) == (None, None, None)
