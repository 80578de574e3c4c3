"""Facts stored by key: the same results as plain tables, no exchange of facts, hot keys apart."""

import re

import pytest
from pyspark.sql import functions as F

from opslens.plans import reports, summaries
from opslens.sources import per_key, release, staging, store_keyed, with_groups


def aggregates():
    return [F.count(F.lit(1)).alias("n"), F.sum("v").alias("v"), F.min("word").alias("word")]


@pytest.fixture
def facts(spark):
    """A third on key 7, a sixth without a key, the rest spread; some keys have no parent."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 6 == 1, None).otherwise(F.col("id") % 401)
    return spark.range(6000).select(key.cast("long").alias("k"), F.col("id").alias("v"), F.hex("id").alias("word"))


@pytest.fixture
def parents(spark):
    return spark.range(0, 390).select(F.col("id").alias("k"), (F.col("id") * 2).alias("p"))


@pytest.fixture
def no_broadcast(spark):
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    yield
    spark.conf.set(limit, before)


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def exchanges(df):
    """Keys that rows are exchanged by, in the plan as it is first made."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange (\w+\([^()]*?)#", plan)


def test_hot_keys_are_apart(spark, facts):
    table = store_keyed(facts, "k", "facts", buckets=8, least_hot=500)
    assert rows(table.rows) == rows(facts)
    assert {r[0] for r in table.hot.select("k").distinct().collect()} == {7, None}
    files = table.even.groupBy(F.input_file_name()).count().collect()
    assert len(files) == 8 and max(r[1] for r in files) < 2 * 3000 / 8


def test_even_tables_have_no_hot_part(spark, facts):
    assert store_keyed(facts, "k", "facts", buckets=8).hot is None  # too small for any
    assert store_keyed(facts.filter("k != 7"), "k", "facts", buckets=8, least_hot=0).hot is None


@pytest.mark.parametrize("least_hot", [0, 500, 10**9])
@pytest.mark.parametrize("how", ["inner", "right"])
def test_same_as_plain(spark, facts, parents, how, least_hot):
    table = store_keyed(facts, "k", "facts", buckets=8, least_hot=least_hot)
    stored = store_keyed(parents, "k", "parents", buckets=8, unique=True).rows
    want = rows(parents.join(facts.groupBy("k").agg(*aggregates()), "k", how))
    assert rows(with_groups(stored, per_key(table, "k", *aggregates()), how)) == want
    assert rows(with_groups(parents, per_key(facts, "k", *aggregates()), how)) == want
    also = facts.withColumn("word", F.col("word").substr(-1, 1))
    wide = store_keyed(also, "k", "facts", buckets=8, least_hot=least_hot)
    want = rows(parents.join(also.groupBy("k", "word").agg(F.sum("v").alias("v")), "k", how))
    assert rows(with_groups(stored, per_key(wide, "k", F.sum("v").alias("v"), also=("word",)), how)) == want


def test_another_key_groups_all_rows(spark, facts):
    table = store_keyed(facts, "k", "facts", buckets=8, least_hot=500)
    by_word = per_key(table, "word", F.count(F.lit(1)).alias("n"))
    assert by_word.hot is None and by_word.even.count() == 6000


def test_empty(spark, facts, parents):
    table = store_keyed(facts.limit(0), "k", "facts", buckets=8)
    assert table.hot is None and table.rows.count() == 0
    assert with_groups(parents, per_key(table, "k", *aggregates())).count() == 0


def test_other_joins_are_refused(parents, facts):
    with pytest.raises(ValueError, match="how"):
        with_groups(parents, per_key(facts, "k", *aggregates()), "left")


def test_grouping_and_joining_exchange_nothing(spark, facts, parents, no_broadcast):
    table = store_keyed(facts.filter("k != 7"), "k", "facts", buckets=8)
    stored = store_keyed(parents, "k", "parents", buckets=8, unique=True).rows
    assert exchanges(with_groups(stored, per_key(table, "k", *aggregates()))) == []
    assert exchanges(with_groups(parents, per_key(facts, "k", *aggregates())))  # what it saves


def test_reports_do_not_exchange_facts(spark, no_broadcast):
    from opslens.workload.tables import Warehouse

    w = Warehouse(spark, "/root/testdata/sf0.001")
    airlines, flights = w.cleaned("airlines", "flights")
    found = [
        reports.carrier_revenue(airlines, flights, w.keyed("passengers")),
        summaries.revenue_pivot(w.keyed("passengers"), flights, airlines),
        reports.safety_matrix(w.keyed("incidents"), flights, airlines),
    ]
    for df in found:
        assert not [e for e in exchanges(df) if "flight_id" in e]
    plain = reports.carrier_revenue(airlines, flights, w.keyed("passengers").rows.filter("flight_id > -1"))
    assert rows(found[0]) == rows(plain)


def test_release_drops_the_table(spark, facts):
    before = {t.name for t in spark.catalog.listTables()}
    others = {path.rsplit("/", 1)[1] for path in staging._MADE[spark.sparkContext.applicationId]}
    store_keyed(facts, "k", "gone", buckets=4, unique=True)
    assert len({t.name for t in spark.catalog.listTables()} - before) == 1
    assert release(spark, keep=tuple(others)) == 1
    assert {t.name for t in spark.catalog.listTables()} == before


def test_keys_are_counted_one_by_one_only_where_many_rows_meet(spark, tmp_path):
    """An even table leaves no table of key counts, a hot key and NULL are found as before."""
    app = spark.sparkContext.applicationId
    even = spark.range(30_000).select(F.col("id").alias("key"), F.lit(1).alias("x"))
    before = len(staging._MADE.get(app, []))
    stored = store_keyed(even, "key", "even-keys", buckets=4, least_hot=500)
    made = [path.rsplit("/", 1)[1] for path in staging._MADE[app][before:]]
    assert stored.hot is None and stored.rows.count() == 30_000 and not [m for m in made if m.startswith("hot-keys")]
    skewed = even.withColumn("key", F.when(F.col("key") < 9_000, F.lit(7)).when(F.col("key") < 18_000, None).otherwise(F.col("key")))
    stored = store_keyed(skewed, "key", "skewed-keys", buckets=4, least_hot=500)
    assert {r.key: r.n for r in stored.hot.groupBy("key").agg(F.count(F.lit(1)).alias("n")).collect()} == {7: 9_000, None: 9_000}
    assert stored.even.count() == 12_000
