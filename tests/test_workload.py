"""Every registered query against DuckDB on the smallest tables."""

import datetime as dt
from decimal import Decimal
from pathlib import Path

import pytest
from compare import difference, duck, duck_rows, spark_rows

import __spark_entry__ as entry
from opslens.workload.oracle import all_oracle_sql
from opslens.sources import staging
from opslens.workload import tables
from opslens.workload.queries import all_queries
from opslens.workload.tables import Warehouse

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def heavy(spark, tmp_path_factory):
    """A thousand trips on one route, of a weight that passes BIGINT in all, and two that are rejected."""
    at, day = str(tmp_path_factory.mktemp("heavy")), dt.datetime(2023, 5, 1)
    for name in ("nation", "region"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{at}/{name}.parquet")
    lines = [(i, 2, 3 if i < 1000 else 4 if i == 1000 else 10, 1, 4.0, 1.0, day) for i in range(1002)]
    tables = {
        "supplier": ([(3, 2), (4, 24), (10, 2)], "s_suppkey long, s_nationkey int"),
        "customer": ([(0, 1)], "c_custkey long, c_nationkey int"),
        "orders": ([(i, 0, day) for i in range(1002)], "o_orderkey long, o_custkey long, o_orderdate timestamp"),
        "lineitem": (
            lines + lines[:7],
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
            "l_shipdate timestamp",
        ),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{at}/{name}.parquet")
    return at


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(all_queries()) == set(all_oracle_sql())
    assert set(all_queries()) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_sql(spark, con, name):
    got = spark_rows(entry.queries()[name](spark, SF))
    assert difference(got, duck_rows(con, entry.oracle_sql()[name])) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "route" and df.count() > 0


def test_dimensions_are_not_forced_into_memory(spark):
    """No broadcast hint: with broadcasting off every dimension join must shuffle."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("pipeline_trips", "enriched_trips", "carrier_revenue", "route_performance"):
            text = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" not in text and "NestedLoop" not in text, name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_totals_beyond_bigint_are_whole(spark, heavy):
    (row,) = entry.queries()["route_performance"](spark, heavy).collect()
    assert row.total_flights == 1000 and row.total_cargo_kg == Decimal(1000 * 9999999999999999 + 500)
    assert dict(entry.queries()["route_performance"](spark, SF).dtypes)["total_cargo_kg"] == "bigint"


def test_trips_are_stored_once(spark, heavy):
    """No copy of their raw texts or of their tagged rows, no second exchange, and not more files than buckets."""
    app = spark.sparkContext.applicationId
    w = Warehouse(spark, heavy)
    w.refresh()
    before = len(staging._MADE.get(app, []))
    assert w.clean("flights").count() == 1000
    reasons = {r.reason: r.n_rows for r in w.ledger("flights").collect()}
    assert reasons == {"kept": 1000, "duplicate": 7, "unknown destination": 1, "inactive carrier": 1}
    made = [path for path in staging._MADE[app][before:] if "flights" in path]
    assert [path.rsplit("/", 1)[1].rsplit("-", 1)[0] for path in made] == ["clean-flights", "clean-flights-ledger"]
    assert len(list(Path(made[0]).glob("*.parquet"))) <= int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_tasks_of_a_build_get_little_input(spark):
    Warehouse(spark, SF)
    for size in ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes"):
        assert spark.conf.get(size).lower() in ("16m", "16mb", str(16 << 20)), size


def test_tasks_that_tag_rows_stay_small(spark, monkeypatch):
    """What a tagging task sorts depends on neither the size of a file nor that of all tables."""
    keys = ["spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes"]
    before = {k: spark.conf.get(k) for k in keys}
    seen = []

    def watched(fn):
        def store(*args, **kwargs):
            label = next(a for a in args if isinstance(a, str) and "-" in a)
            seen.append((label, spark.conf.get(keys[1])))
            return fn(*args, **kwargs)

        return store

    monkeypatch.setattr(tables, "stage", watched(tables.stage))
    monkeypatch.setattr(tables, "store_keyed", watched(tables.store_keyed))
    monkeypatch.setattr(tables, "_BUILT", {})
    monkeypatch.setattr(tables, "_PARTITIONS", {})
    size = tables.source_bytes(spark, SF)
    monkeypatch.setattr(tables, "PARTITION_SOURCE", size // 13)
    try:
        w = Warehouse(spark, SF)
        assert int(spark.conf.get(keys[0])) == -(-size // (size // 13)) > int(before[keys[0]])
        for name in tables.TABLES:
            w.clean(name)
        tagging = {"tagged-airports", "tagged-airlines", "tagged-passengers", "tagged-incidents"}
        assert {label for label, split in seen if split == "4m"} == tagging | {"clean-flights"}
        assert [spark.conf.get(k) for k in keys[1:]] == ["16m", "16m"]
        assert w.ledger("passengers").agg({"n_rows": "sum"}).first()[0] == w.raw("passengers").count()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_sources_that_are_not_there_have_no_size(spark, tmp_path):
    assert tables.source_bytes(spark, str(tmp_path)) == 0
