import datetime
import os

import pytest
from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from opslens import functions as fx
from opslens import sources as io
from opslens.sources import commits, staging

ROWS = [
    (1, " padded ", 'say "hi", ok', "line\nbreak", None, datetime.datetime(2024, 1, 1, 0, 0, 7, 179575)),
    (2, "", "back\\slash", "comma, here", "None", None),
    (3, None, "é → ü", "'", "N/A", datetime.datetime(1999, 12, 31, 23, 59)),
]
SCHEMA = "id bigint, a string, b string, c string, d string, t timestamp_ntz"


@pytest.fixture
def df(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def same(df, rows=ROWS):
    return sorted((tuple(r) for r in df.collect()), key=str) == sorted(rows, key=str)


def test_csv_round_trip_keeps_blanks_nulls_quotes_and_line_breaks(spark, df, tmp_path):
    io.write_csv(df, f"{tmp_path}/t")
    assert same(io.read_csv(spark, f"{tmp_path}/t", df.schema))


def test_cached_load_reads_the_source_once(spark, df, tmp_path):
    asked = []

    def source(name):
        asked.append(name)
        return df

    schemas = {"one": df.schema, "two": df.schema}
    first = io.load_tables(spark, schemas, f"{tmp_path}/cache", source)
    second = io.load_tables(spark, schemas, f"{tmp_path}/cache", source)
    assert asked == ["one", "two"]
    assert all(same(t) for t in (*first.values(), *second.values()))


def test_cached_load_needs_every_file(spark, df, tmp_path):
    io.write_csv(df, f"{tmp_path}/one.csv")
    asked = []
    schemas = {"one": df.schema, "two": df.schema}
    io.load_tables(spark, schemas, str(tmp_path), lambda name: asked.append(name) or df)
    assert asked == ["one", "two"]


def test_folder_of_a_failed_write_is_not_a_cache(spark, df, tmp_path):
    (tmp_path / "one.csv").mkdir()
    loaded = io.load_tables(spark, {"one": df.schema}, str(tmp_path), lambda name: df)
    assert same(loaded["one"])


def test_one_plain_file_is_a_cache(spark, tmp_path):
    (tmp_path / "one.csv").write_text('id,a\n1,x\n2,""\n3,\n')
    loaded = io.load_tables(spark, {"one": "id bigint, a string"}, str(tmp_path), lambda name: pytest.fail(name))
    assert same(loaded["one"], [(1, "x"), (2, ""), (3, None)])


def test_header_must_fit_the_schema(spark, tmp_path):
    (tmp_path / "one.csv").write_text("a,id\nx,1\n")
    with pytest.raises((PySparkException, Py4JError), match="CSV header"):
        io.read_csv(spark, f"{tmp_path}/one.csv", "id string, a string").collect()


def test_append_and_replace(spark, df, tmp_path):
    path = f"{tmp_path}/table"
    io.append_rows(df, path)
    io.append_rows(df, path)
    assert io.read_parquet(spark, path).count() == 6
    assert same(io.replace_table(df, path))
    assert same(io.replace_table(df, path))


def test_load_profile_and_preview(spark, df):
    got = {tuple(r) for r in io.load_profile({"x": df, "y": df.limit(1).select("a")}).collect()}
    assert got == {("x", 3, 6), ("y", 1, 1)}
    assert [r["id"] for r in io.preview(df, [df.id.desc()], 2).collect()] == [3, 2]


def test_partitioned_database_read_needs_bounds(spark):
    with pytest.raises(ValueError):
        io.read_database(spark, "jdbc:none", "t", partition_column="id")


def test_stage_writes_below_the_shared_folder(spark, df):
    staged = io.stage(df, "label")
    assert same(staged) and staged.schema == df.schema
    shared = spark.conf.get("spark.checkpoint.dir", None)
    assert shared is None or all(shared in f for f in staged.inputFiles())


def test_no_machine_local_folder_on_a_cluster(monkeypatch):
    class Context:
        applicationId, master = "app", "yarn"

    class Conf:
        value = None

        def get(self, key, default=None):
            return self.value

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError):
        staging.staging_root(Session())
    Conf.value = "s3a://shared/ckpt/"
    assert staging.staging_root(Session()) == "s3a://shared/ckpt/opslens/app"


def test_release_leaves_no_folder_but_those_to_keep(spark, df, tmp_path):
    staging.release(spark, keep=("raw-", "clean-"))
    root = staging.staging_root(spark).removeprefix("file:")
    folders = lambda: set(os.listdir(root)) if os.path.isdir(root) else set()
    before = folders()
    for label in ("one", "two", "clean-three"):
        assert io.stage(df, label).count() == 3
    assert len(folders() - before) == 3
    assert staging.release(spark, keep=("raw-", "clean-")) == 2
    (kept,) = folders() - before
    assert kept.startswith("clean-three")
    assert staging.release(spark, keep=("raw-", "clean-")) == 0


def test_unfinished_folder_is_built_anew(spark, df, tmp_path):
    io.write_csv(df, f"{tmp_path}/one.csv")
    (tmp_path / "one.csv" / "_SUCCESS").unlink()
    asked = []
    loaded = io.load_tables(spark, {"one": df.schema}, str(tmp_path), lambda name: asked.append(name) or df)
    assert asked == ["one"] and same(loaded["one"])


def test_large_csv_is_split_without_line_breaks(spark, tmp_path):
    (tmp_path / "one.csv").write_text("id,a\n" + "".join(f"{i},text {i}\n" for i in range(20_000)))
    schema = "id bigint, a string"
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        whole = io.read_csv(spark, f"{tmp_path}/one.csv", schema)
        split = io.read_csv(spark, f"{tmp_path}/one.csv", schema, multi_line=False)
        assert whole.rdd.getNumPartitions() == 1 and split.rdd.getNumPartitions() > 4
        assert sorted(split.collect()) == sorted(whole.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_decimal_beyond_the_type_is_told(texts):
    values = ["1234.56789", "9999999999999999.5", "1" * 21, "0." + "1" * 19, "0.10000000000000000000", "-" + "1" * 20, "x", None, "0." + "1" * 18]
    assert texts(fx.beyond_decimal("c", signed=True), values) == [False, False, True, True, False, False, False, False, False]
    got = texts(fx.parse_decimal("c", signed=True), values[:3])
    assert [None if v is None else format(v.normalize(), "f") for v in got] == ["1234.56789", "9999999999999999.5", None]


def failing(df):
    return df.withColumn("a", F.when(F.col("id") >= 0, F.raise_error(F.lit("stop"))).cast("string"))


def test_failed_rebuild_leaves_the_old_table(spark, df, tmp_path):
    path = str(tmp_path / "t")
    io.replace_table(df, path)
    before = io.read_parquet(spark, path)
    with pytest.raises(Exception, match="stop"):
        io.replace_table(failing(df), path)
    with pytest.raises(Exception, match="stop"):
        io.append_rows(failing(df), path)
    assert same(io.read_parquet(spark, path)) and same(before)
    assert io.vacuum_table(spark, path) == 2 and same(io.read_parquet(spark, path))


def test_table_is_rebuilt_from_itself(spark, df, tmp_path):
    path = str(tmp_path / "t")
    io.append_rows(df, path)
    old = io.read_parquet(spark, path)
    io.replace_table(old.unionByName(old), path)
    assert old.count() == 3 and io.read_parquet(spark, path).count() == 6
    assert io.vacuum_table(spark, path) == 1 and io.read_parquet(spark, path).count() == 6


def test_repeated_batch_adds_rows_once(spark, df, tmp_path):
    path = str(tmp_path / "t")
    assert io.append_rows(df, path, "day 1") and not io.append_rows(df, path, "day 1")
    assert io.append_rows(df, path, "day 2/ü") and not io.append_rows(df, path, "day 2/ü")
    assert io.read_parquet(spark, path).count() == 6
    io.replace_table(df, path)
    assert not io.append_rows(df, path, "day 1") and same(io.read_parquet(spark, path))


def test_a_batch_committed_by_two_runs_counts_once(spark, df, tmp_path):
    path = str(tmp_path / "t")
    log = commits.CommitLog(spark, path)
    folders = [log.new_folder() for _ in range(2)]
    for folder in folders:  # both runs saw a table without the batch
        df.write.parquet(f"{path}/{folder}")
    for folder in folders:
        log.commit("append", folder, "day 1")
    assert same(io.read_parquet(spark, path))


def test_foreign_files_are_not_taken_for_a_table(spark, df, tmp_path):
    df.write.parquet(str(tmp_path / "t"))
    with pytest.raises(ValueError, match="not committed"):
        io.append_rows(df, str(tmp_path / "t"))
    assert same(io.read_parquet(spark, str(tmp_path / "t")))


def test_cache_never_mixes_two_builds(spark, df, tmp_path):
    """A build that fails after its first table leaves the old set; the next load takes that, whole."""
    schemas, cache = {"one": df.schema, "two": df.schema}, str(tmp_path / "cache")
    with pytest.raises(Exception, match="stop"):
        io.load_tables(spark, schemas, cache, lambda name: failing(df) if name == "two" else df)
    asked = []
    loaded = io.load_tables(spark, schemas, cache, lambda name: asked.append(name) or df)
    assert asked == ["one", "two"] and same(loaded["one"]) and same(loaded["two"])
    wider = {**schemas, "three": df.schema}
    with pytest.raises(Exception, match="stop"):
        io.load_tables(spark, wider, cache, lambda name: failing(df) if name == "three" else df.limit(1))
    again = io.load_tables(spark, schemas, cache, lambda name: pytest.fail(name))
    assert same(again["one"]) and same(again["two"])
