"""Readers, writers and the cached load."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opslens.sources.commits import CommitLog

# Doubled quotes inside quoted fields, blanks kept, line breaks allowed inside
# fields, microseconds written: what goes out comes back unchanged.
_CSV_COMMON = {
    "header": "true",
    "escape": '"',
    "nullValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


# Written "" is an empty text and nothing at all is NULL.  The reader would take
# both for NULL, so it is told to spell the empty text in a way no source does.
_EMPTY_TEXT = "\ue000empty\ue000"


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet file or folder, or a table that ``append_rows`` and ``replace_table`` have committed."""
    return spark.read.parquet(*(CommitLog(spark, path).current() or [path]))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, multi_line: bool = True) -> DataFrame:
    """CSV with a header and a declared schema.

    With ``multi_line`` fields may hold line breaks and a file is one task, which
    is why ``write_csv`` bounds the size of its files.  Without, a file is split
    among tasks: for large files whose fields hold none.  A header that does not
    fit the schema fails the read instead of shifting columns.
    """
    options = {
        **_CSV_COMMON,
        "emptyValue": _EMPTY_TEXT,
        "multiLine": str(multi_line).lower(),
        "mode": "FAILFAST",
        "enforceSchema": "false",
    }
    df = spark.read.schema(schema).options(**options).csv(path)
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.when(F.col(c) == _EMPTY_TEXT, F.lit("")).otherwise(F.col(c)) for c in texts})


def write_csv(df: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """CSV with a header, replacing what is there."""
    df.write.mode("overwrite").options(**_CSV_COMMON).option("maxRecordsPerFile", rows_per_file).csv(path)


def read_database(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int = 1,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """A database table over JDBC, split into range reads when a column is given."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    reader = reader.options(**dict(properties or {}))
    if partition_column is not None:
        if bounds is None:
            raise ValueError("a partitioned read needs bounds")
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(bounds[0]))
            .option("upperBound", str(bounds[1]))
            .option("numPartitions", str(partitions))
        )
    return reader.load()


def append_rows(df: DataFrame, path: str, batch: str | None = None) -> bool:
    """Add rows to a committed table, creating it on first use; whether they were added.

    A ``batch`` that the table has is not added again, so a job may be repeated.  Without one every call adds.  Readers
    see all rows of a call or none.
    """
    log = CommitLog(df.sparkSession, path)
    if batch is not None and log.holds(batch):
        return False
    folder = log.new_folder()
    df.write.parquet(f"{log.path}/{folder}")
    log.commit("append", folder, batch)
    return True


def replace_table(df: DataFrame, path: str) -> DataFrame:
    """Rebuild a committed table from a query, which may read the table itself, and return the stored table.

    A build that fails leaves the old rows; so do readers that began before.  ``vacuum_table`` deletes old folders.
    """
    log = CommitLog(df.sparkSession, path)
    folder = log.new_folder()
    df.write.parquet(f"{log.path}/{folder}")
    log.commit("replace", folder)
    return df.sparkSession.read.schema(df.schema).parquet(*log.current())


def vacuum_table(spark: SparkSession, path: str) -> int:
    """Delete what replaced and failed writes have left of a committed table; returns the number of folders."""
    return CommitLog(spark, path).vacuum()


def _read_cached(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame | None:
    """The cached table, or None if there is none; a folder counts only once its write has ended."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(place):
        return None
    if files.getFileStatus(place).isDirectory() and not files.exists(spark._jvm.org.apache.hadoop.fs.Path(place, "_SUCCESS")):
        return None
    return read_csv(spark, path, schema)


def load_tables(
    spark: SparkSession,
    schemas: Mapping[str, T.StructType | str],
    cache_dir: str,
    source: Callable[[str], DataFrame],
) -> dict[str, DataFrame]:
    """Tables from their CSV cache if all are there, else from ``source``.

    The cache is one committed folder of ``<name>.csv`` tables: all are written, then the folder is committed, so a
    load never mixes tables of two builds.  Without one, ``<name>.csv`` files or finished folders in ``cache_dir``
    itself count, if all are there.  Tables that come from ``source`` are read back from the new cache, so both ways
    return the same rows.
    """
    log = CommitLog(spark, cache_dir)
    for folder in [*log.current(), cache_dir]:
        cached = {name: _read_cached(spark, f"{folder}/{name}.csv", schema) for name, schema in schemas.items()}
        if all(df is not None for df in cached.values()):
            return cached
    folder = f"data-{uuid.uuid4().hex}"
    for name in schemas:
        write_csv(source(name), f"{log.path}/{folder}/{name}.csv")
    log.commit("replace", folder)
    return {name: read_csv(spark, f"{log.path}/{folder}/{name}.csv", schema) for name, schema in schemas.items()}


def load_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns of each table: ``(table_name, n_rows, n_cols)``."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).cast("bigint").alias("n_cols")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def preview(df: DataFrame, order: Iterable[Column | str], n: int = 5) -> DataFrame:
    """The first ``n`` rows in a stated order."""
    return df.orderBy(*order).limit(n)
