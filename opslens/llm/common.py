"""What the operators share: tables, word patterns, slices of Arrow batches."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from opslens.sources.staging import new_path, stage

__all__ = ["WORD", "SPACES", "batch_slices", "hash_sample", "importable", "new_path", "named", "stage", "table"]

#: A word: what stands between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def importable(spark: SparkSession) -> None:
    """Let Python workers of this machine import the library from where the driver did.

    On a cluster it is installed on the executors or sent with ``--py-files``."""
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, paths]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the driver's, in a session that splits hot keys of joins even for one more exchange."""
    importable(spark)
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def named(df: DataFrame, **columns: str) -> DataFrame:
    """Only these columns, under the operator's own names: others cannot clash with what it adds."""
    return df.select(*[df[f"`{theirs}`"].alias(ours) for ours, theirs in columns.items()])


def hash_sample(rows: DataFrame, size: int, *key: str) -> list[Row]:
    """At most ``size`` rows, those of the lowest hashes of ``key``, ties by the key itself.

    Rows are counted first and cut to little more than wanted by their hash, so that what all tasks together send
    does not grow with their number.
    """
    total = rows.count()
    share = min(1.0, (size + 6 * size**0.5 + 50) / max(total, 1))
    place = F.pmod(F.xxhash64(*key), F.lit(1 << 32))
    some = rows.filter(place < F.lit(int(share * (1 << 32)))) if share < 1 else rows
    return some.orderBy(place, *key).limit(size).collect()


def batch_slices(batch: pa.RecordBatch, column: str, limit: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Slices of a batch that hold about ``limit`` bytes of ``column``, or one longer text."""
    texts = batch.column(column)
    sizes = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(batch):
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(at, stop - at)
        at = stop
