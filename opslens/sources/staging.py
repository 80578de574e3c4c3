"""Staged tables: results written once, read many times.

A staged table cuts lineage without tying the result to an executor: it is
Parquet in the folder the cluster names in ``spark.checkpoint.dir``, so a lost
executor costs a re-read, never a wrong or missing result, and every reader
still gets column pruning, filter pushdown and file sizes for join planning.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOT: dict[str, str] = {}
#: Folders made by this process, oldest first, by application.
_MADE: dict[str, list[str]] = {}
#: Names in the catalog of folders that are tables there.
_NAMES: dict[str, str] = {}


def staging_root(spark: SparkSession) -> str:
    """The shared folder of this application's staged tables.

    Without ``spark.checkpoint.dir`` only a single-machine session gets a
    folder of its own; on a cluster a machine-local folder would be lost with
    its machine, so that is refused.
    """
    app = spark.sparkContext.applicationId
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        if app not in _LOCAL_ROOT:
            _LOCAL_ROOT[app] = tempfile.mkdtemp(prefix="opslens-")
        shared = _LOCAL_ROOT[app]
    return f"{shared.rstrip('/')}/opslens/{app}"


def new_path(spark: SparkSession, label: str) -> str:
    path = f"{staging_root(spark)}/{label}-{uuid.uuid4().hex}"
    _MADE.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def catalogued(path: str, name: str) -> None:
    """Remember that the folder is a table of the catalog, which goes with the folder."""
    _NAMES[path] = name


def release(spark: SparkSession, keep: tuple[str, ...] = ()) -> int:
    """Delete the staged tables of this application and return how many folders went.

    Results that read them must be written before.  Labels that start with one
    of ``keep`` stay, for instance the cleaned tables that all reports share.
    """
    app, left, gone = spark.sparkContext.applicationId, [], 0
    for path in _MADE.pop(app, []):
        if keep and path.rsplit("/", 1)[1].startswith(keep):
            left.append(path)
            continue
        if path in _NAMES:
            spark.sql(f"DROP TABLE IF EXISTS {_NAMES.pop(path)}")
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        gone += place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    _MADE[app] = left
    return gone


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to a new staged table and return the table."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
