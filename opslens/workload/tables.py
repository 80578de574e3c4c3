"""Raw and cleaned operational tables over one folder of driver tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from opslens.operators.ledger import kept_rows, reject_ledger
from opslens.plans import cleaning
from opslens.sources.keyed import KeyedTable, store_keyed
from opslens.sources.staging import stage
from opslens.workload.raw_views import FLIGHT_ORDER, PASSENGER_ORDER, raw_table

#: Facts, stored by the trip they belong to.
FACTS = ["flights", "passengers", "incidents"]
TABLES = ["airports", "airlines", "flights", "passengers", "incidents"]

#: Rows of the builds are sorted whole, and take some thirty times their compressed size: what Spark reads by default into
#: one task would be sorted on disk.  Stored tables are texts and numbers that repeat, so the denser codec is worth it.
SETTINGS = {
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.parquet.compression.codec": "zstd",
}

#: Tagging sorts every row that a task reads, so tasks read less there: by default what they read would grow with the table
#: up to the limit above, and a compressed megabyte of bookings or incidents is some 30 MB of sorted rows.
TAG_SETTINGS = {
    "spark.sql.files.maxPartitionBytes": "4m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
}

#: Bytes of the sources per shuffle partition, at most.  With a fixed number of partitions a task grows with the tables.
PARTITION_SOURCE = 16 << 20
#: Sources of the facts.
SOURCES = ["lineitem", "orders", "events"]

_BUILT: dict[tuple[str, str, str], DataFrame | KeyedTable] = {}
_PARTITIONS: dict[tuple[str, str], int] = {}


@contextmanager
def _settings(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """The session with these settings, and as it was afterwards."""
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def source_bytes(spark: SparkSession, sf_dir: str) -> int:
    """Size of the stored sources of the facts; one that is not there has none."""
    total = 0
    for name in SOURCES:
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
        files = place.getFileSystem(spark._jsc.hadoopConfiguration())
        if files.exists(place):
            total += files.getContentSummary(place).getLength()
    return total


class Warehouse:
    """Cleaned tables are built on first use, stored, and shared by all queries.

    Twelve reports read the same five tables, so each table is cleaned once per
    application and read back with only the columns a report needs.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        for key, value in SETTINGS.items():
            spark.conf.set(key, value)
        # Never fewer than the session has.  Facts of one folder are stored in as many buckets, so they still meet in place.
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in _PARTITIONS:
            _PARTITIONS[key] = -(-source_bytes(spark, sf_dir) // PARTITION_SOURCE)
        if _PARTITIONS[key] > int(spark.conf.get("spark.sql.shuffle.partitions")):
            spark.conf.set("spark.sql.shuffle.partitions", str(_PARTITIONS[key]))

    def raw(self, name: str) -> DataFrame:
        """A raw table, put together from its sources whenever it is read: storing texts costs more than joining again."""
        return raw_table(self.spark, self.sf_dir, name)

    def _stored(self, label: str, build: Callable[[], DataFrame], store: Callable = stage) -> DataFrame | KeyedTable:
        key = (self.spark.sparkContext.applicationId, self.sf_dir, label)
        if key not in _BUILT:
            _BUILT[key] = store(build(), label)
        return _BUILT[key]

    def pipeline(self, name: str) -> DataFrame:
        """The cleaning plan of a table, not yet stored."""
        raw = self.raw(name)
        if name == "airports":
            return cleaning.clean_airports(raw)
        if name == "airlines":
            return cleaning.clean_airlines(raw)
        if name == "flights":
            return cleaning.clean_flights(
                raw, self.clean("airlines"), self.clean("airports"), first_by=FLIGHT_ORDER
            )
        if name == "passengers":
            return cleaning.clean_passengers(raw, first_by=PASSENGER_ORDER)
        if name == "incidents":
            return cleaning.clean_incidents(raw, self.clean("flights"))
        raise KeyError(name)

    def tagged(self, name: str) -> cleaning.Tagged:
        """The raw rows of a table, tagged with why they go."""
        raw = self.raw(name)
        if name == "airports":
            return cleaning.tag_airports(raw)
        if name == "airlines":
            return cleaning.tag_airlines(raw)
        if name == "flights":
            return cleaning.tag_flights(raw, self.clean("airlines"), self.clean("airports"), first_by=FLIGHT_ORDER)
        if name == "passengers":
            return cleaning.tag_passengers(raw, first_by=PASSENGER_ORDER)
        if name == "incidents":
            return cleaning.tag_incidents(raw, self.clean("flights"))
        raise KeyError(name)

    def _kept(self, name: str) -> DataFrame:
        """The cleaned rows of a table, read from its tagged rows, which leave their ledger as well."""
        rows, columns = self.tagged(name)
        with _settings(self.spark, TAG_SETTINGS):
            rows = stage(rows, f"tagged-{name}")
        self._stored(f"clean-{name}-ledger", lambda: reject_ledger(rows))
        return kept_rows(rows).select(*columns)

    def _trips(self) -> KeyedTable:
        """Cleaned trips.  Tagged rows are grouped by trip, so they are stored by trip at once, and read without the rejects."""
        rows, columns = self.tagged("flights")
        with _settings(self.spark, TAG_SETTINGS):
            stored = store_keyed(rows, "flight_id", "clean-flights", unique=True, placed=True)
        self._stored("clean-flights-ledger", lambda: reject_ledger(stored.rows))
        return KeyedTable(stored.key, kept_rows(stored.rows).select(*columns))

    def ledger(self, name: str) -> DataFrame:
        """How many raw rows of a table were kept, and how many went for which reason."""
        self.clean(name)
        return _BUILT[self.spark.sparkContext.applicationId, self.sf_dir, f"clean-{name}-ledger"]

    def clean(self, name: str) -> DataFrame:
        """The stored cleaned table."""
        return self.keyed(name).rows if name in FACTS else self._stored(f"clean-{name}", lambda: self._kept(name))

    def keyed(self, name: str) -> KeyedTable:
        """The stored cleaned fact table, by trip."""

        def store(df: DataFrame, label: str) -> KeyedTable:
            return store_keyed(df, "flight_id", label, stored=True)

        if name == "flights":
            return self._stored("clean-flights", self._trips, lambda trips, _: trips)
        return self._stored(f"clean-{name}", lambda: self._kept(name), store)

    def cleaned(self, *names: str) -> list[DataFrame]:
        return [self.clean(n) for n in names]

    def refresh(self) -> None:
        """Forget the stored tables, for instance after the sources changed."""
        app = self.spark.sparkContext.applicationId
        for key in [k for k in _BUILT if k[:2] == (app, self.sf_dir)]:
            del _BUILT[key]
        _PARTITIONS.pop((app, self.sf_dir), None)
