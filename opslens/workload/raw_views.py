"""Raw operational tables derived from the driver tables.

nation → airports, supplier → airlines, lineitem → flights and passengers,
events → incidents.  The expressions spoil clean values in every way the
pipelines repair; they are written in SQL that Spark and DuckDB read alike, so
both sides of a comparison start from the same rows.  Every source row is used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Column expressions per raw table.  ``k`` is 0 for a first record, 1 for its repeat.
RAW_EXPRESSIONS: dict[str, dict[str, str]] = {
    "airports": {
        "airport_id": "CAST(n_nationkey * 10 + k AS BIGINT)",
        "iata_code": (
            "CASE WHEN n_nationkey = 24 THEN NULL WHEN n_nationkey = 22 AND k = 0 THEN '' "
            "WHEN k = 1 THEN lower(n_name) ELSE concat(' ', n_name) END"
        ),
        "airport_name": (
            "CASE WHEN n_nationkey = 23 OR (n_nationkey = 21 AND k = 0) THEN NULL "
            "WHEN k = 1 THEN concat(n_name, ' Airfield') ELSE concat('  ', n_name, ' Airport ') END"
        ),
        "city": "concat(lower(n_name), ' city ')",
        "province": "CASE WHEN n_nationkey = 20 THEN NULL ELSE lower(r_name) END",
        "latitude": (
            "CASE n_nationkey % 5 WHEN 0 THEN '-6.1256' WHEN 1 THEN '3.6' WHEN 2 THEN 'abc' WHEN 3 THEN '5.' ELSE NULL END"
        ),
        "longitude": "CASE n_nationkey % 4 WHEN 0 THEN '106.6559' WHEN 1 THEN '.5' WHEN 2 THEN '-6.123456789012' ELSE '1234.5' END",
        "elevation_ft": "CASE n_nationkey % 3 WHEN 0 THEN '34' WHEN 1 THEN '12.5' ELSE NULL END",
        "is_international": (
            "CASE n_nationkey % 7 WHEN 0 THEN 'yes' WHEN 1 THEN ' YES' WHEN 2 THEN '1' WHEN 3 THEN 'no' "
            "WHEN 4 THEN 'N/A' WHEN 5 THEN 'n' ELSE NULL END"
        ),
    },
    "airlines": {
        "airline_id": "s_suppkey * 2 + k",
        "iata_code": (
            "CASE WHEN s_suppkey % 50 = 49 THEN NULL WHEN k = 1 THEN concat('C', CAST(s_suppkey AS STRING)) "
            "ELSE concat(' c', CAST(s_suppkey AS STRING)) END"
        ),
        "airline_name": (
            "CASE WHEN s_suppkey % 33 = 32 THEN '  ' "
            "ELSE concat(' Carrier ', CAST(s_suppkey - s_suppkey % 2 AS STRING)) END"
        ),
        "alliance": "CASE s_suppkey % 3 WHEN 0 THEN 'Alpha' WHEN 1 THEN 'None' ELSE NULL END",
        "fleet_size": (
            "CASE s_suppkey % 5 WHEN 0 THEN '~120' WHEN 1 THEN 'about 15' WHEN 2 THEN '35' WHEN 3 THEN 'many' ELSE NULL END"
        ),
        "hub_airport": "concat('nation_', CAST(s_nationkey AS STRING), ' ')",
        "status": (
            "CASE WHEN k = 1 THEN 'inactive' WHEN s_suppkey % 10 = 0 THEN 'suspended' "
            "WHEN s_suppkey % 10 = 1 THEN 'ACTIVE' WHEN s_suppkey % 10 = 2 THEN ' active' ELSE 'active' END"
        ),
    },
    "flights": {
        "flight_id": "l_orderkey * 10 + l_linenumber",
        "flight_number": "concat(' c', CAST(l_suppkey AS STRING), '-', CAST(l_orderkey AS STRING))",
        "airline_iata": "concat(' c', CAST(l_suppkey AS STRING))",
        "origin_iata": "concat('nation_', CAST(c_nationkey AS STRING))",
        "destination_iata": "concat('NATION_', CAST(s_nationkey AS STRING), ' ')",
        "scheduled_dep": "concat(CAST(CAST(o_orderdate AS DATE) AS STRING), ' 06:00')",
        "scheduled_arr": "concat(CAST(CAST(o_orderdate AS DATE) AS STRING), ' 09:30')",
        "actual_dep": (
            "CASE WHEN l_partkey % 8 = 6 THEN NULL ELSE concat(CAST(CAST(o_orderdate AS DATE) AS STRING), ' 06:1', "
            "CAST(l_linenumber AS STRING)) END"
        ),
        "actual_arr": (
            "CASE WHEN l_partkey % 8 = 6 THEN NULL WHEN l_partkey % 11 = 0 THEN 'unknown' "
            "ELSE concat(CAST(CAST(l_shipdate AS DATE) AS STRING), ' 23:59') END"
        ),
        "delay_minutes": (
            "CASE l_partkey % 10 WHEN 0 THEN 'N/A' WHEN 1 THEN NULL WHEN 2 THEN '5.5' WHEN 3 THEN '99999999999' "
            "ELSE CAST(l_partkey % 200 - 20 AS STRING) END"
        ),
        "flight_status": (
            "CASE (l_partkey + l_suppkey) % 8 WHEN 0 THEN 'On Time' WHEN 1 THEN ' on time ' WHEN 2 THEN 'ONTIME' "
            "WHEN 3 THEN 'OT' WHEN 4 THEN 'Delayed' WHEN 5 THEN 'delay' WHEN 6 THEN 'Cancelled' ELSE NULL END"
        ),
        "aircraft_type": "concat('T', CAST(l_linenumber AS STRING))",
        "passengers_onboard": (
            "CASE WHEN l_partkey % 4 = 0 THEN concat(CAST(CAST(l_quantity AS INT) AS STRING), '.5') "
            "WHEN l_partkey % 4 = 1 THEN concat(CAST(CAST(l_quantity AS INT) AS STRING), '.4999999999999999999999') "
            "WHEN l_partkey % 4 = 2 THEN CAST(CAST(l_quantity AS INT) AS STRING) ELSE 'full' END"
        ),
        "cargo_kg": (
            "CASE WHEN l_partkey % 9 = 0 THEN '-1' WHEN l_partkey % 9 = 1 THEN concat(CAST(CAST(l_quantity AS INT) AS STRING), '.56789012345') "
            "WHEN l_partkey % 9 = 2 THEN '9999999999999999.5' ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING) END"
        ),
        "l_partkey": "l_partkey",
        "l_suppkey": "l_suppkey",
        "l_extendedprice": "l_extendedprice",
        "l_shipdate": "l_shipdate",
        "l_quantity": "l_quantity",
    },
    "passengers": {
        "passenger_id": "l_partkey",
        "flight_id": "CASE WHEN l_partkey % 41 = 0 THEN NULL ELSE l_orderkey * 10 + l_linenumber END",
        "full_name": (
            "CASE WHEN l_partkey % 37 = 0 THEN '   ' "
            "ELSE concat(' pax laki-laki o''neil ', CAST(l_partkey % 3 AS STRING), 'rd') END"
        ),
        "gender": (
            "CASE l_partkey % 7 WHEN 0 THEN 'L' WHEN 1 THEN 'Male' WHEN 2 THEN 'P' WHEN 3 THEN 'Female' "
            "WHEN 4 THEN ' male ' WHEN 5 THEN 'Laki-Laki' ELSE NULL END"
        ),
        "nationality": "CASE l_suppkey % 2 WHEN 0 THEN 'wni ' ELSE 'WNA' END",
        "ticket_class": (
            "CASE l_partkey % 6 WHEN 0 THEN 'ECO' WHEN 1 THEN 'Economy' WHEN 2 THEN 'BIZ' WHEN 3 THEN 'C' "
            "WHEN 4 THEN 'First' ELSE 'zzz' END"
        ),
        "ticket_price": (
            "CASE l_suppkey % 4 WHEN 0 THEN concat('Rp ', CAST(CAST(l_quantity AS INT) AS STRING), '.000') "
            "WHEN 1 THEN concat(CAST(CAST(l_quantity AS INT) AS STRING), ',000') "
            "WHEN 2 THEN concat('rp', CAST(CAST(l_quantity AS INT) AS STRING), '000') ELSE 'free' END"
        ),
        "booking_date": (
            "CASE WHEN l_suppkey % 17 = 0 THEN 'soon' ELSE concat('2023-09-1', CAST(l_suppkey % 2 AS STRING)) END"
        ),
        "frequent_flyer": "CASE l_partkey % 4 WHEN 0 THEN 'YES' WHEN 1 THEN 'no' WHEN 2 THEN '1' ELSE NULL END",
        "l_suppkey": "l_suppkey",
        "l_quantity": "l_quantity",
    },
    "incidents": {
        "incident_id": "event_id * 2 + k",
        "flight_id": "CASE WHEN event_id % 31 = 0 THEN NULL ELSE user_id * 10 + event_id % 7 + 1 END",
        "incident_date": "CAST(CAST(ts AS DATE) AS STRING)",
        "incident_type": "concat(event_type, '-related issue')",
        "severity": (
            "CASE event_id % 9 WHEN 0 THEN 'Low' WHEN 1 THEN '1' WHEN 2 THEN 'MEDIUM' WHEN 3 THEN '2' WHEN 4 THEN 'High' "
            "WHEN 5 THEN '4' WHEN 6 THEN 'CRITICAL' WHEN 7 THEN ' low' ELSE NULL END"
        ),
        "description": "CASE WHEN event_id % 13 = 0 THEN NULL WHEN k = 1 THEN upper(props) ELSE props END",
        "resolved": "CASE event_id % 5 WHEN 0 THEN 'yes' WHEN 1 THEN 'true' WHEN 2 THEN '0' WHEN 3 THEN 'no' ELSE NULL END",
    },
}

#: Texts that come from one driver table, for operators that need no joined trip.
_FLIGHT = RAW_EXPRESSIONS["flights"]
RAW_EXPRESSIONS["readings"] = {
    c: _FLIGHT[c]
    for c in (
        "flight_id",
        "delay_minutes",
        "flight_status",
        "passengers_onboard",
        "cargo_kg",
        "actual_arr",
        "airline_iata",
        "l_partkey",
        "l_suppkey",
    )
}
RAW_EXPRESSIONS["stamps"] = {
    "o_orderkey": "o_orderkey",
    "scheduled_dep": _FLIGHT["scheduled_dep"],
    "scheduled_arr": (
        "CASE o_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'later' "
        "WHEN 2 THEN '2023-02-30 10:00' ELSE concat(CAST(CAST(o_orderdate AS DATE) AS STRING), ' 23:05') END"
    ),
}

#: FROM clauses for DuckDB; the Spark side builds the same rows in ``raw_base``.
DUCKDB_FROM = {
    "airports": "nation JOIN region ON n_regionkey = r_regionkey, (SELECT unnest([0, 1]) AS k) twice",
    "airlines": "supplier, (SELECT unnest([0, 1]) AS k) twice",
    "flights": (
        "lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey "
        "JOIN supplier ON l_suppkey = s_suppkey"
    ),
    "passengers": "lineitem",
    "readings": "lineitem",
    "stamps": "orders",
    "incidents": "events, (SELECT unnest([0, 1]) AS k) twice",
}

#: Columns that put records with the same id in order of arrival.  They cover every
#: source column a record is made of, so records that tie are equal.
LINE_ORDER = ["l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate", "l_quantity", "l_returnflag", "l_linestatus"]
FLIGHT_ORDER = LINE_ORDER[:5]
PASSENGER_ORDER = ["passenger_id", "l_suppkey", "l_quantity"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _twice(df: DataFrame) -> DataFrame:
    return df.withColumn("k", F.explode(F.array(F.lit(0), F.lit(1))))


def raw_base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    def t(source: str) -> DataFrame:
        return table(spark, sf_dir, source)

    if name == "airports":
        return _twice(t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")))
    if name == "airlines":
        return _twice(t("supplier"))
    if name == "flights":
        return (
            t("lineitem")
            .join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
            .join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        )
    if name in ("passengers", "readings"):
        return t("lineitem")
    if name == "stamps":
        return t("orders")
    if name == "incidents":
        return _twice(t("events"))
    raise KeyError(name)


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A raw operational table over the driver tables."""
    columns = RAW_EXPRESSIONS[name]
    return raw_base(spark, sf_dir, name).selectExpr(*[f"{e} AS {c}" for c, e in columns.items()])


def raw_sql(name: str) -> str:
    """The same table as DuckDB SQL."""
    columns = ", ".join(f"{e} AS {c}" for c, e in RAW_EXPRESSIONS[name].items())
    return f"SELECT {columns} FROM {DUCKDB_FROM[name]}"
