"""The figures behind the seven charts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslens import functions as fx
from opslens.operators.aggregates import distribution_stats, histogram, pivot_fill, value_share
from opslens.operators.joins import full_merge, look_up
from opslens.operators.ranking import top_k
from opslens.operators.rows import drop_null_subset
from opslens.plans import vocabulary as v
from opslens.sources.keyed import KeyedTable, per_key, with_groups
from opslens.sources.staging import stage


def repair_types(flights: DataFrame, passengers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Numbers back from text after a CSV load; a missing delay becomes 0."""
    fixed = flights.withColumns(
        {
            "delay_minutes": fx.lenient_double("delay_minutes", fill=0),
            "passengers_onboard": fx.lenient_double("passengers_onboard"),
            "cargo_kg": fx.lenient_double("cargo_kg"),
        }
    )
    return fixed, passengers.withColumn("ticket_price_idr", fx.lenient_double("ticket_price_idr"))


def trip_frame(flights: DataFrame, airlines: DataFrame, airports: DataFrame) -> DataFrame:
    """Trips with carrier name and city of origin, where known."""
    named = look_up(
        flights.withColumn("__carrier", F.col("airline_iata")),
        airlines.withColumn("__code", F.col("iata_code")),
        {"__carrier": "__code"},
        {"iata_code": "iata_code", "airline_name": "airline_name"},
        "left",
    )
    placed = look_up(
        named.withColumn("__origin", F.col("origin_iata")),
        airports.withColumn("__code", F.col("iata_code")),
        {"__origin": "__code"},
        {"iata_code": "iata_code_orig", "city": "origin_city"},
        "left",
    )
    return placed.select(*flights.columns, "iata_code", "airline_name", "iata_code_orig", "origin_city")


def passenger_frame(passengers: DataFrame, flights: DataFrame, airlines: DataFrame) -> DataFrame:
    """Bookings with trip status and carrier name, where known."""
    trips = look_up(
        flights.select("flight_id", "airline_iata", "flight_status"),
        airlines.withColumn("__code", F.col("iata_code")),
        {"airline_iata": "__code"},
        {"iata_code": "iata_code", "airline_name": "airline_name"},
        "left",
    )
    return passengers.join(trips, "flight_id", "left").select(
        *passengers.columns, "airline_iata", "flight_status", "iata_code", "airline_name"
    )


def status_share(flights: DataFrame) -> DataFrame:
    """Trips per status, absolute and in percent."""
    return value_share(flights, "flight_status")


def on_time_by_carrier(flights: DataFrame, airlines: DataFrame, target: int = v.ON_TIME_TARGET) -> DataFrame:
    """Share of trips on time per carrier, lowest first, with the target met or not."""
    per_code = flights.groupBy("airline_iata").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("flight_status") == "On Time").alias("on_time")
    )
    named = look_up(per_code, airlines, {"airline_iata": "iata_code"}, {"airline_name": "airline_name"})
    pct = named.groupBy("airline_name").agg(fx.percent(F.sum("on_time"), F.sum("n")).alias("otp_pct"))
    return (
        drop_null_subset(pct, ["airline_name"])
        .withColumn("meets_target", F.col("otp_pct") >= target)
        .orderBy("otp_pct", "airline_name")
    )


def delay_histogram(flights: DataFrame, bins: int = v.DELAY_BINS, status: str = "Delayed") -> DataFrame:
    """Delay of late trips in equal bins; a missing delay counts as 0."""
    late = flights.filter(F.col("flight_status") == status)
    return histogram(late.select(F.coalesce("delay_minutes", F.lit(0)).alias("delay")), "delay", bins)


def delay_stats(flights: DataFrame, status: str = "Delayed") -> DataFrame:
    """Mean, median and longest delay of late trips; a missing delay counts as 0."""
    late = flights.filter(F.col("flight_status") == status)
    stats = distribution_stats(late.select(F.coalesce("delay_minutes", F.lit(0)).alias("delay")), "delay")
    return stats.select(*[F.col(c).alias(f"{c}_delay") for c in stats.columns])


def revenue_pivot(passengers: DataFrame | KeyedTable, flights: DataFrame, airlines: DataFrame) -> DataFrame:
    """Revenue per carrier with one column per ticket class found; empty cells are 0."""
    per_trip = per_key(passengers, "flight_id", F.sum("ticket_price_idr").alias("revenue"), also=("ticket_class",))
    per_code = (
        with_groups(flights.select("flight_id", "airline_iata"), per_trip)
        .groupBy("airline_iata", "ticket_class")
        .agg(F.sum(F.col("revenue").cast("decimal(38,0)")).alias("revenue"))
    )
    named = look_up(per_code, airlines, {"airline_iata": "iata_code"}, {"airline_name": "airline_name"})
    # Staged: finding the classes and filling the cells both read these few rows.
    return pivot_fill(stage(named, "class-revenue"), ["airline_name"], "ticket_class", F.col("revenue"))


def loyalty_mix(passengers: DataFrame, column: str = "is_frequent_flyer") -> DataFrame:
    """Bookings of frequent flyers and of others; fixed figures without the column."""
    if column not in passengers.columns:
        counts = [(v.LOYAL_LABEL, 0), (v.REGULAR_LABEL, 1)]
        return passengers.sparkSession.createDataFrame(counts, "loyalty string, n bigint")
    label = fx.flag_label(column, v.SET_WORDS, v.LOYAL_LABEL, v.REGULAR_LABEL)
    return (
        passengers.select(label.alias("loyalty"))
        .groupBy("loyalty")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), "loyalty")
    )


def incident_pivot(incidents: DataFrame | KeyedTable, flights: DataFrame, airlines: DataFrame) -> DataFrame:
    """Incidents per carrier with one column per known severity, always all four.

    A carrier whose incidents all have an unknown severity stays, with zeros.
    Trips are unique on their id, so the join repeats no incident.
    """
    per_trip = per_key(incidents, "flight_id", F.count(F.lit(1)).alias("n"), also=("severity",))
    per_code = (
        with_groups(flights.select("flight_id", "airline_iata"), per_trip, "right")
        .groupBy("airline_iata", "severity")
        .agg(F.sum("n").alias("n"))
    )
    merged = look_up(per_code, airlines, {"airline_iata": "iata_code"}, {"airline_name": "airline_name"}, "left")
    return pivot_fill(
        drop_null_subset(merged, ["airline_name"]), ["airline_name"], "severity", F.col("n"), v.SEVERITY_ORDER
    )


def top_places(flights: DataFrame, airports: DataFrame, k: int = v.TOP_PLACES) -> DataFrame:
    """The ``k`` places with most movements, fewest first; ties go to the lower code."""
    # Both sides start from the same grouped routes, so the trips are read once.
    routes = flights.groupBy("origin_iata", "destination_iata").agg(F.count(F.lit(1)).alias("n"))
    departures = routes.groupBy("origin_iata").agg(F.sum("n").alias("departures"))
    arrivals = routes.groupBy(F.col("destination_iata").alias("origin_iata")).agg(F.sum("n").alias("arrivals"))
    busy = full_merge(
        drop_null_subset(departures, ["origin_iata"]), drop_null_subset(arrivals, ["origin_iata"]), ["origin_iata"]
    ).withColumn("total", F.col("departures") + F.col("arrivals"))
    first = top_k(busy, "total", ["origin_iata"], k)
    named = look_up(
        first.withColumn("__code", F.col("origin_iata")),
        airports.withColumn("__key", F.col("iata_code")),
        {"__code": "__key"},
        {"iata_code": "iata_code", "city": "city"},
        "left",
    )
    return named.orderBy("total", "origin_iata").select(
        "origin_iata", "departures", "arrivals", "total", "iata_code", "city"
    )
