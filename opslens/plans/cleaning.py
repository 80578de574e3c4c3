"""The five cleaning pipelines: landing tables in, typed tables out.

Each one rejects incomplete rows first and de-duplicates what is left, so an
incomplete first record never hides a complete later one.  ``mode`` is passed
to the parsers: ``permissive`` turns bad text into NULL, ``strict`` fails.

``clean_*`` return the cleaned rows alone.  ``tag_*`` apply the same rules to
tell why rows go: they return tagged rows for ``operators.ledger`` and the
columns that make a cleaned row of a kept one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslens import functions as fx
from opslens.operators.ledger import Rule, tag_reference, tag_rows
from opslens.operators.rows import dedup_first, ref_filter, reject_incomplete
from opslens.plans import vocabulary as v
from opslens.sources.schemas import raw_schema

#: Tagged rows, and the columns that are made of kept ones.
Tagged = tuple[DataFrame, list[Column]]


def _missing(reason: str, column: str, empty: bool = False, blank: bool = False) -> Rule:
    test = F.col(column).isNull()
    if empty:
        test |= F.col(column) == ""
    if blank:
        test |= F.trim(column) == ""
    return reason, test


def _airport_columns(mode: str) -> list[Column]:
    return [
        F.col("airport_id"),
        fx.clean_code("iata_code").alias("iata_code"),
        fx.clean_label("airport_name").alias("airport_name"),
        fx.clean_code("city").alias("city"),
        fx.clean_code("province").alias("province"),
        fx.parse_decimal("latitude", signed=True, mode=mode).alias("latitude"),
        fx.parse_decimal("longitude", signed=True, mode=mode).alias("longitude"),
        fx.parse_int("elevation_ft", mode=mode).alias("elevation_ft"),
        fx.normalize_bool("is_international", v.YES_WORDS, v.NO_WORDS, trim=True).alias("is_international"),
    ]


def clean_airports(raw: DataFrame, mode: str = "permissive") -> DataFrame:
    """Places: one row per code, flags and coordinates typed."""
    complete = reject_incomplete(raw, ["iata_code", "airport_name"], not_empty=["iata_code"])
    return dedup_first(complete, [fx.clean_code("iata_code")], ["airport_id"]).select(*_airport_columns(mode))


def _airline_columns(mode: str) -> list[Column]:
    return [
        F.col("airline_id"),
        fx.clean_code("iata_code").alias("iata_code"),
        fx.clean_label("airline_name").alias("airline_name"),
        F.coalesce("alliance", F.lit(v.ALLIANCE_DEFAULT)).alias("alliance"),
        fx.first_int("fleet_size", mode=mode).alias("fleet_size"),
        fx.clean_code("hub_airport").alias("hub_airport"),
        fx.clean_label("status", lower=True).alias("status"),
    ]


def clean_airlines(raw: DataFrame, mode: str = "permissive") -> DataFrame:
    """Carriers: one row per code, fleet size dug out of free text."""
    complete = reject_incomplete(raw, ["iata_code", "airline_name"], not_blank=["airline_name"])
    return dedup_first(complete, [fx.clean_code("iata_code")], ["airline_id"]).select(*_airline_columns(mode))


def _typed_flights(raw: DataFrame, mode: str, first_by: Sequence[str] | None) -> DataFrame:
    codes = ("flight_number", "airline_iata", "origin_iata", "destination_iata")
    times = ("scheduled_dep", "scheduled_arr", "actual_dep", "actual_arr")
    return raw.select(
        "flight_id",
        *[fx.clean_code(c).alias(c) for c in codes],
        fx.normalize_enum("flight_status", v.STATUS_WORDS, v.STATUS_DEFAULT, trim=True).alias("flight_status"),
        fx.parse_int("delay_minutes", signed=True, floor=0, mode=mode).alias("delay_minutes"),
        *[fx.parse_timestamp(c, mode=mode).alias(c) for c in times],
        fx.parse_count("passengers_onboard", mode=mode).alias("passengers_onboard"),
        fx.parse_decimal("cargo_kg", mode=mode).alias("cargo_kg"),
        *[F.col(c).alias(f"__order_{c}") for c in first_by or ()],
    )


def clean_flights(
    raw: DataFrame,
    airlines: DataFrame,
    airports: DataFrame,
    mode: str = "permissive",
    first_by: Sequence[str] | None = None,
) -> DataFrame:
    """Trips of active carriers between known places.

    ``flight_id`` is taken to be unique.  Where a source repeats it, name the
    columns that tell the first record in ``first_by``.
    """
    typed = _typed_flights(raw, mode, first_by)
    columns = [c for c in typed.columns if not c.startswith("__order_")]
    if first_by is not None:
        # After parsing: numbers and times are a fraction of their texts in the exchange.
        typed = dedup_first(typed, ["flight_id"], [f"__order_{c}" for c in first_by])
    kept = typed.select(*columns)
    kept = ref_filter(kept, airlines, {"airline_iata": "iata_code"}, F.col("status") == v.ACTIVE_STATUS)
    kept = ref_filter(kept, airports, {"origin_iata": "iata_code"})
    return ref_filter(kept, airports, {"destination_iata": "iata_code"})


def _passenger_columns(mode: str) -> list[Column]:
    return [
        F.col("passenger_id"),
        F.col("flight_id"),
        fx.title_words(F.trim("full_name")).alias("full_name"),
        fx.normalize_enum("gender", v.GENDER_WORDS, v.GENDER_DEFAULT).alias("gender"),
        fx.clean_code("nationality").alias("nationality"),
        fx.normalize_enum("ticket_class", v.CLASS_WORDS, v.CLASS_DEFAULT).alias("ticket_class"),
        fx.parse_money("ticket_price", mode=mode).alias("ticket_price_idr"),
        fx.parse_date("booking_date", mode=mode).alias("booking_date"),
        fx.normalize_bool("frequent_flyer", v.SET_WORDS).alias("is_frequent_flyer"),
    ]


def clean_passengers(
    raw: DataFrame, mode: str = "permissive", first_by: Sequence[str] = ("passenger_id",)
) -> DataFrame:
    """Bookings, one per person, trip and booking date; trips are not checked here."""
    complete = reject_incomplete(raw, ["full_name", "flight_id"], not_blank=["full_name"])
    person = fx.clean_label("full_name", lower=True)
    return dedup_first(complete, ["flight_id", person, "booking_date"], first_by).select(*_passenger_columns(mode))


def _incident_columns(mode: str) -> list[Column]:
    return [
        F.col("incident_id"),
        F.col("flight_id"),
        fx.parse_date("incident_date", mode=mode).alias("incident_date"),
        fx.title_words("incident_type").alias("incident_type"),
        fx.normalize_enum("severity", v.SEVERITY_WORDS, v.SEVERITY_DEFAULT).alias("severity"),
        F.col("description"),
        fx.normalize_bool("resolved", v.SET_WORDS).alias("resolved"),
    ]


def clean_incidents(raw: DataFrame, flights: DataFrame, mode: str = "permissive") -> DataFrame:
    """Incidents of known trips; repeated reports are merged before the trip check."""
    complete = reject_incomplete(raw, ["flight_id"])
    first = dedup_first(complete, ["flight_id", "incident_type", F.lower("description")], ["incident_id"])
    return ref_filter(first, flights, {"flight_id": "flight_id"}).select(*_incident_columns(mode))


def tag_airports(raw: DataFrame, mode: str = "permissive") -> Tagged:
    rules = [_missing("no code", "iata_code", empty=True), _missing("no name", "airport_name")]
    tagged = tag_rows(raw, rules, raw_schema("airports").names, [fx.clean_code("iata_code")], ["airport_id"])
    return tagged, _airport_columns(mode)


def tag_airlines(raw: DataFrame, mode: str = "permissive") -> Tagged:
    rules = [_missing("no code", "iata_code"), _missing("no name", "airline_name", blank=True)]
    tagged = tag_rows(raw, rules, raw_schema("airlines").names, [fx.clean_code("iata_code")], ["airline_id"])
    return tagged, _airline_columns(mode)


def tag_flights(
    raw: DataFrame,
    airlines: DataFrame,
    airports: DataFrame,
    mode: str = "permissive",
    first_by: Sequence[str] | None = None,
) -> Tagged:
    typed = _typed_flights(raw, mode, first_by)
    columns = [c for c in typed.columns if not c.startswith("__order_")]
    keys = None if first_by is None else ["flight_id"]
    # References are told from a row alone, so they are looked up before the rows are dealt by trip and can be stored as they lie.
    typed = typed.withColumn("__why", F.lit(None).cast("string"))
    active = F.col("status") == v.ACTIVE_STATUS
    on = {"airline_iata": "iata_code"}
    typed = tag_reference(typed, airlines, on, "unknown carrier", active, "inactive carrier", tag="__why")
    typed = tag_reference(typed, airports, {"origin_iata": "iata_code"}, "unknown origin", tag="__why")
    typed = tag_reference(typed, airports, {"destination_iata": "iata_code"}, "unknown destination", tag="__why")
    # What is never read of a rejected trip is not dealt either.
    typed = typed.withColumns({c: F.when(F.col("__why").isNull(), F.col(c)) for c in columns if c != "flight_id"})
    tagged = tag_rows(typed, [], [*columns, "__why"], keys, [f"__order_{c}" for c in first_by or ()])
    tagged = tagged.withColumn("__reason", F.col("__why")).drop("__why")
    return tagged, [F.col(c) for c in columns]


def tag_passengers(
    raw: DataFrame, mode: str = "permissive", first_by: Sequence[str] = ("passenger_id",)
) -> Tagged:
    rules = [_missing("no name", "full_name", blank=True), _missing("no trip", "flight_id")]
    keys = ["flight_id", fx.clean_label("full_name", lower=True), "booking_date"]
    return tag_rows(raw, rules, raw_schema("passengers").names, keys, first_by), _passenger_columns(mode)


def tag_incidents(raw: DataFrame, flights: DataFrame, mode: str = "permissive") -> Tagged:
    keys = ["flight_id", "incident_type", F.lower("description")]
    tagged = tag_rows(raw, [_missing("no trip", "flight_id")], raw_schema("incidents").names, keys, ["incident_id"])
    return tag_reference(tagged, flights, {"flight_id": "flight_id"}, "unknown trip"), _incident_columns(mode)
