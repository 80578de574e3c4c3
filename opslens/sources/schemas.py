"""Landing and cleaned table schemas.

Landing tables keep every measured column as text so that bad values survive
the load and can be counted; only the arrival ids and foreign keys are typed.
"""

from __future__ import annotations

from pyspark.sql import types as T

RAW_COLUMNS = {
    "airports": (
        "airport_id bigint, iata_code string, airport_name string, city string, province string, "
        "latitude string, longitude string, elevation_ft string, is_international string"
    ),
    "airlines": (
        "airline_id bigint, iata_code string, airline_name string, alliance string, "
        "fleet_size string, hub_airport string, status string"
    ),
    "flights": (
        "flight_id bigint, flight_number string, airline_iata string, origin_iata string, "
        "destination_iata string, scheduled_dep string, scheduled_arr string, actual_dep string, "
        "actual_arr string, delay_minutes string, flight_status string, aircraft_type string, "
        "passengers_onboard string, cargo_kg string"
    ),
    "passengers": (
        "passenger_id bigint, flight_id bigint, full_name string, gender string, nationality string, "
        "ticket_class string, ticket_price string, booking_date string, frequent_flyer string"
    ),
    "incidents": (
        "incident_id bigint, flight_id bigint, incident_date string, incident_type string, "
        "severity string, description string, resolved string"
    ),
}

CLEAN_COLUMNS = {
    "airports": (
        "airport_id bigint, iata_code string, airport_name string, city string, province string, "
        "latitude decimal(38,18), longitude decimal(38,18), elevation_ft int, is_international boolean"
    ),
    "airlines": (
        "airline_id bigint, iata_code string, airline_name string, alliance string, "
        "fleet_size int, hub_airport string, status string"
    ),
    "flights": (
        "flight_id bigint, flight_number string, airline_iata string, origin_iata string, "
        "destination_iata string, flight_status string, delay_minutes int, "
        "scheduled_dep timestamp_ntz, scheduled_arr timestamp_ntz, actual_dep timestamp_ntz, "
        "actual_arr timestamp_ntz, passengers_onboard int, cargo_kg decimal(38,18)"
    ),
    "passengers": (
        "passenger_id bigint, flight_id bigint, full_name string, gender string, nationality string, "
        "ticket_class string, ticket_price_idr bigint, booking_date date, is_frequent_flyer boolean"
    ),
    "incidents": (
        "incident_id bigint, flight_id bigint, incident_date date, incident_type string, "
        "severity string, description string, resolved boolean"
    ),
}


def raw_schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(RAW_COLUMNS[table])


def clean_schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(CLEAN_COLUMNS[table])
