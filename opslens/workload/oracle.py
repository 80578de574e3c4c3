"""The registered queries as DuckDB SQL, written independently of the Spark plans.

Ratios are rounded with whole numbers (half away from zero), joins come before
aggregation and ranks are plain windows, so a shared mistake is unlikely.
"""

from __future__ import annotations

from opslens.workload.raw_views import raw_sql
from opslens.workload.tables import TABLES


def _pct(part: str, whole: str, digits: int = 1) -> str:
    k = 10**digits
    return f"(({200 * k} * ({part}) + ({whole})) // (2 * ({whole}))) / {k}.0"


def _mean(total: str, count: str, digits: int = 1) -> str:
    k = 10**digits
    return f"(({2 * k} * ({total}) + ({count})) // (2 * ({count}))) / {k}.0"


# The spellings that clean to one value.
_BOOL3 = (
    "CASE WHEN lower(trim({c})) IN ('yes', '1', 'true', 'y') THEN 'true' "
    "WHEN lower(trim({c})) IN ('no', '0', 'false', 'n') THEN 'false' END"
)
_BOOL2 = "CASE WHEN lower({c}) IN ('yes', 'true', '1') THEN 'true' ELSE 'false' END"
_GENDER = (
    "CASE WHEN lower(gender) IN ('l', 'm', 'male', 'laki', 'laki-laki') THEN 'Male' "
    "WHEN lower(gender) IN ('p', 'f', 'female', 'perempuan') THEN 'Female' ELSE 'Unknown' END"
)
_CLASS = (
    "CASE WHEN lower(ticket_class) IN ('business', 'biz', 'c') THEN 'Business' "
    "WHEN lower(ticket_class) = 'first' THEN 'First' ELSE 'Economy' END"
)
_SEVERITY = (
    "CASE lower(severity) WHEN 'low' THEN 'Low' WHEN '1' THEN 'Low' WHEN 'medium' THEN 'Medium' WHEN '2' THEN 'Medium' "
    "WHEN 'high' THEN 'High' WHEN '3' THEN 'High' WHEN 'critical' THEN 'Critical' WHEN '4' THEN 'Critical' "
    "ELSE 'Unknown' END"
)
_STATUS = (
    "CASE WHEN lower(trim(flight_status)) IN ('on time', 'ontime', 'ot') THEN 'On Time' "
    "WHEN lower(trim(flight_status)) IN ('delayed', 'delay') THEN 'Delayed' "
    "WHEN lower(trim(flight_status)) = 'cancelled' THEN 'Cancelled' ELSE 'Unknown' END"
)
_DELAY = (
    "CASE WHEN regexp_matches(delay_minutes, '^-?[0-9]+$') "
    "THEN CAST(CASE WHEN TRY_CAST(delay_minutes AS INTEGER) < 0 THEN 0 ELSE TRY_CAST(delay_minutes AS INTEGER) END AS BIGINT) END"
)
_COUNT = (
    "CASE WHEN regexp_matches(passengers_onboard, '^[0-9]+\\.?[0-9]*$') "
    "THEN CAST(round(TRY_CAST(passengers_onboard AS DECIMAL(38,25))) AS BIGINT) END"
)
_CARGO = "CASE WHEN regexp_matches(cargo_kg, '^[0-9]+\\.?[0-9]*$') THEN TRY_CAST(cargo_kg AS DECIMAL(38,18)) END"
_COORD = "CASE WHEN regexp_matches({c}, '^-?[0-9]+\\.?[0-9]*$') THEN TRY_CAST({c} AS DOUBLE) END"
_ELEVATION = "CASE WHEN regexp_matches(elevation_ft, '^[0-9]+$') THEN TRY_CAST(elevation_ft AS BIGINT) END"
_FLEET = "TRY_CAST(nullif(regexp_extract(fleet_size, '[0-9]+'), '') AS BIGINT)"
# What is left of a price without its prefix, put together from the runs between separators.
_MONEY = (
    "TRY_CAST(array_to_string(string_split_regex(CASE WHEN contains(lower(ticket_price), 'rp') "
    "THEN array_to_string(string_split_regex(ticket_price, '(?i)rp\\s*'), '') ELSE ticket_price END, '[.,]'), '') AS BIGINT)"
)
_STAMP = "CAST(TRY_CAST({c} AS TIMESTAMP) AS VARCHAR)"
_DAY = "CAST(TRY_CAST({c} AS DATE) AS VARCHAR)"


def _title(c: str) -> str:
    pieces = f"regexp_extract_all({c}, '[\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}]+')"
    return f"array_to_string([CASE substr(w, 1, 1) WHEN 'ß' THEN 'ß' ELSE upper(substr(w, 1, 1)) END || lower(substr(w, 2)) for w in {pieces}], '')"


_TIMES = ["scheduled_dep", "scheduled_arr", "actual_dep", "actual_arr"]

#: Cleaned tables: needed tables and the statement.
_CLEAN: dict[str, tuple[list[str], str]] = {
    "airports": (
        ["raw_airports"],
        f"""SELECT airport_id, upper(trim(iata_code)) AS iata_code, trim(airport_name) AS airport_name,
            upper(trim(city)) AS city, upper(trim(province)) AS province,
            {_COORD.format(c="latitude")} AS latitude, {_COORD.format(c="longitude")} AS longitude,
            {_ELEVATION} AS elevation_ft, {_BOOL3.format(c="is_international")} AS is_international
        FROM raw_airports WHERE iata_code IS NOT NULL AND iata_code <> '' AND airport_name IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY upper(trim(iata_code)) ORDER BY airport_id) = 1""",
    ),
    "airlines": (
        ["raw_airlines"],
        f"""SELECT airline_id, upper(trim(iata_code)) AS iata_code, trim(airline_name) AS airline_name,
            coalesce(alliance, 'None') AS alliance, {_FLEET} AS fleet_size,
            upper(trim(hub_airport)) AS hub_airport, lower(trim(status)) AS status
        FROM raw_airlines WHERE iata_code IS NOT NULL AND airline_name IS NOT NULL AND trim(airline_name) <> ''
        QUALIFY row_number() OVER (PARTITION BY upper(trim(iata_code)) ORDER BY airline_id) = 1""",
    ),
    "flights": (
        ["raw_flights", "airlines", "airports"],
        f"""SELECT flight_id, upper(trim(flight_number)) AS flight_number, upper(trim(airline_iata)) AS airline_iata,
            upper(trim(origin_iata)) AS origin_iata, upper(trim(destination_iata)) AS destination_iata,
            {_STATUS} AS flight_status, {_DELAY} AS delay_minutes,
            {", ".join(_STAMP.format(c=c) + " AS " + c for c in _TIMES)},
            {_COUNT} AS passengers_onboard, {_CARGO} AS cargo_kg
        FROM (SELECT * FROM raw_flights
              QUALIFY row_number() OVER (PARTITION BY flight_id
                                         ORDER BY l_partkey, l_suppkey, l_extendedprice, l_shipdate, l_quantity) = 1) f
        JOIN (SELECT iata_code AS carrier FROM airlines WHERE status = 'active') a ON upper(trim(airline_iata)) = carrier
        JOIN (SELECT iata_code AS o FROM airports) po ON upper(trim(origin_iata)) = o
        JOIN (SELECT iata_code AS d FROM airports) pd ON upper(trim(destination_iata)) = d""",
    ),
    "passengers": (
        ["raw_passengers"],
        f"""SELECT passenger_id, flight_id, {_title("trim(full_name)")} AS full_name, {_GENDER} AS gender,
            upper(trim(nationality)) AS nationality, {_CLASS} AS ticket_class, {_MONEY} AS ticket_price_idr,
            {_DAY.format(c="booking_date")} AS booking_date, {_BOOL2.format(c="frequent_flyer")} AS is_frequent_flyer
        FROM raw_passengers WHERE full_name IS NOT NULL AND trim(full_name) <> '' AND flight_id IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY flight_id, lower(trim(full_name)), booking_date
                                   ORDER BY passenger_id, l_suppkey, l_quantity) = 1""",
    ),
    "incidents": (
        ["raw_incidents", "flights"],
        f"""SELECT incident_id, i.flight_id, {_DAY.format(c="incident_date")} AS incident_date,
            {_title("incident_type")} AS incident_type, {_SEVERITY} AS severity, description,
            {_BOOL2.format(c="resolved")} AS resolved
        FROM (SELECT * FROM raw_incidents WHERE flight_id IS NOT NULL
              QUALIFY row_number() OVER (PARTITION BY flight_id, incident_type, lower(description)
                                         ORDER BY incident_id) = 1) i
        JOIN (SELECT flight_id FROM flights) f ON i.flight_id = f.flight_id""",
    ),
}


#: Per table: the row's own reason, what makes rows copies, which of them is first, and reasons that other tables give.
_LEDGERS = [
    (
        "airports",
        "CASE WHEN coalesce(iata_code, '') = '' THEN 'no code' WHEN airport_name IS NULL THEN 'no name' END",
        "upper(trim(iata_code))",
        "airport_id",
        "NULL",
    ),
    (
        "airlines",
        "CASE WHEN iata_code IS NULL THEN 'no code' WHEN trim(coalesce(airline_name, '')) = '' THEN 'no name' END",
        "upper(trim(iata_code))",
        "airline_id",
        "NULL",
    ),
    (
        "flights",
        "CAST(NULL AS VARCHAR)",
        "flight_id",
        "l_partkey, l_suppkey, l_extendedprice, l_shipdate, l_quantity",
        """CASE WHEN coalesce(upper(trim(airline_iata)) NOT IN (SELECT iata_code FROM airlines), true) THEN 'unknown carrier'
            WHEN upper(trim(airline_iata)) NOT IN (SELECT iata_code FROM airlines WHERE status = 'active') THEN 'inactive carrier'
            WHEN coalesce(upper(trim(origin_iata)) NOT IN (SELECT iata_code FROM airports), true) THEN 'unknown origin'
            WHEN coalesce(upper(trim(destination_iata)) NOT IN (SELECT iata_code FROM airports), true) THEN 'unknown destination' END""",
    ),
    (
        "passengers",
        "CASE WHEN trim(coalesce(full_name, '')) = '' THEN 'no name' WHEN flight_id IS NULL THEN 'no trip' END",
        "flight_id, lower(trim(full_name)), booking_date",
        "passenger_id, l_suppkey, l_quantity",
        "NULL",
    ),
    (
        "incidents",
        "CASE WHEN flight_id IS NULL THEN 'no trip' END",
        "flight_id, incident_type, lower(description)",
        "incident_id",
        "CASE WHEN flight_id NOT IN (SELECT flight_id FROM flights) THEN 'unknown trip' END",
    ),
]


def _needs(name: str) -> list[str]:
    if name.startswith("raw_"):
        return [name]
    found: list[str] = []
    for part in _CLEAN[name][0]:
        found += [n for n in _needs(part) if n not in found]
    return found + [name]


def _with(tables: str, body: str, recursive: bool = False) -> str:
    order: list[str] = []
    for name in tables.split():
        order += [n for n in _needs(name) if n not in order]
    parts = []
    for name in order:
        sql = raw_sql(name[4:]) if name.startswith("raw_") else _CLEAN[name][1]
        parts.append(f"{name} AS MATERIALIZED ({sql})")
    return f"WITH {'RECURSIVE ' if recursive else ''}{', '.join(parts)} {body}"


_ROUTE = "origin_iata || ' → ' || destination_iata"
_CARRIERS = "(SELECT iata_code AS carrier, airline_name FROM airlines) a ON f.airline_iata = carrier"

# table list, statement (a leading comma continues the WITH list)
_SQL: dict[str, tuple[str, str]] = {
    "clean_codes": (
        "raw_airlines",
        """SELECT airline_id, upper(trim(iata_code)) AS iata_code, trim(airline_name) AS airline_name,
        upper(trim(hub_airport)) AS hub_airport, lower(trim(status)) AS status,
        coalesce(alliance, 'None') AS alliance FROM raw_airlines""",
    ),
    "clean_bool3": (
        "raw_airports",
        f"SELECT airport_id, {_BOOL3.format(c='is_international')} AS is_international FROM raw_airports",
    ),
    "clean_bool2": ("raw_incidents", f"SELECT incident_id, {_BOOL2.format(c='resolved')} AS resolved FROM raw_incidents"),
    "flag_labels": (
        "raw_passengers",
        """SELECT flight_id, passenger_id, l_suppkey, CASE WHEN lower(frequent_flyer) IN ('yes', 'true', '1')
        THEN 'Frequent Flyer' ELSE 'Regular' END AS loyalty FROM raw_passengers""",
    ),
    "clean_enum": (
        "raw_passengers",
        f"SELECT flight_id, passenger_id, l_suppkey, {_GENDER} AS gender, {_CLASS} AS ticket_class FROM raw_passengers",
    ),
    "clean_severity": ("raw_incidents", f"SELECT incident_id, {_SEVERITY} AS severity FROM raw_incidents"),
    "clean_status": ("raw_readings", f"SELECT flight_id, l_partkey, l_suppkey, {_STATUS} AS flight_status FROM raw_readings"),
    "clean_coordinates": (
        "raw_airports",
        f"""SELECT airport_id, {_COORD.format(c="latitude")} AS latitude, {_COORD.format(c="longitude")} AS longitude,
        {_ELEVATION} AS elevation_ft FROM raw_airports""",
    ),
    "clean_numeric": (
        "raw_readings",
        f"""SELECT flight_id, l_partkey, l_suppkey, {_COUNT} AS passengers_onboard,
        CAST({_CARGO} AS DOUBLE) AS cargo_kg FROM raw_readings""",
    ),
    "lenient_numbers": (
        "raw_readings",
        """SELECT flight_id, l_partkey, l_suppkey, coalesce(TRY_CAST(delay_minutes AS DOUBLE), 0) AS delay_minutes,
        TRY_CAST(cargo_kg AS DOUBLE) AS cargo_kg FROM raw_readings""",
    ),
    "clean_delay": ("raw_readings", f"SELECT flight_id, l_partkey, l_suppkey, {_DELAY} AS delay_minutes FROM raw_readings"),
    "extract_int": ("raw_airlines", f"SELECT airline_id, {_FLEET} AS fleet_size FROM raw_airlines"),
    "clean_money": (
        "raw_passengers",
        f"SELECT flight_id, passenger_id, l_suppkey, {_MONEY} AS ticket_price_idr FROM raw_passengers",
    ),
    "clean_timestamp": (
        "raw_stamps",
        f"""SELECT o_orderkey, {_STAMP.format(c="scheduled_dep")} AS scheduled_dep,
        {_STAMP.format(c="scheduled_arr")} AS scheduled_arr FROM raw_stamps""",
    ),
    "clean_date": (
        "raw_passengers",
        f"""SELECT flight_id, passenger_id, l_suppkey, {_DAY.format(c="booking_date")} AS booking_date
        FROM raw_passengers""",
    ),
    "title_case": ("", f"SELECT doc_id, {_title('text')} AS title FROM documents"),
    "dedup_first": (
        "",
        """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag
        FROM lineitem QUALIFY row_number() OVER
        (PARTITION BY l_orderkey, l_linenumber
         ORDER BY l_partkey, l_suppkey, l_extendedprice, l_shipdate, l_quantity, l_returnflag, l_linestatus) = 1""",
    ),
    "dedup_exact": ("", "SELECT DISTINCT text, lang, source FROM documents"),
    "reject_incomplete": (
        "raw_passengers",
        """SELECT passenger_id, flight_id, full_name, booking_date, l_suppkey FROM raw_passengers
        WHERE full_name IS NOT NULL AND flight_id IS NOT NULL AND trim(full_name) <> ''""",
    ),
    "drop_null_subset": (
        "raw_airports",
        """SELECT airport_id, latitude, elevation_ft FROM raw_airports
        WHERE latitude IS NOT NULL AND elevation_ft IS NOT NULL""",
    ),
    "ref_filter": (
        "",
        """SELECT event_id, user_id, upper(event_type) AS place FROM events
        JOIN (SELECT DISTINCT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') c ON user_id = c_custkey""",
    ),
    "status_filter": (
        "raw_readings airlines",
        """SELECT flight_id, l_partkey, l_suppkey, upper(trim(airline_iata)) AS airline_iata FROM raw_readings
        JOIN (SELECT iata_code FROM airlines WHERE status = 'active') a ON upper(trim(airline_iata)) = iata_code""",
    ),
    "pipeline_places": ("airports", "SELECT * FROM airports"),
    "pipeline_carriers": ("airlines", "SELECT * FROM airlines"),
    "pipeline_trips": ("flights", "SELECT * REPLACE (CAST(cargo_kg AS DOUBLE) AS cargo_kg) FROM flights"),
    "pipeline_pax": ("passengers", "SELECT * FROM passengers"),
    "pipeline_incidents": ("incidents", "SELECT * FROM incidents"),
    "csv_roundtrip": ("raw_passengers", "SELECT * FROM raw_passengers"),
    "cached_load": (
        "airlines incidents",
        """SELECT 'airlines' AS table_name, airline_id AS id, status AS label FROM airlines
        UNION ALL SELECT 'incidents', incident_id, severity FROM incidents""",
    ),
    "append_replace": (
        "",
        "SELECT s_suppkey, s_name FROM supplier UNION ALL SELECT s_suppkey, upper(s_name) FROM supplier",
    ),
    "load_profile": (
        "",
        " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, count(*) AS n_rows, CAST({n} AS BIGINT) AS n_cols FROM {t}"
            for t, n in {
                "region": 2,
                "nation": 3,
                "customer": 5,
                "supplier": 4,
                "part": 6,
                "orders": 6,
                "lineitem": 11,
                "events": 6,
                "documents": 5,
                "embeddings": 3,
                "pages": 3,
                "benchmark": 2,
                "labels": 3,
                "conversations": 4,
            }.items()
        ),
    ),
    "preview": ("flights", "SELECT flight_id, flight_number, flight_status FROM flights ORDER BY flight_id LIMIT 5"),
    "null_census": (
        "flights",
        "SELECT * FROM ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_null FROM flights"
            for c in [
                "flight_id",
                "flight_number",
                "airline_iata",
                "origin_iata",
                "destination_iata",
                "flight_status",
                "coalesce(delay_minutes, 0)",
                *_TIMES,
                "passengers_onboard",
                "cargo_kg",
            ]
        )
        + ") WHERE n_null > 0",
    ),
    "enriched_trips": (
        "flights airlines airports",
        f"""SELECT flight_number, airline_name, o.airport_name AS origin_airport, o.city AS origin_city,
        d.airport_name AS dest_airport, d.city AS dest_city, scheduled_dep, flight_status,
        coalesce(delay_minutes, 0) AS delay_minutes, passengers_onboard, CAST(cargo_kg AS DOUBLE) AS cargo_kg
        FROM flights f JOIN {_CARRIERS} JOIN airports o ON f.origin_iata = o.iata_code
        JOIN airports d ON f.destination_iata = d.iata_code""",
    ),
    "trips_incidents": (
        "flights airlines incidents",
        f"""SELECT flight_number, airline_name, {_ROUTE} AS route, flight_status, incident_type, severity,
        coalesce(resolved, 'No Incident') AS incident_status
        FROM flights f JOIN {_CARRIERS} LEFT JOIN incidents i ON f.flight_id = i.flight_id""",
    ),
    "carrier_revenue": (
        "flights airlines passengers",
        f"""SELECT airline_name, count(DISTINCT f.flight_id) AS total_flights, count(passenger_id) AS total_passengers,
        CAST(sum(ticket_price_idr) AS BIGINT) AS total_revenue_idr,
        CAST({_mean("sum(ticket_price_idr)", "count(ticket_price_idr)", 0).replace(" / 1.0", "")} AS BIGINT) AS avg_ticket_price,
        count(*) FILTER (WHERE ticket_class = 'Business') AS business_pax,
        count(*) FILTER (WHERE ticket_class = 'Economy') AS economy_pax
        FROM flights f JOIN {_CARRIERS} JOIN passengers p ON f.flight_id = p.flight_id GROUP BY airline_name""",
    ),
    "above_average": (
        "flights airlines",
        f""", late AS (SELECT sum(delay_minutes) AS s, count(delay_minutes) AS n FROM flights WHERE flight_status = 'Delayed')
        SELECT flight_number, airline_name, {_ROUTE} AS route, delay_minutes, {_mean("s", "n")} AS avg_delay_all
        FROM late, flights f JOIN {_CARRIERS} WHERE flight_status = 'Delayed' AND delay_minutes * n > s""",
    ),
    "punctuality_rank": (
        "flights airlines",
        f"""SELECT airline_name, total_flights, on_time_flights, {_pct("on_time_flights", "total_flights")} AS on_time_percentage,
        rank() OVER (ORDER BY on_time_flights / total_flights DESC NULLS FIRST) AS punctuality_rank
        FROM (SELECT airline_name, count(*) AS total_flights,
              count(*) FILTER (WHERE flight_status = 'On Time') AS on_time_flights
              FROM flights f JOIN {_CARRIERS} GROUP BY airline_name) s""",
    ),
    "incident_totals": (
        "flights airlines incidents",
        f"""SELECT flight_number, airline_name, incident_type, severity,
        (SELECT count(*) FROM incidents i2 JOIN flights f2 ON i2.flight_id = f2.flight_id
         WHERE f2.airline_iata = f.airline_iata) AS total_airline_incidents
        FROM incidents i JOIN flights f ON i.flight_id = f.flight_id JOIN {_CARRIERS}""",
    ),
    "route_performance": (
        "flights airports",
        f"""SELECT {_ROUTE} AS route, o.city || ', ' || o.province AS origin, d.city AS dest_city,
        CASE WHEN o.is_international = 'true' AND d.is_international = 'true' THEN 'Intl–Intl'
             WHEN o.is_international = 'true' OR d.is_international = 'true' THEN 'Intl–Dom' ELSE 'Dom–Dom' END AS route_type,
        n AS total_flights, {_mean("delay", "n")} AS avg_delay_min, {_pct("on_time", "n")} AS on_time_pct,
        CASE WHEN delay <= 5 * n AND 100 * on_time >= 80 * n THEN 'Excellent'
             WHEN delay <= 20 * n AND 100 * on_time >= 60 * n THEN 'Good'
             WHEN delay <= 45 * n THEN 'Fair' ELSE 'Poor' END AS performance_grade,
        pax AS total_pax, cargo AS total_cargo_kg
        FROM (SELECT origin_iata, destination_iata, count(*) AS n, CAST(sum(coalesce(delay_minutes, 0)) AS BIGINT) AS delay,
              count(*) FILTER (WHERE flight_status = 'On Time') AS on_time,
              CAST(sum(passengers_onboard) AS BIGINT) AS pax, CAST(round(sum(cargo_kg)) AS BIGINT) AS cargo
              FROM flights GROUP BY ALL) s
        JOIN airports o ON origin_iata = o.iata_code JOIN airports d ON destination_iata = d.iata_code""",
    ),
    "hub_network": (
        "flights airports",
        """, edges AS (SELECT DISTINCT origin_iata AS src, destination_iata AS dst FROM flights),
        walk AS (SELECT iata_code AS v, 0 AS lvl, [iata_code] AS path FROM airports WHERE iata_code = 'NATION_0'
          UNION ALL
          SELECT dst, lvl + 1, list_append(path, dst) FROM walk JOIN edges ON src = v
          JOIN airports ON dst = iata_code WHERE NOT list_contains(path, dst) AND lvl < 2)
        SELECT DISTINCT CAST(lvl AS BIGINT) AS hub_level, repeat('  ', lvl) || v AS indented_code, airport_name, city,
        'NATION_0' AS hub_root FROM walk JOIN airports ON v = iata_code""",
    ),
    "revenue_share": (
        "flights airlines passengers",
        f""", trips AS (SELECT f.flight_id, flight_number, airline_name, {_ROUTE} AS route, flight_status,
          count(*) AS total_pax, CAST(sum(ticket_price_idr) AS BIGINT) AS rev,
          CAST(sum(CASE WHEN ticket_class = 'Business' THEN ticket_price_idr ELSE 0 END) AS BIGINT) AS biz,
          count(*) FILTER (WHERE is_frequent_flyer = 'true') AS ff_pax
          FROM flights f JOIN {_CARRIERS} JOIN passengers p ON f.flight_id = p.flight_id GROUP BY ALL),
        total AS (SELECT sum(rev) AS t FROM trips)
        SELECT flight_number, airline_name, route, flight_status, total_pax, rev AS total_revenue_idr,
        {_pct("biz", "nullif(rev, 0)")} AS pct_from_business, ff_pax,
        rank() OVER (ORDER BY rev DESC NULLS FIRST) AS revenue_rank, {_pct("rev", "t")} AS pct_of_total_revenue
        FROM trips, total""",
    ),
    "ops_kpi": (
        "flights",
        f"""SELECT count(DISTINCT flight_id) AS total_flights, count(DISTINCT airline_iata) AS total_airlines,
        count(DISTINCT origin_iata || '|' || destination_iata) AS total_routes,
        CAST(sum(passengers_onboard) AS BIGINT) AS total_pax,
        {_mean("CAST(sum(coalesce(delay_minutes, 0)) AS BIGINT)", "count(*)")} AS avg_delay_min,
        {_pct("count(*) FILTER (WHERE flight_status = 'On Time')", "count(*)")} AS on_time_pct,
        {_pct("count(*) FILTER (WHERE flight_status = 'Delayed')", "count(*)")} AS delayed_pct,
        {_pct("count(*) FILTER (WHERE flight_status = 'Cancelled')", "count(*)")} AS cancelled_pct,
        CAST(sum(cargo_kg) AS DOUBLE) AS total_cargo_kg FROM flights""",
    ),
    "busiest_places": (
        "flights airports",
        """SELECT iata_code, airport_name, city, CAST(count(*) AS BIGINT) AS total_movements,
        count(*) FILTER (WHERE dir = 'D') AS departures, count(*) FILTER (WHERE dir = 'A') AS arrivals,
        rank() OVER (ORDER BY count(*) DESC) AS busiest_rank
        FROM (SELECT origin_iata AS code, 'D' AS dir FROM flights UNION ALL SELECT destination_iata, 'A' FROM flights) m
        JOIN airports ON code = iata_code GROUP BY iata_code, airport_name, city""",
    ),
    "safety_matrix": (
        "flights airlines incidents",
        f"""SELECT airline_name, count(*) FILTER (WHERE severity = 'Low') AS low_incidents,
        count(*) FILTER (WHERE severity = 'Medium') AS medium_incidents,
        count(*) FILTER (WHERE severity = 'High') AS high_incidents,
        count(*) FILTER (WHERE severity = 'Critical') AS critical_incidents, count(*) AS total_incidents,
        rank() OVER (ORDER BY count(*) FILTER (WHERE severity = 'Critical') DESC,
                              count(*) FILTER (WHERE severity = 'High') DESC) AS safety_risk_rank
        FROM incidents i JOIN flights f ON i.flight_id = f.flight_id JOIN {_CARRIERS} GROUP BY airline_name""",
    ),
    "quality_report": (
        " ".join(f"raw_{t} {t}" for t in TABLES),
        " UNION ALL ".join(
            f"""SELECT '{t}' AS table_name, r AS raw_rows, c AS clean_rows, r - c AS removed,
            {_pct("r - c", "r")} AS removed_pct
            FROM (SELECT (SELECT count(*) FROM raw_{t}) AS r, (SELECT count(*) FROM {t}) AS c) q"""
            for t in TABLES
        ),
    ),
    "reject_ledger": (
        "raw_airports raw_airlines raw_flights raw_passengers raw_incidents airlines airports flights",
        " UNION ALL ".join(
            f"""SELECT '{t}' AS table_name, coalesce(own, CASE WHEN place > 1 THEN 'duplicate' END, {later}, 'kept') AS reason, count(*) AS n_rows
            FROM (SELECT *, row_number() OVER (PARTITION BY own, {keys} ORDER BY {order}) AS place
                  FROM (SELECT *, {own} AS own FROM raw_{t}) a) b GROUP BY ALL"""
            for t, own, keys, order, later in _LEDGERS
        ),
    ),
    "trip_frame": (
        "flights airlines airports",
        """SELECT f.* REPLACE (CAST(cargo_kg AS DOUBLE) AS cargo_kg, CAST(passengers_onboard AS DOUBLE) AS passengers_onboard,
            CAST(coalesce(delay_minutes, 0) AS DOUBLE) AS delay_minutes), a.iata_code AS iata_code, a.airline_name AS airline_name,
        o.iata_code AS iata_code_orig, o.city AS origin_city
        FROM flights f LEFT JOIN airlines a ON airline_iata = a.iata_code LEFT JOIN airports o ON origin_iata = o.iata_code""",
    ),
    "joined_frames": (
        "flights airlines passengers",
        """SELECT p.* REPLACE (CAST(ticket_price_idr AS DOUBLE) AS ticket_price_idr), f.airline_iata, f.flight_status, a.iata_code, a.airline_name
        FROM passengers p LEFT JOIN flights f ON p.flight_id = f.flight_id LEFT JOIN airlines a ON airline_iata = a.iata_code""",
    ),
    "status_share": (
        "flights",
        f"""SELECT flight_status, n, {_pct("n", "t")} AS pct FROM
        (SELECT flight_status, count(*) AS n FROM flights GROUP BY 1) s, (SELECT count(*) AS t FROM flights) q""",
    ),
    "otp_by_carrier": (
        "flights airlines",
        f"""SELECT airline_name, {_pct("ot", "n", 4)} AS otp_pct,
        CASE WHEN 100 * ot >= 80 * n THEN 'true' ELSE 'false' END AS meets_target
        FROM (SELECT airline_name, count(*) AS n, count(*) FILTER (WHERE flight_status = 'On Time') AS ot
              FROM flights f JOIN {_CARRIERS} GROUP BY 1) s""",
    ),
    "delay_histogram": (
        "flights",
        """, late AS (SELECT CAST(coalesce(delay_minutes, 0) AS BIGINT) AS x FROM flights WHERE flight_status = 'Delayed'),
        ends AS (SELECT CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END::DOUBLE AS a,
                        CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END::DOUBLE AS b FROM late)
        SELECT CAST(i + 1 AS BIGINT) AS bin, a + i * ((b - a) / 8) AS lo, a + (i + 1) * ((b - a) / 8) AS hi,
        (SELECT count(*) FROM late WHERE least(floor((x - a) * 8 / (b - a)), 7) = i) AS n
        FROM ends, (SELECT unnest(range(8)) AS i) bins WHERE a IS NOT NULL""",
    ),
    "delay_stats": (
        "flights",
        f""", late AS (SELECT CAST(coalesce(delay_minutes, 0) AS BIGINT) AS x FROM flights WHERE flight_status = 'Delayed')
        SELECT {_mean("CAST(sum(x) AS BIGINT)", "count(x)", 4)} AS mean_delay, max(x) AS max_delay,
        median(x) AS median_delay FROM late""",
    ),
    "revenue_pivot": (
        "flights airlines passengers",
        f"""SELECT airline_name, {", ".join(
            f"CAST(coalesce(sum(ticket_price_idr) FILTER (WHERE ticket_class = '{c}'), 0) AS BIGINT) AS {c}"
            for c in ("Business", "Economy", "First"))}
        FROM flights f JOIN {_CARRIERS} JOIN passengers p ON f.flight_id = p.flight_id GROUP BY airline_name""",
    ),
    "loyalty_mix": (
        "passengers",
        """SELECT CASE WHEN is_frequent_flyer = 'true' THEN 'Frequent Flyer' ELSE 'Regular' END AS loyalty, count(*) AS n
        FROM passengers GROUP BY 1""",
    ),
    "incident_pivot": (
        "flights airlines incidents",
        f"""SELECT airline_name, {", ".join(
            f"count(*) FILTER (WHERE severity = '{s}') AS {s}" for s in ("Low", "Medium", "High", "Critical"))}
        FROM incidents i JOIN flights f ON i.flight_id = f.flight_id JOIN {_CARRIERS} GROUP BY airline_name""",
    ),
    "top_places": (
        "flights airports",
        """, dep AS (SELECT origin_iata AS code, count(*) AS departures FROM flights GROUP BY 1),
        arr AS (SELECT destination_iata AS code, count(*) AS arrivals FROM flights GROUP BY 1),
        busy AS (SELECT code AS origin_iata, coalesce(departures, 0) AS departures, coalesce(arrivals, 0) AS arrivals
                 FROM dep FULL JOIN arr USING (code))
        SELECT origin_iata, departures, arrivals, departures + arrivals AS total, iata_code, city
        FROM busy LEFT JOIN airports ON origin_iata = iata_code
        ORDER BY total DESC, origin_iata LIMIT 7""",
    ),
    "distinct_by_level": (
        "flights",
        """SELECT airline_iata, flight_status,
        CASE WHEN grouping(airline_iata) + grouping(flight_status) = 2 THEN 3 WHEN grouping(airline_iata) = 1 THEN 2
        ELSE grouping(flight_status) END::BIGINT AS level,
        count(DISTINCT (origin_iata, destination_iata)) FILTER (WHERE origin_iata IS NOT NULL AND destination_iata IS NOT NULL)
        AS routes, count(DISTINCT flight_number) AS numbers, count(DISTINCT CAST(scheduled_dep AS DATE)) AS days
        FROM flights GROUP BY GROUPING SETS ((airline_iata, flight_status), (airline_iata), (flight_status), ())""",
    ),
    "group_distinct": ("flights", "SELECT origin_iata, destination_iata FROM flights GROUP BY ALL"),
    "global_rank": (
        "",
        """SELECT o_orderkey, o_custkey, o_orderstatus,
        rank() OVER (ORDER BY o_custkey DESC NULLS FIRST, o_orderstatus DESC NULLS FIRST) AS place FROM orders""",
    ),
    "share_of_total": (
        "",
        f"""SELECT l_suppkey, quantity, {_pct("quantity", "t", 3)} AS pct FROM
        (SELECT l_suppkey, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity FROM lineitem GROUP BY 1) s,
        (SELECT CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS t FROM lineitem) q""",
    ),
    "distribution_stats": (
        "",
        f"""SELECT {_mean("CAST(sum(l_partkey) AS BIGINT)", "count(l_partkey)", 4)} AS mean, median(l_partkey) AS median,
        max(l_partkey) AS max FROM lineitem""",
    ),
    "share_of_fractions": (
        "",
        """SELECT l_suppkey, price, CAST(round(CAST(price * 100 AS DECIMAL(38,4)) * 100000 / t) AS DOUBLE) / 100000 AS pct FROM
        (SELECT l_suppkey, sum(CAST(l_extendedprice AS DECIMAL(15,2)))::DOUBLE AS price FROM lineitem GROUP BY 1) s,
        (SELECT sum(CAST(l_extendedprice AS DECIMAL(15,2))) AS t FROM lineitem) q""",
    ),
    "distribution_fractions": (
        "",
        """SELECT CAST((2 * 10000 * CAST(sum(c) AS HUGEINT) + 100 * count(c)) // (2 * 100 * count(c)) AS DOUBLE) / 10000 AS mean, median(c)::DOUBLE / 100 AS median,
        max(c)::DOUBLE / 100 AS max FROM (SELECT CAST(round(CAST(l_extendedprice AS DECIMAL(15,2)) * 100) AS BIGINT) AS c FROM lineitem)""",
    ),
    "share_of_cargo": (
        "flights",
        """, units AS (SELECT airline_iata, sum(CAST(floor(cargo_kg) AS HUGEINT)) AS w,
          sum(CAST((cargo_kg - floor(cargo_kg)) * 1000000000000 AS HUGEINT)) AS f FROM flights GROUP BY 1),
        cargo AS (SELECT airline_iata, (w * 1000000000000 + f)::HUGEINT AS u FROM units),
        total AS (SELECT sum(u)::HUGEINT AS t FROM cargo)
        SELECT airline_iata, CAST((2 * 1000000 * u + t) // (2 * t) AS DOUBLE) / 10000 AS pct FROM cargo, total""",
    ),
    "mean_cargo": (
        "flights",
        """, units AS (SELECT origin_iata, destination_iata, count(cargo_kg) AS n, sum(CAST(floor(cargo_kg) AS HUGEINT)) AS w,
          sum(CAST((cargo_kg - floor(cargo_kg)) * 1000000000000 AS HUGEINT)) AS f FROM flights GROUP BY ALL),
        nano AS (SELECT *, ((2 * (w * 1000000000000 + f) + 1000 * n) // (2 * 1000 * n))::HUGEINT AS q FROM units WHERE n > 0)
        SELECT u.origin_iata, u.destination_iata,
        (q // 1000000000)::VARCHAR || '.' || lpad((q % 1000000000)::VARCHAR, 9, '0') AS mean_cargo
        FROM units u LEFT JOIN nano m ON u.origin_iata = m.origin_iata AND u.destination_iata = m.destination_iata""",
    ),
    "value_share": (
        "",
        f"""SELECT o_orderpriority, n, {_pct("n", "t")} AS pct FROM
        (SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1) s,
        (SELECT count(o_orderpriority) AS t FROM orders) q""",
    ),
}
# The same figures, counted anew instead of read from ledgers.
_SQL["counted_quality"] = _SQL["quality_report"]


def all_oracle_sql() -> dict[str, str]:
    return {
        name: _with(tables, body, recursive=name == "hub_network") if tables else body
        for name, (tables, body) in _SQL.items()
    }
