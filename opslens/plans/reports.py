"""The analytical reports over the cleaned tables.

Facts are aggregated on their own key before any dimension is joined, so the
joins run on group rows, not on fact rows.  Reports return DECIMAL for totals
and percentages; every sort ends in a unique column, so a value shared by many
rows does not end up in one sort task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslens import functions as fx
from opslens.operators.joins import left_detail, look_up
from opslens.operators.network import hop_network
from opslens.operators.ranking import global_rank, grand_total
from opslens.plans import vocabulary as v
from opslens.sources.keyed import KeyedTable, per_key, with_groups
from opslens.sources.staging import stage

def _rows() -> Column:
    return F.count(F.lit(1))


def _status(label: str) -> Column:
    return F.col("flight_status") == label


def _big_sum(column: str) -> Column:
    return F.sum(F.col(column).cast("decimal(38,0)"))


def _with_carrier(df: DataFrame, airlines: DataFrame) -> DataFrame:
    return look_up(df, airlines, {"airline_iata": "iata_code"}, {"airline_name": "airline_name"})


def flight_listing(flights: DataFrame, airlines: DataFrame, airports: DataFrame) -> DataFrame:
    """Every trip with carrier and both end points."""
    named = _with_carrier(flights, airlines)
    for end, prefix in (("origin_iata", "origin"), ("destination_iata", "dest")):
        named = look_up(
            named,
            airports,
            {end: "iata_code"},
            {"airport_name": f"{prefix}_airport", "city": f"{prefix}_city"},
        )
    listed = named.withColumn("delay_minutes", F.coalesce("delay_minutes", F.lit(0)))
    return listed.orderBy(F.col("scheduled_dep").asc_nulls_last(), "flight_id").select(
        "flight_number",
        "airline_name",
        "origin_airport",
        "origin_city",
        "dest_airport",
        "dest_city",
        "scheduled_dep",
        "flight_status",
        "delay_minutes",
        "passengers_onboard",
        "cargo_kg",
    )


def incident_listing(flights: DataFrame, airlines: DataFrame, incidents: DataFrame) -> DataFrame:
    """Every trip with its incidents, or marked as having none."""
    trips = _with_carrier(
        flights.select(
            "flight_id", "flight_number", "airline_iata", "origin_iata", "destination_iata", "flight_status"
        ),
        airlines,
    )
    detail = incidents.select("flight_id", "incident_id", "incident_type", "severity", "resolved")
    return (
        left_detail(trips, detail, "flight_id")
        .withColumn("route", fx.route_label("origin_iata", "destination_iata"))
        .withColumn("incident_status", F.coalesce(F.col("resolved").cast("string"), F.lit(v.NO_INCIDENT)))
        .orderBy(F.col("flight_number").asc_nulls_last(), "flight_id", "incident_id")
        .select(
            "flight_number",
            "airline_name",
            "route",
            "flight_status",
            "incident_type",
            "severity",
            "incident_status",
        )
    )


def carrier_revenue(airlines: DataFrame, flights: DataFrame, passengers: DataFrame | KeyedTable) -> DataFrame:
    """Trips, passengers, revenue, mean price and class counts per carrier."""
    per_trip = per_key(
        passengers,
        "flight_id",
        F.count("passenger_id").alias("pax"),
        F.sum("ticket_price_idr").alias("revenue"),
        F.count("ticket_price_idr").alias("priced"),
        F.count_if(F.col("ticket_class") == "Business").alias("business"),
        F.count_if(F.col("ticket_class") == "Economy").alias("economy"),
    )
    sums = [
        _rows().alias("trips"),
        F.sum("pax").alias("pax"),
        _big_sum("revenue").alias("revenue"),
        F.sum("priced").alias("priced"),
        F.sum("business").alias("business"),
        F.sum("economy").alias("economy"),
    ]
    per_code = with_groups(flights.select("flight_id", "airline_iata"), per_trip).groupBy("airline_iata").agg(*sums)
    sums[0] = F.sum("trips").alias("trips")
    per_name = _with_carrier(per_code, airlines).groupBy("airline_name").agg(*sums)
    return per_name.select(
        "airline_name",
        F.col("trips").alias("total_flights"),
        F.col("pax").alias("total_passengers"),
        F.col("revenue").alias("total_revenue_idr"),
        fx.round_to_long(fx.average("revenue", "priced")).alias("avg_ticket_price"),
        F.col("business").alias("business_pax"),
        F.col("economy").alias("economy_pax"),
    ).orderBy(F.col("total_revenue_idr").desc_nulls_first(), F.col("airline_name").asc_nulls_last())


def above_average(flights: DataFrame, airlines: DataFrame, status: str = "Delayed") -> DataFrame:
    """Trips of one status whose delay is above the mean of that status."""
    late = flights.filter(_status(status))
    mean = late.agg(fx.average(F.sum("delay_minutes"), F.count("delay_minutes")).alias("mean")).scalar()
    return (
        _with_carrier(late.filter(F.col("delay_minutes") > mean), airlines)
        .orderBy(F.col("delay_minutes").desc(), "flight_id")
        .select(
            "flight_number",
            "airline_name",
            fx.route_label("origin_iata", "destination_iata").alias("route"),
            "delay_minutes",
            F.round(mean, 1).alias("avg_delay_all"),
        )
    )


def punctuality_rank(flights: DataFrame, airlines: DataFrame) -> DataFrame:
    """Carriers ranked by their share of trips on time."""
    per_code = flights.groupBy("airline_iata").agg(
        _rows().alias("total_flights"), F.count_if(_status("On Time")).alias("on_time_flights")
    )
    per_name = (
        _with_carrier(per_code, airlines)
        .groupBy("airline_name")
        .agg(F.sum("total_flights").alias("total_flights"), F.sum("on_time_flights").alias("on_time_flights"))
        .withColumn("on_time_pct", fx.percent("on_time_flights", "total_flights"))
    )
    ranked = global_rank(per_name, ["on_time_pct"], "punctuality_rank")
    return ranked.select(
        "airline_name",
        "total_flights",
        "on_time_flights",
        F.round("on_time_pct", 1).alias("on_time_percentage"),
        "punctuality_rank",
    ).orderBy("punctuality_rank", F.col("airline_name").asc_nulls_last())


def incident_totals(incidents: DataFrame, flights: DataFrame, airlines: DataFrame) -> DataFrame:
    """Every incident with the number of incidents its carrier has."""
    located = stage(
        incidents.select("incident_id", "flight_id", "incident_type", "severity").join(
            flights.select("flight_id", "flight_number", "airline_iata"), "flight_id"
        ),
        "located-incidents",
    )
    totals = located.groupBy("airline_iata").agg(_rows().alias("total_airline_incidents"))
    return (
        located.join(_with_carrier(totals, airlines), "airline_iata")
        .orderBy(
            F.col("total_airline_incidents").desc(), F.col("severity").asc_nulls_last(), "incident_id"
        )
        .select("flight_number", "airline_name", "incident_type", "severity", "total_airline_incidents")
    )


def route_performance(flights: DataFrame, airports: DataFrame) -> DataFrame:
    """Volume, delay, punctuality, grade and type of every route."""
    per_route = flights.groupBy("origin_iata", "destination_iata").agg(
        _rows().alias("total_flights"),
        F.sum("delay_minutes").alias("delay_sum"),
        F.sum("passengers_onboard").alias("total_pax"),
        fx.wide_sum("cargo_kg").alias("cargo"),
        F.count_if(_status("On Time")).alias("on_time_cnt"),
    )
    # Staged: a row per route, which is read again by those that look at the totals first.
    stats = stage(per_route, "routes")
    routes = look_up(
        stats,
        airports,
        {"origin_iata": "iata_code"},
        {"city": "origin_city", "province": "origin_province", "is_international": "origin_intl"},
    )
    routes = look_up(
        routes, airports, {"destination_iata": "iata_code"}, {"city": "dest_city", "is_international": "dest_intl"}
    )
    # A missing delay counts as none: it adds nothing to the sum but counts as a trip.
    routes = routes.withColumns(
        {
            "mean_delay": fx.average(F.coalesce("delay_sum", F.lit(0)), "total_flights"),
            "punctual": fx.percent("on_time_cnt", "total_flights"),
        }
    )
    grades = []
    for label, most_delay, least_punctual in v.GRADE_LIMITS:
        rule = F.col("mean_delay") <= most_delay
        if least_punctual is not None:
            rule = rule & (F.col("punctual") >= least_punctual)
        grades.append((rule, label))
    both = F.col("origin_intl") & F.col("dest_intl")
    either = F.col("origin_intl") | F.col("dest_intl")
    return (
        routes.withColumn("performance_grade", fx.tier(grades, v.GRADE_DEFAULT))
        .orderBy("performance_grade", F.col("mean_delay").desc(), "origin_iata", "destination_iata")
        .select(
            fx.route_label("origin_iata", "destination_iata").alias("route"),
            F.concat("origin_city", F.lit(", "), "origin_province").alias("origin"),
            "dest_city",
            fx.tier(
                [(both, v.BOTH_INTERNATIONAL), (either, v.ONE_INTERNATIONAL)], v.NONE_INTERNATIONAL
            ).alias("route_type"),
            "total_flights",
            F.round("mean_delay", 1).alias("avg_delay_min"),
            F.round("punctual", 1).alias("on_time_pct"),
            "performance_grade",
            "total_pax",
            fx.wide_decimal("cargo", 0).alias("total_cargo_kg"),
        )
    )


def hub_network(airports: DataFrame, flights: DataFrame, root: str, max_hops: int = 2) -> DataFrame:
    """Places reachable from a hub, level by level, as an indented listing."""
    reached = hop_network(airports, flights, root, max_hops, "iata_code", "origin_iata", "destination_iata")
    named = look_up(reached, airports, {"vertex": "iata_code"}, {"airport_name": "airport_name", "city": "city"})
    return named.orderBy("level", "vertex").select(
        F.col("level").alias("hub_level"),
        fx.indent("vertex", "level").alias("indented_code"),
        "airport_name",
        "city",
        F.col("root").alias("hub_root"),
    )


def revenue_share(flights: DataFrame, airlines: DataFrame, passengers: DataFrame | KeyedTable) -> DataFrame:
    """Trips ranked by revenue, with premium share and share of all revenue."""
    business = F.when(F.col("ticket_class") == "Business", F.col("ticket_price_idr")).otherwise(0)
    per_trip = per_key(
        passengers,
        "flight_id",
        _rows().alias("total_pax"),
        F.sum("ticket_price_idr").alias("total_revenue_idr"),
        F.sum(business).alias("business_revenue"),
        F.count_if("is_frequent_flyer").alias("ff_pax"),
    )
    trips = flights.select(
        "flight_id", "flight_number", "airline_iata", "origin_iata", "destination_iata", "flight_status"
    )
    earned = stage(
        _with_carrier(with_groups(trips, per_trip), airlines).drop("airline_iata"), "trip-revenue"
    )
    total = grand_total(earned, "total_revenue_idr")
    ranked = global_rank(earned, ["total_revenue_idr"], "revenue_rank", staged=True)
    return ranked.orderBy("revenue_rank", "flight_id").select(
        "flight_number",
        "airline_name",
        fx.route_label("origin_iata", "destination_iata").alias("route"),
        "flight_status",
        "total_pax",
        "total_revenue_idr",
        fx.percent_rounded("business_revenue", "total_revenue_idr").alias("pct_from_business"),
        "ff_pax",
        "revenue_rank",
        fx.percent_rounded("total_revenue_idr", total).alias("pct_of_total_revenue"),
    )


def ops_kpi(flights: DataFrame, cargo_scale: int = 6) -> DataFrame:
    """One row of operating figures.

    Weights are summed as wide numbers, so no number of trips overflows the total; it is returned with
    ``cargo_scale`` digits behind the point and 38 in all.

    Grouping by carrier and route first leaves few rows for the distinct
    counts, instead of copying every trip once per distinct count.
    """
    groups = flights.groupBy("airline_iata", "origin_iata", "destination_iata").agg(
        F.count("flight_id").alias("trips"),
        _rows().alias("n"),
        F.sum("passengers_onboard").alias("pax"),
        F.sum("delay_minutes").alias("delay"),
        fx.wide_sum("cargo_kg").alias("cargo"),
        *[
            F.count_if(_status(label)).alias(name)
            for label, name in (("On Time", "on_time"), ("Delayed", "delayed"), ("Cancelled", "cancelled"))
        ],
    )
    totals = groups.agg(
        F.coalesce(F.sum("trips"), F.lit(0)).alias("total_flights"),
        F.count_distinct("airline_iata").alias("total_airlines"),
        F.count_distinct("origin_iata", "destination_iata").alias("total_routes"),
        F.sum("pax").alias("total_pax"),
        F.sum("n").alias("n"),
        F.coalesce(F.sum("delay"), F.lit(0)).alias("delay"),
        fx.wide_merge("cargo").alias("cargo"),
        *[F.sum(name).alias(name) for name in ("on_time", "delayed", "cancelled")],
    )
    return totals.select(
        "total_flights",
        "total_airlines",
        "total_routes",
        "total_pax",
        F.round(fx.average("delay", "n"), 1).alias("avg_delay_min"),
        *[fx.percent_rounded(name, "n").alias(f"{name}_pct") for name in ("on_time", "delayed", "cancelled")],
        fx.wide_decimal("cargo", cargo_scale).alias("total_cargo_kg"),
    )


def movements(flights: DataFrame) -> DataFrame:
    """``(iata_code, departures, arrivals)`` per place from one pass over the trips."""
    ends = F.array(
        F.struct(F.col("origin_iata").alias("iata_code"), F.lit(v.DEPARTURES).alias("direction")),
        F.struct(F.col("destination_iata").alias("iata_code"), F.lit(v.ARRIVALS).alias("direction")),
    )
    return (
        flights.groupBy("origin_iata", "destination_iata")
        .agg(_rows().alias("n"))
        .select("n", F.inline(ends))
        .groupBy("iata_code")
        .agg(
            F.sum(F.when(F.col("direction") == v.DEPARTURES, F.col("n")).otherwise(0)).alias("departures"),
            F.sum(F.when(F.col("direction") == v.ARRIVALS, F.col("n")).otherwise(0)).alias("arrivals"),
        )
    )


def busiest_places(airports: DataFrame, flights: DataFrame) -> DataFrame:
    """Places ranked by departures plus arrivals."""
    named = look_up(
        movements(flights), airports, {"iata_code": "iata_code"}, {"airport_name": "airport_name", "city": "city"}
    ).withColumn("total_movements", F.col("departures") + F.col("arrivals"))
    return (
        global_rank(named, ["total_movements"], "busiest_rank")
        .orderBy(F.col("total_movements").desc(), "iata_code")
        .select(
            "iata_code", "airport_name", "city", "total_movements", "departures", "arrivals", "busiest_rank"
        )
    )


def safety_matrix(incidents: DataFrame | KeyedTable, flights: DataFrame, airlines: DataFrame) -> DataFrame:
    """Incidents per carrier and severity, carriers ranked by the grave ones."""
    cells = [(s, f"{s.lower()}_incidents") for s in v.SEVERITY_ORDER]
    per_trip = per_key(
        incidents,
        "flight_id",
        *[F.count_if(F.col("severity") == s).alias(name) for s, name in cells],
        _rows().alias("total_incidents"),
    )
    names = [name for _, name in cells] + ["total_incidents"]
    per_code = (
        with_groups(flights.select("flight_id", "airline_iata"), per_trip)
        .groupBy("airline_iata")
        .agg(*[F.sum(n).alias(n) for n in names])
    )
    per_name = _with_carrier(per_code, airlines).groupBy("airline_name").agg(*[F.sum(n).alias(n) for n in names])
    return (
        global_rank(per_name, ["critical_incidents", "high_incidents"], "safety_risk_rank")
        .orderBy("safety_risk_rank", F.col("airline_name").asc_nulls_last())
        .select("airline_name", *names, "safety_risk_rank")
    )
