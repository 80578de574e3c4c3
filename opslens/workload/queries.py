"""Registered queries: one per operator, report and summary."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opslens import functions as fx
from opslens import operators as op
from opslens import sources as io
from opslens.plans import quality, reports, summaries
from opslens.plans import vocabulary as v
from opslens.session import apply_defaults
from opslens.sources.staging import new_path
from opslens.workload.raw_views import LINE_ORDER, table
from opslens.workload.tables import TABLES, Warehouse

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

DRIVER_TABLES = [
    *["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"],
    *["documents", "embeddings", "pages", "benchmark", "labels", "conversations"],
]
HUB = "NATION_0"


#: Marks a column of whole DECIMAL, some of which are beyond BIGINT.
_BEYOND = "beyond_bigint"


def whole_numbers(df: DataFrame, column: str) -> DataFrame:
    """``df`` with a column of whole DECIMAL marked to stay so if one of its values is beyond BIGINT; ``df`` is run for that."""
    most = df.agg(F.max(F.abs(column))).first()[0]
    if most is None or most < 2**63:
        return df
    return df.withColumn(column, F.col(column).alias(column, metadata={_BEYOND: True}))


def plain(df: DataFrame) -> DataFrame:
    """Result types any SQL engine prints alike: BIGINT, DOUBLE and text; whole numbers beyond BIGINT stay DECIMAL."""
    columns = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if field.metadata.get(_BEYOND):
            pass
        elif isinstance(field.dataType, T.DecimalType):
            c = c.cast("bigint" if field.dataType.scale == 0 else "double")
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(field.dataType, (T.BooleanType, T.DateType, T.TimestampNTZType)):
            c = c.cast("string")
        columns.append(c.alias(field.name))
    return df.select(*columns)


def query(fn: Callable[[Warehouse], DataFrame]) -> Callable[[Warehouse], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(fn(Warehouse(apply_defaults(spark), sf_dir)))

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    _QUERIES[fn.__name__] = run
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- cleaning operators ------------------------------------------------------


@query
def clean_codes(w: Warehouse) -> DataFrame:
    return w.raw("airlines").select(
        "airline_id",
        fx.clean_code("iata_code").alias("iata_code"),
        fx.clean_label("airline_name").alias("airline_name"),
        fx.clean_code("hub_airport").alias("hub_airport"),
        fx.clean_label("status", lower=True).alias("status"),
        F.coalesce("alliance", F.lit(v.ALLIANCE_DEFAULT)).alias("alliance"),
    )


@query
def clean_bool3(w: Warehouse) -> DataFrame:
    flag = fx.normalize_bool("is_international", v.YES_WORDS, v.NO_WORDS, trim=True)
    return w.raw("airports").select("airport_id", flag.alias("is_international"))


@query
def clean_bool2(w: Warehouse) -> DataFrame:
    return w.raw("incidents").select("incident_id", fx.normalize_bool("resolved", v.SET_WORDS).alias("resolved"))


@query
def flag_labels(w: Warehouse) -> DataFrame:
    label = fx.flag_label("frequent_flyer", v.SET_WORDS, v.LOYAL_LABEL, v.REGULAR_LABEL)
    return w.raw("passengers").select("flight_id", "passenger_id", "l_suppkey", label.alias("loyalty"))


@query
def clean_enum(w: Warehouse) -> DataFrame:
    return w.raw("passengers").select(
        "flight_id",
        "passenger_id",
        "l_suppkey",
        fx.normalize_enum("gender", v.GENDER_WORDS, v.GENDER_DEFAULT).alias("gender"),
        fx.normalize_enum("ticket_class", v.CLASS_WORDS, v.CLASS_DEFAULT).alias("ticket_class"),
    )


@query
def clean_severity(w: Warehouse) -> DataFrame:
    severity = fx.normalize_enum("severity", v.SEVERITY_WORDS, v.SEVERITY_DEFAULT)
    return w.raw("incidents").select("incident_id", severity.alias("severity"))


@query
def clean_status(w: Warehouse) -> DataFrame:
    status = fx.normalize_enum("flight_status", v.STATUS_WORDS, v.STATUS_DEFAULT, trim=True)
    return w.raw("readings").select("flight_id", "l_partkey", "l_suppkey", status.alias("flight_status"))


@query
def clean_coordinates(w: Warehouse) -> DataFrame:
    return w.raw("airports").select(
        "airport_id",
        fx.parse_decimal("latitude", signed=True).alias("latitude"),
        fx.parse_decimal("longitude", signed=True).alias("longitude"),
        fx.parse_int("elevation_ft").alias("elevation_ft"),
    )


@query
def clean_numeric(w: Warehouse) -> DataFrame:
    return w.raw("readings").select(
        "flight_id",
        "l_partkey",
        "l_suppkey",
        fx.parse_count("passengers_onboard").alias("passengers_onboard"),
        fx.parse_decimal("cargo_kg").alias("cargo_kg"),
    )


@query
def lenient_numbers(w: Warehouse) -> DataFrame:
    return w.raw("readings").select(
        "flight_id",
        "l_partkey",
        "l_suppkey",
        fx.lenient_double("delay_minutes", fill=0).alias("delay_minutes"),
        fx.lenient_double("cargo_kg").alias("cargo_kg"),
    )


@query
def clean_delay(w: Warehouse) -> DataFrame:
    delay = fx.parse_int("delay_minutes", signed=True, floor=0)
    return w.raw("readings").select("flight_id", "l_partkey", "l_suppkey", delay.alias("delay_minutes"))


@query
def extract_int(w: Warehouse) -> DataFrame:
    return w.raw("airlines").select("airline_id", fx.first_int("fleet_size").alias("fleet_size"))


@query
def clean_money(w: Warehouse) -> DataFrame:
    price = fx.parse_money("ticket_price")
    return w.raw("passengers").select("flight_id", "passenger_id", "l_suppkey", price.alias("ticket_price_idr"))


@query
def clean_timestamp(w: Warehouse) -> DataFrame:
    times = ("scheduled_dep", "scheduled_arr")
    return w.raw("stamps").select("o_orderkey", *[fx.parse_timestamp(c).alias(c) for c in times])


@query
def clean_date(w: Warehouse) -> DataFrame:
    day = fx.parse_date("booking_date")
    return w.raw("passengers").select("flight_id", "passenger_id", "l_suppkey", day.alias("booking_date"))


@query
def title_case(w: Warehouse) -> DataFrame:
    docs = table(w.spark, w.sf_dir, "documents")
    return docs.select("doc_id", fx.title_words("text").alias("title"))


@query
def dedup_first(w: Warehouse) -> DataFrame:
    lines = table(w.spark, w.sf_dir, "lineitem")
    first = op.dedup_first(lines, ["l_orderkey", "l_linenumber"], LINE_ORDER)
    return first.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag")


@query
def dedup_exact(w: Warehouse) -> DataFrame:
    return op.dedup_exact(table(w.spark, w.sf_dir, "documents"), ["text", "lang", "source"])


@query
def reject_incomplete(w: Warehouse) -> DataFrame:
    kept = op.reject_incomplete(w.raw("passengers"), ["full_name", "flight_id"], not_blank=["full_name"])
    return kept.select("passenger_id", "flight_id", "full_name", "booking_date", "l_suppkey")


@query
def drop_null_subset(w: Warehouse) -> DataFrame:
    kept = op.drop_null_subset(w.raw("airports"), ["latitude", "elevation_ft"])
    return kept.select("airport_id", "latitude", "elevation_ft")


@query
def ref_filter(w: Warehouse) -> DataFrame:
    events = table(w.spark, w.sf_dir, "events").withColumn("place", fx.clean_code(F.concat(F.lit(" "), "event_type")))
    customers = table(w.spark, w.sf_dir, "customer")
    kept = op.ref_filter(events, customers, {"user_id": "c_custkey"}, F.col("c_mktsegment") == "BUILDING")
    return kept.select("event_id", "user_id", "place")


@query
def status_filter(w: Warehouse) -> DataFrame:
    trips = w.raw("readings").withColumn("airline_iata", fx.clean_code("airline_iata"))
    active = F.col("status") == v.ACTIVE_STATUS
    kept = op.ref_filter(trips, w.clean("airlines"), {"airline_iata": "iata_code"}, active)
    return kept.select("flight_id", "l_partkey", "l_suppkey", "airline_iata")


# --- cleaning pipelines ------------------------------------------------------


@query
def pipeline_places(w: Warehouse) -> DataFrame:
    return w.pipeline("airports")


@query
def pipeline_carriers(w: Warehouse) -> DataFrame:
    return w.pipeline("airlines")


@query
def pipeline_trips(w: Warehouse) -> DataFrame:
    return w.pipeline("flights")


@query
def pipeline_pax(w: Warehouse) -> DataFrame:
    return w.pipeline("passengers")


@query
def pipeline_incidents(w: Warehouse) -> DataFrame:
    return w.pipeline("incidents")


# --- sources and sinks -------------------------------------------------------


@query
def csv_roundtrip(w: Warehouse) -> DataFrame:
    """Landing text out to CSV and back: blanks, NULLs and empty texts must survive."""
    raw = w.raw("passengers")
    path = new_path(w.spark, "csv")
    io.write_csv(raw, path)
    return io.read_csv(w.spark, path, raw.schema)


@query
def cached_load(w: Warehouse) -> DataFrame:
    """Cleaned tables through their CSV cache, types repaired by the declared schema."""
    cache = new_path(w.spark, "csv-cache")
    schemas = {name: w.clean(name).schema for name in ("airlines", "incidents")}
    io.load_tables(w.spark, schemas, cache, w.clean)
    loaded = io.load_tables(w.spark, schemas, cache, w.clean)
    parts = [
        loaded[name].select(F.lit(name).alias("table_name"), F.col(key).alias("id"), F.col(label).alias("label"))
        for name, key, label in (("airlines", "airline_id", "status"), ("incidents", "incident_id", "severity"))
    ]
    return parts[0].unionByName(parts[1])


@query
def append_replace(w: Warehouse) -> DataFrame:
    """A table appended to, rebuilt from itself, and appended to by a job that runs twice."""
    suppliers = table(w.spark, w.sf_dir, "supplier").select("s_suppkey", "s_name")
    path = new_path(w.spark, "landing")
    io.append_rows(suppliers, path)
    io.replace_table(io.read_parquet(w.spark, path), path)
    for _ in range(2):
        io.append_rows(suppliers.withColumn("s_name", F.upper("s_name")), path, batch="upper")
    return io.read_parquet(w.spark, path)


@query
def load_profile(w: Warehouse) -> DataFrame:
    return io.load_profile({name: table(w.spark, w.sf_dir, name) for name in DRIVER_TABLES})


@query
def preview(w: Warehouse) -> DataFrame:
    return io.preview(w.clean("flights"), ["flight_id"]).select("flight_id", "flight_number", "flight_status")


@query
def null_census(w: Warehouse) -> DataFrame:
    flights, _ = summaries.repair_types(*w.cleaned("flights", "passengers"))
    return op.null_census(flights)


# --- reports -----------------------------------------------------------------


@query
def enriched_trips(w: Warehouse) -> DataFrame:
    return reports.flight_listing(*w.cleaned("flights", "airlines", "airports"))


@query
def trips_incidents(w: Warehouse) -> DataFrame:
    return reports.incident_listing(*w.cleaned("flights", "airlines", "incidents"))


@query
def carrier_revenue(w: Warehouse) -> DataFrame:
    return reports.carrier_revenue(*w.cleaned("airlines", "flights"), w.keyed("passengers"))


@query
def above_average(w: Warehouse) -> DataFrame:
    return reports.above_average(*w.cleaned("flights", "airlines"))


@query
def punctuality_rank(w: Warehouse) -> DataFrame:
    return reports.punctuality_rank(*w.cleaned("flights", "airlines"))


@query
def incident_totals(w: Warehouse) -> DataFrame:
    return reports.incident_totals(*w.cleaned("incidents", "flights", "airlines"))


@query
def route_performance(w: Warehouse) -> DataFrame:
    return whole_numbers(reports.route_performance(*w.cleaned("flights", "airports")), "total_cargo_kg")


@query
def hub_network(w: Warehouse) -> DataFrame:
    return reports.hub_network(*w.cleaned("airports", "flights"), root=HUB)


@query
def revenue_share(w: Warehouse) -> DataFrame:
    return reports.revenue_share(*w.cleaned("flights", "airlines"), w.keyed("passengers"))


@query
def ops_kpi(w: Warehouse) -> DataFrame:
    return reports.ops_kpi(w.clean("flights"))


@query
def busiest_places(w: Warehouse) -> DataFrame:
    return reports.busiest_places(*w.cleaned("airports", "flights"))


@query
def safety_matrix(w: Warehouse) -> DataFrame:
    return reports.safety_matrix(w.keyed("incidents"), *w.cleaned("flights", "airlines"))


@query
def quality_report(w: Warehouse) -> DataFrame:
    return quality.ledger_report({name: w.ledger(name) for name in TABLES})


@query
def counted_quality(w: Warehouse) -> DataFrame:
    return quality.quality_report({name: (w.raw(name), w.clean(name)) for name in TABLES})


@query
def reject_ledger(w: Warehouse) -> DataFrame:
    return quality.all_ledgers({name: w.ledger(name) for name in TABLES})


# --- chart summaries ---------------------------------------------------------


@query
def trip_frame(w: Warehouse) -> DataFrame:
    flights, _ = summaries.repair_types(*w.cleaned("flights", "passengers"))
    return summaries.trip_frame(flights, *w.cleaned("airlines", "airports"))


@query
def joined_frames(w: Warehouse) -> DataFrame:
    flights, passengers = summaries.repair_types(*w.cleaned("flights", "passengers"))
    return summaries.passenger_frame(passengers, flights, w.clean("airlines"))


@query
def status_share(w: Warehouse) -> DataFrame:
    return summaries.status_share(w.clean("flights"))


@query
def otp_by_carrier(w: Warehouse) -> DataFrame:
    shares = summaries.on_time_by_carrier(*w.cleaned("flights", "airlines"))
    return shares.withColumn("otp_pct", F.round("otp_pct", 4))


@query
def delay_histogram(w: Warehouse) -> DataFrame:
    return summaries.delay_histogram(w.clean("flights"))


@query
def delay_stats(w: Warehouse) -> DataFrame:
    stats = summaries.delay_stats(w.clean("flights"))
    return stats.withColumn("mean_delay", F.round("mean_delay", 4))


@query
def revenue_pivot(w: Warehouse) -> DataFrame:
    return summaries.revenue_pivot(w.keyed("passengers"), *w.cleaned("flights", "airlines"))


@query
def loyalty_mix(w: Warehouse) -> DataFrame:
    return summaries.loyalty_mix(w.clean("passengers"))


@query
def incident_pivot(w: Warehouse) -> DataFrame:
    return summaries.incident_pivot(w.keyed("incidents"), *w.cleaned("flights", "airlines"))


@query
def top_places(w: Warehouse) -> DataFrame:
    return summaries.top_places(*w.cleaned("flights", "airports"))


# --- operators on their own --------------------------------------------------


@query
def distinct_by_level(w: Warehouse) -> DataFrame:
    """Routes, flight numbers and days per carrier and status, per carrier, per status and in all, from one set of bitmaps."""
    trips = w.clean("flights").select(
        "airline_iata",
        "flight_status",
        "origin_iata",
        "destination_iata",
        "flight_number",
        F.to_date("scheduled_dep").cast("string").alias("day"),
    )
    counts = {"routes": ["origin_iata", "destination_iata"], "numbers": ["flight_number"], "days": ["day"]}
    return op.distinct_counts(trips, [["airline_iata", "flight_status"], ["airline_iata"], ["flight_status"], []], counts)


@query
def group_distinct(w: Warehouse) -> DataFrame:
    return op.distinct_groups(w.clean("flights"), ["origin_iata", "destination_iata"])


@query
def global_rank(w: Warehouse) -> DataFrame:
    """Rank of every order by customer and status: many ties."""
    orders = table(w.spark, w.sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return op.global_rank(orders, ["o_custkey", "o_orderstatus"], "place")


@query
def share_of_total(w: Warehouse) -> DataFrame:
    lines = table(w.spark, w.sf_dir, "lineitem").groupBy("l_suppkey").agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("quantity")
    )
    return op.share_of_total(lines, "quantity", "pct", digits=3)


@query
def distribution_stats(w: Warehouse) -> DataFrame:
    stats = op.distribution_stats(table(w.spark, w.sf_dir, "lineitem"), "l_partkey")
    return stats.withColumn("mean", F.round("mean", 4))


@query
def share_of_fractions(w: Warehouse) -> DataFrame:
    """Each supplier's share of all prices."""
    lines = table(w.spark, w.sf_dir, "lineitem").groupBy("l_suppkey").agg(
        F.sum(F.col("l_extendedprice").cast("decimal(15,2)")).alias("price")
    )
    return op.share_of_total(lines, "price", "pct", digits=5)


@query
def distribution_fractions(w: Warehouse) -> DataFrame:
    prices = table(w.spark, w.sf_dir, "lineitem").select(F.col("l_extendedprice").cast("decimal(15,2)").alias("price"))
    stats = op.distribution_stats(prices, "price")
    return stats.withColumns({"mean": F.round("mean", 4), "median": F.round("median", 3)})


@query
def share_of_cargo(w: Warehouse) -> DataFrame:
    """Each carrier's share of all weight, whose total passes the range of the column's type."""
    per_carrier = w.clean("flights").groupBy("airline_iata").agg(fx.wide_sum("cargo_kg").alias("cargo"))
    cargo = per_carrier.select("airline_iata", fx.wide_decimal("cargo", 12).alias("cargo"))
    return op.share_of_total(cargo, "cargo", "pct", digits=4).select("airline_iata", "pct")


@query
def mean_cargo(w: Warehouse) -> DataFrame:
    """Mean weight of every route, to nine digits behind the point, as text so that all are compared."""
    routes = w.clean("flights").groupBy("origin_iata", "destination_iata").agg(
        fx.wide_sum("cargo_kg").alias("cargo"), F.count("cargo_kg").alias("n")
    )
    mean = fx.wide_ratio(F.col("cargo"), fx.wide("n"), scale=9)
    return routes.select("origin_iata", "destination_iata", mean.cast("string").alias("mean_cargo"))


@query
def value_share(w: Warehouse) -> DataFrame:
    return op.value_share(table(w.spark, w.sf_dir, "orders"), "o_orderpriority")
