"""The pipelines and reports on a small hand-made operation with every kind of defect."""

import datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from opslens.plans import cleaning, reports, summaries
from opslens.plans import vocabulary as v
from opslens.operators.ledger import kept_rows, reject_ledger
from opslens.plans.quality import all_ledgers, ledger_report, quality_report
from opslens.sources.schemas import clean_schema, raw_schema

RAW = {
    "airports": [
        (1, "aaa", None, "x", "p", None, None, None, "yes"),  # incomplete: must not hide the next
        (2, " AAA ", "  Alpha Field ", " alpha ", "north", "-1.5", "100.25", "34", "YES"),
        (3, "AAA", "Alpha again", "alpha", "north", "0", "0", "1", "no"),
        (4, "bbb", "Beta", "beta", "south", "abc", ".5", "12.5", "N/A"),
        (5, "ccc", "Gamma", "gamma", None, None, "5.", None, "0"),
        (6, "", "No code", "x", "y", None, None, None, None),
        (7, None, "No code", "x", "y", None, None, None, None),
        (8, " ", "Blank code is kept", "x", "y", None, None, None, None),
    ],
    "airlines": [
        (1, "q1", "  ", "A", "5", "aaa", "active"),  # blank name: must not hide the next
        (2, "Q1", " Quick ", None, "~120", " aaa", " Active "),
        (3, "q1", "Quick twice", "A", "1", "bbb", "inactive"),
        (4, "S1", "Slow", "None", "about 15", "bbb", "suspended"),
        (5, "T1", "Tiny", "Star", "many", None, "ACTIVE"),
        (6, "U1", "Tiny", "Star", "7", None, "active"),  # second carrier of the same name
        (7, None, "Nobody", None, None, None, None),
    ],
    "flights": [
        (1, "q1-1", "q1", "aaa", "bbb", "2023-10-01 06:00", "2023-10-01 07:00", "2023-10-01 06:05", "2023-10-01 07:05", "-3", " on time ", "X", "100.5", "10.5"),
        (2, "q1-2", "Q1", "bbb", "aaa", "2023-10-01 08:00", "2023-10-01 09:00", None, None, "40", "delay", "X", "50", "20"),
        (3, "q1-3", "Q1 ", "aaa", "ccc", "2023-10-01 05:00", "bad", None, None, "N/A", "Cancelled", "X", None, None),
        (4, "s1-1", "S1", "aaa", "bbb", "2023-10-01 06:00", None, None, None, "1", "OT", "X", "1", "1"),
        (5, "q1-4", "Q1", "aaa", "zzz", "2023-10-01 06:00", None, None, None, "1", "OT", "X", "1", "1"),
        (6, "t1-1", "T1", "bbb", "ccc", "2023-10-01 09:00", None, None, None, "20", "DELAYED", "X", "30", "-1"),
        (7, "u1-1", "U1", "bbb", "ccc", "2023-10-01 10:00", None, None, None, None, "late?", "X", "10", "4"),
        (8, "t1-2", "T1", "ccc", "bbb", "2023-10-01 11:00", None, None, None, "0", "OnTime", "X", "7", "5"),
    ],
    "passengers": [
        (1, 1, "ann lee-ray", "F", " wni", "Eco", "Rp 1.000", "2023-09-01", "YES"),
        (2, 1, " Ann Lee-Ray ", "F", "WNI", "BIZ", "9000", "2023-09-01", "no"),  # repeat
        (3, 1, "Ann Lee-Ray", "F", "WNI", "C", "3,000", "2023-09-02", "1"),
        (4, 2, "Bo", " male ", "WNA", "zzz", "2000", "2023-09-03", None),
        (5, 6, "Cy", "x", "WNA", "First", None, "bad day", "true"),
        (6, 99, "Di", "P", "WNA", "C", "500", "2023-09-03", "no"),  # unknown trip stays in the table
        (7, 1, "   ", "P", "WNA", "C", "500", "2023-09-03", "no"),
        (8, None, "Ed", "P", "WNA", "C", "500", "2023-09-03", "no"),
        (9, 7, "Flo", "L", "WNA", "Business", "4000", "2023-09-03", "no"),
    ],
    "incidents": [
        (1, 2, "2023-10-01", "bird-strike", "2", "Same Text", "yes"),
        (2, 2, "2023-10-01", "bird-strike", "CRITICAL", "same text", "no"),  # repeat
        (3, 2, "2023-10-01", "weather", "4", None, "1"),
        (4, 2, "2023-10-01", "weather", "Low", None, "no"),  # repeat: missing texts are one group
        (5, 6, "x", "MEDICAL", "odd", "b", None),
        (6, 99, "2023-10-01", "weather", "Low", "c", "no"),
        (7, None, "2023-10-01", "weather", "Low", "c", "no"),
        (8, 7, "2023-10-01", "weather", "HIGH", "d", "TRUE"),
    ],
}


@pytest.fixture(scope="module")
def raw(spark):
    return {name: spark.createDataFrame(data, raw_schema(name)) for name, data in RAW.items()}


@pytest.fixture(scope="module")
def clean(raw):
    t = {
        "airports": cleaning.clean_airports(raw["airports"]).cache(),
        "airlines": cleaning.clean_airlines(raw["airlines"]).cache(),
        "passengers": cleaning.clean_passengers(raw["passengers"]).cache(),
    }
    t["flights"] = cleaning.clean_flights(raw["flights"], t["airlines"], t["airports"]).cache()
    t["incidents"] = cleaning.clean_incidents(raw["incidents"], t["flights"]).cache()
    return t


def listed(df):
    return [tuple(float(x) if isinstance(x, Decimal) else x for x in r) for r in df.collect()]


def test_clean_schemas(clean):
    for name, df in clean.items():
        want = [(f.name, f.dataType) for f in clean_schema(name).fields]
        assert [(f.name, f.dataType) for f in df.schema.fields] == want, name


def test_clean_airports(clean):
    assert listed(clean["airports"].orderBy("airport_id")) == [
        (2, "AAA", "Alpha Field", "ALPHA", "NORTH", -1.5, 100.25, 34, True),
        (4, "BBB", "Beta", "BETA", "SOUTH", None, None, None, None),
        (5, "CCC", "Gamma", "GAMMA", None, None, 5.0, None, False),
        (8, "", "Blank code is kept", "X", "Y", None, None, None, None),
    ]


def test_clean_airlines(clean):
    assert listed(clean["airlines"].orderBy("airline_id")) == [
        (2, "Q1", "Quick", "None", 120, "AAA", "active"),
        (4, "S1", "Slow", "None", 15, "BBB", "suspended"),
        (5, "T1", "Tiny", "Star", None, None, "active"),
        (6, "U1", "Tiny", "Star", 7, None, "active"),
    ]


def test_clean_flights(clean):
    got = {r["flight_id"]: r for r in clean["flights"].collect()}
    assert sorted(got) == [1, 2, 3, 6, 7, 8]
    first = got[1]
    assert (first["flight_number"], first["airline_iata"], first["flight_status"]) == ("Q1-1", "Q1", "On Time")
    assert (first["delay_minutes"], first["passengers_onboard"], first["cargo_kg"]) == (0, 101, Decimal("10.500"))
    assert first["actual_dep"] == datetime.datetime(2023, 10, 1, 6, 5)
    assert (got[3]["scheduled_arr"], got[3]["delay_minutes"], got[3]["flight_status"]) == (None, None, "Cancelled")
    assert (got[6]["cargo_kg"], got[7]["flight_status"]) == (None, "Unknown")


def test_flights_first_record_per_id(spark, raw, clean):
    repeated = raw["flights"].withColumn("arrival", F.lit(2)).unionByName(
        raw["flights"].withColumn("arrival", F.lit(1)).withColumn("flight_status", F.lit("OT"))
    )
    got = cleaning.clean_flights(repeated, clean["airlines"], clean["airports"], first_by=["arrival"])
    assert got.count() == 6 and {r["flight_status"] for r in got.collect()} == {"On Time"}


def test_clean_passengers(clean):
    day = datetime.date(2023, 9, 1)
    got = listed(clean["passengers"].orderBy("passenger_id"))
    assert got[0] == (1, 1, "Ann Lee-Ray", "Female", "WNI", "Economy", 1000, day, True)
    assert [r[0] for r in got] == [1, 3, 4, 5, 6, 9]
    assert got[2][3:] == ("Unknown", "WNA", "Economy", 2000, datetime.date(2023, 9, 3), False)
    assert got[3][5:] == ("First", None, None, True)


def test_clean_incidents(clean):
    day = datetime.date(2023, 10, 1)
    assert listed(clean["incidents"].orderBy("incident_id")) == [
        (1, 2, day, "Bird-Strike", "Medium", "Same Text", True),
        (3, 2, day, "Weather", "Critical", None, True),
        (5, 6, None, "Medical", "Unknown", "b", False),
        (8, 7, day, "Weather", "High", "d", True),
    ]


def test_strict_pipeline_fails_on_bad_text(raw):
    with pytest.raises(PySparkException):
        cleaning.clean_passengers(raw["passengers"], mode="strict").collect()


def test_cleaning_cleaned_labels_changes_nothing(raw, clean):
    again = clean["airports"].select(*[F.col(c).cast("string").alias(c) if c != "airport_id" else F.col(c) for c in clean["airports"].columns])
    assert listed(cleaning.clean_airports(again.filter("iata_code <> ''")).orderBy("airport_id")) == listed(
        clean["airports"].filter("iata_code <> ''").orderBy("airport_id")
    )


def test_quality_report(raw, clean):
    got = listed(quality_report({name: (raw[name], clean[name]) for name in RAW}).orderBy("table_name"))
    assert got == [
        ("airlines", 7, 4, 3, 42.9),
        ("airports", 8, 4, 4, 50.0),
        ("flights", 8, 6, 2, 25.0),
        ("incidents", 8, 4, 4, 50.0),
        ("passengers", 9, 6, 3, 33.3),
    ]


@pytest.fixture(scope="module")
def tagged(raw, clean):
    return {
        "airports": cleaning.tag_airports(raw["airports"]),
        "airlines": cleaning.tag_airlines(raw["airlines"]),
        "flights": cleaning.tag_flights(raw["flights"], clean["airlines"], clean["airports"]),
        "passengers": cleaning.tag_passengers(raw["passengers"]),
        "incidents": cleaning.tag_incidents(raw["incidents"], clean["flights"]),
    }


@pytest.mark.parametrize("name", list(RAW))
def test_tagged_rows_that_are_kept_are_the_cleaned_ones(tagged, clean, name):
    rows, columns = tagged[name]
    got = kept_rows(rows).select(*columns)
    assert got.columns == clean[name].columns
    assert sorted(map(str, got.collect())) == sorted(map(str, clean[name].collect()))


def test_ledgers(tagged, raw, clean):
    ledgers = {name: reject_ledger(rows) for name, (rows, _) in tagged.items()}
    got = {(r.table_name, r.reason): r.n_rows for r in all_ledgers(ledgers).collect()}
    assert {k: n for k, n in got.items() if k[0] == "airports"} == {
        ("airports", "kept"): 4, ("airports", "no code"): 2, ("airports", "no name"): 1, ("airports", "duplicate"): 1,
    }
    assert got["airlines", "no name"] == 1 and got["airlines", "duplicate"] == 1 and got["airlines", "no code"] == 1
    assert got["flights", "inactive carrier"] == 1 and got["flights", "unknown destination"] == 1
    report = ledger_report(ledgers).orderBy("table_name")
    counted = quality_report({name: (raw[name], clean[name]) for name in RAW}).orderBy("table_name")
    assert listed(report) == listed(counted)


def test_strict_parsing_skips_rows_that_go(spark):
    """As in the pipeline, a bad number fails the job only in a row that is kept."""
    rows = [(1, None, "x", "c", "p", "bad", None, None, None), (2, "AA", "Alpha", "c", "p", "1.5", None, None, None)]
    raw = spark.createDataFrame(rows, raw_schema("airports"))
    tagged, columns = cleaning.tag_airports(raw, "strict")
    assert [r.airport_id for r in kept_rows(tagged).select(*columns).collect()] == [2]


def test_flight_listing_order_and_defaults(clean):
    got = listed(reports.flight_listing(clean["flights"], clean["airlines"], clean["airports"]))
    assert [r[0] for r in got] == ["Q1-3", "Q1-1", "Q1-2", "T1-1", "U1-1", "T1-2"]
    assert got[0][1:6] == ("Quick", "Alpha Field", "ALPHA", "Gamma", "GAMMA") and got[0][8] == 0


def test_incident_listing(clean):
    got = listed(reports.incident_listing(clean["flights"], clean["airlines"], clean["incidents"]))
    assert [(r[0], r[2], r[5], r[6]) for r in got] == [
        ("Q1-1", "AAA → BBB", None, "No Incident"),
        ("Q1-2", "BBB → AAA", "Medium", "true"),
        ("Q1-2", "BBB → AAA", "Critical", "true"),
        ("Q1-3", "AAA → CCC", None, "No Incident"),
        ("T1-1", "BBB → CCC", "Unknown", "false"),
        ("T1-2", "CCC → BBB", None, "No Incident"),
        ("U1-1", "BBB → CCC", "High", "true"),
    ]


def test_carrier_revenue(clean):
    got = listed(reports.carrier_revenue(clean["airlines"], clean["flights"], clean["passengers"]))
    # One price is missing: it counts as a passenger but not in the mean.
    assert got == [("Quick", 2, 3, 6000, 2000, 1, 2), ("Tiny", 2, 2, 4000, 4000, 1, 0)]


def test_above_average(clean):
    got = listed(reports.above_average(clean["flights"], clean["airlines"]))
    assert got == [("Q1-2", "Quick", "BBB → AAA", 40, 30.0)]


def test_punctuality_rank_merges_carriers_of_one_name(clean):
    got = listed(reports.punctuality_rank(clean["flights"], clean["airlines"]))
    assert got == [("Quick", 3, 1, 33.3, 1), ("Tiny", 3, 1, 33.3, 1)]


def test_incident_totals(clean):
    got = listed(reports.incident_totals(clean["incidents"], clean["flights"], clean["airlines"]))
    assert [(r[0], r[3], r[4]) for r in got] == [
        ("Q1-2", "Critical", 2),
        ("Q1-2", "Medium", 2),
        ("U1-1", "High", 1),
        ("T1-1", "Unknown", 1),
    ]


def test_route_performance(clean):
    got = {r[0]: r[1:] for r in listed(reports.route_performance(clean["flights"], clean["airports"]))}
    # TRUE and NULL is not TRUE, TRUE or NULL is; a cancelled route passes on its missing delay.
    assert got["AAA → BBB"] == ("ALPHA, NORTH", "BETA", v.ONE_INTERNATIONAL, 1, 0.0, 100.0, "Excellent", 101, 11)
    assert got["AAA → CCC"] == ("ALPHA, NORTH", "GAMMA", v.ONE_INTERNATIONAL, 1, 0.0, 0.0, "Fair", None, None)
    assert got["BBB → AAA"] == ("BETA, SOUTH", "ALPHA", v.ONE_INTERNATIONAL, 1, 40.0, 0.0, "Fair", 50, 20)
    # 20 and a missing delay: the mean is 10 over both trips.
    assert got["BBB → CCC"] == ("BETA, SOUTH", "GAMMA", v.NONE_INTERNATIONAL, 2, 10.0, 0.0, "Fair", 40, 4)
    assert got["CCC → BBB"][0] is None and got["CCC → BBB"][6] == "Excellent"


def test_hub_network_listing(clean):
    got = listed(reports.hub_network(clean["airports"], clean["flights"], "AAA"))
    assert [(r[0], r[1]) for r in got] == [(0, "AAA"), (1, "  BBB"), (1, "  CCC"), (2, "    BBB"), (2, "    CCC")]
    assert {r[4] for r in got} == {"AAA"}


def test_revenue_share(clean):
    got = listed(reports.revenue_share(clean["flights"], clean["airlines"], clean["passengers"]))
    # A trip without any price has no revenue at all and is ranked first.
    assert [(r[0], r[5], r[6], r[7], r[8], r[9]) for r in got] == [
        ("T1-1", None, None, 1, 1, None),
        ("Q1-1", 4000, 75.0, 2, 2, 40.0),
        ("U1-1", 4000, 100.0, 0, 2, 40.0),
        ("Q1-2", 2000, 0.0, 0, 4, 20.0),
    ]


def test_ops_kpi(clean):
    assert listed(reports.ops_kpi(clean["flights"])) == [(6, 3, 5, 198, 10.0, 33.3, 33.3, 16.7, 39.5)]


def test_ops_kpi_of_nothing(clean):
    assert listed(reports.ops_kpi(clean["flights"].limit(0))) == [(0, 0, 0, None, None, None, None, None, None)]


def test_busiest_places(clean):
    got = listed(reports.busiest_places(clean["airports"], clean["flights"]))
    assert [(r[0], r[3], r[4], r[5], r[6]) for r in got] == [
        ("BBB", 5, 3, 2, 1),
        ("CCC", 4, 1, 3, 2),
        ("AAA", 3, 2, 1, 3),
    ]


def test_movements_equal_union_of_both_ends(clean):
    flights = clean["flights"]
    both = flights.select(F.col("origin_iata").alias("c"), F.lit(1).alias("d")).unionAll(
        flights.select("destination_iata", F.lit(0))
    )
    want = both.groupBy("c").agg(F.sum("d"), F.sum(1 - F.col("d")))
    assert sorted(listed(reports.movements(flights))) == sorted(listed(want))


def test_safety_matrix(clean):
    got = listed(reports.safety_matrix(clean["incidents"], clean["flights"], clean["airlines"]))
    assert got == [("Quick", 0, 1, 0, 1, 2, 1), ("Tiny", 0, 0, 1, 0, 2, 2)]


def test_summaries(clean):
    flights, airlines, airports = clean["flights"], clean["airlines"], clean["airports"]
    passengers, incidents = clean["passengers"], clean["incidents"]
    trips = summaries.trip_frame(flights, airlines, airports)
    assert (trips.count(), len(trips.columns)) == (6, 17)
    people = summaries.passenger_frame(passengers, flights, airlines)
    assert (people.count(), len(people.columns)) == (6, 13)
    assert people.filter("airline_name IS NULL").count() == 1
    assert listed(summaries.status_share(flights)) == [
        ("Delayed", 2, 33.3), ("On Time", 2, 33.3), ("Cancelled", 1, 16.7), ("Unknown", 1, 16.7),
    ]
    assert [(r[0], round(r[1], 1), r[2]) for r in listed(summaries.on_time_by_carrier(flights, airlines))] == [
        ("Quick", 33.3, False), ("Tiny", 33.3, False),
    ]
    assert [r[3] for r in listed(summaries.delay_histogram(flights).orderBy("bin"))] == [1, 0, 0, 0, 0, 0, 0, 1]
    assert listed(summaries.delay_stats(flights)) == [(30.0, 30.0, 40)]
    pivot = summaries.revenue_pivot(passengers, flights, airlines)
    assert pivot.columns == ["airline_name", "Business", "Economy", "First"]
    assert sorted(listed(pivot)) == [("Quick", 3000, 3000, 0), ("Tiny", 4000, 0, 0)]
    assert listed(summaries.loyalty_mix(passengers)) == [("Frequent Flyer", 3), ("Regular", 3)]
    assert listed(summaries.loyalty_mix(passengers.drop("is_frequent_flyer"))) == [("Frequent Flyer", 0), ("Regular", 1)]
    assert sorted(listed(summaries.incident_pivot(incidents, flights, airlines))) == [
        ("Quick", 0, 1, 0, 1), ("Tiny", 0, 0, 1, 0),
    ]
    assert listed(summaries.top_places(flights, airports, 2)) == [
        ("CCC", 1, 3, 4, "CCC", "GAMMA"), ("BBB", 3, 2, 5, "BBB", "BETA"),
    ]


def test_carrier_with_unknown_severity_only_stays_with_zeros(clean):
    only = clean["incidents"].filter("severity = 'Unknown'")
    assert listed(summaries.incident_pivot(only, clean["flights"], clean["airlines"])) == [("Tiny", 0, 0, 0, 0)]


def test_repair_types(spark):
    flights = spark.createDataFrame([("x", "5", None), (None, "7.5", "1")], "delay_minutes string, passengers_onboard string, cargo_kg string")
    people = spark.createDataFrame([("12",), ("free",)], "ticket_price_idr string")
    fixed, priced = summaries.repair_types(flights, people)
    assert listed(fixed) == [(0.0, 5.0, None), (0.0, 7.5, 1.0)]
    assert listed(priced) == [(12.0,), (None,)]


def test_aggregating_before_joining_equals_joining_first(clean):
    """The literal form: join every booking, then group."""
    joined = (
        clean["flights"].join(clean["passengers"], "flight_id")
        .join(clean["airlines"].select(F.col("iata_code").alias("airline_iata"), "airline_name"), "airline_iata")
    )
    want = joined.groupBy("airline_name").agg(
        F.count_distinct("flight_id"), F.count("passenger_id"), F.sum("ticket_price_idr"),
        F.round(F.avg("ticket_price_idr")).cast("bigint"),
        F.count_if(F.col("ticket_class") == "Business"), F.count_if(F.col("ticket_class") == "Economy"),
    )
    got = reports.carrier_revenue(clean["airlines"], clean["flights"], clean["passengers"])
    assert sorted(listed(got)) == sorted(listed(want))
