"""Literal against scalable form of the shapes that do not scale as usually written.

python benchmarks/forms.py [sf_dir]: best of three runs each, cleaned tables built first.
Prints the seconds of both.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import DataFrame, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from opslens import operators as op  # noqa: E402
from opslens.plans import reports  # noqa: E402
from opslens.session import local_session  # noqa: E402
from opslens.workload.raw_views import table  # noqa: E402
from opslens.workload.tables import Warehouse  # noqa: E402

SF_DIR = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"


def forms(w: Warehouse):
    flights, airlines, airports, passengers = w.cleaned("flights", "airlines", "airports", "passengers")
    lines = table(w.spark, w.sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")

    yield "rank of every row", (
        lambda: lines.withColumn("r", F.rank().over(Window.orderBy(F.col("l_partkey").desc()))),
        lambda: op.global_rank(lines, ["l_partkey"], "r"),
    )

    total = F.sum("l_partkey").over(Window.partitionBy())
    yield "share of total", (
        lambda: lines.withColumn("s", F.col("l_partkey") * 100 / total),
        lambda: op.share_of_total(lines, "l_partkey", "s"),
    )

    yield "exact median", (
        lambda: lines.agg(F.median("l_partkey"), F.avg("l_partkey"), F.max("l_partkey")),
        lambda: op.distribution_stats(lines, "l_partkey"),
    )

    yield "three distinct counts", (
        lambda: flights.agg(
            F.count_distinct("flight_id"),
            F.count_distinct("airline_iata"),
            F.count_distinct("origin_iata", "destination_iata"),
            F.sum("passengers_onboard"),
            F.sum("cargo_kg"),
        ),
        lambda: reports.ops_kpi(flights),
    )

    def union_movements() -> DataFrame:
        ends = [
            flights.join(airports, F.col("iata_code") == F.col(c)).groupBy("iata_code").agg(F.count("*").alias(n))
            for c, n in (("origin_iata", "d"), ("destination_iata", "a"))
        ]
        return ends[0].unionByName(ends[1], allowMissingColumns=True).groupBy("iata_code").agg(F.sum("d"), F.sum("a"))

    yield "movements", (union_movements, lambda: reports.movements(flights))

    def join_first() -> DataFrame:
        return (
            airlines.join(flights, F.col("iata_code") == F.col("airline_iata"))
            .join(passengers, "flight_id")
            .groupBy("airline_name")
            .agg(
                F.count_distinct("flight_id"),
                F.count("passenger_id"),
                F.sum("ticket_price_idr"),
                F.avg("ticket_price_idr"),
                F.sum(F.when(F.col("ticket_class") == "Business", 1).otherwise(0)),
                F.sum(F.when(F.col("ticket_class") == "Economy", 1).otherwise(0)),
            )
        )

    yield "revenue per carrier", (join_first, lambda: reports.carrier_revenue(airlines, flights, passengers))


def best(build) -> float:
    times = []
    for _ in range(3):
        start = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
    return min(times)


def main() -> None:
    spark = local_session(8, name="opslens-forms")
    for name, (literal, scalable) in forms(Warehouse(spark, SF_DIR)):
        print(f"| {name} | {best(literal):.2f} | {best(scalable):.2f} |", flush=True)


if __name__ == "__main__":
    main()
