"""Balance of tasks where a third of all rows hold one key, as table rows.

python benchmarks/skew.py [sf_dir] [times]: the cleaned tables of the folder, details repeated ``times`` times with every
third one moved to one trip, ranked and listed with 64 shuffle partitions, hardly any broadcast and a low skew
threshold.  Spark's event log goes to a new scratch folder.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

LOGS = tempfile.mkdtemp(prefix="opslens-events-")
os.environ["PYSPARK_SUBMIT_ARGS"] = (
    f"--conf spark.eventLog.enabled=true --conf spark.eventLog.dir=file:{LOGS} "
    "--conf spark.eventLog.rolling.enabled=false --conf spark.eventLog.compress=false pyspark-shell"
)

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from opslens import operators as op  # noqa: E402
from opslens.plans import reports  # noqa: E402
from opslens.session import local_session  # noqa: E402
from opslens.sources.staging import release, stage  # noqa: E402
from opslens.workload.tables import Warehouse  # noqa: E402

SF_DIR = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
TIMES = int(sys.argv[2]) if len(sys.argv) > 2 else 40
SETTINGS = {
    "spark.sql.shuffle.partitions": "64",
    "spark.sql.autoBroadcastJoinThreshold": "100k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1m",
}


def crowded(df: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """``df`` repeated, every third row with the one key of ``hot``."""
    rows = df.crossJoin(F.broadcast(hot.select(F.col(key).alias("__hot")))).withColumn("__copy", F.explode(F.sequence(F.lit(1), F.lit(TIMES))))
    moved = F.when(F.pmod(F.xxhash64("__copy", *df.columns), F.lit(3)) == 0, F.col("__hot")).otherwise(F.col(key))
    return stage(rows.withColumn(key, moved).select(*df.columns), "crowded")


def records_by_stage(app: str) -> dict[str, dict[int, list[int]]]:
    """Shuffle records read per task, by job description and stage."""
    name_of: dict[int, str] = {}
    found: dict[str, dict[int, list[int]]] = {}
    with open(f"{LOGS}/{app}") as lines:
        for line in lines:
            event = json.loads(line)
            if event["Event"] == "SparkListenerJobStart":
                for k in event["Stage IDs"]:
                    name_of[k] = event["Properties"].get("spark.job.description", "")
            elif event["Event"] == "SparkListenerTaskEnd" and event.get("Task Metrics"):
                read = event["Task Metrics"]["Shuffle Read Metrics"]["Total Records Read"]
                if read:
                    found.setdefault(name_of.get(event["Stage ID"], ""), {}).setdefault(event["Stage ID"], []).append(read)
    return found


def main() -> None:
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), name="opslens-skew")
    app = spark.sparkContext.applicationId
    warehouse = Warehouse(spark, SF_DIR)
    flights, airlines, incidents = warehouse.cleaned("flights", "airlines", "incidents")
    hot = flights.orderBy("flight_id").limit(1)
    details = crowded(incidents, "flight_id", hot)
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    shapes: dict[str, Callable[[], DataFrame]] = {
        "left_detail": lambda: op.left_detail(flights.select("flight_id", "flight_number"), details, "flight_id"),
        "incident listing": lambda: reports.incident_listing(flights, airlines, details),
        "rank of every detail by trip": lambda: op.global_rank(details.select("incident_id", "flight_id"), ["flight_id"], "r"),
    }
    for name, build in shapes.items():
        spark.sparkContext.setJobDescription(name)
        build().write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobDescription(None)
    release(spark)
    spark.stop()
    print("| stage | tasks | median | largest |\n| --- | --- | --- | --- |")
    for name, stages in records_by_stage(app).items():
        for k, reads in sorted(stages.items()):
            if name in shapes and sum(reads) > 100_000:
                print(f"| {name}, stage {k} | {len(reads)} | {statistics.median(reads):,.0f} | {max(reads):,} |")


if __name__ == "__main__":
    main()
