"""First and second run and shuffle volume of every registered query, as table rows.

python benchmarks/query_costs.py [sf_dir]: Spark's event log goes to a new scratch folder.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

LOGS = tempfile.mkdtemp(prefix="opslens-events-")
os.environ["PYSPARK_SUBMIT_ARGS"] = (
    f"--conf spark.eventLog.enabled=true --conf spark.eventLog.dir=file:{LOGS} "
    "--conf spark.eventLog.rolling.enabled=false --conf spark.eventLog.compress=false pyspark-shell"
)

from opslens.session import local_session  # noqa: E402
from opslens.workload.queries import all_queries  # noqa: E402
from opslens.workload.tables import TABLES, Warehouse  # noqa: E402

SF_DIR = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"


def shuffle_by_job_group(app: str) -> dict[str, int]:
    """Shuffle bytes written, by the job group the stage ran in."""
    group_of, written = {}, {}
    with open(f"{LOGS}/{app}") as lines:
        for line in lines:
            event = json.loads(line)
            if event["Event"] == "SparkListenerJobStart":
                for stage in event["Stage IDs"]:
                    group_of.setdefault(stage, event["Properties"].get("spark.jobGroup.id", ""))
            elif event["Event"] == "SparkListenerTaskEnd" and event.get("Task Metrics"):
                size = event["Task Metrics"]["Shuffle Write Metrics"]["Shuffle Bytes Written"]
                group = group_of.get(event["Stage ID"], "")
                written[group] = written.get(group, 0) + size
    return written


def main() -> None:
    spark = local_session(8, name="opslens-profile")
    warehouse = Warehouse(spark, SF_DIR)
    rows = []

    def timed(name: str, work) -> float:
        spark.sparkContext.setJobGroup(name, name)
        start = time.perf_counter()
        work()
        return time.perf_counter() - start

    for name in TABLES:
        rows.append((f"build:{name}", timed(f"build:{name}", lambda n=name: warehouse.clean(n)), None))
    for name, run in all_queries().items():

        def work(run=run):
            run(spark, SF_DIR).write.format("noop").mode("overwrite").save()

        rows.append((name, timed(name, work), timed(f"{name}#2", work)))
    app = spark.sparkContext.applicationId
    spark.stop()
    moved = shuffle_by_job_group(app)
    for name, first, second in rows:
        size = moved.get(name if second is None else f"{name}#2", 0) / 1e6
        print(f"| {name} | {first:.2f} | {'' if second is None else f'{second:.2f}'} | {size:.1f} |")


if __name__ == "__main__":
    main()
