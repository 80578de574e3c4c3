"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Runtime SQL settings.  They ask for what the plans are written for: runtime
#: re-planning, splitting of skewed join partitions even where that costs one
#: more exchange, and zone-free text to time conversion.  The method limit is the
#: size up to which the JVM compiles a method: the long projections of the
#: cleaning pipelines would otherwise be fused into one method it only interprets.
SQL_DEFAULTS = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set the runtime settings on an existing session and return it."""
    for key, value in SQL_DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", name: str = "opslens", memory: str = "16g") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    shuffle = "8" if cpus == "*" else str(cpus)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", shuffle)
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return apply_defaults(spark)
