"""Rows lost in cleaning."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslens.functions.numeric import percent_rounded
from opslens.operators.ledger import KEPT


def quality_report(tables: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """``(table_name, raw_rows, clean_rows, removed, removed_pct)`` per table.

    Plain counts, which read no column of a stored table.  Counters gathered
    while the pipelines write would count a task twice when it has to run again.
    """

    def line(name: str, raw: DataFrame, clean: DataFrame) -> DataFrame:
        kept = clean.agg(F.count(F.lit(1))).scalar()
        return (
            raw.agg(F.count(F.lit(1)).alias("raw_rows"))
            .withColumn("clean_rows", kept)
            .select(
                F.lit(name).alias("table_name"),
                "raw_rows",
                "clean_rows",
                (F.col("raw_rows") - F.col("clean_rows")).alias("removed"),
                percent_rounded(F.col("raw_rows") - F.col("clean_rows"), "raw_rows").alias("removed_pct"),
            )
        )

    return reduce(DataFrame.unionByName, [line(n, r, c) for n, (r, c) in tables.items()])


def all_ledgers(ledgers: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, reason, n_rows)``: why rows of each table went, and how many were kept."""
    return reduce(
        DataFrame.unionByName,
        [ledger.select(F.lit(name).alias("table_name"), "reason", "n_rows") for name, ledger in ledgers.items()],
    )


def ledger_report(ledgers: Mapping[str, DataFrame]) -> DataFrame:
    """The lines of ``quality_report`` out of ledgers, so that no table is read; a table without rows has no line."""
    kept = F.sum(F.when(F.col("reason") == KEPT, F.col("n_rows")).otherwise(0))
    counted = all_ledgers(ledgers).groupBy("table_name").agg(F.sum("n_rows").alias("raw_rows"), kept.alias("clean_rows"))
    removed = F.col("raw_rows") - F.col("clean_rows")
    return counted.select(
        "table_name", "raw_rows", "clean_rows", removed.alias("removed"), percent_rounded(removed, "raw_rows").alias("removed_pct")
    )
