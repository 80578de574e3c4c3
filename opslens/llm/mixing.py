"""Mixing sources to target weights.

Words are summed per source and shared out by weight, no source above ``most`` times its own size.  A
source's rate is its target divided by its size; each document is taken floor(rate) times, and once more
where a number made from its id falls below the fraction that is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslens.llm.common import WORD, named, stage
from opslens.operators.ranking import global_rank

#: Weights of the sources in code point order, repeating.
WEIGHTS = (1, 2, 3)
#: Times a source may be repeated.
MOST = 3


def words(text: Column) -> Column:
    """Words of a text, 0 for a null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def chance(doc_id: Column) -> Column:
    """A number in [0, 1) that depends on the id alone: 32 bits of its MD5.  A null id counts as empty text."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Targets of sources (source, source_size): all sizes shared out by weight, none above ``most`` times its size.

    What a stopped source leaves is shared by weight among the others until none is above; each round
    needs two sums over the sources, so their number does not matter.  A null source comes last.
    """
    ranked = global_rank(sizes, ["source"], "place", descending=False)
    cycle = F.array(*[F.lit(w).cast("long") for w in weights])
    found = stage(
        ranked.select(
            "source",
            "source_size",
            F.element_at(cycle, (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int")).alias("weight"),
        ),
        "sources",
    )
    limit = F.col("source_size") * most
    total, all_weights = found.agg(F.sum("source_size"), F.sum("weight")).first()
    rest, weight = total or 0, all_weights or 0
    while weight:
        # A source is stopped where its share is above its limit: rest * w / weight > limit, in whole numbers.
        share = F.col("weight").cast("decimal(38,0)") * F.lit(rest)
        above = share > limit.cast("decimal(38,0)") * F.lit(weight)
        stopped, stopped_weight = found.filter(above).agg(F.sum(limit), F.sum("weight")).first()
        after = (total - (stopped or 0), all_weights - (stopped_weight or 0))
        if after == (rest, weight):
            break
        rest, weight = after
    if not weight:
        return found.withColumn("target", limit.cast("double"))
    share = F.col("weight").cast("double") * F.lit(float(rest)) / F.lit(float(weight))
    return found.withColumn("target", F.least(limit.cast("double"), share))


def source_rates(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Source, source_size, target and rate from rows of (source, size).  A source without words has rate 0."""
    targets = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return targets.select("source", "source_size", "target", rate.alias("rate"))


def copies(doc_id: Column, rate: Column) -> Column:
    """floor(rate), and one more where the document's number falls below the fraction."""
    return F.floor(rate) + (chance(doc_id) < rate - F.floor(rate)).cast("long")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Documents (doc_id, text, source) with size, source_size, target, rate and copies.

    The choice depends on ids, sizes and sources only, so runs agree; rows of the same id are chosen alike.
    Null texts have size 0, null sources are one source, no documents give no rows.
    """
    rows = named(docs, doc_id="doc_id", text="text", source="source")
    sized = stage(rows.select("doc_id", "source", words(F.col("text")).alias("size")), "sizes")
    rates = source_rates(sized, weights, most).withColumnRenamed("source", "_source")
    # One row per source on the right; a hot source is on the left, where Spark splits it.
    return sized.join(rates, F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id", "source", "size", "source_size", "target", "rate", copies(F.col("doc_id"), F.col("rate")).alias("copies")
    )


def repeated(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, columns as they are."""
    sized = named(docs, text="text", source="source").select("source", words(F.col("text")).alias("size"))
    rates = source_rates(sized, weights, most).select("source", "rate")
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row"))
    taken = rows.join(rates, F.col("_row.source").eqNullSafe(F.col("source"))).select(
        "_row", copies(F.col("_row.doc_id"), F.col("rate")).cast("int").alias("copies")
    )
    again = taken.filter("copies > 0").select("_row", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return again.select("_row.*")
