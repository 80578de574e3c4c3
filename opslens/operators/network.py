"""Reachability along directed edges."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslens.sources.staging import stage


def state_bound(level: int, max_hops: int) -> int:
    """Most path sets a vertex keeps on a level: 1 + p + p^2 + ... to the number of hops left, p = level - 1."""
    return sum((level - 1) ** t for t in range(max_hops - level + 1)) if level > 1 else 1


def representatives(paths: DataFrame, hops_left: int) -> DataFrame:
    """Of (vertex, between) sets a few per vertex that can stand for all of them over ``hops_left`` more hops.

    For any ``hops_left`` vertices, if some set of a vertex holds none of them, a kept one holds none of them either.
    The first set of a vertex is kept; a continuation that it blocks meets one of its members, so for each member the
    first set without that member is kept, and so on, once per hop left.  A round takes a minimum per (vertex, members
    to avoid), which is combined before the exchange; a vertex that very many paths end at is a few rows per task.
    """
    first = paths.groupBy("vertex").agg(F.min("between").alias("between"))
    kept = [stage(first.withColumn("avoid", F.array().cast(paths.schema["between"].dataType)), "kept-paths")]
    for _ in range(hops_left):
        avoid = kept[-1].select("vertex", "avoid", F.explode("between").alias("member"))
        wider = avoid.select("vertex", F.array_sort(F.array_append("avoid", F.col("member"))).alias("avoid")).distinct()
        free = paths.join(wider, "vertex").filter(~F.arrays_overlap("between", "avoid"))
        kept.append(stage(free.groupBy("vertex", "avoid").agg(F.min("between").alias("between")), "kept-paths"))
    return reduce(DataFrame.unionByName, kept).select("vertex", "between").distinct()


def hop_network(
    nodes: DataFrame,
    edges: DataFrame,
    root: str,
    max_hops: int,
    node_key: str,
    src: str,
    dst: str,
) -> DataFrame:
    """``(level, vertex, root)``: vertices ending a path of ``level`` hops from ``root``.

    Paths never repeat a vertex.  This is not shortest distance: a vertex that
    can be reached in one hop and in two is listed at both levels.

    What can follow a path depends only on its end and the set of vertices
    between it and the root, and only few of these sets matter for the hops that
    are left (``representatives``): a level keeps at most ``state_bound`` of them
    per vertex, however many paths there are.  The last level keeps just the
    ends.  Parallel edges are merged beforehand.  Each level is staged, which
    cuts the lineage of the loop.
    """
    known = nodes.select(F.col(node_key).alias("dst")).filter(F.col("dst").isNotNull()).distinct()
    lanes = edges.select(F.col(src).alias("src"), F.col(dst).alias("dst")).distinct()
    lanes = lanes.filter((F.col("src") != F.col("dst")) & (F.col("dst") != root))
    lanes = stage(lanes.join(known, "dst", "left_semi"), "lanes")

    start = known.filter(F.col("dst") == root).select(F.col("dst").alias("vertex"))
    level_rows = [start.select(F.lit(0).alias("level"), "vertex")]
    # Sets hold neither the root nor the end: no lane leads to the one, and no path goes on from the other to itself.
    frontier = start.withColumn("between", F.array().cast(f"array<{lanes.schema['dst'].dataType.simpleString()}>"))
    for level in range(1, max_hops + 1):
        reached = frontier.join(lanes, F.col("vertex") == F.col("src")).filter(~F.array_contains("between", F.col("dst")))
        if level == max_hops:
            level_rows.append(reached.select(F.lit(level).alias("level"), F.col("dst").alias("vertex")).distinct())
            break
        via = F.array_sort(F.array_append("between", F.col("vertex"))) if level > 1 else F.col("between")
        paths = stage(reached.select(F.col("dst").alias("vertex"), via.alias("between")).distinct(), "paths")
        frontier = paths if level == 1 else stage(representatives(paths, max_hops - level), f"hop-{level}")
        level_rows.append(frontier.select(F.lit(level).alias("level"), "vertex").distinct())

    result = reduce(DataFrame.unionByName, level_rows)
    return result.withColumn("root", F.lit(root))
