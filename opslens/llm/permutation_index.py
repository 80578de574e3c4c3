"""Approximate nearest neighbours by a permutation index.

A vector is represented by the order of its nearest pivots: near vectors see the pivots in a like order.  The index
deals vectors into shards; each shard posts its vectors under their nearest pivots, with the place each pivot
has.  A query reads the postings of its own nearest pivots, ranks the shard's vectors by Spearman's footrule
between the orders, and measures the first of them exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opslens.llm.common import hash_sample, named, stage

#: Pivots, a bounded sample of the vectors, and how many of them an order keeps.
PIVOTS = 512
PREFIX = 128
#: Share of a shard's vectors that is measured exactly, and least number of them, in neighbours asked for.
MEASURED = 0.08
LEAST_MEASURED = 4
#: Vectors of a shard, on average, and queries that meet a shard at once.
SHARD_VECTORS = 4096
QUERY_BLOCK = 16_384
#: Neighbours of a query.
NEIGHBOURS = 10


def usable(vectors: DataFrame) -> DataFrame:
    """Rows (vec_id, vector) that take part, vectors as doubles.

    Left out are null ids, null and zero vectors, null or non-finite components, and vectors that have not the most
    frequent number of components (the least of several).
    """
    rows = named(vectors, vec_id="vec_id", vector="vector").select("vec_id", F.col("vector").cast("array<double>").alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.filter(F.col("vec_id").isNotNull() & ~bad & F.exists("vector", lambda x: x != 0))
    size = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("vector") == (size["n"] if size else 0))


def choose_pivots(rows: DataFrame, pivots: int = PIVOTS) -> np.ndarray:
    """Distinct vectors of the lowest id hashes; equal vectors, however many, give one pivot."""
    some = hash_sample(rows, 4 * pivots, "vec_id", "vector")
    found = list(dict.fromkeys(tuple(r["vector"]) for r in some))[:pivots]
    return np.array(found, np.float64)


def orders(vectors: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """Each vector's nearest pivots, nearest first, ties by pivot number."""
    near = (pivots**2).sum(axis=1) - 2 * vectors @ pivots.T
    return np.argsort(near, axis=1, kind="stable")[:, :prefix]


_SHARD = "shard long, ids array<long>, vectors array<double>, posted array<int>, rows array<int>, close array<int>"


def build(rows: DataFrame, pivots: np.ndarray, prefix: int = PREFIX, shard_vectors: int = SHARD_VECTORS) -> DataFrame:
    """The index: one row per shard, staged.

    ``ids`` ascend; ``rows`` and ``close`` are the inverted files of all pivots in a row, those of pivot p from
    posted[p] to posted[p + 1]: a vector's row, and the prefix length less the place that p has in its order.
    """
    prefix = min(prefix, len(pivots))
    shards = max(1, -(-rows.count() // shard_vectors))

    def post(table: pa.Table) -> pa.Table:
        ids = table.column("vec_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        vectors = table.column("vector").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)[order]
        near = orders(vectors, pivots, prefix).ravel()
        row, close = np.repeat(np.arange(len(ids)), prefix), np.tile(prefix - np.arange(prefix), len(ids))
        by = np.argsort(near, kind="stable")
        posted = np.concatenate([[0], np.cumsum(np.bincount(near, minlength=len(pivots)))])
        one = lambda values, kind: pa.array([values], pa.list_(kind))
        return pa.table(
            {
                "shard": table.column("shard")[:1],
                "ids": one(ids, pa.int64()),
                "vectors": one(vectors.ravel(), pa.float64()),
                "posted": one(posted.astype(np.int32), pa.int32()),
                "rows": one(row[by].astype(np.int32), pa.int32()),
                "close": one(close[by].astype(np.int32), pa.int32()),
            }
        )

    # Dealt by row, not by id: rows of one id are spread.
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)))
    return stage(dealt.groupBy("shard").applyInArrow(post, _SHARD), "permutation-index")


def search(
    index: DataFrame,
    queries: DataFrame,
    pivots: np.ndarray,
    prefix: int = PREFIX,
    neighbours: int = NEIGHBOURS,
    measured: float = MEASURED,
    least: int = LEAST_MEASURED,
) -> DataFrame:
    """Per query (vec_id, vector) its nearest found: query_id, rank, vec_id, score (Euclidean distance).

    All queries meet all shards, a block of queries with a shard at a time.  An id is found once, at its nearest
    vector, and never by a query of the same id.  Ties go to the lesser id.
    """
    prefix = min(prefix, len(pivots))

    def find(key: tuple, shard: pa.Table, block: pa.Table) -> pa.Table:
        out_query, out_id, out_score = [], [], []
        if len(shard) and len(block):
            lists = {c: shard.column(c).combine_chunks().flatten().to_numpy() for c in ("ids", "vectors", "posted", "rows", "close")}
            ids, posted, rows, close = lists["ids"], lists["posted"], lists["rows"], lists["close"]
            vectors = lists["vectors"].reshape(len(ids), -1)
            asked = block.column("vector").combine_chunks().flatten().to_numpy().reshape(len(block), -1)
            keep = min(len(ids), max(least * neighbours, int(np.ceil(measured * len(ids)))))
            near = orders(asked, pivots, prefix)
            for q, query_id in enumerate(block.column("vec_id").to_pylist()):
                files = [slice(posted[p], posted[p + 1]) for p in near[q]]
                # Twice the common closeness is what footrule falls short of its value for strangers.
                common = np.concatenate([np.minimum(close[f], prefix - k) for k, f in enumerate(files)])
                short = np.bincount(np.concatenate([rows[f] for f in files]), common, len(ids))
                first = np.argsort(-short, kind="stable")[:keep]
                first = first[ids[first] != query_id]
                score = np.sqrt(((vectors[first] - asked[q]) ** 2).sum(axis=1))
                order = np.lexsort((ids[first], score))
                _, once = np.unique(ids[first][order], return_index=True)
                order = order[np.sort(once)][:neighbours]
                out_query.append(np.full(len(order), query_id))
                out_id.append(ids[first][order])
                out_score.append(score[order])
        join = lambda parts, kind: pa.array(np.concatenate(parts) if parts else [], kind)
        return pa.table(
            {"query_id": join(out_query, pa.int64()), "vec_id": join(out_id, pa.int64()), "score": join(out_score, pa.float64())}
        )

    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    shards = index.select("shard").withColumnRenamed("shard", "_shard")
    spread = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    # One number per shard, so that a block is sent to each.
    numbers = shards.agg(F.sort_array(F.collect_list("_shard")).alias("numbers"))
    asked = queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    asked = asked.withColumn("shard", F.explode(numbers.scalar()))
    found = (
        spread.groupBy("shard", "block")
        .cogroup(asked.select("shard", "block", "vec_id", "vector").groupBy("shard", "block"))
        .applyInArrow(find, "query_id long, vec_id long, score double")
    )
    nearest = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return nearest.withColumn("rank", place).filter(F.col("rank") <= neighbours).select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, every: int, pivots: int = PIVOTS, **options) -> DataFrame:
    """Index all usable ``vectors`` (vec_id, vector) and search those whose id is divisible by ``every``.

    Without usable vectors, or without queries among them, there are no rows."""
    rows = stage(usable(vectors), "vectors")
    chosen = choose_pivots(rows, pivots)
    if not len(chosen):
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    index = build(rows, chosen)
    return search(index, rows.filter(F.col("vec_id") % every == 0), chosen, **options)
