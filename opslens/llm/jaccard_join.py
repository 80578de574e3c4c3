"""All pairs of texts whose word n-gram sets have a Jaccard similarity of at least a threshold.

MinHash signatures are cut into bands; texts that agree on a band may be alike, and the number of bands and rows
follows from the share of pairs at the threshold that must be found.  Equal texts are one text with copies.
The texts of a bucket follow its least text, the bucket's centre, so that the buckets of a group of near copies
fall together.  The followers of a centre are compared on their full n-gram sets, block against block, and a
pair counts under the least centre both have.  What leaves a comparison is a row per text: its links, and a
text it hangs together with.  So rows grow with the texts, though links may grow with their square.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslens.llm.common import batch_slices, named, stage
from opslens.llm.components import components
from opslens.llm.textbytes import mix, shingles

#: Words of a shingle, least similarity, and share of the pairs at just that similarity to be found.
SHINGLE = 5
SIMILARITY = Fraction(4, 5)
RECALL = 0.99999
#: Most hashes of a signature.
MAX_HASHES = 160
#: Texts of a block.
BLOCK = 512
#: A shingle of more texts of a comparison is counted by matrix product, of fewer by pairs.
_DENSE = 24
_COLUMNS = 4096


def banding(similarity: Fraction = SIMILARITY, recall: float = RECALL, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """Bands and rows: the most rows (fewest chance candidates) whose bands reach the recall within ``max_hashes``."""
    found = None
    for rows in range(1, max_hashes + 1):
        hit = float(similarity) ** rows
        if hit * max_hashes < 1e-6:
            break
        bands = 1 if hit >= recall else math.ceil(math.log1p(-recall) / math.log1p(-hit))
        if bands * rows <= max_hashes:
            found = bands, rows
    if not found:
        raise ValueError("max_hashes is too small for this recall")
    return found


def band_hashes(hashes: np.ndarray, offsets: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A hash per text and band of the least values of its shingles; texts must have shingles."""
    seeds = np.random.default_rng(20240229).integers(0, 1 << 32, size=(2, bands * rows), dtype=np.uint32)
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    buffer = np.empty_like(short)
    out = np.zeros((len(offsets) - 1, bands), np.uint64)
    for band in range(bands):
        value = np.full(len(offsets) - 1, band + 1, np.uint64)
        for k in range(band * rows, (band + 1) * rows):
            np.multiply(short, seeds[0, k] | np.uint32(1), out=buffer)
            np.add(buffer, seeds[1, k], out=buffer)
            value = mix(value + np.minimum.reduceat(buffer, offsets[:-1]).astype(np.uint64))
        out[:, band] = value
    return out


def _keys(text: Column) -> list[Column]:
    """128 bits that stand for a text; a null text is empty."""
    text = F.coalesce(text, F.lit(""))
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text, F.length(text)).alias("k2")]


def signatures(texts: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """k1, k2 and the band hashes of texts (k1, k2, text) that have words."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in batch_slices(batch, "text", 1 << 21):
                hashes, offsets = shingles(some.column("text"), size)
                filled = np.flatnonzero(np.diff(offsets))
                if not len(filled):
                    continue
                found = band_hashes(hashes, np.append(offsets[filled], offsets[-1]), bands, rows)
                ends = np.arange(len(filled) + 1, dtype=np.int32) * bands
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(found.view(np.int64).ravel()))
                keep = pa.array(filled)
                yield pa.RecordBatch.from_arrays(
                    [some.column("k1").take(keep), some.column("k2").take(keep), lists], ["k1", "k2", "bands"]
                )

    return texts.mapInArrow(sign, "k1 long, k2 long, bands array<long>")


def overlaps(owner: np.ndarray, shingle: np.ndarray, n: int) -> np.ndarray:
    """Shared shingles of each two of n sets, from the sets' distinct (owner, shingle) rows."""
    _, column, size = np.unique(shingle, return_inverse=True, return_counts=True)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    size_of = size[column]
    # Shingles of few sets: every ordered pair of rows with the same shingle, by their distance.
    few = (size_of > 1) & (size_of <= _DENSE)
    o, c = owner[few], column[few]
    out = np.zeros(n * n, np.int64)
    for gap in range(1, _DENSE):
        same = np.flatnonzero(c[gap:] == c[:-gap]) if len(c) > gap else np.empty(0, int)
        if not len(same):
            break
        out += np.bincount(o[same] * n + o[same + gap], minlength=n * n)
    out = out.reshape(n, n)
    out = out + out.T
    # Shingles of many sets: products of 0/1 columns, some at a time.
    many = size_of > _DENSE
    o, c = owner[many], column[many]
    if len(c):
        rank = np.cumsum(np.concatenate([[0], np.diff(c) > 0]))
        for first in range(0, rank[-1] + 1, _COLUMNS):
            here = (rank >= first) & (rank < first + _COLUMNS)
            ones = np.zeros((n, min(_COLUMNS, rank[-1] + 1 - first)), np.float32)
            ones[o[here], rank[here] - first] = 1
            out += np.rint(ones @ ones.T).astype(np.int64)
    return out


def local_roots(linked: np.ndarray) -> np.ndarray:
    """Least member of each member's component in a symmetric link matrix."""
    label = np.arange(len(linked))
    near = linked | np.eye(len(linked), dtype=bool)
    while True:
        after = np.where(near, label, len(label)).min(axis=1)
        after = after[after]
        if (after == label).all():
            return label
        label = after


_FOUND = "k1 long, k2 long, links long, root1 long, root2 long"


def _compare(size: int, similarity: Fraction):
    """Compares the texts of two blocks of a centre, or of one with itself."""

    def run(table: pa.Table) -> pa.Table:
        n = len(table)
        centre = table.column("centre")[0].as_py()
        block = table.column("block").to_numpy()
        k1, k2 = table.column("k1").to_numpy(), table.column("k2").to_numpy()
        owners, hashes = [], []
        at = 0
        for batch in table.select(["text"]).combine_chunks().to_batches():
            for some in batch_slices(batch, "text"):
                found, offsets = shingles(some.column("text"), size)
                owners.append(np.repeat(np.arange(at, at + len(some)), np.diff(offsets)))
                hashes.append(found)
                at += len(some)
        owner, shingle = np.concatenate(owners), np.concatenate(hashes)
        order = np.lexsort((shingle, owner))
        owner, shingle = owner[order], shingle[order]
        new = np.ones(len(owner), dtype=bool)
        new[1:] = (owner[1:] != owner[:-1]) | (shingle[1:] != shingle[:-1])
        owner, shingle = owner[new], shingle[new]
        sets = np.bincount(owner, minlength=n)
        shared = overlaps(owner, shingle, n)
        top, bottom = similarity.numerator, similarity.denominator
        linked = (top + bottom) * shared >= top * (sets[:, None] + sets)
        np.fill_diagonal(linked, False)
        if len(np.unique(block)) > 1:
            linked &= block[:, None] != block
        # Pairs that also follow a lesser centre count there.
        lists = table.column("centres").combine_chunks()
        of = np.repeat(np.arange(n), np.diff(lists.offsets.to_numpy()))
        values = lists.flatten().to_numpy()
        lesser, where = np.unique(values[values < centre], return_inverse=True)
        if len(lesser):
            follows = np.zeros((n, len(lesser)), np.float32)
            follows[of[values < centre], where] = 1
            linked &= follows @ follows.T == 0
        links = linked @ table.column("copies").to_numpy()
        root = local_roots(linked)
        have = np.flatnonzero(linked.any(axis=1))
        return pa.table(
            {"k1": k1[have], "k2": k2[have], "links": links[have], "root1": k1[root[have]], "root2": k2[root[have]]}
        )

    return run


def links(docs: DataFrame, size: int = SHINGLE, similarity: Fraction = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """One row per document (doc_id, text): doc_id, k1, k2, copies, n_links, class_id, label.

    n_links counts the other documents whose n-gram sets are at least ``similarity`` alike, equal texts included;
    class_id is the least doc_id that links reach (null where all are null), label the text they all share.  Texts
    under ``size`` words have one shingle of all their words.  Texts without words, null among them, are linked to
    equal texts only.  No documents give no rows.
    """
    bands, rows = banding(similarity, recall)
    given = named(docs, doc_id="doc_id", text="text").select("doc_id", "text", *_keys(F.col("text")))
    members = stage(given.select("doc_id", "k1", "k2"), "members")
    copies = members.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first_id"))
    copies = stage(copies, "copies")

    signed = stage(signatures(given.select("k1", "k2", "text"), size, bands, rows), "signatures")
    buckets = signed.select("k1", "k2", F.explode("bands").alias("bucket"))
    centres = (
        buckets.groupBy("bucket")
        .agg(F.min("k1").alias("centre"), F.max("k1").alias("other"))
        .filter("centre != other")
        .select("bucket", "centre")
    )
    # The right sides are staged: joins then have exchanges of their own, and Spark can split a hot bucket or text.
    centres = stage(centres, "centres")
    follows = stage(buckets.join(centres, "bucket").select("k1", "k2", "centre").distinct(), "followers")
    # At most one centre a band.
    lists = follows.groupBy("k1", "k2").agg(F.sort_array(F.collect_set("centre")).alias("centres"))
    blocks = follows.groupBy("centre").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    blocks = stage(blocks, "blocks")
    candidates = stage(lists.join(copies, ["k1", "k2"]), "candidates")
    # Of copies, the row of the least id: the id is part of the join key, so a text of many copies is spread.  The
    # join is a merge at every size: candidates grow with the texts, and a plan that changes on the way helps nobody.
    wanted = candidates.select("k1", "k2", "first_id").hint("merge")
    same = [given["k1"] == wanted["k1"], given["k2"] == wanted["k2"], given["doc_id"].eqNullSafe(wanted["first_id"])]
    texts = given.join(wanted, same, "left_semi").groupBy("k1", "k2").agg(F.first("text").alias("text"))
    texts = stage(texts.join(candidates.drop("first_id"), ["k1", "k2"]), "candidate-texts")

    dealt = follows.join(blocks, "centre").withColumn("block", F.pmod(F.col("k2"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = dealt.select("k1", "k2", "centre", "block", other).select(
        "k1", "k2", "centre", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    )
    pairs = dealt.join(texts, ["k1", "k2"]).groupBy("centre", "low", "high")
    found = stage(pairs.applyInArrow(_compare(size, similarity), _FOUND), "links")

    near = found.groupBy("k1", "k2").agg(F.sum("links").alias("links"))
    edges = found.select(F.struct("k1", "k2").alias("u"), F.struct(F.col("root1").alias("k1"), F.col("root2").alias("k2")).alias("v"))
    grouped = components(edges.filter("u != v").distinct()).select("v.k1", "v.k2", "label")
    grouped = stage(grouped.join(near, ["k1", "k2"]).join(copies.select("k1", "k2", "first_id"), ["k1", "k2"]), "groups")
    classes = grouped.groupBy("label").agg(F.min("first_id").alias("class_id"))
    joined = grouped.join(classes, "label").select("k1", "k2", "links", "label", "class_id")
    known = copies.join(joined, ["k1", "k2"], "left").select(
        "k1",
        "k2",
        "copies",
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.when(F.col("label").isNull(), F.col("first_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("label", F.struct("k1", "k2")).alias("label"),
    )
    # A text of many copies is on the left, where Spark splits it.
    return members.join(stage(known, "classes"), ["k1", "k2"]).select(
        "doc_id", "k1", "k2", "copies", "n_links", "class_id", "label"
    )


def keep_one(docs: DataFrame, size: int = SHINGLE, similarity: Fraction = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """``docs`` with one row of each group that links hang together: the least doc_id (null last), columns as they are."""
    # Staged: both aggregates read it, each with an exchange of its own, so that a text of many copies is spread.
    found = stage(links(docs, size, similarity, recall), "linked")
    row = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "k1", "k2")
    first = found.groupBy("label").agg(F.min(row).alias("first")).select("first.*")
    many = found.groupBy("doc_id", "k1", "k2").agg(F.count(F.lit(1)).alias("same"))
    on = ["k1", "k2"]
    chosen = first.join(many.withColumnRenamed("doc_id", "_id"), on).filter(F.col("doc_id").eqNullSafe(F.col("_id")))
    chosen = stage(chosen.select(F.col("doc_id").alias("_id"), "k1", "k2", "same"), "chosen")
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row"), *_keys(docs["text"]))
    kept = rows.join(chosen, on).filter(F.col("_row.doc_id").eqNullSafe(F.col("_id")))
    # Rows that agree in id and text: any one of them, found among those rows alone.
    alone = kept.filter("same = 1").select("_row")
    again = kept.filter("same > 1").groupBy("k1", "k2", "_id").agg(F.min("_row").alias("_row")).select("_row")
    return alone.unionByName(again).select("_row.*")
