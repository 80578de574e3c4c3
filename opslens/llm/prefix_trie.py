"""Conversations rebuilt from shared openings, and the trie of their prefixes, by halving sequences.

The method is the recursion of a van Emde Boas layout.  A stretch of a sequence is cut at half its depth; the prefix
that ends at the cut gets a name, the upper half continues under the old root and the lower half under the named cut.
All stretches of one length are cut in the same round, so a sequence of n turns takes log n rounds, and rows halve:

* ``_block_names`` names halves: a stretch of 2^k turns is named by its two halves' names, from single turns up;
* ``_prefix_names`` cuts, from the longest stretch down: root name and the name of the upper half name the cut.  When
  stretches have one turn, every prefix has a name, equal for equal prefixes, and names group into nodes;
* ``_grafted`` takes totals up again: a lower half's total is grafted on its upper half, round by round, along the one
  sequence that owns a node, and owners that pass through a node add up there.

Rows are (conversation, place), so a conversation of a third of all turns is spread like any other, and equal
conversations are one sequence once they are named.  A name is 16 bytes of MD5 over names of fixed width.

Cases: rows are ordered by turn (null first), then role, then text; null role or text is empty.  Rows without conv_id
take no part.  Repeated rows are turns of their own.  An empty table gives no nodes.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opslens.llm.common import WORD, named, stage

#: Conversations that share an opening: c and the next lower multiple of this.
FAMILY = 20
#: An opening has fewer turns than this.
OPENINGS = 4
ROOT = bytes(16)
#: Ids that are joined to one text before they are hashed.
_IDS = 1 << 16
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def _name(*parts: Column) -> Column:
    return F.unhex(F.md5(F.concat(*parts)))


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of sorted turns within their conversation, as far as this partition has it."""
    task, last, done = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        if not len(batch):
            continue
        conv = batch.column("conv").to_numpy()
        first = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]]))
        size = np.diff(np.append(first, len(conv)))
        place = np.arange(len(conv)) - np.repeat(first, size) + 1
        if conv[0] == last:
            place[: size[0]] += done
        last, done = conv[-1], int(place[-1])
        yield pa.record_batch(
            {
                "task": pa.array(np.full(len(conv), task, np.int32)),
                "conv": batch.column("conv"),
                "place": pa.array(place.astype(np.int64)),
                "turn": batch.column("turn"),
                "words": batch.column("words"),
            }
        )


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv, pos from 1, turn, words) of the rebuilt conversations, and (conv, length) of all of them.

    Conversation c opens with the first h turns of c - c % FAMILY, h = crc32(c) % OPENINGS, then has its own from the
    one after its first h.  Turns are sorted by ranges and numbered within them, then shifted by what earlier ranges
    hold of the same conversation, so a long conversation is no task of its own.
    """
    read = named(turns, conv="conv_id", turn="turn", role="role", text="text").filter("conv is not null").fillna("", ["role", "text"])
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    ordered = read.withColumn("conv", F.col("conv").cast("long")).repartitionByRange(*order).sortWithinPartitions(*order)
    label = _name(F.length("role").cast("string").cast("binary"), F.lit(b":"), F.col("role").cast("binary"), F.col("text").cast("binary"))
    coded = ordered.select("conv", label.alias("turn"), F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"))
    numbered = stage(coded.mapInArrow(_number, "task int, conv long, place long, turn binary, words long"), "turns")
    pieces = numbered.groupBy("conv", "task").agg(F.max("place").alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    pieces = stage(pieces.withColumn("before", F.coalesce(before, F.lit(0))), "turn-pieces")
    sizes = pieces.groupBy("conv").agg(F.sum("n").alias("n"))
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % OPENINGS
    convs = sizes.select("conv", "n", h.alias("h"), (F.col("conv") - F.col("conv") % FAMILY).alias("base"))
    opening = sizes.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    shared = F.least("h", F.coalesce("base_n", F.lit(0)))
    convs = stage(
        convs.join(opening, "base", "left")
        .withColumn("shared", shared)
        .withColumn("length", F.col("shared") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
        .select("conv", "base", "h", "shared", "length"),
        "conversations",
    )
    at = F.col("place") + F.col("before")
    placed = numbered.join(pieces.join(convs, "conv").select("conv", "task", "before", "h", "shared"), ["conv", "task"])
    own = placed.filter(at > F.col("h")).select("conv", (at - F.col("h") + F.col("shared")).alias("pos"), "turn", "words")
    bases = numbered.filter(F.col("conv") % FAMILY == 0).join(pieces.select("conv", "task", "before"), ["conv", "task"])
    openings = bases.filter(at < OPENINGS).select(F.col("conv").alias("base"), at.alias("pos"), "turn", "words")
    opened = convs.join(openings, "base").filter(F.col("pos") <= F.col("shared")).select("conv", "pos", "turn", "words")
    return stage(own.unionByName(opened), "rebuilt"), convs.select("conv", "length")


def _block_names(turns: DataFrame, rounds: int) -> list[DataFrame]:
    """Per k below ``rounds`` the names of whole stretches of 2^k turns: (conv, j), turns j * 2^k + 1 and on."""
    levels = [turns.select("conv", (F.col("pos") - 1).alias("j"), F.col("turn").alias("block"))]
    for _ in range(1, rounds):
        half = F.struct("j", "block")
        pairs = levels[-1].groupBy("conv", F.shiftright("j", 1).alias("at")).agg(
            F.min(half).alias("upper"), F.max(half).alias("lower"), F.count(F.lit(1)).alias("n")
        )
        whole = pairs.filter("n = 2").select(
            "conv", F.col("at").alias("j"), _name(F.col("upper.block"), F.col("lower.block")).alias("block")
        )
        levels.append(stage(whole, "blocks"))
    return levels


def _prefix_names(convs: DataFrame, blocks: list[DataFrame]) -> DataFrame:
    """(conv, depth, name) of every prefix of every conversation, depth 0 included."""
    named_cuts = [convs.select("conv", F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("name"))]
    for k in reversed(range(len(blocks))):
        roots = reduce(DataFrame.unionByName, named_cuts)
        # Roots are at multiples of 2^(k+1); the cut is 2^k deeper, if the sequence has these turns.
        cut = roots.withColumn("j", F.shiftright("depth", k)).join(blocks[k], ["conv", "j"])
        below = cut.select("conv", (F.col("depth") + (1 << k)).alias("depth"), _name(F.col("name"), F.col("block")).alias("name"))
        named_cuts.append(stage(below, "cuts"))
    return reduce(DataFrame.unionByName, named_cuts)


def _grafted(own: DataFrame, owners: DataFrame, rounds: int, sums: list[str]) -> DataFrame:
    """Totals of ``own`` (conv, depth, sums) from each depth to the end of the sequence: (conv, depth, sums).

    ``owners`` has (conv, length).  Totals of stretches are added up by halves; then each stretch passes on what hangs
    below it, its upper half with the lower half's total grafted on.
    """
    totals = [own.select("conv", F.col("depth").alias("j"), *sums)]
    for _ in range(1, rounds):
        up = totals[-1].groupBy("conv", F.shiftright("j", 1).alias("j")).agg(*[F.sum(s).alias(s) for s in sums])
        totals.append(stage(up, "stretch-totals"))
    below = owners.select("conv", "length", F.lit(0).cast("long").alias("j"), *[F.lit(0).cast("long").alias(s) for s in sums])
    for k in reversed(range(rounds)):
        lower = totals[k].select("conv", (F.col("j") - 1).alias("upper"), *[F.col(s).alias(f"add_{s}") for s in sums])
        split = below.withColumn("upper", F.col("j") * 2).join(lower, ["conv", "upper"], "left")
        halves = F.inline(
            F.array(
                F.struct(F.col("upper").alias("j"), *[(F.col(s) + F.coalesce(f"add_{s}", F.lit(0))).alias(s) for s in sums]),
                F.struct((F.col("upper") + 1).alias("j"), *sums),
            )
        )
        below = stage(
            split.select("conv", "length", halves).filter(F.col("j") * (1 << k) <= F.col("length")), "grafts"
        )
    here = totals[0].select("conv", "j", *[F.col(s).alias(f"add_{s}") for s in sums])
    return below.join(here, ["conv", "j"], "left").select(
        "conv", F.col("j").alias("depth"), *[(F.col(s) + F.coalesce(f"add_{s}", F.lit(0))).alias(s) for s in sums]
    )


def _join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ends as texts of up to ``_IDS`` ids: (depth, name, first, ids)."""
    key, ids = None, []

    def piece() -> pa.RecordBatch:
        return pa.record_batch(
            {
                "depth": pa.array([key[0]], pa.int64()),
                "name": pa.array([key[1]], pa.binary()),
                "first": pa.array([ids[0]], pa.int64()),
                "ids": pa.array([",".join(map(str, ids))], pa.string()),
            }
        )

    for batch in batches:
        for depth, name, conv in zip(*(batch.column(c).to_pylist() for c in ("depth", "name", "conv")), strict=True):
            if ids and (key != (depth, name) or len(ids) == _IDS):
                yield piece()
                ids = []
            key = (depth, name)
            ids.append(conv)
    if ids:
        yield piece()


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's texts in a row, read as a stream."""
    key, state = None, None
    for batch in batches:
        out: list[tuple] = []
        for depth, name, ids in zip(*(batch.column(c).to_pylist() for c in ("depth", "name", "ids")), strict=True):
            if key == (depth, name):
                state.update(b",")
            else:
                if key is not None:
                    out.append((*key, state.hexdigest()))
                key, state = (depth, name), hashlib.sha256()
            state.update(ids.encode())
        yield _digests(out)
    if key is not None:
        yield _digests([(*key, state.hexdigest())])


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [(), (), ()]
    kinds = (("depth", pa.int64()), ("name", pa.binary()), ("ends_sha256", pa.string()))
    return pa.record_batch({c: pa.array(values, t) for (c, t), values in zip(kinds, columns, strict=True)})


def end_digests(ends: DataFrame) -> DataFrame:
    """(depth, name, ends_sha256) over the ids of ``ends`` (depth, name, conv), ascending and joined by commas.

    A hash of one long text cannot be split, but its text can: ids are sorted by ranges and joined there, and a node's
    few texts are then hashed as a stream.
    """
    keys = ["depth", "name", "conv"]
    texts = ends.select(*keys).repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(
        _join_ids, "depth long, name binary, first long, ids string"
    )
    joined = texts.repartition("depth", "name").sortWithinPartitions("depth", "name", "first")
    return joined.mapInArrow(_hash_ids, "depth long, name binary, ends_sha256 string")


def trie(turns: DataFrame) -> DataFrame:
    """A row per distinct prefix of the rebuilt conversations, with its counts and its subtree's totals.

    ``conv_id`` is the smallest conversation that has the prefix, ``parent_conv_id`` that of the prefix without its last
    turn.  ``saved_tokens`` counts, over the subtree, the words that sharing saves: each node's n_convs - 1 times the
    words of its last turn.
    """
    rows, convs = rebuilt(turns)
    deepest = convs.agg(F.max("length")).first()[0]
    rounds = max(int(deepest or 0), 1).bit_length()
    prefixes = _prefix_names(convs, _block_names(rows, rounds))
    ends = stage(prefixes.join(convs.select("conv", F.col("length").alias("depth")), ["conv", "depth"]), "ends")
    # Equal conversations are one sequence, owned by the smallest.
    same = ends.groupBy("depth", "name").agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("copies"))
    owners = stage(same.select("conv", "copies", F.col("depth").alias("length")), "owners")
    owned = stage(prefixes.join(owners.select("conv", "copies"), "conv"), "owned-prefixes")
    nodes = stage(
        owned.groupBy("depth", "name").agg(F.sum("copies").alias("n_convs"), F.min("conv").alias("conv")), "nodes"
    )
    above = owned.select("conv", (F.col("depth") + 1).alias("depth"), F.col("name").alias("parent"))
    words = rows.select("conv", F.col("pos").alias("depth"), "words")
    linked = stage(nodes.join(above, ["conv", "depth"], "left").join(words, ["conv", "depth"], "left"), "linked-nodes")
    below = linked.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("name"))
    children = below.agg(F.count(F.lit(1)).alias("n_children"))
    counted = stage(linked.join(children, ["depth", "name"], "left").fillna(0, ["n_children", "words"]), "counted-nodes")
    own = counted.select(
        "conv", "depth", (F.col("n_children") == 0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved")
    )
    paths = _grafted(own, owners.select("conv", "length"), rounds, ["leaves", "saved"])
    totals = owned.join(paths, ["conv", "depth"]).groupBy("depth", "name").agg(
        F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens")
    )
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("name").alias("parent"), F.col("conv").alias("parent_conv_id"))
    # Children lead the join, so that Spark can split those of a hot parent.
    return (
        counted.join(parents, ["depth", "parent"], "left")
        .join(totals, ["depth", "name"])
        .join(end_digests(ends), ["depth", "name"], "left")
        .select(
            F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(_NO_ENDS)).alias("ends_sha256"),
        )
    )
