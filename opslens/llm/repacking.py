"""Best-fit packing of documents into sequences, certified by dual-feasible lower bounds.

Documents become pieces (id ranges); pieces are dealt into groups of bounded size and each group is packed
best-fit decreasing.  A dual-feasible function maps lengths so that no full sequence maps above 1, so the
mapped total, rounded up, is a number of sequences no packing of the group can beat.  A group that
reaches its bound is done.  Groups with a gap keep their full sequences and exchange the rest: several of
them are thrown together and packed anew, and the new packing stands where it needs fewer sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslens.llm.common import batch_slices, named, stage
from opslens.llm.encode import encoder, with_end

#: Tokens of a sequence.
CAPACITY = 2048
#: Pieces of a group, on average.
GROUP_PIECES = 16_384
#: Groups with a gap that exchange documents, on average.
FAN = 8

#: Text that is encoded at once, in bytes.
_SLICE = 1 << 20
#: Group numbers of a round start at a multiple of one, sequence numbers of a group at a multiple of the other.
_ROUND, _BINS = 1 << 36, 1 << 22

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """Documents (doc_id, text) as pieces of at most ``capacity`` ids.

    A document is its ids and an end id, so a null or empty text has one.  Only longer documents are cut; all
    pieces but the first are full, so each document leaves at most one piece that must share.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in batches:
            for some in batch_slices(batch, "text", _SLICE):
                ids, offsets = with_end(*encode.encode(some.column("text")))
                ids, lengths = ids.astype("<u4"), np.diff(offsets)
                counts = -(-lengths // capacity)
                row = np.repeat(np.arange(len(some)), counts)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
                first = (lengths - 1) % capacity + 1
                start = np.where(piece > 0, first[row] + (piece - 1) * capacity, 0)
                length = np.where(piece > 0, capacity, first[row])
                at = offsets[row] + start
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(at, at + length, strict=True)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": some.column("doc_id").take(pa.array(row)),
                        "piece": pa.array(piece, pa.int32()),
                        "start": pa.array(start, pa.int64()),
                        "length": pa.array(length, pa.int64()),
                        "ids_crc32": pa.array(crc, pa.int64()),
                    }
                )

    rows = named(docs, doc_id="doc_id", text="text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(cut, PIECES)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Sequences that ``lengths`` need at least: the best of three families of dual-feasible functions."""
    if not len(lengths):
        return 0
    counts = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    sizes = np.arange(capacity + 1)
    half = capacity // 2
    best = -(-int(counts @ sizes) // capacity)
    # Lengths over capacity - e take a whole sequence, those under e nothing.
    many, total = np.concatenate([[0], np.cumsum(counts)]), np.concatenate([[0], np.cumsum(counts * sizes)])
    e = np.arange(half + 1)
    whole = many[-1] - many[capacity - e + 1]
    rest = total[capacity - e + 1] - total[e]
    best = max(best, int((whole + -(-rest // capacity)).max()))
    # Steps of 1 / k: (k + 1) x / capacity rounded down, but lengths that divide evenly keep their share.
    for k in range(1, min(100, capacity) + 1):
        scaled = (k + 1) * sizes
        even = scaled % capacity == 0
        steps, share = int(counts[~even] @ (scaled[~even] // capacity)), int(counts[even] @ sizes[even])
        best = max(best, -(-(steps * capacity + share * k) // (k * capacity)))
    # In units of e: small lengths count one unit, large ones the units that what they leave cannot hold.
    for e in range(1, half + 1):
        units = capacity // e
        small, large = counts[e : half + 1].sum(), counts[half + 1 :]
        used = units * large.sum() - large @ ((capacity - sizes[half + 1 :]) // e)
        best = max(best, -(-int(small + used) // units))
    return best


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Best-fit decreasing: each length's sequence and offset, and the number of sequences."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    free: list[list[int]] = [[] for _ in range(capacity + 1)]  # open sequences by what is left
    left = n = 0  # bit r of left: a sequence with r left exists
    for i, length in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fits = left >> length
        if fits:
            room = length + (fits & -fits).bit_length() - 1
            b = free[room].pop()
            if not free[room]:
                left &= ~(1 << room)
        else:
            room, b, n = capacity, n, n + 1
        bins[i], offsets[i] = b, capacity - room
        rest = room - length
        if rest:
            free[rest].append(b)
            left |= 1 << rest
    return bins, offsets, n


_PLACED = f"{PIECES}, row long, home long, bin long, offset long, n_bins long, bound long, full boolean"


def _pack(capacity: int):
    """Packs a group; rows that already have a sequence keep it unless the new packing needs fewer."""

    def run(table: pa.Table) -> pa.Table:
        lengths = table.column("length").to_numpy()
        bins, offsets, n = best_fit(lengths, capacity)
        home = table.column("next").to_numpy()
        if "bin" in table.column_names:
            old_home, old_bin = table.column("home").to_numpy(), table.column("bin").to_numpy()
            _, first, old = np.unique(np.stack([old_home, old_bin]), axis=1, return_index=True, return_inverse=True)
            if len(first) <= n:
                home, bins, offsets = old_home, old_bin, table.column("offset").to_numpy()
                place, n = old.ravel(), len(first)
            else:
                place = bins
        else:
            place = bins
        fill = np.bincount(place, weights=lengths)
        rows = len(lengths)
        out = {name: table.column(name) for name in ("doc_id", "piece", "start", "length", "ids_crc32", "row")}
        out |= {
            "home": pa.array(home),
            "bin": pa.array(bins),
            "offset": pa.array(offsets),
            "n_bins": pa.array(np.full(rows, n)),
            "bound": pa.array(np.full(rows, lower_bound(lengths, capacity))),
            "full": pa.array(fill[place] == capacity),
        }
        return pa.table(out)

    return run


def pack(
    items: DataFrame,
    capacity: int = CAPACITY,
    group_pieces: int = GROUP_PIECES,
    fan: int = FAN,
    rounds: int | None = None,
) -> DataFrame:
    """Pack pieces (``PIECES``) into sequences of at most ``capacity`` ids.

    Groups with a gap exchange until fewer than two are left or a round saves no sequence (or for ``rounds`` rounds).

    One row per piece with sequence_id, offset, and n_bins and bound of the group it was last packed in.  Repeated
    rows are packed each on its own.  No pieces give no rows.
    """
    spark = items.sparkSession
    rows = stage(items.withColumn("row", F.monotonically_increasing_id()), "pieces")
    sharing = rows.filter(F.col("length") < capacity)
    groups = max(1, -(-sharing.count() // group_pieces))
    dealt = sharing.withColumn("next", F.pmod(F.xxhash64("row"), F.lit(groups)))
    placed = stage(dealt.groupBy("next").applyInArrow(_pack(capacity), _PLACED), "packed")
    done, r = [], 0
    while rounds is None or r < rounds:
        r += 1
        gap = (F.col("n_bins") > F.col("bound")) & ~F.col("full")
        open_groups, before = placed.filter(gap).agg(F.count_distinct("home"), F.count_distinct("home", "bin")).first()
        if open_groups < 2:
            break
        done.append(placed.filter(~gap))
        unions = max(1, round(open_groups / fan))
        home = F.lit(r * _ROUND) + F.pmod(F.xxhash64("home", F.lit(r)), F.lit(unions))
        again = placed.filter(gap).withColumn("next", home).groupBy("next")
        placed = stage(again.applyInArrow(_pack(capacity), _PLACED), f"packed-{r}")
        if placed.agg(F.count_distinct("home", "bin")).first()[0] == before:
            break
    found = reduce(DataFrame.unionByName, [*done, placed])
    shared = found.withColumn("sequence_id", F.col("home") * _BINS + F.col("bin"))
    alone = rows.filter(F.col("length") == capacity).select(
        "*", (-F.col("row") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    one = F.lit(1).cast("long")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "n_bins", "bound"]
    return shared.select(*columns).unionByName(alone.withColumns({"n_bins": one, "bound": one}).select(*columns))


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """Cut and pack documents (doc_id, text); see ``pieces`` and ``pack``."""
    return pack(pieces(docs, vocabulary, capacity), capacity)
