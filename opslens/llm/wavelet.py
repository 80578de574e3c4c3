"""Token ids of a corpus as wavelet matrices, one compressed file per shard.

A wavelet matrix keeps a sequence as bit planes.  Plane 0 has the highest bit of each id in text
order; each further plane has the next bit after a stable partition by the bit before.  With the
number of ones before every 512th bit stored beside each plane, one file answers: which id stands at a
place (``access``), how often an id occurs before a place (``rank``, ``count``), where its k-th
occurrence is (``select``, ``occurrences``), and gives the sequence back (``decode``).

File: magic, length of a JSON header, header, then zstd sections in the header's order: document ids,
their null marks, token counts, and for each plane its bits and its rank directory.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opslens.llm.common import batch_slices, named, new_path, stage
from opslens.llm.encode import encoder, with_end

MAGIC = b"WVMX0001"
#: Ids after which a shard is closed at the next document's end.
SHARD_TOKENS = 1 << 22
#: Bits between two entries of the rank directory.
RANK_BITS = 512
_WORDS = RANK_BITS // 64
#: Ids that are moved at once, so that their places stay in a core's cache.
_BLOCK = 1 << 15
#: Pieces that a worker remembers here, some 150 MB: rare words of earlier tasks are not encoded again.
CACHE_PIECES = 1_000_000


class Plane:
    """A bit vector with rank and select."""

    def __init__(self, words: np.ndarray, n: int, directory: np.ndarray):
        self.words, self.n, self.directory = words, n, directory

    @classmethod
    def of(cls, bits: np.ndarray) -> Plane:
        packed = np.packbits(bits, bitorder="little")
        words = np.zeros(-(-max(len(bits), 1) // RANK_BITS) * _WORDS, "<u8")
        words.view(np.uint8)[: len(packed)] = packed
        ones = np.bitwise_count(words).reshape(-1, _WORDS).sum(axis=1)
        return cls(words, len(bits), np.concatenate([[0], np.cumsum(ones)]).astype("<u4"))

    def bits(self) -> np.ndarray:
        return np.unpackbits(self.words.view(np.uint8), count=self.n, bitorder="little").view(bool)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)

    def rank1(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place, places from 0 to n."""
        block = at // RANK_BITS
        last = np.minimum(block, len(self.words) // _WORDS - 1)
        words = self.words.reshape(-1, _WORDS)[last]
        left = np.clip((at - last * RANK_BITS)[:, None] - 64 * np.arange(_WORDS), 0, 64)
        mask = np.where(left == 64, ~np.uint64(0), (np.uint64(1) << (left & 63).astype(np.uint64)) - np.uint64(1))
        return self.directory[last].astype(np.int64) + np.bitwise_count(words & mask).sum(axis=1, dtype=np.int64)

    def select(self, bit: int, k: np.ndarray) -> np.ndarray:
        """Place of the k-th (from 0) one or zero: the last place with k of them before it."""
        low, high = np.zeros_like(k), np.full_like(k, self.n)
        while (low < high).any():
            middle = (low + high + 1) // 2
            ones = self.rank1(middle)
            before = ones if bit else middle - ones
            low, high = np.where(before <= k, middle, low), np.where(before <= k, high, middle - 1)
        return low


def _parted(bit: np.ndarray, zeros: int) -> Iterator[tuple[slice, int, np.ndarray, int, np.ndarray]]:
    """Blocks of a stable partition: the block, where its zeros go, its ones, where these go, its zeros."""
    low, high = 0, zeros
    for at in range(0, len(bit), _BLOCK):
        some = bit[at : at + _BLOCK]
        ones, noughts = np.flatnonzero(some), np.flatnonzero(~some)
        yield slice(at, at + _BLOCK), low, ones, high, noughts
        low, high = low + len(noughts), high + len(ones)


class WaveletMatrix:
    """A sequence of ids as ``bits`` planes."""

    def __init__(self, n: int, bits: int, planes: list[Plane], zeros: list[int]):
        self.n, self.bits, self.planes, self.zeros = n, bits, planes, zeros

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        planes, zeros = [], []
        here = ids.astype(np.result_type(ids, np.min_scalar_type((1 << bits) - 1)), copy=False)
        for level in range(bits - 1, -1, -1):
            bit = (here & here.dtype.type(1 << level)) != 0
            planes.append(Plane.of(bit))
            zeros.append(len(bit) - int(np.count_nonzero(bit)))
            after = np.empty_like(here)
            for block, low, ones, high, noughts in _parted(bit, zeros[-1]):
                np.take(here[block], noughts, out=after[low : low + len(noughts)], mode="clip")
                np.take(here[block], ones, out=after[high : high + len(ones)], mode="clip")
            here = after
        return cls(len(ids), bits, planes, zeros)

    def decode(self) -> np.ndarray:
        """The whole sequence, by undoing the partitions from the last plane up."""
        kind = np.uint16 if self.bits <= 16 else np.uint32
        here = np.zeros(self.n, kind)
        for level, (plane, zeros) in enumerate(zip(reversed(self.planes), reversed(self.zeros), strict=True)):
            bit = plane.bits()
            above = np.empty(self.n, kind)
            here[zeros:] |= kind(1 << level)
            for block, low, ones, high, noughts in _parted(bit, zeros):
                above[block][noughts] = here[low : low + len(noughts)]
                above[block][ones] = here[high : high + len(ones)]
            here = above
        return here

    def access(self, at: np.ndarray) -> np.ndarray:
        """Ids at the given places."""
        at, out = np.asarray(at, np.int64), np.zeros(len(at), np.int64)
        for plane, zeros in zip(self.planes, self.zeros, strict=True):
            bit, ones = plane.get(at).astype(bool), plane.rank1(at)
            out = out * 2 + bit
            at = np.where(bit, zeros + ones, at - ones)
        return out

    def _range(self, token: int, low: int, high: int) -> tuple[int, int]:
        """Where the token's occurrences in [low, high) stand below the last plane."""
        ends = np.array([low, high], np.int64)
        if not 0 <= token < 1 << self.bits:
            return 0, 0
        for level, (plane, zeros) in enumerate(zip(self.planes, self.zeros, strict=True)):
            ones = plane.rank1(ends)
            ends = zeros + ones if (token >> (self.bits - 1 - level)) & 1 else ends - ones
        return int(ends[0]), int(ends[1])

    def count(self, token: int, low: int = 0, high: int | None = None) -> int:
        """Occurrences in [low, high)."""
        first, last = self._range(token, low, self.n if high is None else high)
        return last - first

    def rank(self, token: int, at: int) -> int:
        return self.count(token, 0, at)

    def occurrences(self, token: int) -> np.ndarray:
        """All places of the token, ascending."""
        first, last = self._range(token, 0, self.n)
        at = np.arange(first, last)
        if not len(at):
            return at
        for level in range(self.bits):
            plane, zeros = self.planes[-1 - level], self.zeros[-1 - level]
            at = plane.select(1, at - zeros) if (token >> level) & 1 else plane.select(0, at)
        return at

    def select(self, token: int, k: int) -> int:
        """Place of the k-th occurrence, from 0."""
        return int(self.occurrences(token)[k])


def to_bytes(ids: np.ndarray, bits: int, doc_ids: list[int | None], lengths: np.ndarray, **header: int) -> bytes:
    """A shard file: the documents' ids, their token counts, the wavelet matrix of all tokens."""
    matrix = WaveletMatrix.build(ids, bits)
    missing = np.array([d is None for d in doc_ids], dtype=np.uint8)
    sections = [np.array([d or 0 for d in doc_ids], "<i8"), missing, np.asarray(lengths, "<i8")]
    for plane in matrix.planes:
        sections += [plane.words, plane.directory]
    press = zstandard.ZstdCompressor(level=1)
    parts = [press.compress(s.tobytes()) for s in sections]
    header |= {"n": len(ids), "bits": bits, "zeros": matrix.zeros, "sizes": [len(p) for p in parts]}
    head = json.dumps(header).encode()
    return b"".join([MAGIC, struct.pack("<I", len(head)), head, *parts])


class Shard:
    """A shard file opened from its bytes."""

    def __init__(self, content: bytes):
        if content[: len(MAGIC)] != MAGIC:
            raise ValueError("not a wavelet shard")
        (size,) = struct.unpack_from("<I", content, len(MAGIC))
        at = len(MAGIC) + 4
        self.header = json.loads(content[at : at + size])
        at += size
        press, sections = zstandard.ZstdDecompressor(), []
        for length in self.header["sizes"]:
            sections.append(press.decompress(content[at : at + length]))
            at += length
        missing = np.frombuffer(sections[1], np.uint8)
        self.doc_ids = [None if m else int(d) for d, m in zip(np.frombuffer(sections[0], "<i8"), missing, strict=True)]
        self.lengths = np.frombuffer(sections[2], "<i8")
        n = self.header["n"]
        planes = [
            Plane(np.frombuffer(w, "<u8"), n, np.frombuffer(d, "<u4"))
            for w, d in zip(sections[3::2], sections[4::2], strict=True)
        ]
        self.matrix = WaveletMatrix(n, self.header["bits"], planes, self.header["zeros"])


def write_shards(docs: DataFrame, path: str, vocabulary: str, shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode ``docs`` (doc_id, text) and write them as shard files in ascending ``doc_id`` order.

    Null ids come first; rows of one id are ordered by text.  A null text is empty: its document has
    the end id alone.  Rows are dealt by ranges of (doc_id, hash of the text), so that an id of many
    rows is spread.  A shard takes whole documents, so a longer document makes a longer shard.
    """
    rows = named(docs, doc_id="doc_id", text="text").select(
        F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("text").alias("key")
    )
    rows = rows.repartitionByRange("doc_id", "key").sortWithinPartitions("doc_id", "key", "text")

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, CACHE_PIECES)
        bits = max(1, (encode.n_ids - 1).bit_length())
        part, sequence = TaskContext.get().partitionId(), 0
        ids, doc_ids, lengths = [], [], []

        def close() -> pa.RecordBatch:
            content = to_bytes(
                np.concatenate(ids), bits, doc_ids, np.concatenate(lengths), part=part, sequence=sequence
            )
            return pa.RecordBatch.from_pydict({"content": pa.array([content], pa.binary())})

        held = 0
        for batch in batches:
            for some in batch_slices(batch, "text"):
                found, offsets = with_end(*encode.encode(some.column("text")))
                at = 0
                while at < len(some):
                    stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + shard_tokens - held)))
                    stop = min(stop, len(some))
                    ids.append(found[offsets[at] : offsets[stop]])
                    doc_ids += some.column("doc_id").slice(at, stop - at).to_pylist()
                    lengths.append(np.diff(offsets[at : stop + 1]))
                    held += int(offsets[stop] - offsets[at])
                    at = stop
                    if held >= shard_tokens:
                        yield close()
                        sequence += 1
                        ids, doc_ids, lengths, held = [], [], [], 0
        if doc_ids:
            yield close()

    # The text writer puts out a string's bytes as they are: one record, one file.
    made = rows.select("doc_id", "text").mapInArrow(shards, "content binary")
    made.select(F.col("content").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).text(path)


def read_shards(spark, path: str) -> DataFrame:
    """The shard files at ``path``, one row each (``content``)."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")


def shard_documents(shards: DataFrame) -> DataFrame:
    """Per document of the shards, from decoded ids: shard place, position there, count, crc32."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                shard = Shard(content.as_buffer().to_pybytes())
                ids = shard.matrix.decode().astype("<u4")
                ends = np.cumsum(shard.lengths)
                starts = ends - shard.lengths
                n = len(ends)
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(starts, ends, strict=True)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": pa.array(np.full(n, shard.header["part"]), pa.int64()),
                        "sequence": pa.array(np.full(n, shard.header["sequence"]), pa.int64()),
                        "doc_id": pa.array(shard.doc_ids, pa.int64()),
                        "shard_start": pa.array(starts, pa.int64()),
                        "n_tokens": pa.array(shard.lengths, pa.int64()),
                        "ids_crc32": pa.array(crc, pa.int64()),
                    }
                )

    return shards.mapInArrow(
        read, "part long, sequence long, doc_id long, shard_start long, n_tokens long, ids_crc32 long"
    )


def corpus_index(docs: DataFrame, vocabulary: str, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Write the shard files of ``docs``, read them back, and place every document in the whole.

    One row per document: doc_id, start (ids of all documents before it), n_tokens (with the end id),
    ids_crc32 (of the ids as little-endian 32-bit integers), part, sequence, shard_start.  No documents give no
    rows.
    """
    spark = docs.sparkSession
    path = new_path(spark, "wavelet")
    write_shards(docs, path, vocabulary, shard_tokens)
    found = stage(shard_documents(read_shards(spark, path)), "wavelet-documents")
    # Shards add up within the part that one task has written, and only parts' totals, one row each, meet in one task.
    ahead = [Window.unboundedPreceding, -1]
    totals = found.groupBy("part", "sequence").agg(F.sum("n_tokens").alias("shard_tokens"))
    inside = F.sum("shard_tokens").over(Window.partitionBy("part").orderBy("sequence").rowsBetween(*ahead))
    parts = totals.groupBy("part").agg(F.sum("shard_tokens").alias("part_tokens"))
    earlier = F.sum("part_tokens").over(Window.orderBy("part").rowsBetween(*ahead))
    parts = parts.select("part", F.coalesce(earlier, F.lit(0)).alias("part_base"))
    bases = totals.withColumn("inside", F.coalesce(inside, F.lit(0))).join(parts, "part").select(
        "part", "sequence", (F.col("part_base") + F.col("inside")).alias("base")
    )
    return found.join(bases, ["part", "sequence"]).select(
        "doc_id",
        (F.col("base") + F.col("shard_start")).alias("start"),
        "n_tokens",
        "ids_crc32",
        "part",
        "sequence",
        "shard_start",
    )
