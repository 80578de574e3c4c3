"""Passages that repeat across documents, found by content-defined chunks.

A gear hash rolls over a text's bytes; where its value behind a word falls below a limit, a chunk ends.  The hash
sees the last 16 bytes only, so chunks fall into step again a few words after an insertion.  Single chunks are short
and occur by chance, so windows are compared: neighbouring chunks of enough words together.  Windows of equal digest
are copies, the first document's stays, and a run of copied windows is a repeated passage.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opslens.llm.common import batch_slices, named, stage
from opslens.llm.textbytes import mix, word_hashes, words

#: Words of a chunk, on average, and at most: text that repeats with a short period may never end a chunk.
CHUNK_WORDS = 4
MOST_WORDS = 32
#: Words of a run of copies to be a passage, and words in a row that must be one document's.
RUN_WORDS = 20
SAME_WORDS = 14
#: Bytes that the rolling hash sees.
WINDOW = 16
#: Stands for a null id, behind all others; a document of this very id would count as the null one.
NO_ID = (1 << 63) - 1

_GEAR = (mix(np.arange(1, 257, dtype=np.uint64)) & np.uint64(0xFFFF)).astype(np.uint16)


def gear(data: np.ndarray) -> np.ndarray:
    """The 16-bit gear hash behind each byte: each step shifts by one bit and adds the byte's number.

    A byte's part has left after 16 steps.  Doubling the reach four times gives the same sums at once.
    """
    h = _GEAR[data]
    for reach in (1, 2, 4, 8):
        h[reach:] = h[reach:] + (h[:-reach] << np.uint16(reach))
    return h


def chunk(texts: pa.Array, chunk_words: int = CHUNK_WORDS) -> dict[str, np.ndarray]:
    """The chunks of all texts: text, digest, start and length in characters, n_words.

    A chunk is at most ``MOST_WORDS`` whole words with the white space behind them; a text's first also has what
    precedes it.  A text without words has no chunk.
    """
    data, starts, ends, offsets = words(texts)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    # A word ends a chunk by the hash of the bytes up to its end; the last word always does.
    h = gear(data)
    cut = np.zeros(len(starts), dtype=bool)
    if len(starts):
        cut[:] = h[ends - 1] < (1 << 16) // chunk_words
        first_byte = starts[offsets[:-1][np.diff(offsets) > 0]]
        begin = np.repeat(first_byte, np.diff(offsets)[np.diff(offsets) > 0])
        cut &= ends - begin >= WINDOW  # before that the hash would see the text before
        cut[offsets[1:][np.diff(offsets) > 0] - 1] = True
    last = np.flatnonzero(cut)
    first = np.concatenate([[0], last[:-1] + 1]) if len(last) else last
    parts = (last - first) // MOST_WORDS + 1
    part = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    first = np.repeat(first, parts) + part * MOST_WORDS
    last = np.minimum(np.repeat(last, parts), first + MOST_WORDS - 1)
    # The digest runs over the words' hashes: how they are spaced does not matter.
    value = word_hashes(data, starts, ends)
    place = np.arange(len(value)) - np.repeat(first, last - first + 1) if len(value) else np.empty(0, int)
    power = mix(place.astype(np.uint64) + np.uint64(77)) | np.uint64(1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value * power, dtype=np.uint64)])
    digest = mix(sums[last + 1] - sums[first] + (last - first + 1).astype(np.uint64)) if len(last) else sums[:0]
    # Characters before each byte: every byte that does not continue one.
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    byte_offsets = _text_starts(texts)
    owner = text[last] if len(last) else last
    at = starts[first]
    after = np.append(starts, len(data))[last + 1] if len(last) else last
    opens = np.ones(len(last), dtype=bool)
    opens[1:] = owner[1:] != owner[:-1]
    closes = np.ones(len(last), dtype=bool)
    closes[:-1] = opens[1:]
    at = np.where(opens, byte_offsets[owner], at)
    after = np.where(closes, byte_offsets[owner + 1], after)
    begin = chars[byte_offsets[owner]]
    return {
        "text": owner,
        "digest": digest.view(np.int64),
        "start": chars[at] - begin,
        "length": chars[after] - chars[at],
        "n_words": last - first + 1,
    }


def windows(found: dict[str, np.ndarray], same_words: int = SAME_WORDS) -> dict[str, np.ndarray]:
    """The windows of ``chunk``'s chunks: text, digest, place and words.

    From each chunk on, and up to each chunk, the fewest neighbouring chunks of one text that have ``same_words`` words
    together.  So every run of chunks of that many words is covered from its first to its last.  place is the start in
    characters, shifted by 32 bits, and the length; words the number of words before, shifted by 32 bits, and in it.
    """
    text, digest, n_words = found["text"], found["digest"].view(np.uint64), found["n_words"]
    after = np.cumsum(n_words)
    before = after - n_words
    one = np.arange(len(text))
    end = np.searchsorted(after, before + same_words)
    begin = np.searchsorted(before, after - same_words, side="right") - 1
    ahead = end < len(text)
    ahead[ahead] = text[end[ahead]] == text[ahead]
    back = begin >= 0
    back[back] = text[begin[back]] == text[back]
    # A window that is the shortest both ways is made once.
    back[back] = end[begin[back]] != one[back]
    first = np.concatenate([one[ahead], begin[back]])
    last = np.concatenate([end[ahead], one[back]])
    value = mix((last - first + 1).astype(np.uint64))
    for k in range(int((last - first).max()) + 1 if len(first) else 0):
        inside = first + k <= last
        value[inside] = mix(value[inside] ^ digest[first[inside] + k])
    opens = np.searchsorted(text, text[first]) if len(first) else first  # the text's first chunk
    start = found["start"][first]
    stop = found["start"][last] + found["length"][last]
    return {
        "text": text[first],
        "digest": value.view(np.int64),
        "place": start << 32 | stop - start,
        "words": before[first] - before[opens] << 32 | after[last] - before[first],
    }


def _text_starts(texts: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    sizes = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def chunk_windows(docs: DataFrame, chunk_words: int = CHUNK_WORDS, same_words: int = SAME_WORDS) -> DataFrame:
    """Window rows of documents (doc_id, text): owner (the id, or ``NO_ID``), version (of its text), digest, place,
    words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in batch_slices(batch, "text", 1 << 21):
                found = windows(chunk(some.column("text"), chunk_words), same_words)
                rows = pa.array(found.pop("text"))
                columns = [some.column("owner").take(rows), some.column("version").take(rows)]
                columns += [pa.array(v.astype(np.int64)) for v in found.values()]
                yield pa.RecordBatch.from_arrays(columns, ["owner", "version", *found])

    rows = named(docs, doc_id="doc_id", text="text").select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("owner"), F.xxhash64("text").alias("version"), "text"
    )
    return rows.mapInArrow(run, "owner long, version long, digest long, place long, words long")


def repeated_passages(
    docs: DataFrame, chunk_words: int = CHUNK_WORDS, run_words: int = RUN_WORDS, same_words: int = SAME_WORDS
) -> DataFrame:
    """Passages of documents (doc_id, text) that stand in a document of lower id: those a deduplication drops.

    One row per passage: doc_id, version, start and length in characters, n_words, first_doc_id (the first
    document that has a window of it).  A passage is a run, of ``run_words`` or more, of windows that touch or overlap, of each of
    which an earlier document has all ``same_words`` or more words in a row; what else stands in other documents
    does not matter.  Rows of one id are one document, so what repeats among them alone stays; a null id comes after
    all others and is one document.
    Null and empty texts have no passages, no documents give no rows.
    """
    found = chunk_windows(docs, chunk_words, same_words)
    # Each task sends a digest once, however often it has it.
    seen = found.groupBy("digest").agg(F.min("owner").alias("first"), F.max("owner").alias("last"))
    # Digests are unique on the right, which is staged; those of many windows are on the left, where Spark splits them.
    copies = stage(seen.filter("first < last").select("digest", "first"), "copies")
    later = found.join(copies, "digest").filter("owner > first")
    # Rows of one id and text are one document: its windows are made one where it is put together.
    later = later.select("owner", "version", "place", "words", "first").distinct()
    high = lambda c: F.shiftright(c, 32)
    low = lambda c: F.col(c).bitwiseAND(F.lit((1 << 32) - 1))
    later = later.select(
        "owner", "version", "first", high("place").alias("start"), (high("place") + low("place")).alias("stop"),
        high("words").alias("word"), (high("words") + low("words")).alias("behind"),
    )
    # No window lies within another, so starts and stops rise together.
    order = Window.partitionBy("owner", "version").orderBy("start", "stop")
    reached = F.coalesce(F.lag("stop").over(order), F.lit(-1))
    runs = later.withColumn("break", (F.col("start") > reached).cast("int")).withColumn("run", F.sum("break").over(order))
    passages = runs.groupBy("owner", "version", "run").agg(
        F.min("start").alias("start"),
        F.max("stop").alias("stop"),
        (F.max("behind") - F.min("word")).alias("n_words"),
        F.min("first").alias("first"),
    )
    return passages.filter(F.col("n_words") >= run_words).select(
        F.nullif("owner", F.lit(NO_ID)).alias("doc_id"),
        "version",
        "start",
        (F.col("stop") - F.col("start")).alias("length"),
        "n_words",
        F.col("first").alias("first_doc_id"),
    )


def drop_repeated(docs: DataFrame, **rule: int) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text``, other columns as they are."""
    spans = repeated_passages(docs, **rule).select("doc_id", "version", F.struct("start", "length").alias("span"))
    spans = stage(spans.groupBy("doc_id", "version").agg(F.sort_array(F.collect_list("span")).alias("spans")), "spans")
    spans = spans.withColumnRenamed("doc_id", "_id")
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row"), F.xxhash64(docs["text"]).alias("version"))
    joined = rows.join(spans, (rows["version"] == spans["version"]) & F.col("_row.doc_id").eqNullSafe(F.col("_id")), "left")
    text = F.col("_row.text")
    # Between one span's end and the next one's start, from 0 to the end of the text.
    starts = F.concat(F.transform("spans", lambda s: s["start"]), F.array(F.length(text).cast("long")))
    stops = F.concat(F.array(F.lit(0).cast("long")), F.transform("spans", lambda s: s["start"] + s["length"]))
    parts = F.transform(F.arrays_zip(stops.alias("stop"), starts.alias("start")), lambda p: F.substr(text, (p["stop"] + 1).cast("int"), (p["start"] - p["stop"]).cast("int")))
    cut = joined.select("_row", F.when(F.col("spans").isNull(), text).otherwise(F.array_join(parts, "")).alias("_text"))
    return cut.select(*[F.col("_text").alias("text") if c == "text" else F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
