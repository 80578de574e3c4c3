"""A text quality score by histogram gradient-boosted trees over document statistics.

Statistics are counted with numpy on the bytes of whole texts.  Trees are grown on the driver on a bounded sample
of labelled documents, level by level, from histograms of gradients over binned statistics.  All trees are
kept in flat arrays, so a batch of documents walks all trees at once, one level a step.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslens.llm.common import batch_slices, hash_sample, named, stage
from opslens.llm.encode import text_buffers
from opslens.llm.textbytes import mix, shingles, word_hashes, words

#: Labelled documents that trees are grown on, at most: those of the lowest hash.
SAMPLE_ROWS = 20_000
TREES, DEPTH, BINS = 120, 4, 64
RATE, RIDGE, MIN_WEIGHT = 0.1, 1.0, 2.0
#: Score from which a document counts as good.
CUT = 0.7
#: Documents whose id has this crc32 remainder are held out of learning.
FOLDS, HELD_OUT = 4, 2

_CLASSES = {
    "symbol": b"#*$%&|<>",
    "capital": bytes(range(0x41, 0x5B)),
    "small": bytes(range(0x61, 0x7B)),
    "digit": bytes(range(0x30, 0x3A)),
    "stop": b".!?",
    "comma": b",;:",
    "bang": b"!",
    "other": bytes(sorted(set(range(0x21, 0x7F)) - {*b"#*$%&|<>.!?,;:"} - {*range(0x30, 0x3A)} - {*range(0x41, 0x5B)} - {*range(0x61, 0x7B)})),
    "high": bytes(range(0x80, 0x100)),
    "line": b"\n",
}
FEATURES = (
    ["words", "word_length", "longest_word", "long_words", "short_words", "distinct_words", "most_frequent", "repeated_windows", "repeated_lines"]
    + [f"{name}_share" for name in _CLASSES]
)


def _per(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of consecutive values between offsets."""
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _groups(keys: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owners and sizes of groups of equal keys within each stretch between offsets."""
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.lexsort((keys, owner))
    owner, keys = owner[order], keys[order]
    new = np.ones(len(owner), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (keys[1:] != keys[:-1])
    first = np.flatnonzero(new)
    return owner[first], np.diff(np.append(first, len(owner)))


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` per text; all 0 for a text without words."""
    data, starts, ends, offsets = words(texts)
    _, bytes_at = text_buffers(texts)
    n = len(offsets) - 1
    count = np.diff(offsets).astype(np.float64)
    some, size = np.maximum(count, 1), (ends - starts).astype(np.float64)
    out = np.zeros((n, len(FEATURES)))
    out[:, 0] = count
    out[:, 1] = _per(size, offsets) / some
    np.maximum.at(out[:, 2], np.repeat(np.arange(n), np.diff(offsets)), size)
    out[:, 3] = _per(size > 12, offsets) / some
    out[:, 4] = _per(size < 3, offsets) / some
    owner, same = _groups(word_hashes(data, starts, ends), offsets)
    out[:, 5] = np.bincount(owner, minlength=n) / some
    np.maximum.at(out[:, 6], owner, same)
    out[:, 6] /= some
    windows, at = shingles(texts, 5)
    owner, same = _groups(windows, at)
    out[:, 7] = np.bincount(owner[same > 1], same[same > 1], minlength=n) / np.maximum(np.diff(at), 1)
    # Lines by the hash of their bytes: what stands between line breaks and text ends.
    edges = np.unique(np.concatenate([bytes_at, np.flatnonzero(data == 0x0A) + 1, np.flatnonzero(data == 0x0A)]))
    line_start, line_end = edges[:-1], edges[1:]
    full = (data[line_start] != 0x0A) if len(line_start) else np.empty(0, bool)
    line_start, line_end = line_start[full], line_end[full]
    line_at = np.searchsorted(line_start, bytes_at)
    owner, same = _groups(word_hashes(data, line_start, line_end), line_at)
    lines = np.maximum(np.diff(line_at), 1)
    out[:, 8] = (np.bincount(owner, same, minlength=n) - np.bincount(owner, minlength=n)) / lines
    for k, members in enumerate(_CLASSES.values()):
        table = np.zeros(256, dtype=bool)
        table[list(members)] = True
        out[:, 9 + k] = _per(table[data], bytes_at) / some
    out[count == 0] = 0
    return out


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and ``x``, the statistics of each document (doc_id, text); a null text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in batch_slices(batch, "text", 1 << 21):
                found = statistics(some.column("text")).astype(np.float32)
                ends = pa.array(np.arange(len(some) + 1, dtype=np.int32) * len(FEATURES))
                lists = pa.ListArray.from_arrays(ends, pa.array(found.ravel()))
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), lists], ["doc_id", "x"])

    rows = named(docs, doc_id="doc_id", text="text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(run, "doc_id long, x array<float>")


@dataclass(frozen=True)
class Forest:
    """All trees in flat arrays: node i goes to ``left[i]`` where x[feature[i]] < cut[i], else to left[i] + 1.

    Leaves lead to themselves and hold ``value``; ``roots`` has each tree's first node.
    """

    base: float
    roots: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """Scores in (0, 1)."""
        total = np.full(len(x), self.base)
        if len(self.roots):
            at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
            rows = np.arange(len(x))[:, None]
            for _ in range(self.depth):
                right = x[rows, self.feature[at]] >= self.cut[at]
                at = np.where(self.left[at] < 0, at, self.left[at] + right)
            total = total + self.value[at].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS) -> Forest:
    """Boosted trees for labels 0 and 1 under logistic loss.

    Cut points are quantiles of the sample.  With labels of one kind only, or none, every score is the smoothed share.
    """
    base = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    feature, cut, left, value, roots = [], [], [], [], []
    if 0 < y.sum() < len(y):
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1], method="higher")).astype(x.dtype) for c in x.T]
        binned = np.stack([np.searchsorted(c, v, side="right") for c, v in zip(cuts, x.T, strict=True)], axis=1)
        flat = binned + np.arange(x.shape[1]) * bins
        margin = np.full(len(y), base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-margin))
            slope, weight = p - y, p * (1 - p)
            roots.append(len(feature))
            feature.append(0), cut.append(0.0), left.append(-1), value.append(0.0)
            at = np.full(len(y), roots[-1])
            open_ = [roots[-1]]
            for _ in range(depth):
                if not open_:
                    break
                place = np.full(len(feature), -1)
                place[open_] = np.arange(len(open_))
                mine = place[at]
                here = mine >= 0
                cell = (mine[here, None] * x.shape[1] * bins + flat[here]).ravel()
                shape, size = (len(open_), x.shape[1], bins), len(open_) * x.shape[1] * bins
                each = lambda v: np.bincount(cell, np.repeat(v[here], x.shape[1]), size).reshape(shape)  # noqa: B023, E731
                g, h = each(slope).cumsum(axis=2), each(weight).cumsum(axis=2)
                g_all, h_all = g[:, :1, -1:], h[:, :1, -1:]
                gain = g**2 / (h + RIDGE) + (g_all - g) ** 2 / (h_all - h + RIDGE) - g_all**2 / (h_all + RIDGE)
                gain[(h < MIN_WEIGHT) | (h_all - h < MIN_WEIGHT)] = 0
                gain = gain.reshape(len(open_), -1)
                best = gain.argmax(axis=1)
                after = []
                for k, node in enumerate(open_):
                    if gain[k, best[k]] <= 1e-9:
                        continue
                    f, b = divmod(int(best[k]), bins)
                    feature[node], cut[node], left[node] = f, cuts[f][b], len(feature)
                    for _ in range(2):
                        after.append(len(feature))
                        feature.append(0), cut.append(0.0), left.append(-1), value.append(0.0)
                    rows = np.flatnonzero(at == node)
                    at[rows] = left[node] + (binned[rows, f] > b)
                open_ = after
            g, h = np.bincount(at, slope, len(feature)), np.bincount(at, weight, len(feature))
            leaf = -RATE * g / (h + RIDGE)
            for node in np.unique(at):
                value[node] = leaf[node]
            margin = margin + leaf[at]
    return Forest(
        base, np.array(roots, np.int64), np.array(feature, np.int64), np.array(cut, np.float32),
        np.array(left, np.int64), np.array(value), depth,
    )


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo the number of folds; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))


def learn(found: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Forest:
    """Trees from documents' statistics (doc_id, x) and labels (doc_id, quality 0 or 1; the lower of several counts).

    Held-out documents are never looked at.
    """
    marks = (
        named(labels, doc_id="doc_id", quality="quality")
        .filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != HELD_OUT))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
    )
    rows = hash_sample(stage(found.join(marks, "doc_id").select("doc_id", "x", "quality"), "labelled"), sample_rows, "doc_id", "x")
    x = np.array([r["x"] for r in rows], np.float32).reshape(len(rows), len(FEATURES))
    return grow(x, np.array([r["quality"] for r in rows], np.float64))


def score(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from ``CUT``) of every document (doc_id, text).

    The score depends on the text alone.  Rows of one id are each scored; no documents give no rows.
    """
    found = stage(document_statistics(docs), "document-statistics")
    forest = learn(found, labels, sample_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(len(batch), len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(forest.score(x))], ["doc_id", "score"])

    scored = found.mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id")) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
    )
