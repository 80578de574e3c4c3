"""How sources of a language differ from each other and from the language, term by term, in whole numbers.

Each language keeps the V terms that stand in ``least_docs`` of its documents.  A group (a source of a language, or the
language as a whole) that has N kept terms gives a term it has c times the weight

    p = 1 + floor(UNIT * (c + 1) / (N + V)),

and a term of weight p in one group and q in another diverges by floor((p - q)^2 / q).  ``term_audit`` lists a source's
terms against its language; ``pair_audit`` sums the divergence of all kept terms for every two sources of a language.

Pairs are priced from joint tables.  The kept terms of a language are dealt into blocks; a block's one-hot matrix has a
row per term and a column for each (source, count level) found there, a source that lacks a term being at level 0.  Its
transpose times itself counts, exactly, how many terms are at level i of one source and at level j of another: all joint
tables of the block at once, in products of column tiles.  Each cell that is not empty is then priced once, and blocks
add up.  No pair of rows is ever joined, and a block has ``BLOCK_TERMS`` terms whatever the size of the corpus.

Cases: null text, lang or source count as ``''``.  A group without kept terms takes part with count 0 everywhere; a
language without kept terms gives its pairs the value 0 and no terms.  Repeated rows are further documents.  Texts of
any length are read whole.  An empty table gives an empty result.  Columns other than the three named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opslens.llm.common import batch_slices, named, stage
from opslens.llm.encode import text_buffers

#: A term is a longest run of ASCII letters and characters beyond ASCII, A-Z lower-cased.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
UNIT = 1_000_000_000
#: Expected number of terms in a block: the rows of its one-hot matrix.
BLOCK_TERMS = 512
#: Columns of a tile; a product of two tiles has at most the square of it, in four bytes each.
TILE = 2048
#: Text that is counted at once, in bytes.
_SLICE = 1 << 25

_INSIDE = np.zeros(256, dtype=bool)
_INSIDE[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def terms(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Per term occurrence its text's index and its code, and between them the distinct terms as strings."""
    data, offsets = text_buffers(texts)
    inside = _INSIDE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    opens, ends = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1] | edge[1:-1]
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(opens)
    cuts = np.concatenate([[0], np.cumsum(np.flatnonzero(ends) + 1 - starts)]).astype(np.int64)
    runs = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(cuts), pa.py_buffer(_LOWER[data[inside]]))
    coded = runs.dictionary_encode()
    owner = np.searchsorted(offsets, starts, side="right") - 1
    return owner, coded.dictionary, coded.indices.to_numpy().astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents per (lang, source, term) of each slice of the input."""
    for batch in batches:
        for part in batch_slices(batch, "text", _SLICE):
            owner, names, code = terms(part.column("text"))
            if not len(code):
                continue
            langs, sources = (part.column(c).dictionary_encode() for c in ("lang", "source"))
            group = langs.indices.to_numpy().astype(np.int64) * len(sources.dictionary) + sources.indices.to_numpy()
            # Once per document and term, then once per group and term.
            seen, times = np.unique(owner * len(names) + code, return_counts=True)
            keys, at = np.unique(group[seen // len(names)] * len(names) + seen % len(names), return_inverse=True)
            of, term = keys // len(names), keys % len(names)
            yield pa.record_batch(
                {
                    "lang": langs.dictionary.take(pa.array(of // len(sources.dictionary))).cast(pa.string()),
                    "source": sources.dictionary.take(pa.array(of % len(sources.dictionary))).cast(pa.string()),
                    "term": names.take(pa.array(term)).cast(pa.string()),
                    "n": pa.array(np.bincount(at, weights=times).astype(np.int64)),
                    "docs": pa.array(np.bincount(at).astype(np.int64)),
                }
            )


def _weight(count: Column, total: Column, kept: Column) -> Column:
    wide = (F.lit(UNIT).cast("decimal(20,0)") * (count + 1).cast("decimal(18,0)")).cast("decimal(38,0)")
    return F.lit(1) + F.call_function("div", wide, (total + kept).cast("decimal(38,0)"))


class Audit:
    """Counts of one corpus, staged, and the two audits over them.

    ``kept`` has a row per (lang, term, source) with the count ``n`` and the language's count ``lang_n``; ``groups`` a
    row per (lang, source) with its number ``sid`` within the language, ``total`` N, and the language's ``lang_total``
    and ``kept_terms`` V.
    """

    def __init__(self, docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least_docs: int = 3):
        read = named(docs, lang=lang, source=source, text=text).fillna("")
        counted = read.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
        of_term = Window.partitionBy("lang", "term")
        # One exchange, by term; a frequent term has a row per slice and source, never one per occurrence.
        per_group = counted.repartition("lang", "term").groupBy("lang", "source", "term").agg(
            F.sum("n").alias("n"), F.sum("docs").alias("docs")
        )
        marked = per_group.withColumns(
            {
                "lang_docs": F.sum("docs").over(of_term),
                "lang_n": F.sum("n").over(of_term),
                "leads": F.col("source") == F.min("source").over(of_term),
            }
        )
        self.kept = stage(marked.filter(F.col("lang_docs") >= least_docs).drop("docs", "lang_docs"), "kept-terms")
        once = F.when(F.col("leads"), 1).otherwise(0)
        sums = self.kept.groupBy("lang", "source").agg(
            F.sum("n").alias("total"), F.sum(once).alias("leading"), F.sum(once * F.col("lang_n")).alias("leading_n")
        )
        groups = read.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").fillna(0)
        per_lang = groups.groupBy("lang").agg(F.sum("leading").alias("kept_terms"), F.sum("leading_n").alias("lang_total"))
        number = F.row_number().over(Window.partitionBy("lang").orderBy("source"))
        self.groups = stage(
            groups.select("lang", "source", "total", number.alias("sid")).join(per_lang, "lang"), "term-groups"
        )

    def _weighted(self) -> DataFrame:
        weight = _weight(F.col("n"), F.col("total"), F.col("kept_terms"))
        return self.kept.join(self.groups, ["lang", "source"]).withColumn("p", weight)

    def term_audit(self, top: int = 200) -> DataFrame:
        """A source's ``top`` terms of larger weight than in its language: (lang, source, item, value, rank)."""
        q = _weight(F.col("lang_n"), F.col("lang_total"), F.col("kept_terms"))
        found = self._weighted().withColumn("q", q).filter("p > q").select(
            "lang", "source", F.col("term").alias("item"), F.expr("(p - q) * (p - q) div q").alias("value")
        )
        return _ranked(found).filter(F.col("rank") <= top)

    def pair_audit(self) -> DataFrame:
        """Every other source of a source's language with their divergence over all kept terms: columns as ``term_audit``."""
        blocks = F.greatest(F.ceil(F.col("kept_terms") / BLOCK_TERMS), F.lit(1))
        groups = self.groups.withColumn("blocks", blocks)
        level_0 = F.when(F.col("kept_terms") > 0, _weight(F.lit(0).cast("long"), F.col("total"), F.col("kept_terms")))
        heads = groups.select(
            "lang", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "sid",
            F.lit(None).cast("string").alias("term"), level_0.alias("p"),
        )
        cells = self._weighted().select(
            "lang", F.pmod(F.xxhash64("term"), blocks).alias("block"), "sid", "term", "p"
        )
        parts = heads.unionByName(cells).groupBy("lang", "block").applyInArrow(_price_block, "lang string, sid int, other int, value long")
        sums = parts.groupBy("lang", "sid", "other").agg(F.sum("value").alias("value"))
        names = self.groups.select("lang", "sid", "source")
        others = names.select("lang", F.col("sid").alias("other"), F.col("source").alias("item"))
        return _ranked(sums.join(names, ["lang", "sid"]).join(others, ["lang", "other"]).select("lang", "source", "item", "value"))


def _ranked(found: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item").asc())
    return found.withColumn("rank", F.row_number().over(order))


def joint_tables(levels: np.ndarray, tile: int = TILE) -> Iterator[tuple[np.ndarray, ...]]:
    """Cells of the joint tables of every two columns of ``levels`` (a row per term, a column per source).

    Yields arrays (a, b, level in a, level in b, terms) with a < b.  The one-hot columns of neighbouring sources form
    tiles, and each product of two tiles holds the tables of all their pairs; counts below 2^24 are exact in float32.
    """
    n_terms, n_sources = levels.shape
    found = [np.unique(levels[:, s], return_inverse=True) for s in range(n_sources)]
    tiles, at = [], 0
    while at < n_sources:
        stop, width = at, 0
        while stop < n_sources and (stop == at or width + len(found[stop][0]) <= tile):
            width += len(found[stop][0])
            stop += 1
        one_hot = np.zeros((n_terms, width), np.float32)
        starts = np.cumsum([0] + [len(found[s][0]) for s in range(at, stop)])
        for s in range(at, stop):
            one_hot[np.arange(n_terms), starts[s - at] + found[s][1]] = 1
        owner = np.repeat(np.arange(at, stop), np.diff(starts))
        tiles.append((one_hot, owner, np.concatenate([found[s][0] for s in range(at, stop)])))
        at = stop
    for k, (left, left_owner, left_level) in enumerate(tiles):
        for right, right_owner, right_level in tiles[k:]:
            counts = left.T @ right
            i, j = np.nonzero(counts)
            later = left_owner[i] < right_owner[j]
            i, j = i[later], j[later]
            yield left_owner[i], right_owner[j], left_level[i], right_level[j], counts[i, j].astype(np.int64)


def _price_block(block: pa.Table) -> pa.Table:
    """Divergence of every two sources over the terms of one block."""
    head = block.column("term").is_null().to_numpy(zero_copy_only=False)
    sid = block.column("sid").to_numpy() - 1
    weight = block.column("p").fill_null(0).to_numpy()
    n = int(sid.max()) + 1
    value = np.zeros((n, n), np.int64)
    if not head.all():
        names = block.column("term").filter(pa.array(~head)).combine_chunks().dictionary_encode()
        level_0 = np.zeros(n, np.int64)
        level_0[sid[head]] = weight[head]
        levels = np.tile(level_0, (len(names.dictionary), 1))
        levels[names.indices.to_numpy(), sid[~head]] = weight[~head]
        for a, b, p, q, count in joint_tables(levels):
            square = (p - q) ** 2
            np.add.at(value, (a, b), count * (square // q))
            np.add.at(value, (b, a), count * (square // p))
    one, other = np.nonzero(~np.eye(n, dtype=bool))
    lang = block.column("lang")[0].as_py()
    return pa.table(
        {
            "lang": pa.array([lang] * len(one), pa.string()),
            "sid": pa.array(one + 1, pa.int32()),
            "other": pa.array(other + 1, pa.int32()),
            "value": pa.array(value[one, other]),
        }
    )


def audit(docs: DataFrame, top: int = 200) -> DataFrame:
    """Both audits of ``documents``: (lang, source, part, item, value, rank), part ``pair`` or ``term``."""
    found = Audit(docs)
    parts = (("pair", found.pair_audit()), ("term", found.term_audit(top)))
    pair, term = (df.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank") for name, df in parts)
    return pair.unionByName(term)
