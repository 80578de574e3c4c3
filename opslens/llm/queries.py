"""The registered queries of this package, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opslens.llm import boosted_trees, chunk_dedup, decision_list, jaccard_join, licences, line_frequency, link_trust, mixing, permutation_index, prefix_trie, repacking, source_divergence, wavelet
from opslens.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

#: The vocabulary of the token queries.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def op1_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as ids in wavelet matrix files, read back: place, count and checksum of each."""
    found = wavelet.corpus_index(table(spark, sf_dir, "documents"), VOCABULARY)
    return found.select("doc_id", "start", "n_tokens", "ids_crc32")


def op2_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licence of every document, its own or that of its directory (source/lang)."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    return licences.scan(docs, path).select("_row.doc_id", "path", "licence", "score", "origin", "origin_dir")


def op3_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    return permutation_index.nearest(vectors, every=100)


def op4_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text statistics, the base rule and the learned rules' verdict of every document."""
    found, _ = decision_list.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the group that links of five-word shingles at 0.8 make, and their number of links."""
    found = jaccard_join.links(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "n_links")


def op6_repacking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents packed into sequences of 2048 ids, with their group's number of sequences and its lower bound."""
    found = repacking.pack_documents(table(spark, sf_dir, "documents"), VOCABULARY)
    return found.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "n_bins", "bound")


def op7_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages as visible lines, without those that repeat on over a fifth of their host's pages."""
    pages = table(spark, sf_dir, "pages")
    text, site = line_frequency.visible_lines(pages["html"]), line_frequency.host(pages["url"])
    found = line_frequency.drop_boilerplate(pages, text, site)
    return found.select(F.col("_row.page_id").alias("page_id"), "host", "n_lines", "n_dropped", "kept")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents mixed by source weights 1, 2, 3, targets at most 3 times a source."""
    found = mixing.mix(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def op8_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of documents that an earlier document has."""
    found = chunk_dedup.repeated_passages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "start", "length", "n_words", "first_doc_id")


def op10_boosted_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score of every document."""
    return boosted_trees.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources against each other over all kept terms, and each source's 200 terms that stand out in its language."""
    return source_divergence.audit(table(spark, sf_dir, "documents"))


def op12_link_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's host, path, rule and verdict."""
    found = link_trust.judge(table(spark, sf_dir, "pages"), "url", "html")
    return found.select(F.col("_row.page_id").alias("page_id"), "host", "path", "rule", "verdict")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of rebuilt conversations, a row per node."""
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_wavelet,
        op2_licences,
        op3_permutation_index,
        op4_decision_list,
        op5_jaccard_join,
        op6_repacking,
        op7_line_frequency,
        op8_chunk_dedup,
        op9_mixing,
        op10_boosted_trees,
        op11_divergence,
        op12_link_trust,
        op13_prefix_trie,
    )
}
