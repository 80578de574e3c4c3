"""The cleaning pipeline of a training corpus, from documents to packed sequences.

Each stage takes what the one before has kept, as a table of the columns of ``documents``; the last returns the pieces
of packed sequences.  An empty table stays empty through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opslens.llm import decision_list, jaccard_join, line_frequency, mixing, repacking
from opslens.llm.common import importable, stage, table
from opslens.llm.queries import VOCABULARY


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the learned rules keep."""
    return decision_list.keep(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that over a fifth of their source has; n_chars follows the text."""
    found = line_frequency.drop_boilerplate(docs, docs["text"], docs["source"])
    changed = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return found.select(*[changed.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles link at 0.8: the one of lowest id."""
    importable(spark)
    return jaccard_join.keep_one(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight asks for."""
    return mixing.repeated(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 ids."""
    importable(spark)
    found = repacking.pack_documents(docs, VOCABULARY)
    return found.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("source_mixing", source_mixing),
    ("packing", packing),
]

#: Learned rules, ids of a tokenizer and best-fit packing are not SQL; tests/llm/test_pipeline.py has a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, apply) in enumerate(STAGES):
        found = apply(spark, docs, sf_dir)
        docs = found if k == len(STAGES) - 1 else stage(found, name)
    return docs
