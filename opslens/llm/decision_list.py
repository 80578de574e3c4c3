"""Quality rules learned as a decision list over text statistics.

Sequential covering: a rule is a conjunction of thresholds that marks documents to reject.  It is grown on two
thirds of the labelled documents, one condition at a time by information gain, pruned from its end on the
other third, and kept if it is precise there; the documents it covers leave, and the next rule is
learned.  The list becomes one Spark conditional expression.  Every step is an aggregate over all
labelled documents, of which only counts per feature and cut point come to the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslens.llm.common import WORD, named, stage

#: Words of a window, and the share of words in repeated windows from which a text fails.
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SYMBOLS = "[#*$%&|<>]"

#: What rules may test: a statistic, as it is or divided by another.
FEATURES = {
    "words": ("n_words", None),
    "chars_per_word": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "distinct_share": ("n_distinct_words", "n_words"),
}
#: Cut points of a feature, rules of a list, conditions of a rule.
CUTS = 40
MAX_RULES = 8
MAX_CONDITIONS = 4
#: Share of rejected documents that a rule needs among those it covers, and documents it must cover.
MIN_PRECISION = 0.9
MIN_COVER = 3


@dataclass(frozen=True)
class Condition:
    """``feature >= cut`` or, where ``below``, ``feature < cut``; ``bin`` is the cut's place, from 1."""

    feature: str
    below: bool
    bin: int
    cut: float

    def on_bins(self) -> Column:
        c = F.col(f"bin_{self.feature}")
        return c < self.bin if self.below else c >= self.bin

    def on_values(self) -> Column:
        value = feature(self.feature)
        return value < self.cut if self.below else value >= self.cut


def feature(name: str) -> Column:
    part, whole = FEATURES[name]
    value = F.col(part).cast("double")
    return value / F.greatest(F.col(whole), F.lit(1)).cast("double") if whole else value


def statistics(docs: DataFrame, with_row: bool = False) -> DataFrame:
    """doc_id (or, ``with_row``, the whole row as ``_row``) and the counts of each whole text, natively.

    A null or empty text has no words.

    n_words, word_chars (code points in words), n_symbols, n_lines (lines with a word), n_dup_lines (of these, equal to
    an earlier one), n_distinct_words, n_repeat_words (words in windows of five words that stand twice or
    more in the text).  Windows are compared by 64-bit hashes of their words' hashes.
    """
    none = F.array().cast("array<long>")
    key = "_row" if with_row else "doc_id"
    carried = F.struct(*[docs[f"`{c}`"] for c in docs.columns]) if with_row else docs["doc_id"]
    rows = docs.select(carried.alias(key), F.coalesce(docs["text"], F.lit("")).alias("text"))
    rows = rows.select(
        key,
        F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("words"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(WORD)).alias("lines"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
    )
    rows = rows.select(
        key,
        "n_symbols",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )

    def window(i: Column) -> Column:
        return F.xxhash64(*[F.get("hashes", i + k) for k in range(WINDOW)])

    counts = [key, "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines"]
    starts = F.sequence(F.lit(0), F.size("hashes") - WINDOW)
    rows = rows.select(
        *counts,
        F.size(F.array_distinct("hashes")).cast("long").alias("n_distinct_words"),
        F.when(F.size("hashes") > WINDOW, F.transform(starts, window)).otherwise(none).alias("windows"),
    )
    counts.append("n_distinct_words")
    # Most texts repeat no window; only the others are sorted.
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.sort_array(F.transform("windows", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    empty = F.array().cast("array<struct<w:bigint,i:int>>")
    rows = rows.select(*counts, F.when(repeats, placed).otherwise(empty).alias("sorted"))

    def repeated(x: Column, j: Column) -> Column:
        same = [F.coalesce(F.get("sorted", j + k)["w"] == x["w"], F.lit(False)) for k in (-1, 1)]
        return same[0] | same[1]

    at = F.sort_array(F.transform(F.filter("sorted", repeated), lambda x: x["i"]))
    rows = rows.select(*counts, at.alias("starts"))
    covered = F.transform("starts", lambda s, j: F.least(F.lit(WINDOW), F.coalesce(F.get("starts", j + 1) - s, F.lit(WINDOW))))
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x)
    # Through a generator, which filters on the counts stay above: moved below it they would repeat all this.
    found = F.struct(*counts[1:], total.alias("n_repeat_words"))
    return rows.select(key, F.inline(F.array(found)))


def base_failed() -> Column:
    """Too few words, or too many of them in repeated windows."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _cut_points(labelled: DataFrame) -> dict[str, list[float]]:
    """Per feature, distinct quantiles over all labelled rows and over the rejected ones."""
    at = [(k + 0.5) / CUTS for k in range(CUTS)]
    found = labelled.agg(
        *[
            F.percentile_approx(F.when(F.lit(every) | F.col("reject"), feature(f)), at, 100_000).alias(f"{f}_{every}")
            for f in FEATURES
            for every in (True, False)
        ]
    ).first()
    return {f: sorted({c for every in (True, False) for c in found[f"{f}_{every}"] or []}) for f in FEATURES}


def _bin(name: str, cuts: list[float]) -> Column:
    """How many cut points a feature reaches."""
    value = feature(name)
    return F.size(F.filter(F.array(*[F.lit(c) for c in cuts]).cast("array<double>"), lambda cut: cut <= value))


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    """Information won by going from p0 rejected and n0 kept documents to p and n."""
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0


def _best_condition(rows: DataFrame, cuts: dict[str, list[float]]) -> tuple[Condition | None, int, int]:
    """The condition of highest gain over these rows, with the rejected and kept rows it covers."""
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"bin_{f}").alias("bin")) for f in FEATURES])
    counts = (
        rows.select(F.explode(pairs).alias("x"), "reject", "rows")
        .groupBy("x.feature", "x.bin")
        .agg(F.sum(F.when(F.col("reject"), F.col("rows"))).alias("p"), F.sum(F.when(~F.col("reject"), F.col("rows"))).alias("n"))
        .collect()  # at most a row for each feature and cut point
    )
    best: tuple[float, Condition | None, int, int] = (1e-9, None, 0, 0)
    for f in sorted(FEATURES):
        own = {r["bin"]: (r["p"] or 0, r["n"] or 0) for r in counts if r["feature"] == f}
        p0, n0 = sum(p for p, _ in own.values()), sum(n for _, n in own.values())
        if not p0:
            continue
        p = n = 0
        for k in range(1, len(cuts[f]) + 1):
            p, n = p + own.get(k - 1, (0, 0))[0], n + own.get(k - 1, (0, 0))[1]
            for below, pc, nc in ((True, p, n), (False, p0 - p, n0 - n)):
                if (gain := _gain(pc, nc, p0, n0)) > best[0]:
                    best = (gain, Condition(f, below, k, cuts[f][k - 1]), pc, nc)
    return best[1:]


def _all(conditions: list[Condition]) -> Column:
    return reduce(lambda a, b: a & b, [c.on_bins() for c in conditions])


def learn(labelled: DataFrame) -> list[list[Condition]]:
    """Rules from rows of statistics with ``reject`` (boolean) and ``doc_id``.

    Without rejected rows, or without any rows, there are no rules.
    """
    labelled = stage(labelled, "labelled")
    cuts = _cut_points(labelled)
    bins = [_bin(f, cuts[f]).alias(f"bin_{f}") for f in FEATURES]
    prune = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 0
    names = [f"bin_{f}" for f in FEATURES]
    rows = labelled.select(*bins, "reject", prune.alias("prune")).groupBy(*names, "reject", "prune").agg(F.count(F.lit(1)).alias("rows"))
    rows = stage(rows, "labelled-bins")
    rules: list[list[Condition]] = []
    while len(rules) < MAX_RULES:
        rule: list[Condition] = []
        grow = rows.filter(~F.col("prune"))
        while len(rule) < MAX_CONDITIONS:
            found, _, kept = _best_condition(grow, cuts)
            if not found:
                break
            rule.append(found)
            grow = grow.filter(found.on_bins())
            if not kept:
                break
        if not rule:
            break
        # The prefix that keeps the best balance of rejected over kept documents where it was not grown.
        covers = [_all(rule[: k + 1]) for k in range(len(rule))]
        seen = rows.agg(
            *[
                F.coalesce(F.sum(F.when(cover & F.col("prune") & (F.col("reject") == reject), F.col("rows"))), F.lit(0)).alias(f"c{k}_{reject}")
                for k, cover in enumerate(covers)
                for reject in (True, False)
            ]
        ).first()
        worth = [(seen[f"c{k}_True"], seen[f"c{k}_False"]) for k in range(len(rule))]
        value = [(p - n) / (p + n) if p + n else -1.0 for p, n in worth]
        k = max(range(len(rule)), key=lambda i: (value[i], -i))
        p, n = worth[k]
        if p < MIN_COVER or p < MIN_PRECISION * (p + n):
            break
        rules.append(rule[: k + 1])
        rows = rows.filter(~_all(rule[: k + 1]))
    return rules


def verdict(rules: list[list[Condition]]) -> Column:
    """The decision list as one expression: false at the first rule that covers a row, else true."""
    out = None
    for rule in rules:
        cover = reduce(lambda a, b: a & b, [c.on_values() for c in rule])
        out = F.when(cover, F.lit(False)) if out is None else out.when(cover, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def _marks(labels: DataFrame) -> DataFrame:
    """doc_id and reject of usable labels: quality 0 or 1; the lower of several counts."""
    usable = named(labels, doc_id="doc_id", quality="quality").filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    return usable.groupBy("doc_id").agg((F.min("quality") == 0).alias("reject"))


def judge(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, list[list[Condition]]]:
    """Statistics of all documents (doc_id, text) with base_failed and kept, and the rules behind them.

    ``labels`` has doc_id and quality.  Rules are learned from labelled documents that pass the base rule; without
    labels only the base rule holds.  Rows of one id share its label, each is judged by its own text.
    """
    found = stage(statistics(docs).withColumn("base_failed", base_failed()), "statistics")
    rules = learn(found.filter(~F.col("base_failed")).join(_marks(labels), "doc_id"))
    return found.withColumn("kept", ~F.col("base_failed") & verdict(rules)), rules


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, columns as they are."""
    # Rows are written with their counts, so texts are counted once and only ids meet the labels.
    found = stage(statistics(docs, with_row=True).filter(~base_failed()), "row-statistics")
    rules = learn(found.withColumn("doc_id", F.col("_row.doc_id")).drop("_row").join(_marks(labels), "doc_id"))
    return found.filter(verdict(rules)).select("_row.*")
