"""Statistics against a plain count, and learning on labelled texts."""

import collections
import random
import re

import pytest

from opslens.llm import decision_list as dl

WORDS = re.compile("[^\x20\x09-\x0d]+")
SCHEMA = "doc_id long, text string, words string, sorted string"


def brute(text):
    text = text or ""
    words = WORDS.findall(text)
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = collections.Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(5)}
    n, repeat = len(words), len(covered)
    return {
        "n_words": n,
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_distinct_words": len(set(words)),
        "n_repeat_words": repeat,
        "base_failed": n < 10 or 100 * repeat > 20 * n,
    }


def texts():
    rng = random.Random(3)
    fixed = [
        None, "", " \n ", "a", "a b c d", "a b c d e", "a b c d e a b c d e", "a a a a a a", "a a a a a a a a a a a",
        "x\ny\nx\n\nx \n y", "été\x0bà  🙂 # $% <b>|&*", " 　", "a b c d e f g a b c d e q a b c d e f", "w " * 30_000,
    ]
    return fixed + [" ".join(rng.choice("abc") for _ in range(rng.randint(1, 60))) + "\n" * rng.randint(0, 2) for _ in range(150)]


def test_statistics(spark):
    rows = [(i, t, "x", "y") for i, t in enumerate(texts())]
    df = dl.statistics(spark.createDataFrame(rows, SCHEMA)).withColumn("base_failed", dl.base_failed())
    got = {r.doc_id: r.asDict() for r in df.collect()}
    for i, t, *_ in rows:
        assert {k: v for k, v in got[i].items() if k != "doc_id"} == brute(t), t and t[:80]


def corpus(n=600, seed=1):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(rng.randint(12, 60))]
        kind = i % 6
        if kind == 0:
            words = ["#|" + w[2:] for w in words]
        elif kind == 1:
            words = [w * 6 for w in words]
        rows.append((i, " ".join(words), None, str(i)))
        labels.append((i, int(kind > 1), 0))
    return rows, labels


def judged(spark, rows, labels):
    docs = spark.createDataFrame(rows, SCHEMA)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return docs, marks, dl.judge(docs, marks)


def test_learns_conjunctions(spark):
    rows, labels = corpus()
    _, _, (found, rules) = judged(spark, rows, labels[: len(labels) // 2])
    kept = {r.doc_id: r.kept for r in found.collect()}
    assert 2 <= len(rules) <= dl.MAX_RULES and all(1 <= len(r) <= dl.MAX_CONDITIONS for r in rules)
    wrong = sum(kept[i] != bool(q) for i, q, _ in labels)
    assert wrong <= len(labels) * 0.02  # half of them were not seen


def test_rule_of_two_conditions(spark):
    """Short texts with symbols are bad, long ones and those without are good."""
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(800):
        short, signs = rng.random() < 0.5, rng.random() < 0.5
        words = ["".join(rng.choices("abcdefghij", k=5)) for _ in range(rng.randint(12, 25) if short else rng.randint(60, 90))]
        rows.append((i, " ".join(w + "#" * signs for w in words), None, None))
        labels.append((i, int(not (short and signs)), 0))
    _, _, (found, rules) = judged(spark, rows, labels)
    assert any(len(r) == 2 for r in rules)
    kept = {r.doc_id: r.kept for r in found.collect()}
    assert sum(kept[i] != bool(q) for i, q, _ in labels) <= 8


@pytest.mark.parametrize("labels", [[], [(1, 1, 0), (2, 1, 0)], [(1, None, 0), (None, 0, 0), (2, 7, 0)]])
def test_without_bad_labels_only_the_base_rule(spark, labels):
    rows = [(i, t, None, None) for i, t in enumerate(texts()[:12])] + [(None, "w " * 3, None, None)] * 2
    docs, marks, (found, rules) = judged(spark, rows, labels)
    assert rules == [] and all(r.kept != r.base_failed for r in found.collect())
    assert found.count() == len(rows)
    assert dl.judge(docs.limit(0), marks)[0].count() == 0


def test_keep_leaves_rows_as_they_are(spark):
    rows, labels = corpus(300)
    docs, marks, (found, _) = judged(spark, rows + rows[2:4], labels)
    kept = dl.keep(docs, marks)
    assert kept.columns == docs.columns
    want = sorted(r.doc_id for r in found.filter("kept").collect())
    assert sorted(r.doc_id for r in kept.collect()) == want


def test_native(spark):
    rows, labels = corpus(30)
    plan = judged(spark, rows, labels)[2][0]._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
