"""Learned models against plain Python that follows the definitions, one row at a time."""

import math
import random
import zlib

import numpy as np
import pytest

from opslens.llm import boosted_trees as bt
from opslens.llm import decision_list as dl


def plain_trees(x, y, trees, depth, bins):
    """Scores of the rows that boosting on them gives: every cut of every feature is tried by summing over rows."""
    n = len(y)
    cuts = [sorted({sorted(c)[math.ceil((n - 1) * k / bins)] for k in range(1, bins)}) for c in zip(*x, strict=True)]
    margin = [math.log((sum(y) + 1) / (n - sum(y) + 1))] * n
    for _ in range(trees):
        p = [1 / (1 + math.exp(-m)) for m in margin]
        slope, weight = [a - b for a, b in zip(p, y, strict=True)], [a * (1 - a) for a in p]
        worth = lambda rows: sum(slope[i] for i in rows) ** 2 / (sum(weight[i] for i in rows) + bt.RIDGE)  # noqa: B023, E731
        done, todo = [], [list(range(n))]
        for _ in range(depth):
            after = []
            for rows in todo:
                best = (1e-9, None)
                for f, own in enumerate(cuts):
                    for cut in own:
                        low, high = [i for i in rows if x[i][f] < cut], [i for i in rows if x[i][f] >= cut]
                        if min(sum(weight[i] for i in side) for side in (low, high)) < bt.MIN_WEIGHT:
                            continue
                        gain = worth(low) + worth(high) - worth(rows)
                        if gain > best[0] + 1e-12:
                            best = (gain, (low, high))
                if best[1]:
                    after += best[1]
                else:
                    done.append(rows)
            todo = after
        for rows in done + todo:
            leaf = -bt.RATE * sum(slope[i] for i in rows) / (sum(weight[i] for i in rows) + bt.RIDGE)
            for i in rows:
                margin[i] += leaf
    return [1 / (1 + math.exp(-m)) for m in margin]


@pytest.mark.parametrize("seed", range(3))
def test_trees_grow_as_defined(seed):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(200, 3)), 1).astype(np.float32)
    y = ((x[:, 0] + x[:, 1] > 0.2) ^ (rng.random(200) < 0.1)).astype(float)
    forest = bt.grow(x, y, trees=5, depth=3, bins=8)
    want = plain_trees(x.tolist(), y.tolist(), 5, 3, 8)
    assert forest.score(x) == pytest.approx(want, abs=1e-9)
    assert len(set(np.round(want, 6))) > 8


def plain_rules(rows, cuts):
    """Sequential covering over rows (bins by feature, reject, prune), one row at a time."""
    holds = lambda row, c: (row[0][c[0]] < c[2]) == c[1]
    rules = []
    while len(rules) < dl.MAX_RULES:
        rule, grow = [], [r for r in rows if not r[2]]
        while len(rule) < dl.MAX_CONDITIONS:
            p0, best = sum(r[1] for r in grow), (1e-9, None)
            for f in sorted(dl.FEATURES):
                for k in range(1, len(cuts[f]) + 1):
                    for below in (True, False):
                        held = [r for r in grow if holds(r, (f, below, k))]
                        p = sum(r[1] for r in held)
                        gain = p * (math.log2(p / len(held)) - math.log2(p0 / len(grow))) if p else 0.0
                        if gain > best[0]:
                            best = (gain, (f, below, k))
            if not best[1]:
                break
            rule.append(best[1])
            grow = [r for r in grow if holds(r, best[1])]
            if all(r[1] for r in grow):
                break
        if not rule:
            break
        worth = []
        for k in range(1, len(rule) + 1):
            held = [r for r in rows if r[2] and all(holds(r, c) for c in rule[:k])]
            p = sum(r[1] for r in held)
            worth.append(((2 * p - len(held)) / len(held) if held else -1.0, -k, p, len(held)))
        _, k, p, covered = max(worth)
        if p < dl.MIN_COVER or p < dl.MIN_PRECISION * covered:
            break
        rules.append(rule[:-k])
        rows = [r for r in rows if not all(holds(r, c) for c in rules[-1])]
    return rules


def labelled(seed, kinds, n=700):
    """Statistics of made-up documents, of which a few kinds are rejected."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = rng.randint(10, 200)
        counts = [words, words * rng.randint(2, 9), rng.randint(0, 40), rng.randint(1, 9), rng.randint(0, 6), rng.randint(5, words), rng.randint(0, 9)]
        reject = any(low <= counts[at] < high for at, low, high in kinds) ^ (rng.random() < 0.02)
        out.append((i, *counts, reject, zlib.crc32(str(i).encode()) % 3 == 0))
    return out


NAMES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_distinct_words", "n_repeat_words"]


@pytest.mark.parametrize(("seed", "kinds"), [(1, [(0, 10, 40)]), (2, [(0, 150, 201), (2, 30, 41)]), (3, [])])
def test_rules_are_learned_as_defined(spark, seed, kinds):
    rows = labelled(seed, kinds)
    df = spark.createDataFrame([r[:-1] for r in rows], ", ".join(["doc_id long", *[f"{c} long" for c in NAMES], "reject boolean"]))
    cuts = dl._cut_points(df)
    at = {c: i + 1 for i, c in enumerate(NAMES)}

    def value(row, name):
        part, whole = dl.FEATURES[name]
        return row[at[part]] / max(row[at[whole]], 1) if whole else float(row[at[part]])

    # A cut point is a quantile of all rows or of the rejected ones.
    for f in dl.FEATURES:
        seen = {value(r, f) for r in rows}
        assert set(cuts[f]) <= seen and len(cuts[f]) <= 2 * dl.CUTS
    binned = [({f: sum(c <= value(r, f) for c in cuts[f]) for f in dl.FEATURES}, r[-2], r[-1]) for r in rows]
    got = dl.learn(df)
    want = plain_rules(binned, cuts)
    assert [[(c.feature, c.below, c.bin) for c in rule] for rule in got] == want
    assert bool(want) == bool(kinds)
    # The verdict is the list read in order.
    kept = {r.doc_id: r.kept for r in df.select("doc_id", dl.verdict(got).alias("kept")).collect()}
    for row, (bins, *_) in zip(rows, binned, strict=True):
        assert kept[row[0]] != any(all((bins[f] < k) == below for f, below, k in rule) for rule in want)


def test_rules_end_at_the_documented_number(spark, monkeypatch):
    """A list that is full ends there: further rules are not learned, those before are the same."""
    bands = [(0, low, low + 12) for low in range(15, 195, 60)]
    rows = labelled(7, bands, 2000)
    df = spark.createDataFrame([r[:-1] for r in rows], ", ".join(["doc_id long", *[f"{c} long" for c in NAMES], "reject boolean"]))
    every = dl.learn(df)
    assert 2 < len(every) <= dl.MAX_RULES
    monkeypatch.setattr(dl, "MAX_RULES", 2)
    assert dl.learn(df) == every[:2]
