"""Neighbours against brute force."""

import random

import numpy as np
import pytest

from opslens.llm import permutation_index as pi

SCHEMA = "vec_id long, vector array<float>, shard string, score string"


def brute(rows, every, k=10):
    size = len(rows[0][1])
    good = [(i, np.array(v, np.float32).astype(float)) for i, v, *_ in rows
            if i is not None and v and len(v) == size and None not in v and np.isfinite(v).all() and any(v)]
    out = {}
    for i, q in good:
        if i % every == 0:
            near = {}
            for j, v in good:
                if j != i:
                    near[j] = min(near.get(j, np.inf), float(np.sqrt(((v - q) ** 2).sum())))
            out[i] = sorted((d, j) for j, d in near.items())[:k]
    return out


def vectors(n, size=8, seed=0):
    rng = np.random.default_rng(seed)
    return [(int(i), rng.normal(size=size).astype(np.float32).tolist(), "s", "x") for i in rng.permutation(n)]


ODD = [(None, [1.0] * 8), (90, None), (91, []), (900, [0.0] * 8), (901, [float("nan")] + [1.0] * 7), (902, [float("inf")] + [1.0] * 7),
       (903, [None] + [1.0] * 7), (904, [1.0] * 9)]


def test_exact_where_all_are_measured(spark, monkeypatch):
    """With every posted vector measured the result is brute force: ties, odd rows, several shards and blocks."""
    monkeypatch.setattr(pi, "QUERY_BLOCK", 7)
    rows = vectors(300) + [(i, v, "", "") for i, v in ODD]
    same = rows[5][1]
    rows += [(1000 + i, same, "", "") for i in range(40)] + rows[:3]
    df = spark.createDataFrame(rows, SCHEMA)
    usable = pi.usable(df)
    chosen = pi.choose_pivots(usable, 20)
    assert len({tuple(p) for p in chosen}) == len(chosen) == 20
    index = pi.build(usable, chosen, 20, shard_vectors=50)
    assert index.count() > 4 and sum(len(r.ids) for r in index.collect()) == usable.count()
    got = {}
    for r in pi.search(index, usable.filter("vec_id % 10 = 0"), chosen, 20, measured=1.0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want = brute(rows, 10)
    assert got.keys() == want.keys()
    for q, near in want.items():
        assert [j for _, j, _ in sorted(got[q])] == [j for _, j in near]
        assert [s for _, _, s in sorted(got[q])] == pytest.approx([d for d, _ in near])
        assert [k for k, _, _ in sorted(got[q])] == list(range(1, len(near) + 1))


def test_footrule(spark):
    """What the postings add up to ranks as the footrule between prefixes does."""
    rng = random.Random(1)
    l, m = 6, 10
    for _ in range(50):
        a, b = rng.sample(range(m), l), rng.sample(range(m), l)
        place = lambda o, p: o.index(p) if p in o else l
        plain = sum(abs(place(a, p) - place(b, p)) for p in range(m))
        common = sum(min(l - place(a, p), l - place(b, p)) for p in set(a) & set(b))
        assert plain == l * (l + 1) - 2 * common


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_on_the_tables(spark, sf):
    from opslens.llm.queries import QUERIES

    got = {}
    for r in QUERIES["op3_permutation_index"](spark, f"/root/testdata/{sf}").collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    t = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").toPandas()
    x, ids = np.array(t.embedding.tolist(), float), t.vec_id.to_numpy()
    hits = total = 0
    for i in np.flatnonzero(ids % 100 == 0):
        d = ((x - x[i]) ** 2).sum(axis=1)
        d[i] = np.inf
        true = set(ids[np.argsort(d)[:10]].tolist())
        hits, total = hits + len(true & got[ids[i]]), total + len(true)
    assert hits / total >= 0.95


def test_few_or_none(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert pi.nearest(df, 1).count() == 0
    assert pi.nearest(spark.createDataFrame([(i, v, "", "") for i, v in ODD[1:7]], SCHEMA), 1).count() == 0
    two = pi.nearest(spark.createDataFrame([(0, [1.0], "", ""), (1, [3.0], "", "")], SCHEMA), 1)
    assert sorted(tuple(r) for r in two.collect()) == [(0, 1, 1, 2.0), (1, 1, 0, 2.0)]
