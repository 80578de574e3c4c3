"""Shingles, the Jaccard join, chunks and the classifier against plain Python."""

import collections
import itertools
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from opslens.llm import boosted_trees as bt
from opslens.llm import chunk_dedup as cd
from opslens.llm import jaccard_join as jj
from opslens.llm.components import components
from opslens.llm.textbytes import shingles

DOCS = "doc_id long, text string, k1 string, bucket string, label string"
WORDS = re.compile("[^\x20\x09-\x0d]+")
ODD = [None, "", " \n", "a", " a  b ", "a b c d", "a b c d e", "a b c d e f\x0b", "é ü 🙂\x1f漢　字 x y z w", "x " * 40_000]


def grams(text, size=5):
    w = WORDS.findall(text or "")
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def test_shingles():
    texts = ODD + ODD[::-1] + ["b c d e f", "a b c d e"]
    hashes, offsets = shingles(pa.array(texts), 5)
    seen = {}
    for t, a, b in zip(texts, offsets, offsets[1:]):
        w = WORDS.findall(t or "")
        want = [tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))] if w else []
        assert len(want) == b - a
        for g, h in zip(want, hashes[a:b].tolist()):
            assert seen.setdefault(g, h) == h
    assert len(set(seen.values())) == len(seen)
    assert shingles(pa.array([], pa.string()), 5)[1].tolist() == [0]


def test_banding_reaches_recall():
    for s, recall in ((Fraction(4, 5), 0.99999), (Fraction(1, 2), 0.9), (Fraction(9, 10), 0.999)):
        bands, rows = jj.banding(s, recall, 400)
        assert 1 - (1 - float(s) ** rows) ** bands >= recall and bands * rows <= 400
    with pytest.raises(ValueError):
        jj.banding(Fraction(1, 100), 0.999, 10)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(1, 4)))
    out = [(i, t, "x", "y", "z") for i, t in enumerate(ODD)]
    for base in range(12):
        text = [word() for _ in range(rng.randint(5, 120))]
        for _ in range(rng.randint(1, 6)):
            copy = list(text)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
                copy[rng.randrange(len(copy))] = word()
            out.append((1000 - len(out), " ".join(copy), "x", "y", "z"))
    near = [word() for _ in range(300)]
    for _ in range(60):  # many near copies of one text
        copy = list(near)
        for _ in range(rng.randint(0, 9)):
            copy[rng.randrange(300)] = word()
        out.append((5000 + len(out), " ".join(copy), "x", "y", "z"))
    return out + out[20:23] + [(None, out[30][1], "", "", ""), (None, None, "", "", ""), (out[40][0], "another text of the same id", "", "", "")]


def brute_links(rows, limit=Fraction(4, 5)):
    sets = [grams(t) for _, t, *_ in rows]
    n, near = len(rows), collections.defaultdict(set)
    for i, j in itertools.combinations(range(n), 2):
        shared = len(sets[i] & sets[j])
        if (rows[i][1] or "") == (rows[j][1] or "") or sets[i] and sets[j] and shared >= limit * len(sets[i] | sets[j]):
            near[i].add(j), near[j].add(i)
    label = list(range(n))
    for i in range(n):
        todo, seen = [i], {i}
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j), todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        label[i] = (min(ids) if ids else None, min(seen))
    return near, label


@pytest.mark.parametrize("seed,block", [(1, 512), (2, 16)])
def test_links(spark, monkeypatch, seed, block):
    monkeypatch.setattr(jj, "BLOCK", block)
    monkeypatch.setattr(jj, "_DENSE", 6)
    monkeypatch.setattr(jj, "_COLUMNS", 50)
    rows = corpus(seed)
    near, label = brute_links(rows)
    df = spark.createDataFrame(rows, DOCS)
    got = jj.links(df).collect()
    want = collections.Counter((r[0], len(near[i]), label[i][0]) for i, r in enumerate(rows))
    assert collections.Counter((r.doc_id, r.n_links, r.class_id) for r in got) == want
    kept = jj.keep_one(df)
    assert kept.columns == df.columns
    groups = collections.Counter(label[i][1] for i in range(len(rows)))
    left = kept.collect()
    assert len(left) == len(groups)
    firsts = {min((rows[i][0] is None, rows[i][0] or 0) for i in range(len(rows)) if label[i][1] == g) for g in groups}
    assert {(r.doc_id is None, r.doc_id or 0) for r in left} == firsts


def test_links_of_nothing(spark):
    empty = spark.createDataFrame([], DOCS)
    assert jj.links(empty).count() == 0 and jj.keep_one(empty).count() == 0
    blank = spark.createDataFrame([(1, "", "", "", ""), (2, None, "", "", ""), (3, " ", "", "", "")], DOCS)
    assert sorted((r.doc_id, r.n_links, r.class_id) for r in jj.links(blank).collect()) == [(1, 1, 1), (2, 1, 1), (3, 0, 3)]


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 101), (7, 7)] + [(200, i) for i in range(201, 230)]
    got = {r.v: r.label for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 103: 100} | {i: 200 for i in range(200, 230)}


def plain_gear(data):
    h, out = 0, []
    for b in data:
        h = ((h << 1) + int(cd._GEAR[b])) & 0xFFFF
        out.append(h)
    return out


def brute_chunks(text):
    data = (text or "").encode()
    h, found = plain_gear(data), [(m.start(), m.end()) for m in re.finditer(rb"[^\x20\x09-\x0d]+", data)]
    groups, here = [], []
    for k, (a, b) in enumerate(found):
        here.append((a, b))
        hit = h[b - 1] < (1 << 16) // cd.CHUNK_WORDS and b - found[0][0] >= cd.WINDOW
        if hit or len(here) == cd.MOST_WORDS or k == len(found) - 1:
            groups.append(here)
            here = []
    out = []
    for k, g in enumerate(groups):
        a = 0 if k == 0 else g[0][0]
        b = groups[k + 1][0][0] if k + 1 < len(groups) else len(data)
        start = len(data[:a].decode())
        out.append((start, len(data[:b].decode()) - start, len(g), tuple(data[x:y] for x, y in g)))
    return out


def test_gear_is_rolling():
    data = np.frombuffer(bytes(random.Random(1).choices(range(256), k=500)), np.uint8)
    assert cd.gear(data).tolist() == plain_gear(data)


def passages(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghijklé", k=rng.randint(2, 8)))
    text = lambda n: [word() for _ in range(n)]
    shared = [text(60) for _ in range(4)]
    rows, planted = [], collections.defaultdict(list)
    for i in range(80):
        parts = text(rng.randint(20, 150))
        for k, p in enumerate(shared):
            if rng.random() < 0.15:
                at = rng.randrange(len(parts))
                parts[at:at] = p
                planted[k].append(i)
        rows.append((i, " ".join(parts), "", "", ""))
    rows += [(200 + i, t, "", "", "") for i, t in enumerate(ODD)] + rows[:2] + [(None, rows[5][1], "", "", ""), (None, "", "", "", "")]
    rows += [(300, "same line " * 500, "", "", ""), (301, "x " + "same line " * 300, "", "", "")]
    return rows, planted


def test_chunks_and_passages(spark):
    rows, planted = passages(4)
    texts = [t for _, t, *_ in rows]
    found = cd.chunk(pa.array(texts))
    got = collections.defaultdict(list)
    digests = {}
    for t, d, s, n, w in zip(*(found[k].tolist() for k in ("text", "digest", "start", "length", "n_words"))):
        got[t].append((s, n, w, d))
    for i, t in enumerate(texts):
        want = brute_chunks(t)
        assert [g[:3] for g in got[i]] == [w[:3] for w in want], t
        for g, w in zip(got[i], want):
            assert digests.setdefault(w[3], g[3]) == g[3]
    assert len(set(digests.values())) == len(digests)

    owner = lambda d: 1 << 63 if d is None else d
    first = {}
    for d, t, *_ in rows:
        for c in brute_chunks(t):
            first[c[3]] = min(first.get(c[3], 1 << 64), owner(d))
    want = set()
    for d, t, *_ in rows:
        runs, last = [], None
        for s, n, w, words in brute_chunks(t):
            if first[words] < owner(d):
                if last != s:
                    runs.append([])
                runs[-1].append((s, n, w, first[words]))
                last = s + n
        for run in runs:
            by = collections.Counter()
            for _, _, w, f in run:
                by[f] += w
            total, most = sum(by.values()), max((w, -f) for f, w in by.items())
            if total >= cd.RUN_WORDS and most[0] >= cd.SAME_WORDS:
                want.add((d, run[0][0], sum(n for _, n, _, _ in run), total, -most[1]))
    df = spark.createDataFrame(rows, DOCS)
    out = cd.repeated_passages(df).collect()
    assert {(r.doc_id, r.start, r.length, r.n_words, r.first_doc_id) for r in out} == want and len(out) == len(want)
    flagged = {r.doc_id for r in out}
    late = {i for ids in planted.values() for i in ids[1:]}
    assert late <= flagged and flagged <= late | {None, 301}
    assert cd.repeated_passages(df.limit(0)).count() == 0

    cut = cd.drop_repeated(df)
    assert cut.columns == df.columns
    left = collections.Counter((r.doc_id, r.text) for r in cut.collect())
    for d, t, *_ in rows:
        spans = sorted((s, n) for x, s, n, _, _ in want if x == d and (t or "")[s : s + n])
        if d is not None:
            for s, n in reversed(spans):
                t = t[:s] + t[s + n :]
            assert left[d, t]


def test_passages_among_chance_chunks(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choices("abcdefghijkl", k=rng.randint(2, 8)))
    passages = [[word() for _ in range(51)] for _ in range(20)]
    late = [(500 + i, " ".join([word() for _ in range(30)] + p + [word() for _ in range(30)]), "", "", "") for i, p in enumerate(passages)]
    origins = [(400 + i, " ".join([word() for _ in range(20)] + p), "", "", "") for i, p in enumerate(passages)]
    # Each chunk of up to 9 words of a late document is in an earlier document of its own, among other words.
    short = [w for _, t, *_ in late for *_, n, w in brute_chunks(t) if n <= 9]
    early = [(i, " ".join([*(word() for _ in range(8)), *(x.decode() for x in w), *(word() for _ in range(8))]), "", "", "") for i, w in enumerate(short)]
    early = [(i - len(early), *rest) for i, *rest in early]
    found = cd.repeated_passages(spark.createDataFrame(early + origins + late, DOCS)).collect()
    alone = cd.repeated_passages(spark.createDataFrame(origins + late, DOCS)).collect()
    # Other documents neither lose a passage nor change its bounds or its origin, nor make one.
    assert sorted(map(tuple, found)) == sorted(map(tuple, alone))
    assert {(r.doc_id, r.first_doc_id) for r in found} == {(500 + i, 400 + i) for i in range(20)}


def test_statistics():
    texts = [*ODD[:-1], "One two two.\nOne two two.\n#$ A1!", "a b c d e a b c d e"]
    x = bt.statistics(pa.array(texts))
    assert x.shape == (len(texts), len(bt.FEATURES)) and np.isfinite(x).all()
    at = {f: i for i, f in enumerate(bt.FEATURES)}
    last = x[-1]
    assert (last[at["words"]], last[at["distinct_words"]], last[at["repeated_windows"]]) == (10, 0.5, pytest.approx(2 / 6))
    row = x[-2]
    assert row[at["repeated_lines"]] == pytest.approx(1 / 3) and row[at["symbol_share"]] == pytest.approx(2 / 8)
    assert (x[:3] == 0).all()
    for i, t in enumerate(texts):  # a text counts the same alone and among others
        assert np.allclose(bt.statistics(pa.array([t], pa.string()))[0], x[i])


def test_trees_learn_and_walk():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, len(bt.FEATURES))).astype(np.float32)
    y = ((x[:, 1] > 0.3) ^ (x[:, 4] > 0)).astype(float)
    forest = bt.grow(x[:3000], y[:3000])
    got = forest.score(x[3000:])
    assert ((got > 0.5) == y[3000:]).mean() > 0.97
    for i in range(3000, 3010):  # one document, one tree, one node at a time
        total = forest.base
        for node in forest.roots:
            while forest.left[node] >= 0:
                node = forest.left[node] + (x[i, forest.feature[node]] >= forest.cut[node])
            total += forest.value[node]
        assert got[i - 3000] == pytest.approx(1 / (1 + np.exp(-total)))
    assert bt.grow(x[:0], y[:0]).score(x[:3]).tolist() == [0.5] * 3
    assert len(set(bt.grow(x[:9], np.ones(9)).score(x[:3]))) == 1


def test_score(spark):
    rng = random.Random(2)
    rows, labels = [(900 + i, t, "", "", "") for i, t in enumerate(ODD)], []
    for i in range(400):
        good = rng.random() < 0.6
        words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) + ("" if good else "#") for _ in range(rng.randint(5, 50))]
        rows.append((i, " ".join(words), "", "", ""))
        # Labels of held-out documents lie: nothing may learn from them.
        held = zlib.crc32(str(i).encode()) % 4 == 2
        labels.append((i, int(good) if not held else int(not good)))
    rows += [rows[-1], (None, "a b", "", "", ""), (None, None, "", "", "")]
    df = spark.createDataFrame(rows, DOCS)
    marks = spark.createDataFrame([*labels, (None, 1), (3, None), (5, 8)], "doc_id long, quality int")
    got = bt.score(df, marks).collect()
    assert len(got) == len(rows)
    truth = dict(labels)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        if r.doc_id in truth:
            assert r.predicted == (truth[r.doc_id] if not r.held_out else 1 - truth[r.doc_id])
    assert bt.score(df.limit(0), marks).count() == 0
    assert {r.score for r in bt.score(df, marks.limit(0)).collect()} == {0.5}
