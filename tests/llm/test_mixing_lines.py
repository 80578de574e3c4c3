"""Mixing and line frequency against plain Python."""

import collections
import hashlib
import random

import pytest

from opslens.llm import line_frequency as lf
from opslens.llm import mixing
from opslens.llm.common import SPACES

DOCS = "doc_id long, text string, source string, rate string, _row string, copies int"


def targets(sizes, weights=(1, 2, 3), most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, open_, out = sum(sizes.values()), set(names), {}
    while open_:
        rest, w = total - sum(out.values()), sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * rest > most * sizes[s] * w}
        if not over:
            return out | {s: rest * weight[s] / w for s in open_}
        out |= {s: most * sizes[s] for s in over}
        open_ -= over
    return out


def chance(doc_id):
    return int(hashlib.md5(("" if doc_id is None else str(doc_id)).encode()).hexdigest()[:8], 16) / 2**32


def rows(seed, n=300):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        source = rng.choice(["a", "a", "a", "a", "B", "é", "", None, "zz", f"s{i % 7}", "tiny" if i < 2 else "a"])
        text = rng.choice([None, "", " \n", "word " * rng.randint(1, 40), "x\x0by\x0cz 　"])
        out.append((i if rng.random() > 0.02 else None, text, source, "r", "x", 1))
    return out + out[:3] + [(9000, None, "empty", "r", "x", 1)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_mix(spark, seed):
    data = rows(seed)
    size = lambda t: len([w for w in __import__("re").split("[\x20\x09-\x0d]+", t or "") if w])
    sizes = collections.Counter()
    for _, t, s, *_ in data:
        sizes[s] += size(t)
    want = targets(dict(sizes))
    df = spark.createDataFrame(data, DOCS)
    got = mixing.mix(df).collect()
    assert len(got) == len(data)
    expected = collections.Counter()
    for d, t, s, *_ in data:
        rate = want[s] / sizes[s] if sizes[s] else 0
        copies = int(rate) + (chance(d) < rate - int(rate))
        expected[d, s, size(t), sizes[s], round(want[s], 6), copies] += 1
    assert collections.Counter((r.doc_id, r.source, r.size, r.source_size, round(r.target, 6), r.copies) for r in got) == expected
    out = mixing.repeated(df)
    assert out.columns == df.columns
    copies = collections.Counter()
    for r in got:
        copies[r.doc_id, r.source] += r.copies
    assert collections.Counter((r.doc_id, r.source) for r in out.collect()) == +copies


def test_mix_of_nothing(spark):
    assert mixing.mix(spark.createDataFrame([], DOCS)).count() == 0
    assert mixing.repeated(spark.createDataFrame([], DOCS)).count() == 0
    only_empty = spark.createDataFrame([(1, None, "a", "", "", 1), (2, "", None, "", "", 1)], DOCS)
    assert [r.copies for r in mixing.mix(only_empty).collect()] == [0, 0]


PAGES = "page_id long, html string, url string, lines string, kept string, host string"


def brute(data, ratio, least):
    host = lambda u: (u or "").split("/")[2].lower() if (u or "").count("/") > 1 and "://" in u else None
    bare = lambda x: x.strip(SPACES)
    total, seen = collections.Counter(), collections.Counter()
    for _, t, u, *_ in data:
        total[host(u)] += 1
        seen.update((host(u), x) for x in {bare(x) for x in (t or "").split("\n")} if x)
    out = []
    for p, t, u, *_ in data:
        h, all_ = host(u), (t or "").split("\n")
        gone = [bool(bare(x)) and h is not None and seen[h, bare(x)] >= least and seen[h, bare(x)] > ratio * total[h] for x in all_]
        kept = None if t is None else "\n".join(x for x, g in zip(all_, gone) if not g)
        out.append((p, sum(bool(bare(x)) for x in all_), sum(gone), kept))
    return collections.Counter(out)


@pytest.mark.parametrize("ratio,least", [(0.2, 5), (0.5, 2), (0.0, 1)])
def test_line_frequency(spark, ratio, least):
    rng = random.Random(7)
    urls = ["http://hot.example/a"] * 5 + ["https://B.example/x?y", "http://c.example", None, "no url", "", "ftp://d.example/#q"]
    data = [
        (i, rng.choice([None, "", "\n \n", "\n".join(rng.choice(["menu", " menu\t", "x" * 5000, f"own {i}", "é", "", "b", "c", "d"]) for _ in range(rng.randint(1, 9)))]), rng.choice(urls), "l", "k", "h")
        for i in range(200)
    ]
    data += data[:5] + [(None, "menu", "http://hot.example/", "", "", "")]
    df = spark.createDataFrame(data, PAGES)
    found = lf.drop_boilerplate(df, df["html"], lf.host(df["url"]), ratio, least)
    got = collections.Counter((r["_row"].page_id, r.n_lines, r.n_dropped, r.kept) for r in found.collect())
    assert got == brute(data, ratio, least)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_line_frequency_of_nothing(spark):
    df = spark.createDataFrame([], PAGES)
    assert lf.drop_boilerplate(df, df["html"], lf.host(df["url"])).count() == 0


def test_visible_lines(spark, texts):
    html = '<html><head><style>p{}</style><SCRIPT>var t="</p>";</SCRIPT></head><!-- no <p> --><p class="x">One <b>two</b><br/>three</P>'
    (got,) = texts(lf.visible_lines(__import__("pyspark").sql.functions.col("c")), [html])
    assert [x for x in got.split("\n") if x] == ["One two", "three"]
