"""The pipeline and the licence scan against plain Python."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest
from test_mixing_lines import brute as brute_lines
from test_mixing_lines import chance, targets
from test_text_operators import brute_links
from test_tokens import PATH, check_packing
from tokenizers import Tokenizer

import corpus_pipeline
from opslens.llm import decision_list, licences

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(seed, n=160):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghijkl", k=rng.randint(2, 7)))
    rows, labels = [], []
    for i in range(n):
        text = [word() for _ in range(rng.randint(12, 80))]
        if i % 5 == 0:
            text = ["#|" + w for w in text]
        if i % 7 == 1 and i > 20:
            text = rows[i - 7][1].replace("common line", "").split()
            text[rng.randrange(len(text))] = word()
        text = " ".join(text) + ("\ncommon line" if i % 3 == 0 else "")
        rows.append((i, text, "en", rng.choice(["a", "a", "b", "c", None]), len(text)))
        labels.append((i, int("#|" not in text), 0))
    rows += [(1000, None, None, None, None), (1001, "", "en", "a", 0), (None, " ".join(word() for _ in range(30)), "x", "a", 9)]
    rows += [rows[3], (5000, " ".join(word() for _ in range(9000)), "en", "b", 1)]
    return rows, labels


def write(spark, path, rows, labels):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_pipeline(spark, tmp_path):
    rows, labels = documents(11)
    sf = write(spark, tmp_path, rows, labels)
    got = corpus_pipeline.run(spark, sf).collect()

    docs, marks = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    judged = {(r.doc_id, r.n_words): r.kept for r in decision_list.judge(docs, marks)[0].collect()}
    kept = [r for r in rows if judged[r[0], len((r[1] or "").split())]]
    assert 40 < len(kept) < len(rows) and not any("#|" in r[1] for r in kept)
    url = lambda s: None if s is None else f"x://{s}"
    texts = {}
    for p, _, _, text in brute_lines([(r[0], r[1], url(r[3])) for r in kept], 0.2, 2):
        texts.setdefault(p, text)
    assert any("common line" in r[1] and "common line" not in texts[r[0]] for r in kept)
    kept = [(r[0], texts[r[0]], r[2], r[3], len(texts[r[0]])) for r in kept]
    _, label = brute_links(kept)
    groups = {}
    for i, r in enumerate(kept):
        groups.setdefault(label[i][1], []).append(r)
    kept = [min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups.values()]
    size = collections.Counter()
    for r in kept:
        size[r[3]] += len(r[1].split())
    goal = targets(dict(size))
    t = Tokenizer.from_file(PATH)
    want = collections.Counter()
    for r in kept:
        rate = goal[r[3]] / size[r[3]]
        ids = t.encode(r[1], add_special_tokens=False).ids + [0]
        first = (len(ids) - 1) % 2048 + 1
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            key = (r[0], k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))
            want[key] += int(rate) + (chance(r[0]) < rate - int(rate))
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == +want
    bins = check_packing(got, 2048)
    assert bins <= -(-sum(r.length for r in got) // 2048) + 1


def test_stages_keep_columns_and_empty_tables(spark, tmp_path):
    rows, labels = documents(3, 20)
    sf = write(spark, tmp_path, rows, labels)
    for docs in (spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([], SCHEMA)):
        for _, apply in corpus_pipeline.STAGES[:-1]:
            docs = apply(spark, docs, sf)
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert (corpus_pipeline.packing(spark, docs, sf).count() == 0) == (docs.count() == 0)


FILES = [
    (1, "src/LICENSE", "Released under the MIT License."),
    (2, "src/a.py", "some code\nmore code here"),
    (3, "src/deep/er/b.py", "nothing"),
    (4, "src/deep/c.py", "licensed  under the APACHE license, version 2.0\nlots of other words follow in this file and go on"),
    (5, "other/d.py", "plain"),
    (6, "src/gpl/COPYING", "This work is licensed under the GNU General Public License, version 3.\n"),
    (7, "src/gpl/x/y", None),
    (8, None, "All rights reserved."),
    (9, "top.txt", ""),
    (10, "src/gpl", "a file that has a directory's name"),
    (11, "src/near", "Released under the MIT Licence of some other kind that is quite unlike it in most of its many words"),
    (2, "src/a.py", "some code\nmore code here"),
    (12, "two/one", "Released under the MIT License.\nAll rights reserved."),
    (13, "two/two", "Licensed under CC BY-NC 4.0."),
    (14, "two/three", "x"),
]


def test_licences(spark):
    df = spark.createDataFrame([(*f, "p", 0.5) for f in FILES], "id long, name string, text string, path string, score double")
    found = licences.scan(df, df["name"])
    got = collections.defaultdict(list)
    for r in found.collect():
        got[r["_row"].id].append((r.licence, r.origin, r.origin_dir))
    assert len(got[2]) == 2 and sum(map(len, got.values())) == len(FILES)
    want = {
        1: ("MIT", "own", None), 2: ("MIT", "inherited", "src"), 3: ("MIT", "inherited", "src"), 4: ("Apache-2.0", "own", None),
        5: (None, None, None), 6: ("GPL-3.0", "own", None), 7: ("GPL-3.0", "inherited", "src/gpl"), 8: ("all-rights-reserved", "own", None),
        9: (None, None, None), 10: ("MIT", "inherited", "src"), 11: ("MIT", "inherited", "src"), 12: ("MIT", "own", None),
        13: ("CC-BY-NC-4.0", "own", None), 14: ("MIT", "inherited", "two"),
    }
    assert {i: v[0] for i, v in got.items()} == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert licences.scan(df.limit(0), df["name"]).count() == 0


def test_licence_texts_and_headers(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("bcdfghjklm", k=rng.randint(3, 8)))
    code = "\n".join(" ".join(word() for _ in range(6)) for _ in range(120))
    texts = dict(licences.TEXTS[:-6])
    bsd = texts["BSD-3-Clause"].splitlines()
    commented = "\n".join(f" * {line}" for line in texts["ISC"].splitlines())
    holder = "Copyright (c) 2020 Some Body. All rights reserved.\n\n"
    files = [(f"full/{name}/LICENSE", holder + text, name) for name, text in texts.items()] + [(f"full/{name}/x/a.c", code, name) for name in texts]
    files += [
        ("cut/LICENSE", "Copyright (c) 2020\nAll rights reserved.\n" + "\n".join(bsd[: len(bsd) * 2 // 3]), "BSD-3-Clause"), ("cut/a.c", code, "BSD-3-Clause"),
        ("head/b.c", f"/*\n{commented}\n */\n{code}", "ISC"), ("head/c.c", code, None),
        ("gnu/b.c", dict(licences.TEXTS[-6:])["AGPL-3.0"] + "\n" + code, "AGPL-3.0"), ("gnu/c.c", code, None),
        ("line/sa", code + "\nLicensed under CC BY-SA 4.0.", "CC-BY-SA-4.0"), ("line/by", code + "\nLicensed under CC BY 4.0.", "CC-BY-4.0"),
    ]
    df = spark.createDataFrame([(p, t) for p, t, _ in files], "name string, text string")
    found = licences.scan(df, df["name"])
    got = {r.path: r for r in found.collect()}
    assert {p: r.licence for p, r in got.items()} == {p: w for p, _, w in files}
    assert all((r.origin == "inherited") == (p.startswith(("full", "cut")) and p.endswith(".c")) for p, r in got.items() if r.licence)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_anchors_lose_no_line():
    """Every line that reaches the threshold holds an anchor."""
    rng = random.Random(8)
    vocabulary = [re.findall(licences.TERM, t.lower()) for _, t in licences.TEMPLATES]
    every = sorted({t for v in vocabulary for t in v})
    for _ in range(40):
        idf = {t: rng.uniform(1, 12) for t in every}
        need = set(licences.anchors(vocabulary, idf, 0.6))
        for _ in range(60):
            words = rng.choice(vocabulary)
            line = [w for w in words if w not in need and rng.random() < 0.8]
            for v in vocabulary:
                dot = sum(line.count(t) * idf[t] * v.count(t) * idf[t] for t in set(line))
                sizes = [math.sqrt(sum((x.count(t) * idf[t]) ** 2 for t in set(x))) for x in (line, v)]
                assert not line or dot / (sizes[0] * sizes[1]) < 0.6


@pytest.mark.parametrize("name", ["op2_licences", "op5_jaccard_join", "op7_line_frequency", "op9_mixing"])
def test_query_equals_sql(spark, name):
    from compare import difference, duck, duck_rows, spark_rows

    import __spark_entry__ as entry

    sf = "/root/testdata/sf0.001"
    got = spark_rows(entry.queries()[name](spark, sf))
    assert difference(got, duck_rows(duck(sf), entry.oracle_sql()[name])) is None
