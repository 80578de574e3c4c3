"""Source divergence, link trust and the prefix trie against plain versions, and on odd rows."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from opslens.llm import link_trust, prefix_trie, source_divergence
from opslens.llm.common import importable

TERM = re.compile(source_divergence.TERM)
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, term string, sid int"
TURNS = "conv_id long, turn long, role string, text string, name string"
PAGES = "page_id long, url string, html string, host string, verdict string"


@pytest.fixture(scope="module", autouse=True)
def workers(spark):
    importable(spark)


# --- source divergence ---------------------------------------------------------


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain_audit(rows, top):
    docs = [(lang or "", source or "", TERM.findall(lowered(text or ""))) for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        held = Counter(t for d in docs if d[0] == lang for t in set(d[2]))
        kept = sorted(t for t, n in held.items() if n >= 3)
        counts = defaultdict(Counter)
        for at, source, found in docs:
            if at == lang:
                counts[source].update(t for t in found if held[t] >= 3)
        total = sum(counts.values(), Counter())

        def weights(c, kept=kept):
            return {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept}

        p, q = {s: weights(c) for s, c in counts.items()}, weights(total)
        for s in counts:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in counts if o != s]
            found = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, values, limit in (("pair", pairs, None), ("term", found, top)):
                values.sort(key=lambda v: (-v[0], v[1].encode()))
                out += [(lang, s, part, item, v, k + 1) for k, (v, item) in enumerate(values[:limit])]
    return sorted(out)


def divergence(spark, rows, top=200):
    df = spark.createDataFrame([(i, *r, "x", 0) for i, r in enumerate(rows)], DOCS).repartition(3)
    return sorted(tuple(r) for r in source_divergence.audit(df, top).collect())


def test_divergence_equals_plain(spark):
    rng = np.random.default_rng(3)
    words = ["The", "the", "a", "É", "é", "Öl", "b1c", "x-y", "straße", "日本", "q\x00z", "  ", "Q"]
    rows = [
        (" ".join(rng.choice(words, rng.integers(0, 30) ** (3 if i == 7 else 1))), ["en", "de", None][i % 3], f"s{rng.integers(0, 5)}")
        for i in range(120)
    ]
    rows += [(None, "en", None), ("", "en", "s0"), ("alone", "xx", "one"), (None, "xx", "two"), rows[0], rows[0]]
    assert divergence(spark, rows) == plain_audit(rows, 200)
    assert divergence(spark, rows, 2) == plain_audit(rows, 2)


def test_divergence_of_nothing_and_of_a_long_text(spark):
    assert divergence(spark, []) == []
    rows = [("word " * 200_000 + "end", "en", s) for s in "ab"] + [("end word", "en", "a")]
    assert divergence(spark, rows) == plain_audit(rows, 200)


def test_joint_tables_do_not_depend_on_tiles():
    levels = np.random.default_rng(1).integers(0, 4, (50, 7))
    want = Counter((a, b, x, y) for a in range(7) for b in range(a + 1, 7) for x, y in zip(levels[:, a], levels[:, b]))
    for tile in (1, 5, 4096):
        got = Counter()
        for a, b, x, y, n in source_divergence.joint_tables(levels, tile):
            for k in zip(a, b, x, y, n, strict=True):
                got[k[:4]] += k[4]
        assert got == want


# --- link trust ----------------------------------------------------------------


def judged(spark, rows):
    df = spark.createDataFrame([(i, *r, "x", "y") for i, r in enumerate(rows)], PAGES)
    found = link_trust.judge(df, "url", "html").select("_row.page_id", "host", "path", "rule", "verdict", "trust", "distrust")
    return [tuple(r)[1:] for r in found.orderBy("page_id").collect()]


def test_rules_and_addresses(spark):
    rows = [
        ("https://Blog.Example.ORG/ES/", None),
        ("http://blog.example.org/es/1?x#y", ""),
        ("http://example.org/en/12#t", None),
        ("http://example.orga/en/12", None),
        ("http://notexample.org/en/12", None),
        ("//a.org/x", None),
        (None, None),
        ("x://a.org?b", None),
        ("http://com/fr/", None),
        ("http://a.com/de/://b.org/", None),
    ]
    got = [r[:4] for r in judged(spark, rows)]
    assert got[0] == ("blog.example.org", "/ES/", "org/", "allow")
    assert got[1] == ("blog.example.org", "/es/1", "example.org/es/", "block")
    assert got[2] == ("example.org", "/en/12", "example.org/en/1", "block")
    assert got[3] == ("example.orga", "/en/12", None, "allow")
    assert got[4] == ("notexample.org", "/en/12", "org/", "allow")
    assert got[5][:3] == ("", "", None) and got[6] == ("", "", None, "allow")
    assert got[7][:3] == ("a.org", "", None)
    assert got[8] == ("com", "/fr/", "com/fr/", "allow") and got[9][2:] == ("com/de/", "block")


def plain_flow(seeds, edges):
    arrived, total = dict(seeds), Counter(seeds)
    degree = Counter(a for a, _ in edges)
    while arrived:
        after = Counter()
        for a, b in edges:
            after[b] += arrived.get(a, 0) * link_trust.DAMPING // (100 * degree[a])
        arrived = {h: m for h, m in after.items() if m}
        total.update(arrived)
    return total


def test_mass_flows_along_links(spark):
    def link(*to):
        return " ".join(f'<A HREF = "https://{t}/x">' for t in to)

    rows = [
        ("http://good.org/", link("friend.net", "good.org", "FRIEND.net")),
        ("http://friend.net/", link("far.net", "bad.com")),
        ("http://bad.com/de/", link("good.org")),
        ("http://spam.net/", link("bad.com")),
        ("http://farm.net/", link("spam.net", "bad.com")),
        ("http://far.net/", "<a href=/relative> <a href='//friend.net'>"),
        ("http://alone.net/", None),
    ] * 2
    got = judged(spark, rows)
    edges = {("good.org", "friend.net"), ("friend.net", "far.net"), ("friend.net", "bad.com"), ("bad.com", "good.org")}
    edges |= {("spam.net", "bad.com"), ("farm.net", "spam.net"), ("farm.net", "bad.com"), ("far.net", "friend.net")}
    trust = plain_flow({"good.org": link_trust.SEED}, edges)
    distrust = plain_flow({"bad.com": link_trust.SEED}, {(b, a) for a, b in edges})
    assert [r[4:] for r in got] == [(trust[r[0]], distrust[r[0]]) for r in got]
    verdicts = {r[0]: r[3] for r in got}
    assert verdicts == {
        "good.org": "allow", "friend.net": "allow", "bad.com": "block", "spam.net": "block",
        "farm.net": "block", "far.net": "allow", "alone.net": "allow",
    }


def test_no_pages_and_no_python_in_the_plan(spark):
    assert judged(spark, []) == []
    df = spark.createDataFrame([(1, "http://a.org/", "<p>", "h", "v")], PAGES)
    plan = link_trust.judge(df, "url", "html")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- prefix trie ---------------------------------------------------------------


def plain_trie(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(v, key=lambda t: (t[0], t[1], t[2].encode(), t[3].encode()))] for c, v in convs.items()}
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(turns.get(c - c % 20, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, seq in sorted(built.items()):
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    children = Counter(p[:-1] for p in members if p)
    out = []
    for p, m in members.items():
        below = [x for x in members if x[: len(p)] == p]
        saved = sum((len(members[x]) - 1) * len(WORD.findall(x[-1][1])) for x in below if x)
        ends = ",".join(str(c) for c in m if len(built[c]) == len(p))
        parent = members[p[:-1]][0] if p else None
        leaves = sum(not children[x] for x in below)
        out.append((m[0], len(p), parent, len(m), children[p], leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found_trie(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], TURNS).repartition(5)
    return sorted((tuple(r) for r in prefix_trie.trie(df).collect()), key=str)


def test_trie_equals_plain(spark):
    rng = np.random.default_rng(5)
    rows = []
    for c in rng.permutation(140)[:90].tolist():
        n = 33 if c % 20 == 0 else int(rng.integers(1, 12))
        same = c % 7 == 0
        rows += [(c, t, "ab"[t % 2], "hi  there" if same else f"w{rng.integers(0, 2)} x") for t in range(n)]
    rows += [(7, None, None, None), (7, 3, "a", None), (7, 3, "a", None), (None, 1, "a", "b"), (8, None, "z", " "), (8, None, "y", "q")]
    assert found_trie(spark, rows) == plain_trie(rows)


def test_copies_end_at_one_node(spark, monkeypatch):
    """A third and more of all conversations are equal; their ids are hashed in several texts."""
    monkeypatch.setattr(prefix_trie, "_IDS", 16)
    rows = [(c, t, "u", f"turn {t}") for c in range(150) for t in range(4)] + [(c, 0, "u", f"own {c}") for c in range(1000, 1100)]
    assert found_trie(spark, rows) == plain_trie(rows)


def test_one_long_conversation(spark):
    rows = [(41, t, "u", f"turn {t % 3}") for t in range(300)] + [(40, 0, "u", "turn 0"), (61, 0, None, "turn 0")]
    assert found_trie(spark, rows) == plain_trie(rows)


def test_no_conversations(spark):
    assert found_trie(spark, []) == []
    assert found_trie(spark, [(None, 1, "a", "b")]) == []


def test_only_turnless_conversations(spark):
    """A conversation with no more turns than its hash skips, and no opening to share, is a member of the root only."""
    short = [c for c in range(1, 60) if zlib.crc32(str(c).encode()) % 4 == 3 and c % 20][:2]
    rows = [(c, 0, "a", "b") for c in short]
    assert found_trie(spark, rows) == plain_trie(rows)
    assert len(found_trie(spark, rows)) == 1


def test_rows_come_sorted_however_they_are_dealt(spark):
    rows = [(1, t, "r", str(t)) for t in range(50)]
    df = spark.createDataFrame([(*r, "x") for r in rows], TURNS)
    few, _ = prefix_trie.rebuilt(df.orderBy(F.desc("turn")))
    many, _ = prefix_trie.rebuilt(df.repartition(7))
    key = ["conv", "pos", "turn", "words"]
    assert sorted(map(tuple, few.select(key).collect())) == sorted(map(tuple, many.select(key).collect()))
