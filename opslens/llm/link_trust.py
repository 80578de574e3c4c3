"""Verdicts on URLs: rules for hosts and paths, and trust and distrust that flow along links between hosts.

Trust is personalised PageRank from the hosts whose pages an allow rule decides, along links; distrust is the same from
the hosts whose pages a block rule decides, against the direction of links, so a host that links to blocked places is
doubted.  Masses are whole numbers and every share is rounded down, so a run gives the same verdicts whatever the order
of sums, and the flow ends by itself: each round passes on what the round before has brought, until nothing is left
to pass.  All of it is DataFrame operations.

Cases: a null url, or one without ``://``, has an empty host and path, fits no rule and takes no part in the graph.
Null html has no links.  Repeated pages count as often as they stand there.  Links to the own host and links without a
host are left out; the same link between two hosts counts once.  An empty table gives an empty result.  The input's own
columns are kept as the struct ``_row``, so no name can clash.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslens.llm.common import named, stage

#: (verdict, host, start of the path); a rule holds for its host and all hosts below it.
Rule = tuple[str, str, str]
RULES: list[Rule] = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
#: Mass of a host all of whose pages a rule decides.
SEED = 1_000_000
#: Part of a host's mass that goes on along its links, in percent.
DAMPING = 85
#: A host is blocked from this distrust on, if it has more distrust than trust.
LEAST_DISTRUST = 100_000
#: The host of a link.  Character by character, so that all engines read it alike.
LINK = r"""[hH][rR][eE][fF][ \t\n\r]*=[ \t\n\r]*["']?[ \t\n\r]*(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#"'<> \t\n\r]+)"""
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    """What stands between ``://`` and the next ``/``, ``?`` or ``#``, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), _UPPER, _LOWER)


def path(url: Column) -> Column:
    """What follows the host, up to ``?`` or ``#``."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def decide(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits, as ``host/path`` text, and its verdict; both NULL where none fits."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r))
    fits = [
        ((host == on) | F.endswith(host, F.lit(f".{on}"))) & F.startswith(path, F.lit(start)) for _, on, start in ordered
    ]

    def first(values: Sequence[str]) -> Column:
        cases = zip(fits, values, strict=True)
        return reduce(lambda chain, case: chain.when(case[0], F.lit(case[1])), cases, F.when(F.lit(False), F.lit("")))

    return first([on + start for _, on, start in ordered]), first([verdict for verdict, _, _ in ordered])


def host_links(pages: DataFrame) -> DataFrame:
    """Distinct links between different hosts, (``src``, ``dst``), of pages with columns host and html."""
    found = F.transform(F.regexp_extract_all("html", F.lit(LINK), 1), lambda link: F.translate(link, _UPPER, _LOWER))
    ends = pages.filter(F.col("host") != "").select(F.col("host").alias("src"), F.explode(F.array_distinct(found)).alias("dst"))
    return ends.filter(F.col("src") != F.col("dst")).distinct()


def flow(seeds: DataFrame, links: DataFrame, damping: int = DAMPING) -> DataFrame:
    """Mass that ``seeds`` (kind, host, mass) have brought to each (kind, host) by links (kind, src, dst).

    A host sends ``damping`` percent of the mass that reached it, in equal parts rounded down, along its links.  The
    parts are counted before, so a round joins the arrived mass with links and sums by target, partial sums first; what
    a hot host sends is one row per link, and Spark splits the join where one host has very many.
    """
    degrees = links.groupBy("kind", "src").agg(F.count(F.lit(1)).alias("degree"))
    lanes = stage(links.join(degrees, ["kind", "src"]), "lanes")
    arrived = [stage(seeds.filter("mass > 0").select("kind", "host", "mass"), "flow")]
    while not arrived[-1].isEmpty():
        sent = lanes.join(arrived[-1].withColumnRenamed("host", "src"), ["kind", "src"]).select(
            "kind", F.col("dst").alias("host"), F.expr(f"mass * {damping} div (100 * degree)").alias("mass")
        )
        arrived.append(stage(sent.filter("mass > 0").groupBy("kind", "host").agg(F.sum("mass").alias("mass")), "flow"))
    return reduce(DataFrame.unionByName, arrived).groupBy("kind", "host").agg(F.sum("mass").alias("mass"))


def judge(pages: DataFrame, url: str, html: str, rules: Sequence[Rule] = RULES, least: int = LEAST_DISTRUST) -> DataFrame:
    """Every page as ``_row`` with host, path, rule, verdict and its host's trust and distrust.

    The verdict is the rule's, else the host's: ``block`` where its distrust is ``least`` or more and above its trust,
    ``allow`` otherwise.  A host's seed of trust is ``SEED`` times the part of its pages that allow rules decide, and
    its seed of distrust likewise, so many pages alone give a host no weight.
    """
    read = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("_row"))
    address = F.col(f"_row.`{url}`")
    rule, verdict = decide(F.col("host"), F.col("path"), rules)
    judged = read.select("_row", host(address).alias("host"), path(address).alias("path"))
    judged = judged.select("_row", "host", "path", rule.alias("rule"), verdict.alias("ruled"))
    bare = named(pages, url=url, html=html).select(host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), "html")
    # One row per host from here on; a host of a third of all pages is one row per task before the exchange.
    per_host = (
        bare.filter(F.col("host") != "")
        .groupBy("host")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(decide(F.col("host"), F.col("path"), rules)[1] == "allow").alias("trust"),
            F.count_if(decide(F.col("host"), F.col("path"), rules)[1] == "block").alias("distrust"),
        )
    )
    seeds = stage(
        per_host.unpivot(["host", "n"], ["trust", "distrust"], "kind", "k").select(
            "kind", "host", F.expr(f"k * {SEED} div n").alias("mass")
        ),
        "seeds",
    )
    links = stage(host_links(bare), "links")
    both = links.select(F.lit("trust").alias("kind"), "src", "dst").unionByName(
        links.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"))
    )
    masses = flow(seeds, both).groupBy("host").agg(
        *[F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("mass"))), F.lit(0)).alias(k) for k in ("trust", "distrust")]
    )
    doubted = (F.col("distrust") >= least) & (F.col("distrust") > F.col("trust"))
    hosts = stage(masses.select(F.col("host").alias("of"), "trust", "distrust", doubted.alias("doubted")), "hosts")
    return judged.join(hosts, F.col("host") == F.col("of"), "left").select(
        "_row",
        "host",
        "path",
        "rule",
        F.coalesce("ruled", F.when(F.col("doubted"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        F.coalesce("trust", F.lit(0)).cast("long").alias("trust"),
        F.coalesce("distrust", F.lit(0)).cast("long").alias("distrust"),
    )
