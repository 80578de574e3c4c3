"""Boilerplate lines by their frequency within a site, with native functions only.

For each host, the pages that contain a line are divided by all pages of the host; lines above a ratio are dropped
from the host's pages.  Lines are counted by their MD5, so that long ones do not travel.  On average a
page of a host has at most (its distinct lines / ratio) lines above the ratio, so the set of a host's
boilerplate lines stays small whatever the host's size, and goes to its pages as one array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslens.llm.common import SPACES, stage

#: A line on more than this share of a host's pages is boilerplate, if it repeats: a line on one page of a small host
#: is that page's text.
RATIO = 0.2
MIN_PAGES = 2

#: Parts of a page that are no text, tags that end a line, and all other tags.
HIDDEN = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->"
BREAKS = r"(?is)</?(p|br|div|li|ul|ol|nav|h[1-6]|title|head|body|html|article|section|header|footer|table|tr|td|th|meta|!doctype)\b[^>]*>"
TAGS = r"<[^>]*>"


def host(url: Column) -> Column:
    """The host of a URL in lower case; null if it has none."""
    found = F.regexp_extract(F.lower(url), "^[a-z]+://([^/?#]*)", 1)
    return F.when(found != "", found)


def visible_lines(html: Column) -> Column:
    """A page's text with one line per block."""
    text = F.regexp_replace(html, HIDDEN, "\n")
    return F.regexp_replace(F.regexp_replace(text, BREAKS, "\n"), TAGS, "")


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _key(line: Column) -> Column:
    """A line without white space around it, as 16 bytes."""
    return F.unhex(F.md5(F.btrim(line, F.lit(SPACES)).cast("binary")))


def _blank(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACES)) == ""


def boilerplate(pages: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """Per host (rows of host, text), ``lines``: the MD5s of its boilerplate lines."""
    keyed = pages.filter(F.col("host").isNotNull()).select("host", _lines(F.col("text")).alias("lines"))
    distinct = F.array_distinct(F.transform(F.filter("lines", lambda x: ~_blank(x)), _key))
    # The total is counted as a line of every page, under an empty key: one pass, one exchange.
    seen = keyed.select("host", F.explode(F.concat(F.array(F.lit(b"")), distinct)).alias("line"))
    counts = seen.groupBy("host", "line").agg(F.count(F.lit(1)).alias("pages"))
    often = stage(counts.filter((F.length("line") == 0) | (F.col("pages") >= min_pages)), "line-counts")
    totals = often.filter(F.length("line") == 0).select("host", F.col("pages").alias("total"))
    return (
        often.filter(F.length("line") > 0)
        .join(totals, "host")
        .filter(F.col("pages") > ratio * F.col("total"))
        .groupBy("host")
        .agg(F.collect_set("line").alias("lines"))
    )


def drop_boilerplate(
    pages: DataFrame, text: Column, site: Column, ratio: float = RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """``_row`` (the whole row), host, n_lines, n_dropped and ``kept`` (the text without boilerplate lines).

    Every row is a page, repeated rows too.  Blank lines are never counted and stay.  A page without host keeps all
    lines; a null text has none and stays null.  No pages give no rows.
    """
    rows = pages.select(F.struct(*[pages[f"`{c}`"] for c in pages.columns]).alias("_row"), text.alias("text"), site.alias("host"))
    often = boilerplate(rows.select("host", "text"), ratio, min_pages).select(F.col("host").alias("_host"), "lines")
    # Staged, so that the join has an exchange of its own on either side and can split a hot host's pages.
    often = stage(often, "boilerplate")
    joined = rows.join(often, F.col("host") == F.col("_host"), "left").select(
        "_row", "host", F.col("text").isNull().alias("empty"), _lines(F.col("text")).alias("all"), "lines"
    )
    stays = F.filter("all", lambda x: _blank(x) | ~F.array_contains("lines", _key(x)))
    kept = joined.select(
        "_row", "host", "empty", "all", F.when(F.col("lines").isNull(), F.col("all")).otherwise(stays).alias("left")
    )
    return kept.select(
        "_row",
        "host",
        F.size(F.filter("all", lambda x: ~_blank(x))).cast("long").alias("n_lines"),
        (F.size("all") - F.size("left")).cast("long").alias("n_dropped"),
        F.when(~F.col("empty"), F.array_join("left", "\n")).alias("kept"),
    )
