"""Text normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from opslens.functions._col import as_col

# Fixed value: the separator printed between the two ends of a route.
ROUTE_ARROW = " → "

# A word is a run of letters and digits; everything else is kept as it stands.
_WORD_OR_GAP = r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"
_GAP_BUT_SPACE = r"([^\p{L}\p{N} ])"

# Western text whose letters all have a capital of one character (no ß, ŉ or İ),
# and which does not hold the mark itself.
_WORD_MARK = "\u0001 "
_WESTERN = r"^[\u0002-Þà-įı-ňŊ-ſ]*\z"


def clean_code(c: Column | str) -> Column:
    """Identifier form: spaces trimmed, upper case."""
    return F.upper(F.trim(as_col(c)))


def clean_label(c: Column | str, lower: bool = False) -> Column:
    """Label form: spaces trimmed, optionally lower case."""
    trimmed = F.trim(as_col(c))
    return F.lower(trimmed) if lower else trimmed


def title_words(c: Column | str) -> Column:
    """Upper-case the first character of every alphanumeric run, lower-case the rest.

    Spark's own ``initcap`` only starts a word after a space, so ``one-two``
    would become ``One-two``; here it becomes ``One-Two``.  A letter without a
    one-character capital (``ß``) stays as it is.

    Western text is marked so that every word follows a space, goes through
    ``initcap`` and loses its marks again; that is several times cheaper than
    taking the text apart, which is left for the rest.
    """
    c = as_col(c)
    marked = F.regexp_replace(c, _GAP_BUT_SPACE, f"$1{_WORD_MARK}")
    quick = F.replace(F.initcap(marked), F.lit(_WORD_MARK), F.lit(""))

    def capitalize(piece: Column) -> Column:
        first = F.substring(piece, 1, 1)
        capital = F.when(F.length(F.upper(first)) == 1, F.upper(first)).otherwise(first)
        return F.concat(capital, F.lower(F.substring(piece, 2, 2**31 - 1)))

    pieces = F.regexp_extract_all(c, F.lit(_WORD_OR_GAP), F.lit(0))
    return F.when(c.rlike(_WESTERN), quick).otherwise(F.array_join(F.transform(pieces, capitalize), ""))


def route_label(origin: Column | str, destination: Column | str, arrow: str = ROUTE_ARROW) -> Column:
    """``origin → destination``; NULL as soon as one end is NULL."""
    return F.concat(as_col(origin), F.lit(arrow), as_col(destination))


def indent(c: Column | str, level: Column | str, unit: str = "  ") -> Column:
    """Prefix ``c`` with ``level`` copies of ``unit``."""
    return F.concat(F.repeat(F.lit(unit), as_col(level)), as_col(c))
