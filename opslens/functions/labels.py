"""Spelling variants to one label."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from opslens.functions._col import as_col


def _folded(c: Column | str, trim: bool) -> Column:
    c = as_col(c)
    return F.lower(F.trim(c) if trim else c)


def normalize_bool(
    c: Column | str,
    true: Sequence[str],
    false: Sequence[str] | None = None,
    trim: bool = False,
) -> Column:
    """Text flag to BOOLEAN, ignoring case.

    With ``false`` given there are three states and an unknown spelling is
    NULL.  Without it there are two and everything not true, NULL included,
    is FALSE.
    """
    value = _folded(c, trim)
    if false is None:
        return F.coalesce(value.isin(list(true)), F.lit(False))
    return F.when(value.isin(list(true)), F.lit(True)).when(value.isin(list(false)), F.lit(False))


def normalize_enum(
    c: Column | str,
    spellings: Mapping[str, Sequence[str]],
    default: str,
    trim: bool = False,
) -> Column:
    """Map lower-case spellings to their label; everything else to ``default``."""
    value = _folded(c, trim)
    result = None
    for label, words in spellings.items():
        hit = value.isin(list(words))
        result = F.when(hit, F.lit(label)) if result is None else result.when(hit, F.lit(label))
    return F.lit(default) if result is None else result.otherwise(F.lit(default))


def flag_label(c: Column | str, true: Sequence[str], yes: str, no: str) -> Column:
    """A flag of any type to one of two labels; NULL counts as not set."""
    value = F.lower(as_col(c).cast("string"))
    return F.when(value.isin(list(true)), F.lit(yes)).otherwise(F.lit(no))
