"""Text to typed values.

Every parser takes ``mode``.  ``"permissive"`` turns what cannot be parsed into
NULL; ``"strict"`` lets the cast fail the job, for loads where a bad value must
stop the run.  Values rejected by a parser's own shape guard are NULL in both.

A failing ``try_cast`` to a number raises and catches an exception per row,
some fifty times the price of a good cast.  So the permissive parsers test the
shape first and check ranges by comparison; their casts do not fail.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opslens.functions._col import as_col

# The accepted shapes of numbers held as text.  ``\z`` rather than
# ``$``, because ``$`` also matches in front of a final line break.
UNSIGNED_INT = r"^[0-9]+\z"
SIGNED_INT = r"^-?[0-9]+\z"
UNSIGNED_DECIMAL = r"^[0-9]+\.?[0-9]*\z"
SIGNED_DECIMAL = r"^-?[0-9]+\.?[0-9]*\z"

# Currency prefix and separators of price texts.
MONEY_PREFIX = "Rp"
MONEY_SEPARATORS = ".,"

# What a number may look like where the source says nothing about its shape.
_ANY_INT = r"^\s*[+-]?[0-9]+\s*\z"
_ANY_NUMBER = r"(?i)^\s*[+-]?([0-9]+\.?[0-9]*(e[+-]?[0-9]+)?|\.[0-9]+(e[+-]?[0-9]+)?|inf|infinity)\s*\z"

# Per integer type: the text length any value of which fits, and the largest value.
_INT_LIMITS = {"int": (9, 2**31 - 1), "bigint": (18, 2**63 - 1)}

_MINUTE_STAMP = r"^\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} [0-9]{1,2}:[0-9]{1,2}"
_DAY_STAMP = r"^\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"


def _convert(c: Column, dtype: T.DataType | str, mode: str) -> Column:
    if mode == "permissive":
        return c.try_cast(dtype)
    if mode == "strict":
        return c.cast(dtype)
    raise ValueError(f"unknown mode {mode!r}")


def _to_integer(c: Column, dtype: str, mode: str) -> Column:
    """Integer-shaped text (or a whole DECIMAL) to an integer type; NULL if out of range."""
    if mode == "strict":
        return c.cast(dtype)
    short, largest = _INT_LIMITS[dtype]
    wide = c.try_cast(T.DecimalType(38, 0))
    in_range = F.when(wide.between(-largest - 1, largest), wide.cast(dtype))
    return F.when(F.length(c.cast("string")) <= short, c.cast(dtype)).otherwise(in_range)


def parse_decimal(
    c: Column | str,
    precision: int = 38,
    scale: int = 18,
    signed: bool = False,
    mode: str = "permissive",
) -> Column:
    """Plain decimal notation to DECIMAL; anything else is NULL.

    ``5.`` is accepted; ``.5``, ``+1`` and exponents are not.  The type is as wide
    as Spark's are, with 20 digits before the point and 18 behind it: a larger
    number is NULL (``permissive``), further digits behind the point are rounded.
    ``beyond_decimal`` counts both.
    """
    c = as_col(c)
    shape = SIGNED_DECIMAL if signed else UNSIGNED_DECIMAL
    return F.when(c.rlike(shape), _convert(c, T.DecimalType(precision, scale), mode))


def beyond_decimal(c: Column | str, precision: int = 38, scale: int = 18, signed: bool = False) -> Column:
    """Whether ``parse_decimal`` takes a text but cannot keep all its digits."""
    c = as_col(c)
    shape = SIGNED_DECIMAL if signed else UNSIGNED_DECIMAL
    whole = F.length(F.regexp_replace(F.substring_index(c, ".", 1), "^-?0*", ""))
    behind = F.length(F.regexp_replace(c, r"^[^.]*\.?|0*$", ""))
    return F.coalesce(c.rlike(shape) & ((whole > precision - scale) | (F.contains(c, F.lit(".")) & (behind > scale))), F.lit(False))


def parse_int(
    c: Column | str,
    signed: bool = False,
    floor: int | None = None,
    mode: str = "permissive",
) -> Column:
    """Integer text to INT; anything else is NULL.  ``floor`` lifts smaller values.

    The floor is applied with CASE: ``greatest`` would skip the NULL of an
    overflowing value and report the floor instead.
    """
    c = as_col(c)
    value = F.when(c.rlike(SIGNED_INT if signed else UNSIGNED_INT), _to_integer(c, "int", mode))
    if floor is None:
        return value
    return F.when(value < floor, F.lit(floor)).otherwise(value)


def parse_count(c: Column | str, mode: str = "permissive") -> Column:
    """Unsigned decimal text rounded half up to INT (fractional head counts).

    The first fractional digit alone decides, so the rounding is exact for any
    number of digits.
    """
    c = as_col(c)
    whole = F.substring_index(c, ".", 1)
    up = F.substr(c, F.length(whole) + 2, F.lit(1)) >= "5"
    value = _to_integer(whole, "bigint", mode) + F.when(up, 1).otherwise(0)
    if mode == "permissive":
        value = F.when(value <= _INT_LIMITS["int"][1], value)
    return F.when(c.rlike(UNSIGNED_DECIMAL), value.cast("int"))


def first_int(c: Column | str, mode: str = "permissive") -> Column:
    """The first run of digits inside free text, as INT."""
    return _to_integer(F.regexp_substr(as_col(c), F.lit("[0-9]+")), "int", mode)


def parse_money(
    c: Column | str,
    prefix: str = MONEY_PREFIX,
    separators: str = MONEY_SEPARATORS,
    mode: str = "permissive",
) -> Column:
    """Price text to BIGINT: currency prefix and thousands separators removed.

    Separators are thousands separators only: ``12.50`` reads as 1250.
    """
    c = as_col(c)
    has_prefix = F.contains(F.lower(c), F.lit(prefix.lower()))
    bare = F.when(has_prefix, F.regexp_replace(c, rf"(?i)\Q{prefix}\E\s*", "")).otherwise(c)
    digits = F.translate(bare, separators, "")
    if mode == "strict":
        return digits.cast("bigint")
    return F.when(digits.rlike(_ANY_INT), _to_integer(digits, "bigint", mode))


def parse_timestamp(c: Column | str, mode: str = "permissive") -> Column:
    """``yyyy-MM-dd HH:mm`` text to TIMESTAMP_NTZ; text after the minute is ignored."""
    c = as_col(c)
    stamp = F.regexp_substr(c, F.lit(_MINUTE_STAMP))
    if mode == "strict":
        return _convert(F.coalesce(stamp, c), "timestamp_ntz", mode)
    # The usual spelling needs no search: the cast checks the rest of it.
    usual = (F.length(c) == 16) & (F.substring(c, 11, 1) == " ") & (F.substring(c, 14, 1) == ":")
    return _convert(F.when(usual, c).otherwise(stamp), "timestamp_ntz", mode)


def parse_date(c: Column | str, mode: str = "permissive") -> Column:
    """``yyyy-MM-dd`` text to DATE."""
    c = as_col(c)
    return _convert(c if mode == "strict" else F.when(c.rlike(_DAY_STAMP), c), "date", mode)


def lenient_double(c: Column | str, fill: float | None = None) -> Column:
    """Whatever reads as a number, as DOUBLE; the rest is NULL or ``fill``."""
    text = as_col(c).cast("string")
    value = F.when(text.rlike(_ANY_NUMBER), text.try_cast("double"))
    return value if fill is None else F.coalesce(value, F.lit(float(fill)))
