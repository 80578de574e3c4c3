"""Sums and ratios that no number of rows overflows.

A wide number is a struct of two DECIMAL(38,0): ``whole`` and ``fraction``, the latter in units of 10^-18, so its
value is whole + fraction / 10^18.  The two halves of a column are summed apart, as plain sums that Spark combines
before it shuffles, and a carry between them is made once, when a result is read.  A sum of DECIMAL(38,18) so holds
10^18 rows of the largest value, where Spark's own sum of that type ends at 10^20 in all.

Ratios are long division on the wide numbers' digits, rounded half away from zero to a stated scale; they do not pass
through Spark's rule that takes digits behind the point away from a wide quotient.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, Row
from pyspark.sql import functions as F

from opslens.functions._col import as_col

#: Digits of the fraction and their unit.
DIGITS = 18
UNIT = 10**DIGITS
#: Type of both halves in a row; sums of it are DECIMAL(38,0).
_HALF = "decimal(28,0)"
_WIDE = "decimal(38,0)"
#: Whole parts that long division takes: ten times them still fits.
_LARGEST = Decimal(10**37)


def _big(value: int) -> Column:
    return F.lit(Decimal(value)).cast(_WIDE)


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _halves(c: Column, dtype: str) -> tuple[Column, Column]:
    # Spark negates a DECIMAL with 34 digits of precision, so nothing here is negated, but taken from zero.
    whole = F.when(c < 0, F.ceil(c)).otherwise(F.floor(c))
    behind = (c % F.lit(Decimal(1))).cast(f"decimal({DIGITS},{DIGITS})") * F.lit(Decimal(UNIT))
    return whole.cast(dtype), behind.cast(dtype)


def wide(c: Column | str) -> Column:
    """A whole number or DECIMAL (up to 18 digits behind the point) as a wide number; NULL stays NULL."""
    c = as_col(c)
    whole, fraction = _halves(c, _WIDE)
    return F.when(c.isNotNull(), F.struct(whole.alias("whole"), fraction.alias("fraction")))


def wide_sum(c: Column | str, times: Column | str | None = None) -> Column:
    """The sum of a column as a wide number, each row ``times`` over; NULL where no row has a value."""
    parts = _halves(as_col(c), _HALF if times is None else _WIDE)
    if times is not None:
        parts = tuple((half * as_col(times)).cast(_WIDE) for half in parts)
    whole, fraction = (F.sum(half) for half in parts)
    return F.when(whole.isNotNull(), F.struct(whole.alias("whole"), fraction.alias("fraction")))


def wide_merge(c: Column | str) -> Column:
    """The sum of wide numbers, for instance of group totals."""
    c = as_col(c)
    whole, fraction = F.sum(c["whole"]), F.sum(c["fraction"])
    return F.when(whole.isNotNull(), F.struct(whole.alias("whole"), fraction.alias("fraction")))


def _carried(c: Column) -> Column:
    """``(negative, whole, fraction)`` of the absolute value, the fraction under one unit."""

    def split(x: Column) -> Column:
        left = F.pmod(x["fraction"], _big(UNIT))
        # What is carried is a whole number, so the quotient is exact at any scale.
        whole = (x["whole"] + ((x["fraction"] - left) / _big(UNIT)).cast(_WIDE)).cast(_WIDE)
        return _bind(F.struct(whole.alias("whole"), left.cast(_WIDE).alias("fraction")), absolute)

    def absolute(x: Column) -> Column:
        minus = x["whole"] < 0
        borrow = minus & (x["fraction"] > 0)
        whole = F.when(borrow, _big(-1) - x["whole"]).when(minus, _big(0) - x["whole"]).otherwise(x["whole"])
        fraction = F.when(borrow, _big(UNIT) - x["fraction"]).otherwise(x["fraction"])
        return F.struct(minus.alias("negative"), whole.cast(_WIDE).alias("whole"), fraction.cast(_WIDE).alias("fraction"))

    return F.when(c.isNotNull(), _bind(c, split))


def _text(negative: Column, digits: Column, scale: int) -> Column:
    """Decimal notation of a whole number of units of 10^-scale."""
    full = F.lpad(digits, F.greatest(F.length(digits), F.lit(scale + 1)), F.lit("0"))
    whole = F.substr(full, F.lit(1), F.length(full) - scale)
    point = F.concat(F.lit("."), F.right(full, F.lit(scale))) if scale else F.lit("")
    return F.concat(F.when(negative, F.lit("-")).otherwise(F.lit("")), whole, point)


def wide_text(c: Column | str) -> Column:
    """All digits of a wide number, as decimal notation without trailing zeros."""

    def write(x: Column) -> Column:
        behind = F.rtrim(F.lpad(x["fraction"].cast("string"), F.lit(DIGITS), F.lit("0")), F.lit("0"))
        return F.concat(
            F.when(x["negative"], F.lit("-")).otherwise(F.lit("")),
            x["whole"].cast("string"),
            F.when(behind != "", F.concat(F.lit("."), behind)).otherwise(F.lit("")),
        )

    return _bind(_carried(as_col(c)), write)


def wide_decimal(c: Column | str, scale: int = 6) -> Column:
    """A wide number as DECIMAL(38, scale), half away from zero; NULL if it has more than 38 - scale digits before the point."""
    step = 10 ** (DIGITS - scale)

    def build(x: Column) -> Column:
        # Whole units of 10^-scale; the rounding may carry into the whole part.
        over = (x["fraction"] + _big(step // 2)) if step > 1 else x["fraction"]
        units = ((over - F.pmod(over, _big(step))) / _big(step)).cast(_WIDE)
        carry = F.when(units >= _big(10**scale), 1).otherwise(0).cast(_WIDE)
        units = units - carry * _big(10**scale)
        digits = F.concat((x["whole"] + carry).cast(_WIDE).cast("string"), F.lpad(units.cast(_WIDE).cast("string"), F.lit(scale), F.lit("0")))
        return _text(x["negative"], digits if scale else (x["whole"] + carry).cast(_WIDE).cast("string"), scale).try_cast(f"decimal(38,{scale})")

    return _bind(_carried(as_col(c)), build)


def _power(k: Column) -> Column:
    """10^k as DECIMAL, k from 0 to 37."""
    return F.concat(F.lit("1"), F.repeat(F.lit("0"), k)).cast(_WIDE)


def _pair(whole: Column, fraction: Column) -> Column:
    return F.struct(whole.cast(_WIDE).alias("whole"), fraction.cast(_WIDE).alias("fraction"))


def _times(x: Column, k: Column) -> Column:
    """A pair times 10^k, for products under 10^38."""
    low = x["fraction"] * _power(F.least(k, F.lit(DIGITS)))
    rest = F.pmod(low.cast(_WIDE), _big(UNIT))
    up = ((low.cast(_WIDE) - rest) / _big(UNIT)).cast(_WIDE)
    over = F.greatest(k - DIGITS, F.lit(0))
    return F.when(
        k > DIGITS, _pair(x["whole"] * _power(k) + x["fraction"] * _power(over), F.lit(0))
    ).otherwise(_pair(x["whole"] * _power(k) + up, rest))


def _minus(x: Column, y: Column) -> Column:
    borrow = x["fraction"] < y["fraction"]
    return _pair(
        x["whole"] - y["whole"] - F.when(borrow, 1).otherwise(0),
        x["fraction"] - y["fraction"] + F.when(borrow, _big(UNIT)).otherwise(_big(0)),
    )


def _places(x: Column) -> Column:
    """Digits of a pair counted in units of its fraction."""
    return F.when(x["whole"] > 0, F.length(x["whole"].cast("string")) + DIGITS).otherwise(
        F.length(x["fraction"].cast("string"))
    )


def _long_division(above: Column, below: Column, digits: int) -> Column:
    """round(above / below * 10^digits) of two pairs, digit by digit; ``below`` is not zero."""
    k = F.greatest(_places(above) - _places(below) + 1, F.lit(0))

    def divide(x: Column) -> Column:
        multiples = []
        for j in range(1, 10):
            low = (x["by"]["fraction"] * j).cast(_WIDE)
            rest = F.pmod(low, _big(UNIT))
            multiples.append(_pair(x["by"]["whole"] * j + (low - rest) / _big(UNIT), rest))
        return _bind(F.struct(x["above"].alias("above"), x["k"].alias("k"), F.array(*multiples).alias("table")), loop)

    def loop(x: Column) -> Column:
        start = F.struct(_big(0).alias("q"), x["above"].alias("left"))

        def step(state: Column, _: Column) -> Column:
            def digit(left: Column) -> Column:
                return _bind(
                    F.struct(left.alias("left"), F.size(F.filter(x["table"], lambda m: m <= left)).alias("n")),
                    lambda y: F.struct(
                        (state["q"] * 10 + y["n"]).cast(_WIDE).alias("q"),
                        F.when(y["n"] == 0, y["left"]).otherwise(_minus(y["left"], x["table"][y["n"] - 1])).alias("left"),
                    ),
                )

            return _bind(_times(state["left"], F.lit(1)), digit)

        def finish(state: Column) -> Column:
            twice = _minus(x["table"][0], state["left"])
            return (state["q"] + F.when(state["left"] >= twice, 1).otherwise(0)).cast(_WIDE)

        rounds = F.sequence(F.lit(1), x["k"] + digits)
        return F.when(x["k"] + digits > 0, F.aggregate(rounds, start, step, finish)).otherwise(finish(start))

    # The divisor grows by 10^k until it is above the dividend; then k digits stand before the point.  Where it would
    # pass the range of a pair, the dividend is the small one, and nothing need grow.
    return _bind(
        F.struct(above.alias("above"), k.alias("k"), _times(below, k).alias("by")),
        divide,
    )


def wide_ratio(above: Column, below: Column, factor: int = 1, scale: int = DIGITS) -> Column:
    """``factor * above / below`` of two wide numbers as DECIMAL(38, scale), exact to the last digit.

    ``factor`` is a power of ten.  NULL when the divisor is zero or a part is NULL, when the result may have more than
    37 digits, and for whole parts of 10^37 or more.  It is long division, digit by digit, for rows that are groups or
    totals; for a column against one total see ``ratio_to``.
    """
    shift = len(str(factor)) - 1
    if factor != 10**shift:
        raise ValueError("the factor must be a power of ten")
    digits = scale + shift

    def divide(x: Column) -> Column:
        a, b = x["a"], x["b"]
        # More digits than a DECIMAL surely holds, or too many for the division: no result.
        beyond = _places(a) - _places(b) + digits > 36
        beyond = beyond | (a["whole"] >= F.lit(_LARGEST)) | (b["whole"] >= F.lit(_LARGEST))
        zero = (b["whole"] == 0) & (b["fraction"] == 0)
        pairs = [_pair(y["whole"], y["fraction"]) for y in (a, b)]
        q = F.when(zero | beyond, F.lit(None).cast(_WIDE)).otherwise(_long_division(*pairs, digits))
        return _bind(
            F.struct(q.alias("q"), (a["negative"] != b["negative"]).alias("negative")),
            lambda y: _text(y["negative"] & (y["q"] != 0), y["q"].cast("string"), scale).try_cast(f"decimal(38,{scale})"),
        )

    ready = above.isNotNull() & below.isNotNull()
    return F.when(ready, _bind(F.struct(_carried(above).alias("a"), _carried(below).alias("b")), divide))


def wide_units(total: Row | Decimal | None) -> int:
    """A wide number or a DECIMAL that was read, as a Python integer of units of 10^-18."""
    if total is None:
        return 0
    if isinstance(total, Decimal):
        sign, digits, power = total.as_tuple()
        return (-1) ** sign * int("".join(map(str, digits))) * 10 ** (DIGITS + power)
    return int(total["whole"]) * UNIT + int(total["fraction"])


def wide_mean(total: Row | Decimal, count: int) -> Decimal:
    """The mean from a sum that was read, with 18 digits behind the point, half away from zero."""
    units = wide_units(total)
    near = (2 * abs(units) + count) // (2 * count)
    return Decimal(f"{'-' if units < 0 else ''}{near // UNIT}.{near % UNIT:0{DIGITS}d}")


def ratio_to(c: Column | str, total: int, factor: int, digits: int, largest: int) -> Column:
    """``factor * c / total`` as DECIMAL(38, digits), for one divisor that was read, like the total of a share.

    ``total`` and ``largest`` (the largest absolute value of ``c``) are in units of 10^-18.  Where the dividend fits
    in 38 digits, this is one plain division by a literal; else it is ``wide_ratio``.  Both give the same digits.
    """
    c = as_col(c)
    if not total:
        return F.lit(None).cast(f"decimal(38,{digits})")
    if digits > 6 or largest * factor * 10**digits >= 10**31 or abs(total) >= 10**38:
        whole, behind = divmod(total, UNIT)
        divisor = F.struct(_big(whole).alias("whole"), _big(behind).alias("fraction"))
        return wide_ratio(wide(c), divisor, factor, digits)
    whole, fraction = _halves(c, _WIDE)
    signed = (whole * _big(UNIT) + fraction).cast(_WIDE)
    up = (F.when(c < 0, _big(0) - signed).otherwise(signed) * _big(factor * 10**digits)).cast(_WIDE)
    down = _big(abs(total))
    left = up % down
    q = ((up - left) / down).cast(_WIDE) + F.when(left >= down - left, 1).otherwise(0)
    minus = (c < 0) != F.lit(total < 0)
    return (F.when(minus, -q).otherwise(q) / F.lit(Decimal(10**digits))).cast(f"decimal(38,{digits})")
