"""Column expressions.  Everything here is a native Spark expression."""

from opslens.functions.labels import flag_label, normalize_bool, normalize_enum
from opslens.functions.numeric import (
    average,
    exact_ratio,
    percent,
    percent_rounded,
    round_to_long,
    tier,
)
from opslens.functions.parse import (
    first_int,
    lenient_double,
    parse_count,
    parse_date,
    beyond_decimal,
    parse_decimal,
    parse_int,
    parse_money,
    parse_timestamp,
)
from opslens.functions.text import clean_code, clean_label, indent, route_label, title_words
from opslens.functions.wide import ratio_to, wide, wide_decimal, wide_merge, wide_ratio, wide_sum, wide_text, wide_units

__all__ = [
    "average",
    "clean_code",
    "clean_label",
    "exact_ratio",
    "first_int",
    "flag_label",
    "indent",
    "lenient_double",
    "normalize_bool",
    "normalize_enum",
    "parse_count",
    "parse_date",
    "beyond_decimal",
    "parse_decimal",
    "parse_int",
    "parse_money",
    "parse_timestamp",
    "percent",
    "percent_rounded",
    "ratio_to",
    "round_to_long",
    "route_label",
    "tier",
    "title_words",
    "wide",
    "wide_decimal",
    "wide_merge",
    "wide_ratio",
    "wide_sum",
    "wide_text",
    "wide_units",
]
