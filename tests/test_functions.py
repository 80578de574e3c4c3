import datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from opslens import functions as fx
from opslens.plans import vocabulary as v


def test_codes_and_labels_trim_spaces_only(texts):
    assert texts(fx.clean_code("c"), [" ab ", "\tab", None, ""]) == ["AB", "\tAB", None, ""]
    assert texts(fx.clean_label("c"), ["  Ab c "]) == ["Ab c"]
    assert texts(fx.clean_label("c", lower=True), ["  Ab c "]) == ["ab c"]


@pytest.mark.parametrize(
    ("given", "want"),
    [
        ("laki-laki o'NEIL 3RD", "Laki-Laki O'Neil 3rd"),
        ("  two  blanks ", "  Two  Blanks "),
        ("élan ÉCOLE ñandú", "Élan École Ñandú"),
        ("straße ßeta", "Straße ßeta"),
        ("line\nbreak\ttab a\u0001 b", "Line\nBreak\tTab A\u0001 B"),
        ("", ""),
        (None, None),
    ],
)
def test_title_words(texts, given, want):
    assert texts(fx.title_words("c"), [given]) == [want]


def test_title_words_quick_way_equals_the_long_way(texts):
    # A trailing character outside the quick alphabet forces the long way.
    samples = ["abc-def ghi", "x1y2 _z", "ÀB çd.e", "a  b--c'd", "MIXED case", "7up o.k"]
    quick = texts(fx.title_words("c"), samples)
    long = texts(fx.title_words(F.concat("c", F.lit(" 漢"))), samples)
    assert [f"{q} 漢" for q in quick] == long


def test_three_state_flag(texts):
    flag = fx.normalize_bool("c", v.YES_WORDS, v.NO_WORDS, trim=True)
    assert texts(flag, ["yes", "YES ", "1", "N", "0", "N/A", "", None]) == [
        True, True, True, False, False, None, None, None,
    ]


def test_two_state_flag_does_not_trim(texts):
    flag = fx.normalize_bool("c", v.SET_WORDS)
    assert texts(flag, ["yes", "TRUE", "1", " yes", "y", "no", None]) == [
        True, True, True, False, False, False, False,
    ]


def test_enum_trim_and_defaults(texts):
    status = fx.normalize_enum("c", v.STATUS_WORDS, v.STATUS_DEFAULT, trim=True)
    assert texts(status, [" OT ", "delay", "CANCELLED", "??", None]) == [
        "On Time", "Delayed", "Cancelled", "Unknown", "Unknown",
    ]
    gender = fx.normalize_enum("c", v.GENDER_WORDS, v.GENDER_DEFAULT)
    assert texts(gender, [" male ", "Laki-Laki", "P"]) == ["Unknown", "Male", "Female"]
    ticket = fx.normalize_enum("c", v.CLASS_WORDS, v.CLASS_DEFAULT)
    assert texts(ticket, ["zzz", None, "C", "First"]) == ["Economy", "Economy", "Business", "First"]
    severity = fx.normalize_enum("c", v.SEVERITY_WORDS, v.SEVERITY_DEFAULT)
    assert texts(severity, ["3", "CRITICAL", "5", None]) == ["High", "Critical", "Unknown", "Unknown"]


def test_flag_label_takes_any_type(texts):
    label = fx.flag_label("c", v.SET_WORDS, "yes", "no")
    assert texts(label, [True, False, None], "boolean") == ["yes", "no", "no"]
    assert texts(label, ["YES", "1", "y", None]) == ["yes", "yes", "no", "no"]


def test_decimal_shapes(texts):
    got = texts(fx.parse_decimal("c", 9, 6, signed=True), ["-6.1256", "5.", ".5", "+1", "1e3", "12\n", "abc", None])
    assert got == [Decimal("-6.125600"), Decimal("5.000000"), None, None, None, None, None, None]
    assert texts(fx.parse_decimal("c"), ["-1", "1200.5"]) == [None, Decimal("1200.500")]


def test_int_floor_and_overflow(texts):
    delay = fx.parse_int("c", signed=True, floor=0)
    values = ["-5", "30", "N/A", "5.5", None, "99999999999", "-99999999999", "2147483647", "0000000000012", "9" * 60]
    assert texts(delay, values) == [0, 30, None, None, None, None, None, 2147483647, 12, None]
    assert texts(fx.parse_int("c"), ["34", "-1", "12.5"]) == [34, None, None]


def test_count_rounds_half_up_exactly(texts):
    values = ["162.5", "162.4999999999999999999999999999", "162", "5.", "-1", "full", None, "99999999999.5"]
    assert texts(fx.parse_count("c"), values) == [163, 162, 162, 5, None, None, None, None]


def test_first_int(texts):
    assert texts(fx.first_int("c"), ["~120", "about 15 or 20", "35", "many", None, "99999999999"]) == [
        120, 15, 35, None, None, None,
    ]


def test_money(texts):
    values = ["Rp 1.200.000", "RP850,000", "1200000", "12.50", "free", "", None, "9" * 19]
    assert texts(fx.parse_money("c"), values) == [1200000, 850000, 1200000, 1250, None, None, None, None]


def test_stamps_and_dates(texts):
    at = datetime.datetime(2023, 10, 1, 6, 5)
    values = ["2023-10-01 06:05", "2023-10-1 6:05", "2023-10-01 06:05:59", "2023-02-30 10:00", "2023-10", "x", None]
    assert texts(fx.parse_timestamp("c"), values) == [at, at, at, None, None, None, None]
    day = datetime.date(2023, 9, 5)
    assert texts(fx.parse_date("c"), ["2023-09-05", "2023-9-5", "2023/09/05", "2023-09", None]) == [
        day, day, None, None, None,
    ]


def test_stamps_do_not_depend_on_the_session_zone(spark, texts):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        # This hour does not exist in that zone.
        assert texts(fx.parse_timestamp("c"), ["2023-03-26 02:30"]) == [datetime.datetime(2023, 3, 26, 2, 30)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_lenient_double(texts):
    values = ["5", " 1e2 ", ".5", "N/A", "nan", "5d", None]
    assert texts(fx.lenient_double("c"), values) == [5.0, 100.0, 0.5, None, None, None, None]
    assert texts(fx.lenient_double("c", fill=0), ["x", "7"]) == [0.0, 7.0]


@pytest.mark.parametrize(
    ("parser", "bad"),
    [
        (fx.parse_money, "free"),
        (fx.parse_date, "soon"),
        (fx.parse_timestamp, "later"),
        (fx.parse_int, "99999999999"),
    ],
)
def test_strict_mode_fails_the_job(texts, parser, bad):
    assert texts(parser("c"), [bad]) == [None]
    with pytest.raises(PySparkException):
        texts(parser("c", mode="strict"), [bad])


def test_unknown_mode_is_refused(spark):
    for parser in (fx.parse_date, fx.parse_decimal, fx.parse_timestamp):
        with pytest.raises(ValueError):
            parser("c", mode="loose")


def test_ratios(spark):
    df = spark.createDataFrame([(1, 8), (1, 16), (0, 5), (3, 0)], "a bigint, b bigint")
    got = df.select(fx.percent_rounded("a", "b"), fx.round_to_long(fx.average("a", "b"))).collect()
    assert [r[0] for r in got] == [Decimal("12.5"), Decimal("6.3"), Decimal("0.0"), None]
    assert [r[1] for r in got] == [0, 0, 0, None]
    half = spark.createDataFrame([(5, 2), (-5, 2)], "a bigint, b bigint").select(fx.round_to_long(fx.average("a", "b")))
    assert [r[0] for r in half.collect()] == [3, -3]


def test_route_and_indent(texts):
    assert texts(fx.route_label("c", F.lit("B")), ["A", None]) == ["A → B", None]
    assert texts(fx.indent("c", F.lit(2)), ["A"]) == ["    A"]
