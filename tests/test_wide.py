"""Wide sums and ratios against Python integers."""

import random
from decimal import Decimal as D
from decimal import localcontext

import pytest
from pyspark.sql import functions as F

import opslens.functions as fx
import opslens.operators as op
from opslens.functions.wide import UNIT

TYPE = "decimal(38,18)"


def units(x):
    with localcontext() as c:
        c.prec = 100
        return int(x * UNIT)


def nearest(above, below):
    """above / below as a whole number, half away from zero."""
    q = (2 * abs(above) + abs(below)) // (2 * abs(below))
    return q if (above < 0) == (below < 0) else -q


def number(rng):
    n = rng.randrange(10 ** rng.choice([1, 5, 9, 18, 19, 25, 38]))
    with localcontext() as c:
        c.prec = 60
        return D(n).scaleb(-rng.choice([18, 18, 2]) if n < 10**22 else -18) * rng.choice([1, 1, -1])


@pytest.fixture(scope="module", autouse=True)
def digits():
    with localcontext() as c:
        c.prec = 100
        yield


@pytest.fixture(scope="module")
def pairs(spark, digits):
    rng = random.Random(7)
    top = D("99999999999999999999.999999999999999999")
    rows = [(i, number(rng), number(rng)) for i in range(300)]
    rows += [(1000, D(1), D(8)), (1001, D("1e-18"), D("4e-18")), (1002, D(0), D(5)), (1003, top, top), (1004, D(f"-{top}"), top)]
    return rows, spark.createDataFrame(rows, f"i int, a {TYPE}, b {TYPE}")


@pytest.mark.parametrize(("factor", "scale"), [(100, 1), (1, 18), (100, 6), (1, 0)])
def test_ratio_equals_integers(pairs, factor, scale):
    rows, df = pairs
    got = {r.i: r.q for r in df.select("i", fx.exact_ratio("a", "b", factor, scale).alias("q")).collect()}
    for i, a, b in rows:
        if b == 0:
            assert got[i] is None
            continue
        want = nearest(units(a) * factor * 10**scale, units(b))
        assert got[i] is None and abs(want) >= 10**35 or units(got[i]) == want * 10 ** (18 - scale), (a, b)


def test_ratio_of_nothing(spark):
    df = spark.createDataFrame([(None, D(1)), (D(1), None), (D(1), D(0))], f"a {TYPE}, b {TYPE}")
    assert [r[0] for r in df.select(fx.exact_ratio("a", "b", scale=3)).collect()] == [None] * 3


def test_sum_beyond_a_decimal(spark, pairs):
    """A sum above 10^21, in two steps of aggregation, equals Python integers."""
    rows, df = pairs
    top = D("99999999999999999999.999999999999999999")
    many = df.select("i", "a").unionByName(spark.range(40).select(F.col("id").cast("int").alias("i"), F.lit(top).cast(TYPE).alias("a")))
    parts = many.groupBy(F.col("i") % 7).agg(fx.wide_sum("a").alias("s"))
    total = parts.agg(fx.wide_merge("s").alias("t"))
    found = total.select("t", fx.wide_text("t").alias("text"), fx.wide_decimal("t", 6).alias("d"), fx.wide_decimal("t", 0).alias("n")).first()
    want = sum(units(a) for _, a, _ in rows) + 40 * units(top)
    assert want > 10**21 * UNIT and fx.wide_units(found.t) == want
    assert units(D(found.text)) == want
    assert units(found.d) == nearest(want, 10**12) * 10**12 and units(found.n) == nearest(want, UNIT) * UNIT


def test_sums_of_signs_and_nothing(spark):
    df = spark.createDataFrame([(D("-1.5"),), (D("0.25"),), (None,)], f"a {TYPE}")
    row = df.agg(fx.wide_sum("a").alias("t")).select(fx.wide_text("t").alias("x"), fx.wide_decimal("t", 1).alias("d")).first()
    assert (row.x, row.d) == ("-1.25", D("-1.3"))
    none = df.filter("a > 9").agg(fx.wide_sum("a").alias("t")).select("t", fx.wide_text("t").alias("x")).first()
    assert (none.t, none.x) == (None, None)


def test_shares_and_mean_of_small_fractions(spark):
    df = spark.createDataFrame([(D("1e-18"),), (D("3e-18"),)], f"v {TYPE}")
    assert sorted(r.pct for r in op.share_of_total(df, "v", "pct").collect()) == [D("25.0"), D("75.0")]
    assert op.distribution_stats(df, "v").first()["mean"] == D("2e-18")


@pytest.mark.parametrize("digits", [1, 9])
def test_shares_of_a_total_beyond_a_decimal(spark, digits):
    """Both forms of the division: by a literal, and digit by digit where the dividend is too wide."""
    top = D("99999999999999999999.5")
    rows = [top, top, D("0.000000000000000001"), D("-12345678901234567.25"), None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], f"i int, v {TYPE}")
    got = {r.i: r.pct for r in op.share_of_total(df, "v", "pct", digits).collect()}
    total = sum(units(v) for v in rows if v is not None)
    for i, v in enumerate(rows):
        want = None if v is None else nearest(units(v) * 100 * 10**digits, total)
        assert (got[i] if v is None else units(got[i])) == (None if v is None else want * 10 ** (18 - digits))


def test_share_of_zero_total(spark):
    df = spark.createDataFrame([(D("1.5"),), (D("-1.5"),)], f"v {TYPE}")
    assert [r.pct for r in op.share_of_total(df, "v", "pct").collect()] == [None, None]
