import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from rentpulse import rules as R
from rentpulse.functions import cleanse as C
from rentpulse.functions import dates as D
from rentpulse.functions import labels as L
from rentpulse.functions import numeric as N
from rentpulse.functions.keys import KEY_NULL, surrogate_key
from rentpulse.plans import silver
from rentpulse.plans.facts import is_active
from rentpulse.rules import RentalRules

RULES = RentalRules(as_of=dt.date(2026, 7, 15))


def texts(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")


def numbers(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, n bigint")


def column(df, expr):
    return [row[0] for row in df.orderBy("i").select(expr).collect()]


def test_try_long_rounds_and_keeps_19_digits(spark):
    df = texts(spark, ["12", " 7 ", "5.7", "2.5", "-2.5", "", None, "abc", "1234567890123456789", "1e30"])
    assert column(df, C.try_long("t")) == [12, 7, 6, 3, -3, None, None, None, 1234567890123456789, None]


def test_strict_long_fails_on_bad_text(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        texts(spark, ["12", "x"]).select(C.strict_long("t")).collect()


def test_try_double_refuses_java_spellings(spark):
    df = texts(spark, ["1.5", "-3", "1e3", "5d", "2f", "NaN", "Infinity", "0x1p3", "1e999", "7.", "", None])
    assert column(df, C.try_double("t")) == [1.5, -3.0, 1000.0] + [None] * 6 + [7.0, None, None]


def test_currency_and_percent(spark):
    df = texts(spark, ["$1,234.50", "$0.99", "N/A", "", None])
    assert column(df, C.currency("t")) == [1234.5, 0.99, None, None, None]
    df = texts(spark, ["95%", "100%", "N/A", None])
    assert column(df, C.percent("t")) == [95.0, 100.0, None, None]


def test_flags_are_never_null(spark):
    df = texts(spark, ["t", "f", "T", "", None])
    assert column(df, C.flag("t")) == [True, False, False, False, False]
    assert column(df, C.equals_flag("t", "f")) == [False, True, False, False, False]


def test_availability_boundaries(spark):
    df = numbers(spark, [59, 60, 179, 180, 181, None])
    low, part, full = R.AVAILABILITY_PROFILES
    assert column(df, silver.availability_profile(F.col("n"), RULES)) == [low, part, part, full, full, full]
    assert column(df, C.above_flag(F.col("n"), 180)) == [False, False, False, False, True, False]


def test_host_profile_boundaries(spark):
    df = numbers(spark, [1, 2, 4, 5, None])
    single, multi, professional = R.HOST_PROFILES
    assert column(df, silver.host_profile(F.col("n"), RULES)) == [single, multi, multi, professional, single]


def test_null_tokens(spark):
    df = texts(spark, ["", "NULL", "null", "NA", "Na", "x", None])
    assert column(df, C.null_tokens("t", ["", "NULL", "null", "NA"])) == [None] * 4 + ["Na", "x", None]


def test_dates(spark):
    df = texts(spark, ["2020-12-31", "2021-13-01", "31/12/2020", "", None])
    day = D.try_date("t")
    assert column(df, day) == [dt.date(2020, 12, 31), None, None, None, None]
    assert column(df, D.years_between(day, F.lit(dt.date(2021, 1, 1))))[0] == 1
    assert column(df, D.days_between(day, F.lit(dt.date(2021, 1, 1))))[0] == 1
    assert column(df, D.month_start(day))[0] == dt.date(2020, 12, 1)


def test_cap_needs_both_sides(spark):
    df = spark.createDataFrame([(0, 5.0, 3.0), (1, 2.0, 3.0), (2, None, 3.0), (3, 2.0, None)], "i int, v double, c double")
    assert column(df, N.cap(F.col("v"), F.col("c"))) == [3.0, 2.0, None, None]


def test_safe_divide_and_rounding(spark):
    df = spark.createDataFrame([(0, 7.0, 2), (1, 7.0, 0), (2, None, 2)], "i int, a double, b bigint")
    assert column(df, N.safe_divide(F.col("a"), F.col("b"))) == [3.5, None, None]
    df = spark.createDataFrame([(0, 2.0049996), (1, 4.125), (2, -4.125)], "i int, a double")
    assert column(df, F.round(F.col("a"), 2)) == [2.0, 4.13, -4.13]


def test_sums_do_not_depend_on_the_order(spark):
    values = [0.1] * 7 + [1e9, -1e9 + 0.005, 33.335] + [None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, a double")
    for order in (F.asc("i"), F.desc("i")):
        got = df.orderBy(order).coalesce(1).agg(N.exact_sum(F.col("a")).alias("s"), N.exact_avg(F.col("a")).alias("m")).first()
        assert (got.s, got.m) == (34.04, 3.404)
    none = df.filter("a IS NULL").agg(N.exact_sum(F.col("a")).alias("s"), N.exact_avg(F.col("a")).alias("m")).first()
    assert tuple(none) == (None, None)


def test_a_share_of_many_rows_is_rounded_once(spark):
    share = spark.range(200_003).agg(F.round(N.share_pct(F.col("id") < 20_010), 2).alias("s")).first().s
    assert share == 10.0  # 10.00484993: rounding to three more digits first would change nothing below 10.005


def test_surrogate_key_distinguishes_null(spark):
    df = spark.createDataFrame([(0, 7, "x"), (1, None, "x"), (2, None, None)], "i int, a bigint, b string")
    expected = ["7-x", f"{KEY_NULL}-x", f"{KEY_NULL}-{KEY_NULL}"]
    assert column(df, surrogate_key(F.col("a"), F.col("b"))) == [hashlib.md5(t.encode()).hexdigest() for t in expected]


def test_labels_and_display(spark):
    df = texts(spark, ["malaga", "santa cruz", "x-y", None])
    assert column(df, L.mapped_label(F.col("t"), R.CITY_LABELS)) == ["Málaga", "Santa Cruz", "X-y", None]
    df = numbers(spark, [1234567])
    assert column(df, L.format_count(F.col("n"))) == ["1,234,567"]
    assert column(df, L.format_pct(F.lit(12.34))) == ["12.3%"]
    assert column(df, L.format_money(F.lit(1234.4))) == ["$1,234"]


@pytest.mark.parametrize(
    ("price", "days", "ltm", "last", "expected"),
    [
        (10.0, 5, 1, None, True),
        (10.0, 5, 0, dt.date(2026, 1, 15), True),
        (10.0, 5, 0, dt.date(2026, 1, 14), False),
        (None, 5, 1, None, False),
        (10.0, 0, 1, None, False),
        (10.0, None, 1, None, False),
        (10.0, 5, None, None, False),
    ],
)
def test_activity_rule(spark, price, days, ltm, last, expected):
    df = spark.createDataFrame([(price, days, ltm, last)], "p double, d bigint, l bigint, r date")
    active = is_active(F.col("p"), F.col("d"), F.col("l"), F.col("r"), RULES)
    assert df.select(active).first()[0] is expected
