"""Dated lists: patterns, validity and the as-of join."""

import datetime as dt

import pytest

from rentpulse.llm import url_lists

DAY = dt.date(2024, 3, 1)
ENTRY = "pattern string, listed_on date, listed boolean"
CAPTURE = "page_id long, url string, fetched_on date, rule string, month int, blocked string"


def day(n):
    return DAY + dt.timedelta(days=n)


def captures(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "x") for r in rows], CAPTURE)


def verdicts(df):
    return sorted(((r.page_id, r.blocked, r.rule, r.n_rules) for r in df.collect()), key=str)


@pytest.mark.parametrize(
    ("url", "expected"),
    [
        ("https://u:p@A.b.Example.com:80/x/y?q=/z#f", ["a.b.example.com", "b.example.com", "example.com", "com", "a.b.example.com/x", "a.b.example.com/x/y"]),
        ("//host.", ["host"]),
        ("no url", []),
        ("http:///path", []),
    ],
)
def test_patterns(spark, url, expected):
    row = spark.createDataFrame([(url,)], "url string").select(url_lists.patterns(url_lists.F.col("url")).alias("p")).first()
    assert row.p == expected


def test_entries_active_at_the_fetch(spark):
    entries = [("Bad.org", day(0), True), ("bad.org", day(10), False), ("bad.org", day(40), True), ("ok.net/en", day(5), True)]
    entries += [("bad.org", day(10), False), ("tie.com", day(3), False), ("tie.com", day(3), True), (None, day(0), True), ("x.y", None, True)]
    rows = [(n, "http://www.bad.org/", day(n)) for n in (-1, 0, 9, 10, 39, 40, 400)]
    rows += [(500, "http://ok.net/en/1", day(6)), (501, "http://ok.net/english", day(6)), (502, "http://tie.com", day(3))]
    rows += [(503, None, day(1)), (504, "http://bad.org", None), (505, "", day(1)), (0, "http://www.bad.org/", day(0)), (None, "http://bad.org", day(1))]
    got = verdicts(url_lists.judge(captures(spark, rows), spark.createDataFrame(entries, ENTRY)))
    on = {0, 9, 40, 400}
    expected = [(n, True, "bad.org", 1) if n in on else (n, False, None, 0) for n in (-1, 0, 0, 9, 10, 39, 40, 400)]
    expected += [(500, True, "ok.net/en", 1), (501, False, None, 0), (502, True, "tie.com", 1)]
    expected += [(503, False, None, 0), (504, False, None, 0), (505, False, None, 0), (None, True, "bad.org", 1)]
    assert got == sorted(expected, key=str)


def test_the_longest_rule_is_named(spark):
    entries = spark.createDataFrame([("a.com", day(0), True), ("x.a.com", day(1), True), ("com", day(0), True)], ENTRY)
    got = url_lists.judge(captures(spark, [(1, "http://x.a.com/", day(2))]), entries).first()
    assert (got.rule, got.listed_on, got.n_rules) == ("x.a.com", day(1), 3)


def test_empty_tables(spark):
    entries, rows = spark.createDataFrame([], ENTRY), captures(spark, [(1, "http://a.com", day(0))])
    assert verdicts(url_lists.judge(rows, entries)) == [(1, False, None, 0)]
    some = spark.createDataFrame([("a.com", day(0), True)], ENTRY)
    assert url_lists.judge(rows.limit(0), some).count() == 0


def test_too_deep_patterns_fail(spark):
    entries = spark.createDataFrame([("a.com/" + "x/" * 9, day(0), True)], ENTRY)
    with pytest.raises(Exception, match="too deep"):
        url_lists.validity(entries).collect()
