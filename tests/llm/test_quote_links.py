"""Messages that quote each other become threads."""

import pytest
from pyspark.sql import functions as F

from rentpulse.llm import quote_links

MESSAGE = "conv_id long, turn long, role string, text string, body string, depth int, level int"


def messages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 1) for r in rows], MESSAGE)


def quote(text):
    return "\n".join("> " + line for line in text.split("\n"))


def places(df):
    return sorted(((r.conv_id, r.turn, r.reply_to, r.root_turn, r.depth, r.position, r.body) for r in df.collect()), key=str)


@pytest.mark.parametrize(("line", "level"), [("plain", 0), ("> a", 1), (">> a", 2), ("> > >a", 3), (" > a", 0), (">", 1)])
def test_levels(spark, line, level):
    assert spark.range(1).select(quote_links.level(F.lit(line))).first()[0] == level


def test_replies_and_threads(spark):
    rows = [
        (1, 0, "a", "First  line\nsecond line"),
        (1, 1, "b", "> first LINE\n\nmy answer"),
        (1, 2, "c", "> second line\nan aside"),
        (1, 3, "a", "> > first line\n> my answer\nthanks"),
        (1, 4, "a", "a new topic\n> never written"),
        (1, 5, "b", "> > second line\n> unknown\nlate"),
        (2, 0, "a", "> my answer\nelsewhere"),
        (2, 1, "b", "> later line\nearly"),
        (2, 2, "b", "later line"),
    ]
    assert places(quote_links.conversations(messages(spark, rows))) == [
        (1, 0, None, 0, 0, 1, "First  line\nsecond line"),
        (1, 1, 0, 0, 1, 2, "\nmy answer".strip("\n")),
        (1, 2, 0, 0, 1, 3, "an aside"),
        (1, 3, 1, 0, 2, 4, "thanks"),
        (1, 4, None, 4, 0, 1, "a new topic"),
        (1, 5, 0, 0, 1, 5, "late"),
        (2, 0, None, 0, 0, 1, "elsewhere"),
        (2, 1, None, 1, 0, 1, "early"),
        (2, 2, None, 2, 0, 1, "later line"),
    ]


def test_a_repeated_line_belongs_to_its_latest_earlier_author(spark):
    rows = [(1, t, "a", "yes") for t in (0, 1, 2)] + [(1, 3, "b", "> yes\nno"), (1, 4, "a", "yes")]
    got = {r[1]: r[2] for r in places(quote_links.conversations(messages(spark, rows)))}
    assert got == {0: None, 1: None, 2: None, 3: 2, 4: None}


@pytest.mark.parametrize("quoted", ["unique\nBest,\nBob", "Unique\n\nBest,\nBob", "unique\nBob"])
def test_recurring_lines_do_not_outvote_the_line_that_tells(spark, quoted):
    """Turn 3 ends as turn 1 does; a quote of turn 1, whole or in part, leads to turn 1 and its thread."""
    rows = [
        (1, 0, "a", "a question"),
        (1, 1, "b", "unique\nBest,\nBob"),
        (1, 2, "a", "another topic"),
        (1, 3, "b", "something else\nBest,\nBob"),
        (1, 4, "a", quote(quoted) + "\nan answer"),
        (1, 5, "c", quote("another topic") + "\n" + quote(quote("Best,\nBob")) + "\nlate"),
    ]
    got = {r[1]: r[2:5] for r in places(quote_links.conversations(messages(spark, rows)))}
    assert got[4] == (1, 1, 1) and got[5] == (2, 2, 1)


def test_passages_are_runs_of_one_level(spark):
    text = "> a\n>\n> b\n> > c\nown\n\nmore\n> a\n> b"
    got = quote_links.passages(messages(spark, [(1, 0, "a", text)])).collect()
    assert sorted((r.level, len(r.lines), r.n) for r in got) == [(0, 2, 1), (1, 2, 2), (2, 1, 1)]


def test_long_chains(spark):
    rows = [(1, 0, "a", "line 0")] + [(1, t, "a", f"> line {t - 1}\nline {t}") for t in range(1, 70)]
    got = quote_links.conversations(messages(spark, rows)).collect()
    assert {(r.turn, r.root_turn, r.depth, r.position) for r in got} == {(t, 0, t, t + 1) for t in range(70)}


def test_awkward_messages(spark):
    rows = [(1, 0, None, None), (1, 1, "a", ""), (1, 2, "a", "> \n>\n"), (None, 3, "a", "x"), (1, None, "a", "> x"), (None, None, None, None)]
    rows += [(3, 0, "a", "word " * 100_000), (3, 1, "b", "> " + "word " * 100_000), (3, 1, "b", "> " + "word " * 100_000)]
    got = places(quote_links.conversations(messages(spark, rows)))
    assert len(got) == len(rows)
    assert [r[2:5] for r in got if r[0] == 3] == [(None, 0, 0), (0, 0, 1), (0, 0, 1)]
    assert all(r[2] is None for r in got if r[0] != 3)
    assert quote_links.conversations(messages(spark, rows).limit(0)).count() == 0
