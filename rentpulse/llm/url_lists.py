"""Filtering URLs by dated lists, as of the time each was fetched.

A list is a log of entries: from a date on, a pattern is listed or is not. Entries become validity
intervals, and a capture is blocked if an interval of one of its patterns holds its fetch date. A
pattern is a host, which covers its subdomains, or a host and leading path segments.

The as-of join is an equi-join on pattern and month: an interval is a row in each month it touches
between the first and the last capture, a capture a row per pattern it could match. So the captures of
a host with a third of all rows are spread over the months, and joined with that month's intervals
only. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from rentpulse.sources.scratch import materialize

# Path segments a pattern may have.
PATH_SEGMENTS = 8

_HOST = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:@]*)"
_PATH = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*([^?#]*)"


def host(url: Column) -> Column:
    """Lower-case host without user, port and closing dots; empty if there is none."""
    return F.rtrim(F.lower(F.regexp_extract(url, _HOST, 1)), F.lit("."))


def path_segments(url: Column) -> Column:
    return F.filter(F.split(F.regexp_extract(url, _PATH, 1), "/"), lambda s: s != "")


def patterns(url: Column) -> Column:
    """All patterns that cover a URL: its host, every parent of it, and the host with leading path segments."""
    labels = F.split(host(url), r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    segments = F.slice(path_segments(url), 1, PATH_SEGMENTS)
    depth = F.sequence(F.lit(1), F.greatest(F.size(segments), F.lit(1)))
    below = F.transform(depth, lambda i: F.concat(host(url), F.lit("/"), F.array_join(F.slice(segments, 1, i), "/")))
    below = F.when(F.size(segments) > 0, below).otherwise(F.array().cast("array<string>"))
    return F.when(host(url) == "", F.array().cast("array<string>")).otherwise(F.concat(parents, below))


def validity(entries: DataFrame) -> DataFrame:
    """Intervals (pattern, valid_from, valid_to) from entries (pattern, listed_on, listed).

    ``valid_to`` is the pattern's next entry (exclusive), NULL if there is none. Of several entries on
    one date, one that lists the pattern wins. Entries with a NULL are ignored. Patterns are compared in
    lower case up to the path; one with more than PATH_SEGMENTS segments is an error.
    """
    cut = F.split("pattern", "/", 2)
    lowered = F.concat_ws("/", F.lower(cut[0]), F.when(F.size(cut) > 1, cut[1]))
    deep = F.size(F.split("pattern", "/")) > PATH_SEGMENTS + 1
    checked = F.when(deep, F.raise_error(F.concat(F.lit("pattern too deep: "), F.col("pattern")))).otherwise(lowered)
    daily = (
        entries.filter("pattern IS NOT NULL AND listed_on IS NOT NULL AND listed IS NOT NULL")
        .select(checked.alias("pattern"), "listed_on", "listed")
        .groupBy("pattern", "listed_on")
        .agg(F.max("listed").alias("listed"))
    )
    following = F.lead("listed_on").over(W.partitionBy("pattern").orderBy("listed_on"))
    dated = daily.withColumn("valid_to", following).filter("listed")
    return dated.select("pattern", F.col("listed_on").alias("valid_from"), "valid_to")


def _month(date: Column) -> Column:
    return F.year(date) * 12 + F.month(date)


def judge(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """Every capture (page_id, url, fetched_on) with blocked, rule, listed_on and n_rules.

    ``rule`` is the longest pattern active at the fetch date, ``listed_on`` the start of its interval and
    ``n_rules`` the number of active patterns. A capture without URL, host or date is not blocked.
    Repeated captures keep a row each; other columns of the inputs are ignored.
    """
    captures = captures.select("page_id", "url", "fetched_on")
    span = captures.agg(F.min("fetched_on").alias("first"), F.max("fetched_on").alias("last")).first()
    last = F.lit(span["last"]).cast("date")
    until = F.least(F.coalesce(F.date_sub("valid_to", 1), last), last)
    since = F.greatest("valid_from", F.lit(span["first"]).cast("date"))
    months = F.when(since <= until, F.sequence(_month(since), _month(until)))
    intervals = materialize(validity(entries).withColumn("month", F.explode(months)), "intervals")
    distinct = captures.filter("fetched_on IS NOT NULL AND url IS NOT NULL").distinct()
    asked = distinct.withColumn("month", _month(F.col("fetched_on"))).withColumn("pattern", F.explode(patterns(F.col("url"))))
    active = asked.join(intervals, ["pattern", "month"]).filter(
        "valid_from <= fetched_on AND (valid_to IS NULL OR fetched_on < valid_to)"
    )
    longest = F.max(F.struct(F.length("pattern").alias("n"), "pattern", "valid_from"))
    found = active.groupBy("page_id", "url", "fetched_on").agg(longest.alias("best"), F.count(F.lit(1)).alias("n_rules"))
    found = found.withColumnsRenamed({c: f"_{c}" for c in ("page_id", "url", "fetched_on")})
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("page_id", "url", "fetched_on")]
    return captures.join(found, same, "left").select(
        "page_id",
        "url",
        "fetched_on",
        F.col("best").isNotNull().alias("blocked"),
        F.col("best.pattern").alias("rule"),
        F.col("best.valid_from").alias("listed_on"),
        F.coalesce("n_rules", F.lit(0)).alias("n_rules"),
    )
