"""Conversations from messages that quote each other.

Lines that start with ``>`` are quotes, as deep as they have marks. A passage is a run of lines of one
level, blank ones left out. Every quoted passage, normalised and hashed, is looked up among the passages
its conversation's members wrote themselves, as of the moment of the reply: its latest earlier author. The
lines of passages that nobody wrote as a whole are looked up one by one. What many messages have, as
greetings and signatures, tells little, so a vote counts the less the more messages have it. A message
replies to the one most of its shallowest matched quotes come from; following replies to their start by
pointer doubling gives the threads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from rentpulse.sources.scratch import materialize

_MARKS = r"^(?:>[ \t]?)+"
# Of a line that one message has; a line that n have weighs the n-th part of the n-th part, 1 at least.
WEIGHT = 1 << 20


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\r?\n")


def body(text: Column) -> Column:
    """The text without quoted lines and outer line ends; empty for NULL."""
    own = F.filter(_lines(text), lambda line: ~line.startswith(">"))
    return F.trim(F.array_join(own, "\n"), F.lit("\n"))


def level(line: Column) -> Column:
    """How many quote marks a line starts with."""
    return F.length(F.regexp_replace(F.regexp_extract(line, _MARKS, 0), r"[ \t]", ""))


def digest(line: Column) -> Column:
    """Hash of a line without marks, case and extra white space; NULL for a blank line."""
    plain = F.lower(F.trim(F.regexp_replace(F.regexp_replace(line, _MARKS, ""), r"\s+", " ")))
    return F.when(plain != "", F.xxhash64(plain))


def quote(text: Column) -> Column:
    """The text as a reply shows it: every line one level deeper."""
    return F.array_join(F.transform(_lines(text), lambda line: F.concat(F.lit("> "), line)), "\n")


def passages(messages: DataFrame) -> DataFrame:
    """conv_id, turn, level, digest, lines (their hashes, in order) and n of the passages of each message."""
    pairs = F.transform(_lines(F.col("text")), lambda line: F.struct(level(line).alias("level"), digest(line).alias("digest")))
    pairs = F.filter(pairs, lambda pair: pair["digest"].isNotNull())
    known = messages.filter("conv_id IS NOT NULL AND turn IS NOT NULL")
    # Exploded, the array is computed once and not again for every passage.
    known = known.select("conv_id", "turn", F.explode(F.array(pairs)).alias("pairs")).filter(F.size("pairs") > 0)
    at = F.sequence(F.lit(1), F.size("pairs"))
    depth = lambda i: F.get(F.col("pairs"), i - 1)["level"]
    first = F.filter(at, lambda i: ~depth(i).eqNullSafe(depth(i - 1)))
    last = F.filter(at, lambda i: ~depth(i).eqNullSafe(depth(i + 1)))
    run = lambda a, b: F.struct(depth(a).alias("level"), F.slice("pairs", a, b - a + 1)["digest"].alias("lines"))
    runs = known.select("conv_id", "turn", F.explode(F.zip_with(first, last, run)).alias("run")).select("conv_id", "turn", "run.*")
    runs = runs.withColumn("digest", F.xxhash64("lines"))
    return runs.groupBy("conv_id", "turn", "level", "digest").agg(F.first("lines").alias("lines"), F.count(F.lit(1)).alias("n"))


def with_source(parts: DataFrame) -> DataFrame:
    """Adds source, the latest earlier turn that has the part as its own, and how many earlier ones have."""
    author = F.when(F.col("level") == 0, F.col("turn"))
    earlier = W.partitionBy("conv_id", "digest").orderBy("turn").rangeBetween(W.unboundedPreceding, -1)
    return parts.withColumns({"source": F.max(author).over(earlier), "authors": F.count(author).over(earlier)})


def replies(messages: DataFrame) -> DataFrame:
    """conv_id, turn, reply_to, n_quotes and n_found of every message with a quoted line that is found.

    Takes conv_id, turn and text. A quoted passage belongs to the latest earlier message of the conversation
    that has it as a passage of its own, each line of any other to the latest that has the line as its own.
    Among the found quotes of the least depth, the message with the most lines is replied to, a line that
    several earlier messages have weighing less, and the later message of equals.
    """
    whole = materialize(with_source(passages(messages)), "passages")
    single = whole.filter("level = 0 OR source IS NULL").select("conv_id", "turn", "level", F.explode("lines").alias("digest"), "n")
    single = with_source(single.groupBy("conv_id", "turn", "level", "digest").agg(F.sum("n").alias("n")))
    columns = ["conv_id", "turn", "level", "source", "authors", "n"]
    found = whole.filter("level > 0 AND source IS NOT NULL").withColumn("n", F.col("n") * F.size("lines"))
    found = found.select(*columns).unionByName(single.filter("level > 0").select(*columns))
    weight = F.greatest(F.lit(1), F.expr(f"bigint({WEIGHT}) div greatest(1, authors * authors)"))
    votes = found.groupBy("conv_id", "turn", "level", "source").agg(F.sum(F.col("n") * weight).alias("weight"), F.sum("n").alias("n"))
    best = F.max(F.when(F.col("source").isNotNull(), F.struct((-F.col("level")).alias("l"), "weight", "source")))
    chosen = votes.groupBy("conv_id", "turn").agg(
        best.alias("best"), F.sum("n").alias("n_quotes"), F.sum(F.when(F.col("source").isNotNull(), F.col("n"))).alias("n_found")
    )
    return chosen.filter("best IS NOT NULL").select("conv_id", "turn", F.col("best.source").alias("reply_to"), "n_quotes", "n_found")


def threads(links: DataFrame) -> DataFrame:
    """conv_id, turn, root_turn and depth of every reply (conv_id, turn, reply_to).

    Each round doubles the distance that every reply looks back, and is a written table.
    """
    now = materialize(links.select("conv_id", "turn", F.col("reply_to").alias("top"), F.lit(1).cast("bigint").alias("depth")), "threads")
    reached = None
    while (total := now.agg(F.sum("depth")).first()[0]) != reached:
        reached = total
        above = now.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), F.col("top").alias("up"), F.col("depth").alias("more"))
        met = now.join(above, (F.col("conv_id") == F.col("c")) & (F.col("top") == F.col("t")), "left")
        now = met.select("conv_id", "turn", F.coalesce("up", "top").alias("top"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"))
        now = materialize(now, "threads")
    return now.withColumnRenamed("top", "root_turn")


def conversations(messages: DataFrame) -> DataFrame:
    """Every message (conv_id, turn, role, text) with its place among the replies, without quotes.

    Returns conv_id, turn, role, body, reply_to, root_turn, depth and position. A message that quotes
    nothing known starts a thread (reply_to NULL, depth 0). ``position`` numbers a thread's messages from
    1, replies after what they reply to. NULL texts are empty; messages without conv_id or turn are
    threads of their own, position NULL. Rows with the same conv_id and turn share the reply that their
    quotes together point to.
    """
    links = materialize(replies(messages), "replies")
    placed = threads(links).join(links.select("conv_id", "turn", "reply_to"), ["conv_id", "turn"])
    met = messages.select("conv_id", "turn", "role", body(F.col("text")).alias("body")).join(placed, ["conv_id", "turn"], "left")
    met = met.withColumns({"root_turn": F.coalesce("root_turn", "turn"), "depth": F.coalesce("depth", F.lit(0))})
    order = W.partitionBy("conv_id", "root_turn").orderBy("turn", "role", "body")
    known = F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
    position = F.when(known, F.row_number().over(order))
    return met.select("conv_id", "turn", "role", "body", "reply_to", "root_turn", "depth", position.alias("position"))
