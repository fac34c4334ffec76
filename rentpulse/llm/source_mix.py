"""Mixing sources to target weights along a low-discrepancy schedule.

Slot ``n`` of the mix has the golden-ratio point ``frac(n * 0.618...)``. The cumulative target
weights cut [0, 1) into one interval per source, and the interval that holds the point owns the
slot. Slots are ranked per source, and rank ``r`` takes the ``r``-th block of equally many tokens
from the source's shuffled token stream, so any stretch of the mix has the target proportions.

Every ranking is done in two steps (per bucket, then over the bounded number of buckets), so a
source with a third of all documents is ranked by many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from rentpulse.llm.common import WORD, whole_text
from rentpulse.sources.scratch import materialize

WEIGHTS = (5, 2, 1)
SHARE = 1.5
PASSES = 2
BLOCK_TOKENS = 256

_GOLDEN = 0.6180339887498949
_CELLS = 4096  # of [0, 1); points meet the intervals of the sources by cell
_CHUNK = 65536  # slots ranked together
_BUCKETS = 4096  # of a source's shuffled documents


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """Targets per source from rows (source, size).

    Sources in code-point order, NULL last, get the weights in turn. A target stops at PASSES times
    the source's size; what it would have had beyond is shared among the others by weight. All rows
    of a source are summed first: the windows below see one row per source.
    Returns source, sid (from 1), weight, source_size, target.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("sid") - 1) % len(weights) + 1).cast("int"))
    ranked = (
        per_source.withColumn("sid", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())))
        .withColumn("weight", weight)
        .withColumn("limit", F.lit(PASSES) * F.col("source_size"))
    )
    fullness = W.orderBy(F.col("limit") / F.col("weight"), "sid")
    before = F.coalesce(F.sum("limit").over(fullness.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("weight").over(fullness.rowsBetween(0, W.unboundedFollowing))
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    filled = (
        ranked.withColumn("place", F.row_number().over(fullness))
        .withColumn("rate", (F.sum("source_size").over(everything) * share - before) / left)
        .withColumn("free", F.col("limit") > F.col("weight") * F.col("rate"))
    )
    first_free = F.min(F.when(F.col("free"), F.struct("place", "rate"))).over(everything)
    capped = F.col("first").isNull() | (F.col("place") < F.col("first.place"))
    return filled.withColumn("first", first_free).select(
        "source",
        "sid",
        "weight",
        "source_size",
        F.when(capped, F.col("limit").cast("double"))
        .otherwise(F.col("weight") * F.col("first.rate"))
        .alias("target"),
    )


def schedule(targets: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """The mix's slots: slot, sid, rank (from 0 within the source).

    A source gets exactly the blocks its target needs: ranks beyond that are dropped, and blocks the
    points did not reach are appended behind the schedule.
    """
    spark = targets.sparkSession
    needed = targets.withColumn("n_blocks", F.ceil(F.round("target") / block_tokens).cast("bigint")).filter("n_blocks > 0")
    total = needed.agg(F.sum("n_blocks")).first()[0] or 0
    order = W.orderBy("sid")
    share = needed.withColumn("hi", F.sum("n_blocks").over(order) / F.lit(float(max(total, 1))))
    share = share.withColumn("lo", F.coalesce(F.lag("hi").over(order), F.lit(0.0)))
    cells = share.select(
        "sid", "lo", "hi", F.explode(F.expr(f"sequence(int(lo * {_CELLS}), int(least(hi * {_CELLS}, {_CELLS - 1})))")).alias("cell")
    )
    points = (
        spark.range(total)
        .withColumn("x", F.col("id") * _GOLDEN)
        .select(F.col("id").alias("slot"), (F.col("x") - F.floor("x")).alias("u"))
        .withColumn("cell", (F.col("u") * _CELLS).cast("int"))
    )
    owned = points.join(cells, "cell").filter("u >= lo AND u < hi").select("sid", "slot", F.expr(f"slot div {_CHUNK}").alias("chunk"))
    in_chunk = F.row_number().over(W.partitionBy("sid", "chunk").orderBy("slot"))
    counts = owned.groupBy("sid", "chunk").agg(F.count(F.lit(1)).alias("n"))
    start = F.coalesce(F.sum("n").over(W.partitionBy("sid").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ranked = owned.withColumn("r", in_chunk).join(counts.withColumn("start", start).drop("n"), ["sid", "chunk"])
    ranked = ranked.select("sid", "slot", (F.col("start") + F.col("r") - 1).alias("rank"))
    on_time = ranked.join(needed.select("sid", "n_blocks"), "sid").filter("rank < n_blocks").drop("n_blocks")
    reached = counts.groupBy("sid").agg(F.sum("n").alias("n"))
    late = (
        needed.select("sid", "n_blocks")
        .join(reached, "sid", "left")
        .filter("coalesce(n, 0) < n_blocks")
        .select("sid", F.explode(F.expr("sequence(coalesce(n, 0), n_blocks - 1)")).alias("rank"))
        .select("sid", (F.lit(total) + F.col("rank")).alias("slot"), "rank")
    )
    return on_time.unionByName(late)


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    block_tokens: int = BLOCK_TOKENS,
    seed: str = "mix",
) -> DataFrame:
    """What the mix takes of every document (columns doc_id, source, text).

    Returns doc_id, size, source_size, target, taken, first_slot and copies. ``size`` counts words (0
    for NULL or empty text, of which nothing is taken), ``taken`` the words the mix takes, repeats
    counted, ``first_slot`` the first slot that reads the document, and ``copies`` how often it
    occurs when only whole documents are kept: a pass counts if the mix takes at least half of it.
    Documents are shuffled by a hash of the seed and their id; equal ids keep one row each, so every
    input row has a row here. NULL sources are a source of their own. The result does not depend on
    partitioning.
    """
    rows = docs.select(
        "doc_id",
        "source",
        F.regexp_count(whole_text(), F.lit(WORD)).cast("bigint").alias("size"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary")).alias("at"),
    )
    rows = materialize(rows, "mix_sizes")
    targets = materialize(source_targets(rows, weights, share), "mix_targets")
    bucket = F.conv(F.substring("at", 1, 3), 16, 10).cast("int")
    placed = rows.join(targets, rows["source"].eqNullSafe(targets["source"])).drop("source", "weight").withColumn("bucket", bucket)
    in_bucket = W.partitionBy("sid", "bucket").orderBy("at", "doc_id", "size").rowsBetween(W.unboundedPreceding, 0)
    sums = placed.groupBy("sid", "bucket").agg(F.sum("size").alias("n"))
    ahead = F.coalesce(F.sum("n").over(W.partitionBy("sid").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = (
        placed.withColumn("upto", F.sum("size").over(in_bucket))
        .join(sums.withColumn("ahead", ahead).drop("n"), ["sid", "bucket"])
        .withColumn("pos", F.col("ahead") + F.col("upto") - F.col("size"))
        .withColumn("quota", F.round("target").cast("bigint"))
        .drop("ahead", "upto", "at", "bucket")
    )
    placed = materialize(placed, "mix_placed")
    key = ["sid", "doc_id", "pos"]
    spans = (
        placed.filter("size > 0")
        .select(*key, "size", "quota", F.explode(F.expr(f"transform(sequence(0, {PASSES - 1}), p -> pos + p * source_size)")).alias("lo"))
        .withColumn("hi", F.least(F.col("lo") + F.col("size"), F.col("quota")))
        .filter("lo < hi")
    )
    pieces = spans.withColumn("rank", F.explode(F.expr(f"sequence(lo div {block_tokens}, (hi - 1) div {block_tokens})")))
    start = F.col("rank") * block_tokens
    words = F.least("hi", start + block_tokens) - F.greatest("lo", start)
    taken = (
        pieces.join(schedule(targets, block_tokens), ["sid", "rank"])
        .select(*key, "lo", "size", "slot", words.alias("words"))
        .groupBy(*key, "lo", "size")
        .agg(F.sum("words").alias("words"), F.min("slot").alias("slot"))
        .groupBy(*key)
        .agg(
            F.sum("words").alias("taken"),
            F.min("slot").alias("first_slot"),
            F.count_if(F.col("words") * 2 >= F.col("size")).alias("copies"),
        )
    )
    taken = taken.withColumnsRenamed({c: f"_{c}" for c in key})
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key]
    met = placed.join(taken, same, "left")
    return met.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        F.coalesce("taken", F.lit(0)).alias("taken"),
        "first_slot",
        F.coalesce("copies", F.lit(0)).alias("copies"),
    )


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The documents as often as the mix keeps them whole (their columns unchanged).

    Documents without a word take no part in the mix; they pass unchanged, once.
    """
    plan = mix(docs, **settings).groupBy("doc_id").agg(F.max("copies").alias("copies"), F.max("size").alias("size"))
    rows = docs.select(F.struct("*").alias("row"))  # so that no name can clash
    times = F.when(F.col("size") == 0, F.lit(1)).otherwise(F.col("copies")).cast("int")
    met = rows.join(plan, F.col("row.doc_id").eqNullSafe(F.col("doc_id")))
    return met.select("row", F.explode(F.array_repeat(F.lit(1), times))).select("row.*")
