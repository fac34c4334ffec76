"""Connected components of a graph that may not fit one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentpulse.sources.scratch import discard, materialize


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id of the edges (a, b); the component is its smallest id.

    Alternating large and small stars: every node links its larger neighbours, then its smaller ones,
    to the smallest node it knows. Both are a grouped minimum (combined before the shuffle) and a join
    of the edges with it, so a hub is never gathered in one task. Each round is a written table, which
    goes once the next is written. Loops and repeated edges change nothing, edges with a NULL end are ignored.
    """
    edges = (
        edges.filter("a IS NOT NULL AND b IS NOT NULL AND a != b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    edges = materialize(edges, "edges")
    seen = None
    while (now := _signature(edges)) != seen:
        seen = now
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = materialize(large, "edges")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        past, edges = edges, materialize(small.unionByName(low.withColumnRenamed("m", "b")).distinct(), "edges")
        discard(past, large)
    roots = edges.select(F.col("b").alias("id")).distinct().withColumn("component", F.col("id"))
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.expr("sum(cast(xxhash64(a, b) AS decimal(20)))")).first()
    return tuple(row)
