"""Approximate nearest neighbours in a hash-prefix forest.

Every tree gives a vector a long string of bits, the sides of as many random hyperplanes it lies on,
and keeps the strings in a sorted array: the rows below any prefix are a contiguous run. A query
descends each tree to its longest matching prefix; then all trees ascend together, one bit at a time,
until their runs hold as many different candidates as asked for. The candidates are ranked by the exact
inner product. Sides of hyperplanes tell angles, so rows are hashed with a further coordinate that gives
all of them the same length, and queries with 0 there: then a smaller angle is a larger inner product.
Were lengths very different, that coordinate would outweigh the others, so rows of similar length have a
forest each.

Rows are dealt into blocks with a forest each, so memory is bounded and every row is indexed; a block
answers the queries in bounded groups, and a query's answers from all blocks are merged.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from rentpulse.llm.vectors import matrix, usable
from rentpulse.sources.scratch import materialize

TREES = 128
BITS = 16
# Rows that the runs must hold together before the ascent ends (a row that several trees find counts
# several times): a share of the block, and so many for each neighbour asked for.
REACH = 0.5
SPARE = 20
# As different rows (copies are in the runs of all trees at once) they must hold this share of the block,
# and so many for each neighbour.
DIFFERENT = 0.35
SPARE_DIFFERENT = 5
# Rows of a forest differ in length by this factor at most; the last of the BANDS has all shorter ones.
BAND = 1.15
BANDS = 40
BLOCK_ROWS = 16_384
QUERY_ROWS = 2_048
SEED = 61


class Forest:
    """The sorted bit strings of some vectors."""

    def __init__(self, rows: np.ndarray, trees: int = TREES, bits: int = BITS, seed: int = SEED):
        self.rows, self.bits = rows, bits
        self.planes = np.random.default_rng(seed).standard_normal((trees, rows.shape[1], bits))
        self.orders, self.strings = [], []
        for planes in self.planes:
            strings = self._strings(rows, planes)
            order = np.argsort(strings, kind="stable")
            self.orders.append(order)
            self.strings.append(strings[order])

    def _strings(self, vectors: np.ndarray, planes: np.ndarray) -> np.ndarray:
        sides = vectors @ planes > 0
        return sides @ (1 << np.arange(self.bits - 1, -1, -1, dtype=np.int64))

    def runs(self, queries: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
        """First and last rows of each query's run in each tree (queries x trees)."""
        own = np.stack([self._strings(queries, planes) for planes in self.planes], axis=1)
        low, high = np.zeros_like(own), np.zeros_like(own)
        rising = np.arange(len(queries))
        for cut in range(self.bits + 1):  # bits given up: none at first, all in the end
            lo, hi = np.empty((len(rising), own.shape[1]), np.int64), np.empty((len(rising), own.shape[1]), np.int64)
            for tree, strings in enumerate(self.strings):
                prefix = own[rising, tree] >> cut
                lo[:, tree] = np.searchsorted(strings, prefix << cut)
                hi[:, tree] = np.searchsorted(strings, (prefix + 1) << cut)
            low[rising], high[rising] = lo, hi
            rising = rising[(hi - lo).sum(axis=1) < wanted]
            if not len(rising):
                break
        return low, high

    def candidates(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Places of the rows in one query's runs."""
        found = np.zeros(len(self.rows), bool)
        for order, a, b in zip(self.orders, low, high, strict=True):
            found[order[a:b]] = True
        return np.flatnonzero(found)


def lifted(rows: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and queries with a further coordinate, so that rows order by angle as by inner product."""
    rows = rows / np.abs(rows).max()
    queries = queries / np.abs(queries).max(axis=1, keepdims=True)
    square = (rows * rows).sum(axis=1)
    return np.column_stack([rows, np.sqrt(square.max() - square)]), np.column_stack([queries, np.zeros(len(queries))])


def bands(rows: np.ndarray) -> list[np.ndarray]:
    """Places of the rows of similar length, the longest rows first."""
    length = np.linalg.norm(rows / np.abs(rows).max(), axis=1)
    length = np.maximum(length / length.max(), np.finfo(float).tiny)
    number = np.minimum(np.floor(-np.log(length) / math.log(BAND) + 1e-6), BANDS - 1)
    return [np.flatnonzero(number == n) for n in np.unique(number)]


def band_candidates(rows: np.ndarray, ids: np.ndarray, queries: np.ndarray, own: np.ndarray, k: int, reach: float) -> list[np.ndarray]:
    """Places of the rows that each query is compared with: of at least k ids besides its own, if there are."""
    rows, queries = lifted(rows, queries)
    forest, wanted = Forest(rows), math.ceil(reach * len(rows)) + SPARE * k
    out: list[np.ndarray] = [np.empty(0, np.int64)] * len(queries)
    rising, most = np.arange(len(queries)), len(np.unique(ids))
    enough = math.ceil(min(reach, DIFFERENT) * len(rows)) + SPARE_DIFFERENT * k
    while len(rising):
        low, high = forest.runs(queries[rising], wanted)
        short = np.zeros(len(rising), bool)
        for place, q in enumerate(rising):
            near = forest.candidates(low[place], high[place])
            out[q] = near[ids[near] != own[q]]
            different = len(np.unique(ids[out[q]]))
            short[place] = different < min(most - 1, enough)
        rising, wanted = rising[short], 2 * wanted
    return out


def block_neighbours(rows: np.ndarray, ids: np.ndarray, queries: np.ndarray, own: np.ndarray, k: int, reach: float) -> list[tuple]:
    """(query's place, id, score) of the up to k best candidates of each query; ties to the smaller id."""
    order = np.argsort(ids, kind="stable")
    rows, ids = rows[order], ids[order]
    found = [[band[near] for near in band_candidates(rows[band], ids[band], queries, own, k, reach)] for band in bands(rows)]
    out = []
    for q, query in enumerate(queries):
        near = np.sort(np.concatenate([of_band[q] for of_band in found]))
        rough = rows[near] @ query
        if len(near) > k:
            bar = np.partition(rough, len(near) - k)[len(near) - k]
            near = near[rough >= bar - 1e-9 * max(1.0, abs(bar))]
        exact = (rows[near] * query).sum(axis=1)
        best = np.lexsort((ids[near], -exact))[:k]
        out += [(q, int(ids[i]), float(s)) for i, s in zip(near[best], exact[best], strict=True)]
    return out


def nearest(vectors: DataFrame, is_query, k: int = 20, reach: float = REACH) -> DataFrame:
    """query_id, rank (from 1), vec_id and score: each query's k nearest rows by inner product.

    Takes vec_id, embedding and a condition that marks the queries. A row is no candidate for a query
    with its own vec_id; repeated rows count once. Vectors that are NULL, zero, without vec_id or hold
    a NULL or non-finite component take no part, and vectors meet only those of their length. Fewer than k
    rows are returned only if the trees' whole runs hold fewer.
    """
    good = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("v"), is_query.alias("is_query"))
    good = good.filter(usable("v") & F.col("vec_id").isNotNull()).dropDuplicates(["vec_id", "v"])
    good = materialize(good.withColumn("width", F.size("v")), "vectors")
    sizes = good.groupBy("width").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_query").alias("m")).filter("m > 0")
    sizes = sizes.select(
        "width", F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("blocks"), F.ceil(F.col("m") / QUERY_ROWS).cast("int").alias("groups")
    )
    sizes = materialize(sizes, "widths")
    placed = good.join(sizes, "width").withColumn("h", F.xxhash64("vec_id", F.lit(5)))
    block = F.pmod("h", F.col("blocks").cast("bigint")).cast("int")
    group = F.pmod("h", F.col("groups").cast("bigint")).cast("int")
    rows = placed.select("width", block.alias("block"), F.explode(F.expr("sequence(0, groups - 1)")).alias("part"), "vec_id", "v")
    asked = placed.filter("is_query").select(
        F.col("width").alias("q_width"),
        F.explode(F.expr("sequence(0, blocks - 1)")).alias("q_block"),
        group.alias("q_part"),
        F.col("vec_id").alias("query_id"),
        F.col("v").alias("query"),
    )

    def search(block_rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(block_rows) and len(queries):
            own = queries["query_id"].to_numpy()
            ids = block_rows["vec_id"].to_numpy()
            best = block_neighbours(matrix(block_rows["v"]), ids, matrix(queries["query"]), own, k, reach)
            found = [(own[q], vec_id, score) for q, vec_id, score in best]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    units = rows.groupBy("width", "block", "part").cogroup(asked.groupBy("q_width", "q_block", "q_part"))
    found = units.applyInPandas(search, "query_id long, vec_id long, score double")
    # One id may have several vectors: the best score per pair of ids counts.
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
