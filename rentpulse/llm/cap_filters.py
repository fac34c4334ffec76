"""Near-duplicate embeddings by spherical-cap filters.

A filter is a direction, and a vector belongs to all filters whose inner product with it reaches the
vector's bar: its own so many-th largest (a common bar leaves some vectors without a filter, and a third
of the pairs at cosine 0.9 unmet), and that number grows with the number of filters, so that the chance
of meeting does not fall as the table grows. Directions are the words of random product codes: after a random
rotation the coordinates fall into PARTS sub-blocks, and every choice of one short code word per
sub-block is a direction. So the filters of a vector are list-decoded sub-block by sub-block from the
best words of each, without ever looking at all directions. Vectors of a pair meet in the filters they
share and are verified by their exact cosine; a pair is counted in the smallest filter it shares, so
no pair is ever listed. Large filters are compared in blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentpulse.llm.blocks import paired_blocks
from rentpulse.llm.components import components
from rentpulse.llm.vectors import directions, matrix, usable
from rentpulse.sources.scratch import materialize

PARTS = 3
CODES = 2
# Filters of a vector in each code of up to LISTS_WORDS words: about one random pair in ten thousand
# with a cosine of just 0.9 shares none, and none was seen to at 0.95. More words cut the sphere finer,
# and coarser the fewer coordinates it has: to keep that chance the filters of a vector grow with this
# power of the words, measured up to a billion vectors of 16 to 256 coordinates.
LISTS = 16
LISTS_WORDS = 15
LISTS_POWER = 2 / 3  # at LISTS_WIDTH coordinates and more, higher below
LISTS_WIDTH = 64
# Rows per filter direction that a code is sized for.
ROWS_PER_FILTER = 16
WORDS = (12, 800)  # fewest and most code words of a sub-block
BLOCK_ROWS = 1500
SEED = 73


class ProductCode:
    """Filter directions for vectors of one length."""

    def __init__(self, width: int, words: int, number: int):
        rng = np.random.default_rng([SEED, width, words, number])
        self.words = words
        self.rotation = np.linalg.qr(rng.standard_normal((width, width)))[0]
        self.parts = [p for p in np.array_split(np.arange(width), min(PARTS, width)) if len(p)]
        self.books = []
        for part in self.parts:
            book = rng.standard_normal((words, len(part)))
            self.books.append(book / np.linalg.norm(book, axis=1, keepdims=True))

    def decode(self, unit_rows: np.ndarray, lists: int = LISTS) -> np.ndarray:
        """The ``lists`` filters with the largest inner products, by row.

        The i-th and the j-th best of two sub-blocks can only be among the best if i * j <= lists.
        """
        turned = unit_rows @ self.rotation
        total = np.zeros((len(unit_rows), 1))
        code = np.zeros((len(unit_rows), 1), np.int64)
        for part, book in zip(self.parts, self.books, strict=True):
            score = turned[:, part] @ book.T
            word = np.argsort(-score, axis=1, kind="stable")[:, :lists]
            score = np.take_along_axis(score, word, axis=1)
            i, j = np.indices((total.shape[1], word.shape[1])).reshape(2, -1)
            fits = (i + 1) * (j + 1) <= lists
            i, j = i[fits], j[fits]
            both = total[:, i] + score[:, j]
            best = np.argsort(-both, axis=1, kind="stable")[:, :lists]
            total = np.take_along_axis(both, best, axis=1)
            code = np.take_along_axis(code[:, i] * self.words + word[:, j], best, axis=1)
        return code


def words_for(count: int) -> int:
    """Code words per sub-block so that there is a filter for every ROWS_PER_FILTER rows or so."""
    return int(min(max(math.ceil((count / ROWS_PER_FILTER) ** (1 / PARTS)), WORDS[0]), WORDS[1]))


def lists_for(words: int, width: int) -> int:
    """Filters of a vector in each code, so that a pair meets as surely among many filters as among few."""
    power = LISTS_POWER * max(1.0, LISTS_WIDTH / width) ** 0.5
    return math.ceil(LISTS * max(1.0, words / LISTS_WORDS) ** power)


def unit_links(rows: np.ndarray, ids: np.ndarray, lists: list[np.ndarray], here: int, across: np.ndarray | None, least: float):
    """(row, links, smallest id of its group) for the rows that have links to be counted in this filter.

    ``across``: the rows' blocks if only pairs of different blocks count.
    """
    near = rows @ rows.T >= least
    near &= ids[:, None] != ids[None, :]
    if across is not None:
        near &= across[:, None] != across[None, :]
    some = np.flatnonzero(near.any(axis=1))
    if not len(some):
        return []
    near = near[np.ix_(some, some)]
    # Pairs that also share a smaller filter are counted there.
    smaller = [lists[i][lists[i] < here] for i in some]
    known, place = np.unique(np.concatenate(smaller), return_inverse=True)
    if len(known):
        member = np.zeros((len(some), len(known)), np.float32)
        member[np.repeat(np.arange(len(some)), [len(s) for s in smaller]), place] = 1
        near &= (member @ member.T) < 0.5
    links = near.sum(axis=1)
    label = ids[some].copy()
    while True:
        low = np.minimum(label, np.where(near, label[None, :], np.iinfo(np.int64).max).min(axis=1))
        if (low == label).all():
            break
        label = low
    return [(int(ids[i]), int(n), int(c)) for i, n, c in zip(some, links, label, strict=True) if n]


def near_duplicates(vectors: DataFrame, least: float = 0.9) -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector (vec_id, embedding).

    Links are pairs of different vec_id with a cosine of ``least`` or more, in double precision. Vectors
    that are NULL, zero, without vec_id or hold a NULL or non-finite component link with nothing, nor do
    vectors of different lengths. Repeated rows are one. An id with several vectors has the links of
    all of them. A NULL vec_id has no component and is kept.
    """
    every = vectors.select("vec_id", F.col("embedding").alias("v")).dropDuplicates(["vec_id", "v"])
    good = materialize(every.filter(usable("v") & F.col("vec_id").isNotNull()).withColumn("width", F.size("v")), "vectors")
    counts = good.groupBy("width").count()
    kind = good.schema["v"].dataType.simpleString()

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for width, part in frame.groupby("width"):
                words = words_for(int(part["count"].iat[0]))
                codes = [ProductCode(width, words, number) for number in range(CODES)]
                most = lists_for(words, width)
                step = max(1, 1000 * LISTS // most)
                for at in range(0, len(part), step):
                    some = part.iloc[at : at + step]
                    rows = directions(matrix(some["v"]))
                    found = [code.decode(rows, most) * CODES + number for number, code in enumerate(codes)]
                    lists = list(np.sort(np.concatenate(found, axis=1), axis=1).astype(np.int32))
                    yield pd.DataFrame({"width": width, "vec_id": some["vec_id"].array, "v": some["v"].array, "lists": lists})

    coded = good.join(counts, "width").mapInPandas(listed, f"width int, vec_id long, v {kind}, lists array<int>")
    coded = materialize(coded, "lists")
    member = coded.select("*", F.explode("lists").alias("filter"))
    member = member.withColumn("key", F.struct("width", "filter"))

    def compare(unit: pd.DataFrame) -> pd.DataFrame:
        across = unit["block"].to_numpy() if unit["lo"].iat[0] != unit["hi"].iat[0] else None
        lists = [np.asarray(x) for x in unit["lists"]]
        rows = directions(matrix(unit["v"]))
        found = unit_links(rows, unit["vec_id"].to_numpy(), lists, int(unit["filter"].iat[0]), across, least)
        return pd.DataFrame(found, columns=["vec_id", "links", "low"]).astype("int64")

    units = paired_blocks(member, "key", "vec_id", BLOCK_ROWS).drop("width")
    found = units.groupBy("key", "lo", "hi").applyInPandas(compare, "vec_id long, links long, low long")
    found = materialize(found, "links")
    degree = found.groupBy("vec_id").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("vec_id").alias("a"), F.col("low").alias("b")))
    met = every.join(degree, "vec_id", "left").join(groups.withColumnRenamed("id", "vec_id"), "vec_id", "left")
    component = F.coalesce("component", "vec_id")
    return met.select(
        "vec_id",
        F.coalesce("links", F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("vec_id")).alias("kept"),
    )
