"""Near-duplicate documents by SetSketch registers.

A document is the set of its word shingles. Register i holds how small the smallest of its elements'
exponential variates is, on a scale of powers of BASE, cut at the ends: registers of a union are the
larger registers of both sets, and two sets agree in a register with a probability that grows with
their similarity. Bands of registers bring likely pairs together, the likelihood of (larger, smaller,
equal) registers estimates their similarity jointly with the known sizes, and pairs that may reach
the threshold are confirmed on the full sets.

Equal sets are one node, so copies cost nothing beyond their first. Documents first meet the smallest
document of the band they share most often; once components are known, only pairs across components
are looked at, best estimates first. A large band group is compared in blocks. First each node gives its
single best partner; what is likely then, across components still apart, is confirmed inside the blocks,
and a block gives the links that hold it together. Pairs are never listed.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentpulse.llm.blocks import map_units, neighbours_at, paired_blocks
from rentpulse.llm.components import components
from rentpulse.llm.text_hash import mix, prefix_hashes, range_hashes
from rentpulse.sources.scratch import discard, materialize

SHINGLE_WORDS = 5
PERCENT = 80
BANDS = 32
BAND_ROWS = 5  # a pair at similarity 0.8 misses all bands with probability 3e-6
REGISTERS = BANDS * BAND_ROWS
BASE = 1.01
LAST = 4095
# Pairs are confirmed if the estimate is at most so many standard errors below the threshold.
SLACK = 4.5
BLOCK_ROWS = 1500
_PAIRS_AT_ONCE = 100_000  # pairs held before only the best are kept
_UNIT = ["key", "lo", "hi"]
_CHUNK = 4096  # set elements hashed at a time

_rng = np.random.default_rng(43)
_MULTIPLY = _rng.integers(0, 1 << 63, (REGISTERS, 1), dtype=np.uint64) << np.uint64(1) | np.uint64(1)
_ADD = _rng.integers(0, 1 << 64, (REGISTERS, 1), dtype=np.uint64)
_WHITE = np.isin(np.arange(256), np.frombuffer(b" \t\n\x0b\x0c\r", np.uint8))


def shingle_set(text: str | None, words: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted hashes of the distinct shingles; A-Z count as a-z.

    A text with fewer words has its whole sequence as the one shingle, a text without words none.
    """
    raw = (text or "").encode("utf-8", "replace").lower()  # of bytes: A-Z alone
    data = np.frombuffer(raw, np.uint8)
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_WHITE[data]
    edge = np.flatnonzero(np.diff(inside))
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.empty(0, np.uint64)
    word = range_hashes(prefix_hashes(data), start, end)
    span = min(words, len(word))
    out = np.full(len(word) - span + 1, span, np.uint64)
    for k in range(span):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + word[k : len(word) - span + 1 + k])
    return np.unique(out)


def registers(elements: np.ndarray) -> np.ndarray:
    """SetSketch registers of a non-empty set of hashes."""
    low = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(elements), _CHUNK):
        drawn = elements[None, at : at + _CHUNK] * _MULTIPLY
        drawn += _ADD
        np.minimum(low, drawn.min(axis=1), out=low)
    uniform = (low.astype(np.float64) + 0.5) / 2.0**64
    value = np.floor(1 - np.log(-np.log1p(-uniform)) / math.log(BASE))
    return np.clip(value, 0, LAST).astype(np.uint16)


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union."""
    return np.maximum(a, b)


_GRID = np.linspace(0.0, 1.0, 101)


def estimate(above: np.ndarray, below: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Most likely similarity, given in how many registers a set's value is above or below the other's."""
    u = (n_a / (n_a + n_b))[:, None]
    v = 1 - u
    top = np.minimum(u / v, v / u)  # the sizes allow no more
    j = _GRID[None, :] * top
    chance = lambda x: -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / math.log(BASE)
    more, less = chance(u - v * j), chance(v - u * j)
    equal = np.maximum(1 - more - less, 1e-12)
    ties = (REGISTERS - above - below)[:, None]
    ll = above[:, None] * np.log(more + 1e-12) + below[:, None] * np.log(less + 1e-12) + ties * np.log(equal)
    best = np.argmax(ll, axis=1)
    return np.take_along_axis(j, best[:, None], 1)[:, 0]


def lowest_estimate(percent: int) -> float:
    t = percent / 100
    return t - SLACK * math.sqrt(t * (1 - t) / REGISTERS)


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, set_hash and registers (NULL for the empty set) of every document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                found = shingle_set(text, words)
                if len(found):
                    rows.append((len(found), hashlib.blake2b(found.tobytes(), digest_size=16).digest(), registers(found).tobytes()))
                else:
                    rows.append((0, None, None))
            out = pd.DataFrame(rows, columns=["n_shingles", "set_hash", "regs"])
            out.insert(0, "doc_id", batch["doc_id"].array)
            yield out

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, n_shingles long, set_hash binary, regs binary")


def _bands(nodes: DataFrame) -> DataFrame:
    """band, key, id and n per node and band."""
    width = BAND_ROWS * 2
    key = F.expr(f"transform(sequence(0, {BANDS - 1}), i -> xxhash64(i, substring(regs, i * {width} + 1, {width})))")
    return nodes.select("id", "n", F.posexplode(key).alias("band", "key"))


def _sized(a: str, b: str, percent: int) -> str:
    return f"100 * least({a}, {b}) >= {percent} * greatest({a}, {b})"


def _first_partners(bands: DataFrame, percent: int) -> DataFrame:
    """(a, b): every node with that smallest node of its bands that it shares most bands with."""
    low = bands.groupBy("key").agg(F.min(F.struct("id", "n")).alias("low"), F.count(F.lit(1)).alias("size"))
    met = bands.join(low.filter("size > 1").drop("size"), "key").filter("id != low.id").filter(_sized("n", "low.n", percent))
    shared = met.groupBy("id", F.col("low.id").alias("b")).agg(F.count(F.lit(1)).alias("times"))
    best = shared.groupBy("id").agg(F.max(F.struct("times", (-F.col("b")).alias("other"))).alias("best"))
    return best.select(F.col("id").alias("a"), (-F.col("best.other")).alias("b"))


def _likely(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose estimate may reach the threshold."""

    @F.pandas_udf("double")
    def joint(x: pd.Series, y: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype=float)
        a = np.frombuffer(b"".join(x), np.uint16).reshape(-1, REGISTERS)
        b = np.frombuffer(b"".join(y), np.uint16).reshape(-1, REGISTERS)
        return pd.Series(estimate((a > b).sum(1), (a < b).sum(1), n.to_numpy(float), m.to_numpy(float)))

    one = nodes.select(F.col("id").alias("a"), F.col("regs").alias("ra"), F.col("n").alias("na"))
    two = nodes.select(F.col("id").alias("b"), F.col("regs").alias("rb"), F.col("n").alias("nb"))
    return pairs.join(one, "a").join(two, "b").filter(joint("ra", "rb", "na", "nb") >= lowest_estimate(percent)).select("a", "b")


def _units(bands: DataFrame, nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """The band groups whose nodes are in different components, in units: key, lo, hi, band, block, id, component, n, regs."""
    placed = bands.join(labels, "id", "left").select("band", "key", "id", F.coalesce("component", "id").alias("component"))
    apart = placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x != y").select("key")
    rows = placed.join(apart, "key").join(nodes.select("id", "n", "regs"), "id")
    return paired_blocks(rows, "key", "id", BLOCK_ROWS).select(*_UNIT, "band", "block", "id", "component", "n", "regs")


class _Unit:
    """The rows of a few whole units, and which pairs of them may reach the threshold across components."""

    def __init__(self, frame: pd.DataFrame, percent: int):
        self.ids, self.own = frame["id"].to_numpy(), frame["component"].to_numpy()
        self.sizes = frame["n"].to_numpy(float)
        self.block, self.whole = frame["block"].to_numpy(), (frame["lo"] == frame["hi"]).to_numpy()
        self.band = frame["band"].to_numpy() if "band" in frame else None
        self.regs = np.frombuffer(b"".join(frame["regs"]), np.uint16).reshape(len(frame), REGISTERS)
        self.percent, self.least = percent, lowest_estimate(percent)

    def likely(self, number: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Places x and y and the estimate of the likely pairs, some at a time.

        Pairs share a band; in units of bands, a pair counts in the first it shares.
        """
        for x, y in neighbours_at(number):
            apart = (self.own[x] != self.own[y]) & (self.whole[x] | (self.block[x] != self.block[y]))
            small, large = np.minimum(self.sizes[x], self.sizes[y]), np.maximum(self.sizes[x], self.sizes[y])
            apart &= 100 * small >= self.percent * large
            x, y = x[apart], y[apart]
            above, below = (self.regs[x] > self.regs[y]).sum(1), (self.regs[x] < self.regs[y]).sum(1)
            # An estimate is hardly above the share of equal registers.
            close = REGISTERS - above - below >= (self.least - 0.05) * REGISTERS
            x, y, above, below = x[close], y[close], above[close], below[close]
            shared = (self.regs[x] == self.regs[y]).reshape(-1, BANDS, BAND_ROWS).all(axis=2)
            first = shared.any(axis=1) if self.band is None else shared.argmax(axis=1) == self.band[x]
            x, y = x[first], y[first]
            if len(x):
                j = estimate(above[first], below[first], self.sizes[x], self.sizes[y])
                kept = j >= self.least
                if kept.any():
                    yield x[kept], y[kept], j[kept]


def _best_across(units: DataFrame, percent: int) -> DataFrame:
    """(a, b): each node with its likeliest partner from a component with a smaller label than its own.

    If those links hold, a group of any size hangs together after one round.
    """

    def compare(frame: pd.DataFrame, number: np.ndarray) -> pd.DataFrame:
        unit = _Unit(frame, percent)
        found = pd.DataFrame({"a": [], "b": [], "j": []}).astype({"a": "int64", "b": "int64", "j": "float64"})
        held, size = [found], 0

        def best() -> pd.DataFrame:
            return pd.concat(held, ignore_index=True).sort_values(["j", "b"], ascending=[False, True]).drop_duplicates("a")

        for x, y, j in unit.likely(number):
            up = unit.own[x] > unit.own[y]
            held.append(pd.DataFrame({"a": unit.ids[np.where(up, x, y)], "b": unit.ids[np.where(up, y, x)], "j": j}))
            size += len(x)
            if size > _PAIRS_AT_ONCE:
                held, size = [best()], 0
        return best()

    pairs = map_units(units, _UNIT, compare, "a long, b long, j double")
    best = pairs.groupBy("a").agg(F.max(F.struct("j", (-F.col("b")).alias("other"))).alias("best"))
    return best.select("a", (-F.col("best.other")).alias("b"))


class _Forest:
    """Which of some places hang together."""

    def __init__(self, places: int):
        self.root = list(range(places))

    def find(self, k: int) -> int:
        while self.root[k] != k:
            self.root[k] = self.root[self.root[k]]
            k = self.root[k]
        return k

    def join(self, i: int, k: int) -> bool:
        """Whether they were apart."""
        a, b = self.find(i), self.find(k)
        self.root[a] = b
        return a != b


def _rest_across(units: DataFrame, nodes: DataFrame, labels: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) that join what any link across components joins, confirmed on the full sets.

    The likely pairs are found twice and never listed: first a unit gives what holds its likely pairs together,
    fewer edges than it has nodes; then the clusters of these edges are compared in blocks of their own,
    with the sets at hand, so a set is sent once for each block of its cluster rather than for each band.
    Pairs that hang together by links already confirmed need no look.
    """

    def hang_together(frame: pd.DataFrame, number: np.ndarray) -> pd.DataFrame:
        unit, forest, edges = _Unit(frame, percent), _Forest(len(frame)), []
        for x, y, _ in unit.likely(number):
            edges += [(unit.ids[i], unit.ids[k]) for i, k in zip(x.tolist(), y.tolist(), strict=True) if forest.join(i, k)]
        return pd.DataFrame(edges, columns=["a", "b"]).astype("int64")

    def confirm(frame: pd.DataFrame, number: np.ndarray) -> pd.DataFrame:
        unit, sets, forest, links = _Unit(frame, percent), frame["elements"].to_numpy(), _Forest(len(frame)), []
        for x, y, _ in unit.likely(number):
            for i, k in zip(x.tolist(), y.tolist(), strict=True):
                if forest.find(i) == forest.find(k):
                    continue
                both = len(np.intersect1d(sets[i], sets[k], assume_unique=True))
                if 100 * both >= percent * (len(sets[i]) + len(sets[k]) - both):
                    forest.join(i, k)
                    links.append((unit.ids[i], unit.ids[k]))
        return pd.DataFrame(links, columns=["a", "b"]).astype("int64")

    edges = map_units(units, _UNIT, hang_together, "a long, b long")
    clusters = materialize(components(edges).withColumnRenamed("component", "cluster"), "clusters")
    own = clusters.join(nodes, "id").join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    sets = _sets(docs, clusters.select("id"), words)
    blocks = paired_blocks(own.join(sets, "id"), "cluster", "id", BLOCK_ROWS).withColumnRenamed("cluster", "key")
    return map_units(blocks, _UNIT, confirm, "a long, b long", rows_at_once=400)


def _sets(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """The shingle sets (id, elements) of the documents with these ids, as a written table."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingle_set(text, words).view(np.int64) for text in batch["text"]]
            yield pd.DataFrame({"id": batch["id"].array, "elements": pd.Series(sets, dtype=object)})

    texts = docs.select(F.col("doc_id").alias("id"), "text").join(ids, "id")
    return materialize(texts.mapInPandas(run, "id long, elements array<long>"), "sets")


def _confirmed(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs whose full sets reach the threshold."""
    pairs = materialize(pairs, "pairs")
    sets = _sets(docs, pairs.select("a").unionByName(pairs.select(F.col("b").alias("a"))).distinct().toDF("id"), words)
    one = sets.select(F.col("id").alias("a"), F.col("elements").alias("x"))
    two = sets.select(F.col("id").alias("b"), F.col("elements").alias("y"))
    met = pairs.join(one, "a").join(two, "b").select("a", "b", F.size("x").alias("n"), F.size("y").alias("m"), F.size(F.array_intersect("x", "y")).alias("both"))
    return met.filter(100 * F.col("both") >= percent * (F.col("n") + F.col("m") - F.col("both"))).select("a", "b")


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """Components of documents (doc_id, text) linked by a set similarity of ``percent`` or more.

    Returns a row per input row: doc_id, n_shingles, component_id (smallest doc_id reachable by links,
    its own included) and kept (doc_id = component_id). Documents without words link with nothing. Rows
    that share a doc_id are one document that has each of their texts. A NULL doc_id cannot be reached:
    its component_id is NULL and it is kept.
    """
    found = materialize(sketches(docs, words), "sketches")
    solid = found.filter("set_hash IS NOT NULL AND doc_id IS NOT NULL")
    classes = solid.groupBy("set_hash").agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("regs").alias("regs"))
    classes = materialize(classes, "classes")
    nodes = classes.select("id", "n", "regs")
    same = solid.join(classes.select("set_hash", "id"), "set_hash").filter("doc_id != id")
    links = same.select(F.col("doc_id").alias("a"), F.col("id").alias("b"))
    bands = materialize(_bands(nodes), "bands")
    crowded = bands.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1").select("key")
    whole, bands = bands, materialize(bands.join(crowded, "key"), "crowded")
    discard(whole)
    links = links.unionByName(_confirmed(_likely(_first_partners(bands, percent), nodes, percent), docs, words, percent))
    links = materialize(links, "links")
    labels = materialize(components(links), "labels")
    for last in (False, True):
        units = _units(bands, nodes, labels)
        more = _rest_across(units, nodes, labels, docs, words, percent) if last else _confirmed(_best_across(units, percent), docs, words, percent)
        more = materialize(more, "links")
        if not more.isEmpty():
            links = labels.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(more)
            labels = materialize(components(links), "labels")
    met = found.select("doc_id", "n_shingles").join(labels.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return met.select(
        "doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept")
    )
