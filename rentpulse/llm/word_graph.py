"""Phrase collocations from a weighted de Bruijn graph of words.

A node is three neighbouring words of a piece of text, an edge four: it leads from its first three words
to its last three and weighs as often as they occur. Only these longest grams are counted from text; a
position near the end of its piece gives the shorter gram that is left. All shorter counts follow: a
node occurs as often as its outgoing edges weigh, plus its occurrences at piece ends; two words as often
as the nodes they begin, plus theirs at piece ends; one word likewise.

A phrase holds no word, pair or three neighbours rarer than itself. So words, pairs and threes are
counted by their hashes first, and the graph is built of the frequent ones alone: a gram ends before the
word that would make it hold a rare one, as it does at the end of a piece. Tasks know the frequent ones
by bit maps of fixed size; bits that are set by something else, and equal hashes, let a rare one
through, which costs time and changes no count.

Edges meet at their node's rarest-ranked word, and the neighbouring edges of a text that meet at the
same word are a unary path, sent as one stretch of words with its weight rather than edge by edge. Paths
travel packed, by shares of the meeting places, and the edges of a share are summed where they meet. Words
that are a large share of the corpus rank last, and a node of three such words meets by itself, so a
frequent word or pair does not gather the corpus in one task.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rentpulse.llm.text_hash import mix, prefix_hashes, range_hashes
from rentpulse.sources.scratch import materialize

LONGEST = 4
MIN_COUNT = 30
TOP = 2000
CONTAINED_PERCENT = 80
SCALE = 2_000_000
# A word that is more than this share of all words, or occurs more often than this, ranks last.
HEAVY_SHARE = 1 / 2000
HEAVY_COUNT = 1 << 18
# Size of the bit maps of frequent words, pairs and threes (2 MB each), and of the parts they are built in.
MAP_BITS = 1 << 24
_PART_BITS = 1 << 15
# Bits of a hash that tell pairs, and threes, apart when they are counted.
COUNT_BITS = 40
# Text whose graph a worker builds at once, and distinct paths it holds before it sends them on.
BYTES_AT_ONCE = 1 << 19
PATHS_AT_ONCE = 60_000
# Bytes of paths a worker holds before it packs them, and words of the corpus whose paths are summed together.
PACKED_AT_ONCE = 1 << 24
WORDS_PER_SHARE = 1 << 20

# Marks that end a piece, and the blanks between words.
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz \n\n\n\n\n\n\n\n\n")
_BLANKS = re.compile(b"  +")
_NONE = np.uint64(np.iinfo(np.uint64).max)
_LAST_RANK = np.uint64(1 << 63)


class BitMap:
    """A set of hashes, by the bits they fall on."""

    def __init__(self, content: np.ndarray):
        self.content = content

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        bit = hashes % np.uint64(8 * len(self.content))
        return (self.content[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def bit_map(hashes: DataFrame, bits: int | None = None) -> BitMap:
    """The bit map of the column ``hash``, of a power of two (MAP_BITS) bits; the driver receives that many."""
    bits = bits or MAP_BITS
    size = min(bits, _PART_BITS)

    def filled(frame: pd.DataFrame) -> pd.DataFrame:
        mask = np.zeros(size, bool)
        mask[frame["bit"].to_numpy() % size] = True
        return pd.DataFrame({"part": [frame["bit"].iloc[0] // size], "content": [np.packbits(mask, bitorder="little").tobytes()]})

    found = hashes.select(F.expr(f"hash & {bits - 1}L").alias("bit")).distinct()
    parts = found.groupBy(F.expr(f"bit div {size}")).applyInPandas(filled, "part long, content binary").collect()
    content = np.zeros(bits // 8, np.uint8)
    for r in parts:
        content[r.part * size // 8 : (r.part + 1) * size // 8] = np.frombuffer(r.content, np.uint8)
    return BitMap(content)


class Words:
    """The words of several texts of one language: where they are, their hashes, and how many are left in their piece."""

    def __init__(self, lang: str, texts: list[str]):
        self.data = _BLANKS.sub(b" ", b"\n".join(t.encode("utf-8", "replace") for t in texts).translate(_FOLD))
        raw = np.frombuffer(self.data, np.uint8)
        inside = np.zeros(len(raw) + 2, np.int8)
        inside[1:-1] = (raw != 32) & (raw != 10)
        edge = np.flatnonzero(np.diff(inside))
        self.start, self.end = edge[::2], edge[1::2]
        self.hashes = mix(range_hashes(prefix_hashes(raw), self.start, self.end) + np.uint64(crc32(lang.encode("utf-8", "replace"))))
        piece = np.cumsum(raw == 10)[self.start]
        self.left = self._left(np.diff(piece, append=-1) != 0)

    def _left(self, ends: np.ndarray) -> np.ndarray:
        """The number of words from each one to the end of its stretch, given which ones are the last."""
        last = np.flatnonzero(ends)
        return np.repeat(last, np.diff(last, prepend=-1)) - np.arange(len(ends)) + 1

    def pairs(self) -> np.ndarray:
        """The hash of each word and the next; of no meaning where the piece ends."""
        return mix(self.hashes * np.uint64(0x9E3779B97F4A7C15) + np.roll(self.hashes, -1))

    def threes(self) -> np.ndarray:
        """The hash of each word and the next two; of no meaning where the piece ends."""
        return mix(self.pairs() * np.uint64(0x9E3779B97F4A7C15) + np.roll(self.hashes, -2))

    def prune(self, words: BitMap, pairs: BitMap | None = None) -> None:
        """End the pieces at words and pairs that are not frequent, and forget such words."""
        often = words.holds(self.hashes)
        linked = (self.left > 1) & often & np.roll(often, -1)
        if pairs is not None:
            linked &= pairs.holds(self.pairs())
        left = self._left(~linked)
        self.start, self.end, self.hashes, self.left = (x[often] for x in (self.start, self.end, self.hashes, left))

    def grams(self, threes: BitMap) -> np.ndarray:
        """How many words the gram from each word on has: as many as hold no rare three."""
        often = (self.left > 2) & threes.holds(self.threes())
        size = np.minimum(self.left, LONGEST)
        size[(size > 2) & ~often] = 2
        size[(size > 3) & ~np.roll(often, -1)] = 3
        return size

    def paths(self, heavy: np.ndarray, threes: BitMap) -> Iterator[tuple[int, int, bytes]]:
        """(meeting place, number of edges, stretch of words) of the unary paths; an edge starts at each word."""
        n = len(self.start)
        if not n:
            return
        rank = self.hashes >> np.uint64(1)
        if len(heavy):
            place = np.minimum(np.searchsorted(heavy, self.hashes), len(heavy) - 1)
            rank[heavy[place] == self.hashes] |= _LAST_RANK
        size = self.grams(threes)
        meet, node = rank.copy(), np.zeros(n, np.uint64)
        for k in range(LONGEST - 1):
            there = np.flatnonzero(size > k)
            meet[there] = np.minimum(meet[there], rank[there + k])
            node[there] = mix(node[there] * np.uint64(0x9E3779B97F4A7C15) + self.hashes[there + k])
        meet = np.where(meet >= _LAST_RANK, node, meet) & np.uint64(0x7FFFFFFF)
        upto = np.arange(n) + size
        first = np.ones(n, bool)
        # The grams of a path have LONGEST words or end with it.
        first[1:] = (meet[1:] != meet[:-1]) | ((size[:-1] < LONGEST) & (upto[1:] != upto[:-1]))
        begin = np.flatnonzero(first)
        edges = np.diff(begin, append=n)
        stop = self.end[upto[begin + edges - 1] - 1]
        rows = zip(meet[begin].tolist(), edges.tolist(), self.start[begin].tolist(), stop.tolist(), strict=True)
        for at, number, a, b in rows:
            yield at, number, self.data[a:b]


def _portions(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[str, Words]]:
    """The words of one language's texts, some BYTES_AT_ONCE characters at a time."""
    for batch in batches:
        for lang, texts in batch.groupby("lang", sort=False)["text"]:
            held, size = [], 0
            for text in texts:
                held.append(text)
                size += len(text) + 1
                if size >= BYTES_AT_ONCE:
                    yield lang, Words(lang, held)
                    held, size = [], 0
            if held:
                yield lang, Words(lang, held)


def _word_counts(rows: DataFrame) -> DataFrame:
    """lang, hash and n of the words."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for lang, words in _portions(batches):
            found, n = np.unique(words.hashes, return_counts=True)
            yield pd.DataFrame({"lang": pd.Series([lang] * len(found), dtype=object), "hash": found.view(np.int64), "n": n})

    return rows.mapInPandas(run, "lang string, hash long, n long").groupBy("lang", "hash").agg(F.sum("n").alias("n"))


def _frequent(rows: DataFrame, hashes: Callable[[Words], np.ndarray], min_count: int) -> BitMap:
    """The bit map of what the function finds in the rows' words min_count times or more.

    Counted by the low COUNT_BITS bits of the hashes, which fill fewer bytes. What shares these bits counts
    together, so a count may be too large, never too small.
    """
    mask = np.uint64((1 << COUNT_BITS) - 1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, portion in _portions(batches):
            found, n = np.unique(hashes(portion) & mask, return_counts=True)
            yield pd.DataFrame({"hash": found.view(np.int64), "n": n})

    counts = rows.mapInPandas(run, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))
    return bit_map(counts.filter(F.col("n") >= min_count))


def weighted_paths(rows: DataFrame, words: BitMap, pairs: BitMap, threes: BitMap, heavy: np.ndarray, shares: int = 1) -> DataFrame:
    """lang, share and paths: the unary paths, dealt to shares by where their edges meet, packed.

    ``paths`` is deflated and has two lists of lines: paths (words, tab, number of edges) that occur once in
    what was packed, then, behind an empty line, others with a further tab and their weight.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Paths of a word or two recur most: they are held apart, and longer.
        short: Counter[tuple[str, int, int, bytes]] = Counter()
        held: Counter[tuple[str, int, int, bytes]] = Counter()
        lists: defaultdict[tuple[str, int], tuple[list[bytes], list[bytes]]] = defaultdict(lambda: ([], []))
        size = 0
        for lang, found in _portions(batches):
            found.prune(words, pairs)
            for path in found.paths(heavy, threes):
                (held if path[2].count(b" ") > 1 else short)[(lang, *path)] += 1
            for counts, limit in ((held, PATHS_AT_ONCE), (short, 2 * PATHS_AT_ONCE)):
                if len(counts) >= limit:
                    size += listed(counts, lists)
                    counts.clear()
            if size >= PACKED_AT_ONCE:
                yield packed(lists)
                lists.clear()
                size = 0
        listed(held, lists)
        listed(short, lists)
        yield packed(lists)

    def listed(counts: Counter, lists: defaultdict) -> int:
        fresh: defaultdict[tuple[str, int], tuple[list[bytes], list[bytes]]] = defaultdict(lambda: ([], []))
        for (lang, meet, edges, path), weight in counts.items():
            once, often = fresh[lang, meet % shares]
            if weight == 1:
                once.append(b"%b\t%d" % (path, edges))
            else:
                often.append(b"%b\t%d\t%d" % (path, edges, weight))
        size = 0
        for key, both in fresh.items():
            for lines, into in zip(both, lists[key], strict=True):
                if lines:
                    into.append(b"\n".join(lines))  # one value takes less than its lines
                    size += len(into[-1])
        return size

    def packed(lists: defaultdict) -> pd.DataFrame:
        out = []
        for (lang, share), both in lists.items():
            # Neighbours in order begin alike and deflate to less.
            once, often = (b"\n".join(sorted(b"\n".join(lines).split(b"\n"))) for lines in both)
            out.append((lang, share, zlib.compress(once + b"\n\n" + often, 1)))
        return pd.DataFrame(out, columns=["lang", "share", "paths"]).astype({"lang": object, "share": "int32", "paths": object})

    return rows.mapInPandas(run, "lang string, share int, paths binary")


def node_counts(paths: DataFrame, min_count: int) -> DataFrame:
    """lang, level, phrase and f of the nodes and shorter grams, and of the edges that weigh min_count or more.

    All edges of a node meet in one share; a share has the paths that start at some WORDS_PER_SHARE words on average.
    """

    def summed(frame: pd.DataFrame) -> pd.DataFrame:
        weights: Counter[bytes] = Counter()
        for content in frame["paths"]:
            once, often = zlib.decompress(content).split(b"\n\n")
            weights.update(once.split(b"\n") if once else ())
            for line in often.split(b"\n") if often else ():
                path, weight = line.rsplit(b"\t", 1)
                weights[path] += int(weight)
        edges: defaultdict[bytes, int] = defaultdict(int)
        nodes: defaultdict[bytes, int] = defaultdict(int)
        for line, weight in weights.items():
            path, number = line.split(b"\t")
            words = path.split(b" ")
            for at in range(int(number)):
                gram = words[at : at + LONGEST]
                if len(gram) == LONGEST:
                    edges[b" ".join(gram)] += weight
                nodes[b" ".join(gram[: LONGEST - 1])] += weight
        kept = [*nodes.items(), *((phrase, f) for phrase, f in edges.items() if f >= min_count)]
        phrases = pd.Series([phrase.decode("utf-8", "replace") for phrase, _ in kept], dtype=object)
        levels = np.array([phrase.count(b" ") + 1 for phrase, _ in kept], np.int32)
        return pd.DataFrame({"lang": frame["lang"].iloc[0], "level": levels, "phrase": phrases, "f": np.array([f for _, f in kept], np.int64)})

    return paths.groupBy("lang", "share").applyInPandas(summed, "lang string, level int, phrase string, f long")


def _summed(rows: DataFrame, keys: list[str], records: str) -> DataFrame:
    """Sums of f by keys, level and phrase over the records (level, phrase, f) that each row becomes."""
    split = rows.select(*keys, F.explode(F.array_compact(F.expr(f"array({records})"))).alias("r")).select(*keys, "r.*")
    return split.groupBy(*keys, "level", "phrase").agg(F.sum("f").alias("f"))


def phrase_counts(docs: DataFrame, min_count: int = MIN_COUNT) -> tuple[DataFrame, DataFrame]:
    """The phrases that occur min_count times or more, and the number of words per language.

    Phrases (lang, level, phrase, f) are of up to LONGEST words (level) within pieces of the text; see the
    module for how their counts f arise. The other table has lang and n.
    """
    lang = F.coalesce(F.col("lang"), F.lit("und")).alias("lang")
    rows = docs.select(lang, "text").filter("text IS NOT NULL")
    found = materialize(_word_counts(rows), "words")
    totals = materialize(found.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    words = bit_map(found.filter(F.col("n") >= min_count))
    share = totals.agg(F.least(F.sum("n") * HEAVY_SHARE, F.lit(float(HEAVY_COUNT))).alias("least"))
    heavy = [r.hash for r in found.join(share, F.col("n") > F.col("least")).select("hash").collect()]  # under 1 / HEAVY_SHARE rows, or a word in HEAVY_COUNT
    heavy = np.sort(np.array(heavy, np.int64).view(np.uint64))

    def two(portion: Words) -> np.ndarray:
        portion.prune(words)
        return portion.pairs()[portion.left > 1]

    def three(portion: Words) -> np.ndarray:
        portion.prune(words, pairs)
        return portion.threes()[portion.left > 2]

    pairs = _frequent(rows, two, min_count)
    threes = _frequent(rows, three, min_count)
    corpus = totals.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
    shares = 1 << (int(corpus) // WORDS_PER_SHARE).bit_length()
    # An edge adds its weight to its node; a shorter gram is a node, or less, as it is.
    nodes = node_counts(weighted_paths(rows, words, pairs, threes, heavy, shares), min_count)
    own = f"if(level > 1 AND f < {min_count}, NULL, struct(level, phrase, f))"
    begun = "struct(least(level, {0}) AS level, substring_index(phrase, ' ', {0}) AS phrase, f)"
    doubles = _summed(nodes, ["lang"], f"if(level < 4, {begun.format(2)}, NULL), if(level > 2, {own}, NULL)")
    singles = _summed(doubles, ["lang"], f"if(level < 3, {begun.format(1)}, NULL), if(level > 1, {own}, NULL)")
    return materialize(singles.filter(F.col("f") >= min_count), "phrases"), totals


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP) -> DataFrame:
    """The best phrases per language: lang, rank, phrase, a, l, r, n, score.

    ``docs`` has text and lang (NULL: ``und``); other columns do not matter, NULL and empty texts have no
    words, and repeated rows count as often as they are there. n is the number of words of the language, a
    how often the phrase occurs, l and r how often the parts of its lowest-scoring cut do (a tie goes to
    the earlier cut), and score = floor(2,000,000 a / (l + r)). A phrase that some longer phrase contains
    in at least CONTAINED_PERCENT of its occurrences is left out. Ties go to the larger a, then to the
    phrase that is first in byte order. An empty table has no phrases.
    """
    often, total = phrase_counts(docs, min_count)
    found = often.filter("level > 1").select("lang", "level", "phrase", F.col("f").alias("a"))

    def part(name: str, f: str) -> DataFrame:
        return often.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))

    cut = F.explode(F.expr("sequence(1, level - 1)")).alias("k")
    cuts = found.select("*", cut).withColumns({"first": F.expr("substring_index(phrase, ' ', k)"), "rest": F.expr("substring_index(phrase, ' ', k - level)")})
    met = cuts.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"])
    score = F.expr(f"CAST(a AS decimal(20, 0)) * {SCALE} div (CAST(l AS decimal(20, 0)) + r)").alias("score")
    worst = met.groupBy("lang", "level", "phrase", "a").agg(F.min(F.struct(score, "k", "l", "r")).alias("worst"))

    longer = found.filter("level > 2").select("lang", F.col("a").alias("whole"), F.expr("level - 1").alias("level"), "phrase")
    ends = F.explode(F.array(F.expr("substring_index(phrase, ' ', level)"), F.expr("substring_index(phrase, ' ', -level)")))
    holder = longer.select("lang", "whole", ends.alias("phrase")).groupBy("lang", "phrase").agg(F.max("whole").alias("whole"))
    kept = worst.join(holder, ["lang", "phrase"], "left").filter(
        f"whole IS NULL OR CAST(whole AS decimal(20, 0)) * 100 < CAST(a AS decimal(20, 0)) * {CONTAINED_PERCENT}"
    )
    order = Window.partitionBy("lang").orderBy(F.desc("worst.score"), F.desc("a"), "phrase")
    best = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return best.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "worst.l", "worst.r", "n", "worst.score")
