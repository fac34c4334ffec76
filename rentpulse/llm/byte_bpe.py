"""Byte-level BPE by a given rank file.

A piece's bytes are the leaves of a segment tree. Leaf ``i`` holds the rank of the pair that starts
at part ``i``, and every inner node the smallest key of its children, where the key is the rank
followed by the position: the root is the leftmost pair of minimum rank. A merge clears the leaf of
the part it swallows and updates the leaves of the merged part and its left neighbour, each on one
path to the root. A piece of n bytes takes O(n log n) steps, however long it is.

Short pieces run in lockstep: one row of a matrix is one piece's tree, and a step does the next merge
of every piece that still has one. Long pieces run alone, with the same tree in a list.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Pieces remembered by one Python worker: two generations of this many.
CACHED_PIECES = 150_000
# Longest piece, in bytes, whose tree is a matrix row; matrices have at most this many rows.
ROW_BYTES = 64
ROWS = 4096
# Characters of text split at a time.
TEXT_AT_ONCE = 1 << 20


def load_ranks(path: str) -> bytes:
    """The rank file's content (a line per token: base64 bytes, blank, rank)."""
    with open(path, "rb") as file:
        return file.read()


@lru_cache(maxsize=4)
def parse_ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines()) if token}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one non-empty piece."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    width = 1 << (n - 2).bit_length() if n > 2 else 1
    none = len(ranks) * (n + 1) << 1
    rank_of = ranks.get
    tree = [none] * (2 * width)
    for i in range(n - 1):
        rank = rank_of(piece[i : i + 2])
        if rank is not None:
            tree[width + i] = rank * n + i
    for node in range(width - 1, 0, -1):
        a, b = tree[2 * node], tree[2 * node + 1]
        tree[node] = a if a < b else b
    after = list(range(1, n + 1))  # where the part that starts here ends
    before = list(range(-1, n - 1))  # where the part left of it starts
    while (key := tree[1]) != none:
        i = key % n
        swallowed = after[i]
        end = after[swallowed]
        after[i] = end
        changed = [(i, none), (swallowed, none)]
        if end < n:
            before[end] = i
            rank = rank_of(piece[i : after[end]])
            if rank is not None:
                changed[0] = (i, rank * n + i)
        else:
            changed.pop()  # the last part has no pair and no leaf
        left = before[i]
        if left >= 0:
            rank = rank_of(piece[left:end])
            changed.append((left, none if rank is None else rank * n + left))
        for leaf, value in changed:
            node = width + leaf
            tree[node] = value
            while node > 1:
                other = tree[node ^ 1]
                if other < value:
                    value = other
                node >>= 1
                if tree[node] == value:
                    break
                tree[node] = value
    ids, at = [], 0
    while at < n:
        ids.append(ranks[piece[at : after[at]]])
        at = after[at]
    return ids


class PairRanks:
    """Rank of the token that two adjacent tokens spell, for arrays of token ids."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs = [
            (ranks[token[:cut]] << 32 | ranks[token[cut:]], rank)
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        ]
        pairs.append((1 << 62, -1))
        table = np.array(sorted(pairs), np.int64)
        self.keys, self.ranks = np.ascontiguousarray(table[:, 0]), np.ascontiguousarray(table[:, 1])
        self.of_byte = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """-1 where the two spell no token."""
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at], -1)


def merge_rows(pieces: list[bytes], pairs: PairRanks, width: int) -> list[bytes]:
    """Packed token ids of pieces of 2 to ``width`` bytes (a power of two), all in lockstep."""
    count = len(pieces)
    size = np.fromiter(map(len, pieces), np.int64, count)
    raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(count, width)
    none = np.int64(1) << 40
    ids = np.zeros((count, width + 1), np.int64)
    ids[:, :width] = pairs.of_byte[raw]
    place = np.arange(width + 1)
    after = np.broadcast_to(place + 1, (count, width + 1)).copy()
    before = np.broadcast_to(place - 1, (count, width + 1)).copy()
    tree = np.full((count, 2 * width), none)
    rank = pairs.find(ids[:, : width - 1], ids[:, 1:width])
    usable = (rank >= 0) & (place[: width - 1] < size[:, None] - 1)
    tree[:, width : 2 * width - 1] = np.where(usable, rank * width + place[: width - 1], none)
    node = width >> 1
    while node:
        tree[:, node : 2 * node] = np.minimum(tree[:, 2 * node : 4 * node : 2], tree[:, 2 * node + 1 : 4 * node : 2])
        node >>= 1
    live = np.arange(count)
    while len(live := live[tree[live, 1] < none]):
        rank, at = np.divmod(tree[live, 1], width)
        gone = after[live, at]
        end = after[live, gone]
        left = before[live, at]
        after[live, at] = end
        before[live, np.minimum(end, width)] = at
        ids[live, at] = rank
        right = pairs.find(rank, ids[live, np.minimum(end, width)])
        left_rank = pairs.find(ids[live, left], rank)
        tree[live, width + np.minimum(gone, width - 1)] = none
        tree[live, width + at] = np.where((right >= 0) & (end < size[live]), right * width + at, none)
        has_left = left >= 0
        row, leaf = live[has_left], left[has_left]
        tree[row, width + leaf] = np.where(left_rank[has_left] >= 0, left_rank[has_left] * width + leaf, none)
        for row, leaf in ((live, gone), (live, at), (row, leaf)):
            node = (width + leaf) >> 1
            while node.size and node[0]:
                tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])
                node = node >> 1
    start = np.zeros((count, width + 1), bool)  # where parts start
    start[:, 0] = True
    at = np.zeros(count, np.int64)
    live = np.arange(count)
    while len(live):
        at = after[live, at]
        going = at < size[live]
        live, at = live[going], at[going]
        start[live, at] = True
    packed = ids[start].astype("<u4").tobytes()
    stop = (np.cumsum(start.sum(1)) * 4).tolist()
    return [packed[a:b] for a, b in zip([0, *stop[:-1]], stop, strict=True)]


class Encoder:
    """Encodes texts; remembers recent pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks = ranks
        self.pairs = PairRanks(ranks)
        self.split = regex.compile(pattern).findall
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _learn(self, pieces: set[str]) -> dict[str, bytes]:
        """Ids of pieces that are not remembered; all are remembered but the long ones."""
        found: dict[str, bytes] = {}
        rows: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces:
            if (ids := self.old.get(piece)) is not None:
                found[piece] = ids
                continue
            raw = piece.encode("utf-8", "replace")
            whole = self.ranks.get(raw)
            if whole is not None:
                found[piece] = whole.to_bytes(4, "little")
            elif len(raw) <= ROW_BYTES:
                rows.setdefault(max(2, 1 << (len(raw) - 1).bit_length()), []).append((piece, raw))
            else:
                found[piece] = np.array(merge(raw, self.ranks), "<u4").tobytes()
        for width, group in rows.items():
            for at in range(0, len(group), ROWS):
                part = group[at : at + ROWS]
                found.update(zip((p for p, _ in part), merge_rows([raw for _, raw in part], self.pairs, width), strict=True))
        if len(self.young) + len(found) > CACHED_PIECES:
            self.old, self.young = self.young, {}
        self.young.update((piece, ids) for piece, ids in found.items() if len(piece) <= ROW_BYTES)
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of every text; texts are split into pieces a bounded stretch at a time."""
        out: list[bytes] = []
        at = 0
        while at < len(texts):
            end, chars = at, 0
            while end < len(texts) and (end == at or chars + len(texts[end]) <= TEXT_AT_ONCE):
                chars += len(texts[end])
                end += 1
            split = [self.split(text) for text in texts[at:end]]
            young = self.young
            fresh = self._learn({piece for pieces in split for piece in pieces if piece not in young})
            known = young if young is self.young and fresh.keys() <= young.keys() else {**young, **fresh}
            token = known.__getitem__
            out.extend([b"".join(map(token, pieces)) for pieces in split])
            at = end
        return out


@lru_cache(maxsize=2)
def _encoder(content: bytes, pattern: str) -> Encoder:
    return Encoder(parse_ranks(content), pattern)


class Codec(NamedTuple):
    encode: Callable[[Column], Column]
    decode: Callable[[Column], Column]
    round_trip: Callable[[Column], Column]


@lru_cache(maxsize=2)
def _vocabulary(content: bytes) -> dict[int, bytes]:
    return {rank: token for token, rank in parse_ranks(content).items()}


def decode_ids(packed: bytes, vocabulary: dict[int, bytes]) -> bytes:
    return b"".join(map(vocabulary.__getitem__, memoryview(packed).cast("I"))) if packed else b""


def codec(spark: SparkSession, ranks_path: str, pattern: str) -> Codec:
    """Column functions ``encode``, ``decode`` and ``round_trip``.

    ``encode`` turns text into token ids packed as little-endian unsigned 32-bit integers, each match
    of the pattern by itself and special tokens read as plain text; NULL and empty text give no ids.
    ``decode`` turns packed ids into bytes; NULL gives none, an unknown id fails. ``round_trip`` does
    both in one Python process: a struct of ids and the bytes decoded from them.
    The rank file is read once by the driver (it has a fixed size) and sent to the executors.
    """
    content = spark.sparkContext.broadcast(load_ranks(ranks_path))

    @F.pandas_udf("binary")
    def encode(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = _encoder(content.value, pattern)
        for batch in texts:
            yield pd.Series(encoder.encode([text or "" for text in batch]), dtype=object)

    @F.pandas_udf("binary")
    def decode(packed: Iterator[pd.Series]) -> Iterator[pd.Series]:
        vocabulary = _vocabulary(content.value)
        for batch in packed:
            yield pd.Series([decode_ids(ids, vocabulary) for ids in batch], dtype=object)

    @F.pandas_udf("ids binary, bytes binary")
    def round_trip(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder, vocabulary = _encoder(content.value, pattern), _vocabulary(content.value)
        for batch in texts:
            ids = encoder.encode([text or "" for text in batch])
            yield pd.DataFrame({"ids": ids, "bytes": [decode_ids(x, vocabulary) for x in ids]}, dtype=object)

    return Codec(encode, decode, round_trip)


def token_count(packed: Column) -> Column:
    return (F.octet_length(packed) / 4).cast("bigint")
