"""Periodic runs in word sequences, found online by catchers over completed dyadic blocks.

A square is a stretch that repeats at once: its second half equals its first. On level k the text is cut
into blocks of B = 2**k words. The catcher of a completed block looks for squares of period B to 2B - 1
whose first half covers the block's last word, and every such square has such a block. Each appended
word, on each level, advances the one catcher whose block was completed B to 2B - 1 words ago: if the
word equals the block's last word, their distance is a period to check. The two suffixes, the one that
ends with the block and the one that ends with the new word, are compared backwards, and both places
forwards, as far as text is there. Equal stretches long enough make a square; squares of one period that
overlap are one maximal run, and of the runs over the same words the smallest period stays.

Comparisons start with a hash of the shortest stretch that can matter, which only rules out; what is
reported has been compared word by word. Work is one comparison per word and level, a logarithm of
the longest text, besides what the runs themselves take.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from rentpulse.llm.text_hash import prefix_hashes_of, range_hashes

MIN_LENGTH = 12
# Words whose catchers advance side by side in one worker.
WORDS_AT_ONCE = 400_000

RUN = "struct<start: bigint, length: bigint, period: bigint>"


class SquareCatchers:
    """Runs of a word sequence (as numbers) that grows by ``append``."""

    def __init__(self, min_length: int = MIN_LENGTH, longest_period: int | None = None):
        self.min_length, self.longest_period = min_length, longest_period
        self.text = np.empty(0, np.int64)
        self.hashes = np.zeros(1, np.uint64)
        self.reach = np.empty(0, np.int64)  # where the known run over a word ends,
        self.period = np.empty(0, np.int64)  # and its period
        self.open: dict[int, list[tuple[int, int]]] = {}  # per level, what the end of the text left undecided
        self.seen = 0
        self.runs: dict[tuple[int, int], int] = {}

    def append(self, words: np.ndarray, *, last: bool = False) -> list[tuple[int, int, int]]:
        """Take more words; returns the runs (start, length, period) that are complete by now and were not before.

        A run that reaches the end of the text is complete only if the words are the ``last``.
        """
        self.text = np.concatenate([self.text, words])
        self.hashes = prefix_hashes_of(self.text)
        grown = np.zeros(len(words), np.int64)
        self.reach, self.period = np.concatenate([self.reach, grown]), np.concatenate([self.period, grown])
        found: list[tuple[int, int, int]] = []
        n, level = len(self.text), 0
        while (1 << level) <= min(n // 2, self.longest_period or n):
            found += self._advance(level, last)
            level += 1
        self.seen = n
        return found

    def _advance(self, level: int, last: bool) -> list[tuple[int, int, int]]:
        text, n, size = self.text, len(self.text), 1 << level
        at = np.arange(max(self.seen, 2 * size - 1), n)  # each new word
        end = ((at + 1 >> level) - 1) << level  # the end of the block whose catcher it advances
        hit = np.flatnonzero(text[end - 1] == text[at])
        end, gap = end[hit], at[hit] + 1 - end[hit]
        if waiting := self.open.pop(level, None):
            end, gap = np.concatenate([np.array(waiting).T, [end, gap]], axis=1)
        stretch = (max(size, self.min_length - 2 * size + 1, -(-self.min_length // 2)) + 2) // 2
        back = self._equal(end - stretch, gap, stretch)
        ahead = self._equal(end - 1, gap, stretch)
        short = (end - 1 + gap + stretch > n) & (not last)
        known = (self.reach[end - 1] >= end + gap) & (gap % np.maximum(self.period[end - 1], 1) == 0)
        keep = (back | ahead | short) & ~known
        end, gap = end[keep], gap[keep]
        order = np.lexsort((end, gap))
        found, undecided = [], []
        period, equal_to = 0, 0  # words up to here were compared for this period
        for stop, p in zip(end[order].tolist(), gap[order].tolist(), strict=True):
            if p == period and stop <= equal_to:
                continue
            start = stop - self._common_back(stop, p)
            period, equal_to = p, stop + self._common_ahead(stop, p)
            if equal_to + p == n and not last:
                undecided.append((stop, p))
            elif equal_to - start >= max(p, self.min_length - p):
                span = (start, equal_to + p)
                if span not in self.runs:  # else with a period that divides this one
                    self.runs[span] = p
                    found.append((start, span[1] - start, p))
        if undecided:
            self.open[level] = undecided
        for start, length, p in found:
            further = self.reach[start : start + length] < start + length
            self.reach[start : start + length][further] = start + length
            self.period[start : start + length][further] = p
        return found

    def _equal(self, start: np.ndarray, gap: np.ndarray, length: int) -> np.ndarray:
        """Whether the words from ``start`` and those ``gap`` later hash alike; False where there are none."""
        there = (start >= 0) & (start + gap + length <= len(self.text))
        a = np.where(there, start, 0)
        b = np.where(there, start + gap, 0)
        size = np.where(there, length, 0)
        return there & (range_hashes(self.hashes, a, a + size) == range_hashes(self.hashes, b, b + size))

    def _common_back(self, stop: int, p: int) -> int:
        """How many words before ``stop`` equal those p later."""
        done, step = 0, 16
        while done < stop:
            low = max(0, stop - done - step)
            differ = np.flatnonzero(self.text[low : stop - done] != self.text[low + p : stop - done + p])
            if len(differ):
                return stop - low - int(differ[-1]) - 1
            done, step = stop - low, 2 * step
        return done

    def _common_ahead(self, start: int, p: int) -> int:
        """How many words from ``start`` equal those p later."""
        done, step, room = 0, 16, len(self.text) - start - p
        while done < room:
            upto = min(room, done + step)
            differ = np.flatnonzero(self.text[start + done : start + upto] != self.text[start + done + p : start + upto + p])
            if len(differ):
                return done + int(differ[0])
            done, step = upto, 2 * step
        return done


def text_words(text: str | None) -> list[bytes]:
    """The words of a text, which end at ASCII white space."""
    return (text or "").encode("utf-8", "replace").split()


def runs_of(texts: list[list[bytes]], min_length: int = MIN_LENGTH) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of several texts, sorted; a wall that equals nothing parts the texts."""
    number: dict[bytes, int] = {}
    parts: list[np.ndarray] = []
    for k, words in enumerate(texts):
        parts.append(np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words)))
        parts.append(np.array([-1 - k]))
    if not parts:
        return []
    longest = max(map(len, texts)) // 2
    found = SquareCatchers(min_length, longest).append(np.concatenate(parts), last=True)
    begins = np.cumsum([0, *(len(words) + 1 for words in texts)])
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for start, length, period in found:
        owner = int(np.searchsorted(begins, start, side="right")) - 1
        out[owner].append((start - int(begins[owner]), length, period))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in out]


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    """The words outside of repetitions, joined by blanks: of each run its first period stays."""
    kept = words
    if runs:
        step = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            step[start + period] += 1
            step[start + length] -= 1
        kept = list(compress(words, np.cumsum(step[:-1]) == 0))
    return b" ".join(kept).decode("utf-8", "replace")


def periodic_runs(min_length: int = MIN_LENGTH) -> Callable[[Column], Column]:
    """Column function: text to a struct of n_words, runs (start, length, period; by start, then period) and collapsed.

    A run is a stretch of words with smallest period q and at least ``min_length`` and 2 q words that no
    neighbouring word extends. ``collapsed`` leaves out the words that a run holds after its first q. NULL
    and blank texts have no words, no runs and an empty rest. Each row is judged by itself, so repeated rows
    get equal results and an empty table none; texts of any length are taken whole.
    """

    @F.pandas_udf(f"n_words bigint, runs array<{RUN}>, collapsed string")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows: list[tuple] = []
            group: list[list[bytes]] = []
            room = 0
            for k, text in enumerate(batch, 1):
                group.append(text_words(text))
                room += len(group[-1])
                if room >= WORDS_AT_ONCE or k == len(batch):
                    for words, runs in zip(group, runs_of(group, min_length), strict=True):
                        shown = [{"start": s, "length": n, "period": p} for s, n, p in runs]
                        rows.append((len(words), shown, collapse(words, runs)))
                    group, room = [], 0
            yield pd.DataFrame(rows, columns=["n_words", "runs", "collapsed"])

    return found
