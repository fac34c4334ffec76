"""Licence notices found through a positional index of their rare words.

The index holds, for each word that is rare in the corpus, the notices it occurs in and where. A text
looks up the words it has in the index; each hit says where the notice would begin in the text. Hits that
agree on the beginning, up to a few words put in or left out, are a candidate once they carry half of the
weight of the notice's rare words, and it holds if every mandatory key phrase stands at its place and
enough of the notice's words do. A phrase that is searched word by word is a notice whose one rare word
is its rarest and whose key phrase is all of it.

Weights are inverse document frequencies of the notices' words, counted over all documents.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rare words of a notice that are indexed, and the share of their weight that makes a candidate.
RARE_WORDS = 8
CANDIDATE_WEIGHT = 0.5
# Words that may be put in or left out between two rare words' places.
SLACK = 3
# Share of the notice's words that must be at their places.
COVERAGE = 0.8

# Words are runs of digits, letters a to z and anything beyond ASCII; A to Z count as a to z.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)

PLACE = "struct<label: string, start: bigint, n_words: bigint, score: double, exact: boolean>"


def text_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_FOLD).split()


@dataclass(frozen=True)
class Notice:
    """A notice to look for: its label, its words and the phrases in it that must be there."""

    label: str
    text: str
    keys: tuple[str, ...] = ()
    exact: bool = False


# Phrases that name a licence, and the labels they stand for.
PHRASES = (
    Notice("mit", "under the mit license", exact=True),
    Notice("apache-2", "apache license version 2", exact=True),
    Notice("cc-by-nc", "cc by nc", exact=True),
)

# Opening sentences of public licence notices, with key phrases.
NOTICES = (
    Notice(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction",
        ("permission is hereby granted free of charge", "without restriction"),
    ),
    Notice(
        "apache-2",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License",
        ("apache license version 2 0", "in compliance with the license"),
    ),
    Notice("apache-2", "Licensed under the Apache License, Version 2.0", ("apache license version 2 0",)),
    Notice("gpl-3", "licensed under the GNU General Public License, version 3", ("gnu general public license version 3",)),
    Notice(
        "gpl-3",
        "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
        ("gnu general public license", "version 3"),
    ),
    Notice(
        "gpl-2",
        "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License",
        ("gnu general public license", "version 2"),
    ),
    Notice(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
        ("redistribution and use in source and binary forms",),
    ),
    Notice(
        "mpl-2",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        ("mozilla public license v 2 0",),
    ),
    Notice(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        ("with or without fee is hereby granted",),
    ),
    Notice("unlicense", "This is free and unencumbered software released into the public domain", ("released into the public domain",)),
    Notice("cc-by", "licensed under a Creative Commons Attribution 4.0 International License", ("creative commons attribution 4 0",)),
    Notice("cc-by-nc", "licensed under CC BY-NC 4.0", ("cc by nc",)),
)


def word_weights(docs: DataFrame, notices: Sequence[Notice]) -> dict[bytes, float]:
    """log((documents + 1) / (documents with the word + 1)) of every word of the notices, over rows (text).

    The driver receives one row per word of the notices.
    """
    words = frozenset(w for notice in notices for w in text_words(notice.text))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch["text"]:
                found.update(words.intersection(text_words(text)))
                found[b" "] += 1  # no word: all documents
        yield pd.DataFrame({"word": pd.Series([w.decode() for w in found], dtype=object), "n": list(found.values())})

    rows = docs.select("text").mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = {r.word.encode(): r.n for r in rows.collect()}
    total = counts.get(b" ", 0)
    return {w: math.log((total + 1) / (counts.get(w, 0) + 1)) for w in words}


class LicenseIndex:
    """Postings of the notices' rare words, and the search of one text."""

    def __init__(self, notices: Sequence[Notice], weights: dict[bytes, float]):
        self.notices = list(notices)
        self.words = [text_words(n.text) for n in notices]
        self.keys: list[list[tuple[int, list[bytes]]]] = []
        self.rare: list[dict[bytes, float]] = []
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for number, (notice, words) in enumerate(zip(self.notices, self.words, strict=True)):
            ranked = sorted(set(words), key=lambda w: (-weights[w], w))
            if notice.exact:
                # One place of the rarest word leads to each place of the phrase.
                self.rare.append({ranked[0]: 1.0})
                self.keys.append([(0, words)])
                self.postings[ranked[0]].append((number, words.index(ranked[0])))
                continue
            rare = ranked[:RARE_WORDS]
            self.rare.append({w: weights[w] + 1e-9 for w in rare})
            self.keys.append([(_place(words, text_words(key)), text_words(key)) for key in notice.keys])
            for at, word in enumerate(words):
                if word in self.rare[-1]:
                    self.postings[word].append((number, at))

    def places(self, words: list[bytes]) -> list[tuple[str, int, int, float, bool]]:
        """(label, first word, number of words, share of the notice found there, exact) of what a text holds."""
        begins: dict[int, list[tuple[int, bytes]]] = defaultdict(list)
        for at, word in enumerate(words):
            if word in self.postings:
                for number, place in self.postings[word]:
                    begins[number].append((at - place, word))
        out = []
        for number, hits in begins.items():
            notice, size = self.notices[number], len(self.words[number])
            if notice.exact:
                starts = [(b, 1.0) for b, _ in hits if b >= 0 and words[b : b + size] == self.words[number]]
            else:
                starts = self._aligned(number, sorted(hits), words)
            out += [(notice.label, max(b, 0), size, score, notice.exact) for b, score in starts]
        return sorted(out, key=lambda p: (p[1], p[0], not p[4], p[2]))

    def _aligned(self, number: int, hits: list[tuple[int, bytes]], words: list[bytes]) -> list[tuple[int, float]]:
        """Where a notice begins, and how much of it is there."""
        rare, found = self.rare[number], []
        enough = CANDIDATE_WEIGHT * sum(rare.values())
        held: Counter[bytes] = Counter()
        weight, low, free = 0.0, 0, -len(words)
        for begin, word in hits:
            if not held[word]:
                weight += rare[word]
            held[word] += 1
            while hits[low][0] < begin - SLACK:
                left = hits[low][1]
                held[left] -= 1
                if not held[left]:
                    weight -= rare[left]
                low += 1
            if weight >= enough and begin >= free:
                first = hits[low][0]
                if all(self._stands(words, first + at, key) for at, key in self.keys[number]):
                    share = self._share(number, words, first)
                    if share >= COVERAGE:
                        found.append((first, share))
                        free = first + len(self.words[number])
        return found

    def _stands(self, words: list[bytes], at: int, key: list[bytes]) -> bool:
        return any(words[b : b + len(key)] == key for b in range(max(at - SLACK, 0), at + 2 * SLACK + 1))

    def _share(self, number: int, words: list[bytes], first: int) -> float:
        notice = self.words[number]
        there = sum(w in words[max(first + k, 0) : max(first + k + SLACK + 1, 0)] for k, w in enumerate(notice))
        return there / len(notice)


def _place(words: list[bytes], key: list[bytes]) -> int:
    for at in range(len(words) - len(key) + 1):
        if words[at : at + len(key)] == key:
            return at
    raise ValueError(f"{b' '.join(key).decode()!r} is not part of its notice")


def scan(index: LicenseIndex) -> Callable[[Column], Column]:
    """Column function: text to a struct of n_words and places (label, start, n_words, score, exact).

    Places are by first word, counted from 0. A NULL or empty text has no words and no places; equal rows
    get equal results; a phrase or notice that stands several times is reported each time.
    """

    @F.pandas_udf(f"n_words bigint, places array<{PLACE}>")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = ("label", "start", "n_words", "score", "exact")
        for batch in batches:
            rows = []
            for text in batch:
                words = text_words(text)
                rows.append((len(words), [dict(zip(names, p, strict=True)) for p in index.places(words)]))
            yield pd.DataFrame(rows, columns=["n_words", "places"])

    return found


def find_licenses(docs: DataFrame, notices: Sequence[Notice] = PHRASES + NOTICES, out: str = "licenses") -> DataFrame:
    """The rows of ``docs`` with a struct column of what ``scan`` finds in their text."""
    index = LicenseIndex(notices, word_weights(docs, notices))
    return docs.withColumn(out, scan(index)("text"))
