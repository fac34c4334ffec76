"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point. An n-gram is the product
(binding) of its letters' vectors, each rotated (permuted) by its distance from the n-gram's end. A
text is the sum (bundle) of its n-grams, a language the sum of its texts, and a text has the language
whose centred prototype has the largest cosine with it.

Bundling is linear, so training sums n-gram counts per language inside each task and ships one
vector per language and task: the model has languages x DIMENSIONS numbers, whatever the corpus size.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIMENSIONS = 1024
GRAM = 3
SEED = 20011
# Languages whose prototypes may be sent to every task (1024 doubles each).
MAX_LANGUAGES = 2000
# N-gram vectors kept by one Python worker (1 KB each), and added up at a time.
CACHED_GRAMS = 30_000
GRAMS_AT_ONCE = 4096
# Characters whose n-grams or letters are counted at a time.
CHARS_AT_ONCE = 1 << 19
# Of the texts in no learned language, the share that may pass the bar by chance.
CHANCE = 0.001
# Distinct n-grams below which a text's own language may leave it under the bar.
FEW_GRAMS = 64
# A letter belongs to a language if it is at least this share of its letters.
LETTER_SHARE = 1e-4

_BITS = 21  # of a code point


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def _codes(text: str) -> np.ndarray:
    """Code points of the lower-cased text."""
    return np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.int64)


def grams(text: str, n: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of the lower-cased text and their counts.

    Runs of anything but letters are one blank, and a blank stands at either end. No n-gram without a letter.
    """
    codes = _codes(text)
    letter = _letters()[codes]
    if not letter.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first non-letter behind a letter stays, as a blank
    codes = np.where(letter, codes, 32)[keep]
    codes = np.concatenate([[32], codes, [32] if codes[-1] != 32 else []]).astype(np.int64)
    packed = codes[: len(codes) - n + 1].copy()
    for k in range(1, n):
        packed = packed << _BITS | codes[k : len(codes) - n + 1 + k]
    return np.unique(packed, return_counts=True)


class GramVectors:
    """Vectors of n-grams, remembered up to a bound."""

    def __init__(self, dimensions: int = DIMENSIONS, n: int = GRAM):
        self.dimensions, self.n = dimensions, n
        self.letters: dict[int, np.ndarray] = {}
        self.rows: dict[int, int] = {}
        self.table = np.empty((0, dimensions), np.int8)

    def _letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            draw = np.random.default_rng([SEED, code]).integers(0, 2, self.dimensions)
            self.letters[code] = (draw * 2 - 1).astype(np.int8)
        return self.letters[code]

    def _bind(self, gram: int) -> np.ndarray:
        out = np.ones(self.dimensions, np.int8)
        for k in range(self.n):
            out *= np.roll(self._letter(gram >> _BITS * k & (1 << _BITS) - 1), k)
        return out

    def bundle(self, codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Sum of the n-grams' vectors, each as often as it occurs."""
        total = np.zeros(self.dimensions, np.float64)
        some = min(GRAMS_AT_ONCE, CACHED_GRAMS)
        for at in range(0, len(codes), some):
            total += self._bundle(codes[at : at + some].tolist(), counts[at : at + some])
        return total

    def _bundle(self, codes: list[int], counts: np.ndarray) -> np.ndarray:
        fresh = [c for c in codes if c not in self.rows]
        if fresh:
            if len(self.rows) + len(fresh) > CACHED_GRAMS:
                self.rows, fresh = {}, codes
            if len(self.table) < len(self.rows) + len(fresh):
                grown = np.empty((min(CACHED_GRAMS, 2 * (len(self.rows) + len(fresh))), self.dimensions), np.int8)
                grown[: len(self.rows)] = self.table[: len(self.rows)]
                self.table = grown
            for code in fresh:
                self.table[len(self.rows)] = self._bind(code)
                self.rows[code] = len(self.rows)
        rows = self.table[[self.rows[c] for c in codes]]
        return (counts.astype(np.float32) @ rows.astype(np.float32)).astype(np.float64)


@lru_cache(maxsize=1)
def _vectors() -> GramVectors:
    return GramVectors()


def _stretches(texts: Iterable[str]) -> Iterator[list[str]]:
    """The texts, some CHARS_AT_ONCE characters at a time."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= CHARS_AT_ONCE:
            yield held
            held, size = [], 0
    if held:
        yield held


def train(labelled: DataFrame) -> dict[str, np.ndarray]:
    """Centred prototypes of unit length per language, from rows (text, lang).

    Rows without text, letters or language teach nothing. The driver receives one vector per
    language. A language that equals the mean of all (as a single one does) keeps its plain prototype.
    """

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vectors = _vectors()
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                for some in _stretches(texts):
                    found = [grams(text) for text in some]
                    codes, inverse = np.unique(np.concatenate([c for c, _ in found]), return_inverse=True)
                    counts = np.bincount(inverse, np.concatenate([n for _, n in found]), len(codes))
                    sums[lang] = sums.get(lang, 0) + vectors.bundle(codes, counts)
        _vectors.cache_clear()  # the worker may serve other tasks
        for lang, total in sums.items():
            yield pd.DataFrame({"lang": lang, "k": np.arange(DIMENSIONS), "v": np.rint(total).astype(np.int64)})

    rows = labelled.filter("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang")
    sums = rows.mapInPandas(partial, "lang string, k int, v long").groupBy("lang", "k").agg(F.sum("v").alias("v"))
    per_lang = sums.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("k", "v")))["v"].alias("v"))
    found = per_lang.limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    units = {r["lang"]: unit(np.array(r["v"], np.float64)) for r in sorted(found, key=lambda r: r["lang"])}
    units = {lang: v for lang, v in units.items() if v.any()}
    mean = sum(units.values()) / max(len(units), 1)
    return {lang: unit(v - mean) if np.abs(v - mean).max() > 1e-9 else v for lang, v in units.items()}


def unit(vector: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(vector)
    return vector / length if length else vector


def judge(prototypes: dict[str, np.ndarray]) -> Callable[[Column], Column]:
    """Column function: text to a struct of lang_pred and score.

    ``score`` is the cosine with the winning prototype, 0 if negative; a tie goes to the first
    language in code-point order. Text that is NULL or has no letter, and any text when nothing was
    learned, is ``und`` with score 0.
    """
    languages = sorted(prototypes)
    matrix = np.array([prototypes[lang] for lang in languages]).reshape(-1, DIMENSIONS)

    @F.pandas_udf("lang_pred string, score double")
    def best(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        vectors = _vectors()
        for batch in texts:
            out = []
            for text in batch:
                codes, counts = grams(text) if text and languages else ((), ())
                if not len(codes):
                    out.append(("und", 0.0))
                    continue
                near = matrix @ unit(vectors.bundle(codes, counts))
                k = int(np.argmax(near))
                out.append((languages[k], float(min(1.0, max(0.0, near[k])))))
            yield pd.DataFrame(out, columns=["lang_pred", "score"])
        _vectors.cache_clear()

    return best


def bar(languages: int, dimensions: int = DIMENSIONS) -> float:
    """The cosine that a share of CHANCE of unrelated texts exceeds with the best of the languages.

    An unrelated text's cosine with one prototype spreads like a normal variable of deviation 1 / sqrt(dimensions).
    """
    return NormalDist().inv_cdf(1 - CHANCE / max(languages, 1)) / dimensions**0.5


def alphabet(labelled: DataFrame) -> np.ndarray:
    """Code points of the letters that some language uses, from rows (text, lang), sorted."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                letters: Counter[int] = Counter()
                for text in texts:
                    for at in range(0, len(text), CHARS_AT_ONCE):
                        codes = _codes(text[at : at + CHARS_AT_ONCE])
                        found, n = np.unique(codes[_letters()[codes]], return_counts=True)
                        letters.update(dict(zip(found.tolist(), n.tolist(), strict=True)))
                yield pd.DataFrame({"lang": lang, "code": list(letters), "n": list(letters.values())}).astype({"code": "int64", "n": "int64"})

    rows = labelled.filter("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang")
    counts = rows.mapInPandas(partial, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    used = counts.join(F.broadcast(totals), "lang").filter(F.col("n") >= LETTER_SHARE * F.col("total"))
    return np.array(sorted(r["code"] for r in used.select("code").distinct().collect()), np.int64)


def speaks(prototypes: dict[str, np.ndarray], letters: np.ndarray) -> Callable[[Column], Column]:
    """Column function: whether a text is in a learned language.

    Its cosine reaches the bar, or it has too few n-grams for that and most of its letters are among
    ``letters``: a word or two tell the script, but not the language. False for text without a letter.
    """
    matrix = np.array([prototypes[lang] for lang in sorted(prototypes)]).reshape(-1, DIMENSIONS)
    least = bar(len(matrix))

    def known(text: str | None) -> bool:
        codes, counts = grams(text) if text and len(matrix) else ((), ())
        if not len(codes):
            return False
        if (matrix @ unit(_vectors().bundle(codes, counts))).max() >= least:
            return True
        if len(codes) >= FEW_GRAMS:
            return False
        own = _codes(text)
        return np.isin(own[_letters()[own]], letters).mean() > 0.5

    @F.pandas_udf("boolean")
    def judged(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield batch.map(known).astype(bool)
        _vectors.cache_clear()

    return judged
