"""Held-out accuracy and defined results of the language profiles."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from rentpulse.llm import language_id, queries


def test_held_out_accuracy(spark, sf_dir, documents):
    got = queries.all_queries()["op4_language_id"](spark, sf_dir)
    met = got.join(documents.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(met) > 20
    assert np.mean([r.lang == r.lang_pred for r in met]) >= 0.95
    assert all(0 <= r.score <= 1 for r in met)


def test_bundle_is_the_sum_of_bound_and_permuted_letters():
    vectors = language_id.GramVectors(dimensions=64)
    codes, counts = language_id.grams("Ab ab!")
    assert counts.sum() == len(" ab ab ") - 2
    expected = np.zeros(64)
    for i in range(5):
        gram = " ab ab "[i : i + 3]
        expected += np.prod([np.roll(vectors._letter(ord(c)), 2 - k) for k, c in enumerate(gram)], axis=0)
    assert np.array_equal(vectors.bundle(codes, counts), expected)


def test_more_grams_than_are_remembered(monkeypatch):
    text = "".join(chr(97 + i * i % 26) for i in range(500))
    codes, counts = language_id.grams(text)
    whole = language_id.GramVectors(32).bundle(codes, counts)
    monkeypatch.setattr(language_id, "CACHED_GRAMS", 10)
    assert np.array_equal(language_id.GramVectors(32).bundle(codes, counts), whole)


def judged(docs, prototypes):
    rows = docs.withColumn("best", language_id.judge(prototypes)("text")).select("doc_id", "best.*").collect()
    return {r.doc_id: (r.lang_pred, r.score) for r in rows}


class PlainProfiles:
    """The method written out: one vector per n-gram occurrence, added one by one."""

    def __init__(self):
        self.letters, self.grams = {}, {}

    def letter(self, c):
        if c not in self.letters:
            draw = np.random.default_rng([language_id.SEED, ord(c)]).integers(0, 2, language_id.DIMENSIONS)
            self.letters[c] = draw * 2 - 1
        return self.letters[c]

    def gram(self, g):
        if g not in self.grams:
            self.grams[g] = np.prod([np.roll(self.letter(c), len(g) - 1 - k) for k, c in enumerate(g)], axis=0)
        return self.grams[g]

    def text(self, text):
        words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
        padded = " " + " ".join(words) + " " if words else ""
        total = np.zeros(language_id.DIMENSIONS)
        for i in range(len(padded) - language_id.GRAM + 1):
            total += self.gram(padded[i : i + language_id.GRAM])
        return total


def unit(v):
    return v / np.linalg.norm(v) if v.any() else v


def test_predictions_against_plain_vectors(spark, sf_dir, documents):
    """Every prediction of the query, from prototypes and profiles written out."""
    plain = PlainProfiles()
    rows = documents.collect()
    profiles = {r.doc_id: plain.text(r.text or "") for r in rows}
    sums = {}
    for r in rows:
        if r.lang is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2:
            sums[r.lang] = sums.get(r.lang, 0) + profiles[r.doc_id]
    units = {lang: unit(v) for lang, v in sorted(sums.items())}
    mean = sum(units.values()) / len(units)
    prototypes = {lang: unit(v - mean) for lang, v in units.items()}
    for r in queries.all_queries()["op4_language_id"](spark, sf_dir).collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        profile = unit(profiles[r.doc_id])
        if not profile.any():
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        near = {lang: float(profile @ v) for lang, v in prototypes.items()}
        assert near[r.lang_pred] >= max(near.values()) - 1e-6
        assert abs(r.score - max(0.0, max(near.values()))) < 1e-5


def test_awkward_rows(awkward):
    got = judged(awkward, language_id.train(awkward))
    assert {got[i] for i in (1, 2, 3, 9)} == {("und", 0.0)}
    assert got[5][0] == got[6][0] == "en" and got[4][0] in ("en", "de")


def test_nothing_learned(awkward, nothing):
    assert language_id.train(nothing) == {}
    assert set(judged(awkward, {}).values()) == {("und", 0.0)}
    assert judged(nothing, {}) == {}


def test_a_single_language_is_recognised(awkward):
    only = language_id.train(awkward.filter(F.col("lang") == "en"))
    assert list(only) == ["en"] and judged(awkward, only)[5][0] == "en"
