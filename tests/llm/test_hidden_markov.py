"""The language model against direct sums over all paths."""

import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rentpulse.llm import hidden_markov as hm
from rentpulse.llm import queries


def small_model():
    rng = np.random.default_rng(2)
    start, step, emit = rng.random(3), rng.random((3, 3)), rng.random((hm.CLASSES, 3))
    return hm.Model(start / start.sum(), step / step.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def paths(model, symbols):
    """(probability, path) of all paths."""
    for path in itertools.product(range(3), repeat=len(symbols)):
        p = model.start[path[0]] * model.emit[symbols[0], path[0]]
        for a, b, s in zip(path, path[1:], symbols[1:], strict=False):
            p *= model.step[a, b] * model.emit[s, b]
        yield p, path


SEQUENCES = [np.array(s) for s in ([4, 9, 4, 0], [0], [7, 7, 0], [1, 2, 3, 4, 5, 0])]


def as_tokens(sequences):
    length = np.array([len(s) for s in sequences])
    return hm.Tokens(np.concatenate(sequences), np.cumsum(length) - length, length, None, None)


def test_likelihood_is_the_sum_over_all_paths():
    model = small_model()
    expected = [math.log10(sum(p for p, _ in paths(model, s))) for s in SEQUENCES]
    assert hm.log_likelihoods(model, as_tokens(SEQUENCES)) == pytest.approx(expected)


def test_expected_counts_are_those_over_all_paths(monkeypatch):
    model = small_model()
    start, step, emit = np.zeros(3), np.zeros((3, 3)), np.zeros((hm.CLASSES, 3))
    for s in SEQUENCES:
        all_ = list(paths(model, s))
        total = sum(p for p, _ in all_)
        for p, path in all_:
            start[path[0]] += p / total
            for a, b in itertools.pairwise(path):
                step[a, b] += p / total
            for c, k in zip(s, path, strict=True):
                emit[c, k] += p / total
    monkeypatch.setattr(hm, "BATCH_TOKENS", 8)
    got = [sum(parts) for parts in zip(*(b.expected(model) for b, _ in hm.batches(as_tokens(SEQUENCES))), strict=True)]
    for a, b in zip(got, (start, step, emit), strict=True):
        assert np.allclose(a, b)


def test_tokens():
    tokens = hm.tokenise(["The cat", None, "", " a\n The", "CAT ", "xthe"])
    assert tokens.length.tolist() == [3, 1, 1, 3, 2, 2] and tokens.owner.tolist() == [0, 0, 3, 3, 4, 5]
    assert [tokens.classes[a : a + n][-1] for a, n in zip(tokens.start, tokens.length, strict=True)] == [0] * 6
    the, cat, a, the_too, cat_too, longer = tokens.words.tolist()
    assert the == the_too and cat == cat_too and len({the, cat, a, longer}) == 4
    assert tokens.classes[0] == tokens.classes[6] != tokens.classes[10]


@pytest.fixture(scope="module")
def scored(spark, sf_dir):
    return {r.doc_id: r for r in queries.all_queries()["op10_hidden_markov"](spark, sf_dir).collect()}


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))


def test_counts_and_base_score(scored, texts):
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in texts}
    seen = Counter(w for d, t in texts.items() if not held[d] for w in [*words(t), None])
    n, v = seen.total(), len(seen)
    assert set(scored) == set(texts)
    for d, text in texts.items():
        tokens = [*words(text), None]
        r = scored[d]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[d], len(tokens), n)
        assert r.n_known == sum(seen[w] > 0 for w in tokens)
        assert r.base_score == pytest.approx(sum(math.log10((seen[w] + 1) / (n + v + 1)) for w in tokens))


def test_states_improve_on_the_unigram(scored):
    held = [r for r in scored.values() if r.held_out]
    gain = sum(r.score - r.base_score for r in held) / sum(r.n_tokens for r in held)
    assert gain > 0.2


def test_training_passes_raise_the_likelihood(documents, texts):
    classes = np.bincount(hm.tokenise(list(texts.values())).classes, minlength=hm.CLASSES)
    some = hm.tokenise(list(texts.values())[:80])
    found = [hm.log_likelihoods(hm.train(documents, classes.astype(float), n), some).sum() for n in (0, 1, 3)]
    assert found == sorted(found)


def test_awkward_rows(awkward, nothing):
    docs = awkward.select("doc_id", "text", (F.col("doc_id") % 2 == 0).alias("held_out")).fillna(False, ["held_out"])
    rows = hm.score(docs).collect()
    assert len(rows) == awkward.count()
    empty = [r for r in rows if r.doc_id in (1, 2, 3)]
    assert {(r.n_tokens, r.n_known) for r in empty} == {(1, 1)} and len({r.score for r in empty}) == 1
    assert all(r.score < 0 and math.isfinite(r.score) for r in rows)
    none = hm.score(docs.withColumn("held_out", F.lit(True))).collect()
    assert all((r.train_tokens, r.n_known, r.base_score) == (0, 0, 0) and r.score < 0 for r in none)
    assert hm.score(nothing.withColumn("held_out", F.lit(False))).count() == 0
