"""Runs against a search of every period at every place."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from rentpulse.llm import queries
from rentpulse.llm.square_catchers import SquareCatchers, collapse, periodic_runs, runs_of, text_words


def plain_runs(words, min_length=12):
    out = {}
    for p in range(1, len(words) // 2 + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j - i >= p and j - i + p >= min_length:
                out.setdefault((i, j + p), p)
            i = max(j, i + 1)
    return sorted(((s, t - s, p) for (s, t), p in out.items()), key=lambda r: (r[0], r[2]))


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return list(b[:n])


def made(rng, kind):
    n = rng.randrange(0, 130)
    if kind == 0:
        return [rng.choice("ab") for _ in range(n)]
    if kind == 1:
        return fibonacci(n)
    if kind == 2:
        return ["x"] * rng.randrange(20) + [rng.choice("abc") for _ in range(rng.randrange(1, 9))] * rng.randrange(1, 12) + ["y"] * rng.randrange(30)
    if kind == 3:
        return [str(i.bit_count() % 2) for i in range(n)]  # no cubes, and prefix hashes of it are treacherous
    return [rng.choice("abcdefgh") for _ in range(n)]


@pytest.mark.parametrize("kind", range(5))
@pytest.mark.parametrize("min_length", [12, 5, 2])
def test_runs(kind, min_length):
    rng = random.Random(kind)
    texts = [[w.encode() for w in made(rng, kind)] for _ in range(60)]
    assert runs_of([*texts, []], min_length) == [plain_runs(t, min_length) for t in [*texts, []]]


@pytest.mark.parametrize("kind", range(5))
def test_words_may_come_in_any_portions(kind):
    rng = random.Random(kind)
    for _ in range(40):
        words = np.array([ord(w) for w in made(rng, kind)], np.int64)
        catchers, found, at = SquareCatchers(), [], 0
        while at < len(words):
            step = rng.randrange(1, 30)
            found += catchers.append(words[at : at + step])
            at = min(at + step, len(words))
            complete = [r for r in plain_runs(words[:at].tolist()) if r[0] + r[1] < at]
            assert set(complete) <= set(found)
        found += catchers.append(words[:0], last=True)
        assert sorted(found) == sorted(plain_runs(words.tolist()))


def test_collapse():
    words = text_words("a b c b c b c b c b c b c d")
    assert runs_of([words]) == [[(1, 12, 2)]]
    assert collapse(words, [(1, 12, 2)]) == "a b c d"


def test_long_texts():
    assert runs_of([[b"a"] * 100_000, [b"b", b"c"] * 50_000]) == [[(0, 100_000, 1)], [(0, 100_000, 2)]]


def test_awkward_rows(awkward, nothing):
    for df in (awkward, nothing):
        got = df.withColumn("found", periodic_runs()("text")).collect()
        assert len(got) == df.count()
        for r in got:
            words = text_words(r.text)
            assert r.found.n_words == len(words)
            if len(words) < 1000:
                runs = plain_runs(words)
                assert [tuple(x) for x in r.found.runs] == runs and r.found.collapsed == collapse(words, runs)
            else:
                assert [tuple(x) for x in r.found.runs] == [(0, len(words), 15)]


def test_query(spark, sf_dir, texts):
    found = {r.doc_id: r for r in queries.all_queries()["op12_square_catchers"](spark, sf_dir).collect()}
    assert found.keys() == texts.keys()
    planted = 0
    for doc_id, text in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n, (g, chosen) = len(words), divmod(zlib.crc32(str(doc_id).encode()), 10)
        if not chosen and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            planted += 1
        if n > 1500:
            continue
        runs = plain_runs(words)
        r = found[doc_id]
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + length for s, length, q in runs)]
        assert r.n_runs == len(runs)
        assert r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(" ".join(kept).encode()).hexdigest()
        top = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        assert (r.start, r.length, r.period) == top
        assert r.exponent_milli == (1000 * top[1] // top[2] if runs else None)
    assert planted
