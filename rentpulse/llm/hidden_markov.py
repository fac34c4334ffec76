"""Scoring texts with a hidden Markov language model.

A word is emitted in two steps: a latent state emits the word's class (its last three bytes, and
whether there are more), and the class emits the word by its training count. The model of states has
a fixed size, whatever the corpus: Baum-Welch passes over all training documents sum expected counts
inside each task, tasks are summed in two levels, and the driver receives a few arrays. Word counts
never reach the driver: documents are dealt into chunks, and each chunk is joined with the counts of
the words it has, by a 64-bit hash. The scaled forward recursion gives the exact likelihood of the whole text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentpulse.llm.common import whole_text
from rentpulse.llm.text_hash import mix, prefix_hashes, range_hashes
from rentpulse.sources.scratch import materialize

STATES = 8
CLASSES = 4096  # class 0 is the end of a text
PASSES = 3
CHUNK_BYTES = 12 << 20  # of text that shares one lookup of word counts
TEXT_AT_ONCE = 2 << 20  # characters scored together
CUT_AT_ONCE = 512 << 10  # bytes cut into words together
BATCH_TOKENS = 400_000  # whose state probabilities are held at once
STICKY = 0.9
SMOOTHING = 0.05
SEED = 97

_WHITE = np.isin(np.arange(256), np.frombuffer(b" \t\n\x0b\x0c\r", np.uint8))


class Model(NamedTuple):
    start: np.ndarray  # states
    step: np.ndarray  # states x states
    emit: np.ndarray  # classes x states


class Tokens(NamedTuple):
    """The words of some texts, each followed by its end."""

    classes: np.ndarray  # of all tokens, text after text; 0 for an end
    start: np.ndarray  # of each text among the tokens
    length: np.ndarray  # in tokens
    words: np.ndarray  # 64-bit hashes of the words, ends left out
    owner: np.ndarray  # the text of each word


def tokenise(texts: list[str | None], hashed: bool = True) -> Tokens:
    """Words are lower-cased in A-Z; NULL is empty. Without ``hashed``, words are not hashed."""
    raw = [(text or "").encode("utf-8", "replace").lower() for text in texts]  # of bytes: A-Z alone
    group = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw))) // CUT_AT_ONCE
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(raw)]
    parts = [_cut(raw[a:b], a, hashed) for a, b in zip(cuts, cuts[1:], strict=False)]
    classes, length, words, owner = (np.concatenate(column) for column in zip(*parts, strict=True))
    return Tokens(classes, np.cumsum(length) - length, length, words, owner)


def _cut(raw: list[bytes], first: int, hashed: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Classes, lengths, word hashes and word owners of a few texts, the first of them numbered ``first``."""
    data = np.frombuffer(b" ".join(raw), np.uint8)
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_WHITE[data]
    edge = np.flatnonzero(np.diff(inside))
    start, end = edge[::2], edge[1::2]
    length = end - start
    code = np.minimum(length, 4).astype(np.uint64)
    for k in range(1, 4):
        byte = data[np.maximum(end - k, start)].astype(np.uint64)
        code = code << np.uint64(8) | np.where(length >= k, byte, np.uint64(0))
    stop = np.searchsorted(start, np.cumsum(size + 1))
    words = np.diff(stop, prepend=0)
    owner = np.repeat(np.arange(len(raw)), words)
    classes = np.zeros(len(start) + len(raw), np.int64)
    classes[np.arange(len(start)) + owner] = (mix(code) % np.uint64(CLASSES - 1)).astype(np.int64) + 1
    hashes = range_hashes(prefix_hashes(data), start, end).view(np.int64) if hashed else np.empty(0, np.int64)
    return classes, words + 1, hashes, owner + first


def portions(frame: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Rows of a frame, some TEXT_AT_ONCE characters at a time."""
    place = np.cumsum(frame["text"].str.len().to_numpy()) // TEXT_AT_ONCE
    for _, part in frame.groupby(place, sort=True):
        yield part


class Batch:
    """Texts of some tokens, longest first, stepped through side by side."""

    def __init__(self, tokens: Tokens, places: np.ndarray):
        self.flat, self.start = tokens.classes, tokens.start[places]
        self.length = tokens.length[places]
        # how many texts have a t-th token
        self.active = len(places) - np.searchsorted(self.length[::-1], np.arange(self.length[0]), side="right")

    def symbols(self, t: int) -> np.ndarray:
        return self.flat[self.start[: self.active[t]] + t]

    def forward(self, model: Model, keep: bool) -> tuple[np.ndarray, list, list]:
        """log10 likelihoods; with ``keep``, also scaled state probabilities and scales."""
        total = np.zeros(len(self.start))
        alphas, scales = [], []
        alpha = None
        for t, n in enumerate(self.active):
            alpha = (model.start if alpha is None else alpha[:n] @ model.step) * model.emit[self.symbols(t)]
            scale = alpha.sum(axis=1)
            alpha /= scale[:, None]
            total[:n] += np.log10(scale)
            if keep:
                alphas.append(alpha)
                scales.append(scale)
        return total, alphas, scales

    def expected(self, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected counts of start states, steps and emissions."""
        _, alphas, scales = self.forward(model, keep=True)
        states = len(model.start)
        own = np.cumsum(self.length) - self.length  # where a text starts among the batch's tokens
        gamma = np.empty((self.length.sum(), states))
        step = np.zeros((states, states))
        beta, ahead = None, None
        for t in range(len(self.active) - 1, -1, -1):
            n = self.active[t]
            here = np.ones((n, states))
            if beta is not None:
                ahead = beta * model.emit[self.symbols(t + 1)] / scales[t + 1][:, None]
                here[: len(ahead)] = ahead @ model.step.T
                step += alphas[t][: len(ahead)].T @ ahead
            beta = here
            gamma[own[:n] + t] = alphas[t] * beta
        classes = self.flat[np.repeat(self.start - own, self.length) + np.arange(len(gamma))]
        emit = np.stack([np.bincount(classes, gamma[:, k], CLASSES) for k in range(states)], axis=1)
        return gamma[own].sum(axis=0), step * model.step, emit


def batches(tokens: Tokens) -> Iterator[tuple[Batch, np.ndarray]]:
    """Batches of texts of similar length, with their places."""
    order = np.argsort(-tokens.length, kind="stable")
    group = np.cumsum(tokens.length[order]) // BATCH_TOKENS
    for places in np.split(order, np.flatnonzero(np.diff(group)) + 1):
        if len(places):
            yield Batch(tokens, places), places


def log_likelihoods(model: Model, tokens: Tokens) -> np.ndarray:
    """log10 probabilities of the texts' classes."""
    out = np.zeros(len(tokens.start))
    for batch, places in batches(tokens):
        out[places] = batch.forward(model, keep=False)[0]
    return out


def first_model(class_counts: np.ndarray) -> Model:
    """States that nearly share the corpus's class frequencies, told apart at random, and tend to last."""
    noise = np.random.default_rng(SEED).uniform(0.5, 1.5, (CLASSES, STATES))
    step = np.full((STATES, STATES), (1 - STICKY) / max(STATES - 1, 1))
    np.fill_diagonal(step, STICKY)
    return _normal(np.ones(STATES), step, class_counts[:, None] * noise)


def _normal(start: np.ndarray, step: np.ndarray, emit: np.ndarray) -> Model:
    """Probabilities from counts; every start, step and class stays possible."""
    start, step, emit = start + SMOOTHING, step + SMOOTHING / STATES, emit + SMOOTHING
    return Model(start / start.sum(), step / step.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def train(texts: DataFrame, class_counts: np.ndarray, passes: int = PASSES) -> Model:
    """Baum-Welch over all rows of column text."""
    model = first_model(class_counts)
    for _ in range(passes):
        model = _next_model(texts, model)
    return model


def _next_model(texts: DataFrame, model: Model) -> Model:
    shapes = [model.start.shape, model.step.shape, model.emit.shape]
    cuts = np.cumsum([math.prod(s) for s in shapes])

    def count(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(cuts[-1])
        for frame in rows:
            for batch, _ in batches(tokenise(frame["text"].tolist(), hashed=False)):
                total += np.concatenate([part.ravel() for part in batch.expected(model)])
        yield pd.DataFrame({"counts": [total.tobytes()]})

    def add(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(cuts[-1])
        for frame in rows:
            for counts in frame["counts"]:
                total += np.frombuffer(counts)
        yield pd.DataFrame({"counts": [total.tobytes()]})

    per_task = texts.select("text").mapInPandas(count, "counts binary")
    per_group = per_task.repartition(16).mapInPandas(add, "counts binary")
    total = np.zeros(cuts[-1])
    for row in per_group.collect():  # 16 rows of the model's size
        total += np.frombuffer(row["counts"])
    return _normal(*[part.reshape(shape) for part, shape in zip(np.split(total, cuts[:-1]), shapes, strict=True)])


def score(docs: DataFrame, passes: int = PASSES) -> DataFrame:
    """Scores of every row of docs (doc_id, text, held_out), learned from the rows not held out.

    Returns doc_id, held_out, n_tokens (words and the end), n_known (tokens that training has),
    train_tokens, base_score (add-one unigram, log10) and score (the model's log10 probability of the
    text). NULL and empty texts are just the end. Unknown words share the probability their class keeps
    for them. Without training rows all classes are equally likely.
    """
    docs = docs.select("doc_id", "held_out", whole_text().alias("text"))
    size = docs.agg(F.sum(F.octet_length("text")).alias("n"), F.count_if(~F.col("held_out")).alias("train")).first()
    chunks = max(1, -(-(size["n"] or 0) // CHUNK_BYTES))
    dealt = docs.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int"))

    def words_of(frame: pd.DataFrame) -> pd.DataFrame:
        words, kinds, trained = [], [], []
        for part in portions(frame):
            tokens = tokenise(part["text"].tolist())
            word, first, place = np.unique(tokens.words, return_index=True, return_inverse=True)
            words.append(word)
            classes = np.delete(tokens.classes, tokens.start + tokens.length - 1)  # without the ends
            kinds.append(classes[first])
            trained.append(np.bincount(place, ~part["held_out"].to_numpy(bool)[tokens.owner], len(word)))
        word, first, place = np.unique(np.concatenate(words), return_index=True, return_inverse=True)
        n = np.bincount(place, np.concatenate(trained), len(word)).astype(np.int64)
        return pd.DataFrame({"chunk": frame["chunk"].iat[0], "word": word, "class": np.concatenate(kinds)[first], "n": n})

    kind = "chunk int, word long, class int, n long"
    local = materialize(dealt.groupBy("chunk").applyInPandas(words_of, kind), "chunk_words")
    counts = local.groupBy("word").agg(F.sum("n").alias("c"), F.first("class").alias("class")).filter("c > 0")
    counts = materialize(counts, "word_counts")
    per_class = counts.groupBy("class").agg(F.sum("c").alias("tokens"), F.count(F.lit(1)).alias("kinds"))
    tokens, kinds = np.zeros(CLASSES), np.zeros(CLASSES)
    for row in per_class.collect():  # one row per class
        tokens[row["class"]], kinds[row["class"]] = row["tokens"], row["kinds"]
    ends = size["train"] or 0
    tokens[0], kinds[0] = ends, min(ends, 1)
    model = train(docs.filter(~F.col("held_out")), tokens, passes) if ends else first_model(np.ones(CLASSES))
    n_train, n_kinds = int(tokens.sum()), int(kinds.sum())
    log_all = math.log10(n_train + n_kinds + 1)
    log_class = np.log10(tokens + kinds + 1)
    log_end = math.log10(ends + 1)

    def judge(frame: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        known = known.sort_values("word")
        vocabulary = np.append(known["word"].to_numpy(np.int64), np.iinfo(np.int64).max)
        log_count = np.append(np.log10(known["c"].to_numpy(float) + 1), 0.0)
        found = []
        for part in portions(frame):
            tokens = tokenise(part["text"].tolist())
            texts = len(part)
            at = np.searchsorted(vocabulary[:-1], tokens.words)
            seen = vocabulary[at] == tokens.words
            words = np.bincount(tokens.owner, np.where(seen, log_count[at], 0.0), texts)
            classes = np.add.reduceat(np.where(tokens.classes > 0, log_class[tokens.classes], 0.0), tokens.start)
            found.append(
                pd.DataFrame(
                    {
                        "doc_id": part["doc_id"].array,
                        "held_out": part["held_out"].array,
                        "n_tokens": tokens.length,
                        "n_known": np.bincount(tokens.owner[seen], minlength=texts) + int(ends > 0),
                        "train_tokens": n_train,
                        "base_score": words + log_end - log_all * tokens.length,
                        "score": words - classes + log_likelihoods(model, tokens),
                    }
                )
            )
        return pd.concat(found, ignore_index=True)

    needed = local.select("chunk", "word").join(counts, "word")
    kind = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return dealt.groupBy("chunk").cogroup(needed.groupBy("chunk")).applyInPandas(judge, kind)
