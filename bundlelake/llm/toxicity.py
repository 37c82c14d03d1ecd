"""Toxicity scores from subword-bag embeddings under a linear softmax.

A word is the bag of its character n-grams, hashed into a table of embeddings; a text is the mean of
its words; a linear softmax over that mean gives the score. Embeddings and softmax are trained
jointly in numpy, so a misspelling never seen before shares most n-grams' vectors with the word it
stands for. The fit runs in one task on a bounded sample of labelled rows; scoring covers all rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bundlelake.llm.common import own_name, quoted, slices, with_arrow

GRAMS, BUCKETS, DIMENSIONS = (3, 4, 5), 1 << 17, 8
#: Labelled rows the model is fitted on at most, of label 1 and of label 0.
SAMPLE = (2_500, 4_500)
#: The mean is scaled by this before the softmax: a few words among hundreds must move the score.
SCALE = 100.0
EPOCHS, BATCH, RATE = 8, 64, 0.15
CACHE_WORDS = 300_000
_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def grams_of(word: str) -> list[int]:
    """Buckets of a word's character n-grams and of the word itself."""
    marked = f"<{word}>"
    found = {marked[i : i + n] for n in GRAMS for i in range(len(marked) - n + 1)} | {marked}
    return [zlib.crc32(g.encode("utf-8", "replace")) % BUCKETS for g in found]


class _Grams(dict):
    """Buckets of words, kept up to a bound."""

    def __missing__(self, word: str) -> np.ndarray:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = np.array(grams_of(word), np.int32)
        return value


def features(text: str | None, grams: _Grams | None = None) -> tuple[np.ndarray, np.ndarray]:
    """A text as buckets and their shares: the mean over words of the mean over n-grams.

    ``grams`` remembers the buckets of words from one text to the next.
    """
    words = words_of(text)
    if not words:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    grams = _Grams() if grams is None else grams
    counts = Counter(words)
    buckets = [grams[w] for w in counts]
    sizes = np.array([len(b) for b in buckets])
    shares = np.repeat(np.array(list(counts.values())) / sizes, sizes)
    names, at = np.unique(np.concatenate(buckets), return_inverse=True)
    return names, (np.bincount(at, weights=shares) / len(words)).astype(np.float32)


def fit(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, base_rate: float | None = None) -> tuple[np.ndarray, float]:
    """Train, and return every bucket's log-odds per unit share and the bias.

    Adagrad on the softmax loss, embeddings and softmax together. ``base_rate`` is the share of
    label 1 among all labelled rows, to which the bias is moved if the sample differs.
    """
    rng = np.random.default_rng(1)
    embedding = rng.uniform(-1, 1, (BUCKETS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    softmax = (rng.standard_normal((DIMENSIONS, 2)) * 0.1).astype(np.float32)
    bias = np.zeros(2, np.float32)
    seen = [np.full_like(embedding, 1e-6), np.full_like(softmax, 1e-6), np.full_like(bias, 1e-6)]

    def move(parameter, gradient, memory):
        memory += gradient**2
        parameter -= RATE * gradient / np.sqrt(memory)

    usable = np.array([k for k, (b, _) in enumerate(bags) if len(b)], np.int64)
    for _ in range(EPOCHS if len(usable) else 0):
        for some in np.array_split(rng.permutation(usable), -(-len(usable) // BATCH)):
            names = np.concatenate([bags[k][0] for k in some])
            shares = np.concatenate([bags[k][1] for k in some]) * np.float32(SCALE)
            sizes = np.array([len(bags[k][0]) for k in some])
            first, row = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(some)), sizes)
            mean = np.add.reduceat(embedding[names] * shares[:, None], first, axis=0)
            logits = mean @ softmax + bias
            odds = np.exp(logits - logits.max(1, keepdims=True))
            error = odds / odds.sum(1, keepdims=True)
            error[np.arange(len(some)), labels[some]] -= 1
            error /= len(some)
            # the two columns of error are opposite, so a text moves all its buckets along one direction
            pull = np.bincount(names, error[row, 1] * shares, BUCKETS)
            touched = np.flatnonzero(pull)
            gradient = np.outer(pull[touched], softmax[:, 1] - softmax[:, 0]).astype(np.float32)
            seen[0][touched] += gradient**2
            embedding[touched] -= RATE * gradient / np.sqrt(seen[0][touched])
            move(softmax, mean.T @ error, seen[1])
            move(bias, error.sum(0), seen[2])
    odds = float(bias[1] - bias[0])
    ones = float(labels.mean()) if len(labels) else 0.0
    if base_rate is not None and 0 < ones < 1 and 0 < base_rate < 1:
        odds += float(np.log(base_rate / (1 - base_rate)) - np.log(ones / (1 - ones)))
    return (embedding @ (softmax[:, 1] - softmax[:, 0]) * np.float32(SCALE)).astype(np.float32), odds


def train(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[np.ndarray, float]:
    """Fit on the labelled documents, at most ``SAMPLE`` of each label.

    ``labels`` has the key and ``label`` (0 or 1); which of its rows are taken depends on hashes of
    their keys only, and the documents are filtered where they lie. Rows without a key or a label are
    left out; a label of no document is too. Without rows of both labels the model scores every
    text by the base rate alone.
    """
    rows = labels.where(quoted(key).isNotNull() & F.col("label").isin(0, 1)).select(
        quoted(key).alias("_key"), F.col("label").cast("int").alias("label")
    )
    counts = {r[0]: r[1] for r in rows.groupBy("label").count().collect()}
    total = sum(counts.values())
    base = counts.get(1, 0) / total if total else 0.0
    if len(counts) < 2:
        return np.zeros(BUCKETS, np.float32), 20.0 if base else -20.0

    def some(value: int, most: int) -> DataFrame:
        return rows.where(F.col("label") == value).orderBy(F.xxhash64("_key"), "_key").limit(most)

    chosen = some(1, SAMPLE[0]).unionAll(some(0, SAMPLE[1]))  # bounded by SAMPLE
    texts = documents.select(quoted(key).alias("_key"), quoted(text).alias("text"))
    sample = texts.join(F.broadcast(chosen), "_key").select("text", "label")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bags, labels, grams = [], [], _Grams()
        for batch in batches:
            bags += [features(t, grams) for t in batch.column("text").to_pylist()]
            labels += batch.column("label").to_pylist()
        if bags:
            weights, odds = fit(bags, np.array(labels, np.int64), base)
            yield pa.record_batch([pa.array([weights.tobytes()]), pa.array([odds])], names=["weights", "odds"])

    weights, odds = sample.repartition(1).mapInArrow(run, "weights binary, odds double").first()
    return np.frombuffer(bytes(weights), np.float32), odds


class _Scores(dict):
    """Log-odds of words, kept up to a bound."""

    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = float(self.weights[grams_of(word)].mean())
        return value


_scores: list[_Scores] = []


def _scores_of(weights: np.ndarray) -> _Scores:
    """The last model's word scores in this Python worker, which serve its next tasks too."""
    if not _scores or _scores[0].weights is not weights:
        _scores[:] = [_Scores(weights)]
    return _scores[0]


def score(documents: DataFrame, model: tuple[np.ndarray, float], text: str = "text", into: str = "score") -> DataFrame:
    """Add the probability of label 1 to every row, from its whole text.

    Null and empty texts, and those without letters or digits, get the score of the bias alone. Rows
    stay where they are; the model sent to the tasks has the fixed size ``BUCKETS``. A column
    already named as ``into`` is replaced.
    """
    sent = documents.sparkSession.sparkContext.broadcast(model)
    documents = documents.drop(into)
    body = own_name(documents, "_body")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, odds = sent.value
        get = _scores_of(weights).__getitem__
        for batch in slices(batches, body):
            out = []
            for t in batch.column(body).to_pylist():
                words = words_of(t)
                logit = odds + (sum(map(get, words)) / len(words) if words else 0.0)
                out.append(1 / (1 + np.exp(-np.clip(logit, -30, 30))))
            yield batch.drop_columns([body]).append_column(into, pa.array(out, pa.float64()))

    return with_arrow(documents.withColumn(body, quoted(text)), run, [body], into, "double")


def held_out(key: Column) -> Column:
    """Whether a row is kept from training: the CRC-32 of its key as text is divisible by 5."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))
