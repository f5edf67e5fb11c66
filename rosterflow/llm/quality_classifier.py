"""Quality classifier: supervised subword embeddings.

A document is the average of learned vectors of its words and of the character n-grams
inside them, all hashed into one table; a softmax over the average gives the score.
The table and the output layer are trained by stochastic gradient descent in numpy on a
bounded sample of labelled rows. Scoring needs only the product of both, one number per
bucket, since an average of vectors times the output layer is an average of products.

Null and empty texts have no features and get the score of the output layer's bias.
Nothing but the text enters a score. Documents keep all their columns; the operator's own
columns replace columns of the same name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rosterflow.llm import arrays
from rosterflow.llm.learning import sample_texts


@dataclass(frozen=True)
class Settings:
    """``sample_rows`` and ``sample_bytes`` bound what is learnt from."""

    sample_rows: int = 2500
    sample_bytes: int = 200_000
    bits: int = 17
    width: int = 8
    grams: range = range(3, 6)
    epochs: int = 4
    rate: float = 2.0
    seed: int = 11


@dataclass(frozen=True)
class Model:
    """``table`` is the margin of label 1 that each bucket adds to the average."""

    table: np.ndarray
    bias: float
    settings: Settings


class _Features:
    """Buckets of the distinct words of a batch and the word number of every token.

    A word that repeats the one before it counts as one more, artificial word, so that
    runs of one word are seen whatever the word is.
    """

    def __init__(self, texts: arrays.Texts, settings: Settings):
        words = arrays.Words(texts, arrays.SPACED, fold=False)
        sample, inverse = arrays.kinds(words.hash)
        self.buckets, self.bounds = arrays.word_grams(texts.data, words.start[sample], words.stop[sample], words.hash[sample], settings.grams, settings.bits, fold=False)
        self.bounds = np.append(self.bounds, self.bounds[-1] + 1)
        self.buckets = np.append(self.buckets, 0)
        token, text = inverse, words.text
        again = np.flatnonzero((token[1:] == token[:-1]) & (text[1:] == text[:-1])) + 1
        token, text = np.concatenate([token, np.full(len(again), len(sample))]), np.concatenate([text, text[again]])
        order = np.argsort(text, kind="stable")
        self.token = token[order]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=texts.count))])


def _softmax_margin(margin):
    return 1.0 / (1.0 + np.exp(-np.clip(margin, -40, 40)))


def train(texts: list[bytes], labels: list[int], settings: Settings) -> Model:
    """Stochastic gradient descent over documents with a falling rate; classes are weighted alike.

    Without rows of both classes the model knows only the share of label 1.
    """
    size, share = 1 << settings.bits, float(np.mean(labels)) if labels else 0.5
    if not labels or share in (0.0, 1.0):
        return Model(np.zeros(size), float(np.log((share * len(labels) + 1) / ((1 - share) * len(labels) + 1))), settings)
    rows, wanted = [], np.asarray(labels)
    for at in range(0, len(texts), 200):
        found = _Features(arrays.Texts(pa.array(texts[at : at + 200], pa.binary())), settings)
        for i in range(len(found.first) - 1):
            token, count = np.unique(found.token[found.first[i] : found.first[i + 1]], return_counts=True)
            place, lengths = arrays.spread(found.bounds, token)
            bucket, back = np.unique(found.buckets[place], return_inverse=True)
            weight = np.bincount(back, weights=np.repeat(count, lengths), minlength=len(bucket))
            rows.append((bucket.astype(np.int32), (weight / max(weight.sum(), 1)).astype(np.float32)))
    random = np.random.default_rng(settings.seed)
    vectors = random.uniform(-1, 1, (size, settings.width)).astype(np.float32) / settings.width
    output, bias = np.zeros((settings.width, 2), np.float32), np.zeros(2, np.float32)
    steps, step = settings.epochs * len(rows), 0
    cost = np.where(wanted == 1, 0.5 / share, 0.5 / (1 - share))
    for _ in range(settings.epochs):
        for i in random.permutation(len(rows)):
            bucket, weight = rows[i]
            rate = settings.rate * (1 - step / steps) * cost[i]
            step += 1
            average = weight @ vectors[bucket]
            logits = average @ output + bias
            logits = np.exp(logits - logits.max())
            wrong = logits / logits.sum()
            wrong[wanted[i]] -= 1
            back = output @ wrong
            output -= (0.1 * rate) * np.outer(average, wrong)
            bias -= (0.1 * rate) * wrong
            # every bucket takes the step of its share of the average, scaled up for its small weight
            vectors[bucket] -= rate * np.outer(np.minimum(weight * 50, 1), back)
    # the classes were weighted alike; the bias puts the labels' share back
    shift = np.log(share / (1 - share))
    return Model((vectors @ (output[:, 1] - output[:, 0])).astype(np.float64), float(bias[1] - bias[0] + shift), settings)


def scores(column: pa.Array, model: Model) -> np.ndarray:
    """Probability of label 1 for each text."""
    found = _Features(arrays.Texts(column), model.settings)
    sums = arrays.text_sums(model.table[found.buckets], found.bounds)
    counts = np.diff(found.bounds)
    total = arrays.text_sums(sums[found.token], found.first)
    weight = arrays.text_sums(counts[found.token], found.first)
    return _softmax_margin(total / np.maximum(weight, 1) + model.bias)


def fit(documents: DataFrame, labels: DataFrame, settings: Settings | None = None) -> Model:
    settings = settings or Settings()
    return train(*sample_texts(documents, labels, "quality", settings.sample_rows, settings.sample_bytes), settings)


def score(documents: DataFrame, model: Model, keep: tuple[str, ...] | None = None) -> DataFrame:
    """The columns of ``documents`` (or those in ``keep``) and ``score``, in one pass without a shuffle."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    return arrays.with_columns(documents, lambda column: [pa.array(scores(column, shared.value))], {"score": "double"}, keep=keep)
