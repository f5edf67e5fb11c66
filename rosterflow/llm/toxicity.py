"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A document's features are the hashed character n-grams of its words that occur in it, each
counted once. The ratio of a feature compares how many toxic and how many other labelled
training documents have it; the counts cover every such document and are summed by Spark in
vectors of fixed length. The weights over the scaled features are fitted in numpy on a
bounded sample. Scoring multiplies both into one number per feature.

Null and empty texts have no features and get the score of the bias. Nothing but the text
enters a score. Documents keep all their columns; ``score`` replaces a column of that name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.llm import arrays
from rosterflow.llm.learning import sample_texts, training_labels


#: Tasks whose counts are added up at a time.
TOGETHER = 32


@dataclass(frozen=True)
class Settings:
    """``sample_rows`` and ``sample_bytes`` bound what the weights are fitted on."""

    sample_rows: int = 2000
    sample_bytes: int = 200_000
    bits: int = 18
    grams: range = range(4, 6)
    smoothing: float = 1.0
    penalty: float = 1e-3
    steps: int = 120
    rate: float = 0.1


@dataclass(frozen=True)
class Model:
    table: np.ndarray
    bias: float
    settings: Settings


def features(texts: arrays.Texts, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of every text, in order of texts, and the bounds of each text."""
    words = arrays.Words(texts, arrays.SPACED, fold=True)
    sample, inverse = arrays.kinds(words.hash)
    buckets, bounds = arrays.word_grams(texts.data, words.start[sample], words.stop[sample], words.hash[sample], settings.grams, settings.bits, fold=True)
    kinds = max(len(sample), 1)
    once = distinct(words.text.astype(np.int64) * kinds + inverse)
    place, lengths = arrays.spread(bounds, once % kinds)
    keys = distinct((np.repeat(once // kinds, lengths) << settings.bits) | buckets[place])
    text = keys >> settings.bits
    return keys & ((1 << settings.bits) - 1), np.searchsorted(text, np.arange(texts.count + 1))


def distinct(keys: np.ndarray) -> np.ndarray:
    keys = np.sort(keys)
    return keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys


def document_counts(labelled: DataFrame, settings: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every bucket the number of documents of label 0 and 1 that have it; and the number of documents.

    Each task adds its documents up; the vectors, cut in chunks, are added up by chunk, first those of
    ``TOGETHER`` tasks and then the sums, so that no group grows with the number of tasks alone.
    """
    size, cut = 1 << settings.bits, 64

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have, rows, tasks = np.zeros((2, size), np.int64), np.zeros(2, np.int64), TaskContext.get().partitionId() // TOGETHER
        for batch in batches:
            for piece in arrays.slices(batch, 0):
                found, first = features(arrays.Texts(piece.column(0)), settings)
                label = piece.column(1).to_numpy()
                rows += np.bincount(label, minlength=2)
                of = np.repeat(label, np.diff(first))
                for k in (0, 1):
                    have[k] += np.bincount(found[of == k], minlength=size)
        if rows.sum():
            for k in (0, 1):
                for i, chunk in enumerate(np.split(have[k], cut)):
                    yield pa.record_batch([pa.array([tasks]), pa.array([k * cut + i], pa.int32()), pa.array([rows[k]]), pa.array([chunk.tolist()], pa.list_(pa.int64()))], ["tasks", "chunk", "rows", "have"])

    def summed(key: tuple, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, rows = np.zeros(size // cut, np.int64), 0
        for frame in frames:  # the chunk is the last part of the key
            rows += int(frame["rows"].sum())
            total += np.sum(frame["have"].tolist(), axis=0)
        yield pd.DataFrame({"chunk": [key[-1]], "rows": [rows], "have": [total]})

    schema = "chunk int, rows long, have array<long>"
    arrays.prepare(labelled.sparkSession)
    sums = labelled.select("text", "label").mapInArrow(part, f"tasks long, {schema}").groupBy("tasks", "chunk").applyInPandas(summed, schema)
    parts = sums.groupBy("chunk").applyInPandas(summed, schema).collect()
    have, rows = np.zeros((2, size)), np.zeros(2)
    for row in parts:
        k, i = divmod(row["chunk"], cut)
        have[k, i * (size // cut) : (i + 1) * (size // cut)] = row["have"]
        rows[k] = row["rows"]
    return have[0], have[1], rows


def ratios(negative: np.ndarray, positive: np.ndarray, settings: Settings) -> np.ndarray:
    """Log ratio of the smoothed, normalised counts of both classes."""
    p, q = positive + settings.smoothing, negative + settings.smoothing
    return np.log((p / p.sum()) / (q / q.sum()))


def train(texts: list[bytes], labels: list[int], scale: np.ndarray, settings: Settings) -> Model:
    """Logistic regression over the scaled features by full-batch gradient steps with moments.

    Classes are weighted alike. Without rows of both classes only the bias is set.
    """
    size = 1 << settings.bits
    share = float(np.mean(labels)) if labels else 0.0
    if not labels or share in (0.0, 1.0):
        return Model(np.zeros(size), float(np.log((share * len(labels) + 1) / ((1 - share) * len(labels) + 1))), settings)
    found, ends = [], [0]
    for at in range(0, len(texts), 100):
        buckets, first = features(arrays.Texts(pa.array(texts[at : at + 100], pa.binary())), settings)
        found.append(buckets.astype(np.int32))
        ends.extend(ends[-1] + first[1:])
    bucket, bounds = np.concatenate(found), np.asarray(ends)
    used, column = np.unique(bucket, return_inverse=True)
    value = scale[used]
    row = np.repeat(np.arange(len(texts)), np.diff(bounds))
    # an equal total length for every document would hide few words in long texts, so features are not normalised
    wanted = np.asarray(labels, float)
    cost = np.where(wanted == 1, 0.5 / share, 0.5 / (1 - share)) / len(wanted)
    weight, bias = np.zeros(len(used)), 0.0
    first, second = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    for step in range(1, settings.steps + 1):
        margin = arrays.text_sums((weight * value)[column], bounds) + bias
        wrong = (1 / (1 + np.exp(-np.clip(margin, -40, 40))) - wanted) * cost
        back = np.bincount(column, weights=wrong[row], minlength=len(used)) * value + settings.penalty * weight
        slope = np.append(back, wrong.sum())
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope * slope
        move = settings.rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        weight, bias = weight - move[:-1], bias - move[-1]
    table = np.zeros(size)
    table[used] = weight * value
    return Model(table, float(bias), settings)


def scores(column: pa.Array, model: Model) -> np.ndarray:
    buckets, first = features(arrays.Texts(column), model.settings)
    return 1 / (1 + np.exp(-np.clip(arrays.text_sums(model.table[buckets], first) + model.bias, -40, 40)))


def fit(documents: DataFrame, labels: DataFrame, settings: Settings | None = None) -> Model:
    settings = settings or Settings()
    # labels grow with the documents, so they are never broadcast
    labelled = documents.select("doc_id", "text").filter(F.col("text").isNotNull()).join(training_labels(labels, "toxic").hint("merge"), "doc_id")
    negative, positive, _ = document_counts(labelled, settings)
    texts, marks = sample_texts(documents, labels, "toxic", settings.sample_rows, settings.sample_bytes, by_label=True)
    return train(texts, marks, ratios(negative, positive, settings), settings)


def score(documents: DataFrame, model: Model, keep: tuple[str, ...] | None = None) -> DataFrame:
    """The columns of ``documents`` (or those in ``keep``) and ``score``, in one pass without a shuffle."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    return arrays.with_columns(documents, lambda column: [pa.array(scores(column, shared.value))], {"score": "double"}, keep=keep)
