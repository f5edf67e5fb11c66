"""Quality rules: gradient-boosted trees over document statistics.

The statistics of a batch of texts are computed together in numpy. Trees are grown in numpy
on a bounded sample of labelled rows, over quantile bins, with logistic loss; on chosen
statistics a split may only move the score in the given direction, and the bounds of a split
hold for everything below it, so the whole score is monotonic in them. The trees are then
flattened into node arrays, and a batch walks all trees one level at a time.

Null and empty texts have no words: all counts are 0 and they fail the base rule. The
operator's columns replace columns of the same names; all others are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.llm import arrays
from rosterflow.llm.learning import training_labels

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Statistics the trees see, and the direction in which each may move the score (0: either).
STATISTICS = {
    "log_words": 0,
    "mean_word_chars": 0,
    "symbols_per_word": -1,
    "dup_line_share": -1,
    "repeat_word_share": -1,
    "upper_share": 0,
    "digit_share": 0,
    "distinct_word_share": 0,
    "same_as_previous_share": -1,
    "words_per_line": 0,
    "punctuation_share": 0,
    "wide_char_share": 0,
}


@dataclass(frozen=True)
class Settings:
    """``sample_rows`` bounds what the trees are grown on."""

    sample_rows: int = 20_000
    trees: int = 60
    depth: int = 4
    bins: int = 64
    rate: float = 0.2
    penalty: float = 1.0
    least_rows: int = 5
    least_gain: float = 1e-3
    threshold: float = 0.5


@dataclass(frozen=True)
class Trees:
    """Flattened nodes of all trees: leaves point to themselves. ``roots`` has the first node of each tree."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    bias: float

    def margin(self, rows: np.ndarray) -> np.ndarray:
        node = np.repeat(self.roots[None, :], len(rows), 0)
        line = np.arange(len(rows))[:, None]
        for _ in range(self.depth):
            node = np.where(rows[line, self.feature[node]] <= self.cut[node], self.left[node], self.right[node])
        return self.value[node].sum(1) + self.bias

    def probability(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(rows), -40, 40)))


def statistics(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The base counts (``COUNTS``) and the statistics of each text, one row per text."""
    texts = arrays.Texts(column)
    words = arrays.Words(texts, arrays.SPACED, fold=False)
    data = texts.data
    head = (data & 0xC0) != 0x80
    spaced = ~arrays.SPACED[data]
    chars = arrays.byte_sums(head & ~spaced, texts)
    flags = np.zeros(256, bool)
    flags[list(SYMBOLS)] = True
    symbols = arrays.byte_sums(flags[data], texts)
    upper = arrays.byte_sums((data >= 65) & (data <= 90), texts)
    digits = arrays.byte_sums((data >= 48) & (data <= 57), texts)
    marks = np.zeros(256, bool)
    marks[list(b".,;:!?'\"()-")] = True
    punctuation = arrays.byte_sums(marks[data], texts)
    wide = arrays.byte_sums(head & (data >= 0x80), texts)

    # words in windows that the text has twice or more
    at = arrays.inside(words.text, WINDOW)
    windows = arrays.keyed_by_text(arrays.window_hashes(words.hash, WINDOW)[at], words.text[at])
    steps = np.zeros(len(words.hash) + 1, np.int64)
    found = at[_repeated(windows)]
    np.add.at(steps, found, 1)
    np.add.at(steps, found + WINDOW, -1)
    repeated = arrays.text_sums(np.cumsum(steps[:-1]) > 0, words.first)

    # lines with a word that equal an earlier one
    ends = np.flatnonzero(data == 10)
    bounds = np.unique(np.concatenate([ends, texts.stop]))
    begin = np.concatenate([[0], bounds[:-1] + 1])
    has = np.searchsorted(words.start, bounds) > np.searchsorted(words.start, begin)
    begin, stop = begin[has], bounds[has]
    line_text = np.searchsorted(texts.stop, begin)
    lines = np.bincount(line_text, minlength=texts.count)
    keys = arrays.keyed_by_text(arrays.span_hashes(data, begin, stop, fold=False), line_text)
    sample, _ = arrays.kinds(keys)
    dup_lines = lines - np.bincount(line_text[sample], minlength=texts.count)

    sample, _ = arrays.kinds(arrays.keyed_by_text(words.hash, words.text))
    distinct = np.bincount(words.text[sample], minlength=texts.count)
    same = np.zeros(len(words.hash), bool)
    same[1:] = (words.hash[1:] == words.hash[:-1]) & (words.text[1:] == words.text[:-1])
    same = arrays.text_sums(same, words.first)

    count = words.counts
    per_word, per_char, per_line = np.maximum(count, 1), np.maximum(chars, 1), np.maximum(lines, 1)
    base = np.stack([count, chars, symbols, dup_lines, repeated], 1).astype(np.int64)
    rows = np.stack(
        [np.log1p(count), chars / per_word, symbols / per_word, dup_lines / per_line, repeated / per_word, upper / per_char, digits / per_char]
        + [distinct / per_word, same / per_word, count / per_line, punctuation / per_char, wide / per_char],
        1,
    )
    return base, rows


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Places whose key occurs at another place too."""
    order = np.argsort(keys)
    held = keys[order]
    equal = held[1:] == held[:-1]
    twice = np.zeros(len(keys), bool)
    twice[:-1] |= equal
    twice[1:] |= equal
    return order[twice]


def grow(rows: np.ndarray, labels: np.ndarray, settings: Settings) -> Trees:
    """Boosted trees; without rows of both classes a single leaf with the labels' share."""
    total, ones = len(labels), int(np.sum(labels))
    bias = float(np.log((ones + 0.5) / (total - ones + 0.5)))
    if not 0 < ones < total:
        leaf = np.zeros(1, np.int64)
        return Trees(leaf, np.zeros(1), leaf, leaf, np.zeros(1), leaf, 0, bias)
    cuts = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, settings.bins + 1)[1:-1])) for f in range(rows.shape[1])]
    binned = np.stack([np.searchsorted(c, rows[:, f], "left") for f, c in enumerate(cuts)], 1)
    direction = list(STATISTICS.values()) if rows.shape[1] == len(STATISTICS) else [0] * rows.shape[1]
    nodes: list[list[float]] = []
    roots, margin = [], np.full(total, bias)
    for _ in range(settings.trees):
        chance = 1 / (1 + np.exp(-margin))
        slope, bend = labels - chance, chance * (1 - chance)
        roots.append(len(nodes))
        _grow(nodes, binned, cuts, direction, slope, bend, np.arange(total), margin, -np.inf, np.inf, settings.depth, settings)
    feature, cut, left, right, value = (np.array(v) for v in zip(*nodes, strict=True))
    return Trees(feature.astype(np.int64), cut, left.astype(np.int64), right.astype(np.int64), value, np.array(roots), settings.depth, bias)


def _grow(nodes, binned, cuts, direction, slope, bend, rows, margin, low, high, depth, settings) -> int:
    """Adds a subtree to ``nodes`` and its values to ``margin``; a leaf's value stays within ``low`` and ``high``."""
    number, (g, h) = len(nodes), (slope[rows].sum(), bend[rows].sum())
    worth = float(np.clip(g / (h + settings.penalty), low, high))
    nodes.append([0, 0.0, number, number, settings.rate * worth])
    best = (settings.least_gain, None)
    if depth and len(rows) >= 2 * settings.least_rows:
        for f, c in enumerate(cuts):
            if not len(c):
                continue
            bins = binned[rows, f]
            gl = np.cumsum(np.bincount(bins, slope[rows], len(c) + 1))[:-1]
            hl = np.cumsum(np.bincount(bins, bend[rows], len(c) + 1))[:-1]
            nl = np.cumsum(np.bincount(bins, minlength=len(c) + 1))[:-1]
            wl = np.clip(gl / (hl + settings.penalty), low, high)
            wr = np.clip((g - gl) / (h - hl + settings.penalty), low, high)
            gain = _profit(gl, hl, wl, settings) + _profit(g - gl, h - hl, wr, settings) - _profit(g, h, worth, settings)
            allowed = (nl >= settings.least_rows) & (len(rows) - nl >= settings.least_rows) & (direction[f] * (wr - wl) >= 0)
            gain = np.where(allowed, gain, -np.inf)
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (float(gain[k]), (f, k, float(wl[k]), float(wr[k])))
    if best[1] is None:
        margin[rows] += settings.rate * worth
        return number
    f, k, wl, wr = best[1]
    lower = binned[rows, f] <= k
    middle = (wl + wr) / 2
    bounds = {0: (low, high, low, high), 1: (low, middle, middle, high), -1: (middle, high, low, middle)}[direction[f]]
    down = (binned, cuts, direction, slope, bend)
    a = _grow(nodes, *down, rows[lower], margin, bounds[0], bounds[1], depth - 1, settings)
    b = _grow(nodes, *down, rows[~lower], margin, bounds[2], bounds[3], depth - 1, settings)
    nodes[number] = [f, float(cuts[f][k]), a, b, 0.0]
    return number


def _profit(g, h, w, settings):
    """What a leaf of value ``w`` gains over one of 0."""
    return 2 * g * w - (h + settings.penalty) * w * w


def _measured(column: pa.Array) -> list[pa.Array]:
    base, rows = statistics(column)
    flat = pa.array(rows.ravel(), pa.float64())
    return [*(pa.array(c) for c in base.T), pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * rows.shape[1], pa.int32()), flat)]


def fit(documents: DataFrame, labels: DataFrame, settings: Settings | None = None) -> Trees:
    """Trees grown on at most ``sample_rows`` labelled training documents, chosen by a hash of their id.

    Only the statistics of the sample reach the driver.
    """
    settings = settings or Settings()
    chosen = training_labels(labels, "quality").orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.sample_rows)
    picked = documents.select("doc_id", "text").filter(F.col("text").isNotNull()).join(F.broadcast(chosen), "doc_id")
    measured = arrays.with_columns(picked, _measured, dict.fromkeys(COUNTS, "long") | {"statistics": "array<double>"}, keep=("doc_id", "label"))
    table = measured.orderBy(F.xxhash64("doc_id"), "doc_id", *COUNTS).limit(settings.sample_rows).select("statistics", "label").toArrow()
    rows = np.array(table.column("statistics").to_pylist(), float).reshape(-1, len(STATISTICS))
    return grow(rows, np.array(table.column("label").to_pylist(), float), settings)


def judge(documents: DataFrame, trees: Trees, settings: Settings | None = None, keep: tuple[str, ...] | None = None) -> DataFrame:
    """The columns of ``documents`` (or those in ``keep``), the base counts, ``base_failed``, ``score`` and ``kept``.

    A document is kept if it passes the base rule and the trees give it at least the threshold.
    """
    settings = settings or Settings()
    shared = documents.sparkSession.sparkContext.broadcast(trees)

    def compute(column: pa.Array) -> list[pa.Array]:
        base, rows = statistics(column)
        return [*(pa.array(c) for c in base.T), pa.array(shared.value.probability(rows))]

    counted = arrays.with_columns(documents.drop("base_failed", "kept"), compute, dict.fromkeys(COUNTS, "long") | {"score": "double"}, keep=keep)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    return counted.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("score") >= settings.threshold))
