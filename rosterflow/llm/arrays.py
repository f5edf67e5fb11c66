"""Words and hashes of many texts at once, as numpy arrays inside a task.

A batch of texts is one byte buffer with a separator after every text. Word bounds
come from a table over byte values, word hashes from one polynomial prefix sum. UTF-8
bytes from 0x80 on are word bytes in every word class used here, so bounds between
bytes are bounds between characters.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rosterflow.session import ship

#: Text bytes handled at a time in a task; a longer text is handled alone.
BLOCK_BYTES = 1_000_000
#: Bytes whose prefix sums are held at a time.
SPAN_BYTES = 250_000

_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _class_table(separators: bytes) -> np.ndarray:
    table = np.ones(256, bool)
    table[list(separators)] = False
    return table


#: Words are what lies between white space.
SPACED = _class_table(b"\x20\x09\x0a\x0b\x0c\x0d")
#: Words are runs of digits, lower-case letters (upper case folds) and bytes from 0x80.
ALPHANUMERIC = _class_table(bytes(b for b in range(0x80) if not chr(b).isalnum()))


@cache
def _byte_values(fold: bool) -> np.ndarray:
    values = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    if fold:
        values[65:91] = values[97:123]
    return values


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(size, _MULTIPLIER), np.full(size, _INVERSE)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of a 64-bit value over all others."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def slices(batch: pa.RecordBatch, column: int, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about ``limit`` bytes of text each."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths, dtype=np.int64)
    row = 0
    while row < batch.num_rows:
        base = ends[row - 1] if row else 0
        stop = max(row + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield batch.slice(row, stop - row)
        row = stop


def regular_slices(batches: Iterator[pa.RecordBatch], column: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Consecutive rows with at most ``limit`` bytes of text, or one row of more.

    The bounds depend on the rows alone and not on how they were cut into batches, which
    other columns of a row may change.
    """
    held, size = [], 0
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends, row = np.cumsum(lengths, dtype=np.int64), 0
        while row < batch.num_rows:
            base = int(ends[row - 1]) if row else 0
            stop = max(int(np.searchsorted(ends, base + limit - size, "right")), row if held else row + 1)
            if stop > row:
                held.append(batch.slice(row, stop - row))
                size += int(ends[stop - 1]) - base
                row = stop
            if row < batch.num_rows:
                yield pa.concat_batches(held)
                held, size = [], 0
    if held:
        yield pa.concat_batches(held)


class Texts:
    """Byte buffer of a column of texts; null is empty. Text ``i`` is ``data[start[i]:stop[i]]``."""

    def __init__(self, column: pa.Array, separator: bytes = b" "):
        parts = [b"" if v is None else v for v in column.cast(pa.binary()).to_pylist()]
        self.raw = separator.join(parts) + separator
        self.data = np.frombuffer(self.raw, np.uint8)
        lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        self.stop = np.cumsum(lengths + 1) - 1
        self.start = self.stop - lengths
        self.count = len(parts)


class Words:
    """Words of texts: byte bounds, hash, and the first word of each text (``first[i]:first[i + 1]``)."""

    def __init__(self, texts: Texts, table: np.ndarray, fold: bool):
        word = np.zeros(len(texts.data) + 1, np.int8)
        word[1:] = table[texts.data]
        word[texts.stop + 1] = 0
        step = np.diff(word)
        self.start = np.flatnonzero(step == 1)
        self.stop = np.flatnonzero(step == -1)
        self.hash = span_hashes(texts.data, self.start, self.stop, fold)
        self.first = np.append(np.searchsorted(self.start, texts.start), len(self.start))
        self.counts = np.diff(self.first)
        self.text = np.repeat(np.arange(texts.count), self.counts)


def span_hashes(data: np.ndarray, start: np.ndarray, stop: np.ndarray, fold: bool) -> np.ndarray:
    """64-bit hash of each byte span; spans are ordered and do not overlap."""
    values, out = _byte_values(fold), np.empty(len(start), np.uint64)
    row = 0
    while row < len(start):
        low = start[row]
        end = max(row + 1, int(np.searchsorted(stop, low + SPAN_BYTES, "right")))
        high = stop[end - 1]
        size = 1 << max(10, int(high - low).bit_length())
        up, down = _powers(size)
        total = np.zeros(high - low + 1, np.uint64)
        np.cumsum(values[data[low:high]] * up[: high - low], out=total[1:])
        at, to = start[row:end] - low, stop[row:end] - low
        out[row:end] = mix((total[to] - total[at]) * down[at])
        row = end
    return out


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive values, whatever text they belong to."""
    if len(hashes) < width:
        return np.empty(0, np.uint64)
    last = len(hashes) - width + 1
    out = np.zeros(last, np.uint64)
    for k in range(width):
        out *= _MULTIPLIER
        out += hashes[k : k + last]
    return mix(out)


def inside(texts: np.ndarray, width: int) -> np.ndarray:
    """Positions whose run of ``width`` words stays in one text."""
    if len(texts) < width:
        return np.empty(0, np.int64)
    return np.flatnonzero(texts[: len(texts) - width + 1] == texts[width - 1 :])


def text_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of the values of each text, ``first`` bounding them."""
    total = np.zeros(len(values) + 1, np.result_type(values.dtype, np.int64) if values.dtype.kind in "bi" else np.float64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def byte_sums(flags: np.ndarray, texts: Texts) -> np.ndarray:
    """Number of set flags among the bytes of each text."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[texts.stop] - total[texts.start]


def keyed_by_text(hashes: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """The hashes, told apart by text, so that one sort finds repeats inside each text."""
    return mix(hashes ^ mix(texts.astype(np.uint64) + np.uint64(1)))


def joined(data: np.ndarray, start: np.ndarray, stop: np.ndarray, before: int, after: int) -> tuple[np.ndarray, np.ndarray]:
    """The spans one after another, each between two marker bytes; and the bounds of each."""
    lengths = stop - start + 2
    first = np.concatenate([[0], np.cumsum(lengths)])
    source = np.arange(first[-1]) + np.repeat(start - 1 - first[:-1], lengths)
    out = data[np.clip(source, 0, len(data) - 1)]
    out[first[:-1]] = before
    out[first[1:] - 1] = after
    return out, first


def word_grams(data: np.ndarray, start: np.ndarray, stop: np.ndarray, whole: np.ndarray, sizes: range, bits: int, fold: bool) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the character n-grams of each word, with ``<`` and ``>`` around it, and of its hash ``whole``.

    Returns the buckets and the first one of each word, as bounds.
    """
    if not len(start):
        return np.empty(0, np.int64), np.zeros(1, np.int64)
    spelled, first = joined(data, start, stop, 0x3C, 0x3E)
    if fold:
        upper = (spelled >= 65) & (spelled <= 90)
        spelled = spelled + (upper.astype(np.uint8) << 5)
    heads = np.concatenate([[0], np.cumsum((spelled & 0xC0) != 0x80)])
    first = heads[first]
    points = np.frombuffer(spelled.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    if len(points) != first[-1]:  # not UTF-8: take bytes for characters
        points, first = spelled, np.concatenate([[0], np.cumsum(stop - start + 2)])
    points = mix(points.astype(np.uint64) + np.uint64(1))
    lengths = np.diff(first)
    word = np.repeat(np.arange(len(start)), lengths)
    left = np.repeat(first[1:], lengths) - np.arange(len(points))
    owners, found, gram = [], [], np.zeros(len(points), np.uint64)
    padded = np.concatenate([points, np.zeros(sizes.stop, np.uint64)])
    for n in range(1, sizes.stop):
        gram *= _MULTIPLIER
        gram += padded[n - 1 : n - 1 + len(points)]
        if n in sizes:
            at = np.flatnonzero(left >= n)
            owners.append(word[at])
            found.append(mix(gram[at] + np.uint64(n)) >> np.uint64(64 - bits))
    owners.append(np.arange(len(start)))
    found.append(mix(whole + np.uint64(99)) >> np.uint64(64 - bits))
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    bounds = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(start)))])
    return np.concatenate(found).astype(np.int64)[order], bounds


def kinds(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct key, in key order, and the number of its key for every place."""
    order = np.argsort(keys)
    held = keys[order]
    new = np.concatenate([[True], held[1:] != held[:-1]])[: len(keys)]
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], number


def spread(first: np.ndarray, picked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all members of the picked groups, in order, and how many each has."""
    lengths = first[picked + 1] - first[picked]
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(first[picked] - ends + lengths, lengths), lengths


def prepare(spark: SparkSession) -> None:
    """Make a session fit for the functions that run in its tasks.

    Workers get this package, and the bytes of the batches that tasks are given are bounded
    where the session does not bound them: rows of long texts add up.
    """
    ship(spark)
    if spark.conf.get(_BATCH_BYTES, None) is None:
        spark.conf.set(_BATCH_BYTES, str(8 << 20))


def with_columns(
    frame: DataFrame,
    compute: Callable[[pa.Array], list[pa.Array]],
    added: dict[str, str],
    column: str = "text",
    keep: tuple[str, ...] | None = None,
    limit: int = BLOCK_BYTES,
) -> DataFrame:
    """``frame`` with the columns that ``compute`` makes of a text column, in one pass without a shuffle.

    ``added`` has their names and types; they replace columns of the same names. ``keep``
    names the columns to go on with, all of them if it is not given. ``limit`` is about the
    number of text bytes that ``compute`` is given at a time.
    """
    prepare(frame.sparkSession)
    given = frame.drop(*(name for name in added if name != column)).withColumn(column, F.col(column).cast("string"))
    names = [c for c in given.columns if (keep is None or c in keep) and c not in added]
    at = given.columns.index(column)
    places = [given.columns.index(c) for c in names]

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, at, limit):
                columns = [*(piece.column(i) for i in places), *compute(piece.column(at))]
                yield pa.RecordBatch.from_arrays(columns, [*names, *added])

    new = StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind in added.items()))
    return given.mapInArrow(part, StructType([*given.select(*names).schema, *new]))


def where(documents: DataFrame, judge: Callable[[DataFrame], DataFrame], condition: Column) -> DataFrame:
    """The rows for which ``condition`` holds over what ``judge`` adds, with the given columns whatever their names.

    ``judge`` is given the text and nothing else by its name.
    """
    names = {c: "text" if c == "text" else f"given_{i}" for i, c in enumerate(documents.columns)}
    judged = judge(documents.withColumnsRenamed(names)).filter(condition)
    return judged.select(*(F.col(held).alias(c) for c, held in names.items()))
