"""Phrases whose words come together far more often than apart, by weighted acyclic transducers.

Words are counted first, by a plain shuffled aggregate. Then, for two and for three words:

1. Each shard of texts sorts its distinct n-grams and builds their transducer from them: an n-gram
   opens new states from the first word on in which it differs from the one before, and its count
   is the weight of its last state (:class:`Transducer`).
2. Shards cut their transducers at common bounds and send each part to its prefix range. A range
   unites the parts: their words get common numbers, equal paths become one, weights add up.
   Bounds are pairs of words at even shares of all words, so that the n-grams of one very common
   word lie in many ranges.
3. An n-gram can only be frequent if both of its parts of one word less are. A bit array over the
   frequent ones, of a bounded size, is sent to all tasks: it never leaves out a frequent n-gram, and
   whatever it lets through is counted exactly.

The counts of the parts of candidates are looked up by composing, in every prefix range, the
transducer of the wanted parts with that of the counts: both are walked from word to word together.

A null language is ``und``; null and empty texts have no words. Repeated rows count again, and
columns other than ``text`` and ``lang`` are not looked at. A text of any length is one text of its
shard. An empty table gives no phrases. Scores are integer quotients of exact decimals.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterflow.llm import arrays
from rosterflow.llm.bits import bit_array, contains
from rosterflow.session import materialise

#: Least occurrences of a candidate, words of the longest one, and phrases returned for each language.
LEAST, LONGEST, TOP = 10, 3, 2000
#: A candidate within a longer one that has at least so many percent of its occurrences is dropped.
PERCENT = 50
#: Bytes of text in a shard, and occurrences of words in a prefix range, about.
SHARD_BYTES, RANGE_WORDS = 8_000_000, 1_000_000
#: Words sampled for each bound of a range.
SAMPLES = 16
#: Parts that a language's candidates are ranked in before their best are ranked together.
RANK_PARTS = 64

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_STOP = np.zeros(256, bool)
_STOP[list(b".,;:!?\x0a\x0b\x0c\x0d")] = True
_WORD = ~_STOP
_WORD[list(b" \t")] = False

Bound = tuple[bytes, bytes, bytes]


def _language_hash(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(blake2b(lang.encode(), digest_size=8).digest(), "little"))


def _numbered(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The distinct words in order, and the number of each given word among them."""
    coded = words.dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy(zero_copy_only=False)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return coded.dictionary.take(pa.array(order)), rank[coded.indices.to_numpy(zero_copy_only=False)]


def _word_hashes(words: pa.Array) -> np.ndarray:
    if not len(words):
        return np.empty(0, np.uint64)
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    return arrays.span_hashes(np.frombuffer(words.buffers()[2], np.uint8), offsets[:-1], offsets[1:], fold=False)


def _follow(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return arrays.mix(before * np.uint64(0x9E3779B97F4A7C15) + word)


class Shard:
    """Words of some texts, numbered in order: ``ids``, ``lang`` (a code) and ``piece`` of each occurrence."""

    def __init__(self, texts: pa.Array, langs: pa.Array):
        held = arrays.Texts(texts, b"\n")
        data = _FOLD[held.data]
        word = np.zeros(len(data) + 1, np.int8)
        word[1:] = _WORD[data]
        step = np.diff(word)
        start = np.flatnonzero(step == 1)  # the last byte is a stop, so that every word ends
        stop = np.flatnonzero(step == -1)
        offsets = np.concatenate([[0], np.cumsum(stop - start)]).astype(np.int32)
        spelled = pa.BinaryArray.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(data[word[1:].astype(bool)])])
        self.lexicon, self.ids = _numbered(spelled)
        self.piece = np.searchsorted(np.flatnonzero(_STOP[data]), start)
        coded = langs.cast(pa.string()).fill_null("und").dictionary_encode()
        self.langs = coded.dictionary.to_pylist()
        self.lang = coded.indices.to_numpy(zero_copy_only=False)[np.searchsorted(held.stop, start)]

    def hashes(self) -> np.ndarray:
        salts = np.array([_language_hash(lang) for lang in self.langs], np.uint64)
        return arrays.mix(_word_hashes(self.lexicon)[self.ids] ^ salts[self.lang])

    def together(self, size: int) -> np.ndarray:
        """Whether ``size`` words from each place on lie in one piece."""
        return self.piece[: len(self.piece) - size + 1] == self.piece[size - 1 :]

    def wanted(self, size: int, bits: np.ndarray) -> np.ndarray:
        """Places of the n-grams whose parts of one word less may both be frequent."""
        if len(self.ids) < size:
            return np.empty(0, np.int64)
        hashes = self.hashes()
        parts = hashes
        for k in range(1, size - 1):
            parts = _follow(parts[: len(hashes) - k], hashes[k:])
        maybe = contains(bits, parts)
        return np.flatnonzero(self.together(size) & maybe[:-1] & maybe[1:])


def _path_keys(columns: list[np.ndarray]) -> np.ndarray:
    """A number for each path, in the order of paths."""
    key = columns[0]
    for k, column in enumerate(columns[1:]):
        if k:
            key = np.unique(key, return_inverse=True)[1]
        key = (key << 32) | column
    return key


class Transducer:
    """Acyclic automaton of word paths of one length, each with the weight of its last state.

    ``labels[d]`` has the word of every state at depth ``d``, in the order of paths, and
    ``arcs[d]`` the number of states that follow it.
    """

    def __init__(self, lexicon: pa.Array, labels: list[np.ndarray], arcs: list[np.ndarray], weights: np.ndarray):
        self.lexicon, self.labels, self.arcs, self.weights = lexicon, labels, arcs, weights

    @classmethod
    def build(cls, lexicon: pa.Array, paths: list[np.ndarray], weights: np.ndarray) -> Transducer:
        """From sorted distinct paths: each opens states from where it differs from the one before."""
        used, local = np.unique(np.concatenate(paths), return_inverse=True)
        paths = np.split(local, len(paths))
        labels, arcs, opened = [], [], np.zeros(len(weights), bool)
        opened[:1] = True
        heads = []
        for column in paths:
            opened = opened.copy()
            opened[1:] |= column[1:] != column[:-1]
            heads.append(np.flatnonzero(opened))
            labels.append(column[heads[-1]])
        for upper, lower in zip(heads, heads[1:], strict=False):
            arcs.append(np.diff(np.searchsorted(lower, np.append(upper, len(weights)))))
        return cls(lexicon.take(pa.array(used)), labels, arcs, weights)

    def paths(self) -> list[np.ndarray]:
        columns = [self.labels[-1]]
        for depth in range(len(self.arcs) - 1, -1, -1):
            width = self.arcs[depth]
            for lower in self.arcs[depth + 1 :]:
                ends = np.concatenate([[0], np.cumsum(lower)])
                bounds = np.concatenate([[0], np.cumsum(width)])
                width = ends[bounds[1:]] - ends[bounds[:-1]]
            columns.insert(0, np.repeat(self.labels[depth], width))
        return columns

    def to_bytes(self) -> bytes:
        texts = self.lexicon.cast(pa.binary())
        lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        out = [np.frombuffer(b"".join(texts.to_pylist()), np.uint8), lengths, *self.labels, *self.arcs, self.weights]
        parts = [np.int64(len(self.labels)).tobytes()]
        for values in out:
            short = values.astype(np.min_scalar_type(int(values.max()))) if len(values) else values.astype(np.uint8)
            parts += [np.array([short.itemsize, len(short)], np.int64).tobytes(), short.tobytes()]
        raw = b"".join(parts)
        return np.int64(len(raw)).tobytes() + pa.compress(raw, codec="zstd", asbytes=True)

    @classmethod
    def from_bytes(cls, packed: bytes) -> Transducer:
        raw = pa.decompress(packed[8:], int(np.frombuffer(packed, np.int64, 1)[0]), codec="zstd", asbytes=True)
        depth, at, found = int(np.frombuffer(raw, np.int64, 1)[0]), 8, []
        while at < len(raw):
            size, count = (int(x) for x in np.frombuffer(raw, np.int64, 2, at))
            found.append(np.frombuffer(raw, f"u{size}", count, at + 16))
            at += 16 + size * count
        offsets = np.concatenate([[0], np.cumsum(found[1], dtype=np.int64)]).astype(np.int32)
        lexicon = pa.BinaryArray.from_buffers(pa.binary(), len(found[1]), [None, pa.py_buffer(offsets), pa.py_buffer(found[0].tobytes())])
        rest = [v.astype(np.int64) for v in found[2:]]
        return cls(lexicon, rest[:depth], rest[depth:-1], rest[-1])


def united(parts: list[Transducer]) -> Transducer:
    """One transducer of all paths, with the sums of their weights."""
    lexicon, ids = _numbered(pa.concat_arrays([p.lexicon for p in parts]))
    firsts = np.concatenate([[0], np.cumsum([len(p.lexicon) for p in parts])])
    columns = [np.concatenate(c) for c in zip(*([ids[first + column] for column in p.paths()] for first, p in zip(firsts, parts, strict=False)), strict=True)]
    key = _path_keys(columns)
    order = np.argsort(key, kind="stable")
    heads = np.flatnonzero(np.concatenate([[True], np.diff(key[order]) != 0]))
    weights = np.add.reduceat(np.concatenate([p.weights for p in parts])[order], heads)
    return Transducer.build(lexicon, [c[order][heads] for c in columns], weights)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in arrays.regular_slices(batches, 1, SHARD_BYTES):
        shard = Shard(batch.column(1), batch.column(0))
        for code, lang in enumerate(shard.langs):
            counts = np.bincount(shard.ids[shard.lang == code], minlength=len(shard.lexicon))
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), shard.lexicon.take(pa.array(some)).cast(pa.string()), pa.array(counts[some])], ["lang", "phrase", "f"])


def _cuts(lexicon: list[bytes], bounds: list[Bound]) -> np.ndarray:
    """The bounds as pairs of word numbers."""
    out = []
    for _, first, second in bounds:
        at = bisect_left(lexicon, first)
        out.append((at << 32) | (bisect_left(lexicon, second) if at < len(lexicon) and lexicon[at] == first else 0))
    return np.array(out, np.int64)


def _shard_parts(batches: Iterator[pa.RecordBatch], size: int, bits: np.ndarray, bounds: list[Bound]) -> Iterator[pa.RecordBatch]:
    for batch in arrays.regular_slices(batches, 1, SHARD_BYTES):
        shard = Shard(batch.column(1), batch.column(0))
        places = shard.wanted(size, bits)
        spelled = shard.lexicon.to_pylist()
        for code, lang in enumerate(shard.langs):
            here = places[shard.lang[places] == code]
            if not len(here):
                continue
            columns = [shard.ids[here + k] for k in range(size)]
            _, at, weights = np.unique(_path_keys(columns), return_index=True, return_counts=True)
            paths = [c[at] for c in columns]
            low, high = (bisect_left(bounds, (lang.encode() + end, b"", b"")) for end in (b"", b"\0"))
            cuts = np.searchsorted((paths[0] << 32) | paths[1], _cuts(spelled, bounds[low:high]))
            ends = np.concatenate([[0], cuts, [len(weights)]])
            for k, (begin, end) in enumerate(zip(ends, ends[1:], strict=False)):
                if begin < end:
                    part = Transducer.build(shard.lexicon, [c[begin:end] for c in paths], weights[begin:end])
                    yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([low + k]), pa.array([part.to_bytes()], pa.binary())], ["lang", "range", "part"])


def _frequent(parts: pa.Table) -> pa.Table:
    whole = united([Transducer.from_bytes(p) for p in parts.column("part").to_pylist()])
    some = np.flatnonzero(whole.weights >= LEAST)
    words = [whole.lexicon.take(pa.array(c[some])).cast(pa.string()) for c in whole.paths()]
    langs = pa.array([parts.column("lang")[0].as_py()] * len(some), pa.string())
    return pa.table([langs, pc.binary_join_element_wise(*words, " "), pa.array(whole.weights[some])], ["lang", "phrase", "f"])


_COUNTS = "lang string, phrase string, f long"


def count(documents: DataFrame, size: int, bits: np.ndarray, bounds: list[Bound]) -> DataFrame:
    """The n-grams of ``size`` words with ``LEAST`` occurrences, counted by transducers."""
    shared = documents.sparkSession.sparkContext.broadcast((bits, bounds))
    parts = documents.mapInArrow(lambda batches: _shard_parts(batches, size, *shared.value), "lang string, range long, part binary")
    return parts.groupBy("lang", "range").applyInArrow(_frequent, _COUNTS)


def _phrase_hashes(phrases: pa.Array, langs: pa.Array) -> np.ndarray:
    shard = Shard(phrases, langs)
    hashes = shard.hashes().reshape(len(phrases), -1)
    total = hashes[:, 0]
    for k in range(1, hashes.shape[1]):
        total = _follow(total, hashes[:, k])
    return total


def _hashed(frequent: DataFrame) -> DataFrame:
    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(_phrase_hashes(batch.column(1), batch.column(0)).view(np.int64))], ["hash"])

    return frequent.select("lang", "phrase").mapInArrow(part, "hash long")


def range_bounds(words: DataFrame, total: int, range_words: int = RANGE_WORDS) -> list[Bound]:
    """Pairs of words that cut all n-grams in ranges of about ``range_words`` occurrences; one row a bound at the driver."""
    ranges = -(-total // range_words)
    if ranges < 2:
        return []
    chance = F.pmod(F.xxhash64("lang", "phrase"), F.lit(1 << 20)) / float(1 << 20)
    copies = F.floor(F.col("f") * (ranges * SAMPLES / total) + chance)
    sampled = words.select("lang", "phrase", copies.alias("copies")).filter("copies > 0").collect()
    sampled = sorted((r["lang"].encode(), r["phrase"].encode(), r["copies"]) for r in sampled)
    by_lang: dict[bytes, tuple[list[bytes], list[int]]] = {}
    for lang, word, n in sampled:
        spelled, ends = by_lang.setdefault(lang, ([], []))
        spelled.append(word)
        ends.append((ends[-1] if ends else 0) + n)
    bounds, held, step = [], 0, sum(n for _, _, n in sampled) / ranges
    for lang, word, n in sampled:
        spelled, ends = by_lang[lang]
        k = int(held / step) + 1
        while k * step < held + n:
            share = (k * step - held) / n
            bounds.append((lang, word, spelled[min(len(spelled) - 1, bisect_right(ends, share * ends[-1]))]))
            k += 1
        held += n
    return sorted(set(bounds))


def _ranged(batches: Iterator[pa.RecordBatch], bounds: list[Bound]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
        spelled = [(lang.encode(), *(phrase.encode().split(b" ") + [b""])[:2]) for lang, phrase in paths]
        yield batch.append_column("range", pa.array([bisect_right(bounds, p) for p in spelled], pa.int64()))


class _States:
    """States of the paths of one to ``LONGEST - 1`` words: by depth, keys of (state before, word) in order."""

    def __init__(self, words: list[np.ndarray], lengths: np.ndarray):
        self.keys, self.last, state = [], np.empty(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for depth, column in enumerate(words):
            on = np.flatnonzero(lengths > depth)
            keys, state[on] = np.unique((state[on] << 32) | column[on], return_inverse=True)
            self.keys.append(keys)
            ends = on[lengths[on] == depth + 1]
            self.last[ends] = state[ends]


def composed(wanted: pa.Table, counts: pa.Table) -> pa.Table:
    """The wanted parts with the weight of their path in ``counts``, both walked word by word."""
    langs = pa.concat_arrays([t.column("lang").combine_chunks() for t in (wanted, counts)])
    phrases = pa.concat_arrays([t.column("phrase").combine_chunks() for t in (wanted, counts)])
    split = pc.split_pattern(phrases, " ")
    # the language is the first word of a path
    lengths = split.value_lengths().to_numpy(zero_copy_only=False) + 1
    _, ids = _numbered(split.flatten().cast(pa.binary()))
    _, lang = _numbered(langs.cast(pa.binary()))
    firsts = np.concatenate([[0], np.cumsum(lengths - 1)])[:-1]
    words = [lang, *(np.where(lengths > d, ids[np.minimum(firsts + d - 1, len(ids) - 1)], 0) for d in range(1, LONGEST))]
    asked = wanted.num_rows
    one, two = (_States([w[part] for w in words], lengths[part]) for part in (slice(0, asked), slice(asked, None)))
    weights = [np.zeros(len(k), np.int64) for k in two.keys]
    for depth in range(len(words)):
        ends = lengths[asked:] == depth + 1
        weights[depth][two.last[ends]] = counts.column("f").to_numpy()[ends]
    found, pair = np.zeros(asked, np.int64), np.zeros(1, np.int64)  # the counts' state for each state of the wanted
    for depth in range(len(words)):
        before, word = one.keys[depth] >> 32, one.keys[depth] & 0xFFFFFFFF
        keys = np.where(pair[before] >= 0, (pair[before] << 32) | word, -1)
        at = np.minimum(np.searchsorted(two.keys[depth], keys), max(0, len(two.keys[depth]) - 1))
        hit = (two.keys[depth][at] == keys) if len(two.keys[depth]) else np.zeros(len(keys), bool)
        pair = np.where(hit, at, -1)
        ends = np.flatnonzero(lengths[:asked] == depth + 1)
        state = pair[one.last[ends]]
        if len(weights[depth]):
            found[ends] = np.where(state >= 0, weights[depth][state], 0)
    some = np.flatnonzero(found)
    return pa.table([wanted.column("lang").take(pa.array(some)), wanted.column("phrase").take(pa.array(some)), pa.array(found[some])], ["lang", "phrase", "f"])


def look_up(wanted: DataFrame, counts: DataFrame, bounds: list[Bound]) -> DataFrame:
    """``lang, phrase, f`` of the wanted phrases, by composition in every prefix range."""
    shared = wanted.sparkSession.sparkContext.broadcast(bounds)
    asked = wanted.mapInArrow(lambda batches: _ranged(batches, shared.value), "lang string, phrase string, range long")
    held = counts.select("lang", "phrase", "f").mapInArrow(lambda batches: _ranged(batches, shared.value), "lang string, phrase string, f long, range long")
    return asked.groupBy("range").cogroup(held.groupBy("range")).applyInArrow(composed, _COUNTS)


def phrases(documents: DataFrame, range_words: int = RANGE_WORDS) -> DataFrame:
    """The best ``TOP`` phrases of every language: ``lang, rank, phrase, a, l, r, n, score``."""
    arrays.prepare(documents.sparkSession)
    texts = documents.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    words = texts.mapInArrow(_word_counts, _COUNTS).groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    words = materialise(words, "words")
    totals = materialise(words.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    bounds = range_bounds(words, totals.agg(F.sum("n")).first()[0] or 0, range_words)
    frequent = [words.filter(F.col("f") >= LEAST)]
    for size in range(2, LONGEST + 1):
        frequent.append(materialise(count(texts, size, bit_array(_hashed(frequent[-1])), bounds), f"phrases-{size}"))

    candidates = frequent[1]
    counts = frequent[0].unionByName(frequent[1])
    for more in frequent[2:]:
        candidates = candidates.unionByName(more)
    candidates = candidates.select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("words"))
    cuts = candidates.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("words", 1, F.col("k")), " ").alias("first"), F.array_join(F.slice("words", F.col("k") + 1, F.size("words") - F.col("k")), " ").alias("rest"))
    cuts = materialise(cuts, "cuts")
    wanted = cuts.select("lang", F.col("first").alias("phrase")).unionByName(cuts.select("lang", F.col("rest").alias("phrase"))).distinct()
    parts = materialise(look_up(wanted, counts, bounds), "parts")
    scored = cuts.join(parts.toDF("lang", "first", "l"), ["lang", "first"]).join(parts.toDF("lang", "rest", "r"), ["lang", "rest"])
    wide = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r")}
    scored = scored.withColumns({f"wide_{c}": v for c, v in wide.items()})
    scored = scored.withColumn("score", F.expr("(wide_a * wide_a * cast(1000000 as decimal(7,0))) div (wide_l * wide_r)"))
    lowest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    longer = candidates.filter(F.size("words") > 2).select("lang", "a", "words", F.explode(F.sequence(F.lit(2), F.size("words") - 1)).alias("size"))
    longer = longer.select("lang", "a", "size", "words", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("size") + 1)).alias("at"))
    longer = longer.select("lang", F.array_join(F.slice("words", F.col("at"), F.col("size")), " ").alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = lowest.join(longer, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (100 * F.col("longer") < PERCENT * F.col("a")))
    order = [F.col("cut.score").desc(), F.col("a").desc(), F.col("phrase")]
    kept = kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)))
    best = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= TOP)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= TOP)
    ranked = best.join(totals, "lang")
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
