"""Language-model scores of a weighted backoff automaton of word n-grams.

Every history seen in training is a state, with an arc for each word seen after it and a failure
arc to the next shorter history; a text is walked once from left to right, its state is carried
along, and the log10 weights of the arcs taken add up to its score. With counts c and strength S,

    p(w | h) = (c(h w) + S p(w | shorter h)) / (c(h) + S)

and for no history the absolute discount D = n1 / (n1 + 2 n2): (c(w) - D) / N for known words
and D V / N for the unknown word. Both sum to 1 over the V known words and the unknown one.

Counts are exact and cover all training texts. The model grows with the corpus, so it is never
held in one place. Documents are cut into blocks; a block's distinct n-grams, with its own
training counts, go to buckets of their hash, where the counts of all blocks are added up and
answered to each block in the order asked. Blocks then meet their answers; each builds the states
and arcs that its own texts can reach and walks them. Common words cost one entry a block, so
no bucket depends on how often a word occurs.

The documents are read twice and must give the same rows in the same partitions both times, as
tables do; otherwise the query fails rather than scores wrongly. Null and empty texts are just
the end of a text. The operator's columns replace columns of the same names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rosterflow.llm import arrays
from rosterflow.session import materialise

#: Text bytes per bucket of n-grams.
BUCKET_BYTES = 4_000_000
#: Words of a text walked in one go.
PIECE = 512
START, END = np.uint64(0x5374617274), np.uint64(0x456E64)


@dataclass(frozen=True)
class Settings:
    order: int = 2
    strength: float = 8.0
    #: Of the base score: what is added to every count.
    added: float = 0.1
    #: Text bytes of a block.
    block_bytes: int = 8_000_000


@dataclass(frozen=True)
class Totals:
    """Of the training texts: tokens, distinct tokens, and those that occur once and twice."""

    tokens: int
    kinds: int
    once: int
    twice: int


class Block:
    """Texts of a block as token sequences, with the distinct n-grams of each order."""

    def __init__(self, column: pa.Array, training: np.ndarray, order: int):
        words = arrays.Words(arrays.Texts(column), arrays.SPACED, fold=True)
        lengths = words.counts + 2
        begin = np.cumsum(lengths) - lengths
        sequence = np.empty(int(lengths.sum()), np.uint64)
        sequence[begin] = START
        sequence[begin + lengths - 1] = END
        sequence[np.arange(len(words.hash)) + 2 * words.text + 1] = words.hash
        self.text = np.repeat(np.arange(len(lengths)), lengths)
        # tokens are all but the starts; token t ends n-grams of up to place[t] + 1 words, the start included
        self.tokens = np.setdiff1d(np.arange(len(sequence)), begin, assume_unique=True)
        self.place = self.tokens - np.repeat(begin, lengths - 1)
        self.token_text = self.text[self.tokens]
        self.first = np.concatenate([[0], np.cumsum(lengths - 1)])
        self.ends = self.first[1:] - 1
        learns = training[self.token_text]
        self.grams, self.number, self.counts, self.has = [], [], [], []
        for k in range(1, order + 1):
            has = np.flatnonzero(self.place >= k - 1)
            gram = arrays.mix(arrays.window_hashes(sequence, k)[self.tokens[has] - k + 1] + np.uint64(k))
            sample, number = arrays.kinds(gram)
            self.grams.append(gram[sample])
            self.number.append(number)
            self.counts.append(np.bincount(number, weights=learns[has], minlength=len(sample)).astype(np.int64))
            self.has.append(has)

    def parts(self, bits: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Order, bucket, hashes and own training counts, by order and bucket."""
        for k, (grams, counts) in enumerate(zip(self.grams, self.counts, strict=True), 1):
            bucket = (grams >> np.uint64(63 - bits)) >> np.uint64(1)
            heads = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))[: len(grams)]
            for low, high in zip(heads.tolist(), [*heads[1:].tolist(), len(grams)], strict=True):
                yield k, int(bucket[low]), grams[low:high], counts[low:high]

    def histories(self, k: int, sample: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For n-grams of order ``k`` that end at the given tokens: the numbers of their first and of their last
        ``k - 1`` words among the n-grams of that order; -1 for the start of a text as a history."""
        before = np.full(len(self.tokens), -1)
        before[self.has[k - 2]] = self.number[k - 2]
        own = before[sample]
        inner = self.place[sample] > 1
        return np.where(inner, before[sample - 1], -1), own

    def scores(self, counts: list[np.ndarray], totals: Totals, settings: Settings) -> list[np.ndarray]:
        """Per text: tokens, known tokens, base score and score, from the training counts of the distinct n-grams."""
        known = counts[0][self.number[0]]
        base = np.log10((known + settings.added) / (totals.tokens + settings.added * (totals.kinds + 1)))
        found = Automaton(self, counts, totals, settings).walk(self.number[0], self.first)
        return [np.diff(self.first), arrays.text_sums(known > 0, self.first), arrays.text_sums(base, self.first), found]


class Automaton:
    """The part of the weighted backoff automaton that the texts of a block can reach.

    A state is a history that was seen in training: state 0 the empty one, state 1 the start of a
    text, then the seen n-grams of one word, of two, and so on. Every n-gram seen is an arc from
    its history to the longest history that it leaves, with the log10 of its interpolated
    probability. The failure arc of a state leads to its history without the first word and
    weighs what the state gives to all words not seen after it.
    """

    def __init__(self, block: Block, counts: list[np.ndarray], totals: Totals, settings: Settings):
        self.words, self.order = len(block.grams[0]), len(counts)
        discount = totals.once / (totals.once + 2 * totals.twice) if totals.once else 0.5
        total = max(totals.tokens, 1)
        least = np.finfo(float).tiny
        self.unknown = math.log10(max(discount * totals.kinds / total if totals.tokens else 1.0, least))
        # the start of a text is a history as often as the end is a token
        starts = int(counts[0][block.number[0][block.ends[0]]]) if len(block.ends) else 0
        state = [np.full(len(c), -1) for c in counts]
        weight, fails, states = [0.0, math.log10(settings.strength / (starts + settings.strength))], [0, 0], 2
        keys, chances, targets = [], [], []
        before = None
        for k, seen in enumerate(counts, 1):
            some = np.flatnonzero(seen)
            if k == 1:
                from_, back = np.zeros(len(some), np.int64), np.zeros(len(some), np.int64)
                word, chance = some, np.maximum((seen[some] - discount) / total, least)
            else:
                sample = np.empty(len(seen), np.int64)
                sample[block.number[k - 1]] = block.has[k - 1]
                history, suffix = block.histories(k, sample[some])
                held = np.where(history >= 0, counts[k - 2][history], starts)
                from_ = np.where(history >= 0, state[k - 2][history], 1)
                word, back = block.number[0][sample[some]], state[k - 2][suffix]
                chance = (seen[some] + settings.strength * before[suffix]) / (held + settings.strength)
            if k < self.order:
                state[k - 1][some] = states + np.arange(len(some))
                states += len(some)
                weight.append(np.log10(settings.strength / (seen[some] + settings.strength)))
                fails.append(back)
                targets.append(state[k - 1][some])
            else:
                targets.append(back)
            before = np.zeros(len(seen))
            before[some] = chance
            keys.append(from_ * self.words + word)
            chances.append(np.log10(chance))
        order = np.argsort(key := np.concatenate(keys))
        self.keys, self.weights, self.targets = key[order], np.concatenate(chances)[order], np.concatenate(targets)[order]
        self.failed, self.fails = np.hstack(weight), np.hstack(fails).astype(np.int64)
        self.begin = 1 if starts and self.order > 1 else 0

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log10 probability of a word in each state, and the state it leads to."""
        gained, state = np.zeros(len(state)), state.copy()
        open_ = np.arange(len(state))
        while len(open_):
            key = state[open_] * self.words + word[open_]
            at = np.minimum(np.searchsorted(self.keys, key), max(0, len(self.keys) - 1))
            hit = self.keys[at] == key if len(self.keys) else np.zeros(len(key), bool)
            gained[open_[hit]] += self.weights[at[hit]]
            state[open_[hit]] = self.targets[at[hit]]
            open_ = open_[~hit]
            lost = state[open_] == 0
            gained[open_[lost]] += self.unknown
            open_ = open_[~lost]
            gained[open_] += self.failed[state[open_]]
            state[open_] = self.fails[state[open_]]
        return gained, state

    def walk(self, word: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Log10 probability of each text, walked from left to right, all texts side by side.

        A long text is walked in pieces of ``PIECE`` words. What state a piece begins in
        follows from the few words before it, which are walked first.
        """
        lengths = np.diff(first)
        pieces = -(-lengths // PIECE)
        text = np.repeat(np.arange(len(lengths)), pieces)
        place = PIECE * (np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces))
        size = np.minimum(PIECE, lengths[text] - place)
        ahead = np.minimum(self.order - 1, place)
        begin = first[text] + place - ahead
        order = np.argsort(-(size + ahead), kind="stable")
        begin, ahead, left = begin[order], ahead[order], (size + ahead)[order]
        state = np.where(place[order] - ahead > 0, 0, self.begin)
        total = np.zeros(len(text))
        for k in range(int(left[0]) if len(left) else 0):
            now = int(np.searchsorted(-left, -k, "left"))  # pieces of more than k words
            gained, state[:now] = self.step(state[:now], word[begin[:now] + k])
            total[:now] += np.where(ahead[:now] <= k, gained, 0.0)
        return np.bincount(text[order], total, len(lengths))


def _blocks(batches: Iterator[pa.RecordBatch], column: int, flag: int, settings: Settings) -> Iterator[tuple[int, Block, pa.RecordBatch]]:
    """The blocks of a task with a key of each: the task's partition, the block's place in it and its n-grams."""
    for place, piece in enumerate(arrays.regular_slices(batches, column, settings.block_bytes)):
        block = Block(piece.column(column), piece.column(flag).to_numpy(zero_copy_only=False).astype(bool), settings.order)
        seed = np.array([TaskContext.get().partitionId() << 32 | place], np.uint64)
        content = np.uint64(len(block.tokens)) + np.sum(block.grams[-1], dtype=np.uint64) + np.sum(arrays.mix(block.counts[-1].astype(np.uint64) + block.grams[-1]), dtype=np.uint64)
        yield int((arrays.mix(seed) ^ content).view(np.int64)[0]), block, piece


def _packed(values: np.ndarray) -> bytes:
    """Numbers by byte planes: the planes of high bytes are all but empty and compress to nothing."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def _unpacked(data: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(kind).ravel()


def count(documents: DataFrame, settings: Settings) -> tuple[DataFrame, Totals, int]:
    """Answers to all blocks, the corpus totals, and the bits of a bucket's number."""
    size = documents.agg(F.sum(F.octet_length("text")).alias("bytes")).first()["bytes"] or 0
    bits = max(int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")) - 1, size // BUCKET_BYTES, 1).bit_length()

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, block, _ in _blocks(batches, 0, 1, settings):
            rows = [(k, b, key, _packed(np.diff(grams, prepend=np.uint64(0))), _packed(counts.astype(np.uint32))) for k, b, grams, counts in block.parts(bits)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()), strict=True)], ["order", "bucket", "block", "grams", "counts"])

    def answer(asked: pa.Table) -> pa.Table:
        asked = asked.combine_chunks()
        orders = asked.column("order").to_numpy()
        sizes = np.array([len(g) // 8 for g in asked.column("grams").to_pylist()])
        replies: list[bytes] = [b""] * len(orders)
        stats = np.zeros(4, np.int64)
        for k in np.unique(orders).tolist():
            rows = np.flatnonzero(orders == k)
            # n-grams are sorted in a row and sent as differences
            grams = np.concatenate([np.cumsum(_unpacked(g, np.uint64), dtype=np.uint64) for g in asked.column("grams").take(pa.array(rows)).to_pylist()])
            counts = np.concatenate([_unpacked(c, np.uint32) for c in asked.column("counts").take(pa.array(rows)).to_pylist()])
            sample, number = arrays.kinds(grams)
            totals = np.bincount(number, weights=counts, minlength=len(sample)).astype(np.int64)
            if k == 1:
                stats += [totals.sum(), (totals > 0).sum(), (totals == 1).sum(), (totals == 2).sum()]
            reply, at = totals[number], np.concatenate([[0], np.cumsum(sizes[rows])])
            for i, row in enumerate(rows.tolist()):
                replies[row] = _packed(reply[at[i] : at[i + 1]])
        names = ["order", "bucket", "block"]
        # the first row of a bucket carries its share of the totals
        told = [pa.array(np.concatenate([[s], np.zeros(len(orders) - 1, np.int64)])) for s in stats]
        return pa.table([*(asked.column(n) for n in names), pa.array(replies, pa.binary()), *told], [*names, "replies", *_TOTALS])

    asked = documents.select("text", "training").mapInArrow(ask, "order int, bucket int, block long, grams binary, counts binary")
    answers = asked.groupBy("bucket").applyInArrow(answer, "order int, bucket int, block long, replies binary, " + ", ".join(f"{n} long" for n in _TOTALS))
    answers = materialise(answers, "ngram-answers")
    row = answers.agg(*(F.sum(n).alias(n) for n in _TOTALS)).first()
    return answers.drop(*_TOTALS), Totals(*(int(row[n] or 0) for n in _TOTALS)), bits


_TOTALS = ("tokens", "kinds", "once", "twice")
SCORES = {"n_tokens": "long", "n_known": "long", "train_tokens": "long", "base_score": "double", "score": "double"}


def score(documents: DataFrame, training: Column, settings: Settings | None = None) -> DataFrame:
    """All columns of ``documents`` but ``text``, and ``SCORES``; the model learns where ``training`` holds."""
    settings = settings or Settings()
    arrays.prepare(documents.sparkSession)
    frame = documents.drop(*SCORES, "training", "block").withColumn("text", F.col("text").cast("string")).withColumn("training", F.coalesce(training, F.lit(False)))
    answers, totals, _ = count(frame, settings)
    names = [c for c in frame.columns if c not in ("text", "training")]
    at, flag = frame.columns.index("text"), frame.columns.index("training")
    order = settings.order

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, _, piece in _blocks(batches, at, flag, settings):
            yield piece.append_column("block", pa.array(np.full(piece.num_rows, key)))

    def scored(texts: pa.Table, replies: pa.Table) -> pa.Table:
        if not texts.num_rows:
            raise ValueError("the documents changed between two passes; write them to a table first")
        texts = texts.combine_chunks()
        column = texts.column("text").chunk(0) if texts.num_rows else pa.array([], pa.string())
        block = Block(column, texts.column("training").to_numpy().astype(bool), order)
        replies = replies.sort_by([("order", "ascending"), ("bucket", "ascending")])
        kinds, held = replies.column("order").to_numpy(), replies.column("replies").to_pylist()
        counts = [np.concatenate([np.empty(0, np.int64), *(_unpacked(h, np.int64) for h, k in zip(held, kinds, strict=True) if k == n)]) for n in range(1, order + 1)]
        if [len(c) for c in counts] != [len(g) for g in block.grams]:
            raise ValueError("the documents changed between two passes; write them to a table first")
        tokens, known, base, found = block.scores(counts, totals, settings)
        added = [pa.array(tokens), pa.array(known), pa.array(np.full(len(tokens), totals.tokens)), pa.array(base), pa.array(found)]
        return pa.table([*(texts.column(n) for n in names), *added], [*names, *SCORES])

    new = StructType.fromDDL(", ".join(f"{n} {t}" for n, t in SCORES.items()))
    blocks = frame.mapInArrow(dealt, StructType([*frame.schema, *StructType.fromDDL("block long")]))
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(scored, StructType([*frame.select(*names).schema, *new]))
