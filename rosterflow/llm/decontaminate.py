"""Benchmark decontamination by suffix arrays over the training documents.

Each task cuts its documents into shards of a few megabytes and builds the suffix array of
the words of a shard, ordered by the words' numbers and sorted as deep as a search can look.
Every distinct window of the benchmark, wherever and in however many items it stands, is found
once by binary search in every shard; equal ranges give the places of all its verbatim matches.
Matches that continue each other are joined to the longest ones, with their places in the document
and in the first item that holds their window. Which items a document meets follows from the sets
of items of its windows, which are kept once however many windows share them; so prompts that all
items begin with cost what one of them costs.

A benchmark of one block is searched for in one pass that shuffles nothing. A larger one is first
cut down to the items that share the hash of a window with some document, by a semi join behind
a bit array; what is left is searched for block after block, one of them in memory at a time, and
matches, not documents, are joined in the end. Words are compared by 64-bit hashes. Null and empty
texts have no words and no matches; an item without words has no window; an item of fewer words
than a window is one window as a whole. A null item id counts as an empty text. Equal ids of items
are one item in the result. The operator's columns replace columns of the same names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rosterflow.llm import arrays
from rosterflow.llm.bits import bit_array, contains
from rosterflow.session import materialise

WINDOW = 13
#: A document is contaminated if at least one in so many of its words lies in a match.
SHARE = 20
#: Text bytes of a shard of training documents, and of a block of benchmark items.
SHARD_BYTES = 4_000_000
BLOCK_BYTES = 8_000_000

MATCHES = "array<struct<item_id:string,item_word:int,word:int,length:int>>"
#: Ids of items that a batch of results holds, about.
BATCH_ITEMS = 500_000


def window_keys(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words, told apart by size."""
    return arrays.mix(arrays.window_hashes(hashes, size) + np.uint64(size))


class Windows:
    """Distinct windows of a block of items.

    ``begin`` and ``length`` give each window's words in ``words``, ``item`` the first item that has
    it; ``group`` numbers the sets of items, ``members[group_first[g]:group_first[g + 1]]`` are in set ``g``.
    """

    def __init__(self, ids: list[str], found: arrays.Words, size: int):
        self.ids, self.words, self.first, self.size = ids, found.hash, found.first, size
        usable = np.where(found.counts >= size, found.counts - size + 1, np.minimum(found.counts, 1))
        item = np.repeat(np.arange(len(ids)), usable)
        begin = found.first[item] + np.arange(len(item)) - np.repeat(np.cumsum(usable) - usable, usable)
        length = np.minimum(found.counts, size)[item]
        key = np.empty(len(item), np.uint64)
        for n in np.unique(length):
            of = length == n
            key[of] = window_keys(found.hash, int(n))[begin[of]]
        self.key, at, window = np.unique(key, return_index=True, return_inverse=True)
        self.begin, self.length, self.item = begin[at], length[at], item[at]
        pairs = np.unique(window * len(ids) + item) if len(ids) else np.empty(0, np.int64)
        window, item = np.divmod(pairs, max(1, len(ids)))
        bounds = np.searchsorted(window, np.arange(len(at) + 1))
        sums = [np.concatenate([[np.uint64(0)], np.cumsum(arrays.mix(item.astype(np.uint64) + np.uint64(salt)))]) for salt in (1, 1 << 40)]
        digests = np.stack([s[bounds[1:]] - s[bounds[:-1]] for s in sums], axis=1)
        _, shown, self.group = np.unique(digests, axis=0, return_index=True, return_inverse=True)
        place, sizes = arrays.spread(bounds, shown)
        self.members, self.group_first = item[place], np.concatenate([[0], np.cumsum(sizes)])


class Shard:
    """Suffix array over the words of some texts."""

    def __init__(self, hashes: np.ndarray, text: np.ndarray, depth: int):
        sample, number = arrays.kinds(hashes)
        self.distinct = hashes[sample]
        self.words = number + 1
        self.text = text
        size = len(hashes)
        rank, sorted_to, self.order = self.words, 1, np.argsort(self.words, kind="stable")
        while sorted_to < depth:
            after = np.zeros(size, np.int64)
            same = np.flatnonzero(text[: size - sorted_to] == text[sorted_to:]) if size > sorted_to else np.empty(0, np.int64)
            after[same] = rank[same + sorted_to]
            key = rank * (size + 2) + after
            self.order = np.argsort(key, kind="stable")
            held = key[self.order]
            rank = np.empty(size, np.int64)
            rank[self.order] = np.cumsum(np.concatenate([[1], held[1:] != held[:-1]]))
            sorted_to *= 2
        # words past the end of a text are 0, below every word
        ends = np.searchsorted(text, text, "right")
        self.ends = ends
        self.padded = np.concatenate([self.words, np.zeros(depth, np.int64)])

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The shard's numbers of words, 0 for a word that it does not have."""
        at = np.minimum(np.searchsorted(self.distinct, hashes), len(self.distinct) - 1)
        return np.where(self.distinct[at] == hashes, at + 1, 0)

    def _sign(self, place: np.ndarray, sought: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the suffix at each place of the array comes before (-1) the sought words, has them (0) or comes after."""
        begin = self.order[place]
        sign = np.zeros(len(place), np.int8)
        for k in range(sought.shape[1]):
            open_ = np.flatnonzero((sign == 0) & (k < length))
            if not len(open_):
                break
            at = begin[open_] + k
            have = np.where(at < self.ends[begin[open_]], self.padded[at], 0)
            sign[open_] = np.sign(have - sought[open_, k])
        return sign

    def search(self, sought: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Range of the suffix array whose suffixes begin with the first ``length`` words of each row."""
        bounds = []
        for least in (0, 1):
            low, high = np.zeros(len(sought), np.int64), np.full(len(sought), len(self.order))
            while True:
                busy = np.flatnonzero(low < high)
                if not len(busy):
                    break
                middle = (low[busy] + high[busy]) // 2
                right = self._sign(middle, sought[busy], length[busy]) < least
                low[busy[right]] = middle[right] + 1
                high[busy[~right]] = middle[~right]
            bounds.append(low)
        return bounds[0], bounds[1]


def _extended(words: arrays.Words, items: Windows, text: np.ndarray, place: np.ndarray, at: np.ndarray, item: np.ndarray, step: int) -> np.ndarray:
    """How many words on (``step`` 1) or back (-1) from the given ones document and item agree."""
    gained, open_ = np.zeros(len(place), np.int64), np.arange(len(place))
    while len(open_):
        there, here = place[open_] + step * (gained[open_] + 1), at[open_] + step * (gained[open_] + 1)
        within = (there >= words.first[text[open_]]) & (there < words.first[text[open_] + 1]) & (here >= items.first[item[open_]]) & (here < items.first[item[open_] + 1])
        open_, there, here = open_[within], there[within], here[within]
        open_ = open_[words.hash[there] == items.words[here]]
        gained[open_] += 1
    return gained


def longest_matches(words: arrays.Words, items: Windows) -> tuple[tuple[np.ndarray, ...], tuple[np.ndarray, np.ndarray]]:
    """Text, place in the text, item, place in the item and length of the longest matches, by text and place; and the
    texts with the sets of items that they meet."""
    none = np.empty(0, np.int64)
    if not len(words.hash) or not len(items.begin):
        return (none,) * 5, (none, none)
    shard = Shard(words.hash, words.text, items.size)
    number = shard.numbers(items.words)
    # a window can only be found if the shard has each of its words
    lacking = np.concatenate([[0], np.cumsum(number == 0)])
    able = np.flatnonzero(lacking[items.begin + items.length] == lacking[items.begin])
    if not len(able):
        return (none,) * 5, (none, none)
    sought = number[np.minimum(items.begin[able][:, None] + np.arange(items.size), len(number) - 1)]
    low, high = shard.search(sought, items.length[able])
    found = np.repeat(able, high - low)
    place = shard.order[np.arange(len(found)) + np.repeat(low - np.cumsum(high - low) + (high - low), high - low)]
    text, item, begin = words.text[place], items.item[found], items.begin[found]
    order = np.lexsort((place, place - begin, item, text))
    found, place, text = found[order], place[order], text[order]
    met = np.unique(text * len(items.group_first) + items.group[found])
    # places of one item that follow each other are one match; one match grows to all that it agrees on
    item, begin, length = items.item[found], items.begin[found], items.length[found]
    joins = np.zeros(len(place), bool)
    joins[1:] = (item[1:] == item[:-1]) & (text[1:] == text[:-1]) & (place[1:] == place[:-1] + 1) & (begin[1:] == begin[:-1] + 1)
    head = np.flatnonzero(~joins)
    tail = np.append(head[1:], len(place))[: len(head)] - 1
    text, item, from_, to = text[head], item[head], place[head], place[tail] + length[tail]
    back = _extended(words, items, text, from_, begin[head], item, -1)
    on = _extended(words, items, text, to - 1, begin[tail] + length[tail] - 1, item, 1)
    rows = np.stack([text, from_ - back - words.first[text], item, begin[head] - back - items.first[item], to - from_ + back + on], axis=1)
    return tuple(np.unique(rows, axis=0).T), tuple(np.divmod(met, len(items.group_first)))


def _block(rows: DataFrame, window: int) -> Windows:
    held = rows.select("item_id", "text").toArrow()
    texts = held.column("text").combine_chunks() if held.num_rows else pa.array([], pa.string())
    return Windows(held.column("item_id").to_pylist(), arrays.Words(arrays.Texts(texts), arrays.ALPHANUMERIC, fold=True), window)


def _searched(frame: DataFrame, items: Windows, names: list[str], hits_only: bool) -> DataFrame:
    """The columns ``names``, ``n_words``, ``matches`` and ``items`` of all rows, or of those with a match."""
    arrays.prepare(frame.sparkSession)
    at, places = frame.columns.index("text"), [frame.columns.index(c) for c in names]
    shared = frame.sparkSession.sparkContext.broadcast(items)
    schema = StructType([*frame.select(*names).schema, *StructType.fromDDL(f"n_words long, matches {MATCHES}, items array<string>")])

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        ids = pa.array(held.ids, pa.string())
        sizes = np.diff(held.group_first)
        for batch in batches:
            for piece in arrays.slices(batch, at, SHARD_BYTES):
                words = arrays.Words(arrays.Texts(piece.column(at)), arrays.ALPHANUMERIC, fold=True)
                (text, place, item, start, length), (owner, group) = longest_matches(words, held)
                due = np.concatenate([[0], np.cumsum(np.bincount(owner, sizes[group], piece.num_rows))])
                row = 0
                while row < piece.num_rows:
                    stop = max(row + 1, int(np.searchsorted(due, due[row] + BATCH_ITEMS, "right")) - 1)
                    some = slice(*np.searchsorted(text, [row, stop]))
                    bounds = pa.array(np.searchsorted(text[some], np.arange(row, stop + 1)), pa.int32())
                    fields = [ids.take(pa.array(item[some])), *(pa.array(v[some].astype(np.int32)) for v in (start, place, length))]
                    matches = pa.ListArray.from_arrays(bounds, pa.StructArray.from_arrays(fields, ["item_id", "item_word", "word", "length"]))
                    own = slice(*np.searchsorted(owner, [row, stop]))
                    members, counts = arrays.spread(held.group_first, group[own])
                    pairs = np.unique(np.repeat(owner[own], counts) * max(1, len(held.ids)) + held.members[members])
                    who, which = np.divmod(pairs, max(1, len(held.ids)))
                    lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(who, np.arange(row, stop + 1)), pa.int32()), ids.take(pa.array(which)))
                    columns = [*(piece.column(i).slice(row, stop - row) for i in places), pa.array(words.counts[row:stop].astype(np.int64)), matches, lists]
                    out = pa.RecordBatch.from_arrays(columns, schema.names)
                    yield out.filter(pc.greater(pc.list_value_length(matches), 0)) if hits_only else out
                    row = stop

    return frame.mapInArrow(part, schema)


def _shared_items(rows: DataFrame, documents: DataFrame, window: int) -> DataFrame:
    """The items that share the hash of a window with a document."""
    sizes = [r[0] for r in rows.select(F.explode("sizes")).distinct().collect()]  # at most one for each size

    def keys(batches: Iterator[pa.RecordBatch], bits: np.ndarray | None, whole: bool) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in arrays.slices(batch, 0, SHARD_BYTES):
                words = arrays.Words(arrays.Texts(piece.column(0)), arrays.ALPHANUMERIC, fold=True)
                for size in sizes:
                    at = arrays.inside(words.text, size)
                    if not whole and size < window:  # a short item is one window
                        at = at[words.counts[words.text[at]] == size]
                    hashes = window_keys(words.hash, size)[at] if len(at) else np.empty(0, np.uint64)
                    kept = np.ones(len(at), bool) if bits is None else contains(bits, hashes)
                    found = np.unique(hashes[kept]) if whole else hashes
                    number = pa.nulls(len(found), pa.int64()) if whole else piece.column(1).take(pa.array(words.text[at]))
                    yield pa.RecordBatch.from_arrays([number, pa.array(found.view(np.int64))], ["number", "hash"])

    schema = "number long, hash long"
    own = materialise(rows.select("text", "number").mapInArrow(lambda b: keys(b, None, False), schema), "item-windows")
    shared = rows.sparkSession.sparkContext.broadcast(bit_array(own.select("hash").distinct()))
    seen = documents.select("text").mapInArrow(lambda b: keys(b, shared.value, True), schema).select("hash").distinct()
    return rows.join(own.join(seen, "hash", "left_semi").select("number").distinct(), "number", "left_semi")


def match(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, keep: tuple[str, ...] | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The columns of ``documents`` (or those in ``keep``), ``n_words``, ``matches`` (the longest verbatim matches) and
    ``items`` (the ids of all items with an occurring window)."""
    arrays.prepare(documents.sparkSession)
    frame = documents.drop("n_words", "matches", "items").withColumn("text", F.col("text").cast("string"))
    names = [c for c in frame.columns if keep is None or c in keep]
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def size(items: DataFrame) -> int:
        return items.agg(F.sum(F.octet_length("text") + F.octet_length("item_id"))).first()[0] or 0

    if size(rows) <= block_bytes:
        return _searched(frame, _block(rows, window), names, hits_only=False)
    counts = F.regexp_count(F.lower("text"), F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"))
    rows = materialise(rows.withColumn("number", F.monotonically_increasing_id()).withColumn("sizes", F.when(counts > 0, F.array(F.least(counts, F.lit(window)))).otherwise(F.array().cast("array<int>"))), "items")
    frame = materialise(frame.withColumn("document_number", F.monotonically_increasing_id()), "documents")
    rows = materialise(_shared_items(rows, frame, window), "shared-items")
    blocks = max(1, -(-size(rows) // block_bytes))
    found = []
    for k in range(blocks):
        block = _block(rows.filter(F.pmod(F.xxhash64("number"), F.lit(blocks)) == k), window)
        found.append(materialise(_searched(frame.select("document_number", "text"), block, ["document_number"], hits_only=True), "block-matches"))
    hits = found[0]
    for more in found[1:]:
        hits = hits.unionByName(more)
    hits = hits.groupBy("document_number").agg(F.array_sort(F.flatten(F.collect_list("matches"))).alias("matches"), F.flatten(F.collect_list("items")).alias("items"))
    words = _searched(frame, _block(rows.limit(0), window), [*names, "document_number"], hits_only=False).drop("matches", "items")
    joined = words.join(hits, "document_number", "left").drop("document_number")
    return joined.withColumns({"matches": F.coalesce("matches", F.array().cast(MATCHES)), "items": F.coalesce("items", F.array().cast("array<string>"))})


def hit_words() -> Column:
    """Number of words inside any match."""
    spans = F.array_sort(F.transform("matches", lambda m: F.struct(m["word"].alias("begin"), (m["word"] + m["length"]).alias("end"))))
    start = F.struct(F.lit(0).alias("upto"), F.lit(0).cast("long").alias("hit"))

    def add(done: Column, span: Column) -> Column:
        gained = F.greatest(F.lit(0), span["end"] - F.greatest(span["begin"], done["upto"]))
        return F.struct(F.greatest(done["upto"], span["end"]).alias("upto"), (done["hit"] + gained).alias("hit"))

    return F.aggregate(spans, start, add, lambda done: done["hit"])


def judge(matched: DataFrame) -> DataFrame:
    """``n_hit``, ``items`` (ids, sorted as text, each once) and ``contaminated`` of matched documents."""
    counted = matched.withColumn("n_hit", hit_words()).withColumn("items", F.array_sort(F.array_distinct("items")))
    return counted.withColumn("contaminated", (F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words")))


def clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    return arrays.where(documents, lambda frame: judge(match(frame, benchmark)), ~F.col("contaminated"))
