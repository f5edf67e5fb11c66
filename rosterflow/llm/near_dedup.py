"""Near-duplicates by a multi-index Hamming join of min-hash signatures, confirmed on full sets.

A document is the set of its distinct word shingles. Its signature has ``PLACES`` symbols of
16 bits, each from the smallest value of one hash function over the set; two documents of
similarity s differ in about (1 - s) of the places. Signatures are cut into ``CHUNKS`` chunks.
If two signatures differ in at most ``MOST_ERRORS`` places, then by the pigeonhole principle
some chunk differs in at most ``MOST_ERRORS // CHUNKS`` = 1 place; so every chunk is indexed
once for each place that may be wrong, left out, and all pairs under the threshold meet in a
bucket. At similarity 0.8 a pair is above the threshold with a probability of about 1e-5.

Equal sets are one class with one representative. In every bucket each member is first held
against the smallest one only; the links confirmed so are joined to components, which takes
large groups of copies together without their pairs. Then members of one bucket that are still
in different components are compared, which is exact: every pair of a bucket is compared or
already connected. Inside the join signatures are compared by two bits a place (never more
errors than the symbols have), and sets by bitmaps of ``BITS`` bits that hold the parity of the
number of shingles hashed to each: two bitmaps differ in no more bits than the sets have
shingles that only one of them has, so that a pair whose bitmaps differ too much cannot be
linked. Pairs that pass are confirmed on the full sets of both texts.

Buckets of more than ``LARGE`` members that are still in different components, such as pages of one
template that are no duplicates, are not held against each other. Their members meet by their rarest
shingles instead: two sets that can be linked have one in common among the rarest fifth (and one
more) of each, in one order of all shingles by how many members have them. So pages of a template
meet only if they share more than it.

Rows with a null id are linked with nothing. Empty and null texts have an empty set and are
linked with nothing. An id with several texts counts as several documents. Columns of the
documents other than id and text are not looked at.
"""

from __future__ import annotations

import operator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterflow.llm import arrays
from rosterflow.llm.components import components
from rosterflow.session import materialise

PLACES, CHUNKS, MOST_ERRORS = 64, 14, 27
BITS = 1024
#: Members of an open bucket that are all held against each other: up to some thousands that takes less than their shingles.
LARGE = 4096
#: Linked if the intersection has at least so many percent of the union.
PERCENT = 80
#: Ids that may be broadcast to pick their texts from the documents; beyond, the join shuffles.
BROADCAST_ROWS = 1_000_000

_random = np.random.default_rng(20)
_FACTORS = _random.integers(0, 1 << 31, PLACES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_SHIFTS = _random.integers(0, 1 << 32, PLACES, dtype=np.uint32)


def shingles(words: arrays.Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of all texts and the bounds of each text; sorted within a text.

    A text of fewer words than ``width`` has all of them as its one shingle.
    """
    at = arrays.inside(words.text, width)
    hashes, text = [arrays.window_hashes(words.hash, width)[at]], [words.text[at]]
    for fewer in range(1, width):
        short = np.flatnonzero(words.counts == fewer)
        if len(short):
            whole = np.stack([words.hash[words.first[short] + k] for k in range(fewer)])
            joined = np.full(len(short), np.uint64(fewer))
            for part in whole:
                joined = arrays.mix(joined * np.uint64(0x9E3779B97F4A7C15) + part)
            hashes.append(joined)
            text.append(short)
    hashes, text = np.concatenate(hashes), np.concatenate(text)
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    hashes, text = hashes[new], text[new]
    return hashes, np.searchsorted(text, np.arange(len(words.counts) + 1))


def _sketch(width: int):
    def compute(column: pa.Array) -> list[pa.Array]:
        hashes, first = shingles(arrays.Words(arrays.Texts(column), arrays.SPACED, fold=True), width)
        size = np.diff(first)
        some = np.flatnonzero(size)
        digests = np.zeros((2, len(size)), np.uint64)
        codes = np.zeros((2, len(size)), np.uint64)
        symbols = np.zeros((len(size), PLACES), np.uint16)
        spot = np.repeat(np.arange(len(size)) * BITS, size) + (hashes % np.uint64(BITS)).astype(np.int64)
        parity = (np.bincount(spot, minlength=len(size) * BITS) & 1).astype(np.uint8)
        bitmaps = np.packbits(parity, bitorder="little").view(np.int64).reshape(-1, len(BITMAP))
        if len(some):
            heads = first[some]
            digests[0, some] = np.add.reduceat(hashes, heads)
            digests[1, some] = np.add.reduceat(arrays.mix(hashes ^ np.uint64(0x5851F42D4C957F2D)), heads)
            low = (hashes >> np.uint64(32)).astype(np.uint32)
            for k in range(PLACES):
                least = np.minimum.reduceat(low * _FACTORS[k] + _SHIFTS[k], heads)
                spread = arrays.mix(least.astype(np.uint64) + np.uint64(k << 32))
                symbols[some, k] = spread.astype(np.uint16)
                codes[0, some] |= (spread & np.uint64(1)) << np.uint64(k)
                codes[1, some] |= (spread >> np.uint64(1) & np.uint64(1)) << np.uint64(k)
        signature = pa.array([row.tobytes() for row in symbols], pa.binary())
        return [pa.array(size.astype(np.int64)), *(pa.array(v.view(np.int64)) for v in (*digests, *codes)), *(pa.array(v) for v in bitmaps.T), signature]

    return compute


CODES, BITMAP = ["code_a", "code_b"], [f"bits_{i}" for i in range(BITS // 64)]
SKETCH = dict.fromkeys(["n_shingles", "digest_a", "digest_b", *CODES, *BITMAP], "long") | {"signature": "binary"}


def sketch(documents: DataFrame, width: int) -> DataFrame:
    """``doc_id`` with the size, digest, two-bit codes and signature of its set."""
    return arrays.with_columns(documents.select("doc_id", "text"), _sketch(width), SKETCH, keep=("doc_id",))


def bucket_keys(signature: Column) -> Column:
    """Array of the keys of a signature: every chunk with each of its places left out in turn."""
    keys, bounds = [], [round(k * PLACES / CHUNKS) for k in range(CHUNKS + 1)]
    for begin, end in zip(bounds, bounds[1:], strict=False):
        for out in range(begin, end):
            before = F.substring(signature, 2 * begin + 1, 2 * (out - begin))
            after = F.substring(signature, 2 * out + 3, 2 * (end - out - 1))
            keys.append(F.xxhash64(F.lit(out), before, after))
    return F.array(*keys)


def _close(a: str, b: str) -> Column:
    """Whether sizes and codes of two aliased rows leave a link possible."""

    def differs(name: str) -> Column:
        return F.col(f"{a}.{name}").bitwiseXOR(F.col(f"{b}.{name}"))

    sizes = F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles")
    similar = 100 * F.least(*sizes) >= PERCENT * F.greatest(*sizes)
    alike = F.bit_count(differs("code_a").bitwiseOR(differs("code_b"))) <= MOST_ERRORS
    # with d shingles in one set only, the intersection is (sizes - d) / 2 and the union (sizes + d) / 2
    least = reduce(operator.add, (F.bit_count(differs(name)) for name in BITMAP))
    total = sizes[0] + sizes[1]
    return similar & alike & (100 * (total - least) >= PERCENT * (total + least))


def _with_text(ids: DataFrame, documents: DataFrame, key: str) -> DataFrame:
    """``ids`` with the text of the document ``key``; the ids are broadcast if they are few."""
    count = ids.count()
    side = F.broadcast(ids) if count <= BROADCAST_ROWS else ids
    return documents.select(F.col("doc_id").alias(key), "text").filter(F.col("text").isNotNull()).join(side, key)


def confirm(pairs: DataFrame, documents: DataFrame, width: int) -> DataFrame:
    """The pairs ``(src, dst)`` whose full sets have the wanted similarity; an id with several texts links by any of them."""
    members = _with_text(pairs.select("src", "dst"), documents, "src").withColumnRenamed("text", "text_a")
    heads = _with_text(pairs.select("dst").distinct(), documents, "dst").withColumnRenamed("text", "text_b")
    arrays.prepare(documents.sparkSession)
    both = members.join(heads.hint("merge"), "dst").select("src", "dst", "text_a", "text_b")

    def part(batches):
        for batch in batches:
            for piece in arrays.slices(batch, 2):
                # pairs come sorted by dst, so that most texts on that side repeat the one before
                texts = piece.column(3).dictionary_encode()
                sets = [shingles(arrays.Words(arrays.Texts(c), arrays.SPACED, fold=True), width) for c in (piece.column(2), texts.dictionary)]
                linked = np.zeros(piece.num_rows, bool)
                for row, other in enumerate(texts.indices.to_pylist()):
                    one = sets[0][0][sets[0][1][row] : sets[0][1][row + 1]]
                    two = sets[1][0][sets[1][1][other] : sets[1][1][other + 1]]
                    shared = len(np.intersect1d(one, two, assume_unique=True))
                    linked[row] = shared and 100 * shared >= PERCENT * (len(one) + len(two) - shared)
                yield piece.select([0, 1]).filter(pa.array(linked))

    return both.mapInArrow(part, both.select("src", "dst").schema).distinct()


def rare_shingles(members: DataFrame, documents: DataFrame, width: int) -> DataFrame:
    """``rep, component, size, hash`` of the rarest shingles of each member (``rep, component``) that can decide its links.

    Sets that share ``PERCENT`` of their union share as much of each of them, hence one of any
    ``size - ceil(PERCENT * size / 100) + 1`` of either, if both are taken in one order.
    """
    texts = _with_text(members.withColumnRenamed("rep", "src"), documents, "src").select("src", "component", "text")
    texts = texts.withColumn("owner", F.xxhash64("src", "text"))
    arrays.prepare(documents.sparkSession)

    def part(batches):
        for batch in batches:
            for piece in arrays.slices(batch, 2):
                hashes, first = shingles(arrays.Words(arrays.Texts(piece.column(2)), arrays.SPACED, fold=True), width)
                size = np.diff(first)
                row = pa.array(np.repeat(np.arange(len(size)), size))
                columns = [piece.column(0).take(row), piece.column(1).take(row), piece.column(3).take(row), pa.array(np.repeat(size, size)), pa.array(hashes.view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["rep", "component", "owner", "size", "hash"])

    kinds = dict(texts.dtypes)
    rows = texts.mapInArrow(part, f"rep {kinds['src']}, component {kinds['component']}, owner long, size long, hash long")
    rows = materialise(rows, "member-shingles")
    counts = rows.groupBy("hash").agg(F.count("*").alias("held"))
    rarest = Window.partitionBy("owner").orderBy("held", "hash")
    ranked = rows.join(counts, "hash").withColumn("place", F.row_number().over(rarest))
    wanted = F.col("size") - F.ceil(F.col("size") * PERCENT / 100) + 1
    return ranked.filter((F.col("place") <= wanted) & (F.col("held") > 1)).select("rep", "component", "size", "hash")


def rare_pairs(members: DataFrame, documents: DataFrame, width: int) -> DataFrame:
    """Distinct pairs ``src, dst`` of members in different components that share one of their rarest shingles."""
    rare = materialise(rare_shingles(members, documents, width), "rare-shingles")
    a, b = rare.alias("a"), rare.alias("b")
    sizes = F.col("a.size"), F.col("b.size")
    similar = 100 * F.least(*sizes) >= PERCENT * F.greatest(*sizes)
    met = a.join(b, (F.col("a.hash") == F.col("b.hash")) & (F.col("a.component") < F.col("b.component")) & similar)
    return met.select(F.greatest("a.rep", "b.rep").alias("src"), F.least("a.rep", "b.rep").alias("dst")).filter("src != dst").distinct()


def link(documents: DataFrame, width: int) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id``, the smallest id reachable, for every row of ``documents``."""
    sketches = materialise(sketch(documents, width), "sketches")
    identity = ["n_shingles", "digest_a", "digest_b"]
    named = sketches.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    classes = named.groupBy(*identity).agg(F.min("doc_id").alias("rep"), F.count("*").alias("rows"))
    # by id, which few rows share, and not by class, which many may
    firsts = named.join(classes.select(*identity, F.col("rep").alias("doc_id")).withColumnsRenamed({c: f"class_{c}" for c in identity}), "doc_id")
    firsts = firsts.filter(reduce(operator.and_, (F.col(c) == F.col(f"class_{c}") for c in identity))).dropDuplicates(["doc_id", *identity])
    # a set of n shingles can only be linked with a different one if n of n + 1 are enough
    indexed = firsts.filter(100 * F.col("n_shingles") >= PERCENT * (F.col("n_shingles") + 1)).withColumnRenamed("doc_id", "rep")
    indexed = materialise(indexed.select("rep", "n_shingles", *CODES, *BITMAP, "signature"), "classes")
    buckets = indexed.select(F.explode(bucket_keys(F.col("signature"))).alias("key"), "rep")
    shared = buckets.groupBy("key").agg(F.min("rep").alias("head"), F.max("rep").alias("last")).filter(F.col("head") != F.col("last"))
    members = materialise(buckets.join(shared.select("key", "head"), "key"), "buckets")
    codes = indexed.drop("signature")

    def possible(pairs: DataFrame) -> DataFrame:
        a, b = codes.withColumnRenamed("rep", "src").alias("a"), codes.withColumnRenamed("rep", "dst").alias("b")
        return pairs.join(a, "src").join(b, "dst").filter(_close("a", "b")).select("src", "dst")

    stars = members.filter(F.col("rep") != F.col("head")).select(F.col("rep").alias("src"), F.col("head").alias("dst")).distinct()
    stars = materialise(possible(stars), "stars")
    links = materialise(confirm(stars, documents, width), "links")
    found = components(links)

    # what the stars have not connected: members of one bucket in different components
    placed = members.join(found.withColumnRenamed("node", "rep"), "rep", "left").select("key", "rep", F.coalesce("component", "rep").alias("component"))
    mixed = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("members")).filter(F.col("low") != F.col("high"))
    mixed = materialise(mixed.select("key", "members"), "mixed")
    open_ = materialise(placed.join(mixed.filter(F.col("members") <= LARGE), "key", "left_semi").join(codes, "rep"), "open")
    a, b = open_.alias("a"), open_.alias("b")
    across = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.component") < F.col("b.component")) & _close("a", "b"))
    rest = across.select(F.greatest("a.rep", "b.rep").alias("src"), F.least("a.rep", "b.rep").alias("dst"))
    crowded = materialise(placed.join(mixed.filter(F.col("members") > LARGE), "key", "left_semi").select("rep", "component").distinct(), "crowded")
    if not crowded.isEmpty():
        rest = rest.unionByName(possible(rare_pairs(crowded, documents, width)))
    rest = rest.distinct()
    rest = materialise(rest.join(stars, ["src", "dst"], "left_anti"), "rest")
    more = materialise(confirm(rest, documents, width), "links")
    if not more.isEmpty():
        found = components(found.select(F.col("node").alias("src"), F.col("component").alias("dst")).unionByName(more))

    # only classes of several rows or in a larger component need another id than their own
    moved = classes.join(found.withColumnRenamed("node", "rep"), "rep", "left").select(*identity, "rows", "rep", F.coalesce("component", "rep").alias("component"))
    moved = moved.filter((F.col("rows") > 1) | (F.col("rep") != F.col("component"))).drop("rows", "rep")
    # staged, so that the join is one of two plain tables, whose large partitions can be split
    moved = materialise(moved, "moved")
    out = sketches.select("doc_id", *identity).join(moved, identity, "left")
    component = F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("component"))
    return out.select("doc_id", "n_shingles", F.coalesce(component, F.col("doc_id")).alias("component_id"))


def representatives(documents: DataFrame, width: int) -> DataFrame:
    """One document of each group, the one with the smallest id, and all that are linked with nothing; own columns.

    Where ids repeat or are null, documents are told by id and text: one text of an id may go
    while another stays, of equal rows one stays, and a null id comes after all others.
    """
    odd = documents.groupBy("doc_id").agg(F.count("*").alias("rows")).filter((F.col("rows") > 1) | F.col("doc_id").isNull())
    if odd.isEmpty():
        gone = link(documents, width).filter(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
        return documents.join(gone, "doc_id", "left_anti").select(*documents.columns)
    names = {c: f"given_{i}" for i, c in enumerate(documents.columns)}
    held, number = F.col(names["text"]), F.col(names["doc_id"])
    text = [held.isNull().alias("none"), *(F.xxhash64(F.lit(k), held).alias(f"text_{k}") for k in range(2))]
    key = F.struct(number.isNull().alias("last"), number.alias("id"), *text)
    keyed = documents.withColumnsRenamed(names).withColumn("document_key", key)
    linked = link(keyed.select(F.col("document_key").alias("doc_id"), held.alias("text")), width)
    gone = linked.filter(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("document_key")).distinct()
    kept = keyed.join(gone, "document_key", "left_anti").dropDuplicates(["document_key"])
    return kept.select(*(F.col(name).alias(c) for c, name in names.items()))
