"""Near-duplicate vectors by sorted projection passes.

Vectors are comparable if their labels are equal and not null and they have as many components;
such vectors share a *room*. Rows with equal unit vectors in a room are one class, compared once.

1. Every pass concatenates ``HASHES`` random hashes of a vector: the place and sign of the
   largest of ``PROJECTIONS`` random projections. Classes are ordered by room, pass and these
   hashes, one after the other, by ranges over all tasks, and each is compared with the
   ``WINDOW`` next ones. Windows go on over the bound to the next range.
2. A comparison takes eight-bit components with an exact bound of their rounding error: it says
   linked, not linked or unsure. Links of a task are united before they leave it, so that a large
   group leaves a row per member and pass, not its pairs. Unsure pairs that are not connected so
   far are decided on the full vectors.
3. Links of all passes are united by connected components.
4. Links are counted exactly inside each component, since a link never leaves it. Components
   of up to ``BLOCK`` classes are compared in one go. In larger ones the angles to the mean decide
   most pairs: two angles that add up to no more than the threshold's angle are linked, two that
   differ by more are not. The pairs left have a member at more than half of that angle from the
   mean; such members are held against the others in blocks of about ``BLOCK``.

What a pass finds depends on chance. Measured on random vectors of 64 components, a pair exactly at the
threshold meets in 57, 37 and 28 of 100 passes over rooms of 3,000, 30,000 and 300,000 classes, and
in one of ten passes with 100, 99 and 98 %; rooms beyond that get more passes. Closer pairs meet
more often. A missed pair loses a link only if nothing else connects its component.

Vectors that are null, empty, zero, or hold null or non-finite components, and rows with a null
id or label, link with nothing; ``n_links`` is 0 and ``component_id`` their own id. Repeated rows
are rows of their own and link with each other. Different vectors of one id are one node: they
share a component, whether they link or not. Other columns are not looked at; an empty table
gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.llm import arrays
from rosterflow.llm.components import components
from rosterflow.session import materialise

COSINE = 0.93
PASSES, HASHES, PROJECTIONS, WINDOW = 10, 6, 32, 64
#: Classes in a room that ``PASSES`` passes suit, and passes more for each tenfold of them.
ROOM, MORE_PASSES = 300_000, 5
#: Classes compared with each other in one go.
BLOCK = 512
#: Rows of a chunk of a sorted range, and rows multiplied at a time.
CHUNK, STRIP = 20_000, 256
#: Steps of a half turn that angles to a mean are counted in.
STEPS = 2048
#: Two counted angles that add up to no more than this are linked for certain; 3 covers the rounding of both and of their sum.
CERTAIN = math.floor(math.acos(COSINE) / math.pi * STEPS) - 3


def units(column: pa.Array) -> tuple[list[np.ndarray | None], np.ndarray]:
    """Unit vector of each row, None for those that link with nothing; and the number of components."""
    out: list[np.ndarray | None] = []
    flat, bounds = column.flatten(), np.concatenate([[0], np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
    whole = flat.is_valid().to_numpy(zero_copy_only=False)
    values = np.where(whole, flat.fill_null(0.0).to_numpy(zero_copy_only=False).astype(np.float64), np.nan)
    for begin, end in zip(bounds, bounds[1:], strict=False):
        vector = values[begin:end]
        largest = np.abs(vector).max() if end > begin else 0.0
        if not np.isfinite(largest) or largest == 0.0:
            out.append(None)
            continue
        vector = vector / largest
        out.append(vector / math.sqrt(vector @ vector))
    return out, np.diff(bounds)


def _unit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found, sizes = units(batch.column(2))
        labels = batch.column(1).to_pylist()
        rooms = [f"{label}:{size}" if unit is not None and label is not None else None for unit, label, size in zip(found, labels, sizes, strict=True)]
        vectors = pa.array([u if r is not None else None for u, r in zip(found, rooms, strict=True)], pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rooms, pa.string()), vectors], ["vec_id", "room", "unit"])


@cache
def _projections(size: int, turn: int) -> np.ndarray:
    return np.random.default_rng([11, size, turn]).standard_normal((size, HASHES * PROJECTIONS)).astype(np.float32)


def sort_keys(vectors: np.ndarray, turn: int) -> np.ndarray:
    """The hashes of a pass, one after another, the first in the highest bits."""
    projected = (vectors.astype(np.float32) @ _projections(vectors.shape[1], turn)).reshape(len(vectors), HASHES, PROJECTIONS)
    largest = np.abs(projected).argmax(axis=2)
    positive = np.take_along_axis(projected, largest[:, :, None], 2)[:, :, 0] > 0
    keys = np.zeros(len(vectors), np.int64)
    for k in range(HASHES):
        keys = keys * (2 * PROJECTIONS) + 2 * largest[:, k] + positive[:, k]
    return keys


def rounded(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Eight-bit components, their scale, and the length of what rounding took away."""
    scale = np.abs(vectors).max(axis=1) / 127
    short = np.rint(vectors / scale[:, None])
    error = np.linalg.norm(vectors - short * scale[:, None], axis=1)
    return short.astype(np.int8), scale.astype(np.float32), (error + 1e-6).astype(np.float32)


def turns(classes: int) -> int:
    """Passes for a room of so many classes."""
    return PASSES + MORE_PASSES * max(0, math.ceil(math.log10(max(classes, 1) / ROOM)))


def _pass_rows(batches: Iterator[pa.RecordBatch], count: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = batch.column(2).value_lengths().to_numpy(zero_copy_only=False)
        for size in np.unique(sizes):
            part = batch.filter(pa.array(sizes == size))
            vectors = part.column(2).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, size)
            short, scale, error = rounded(vectors)
            spelled = pa.array([row.tobytes() for row in short], pa.binary())
            for turn in range(count):
                columns = [part.column(1), pa.array(np.full(part.num_rows, turn, np.int32)), pa.array(sort_keys(vectors, turn)), part.column(0), spelled, pa.array(scale), pa.array(error)]
                yield pa.RecordBatch.from_arrays(columns, ["room", "turn", "key", "node", "short", "scale", "error"])


_PASS_ROWS = "room string, turn int, key long, node long, short binary, scale float, error float"


def near_pairs(short: np.ndarray, scale: np.ndarray, error: np.ndarray, group: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of rows of one group at most ``WINDOW`` apart, the second from ``first`` on, that may be linked, and whether they surely are."""
    values, found = short.astype(np.float32), []
    for begin in range(max(0, first - WINDOW), len(values), STRIP):
        one, two = slice(begin, begin + STRIP), slice(begin, begin + STRIP + WINDOW)
        cosine = (values[one] @ values[two].T) * scale[one, None] * scale[None, two]
        slack = error[one, None] + (1 + error[one, None]) * error[None, two] + 1e-5
        ahead = np.arange(cosine.shape[1])[None] - np.arange(cosine.shape[0])[:, None]
        possible = (ahead > 0) & (ahead <= WINDOW) & (cosine + slack >= COSINE)
        i, j = np.nonzero(possible)
        kept = (group[begin + i] == group[begin + j]) & (begin + j >= first)
        i, j = i[kept], j[kept]
        found.append((begin + i, begin + j, cosine[i, j] - slack[i, j] >= COSINE))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
    return tuple(np.concatenate(parts) for parts in zip(*found, strict=True))


def united(count: int, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Least place of each place's group under the given pairs."""
    root = np.arange(count)
    while len(one):
        a, b = root[one], root[two]
        apart = a != b
        if not apart.any():
            break
        one, two, a, b = one[apart], two[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            above = root[root]
            if (above == root).all():
                break
            root = above
    return root


_FOUND = "kind int, bound long, place long, room string, turn int, node long, other long, short binary, scale float, error float"
SURE, UNSURE, EDGE = 0, 1, 2


def _found(kind: int, node: np.ndarray, other: np.ndarray) -> pa.RecordBatch:
    n = len(node)
    none = [pa.nulls(n, t) for t in (pa.int64(), pa.int64(), pa.string(), pa.int32())]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, kind, np.int32)), *none, pa.array(node), pa.array(other), pa.nulls(n, pa.binary()), pa.nulls(n, pa.float32()), pa.nulls(n, pa.float32())],
        ["kind", "bound", "place", "room", "turn", "node", "other", "short", "scale", "error"],
    )


def _compared(rows: pa.Table, first: int) -> Iterator[pa.RecordBatch]:
    """Links and unsure pairs among rows in order, whose second row is ``first`` or a later one."""
    if rows.num_rows < 2:
        return
    words = rows.column("short").combine_chunks()
    sizes = pc.binary_length(words).to_numpy(zero_copy_only=False)
    codes = [rows.column(c).combine_chunks().dictionary_encode("encode") for c in ("room", "turn", "bound")]
    parts = [c.indices.to_numpy(zero_copy_only=False) for c in codes]
    group = np.cumsum(np.concatenate([[0], np.any([np.diff(p) != 0 for p in parts], axis=0)]))
    node, scale, error = (rows.column(c).to_numpy() for c in ("node", "scale", "error"))
    bounds = np.concatenate([[0], np.flatnonzero(np.diff(sizes)) + 1, [len(sizes)]])
    for begin, end in zip(bounds, bounds[1:], strict=False):
        if end - begin < 2 or end <= first:
            continue
        short = np.frombuffer(b"".join(words.slice(begin, end - begin).to_pylist()), np.int8).reshape(end - begin, sizes[begin])
        here = slice(begin, end)
        one, two, sure = near_pairs(short, scale[here], error[here], group[here], max(0, first - begin))
        root = united(end - begin, one[sure], two[sure])
        tied = np.flatnonzero(root != np.arange(end - begin))
        yield _found(SURE, node[here][tied], node[here][root[tied]])
        open_ = ~sure & (root[one] != root[two])
        yield _found(UNSURE, node[here][one[open_]], node[here][two[open_]])


_ROW = ["bound", "room", "turn", "node", "short", "scale", "error"]


def _edge_rows(rows: pa.Table, bound: int, place: int) -> pa.RecordBatch:
    n = rows.num_rows
    columns = {c: rows.column(c).combine_chunks() for c in ("room", "turn", "node", "short", "scale", "error")}
    columns |= {"kind": pa.array(np.full(n, EDGE, np.int32)), "bound": pa.array(np.full(n, bound, np.int64)), "place": pa.array(np.arange(place, place + n)), "other": pa.nulls(n, pa.int64())}
    names = ["kind", "bound", "place", "room", "turn", "node", "other", "short", "scale", "error"]
    return pa.RecordBatch.from_arrays([columns[c] for c in names], names)


def _windows(batches: Iterator[pa.RecordBatch], edges: bool) -> Iterator[pa.RecordBatch]:
    block = TaskContext.get().partitionId()
    held, waiting, size, started = None, [], 0, 0

    def flush():
        nonlocal held, waiting, size
        new = pa.Table.from_batches(waiting)
        rows = new if held is None else pa.concat_tables([held, new])
        yield from _compared(rows, rows.num_rows - new.num_rows)
        held, waiting, size = rows.slice(max(0, rows.num_rows - WINDOW)), [], 0

    for batch in batches:
        if not batch.num_rows:
            continue
        batch = batch.select(_ROW)
        if edges and started < WINDOW:
            head = batch.slice(0, WINDOW - started)
            yield _edge_rows(pa.Table.from_batches([head]), block - 1, WINDOW + started)
            started += head.num_rows
        waiting.append(batch)
        size += batch.num_rows
        if size >= CHUNK:
            yield from flush()
    if waiting:
        yield from flush()
    if edges and held is not None:
        yield _edge_rows(held, block, WINDOW - held.num_rows)


def passes(classes: DataFrame) -> DataFrame:
    """Linked or connected pairs ``src, dst`` of nodes that the sorted passes find."""
    largest = classes.groupBy("room").count().agg(F.max("count")).first()[0] or 0
    rows = classes.select("node", "room", "unit").mapInArrow(lambda batches, count=turns(largest): _pass_rows(batches, count), _PASS_ROWS)
    order = ["room", "turn", "key", "node"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("bound", F.lit(None).cast("long"))
    found = materialise(dealt.mapInArrow(lambda batches: _windows(batches, True), _FOUND), "windows")
    edges = found.filter(F.col("kind") == EDGE).repartition("bound").sortWithinPartitions("bound", "place")
    found = materialise(found.filter(F.col("kind") != EDGE).unionByName(edges.mapInArrow(lambda batches: _windows(batches, False), _FOUND)).select("kind", "node", "other"), "found")
    unsure = found.filter(F.col("kind") == UNSURE).select(F.greatest("node", "other").alias("src"), F.least("node", "other").alias("dst")).distinct()
    sure = found.filter(F.col("kind") == SURE).select(F.col("node").alias("src"), F.col("other").alias("dst"))
    return sure.unionByName(_verified(unsure, classes))


def _verified(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    vectors = classes.select("node", "room", "unit")
    one = vectors.toDF("src", "room", "unit_one")
    two = vectors.toDF("dst", "room", "unit_two")
    cosine = F.aggregate(F.zip_with("unit_one", "unit_two", lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)
    return pairs.join(one, "src").join(two, ["dst", "room"]).filter(cosine >= COSINE).select("src", "dst")


def _groups(table: pa.Table, names: tuple[str, ...]) -> Iterator[pa.Table]:
    """Consecutive rows with equal values in ``names``."""
    changed = np.zeros(max(0, table.num_rows - 1), bool)
    for name in names:
        codes = table.column(name).combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
        changed |= codes[1:] != codes[:-1]
    bounds = np.concatenate([[0], np.flatnonzero(changed) + 1, [table.num_rows]])
    for begin, end in zip(bounds, bounds[1:], strict=False):
        yield table.slice(begin, end - begin)


def _streamed(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[pa.Table]:
    """Groups of sorted batches, one at a time; a group may go on in the next batch."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        groups = list(_groups(table if held is None else pa.concat_tables([held, table]), names))
        yield from groups[:-1]
        held = groups[-1]
    if held is not None:
        yield held


def _matrix(table: pa.Table) -> np.ndarray:
    column = table.column("unit").combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between the queries and the other rows of each block, counted for both; within small components every row is a query."""
    for group in _streamed(batches, ("component", "room", "query_block", "base_block")):
        query = group.column("query").to_numpy(zero_copy_only=False)
        asked, base = group.filter(pa.array(query)), group.filter(pa.array(~query))
        small = not base.num_rows
        base = asked if small else base
        if not asked.num_rows:
            continue
        linked = _matrix(asked) @ _matrix(base).T >= COSINE
        here, there = ([t.column(c).to_numpy() for c in ("node", "digest", "step", "rows")] for t in (asked, base))
        linked &= (here[0][:, None] != there[0][None]) | (here[1][:, None] != there[1][None])
        if not small:
            linked &= here[2][:, None] + there[2][None] > CERTAIN
        counts = [(here, linked @ there[3])]
        if not small:
            inner = 2 * there[2] <= CERTAIN
            counts.append(([v[inner] for v in there], here[3] @ linked[:, inner]))
        for (node, digest, _, _), links in counts:
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(digest), pa.array(links.astype(np.int64))], ["node", "digest", "links"])


_COUNTED = "node long, digest long, links long"


def _part_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            for group in _groups(pa.Table.from_batches([batch]).sort_by([("component", "ascending"), ("room", "ascending")]), ("component", "room")):
                columns = [group.column(c).combine_chunks().slice(0, 1) for c in ("component", "room")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([_matrix(group).sum(axis=0)], pa.list_(pa.float64()))], ["component", "room", "total"])


def count_links(members: DataFrame) -> DataFrame:
    """``node, digest, n_links`` of every class; ``members`` has ``component, room, node, digest, rows, unit``."""
    key = ["component", "room"]
    sizes = materialise(members.groupBy(*key).agg(F.count("*").alias("size")), "sizes")
    none = F.lit(None).cast("long")
    small = members.join(sizes.filter(F.col("size") <= BLOCK), key).withColumns({"query": F.lit(True), "step": F.lit(0).cast("long"), "query_block": F.lit(0).cast("long"), "base_block": F.lit(0).cast("long")})
    columns = [*key, "query_block", "base_block", "query", "node", "digest", "step", "rows", "unit"]
    own = (F.col("rows") - 1).alias("links")

    large = materialise(members.join(sizes.filter(F.col("size") > BLOCK), key), "large")
    # what is common to a large component is a row of STEPS values or of one vector
    parts = large.select(*key, "unit").mapInArrow(_part_sums, "component long, room string, total array<double>")
    sums = parts.select(*key, F.posexplode("total").alias("at", "value")).groupBy(*key, "at").agg(F.sum("value").alias("value"))
    means = sums.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "value"))), lambda x: x["value"]).alias("mean"))

    def dot(a, b):
        return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)

    length = F.sqrt(dot("mean", "mean"))
    cosine = F.when(length > 0, dot("unit", "mean") / length).otherwise(0.0)
    angle = F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), cosine)))
    placed = large.join(materialise(means, "means"), key).withColumn("step", F.floor(angle / math.pi * STEPS)).drop("mean")
    placed = materialise(placed, "placed")
    counts = placed.groupBy(*key, "step").agg(F.sum("rows").alias("held"), F.count("*").alias("classes"))
    counts = materialise(counts, "steps")
    others = counts.select(*key, F.col("step").alias("other"), F.col("held").alias("other_held"))
    certain = counts.join(others, key).filter(F.col("step") + F.col("other") <= CERTAIN).groupBy(*key, "step").agg(F.sum("other_held").alias("certain"))
    certain = placed.select(*key, "node", "digest", "rows", "step").join(certain, [*key, "step"], "left")
    # a class within half of the angle is among its own certain ones
    known = F.coalesce("certain", F.lit(0)) - F.when(2 * F.col("step") <= CERTAIN, 1).otherwise(1 - F.col("rows"))

    outer = 2 * F.col("step") > CERTAIN
    reach = counts.groupBy(*key).agg(F.max("step").alias("farthest"), F.sum(F.when(outer, F.col("classes")).otherwise(0)).alias("outer"), F.sum("classes").alias("size"))
    reach = reach.filter("outer > 0").withColumns({"query_blocks": F.ceil(F.col("outer") / BLOCK), "base_blocks": F.ceil(F.col("size") / BLOCK)})
    open_ = placed.drop("size").join(materialise(reach.drop("size", "outer"), "reach"), key).filter(F.col("step") + F.col("farthest") > CERTAIN)
    number = F.xxhash64("node", "digest")
    queries = open_.filter(outer).select(F.lit(True).alias("query"), "*", F.pmod(number, "query_blocks").alias("query_block"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("base_blocks") - 1)).alias("base_block"))
    bases = open_.select(F.lit(False).alias("query"), "*", F.pmod(number, "base_blocks").alias("base_block"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("query_blocks") - 1)).alias("query_block"))
    blocks = small.select(*columns).unionByName(queries.select(*columns)).unionByName(bases.select(*columns))
    dealt = blocks.repartition(*key, "query_block", "base_block").sortWithinPartitions(*key, "query_block", "base_block")
    counted = dealt.mapInArrow(_counted, _COUNTED)
    counted = counted.unionByName(small.select("node", "digest", own)).unionByName(certain.select("node", "digest", known.alias("links")))
    return counted.groupBy("node", "digest").agg(F.sum("links").alias("n_links"))


def link(embeddings: DataFrame) -> DataFrame:
    """``vec_id``, ``n_links`` and ``component_id`` of every row."""
    arrays.prepare(embeddings.sparkSession)
    label = F.when(F.col("vec_id").isNotNull(), F.col("label").cast("string"))
    given = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = given.mapInArrow(_unit_rows, "vec_id long, room string, unit array<double>")
    rows = materialise(rows.withColumns({"digest": F.xxhash64("unit"), "second": F.xxhash64(F.lit(1), "unit")}), "vectors")
    identity = ["room", "digest", "second"]
    classes = rows.filter(F.col("room").isNotNull()).groupBy(*identity).agg(F.min("vec_id").alias("node"), F.count("*").alias("rows"), F.any_value("unit").alias("unit"))
    classes = materialise(classes, "classes")
    found = materialise(components(passes(classes)), "components")
    placed = found.unionByName(found.select(F.col("component").alias("node"), "component").distinct())
    members = materialise(classes.join(placed, "node"), "members")
    counts = count_links(members)
    moved = members.select(*identity, "node", "component").join(counts, ["node", "digest"])
    alone = classes.filter("rows > 1").join(placed, "node", "left_anti").select(*identity, F.col("node").alias("component"), (F.col("rows") - 1).alias("n_links"))
    moved = materialise(moved.select(*identity, "component", "n_links").unionByName(alone), "moved")
    out = rows.select("vec_id", *identity).join(moved, identity, "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
