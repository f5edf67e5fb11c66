"""Trie of conversation prefixes by a minimal-perfect-hash node table.

A conversation is rebuilt as the first ``h`` turns of the first conversation of its group of
``GROUP`` ids, ``h`` being the crc32 of its id modulo ``HEADS``, and its own turns after its
first ``h``. Every distinct sequence of first turns is a node.

1. Turns are numbered in their conversations and every prefix gets a 128-bit digest, the xor of
   the digests of its turns, each salted with its place. Both run over ranges of rows, so that a
   conversation of any length is spread over tasks (:mod:`rosterflow.llm.runs`).
2. Distinct digests are enumerated with their counts; an aggregate verifies that all members of
   a node have the same last turn and the same parent.
3. Nodes are dealt to shards by ranges of their smallest member and depth: nodes with one
   smallest member are a path, so that most parents are in their children's shard, and a path of
   any length is cut. A shard assigns its digests to the slots of a minimal perfect hash, every
   look-up compares the digest of the slot; counts are scattered to flat arrays, and sums flow
   from slot to parent slot in depth order.
4. What a shard's topmost nodes pass on to nodes of other shards is summed up over the forest of
   these topmost nodes by pointer doubling, in a number of rounds that is the logarithm of the
   number of shards on a path, and is scattered to its target slots before a second, final pass.
5. Ids of the conversations that end at a node are joined to text in parallel runs of the sorted
   ids; only the digest over these runs is sequential, as its definition asks, and streams.

Rows with a null ``conv_id`` are left out. Null roles and texts are empty. Rows are ordered by
turn, null first; equal turns by their digests, so that repeated rows are turns of their own.
Ids are divided as SQL does (``-21 % 20 = -1``). A conversation whose rebuilt form has no turn
belongs to the root alone. An empty table has no nodes. Columns other than ``conv_id``,
``turn``, ``role`` and ``text`` are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterflow.llm import arrays
from rosterflow.llm.perfect_hash import SlotTable
from rosterflow.llm.runs import ordered_runs
from rosterflow.session import materialise

#: Conversations that take their first turns from the first of them, and the bound of these turns.
GROUP, HEADS = 20, 4
#: Nodes of a shard, about.
SHARD_NODES = 200_000
WORDS = r"[^\x20\x09-\x0D]+"

NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def _digests(*parts: Column | str) -> tuple[Column, Column]:
    return F.xxhash64(F.lit("a"), *parts), F.xxhash64(F.lit("b"), *parts)


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows ``conv_id, k, turn_a, turn_b, words, last`` of the rebuilt conversations, and ids of those without a turn."""
    text, role = F.coalesce(F.col("text").cast("string"), F.lit("")), F.coalesce(F.col("role").cast("string"), F.lit(""))
    turn_a, turn_b = _digests(role, text)
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", turn_a.alias("turn_a"), turn_b.alias("turn_b"), F.regexp_count(text, F.lit(WORDS)).cast("long").alias("words")
    )
    order = [F.col("turn").asc_nulls_first(), F.col("turn_a"), F.col("turn_b")]
    turns = materialise(ordered_runs(rows, "conv_id", order, "turns").drop("turn"), "turns")
    own = turns.groupBy("conv_id").agg(F.max("place").alias("own"))
    heads = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    bases = own.select(F.col("conv_id").alias("base"), F.col("own").alias("base_own"))
    ids = own.select("conv_id", "own", heads.alias("h"), (F.col("conv_id") - F.col("conv_id") % GROUP).alias("base")).join(bases, "base", "left")
    ids = materialise(ids.withColumn("given", F.least("h", F.coalesce("base_own", F.lit(0)))), "conversations")
    firsts = turns.filter(F.col("place") < HEADS).withColumnRenamed("conv_id", "base")
    front = ids.filter("given > 0").join(firsts, "base").filter("place <= given")
    front = front.select("conv_id", F.col("place").alias("k"), "turn_a", "turn_b", "words", ((F.col("place") == F.col("given")) & (F.col("own") <= F.col("h"))).alias("last"))
    rest = turns.join(ids.filter("own > h").select("conv_id", "own", "h", "given"), "conv_id").filter("place > h")
    rest = rest.select("conv_id", (F.col("place") - F.col("h") + F.col("given")).alias("k"), "turn_a", "turn_b", "words", (F.col("place") == F.col("own")).alias("last"))
    return front.unionByName(rest), ids.filter("given = 0 and own <= h").select("conv_id")


def prefixes(rows: DataFrame) -> DataFrame:
    """The rebuilt rows with digests ``a, b`` of their prefix and ``parent_a, parent_b`` of the one before."""
    salted_a, salted_b = _digests("k", "turn_a", "turn_b")
    rows = rows.withColumns({"salted_a": salted_a, "salted_b": salted_b})
    runs = ordered_runs(rows, "conv_id", [F.col("k")], "prefixes", ("salted_a", "salted_b"))
    parent = [F.col(f"running_{i}").bitwiseXOR(F.col(f"salted_{x}")).alias(f"parent_{x}") for i, x in enumerate("ab")]
    seen = F.xxhash64(*parent, "turn_a", "turn_b").alias("seen")
    return materialise(runs.select("conv_id", F.col("k").alias("depth"), F.col("running_0").alias("a"), F.col("running_1").alias("b"), *parent, seen, "words", "last"), "prefixes")


def enumerate_nodes(found: DataFrame, turnless: DataFrame) -> DataFrame:
    """One verified row per distinct prefix and the root, with its parent's smallest member and its number of children."""
    one = F.max("depth") == F.min("depth")
    verified = F.when(one & (F.min("seen") == F.max("seen")), F.count("*")).otherwise(F.raise_error(F.lit("two prefixes have one digest")).cast("long"))
    members = found.groupBy("a", "b").agg(F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), verified.alias("n_convs"), *(F.max(c).alias(c) for c in ("words", "parent_a", "parent_b")))
    all_ids = found.filter("depth = 1").select("conv_id").unionByName(turnless)
    zero = F.lit(0).cast("long")
    root = all_ids.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0")
    root = root.select(zero.alias("a"), zero.alias("b"), "conv_id", zero.alias("depth"), "n_convs", zero.alias("words"), *(F.lit(None).cast("long").alias(c) for c in ("parent_a", "parent_b")))
    nodes = materialise(members.unionByName(root), "nodes")
    owners = nodes.select(F.col("a").alias("parent_a"), F.col("b").alias("parent_b"), F.col("conv_id").alias("parent_conv_id"))
    children = nodes.filter("depth > 0").groupBy(F.col("parent_a").alias("a"), F.col("parent_b").alias("b")).agg(F.count("*").alias("n_children"))
    counted = nodes.join(children, ["a", "b"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    return counted.join(owners, ["parent_a", "parent_b"], "left")


class Shard:
    """Node table of one shard: slots, parent slots, and sums that flow to parents in depth order."""

    def __init__(self, nodes: pa.Table):
        self.column = {name: nodes.column(name).fill_null(0).to_numpy() for name in ("a", "b", "parent_a", "parent_b", "depth", "n_convs", "n_children", "words")}
        self.table = SlotTable(self.column["a"], self.column["b"])
        inner = self.column["depth"] > 0
        parent = np.where(inner, self.table.find(self.column["parent_a"], self.column["parent_b"]), -1)
        self.parent, self.depth = np.empty_like(parent), np.empty_like(parent)
        self.parent[self.table.slot], self.depth[self.table.slot] = parent, self.column["depth"]
        self.leaves = self.scattered(self.column["n_children"] == 0)
        self.saved = self.scattered((self.column["n_convs"] - 1) * self.column["words"])

    def scattered(self, values: np.ndarray) -> np.ndarray:
        out = np.zeros(len(values), np.int64)
        out[self.table.slot] = values
        return out

    def levels(self) -> list[np.ndarray]:
        """Slots by depth, least first."""
        order = np.argsort(self.depth, kind="stable")
        return np.split(order, np.flatnonzero(np.diff(self.depth[order])) + 1)

    def accumulate(self) -> None:
        for slots in reversed(self.levels()):
            held = slots[self.parent[slots] >= 0]
            np.add.at(self.leaves, self.parent[held], self.leaves[held])
            np.add.at(self.saved, self.parent[held], self.saved[held])

    def tops(self) -> np.ndarray:
        """Slot of the topmost node above each slot, itself included."""
        top = np.arange(len(self.parent))
        for slots in self.levels():
            held = slots[self.parent[slots] >= 0]
            top[held] = top[self.parent[held]]
        return top


def _local(nodes: pa.Table) -> pa.Table:
    shard = Shard(nodes)
    shard.accumulate()
    slot, tops = shard.table.slot, shard.tops()
    added = {"top_a": shard.table.a[tops][slot], "top_b": shard.table.b[tops][slot], "leaves": shard.leaves[slot], "saved": shard.saved[slot]}
    kept = nodes.select(["shard", "a", "b", "parent_a", "parent_b", "depth"])
    for name, values in added.items():
        kept = kept.append_column(name, pa.array(values))
    return kept


_LOCAL = "shard long, a long, b long, parent_a long, parent_b long, depth long, top_a long, top_b long, leaves long, saved long"


def _final(nodes: pa.Table, passed: pa.Table) -> pa.Table:
    shard = Shard(nodes)
    at = shard.table.find(passed.column("a").to_numpy(), passed.column("b").to_numpy())
    np.add.at(shard.leaves, at, passed.column("leaves").to_numpy())
    np.add.at(shard.saved, at, passed.column("saved").to_numpy())
    shard.accumulate()
    slot = shard.table.slot
    kept = nodes.select(["a", "b", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children"])
    return kept.append_column("n_leaves", pa.array(shard.leaves[slot])).append_column("saved_tokens", pa.array(shard.saved[slot]))


_FINAL = "a long, b long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"


def _full_sums(tops: DataFrame) -> DataFrame:
    """Sums over whole subtrees for topmost nodes ``a, b`` that hang on ``up_a, up_b``, by pointer doubling."""
    while not tops.filter(F.col("up_a").isNotNull()).isEmpty():
        passed = tops.filter(F.col("up_a").isNotNull()).groupBy(F.col("up_a").alias("a"), F.col("up_b").alias("b")).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        above = tops.select(F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("up_a").alias("next_a"), F.col("up_b").alias("next_b"))
        sums = [(F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c) for c in ("leaves", "saved")]
        joined = tops.join(passed, ["a", "b"], "left").join(above, ["up_a", "up_b"], "left")
        tops = materialise(joined.select("a", "b", F.col("next_a").alias("up_a"), F.col("next_b").alias("up_b"), *sums), "tops")
    return tops


def accumulate(nodes: DataFrame, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """Nodes with ``n_leaves`` and ``saved_tokens`` over their subtrees."""
    nodes = materialise(nodes, "counted")
    shards = max(1, -(-nodes.count() // shard_nodes))
    dealt = materialise(nodes.repartitionByRange(shards, "conv_id", "depth").withColumn("shard", F.spark_partition_id().cast("long")), "shards")
    local = materialise(dealt.groupBy("shard").applyInArrow(_local, _LOCAL), "local")
    top = local.filter("a = top_a and b = top_b")
    above = local.select(F.col("a").alias("parent_a"), F.col("b").alias("parent_b"), F.col("top_a").alias("up_a"), F.col("top_b").alias("up_b"), F.col("shard").alias("up_shard"))
    tops = materialise(top.drop("shard", "top_a", "top_b").join(above, ["parent_a", "parent_b"], "left"), "tops")
    full = _full_sums(tops.select("a", "b", "up_a", "up_b", "leaves", "saved"))
    targets = tops.filter(F.col("up_a").isNotNull()).select("a", "b", "parent_a", "parent_b", "up_shard")
    passed = targets.join(full, ["a", "b"]).groupBy(F.col("up_shard").alias("shard"), F.col("parent_a").alias("a"), F.col("parent_b").alias("b"))
    passed = passed.agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    return dealt.groupBy("shard").cogroup(passed.groupBy("shard")).applyInArrow(_final, _FINAL)


def _runs_of_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b, ids = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        bounds = np.concatenate([[0], np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1])) + 1, [len(a)]])
        texts = [",".join(map(str, ids[i:j].tolist())) for i, j in zip(bounds, bounds[1:], strict=False)]
        yield pa.RecordBatch.from_arrays([*(pa.array(v[bounds[:-1]]) for v in (a, b, ids)), pa.array(texts)], ["a", "b", "first", "ids"])


def _digest_of_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    node, digest, done = None, None, []
    for batch in batches:
        for a, b, ids in zip(*(batch.column(name).to_pylist() for name in ("a", "b", "ids")), strict=True):
            if (a, b) != node:
                if node is not None:
                    done.append((*node, digest.hexdigest()))
                node, digest = (a, b), hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in zip(*done, strict=True)], ["a", "b", "ends_sha256"])
            done = []
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*node, digest.hexdigest())], ["a", "b", "ends_sha256"])


def end_digests(ends: DataFrame) -> DataFrame:
    """``a, b`` and the digest of the sorted ids of the conversations that end there."""
    arrays.prepare(ends.sparkSession)
    keys = ["a", "b", "conv_id"]
    runs = ends.select(*keys).repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(_runs_of_ids, "a long, b long, first long, ids string")
    return runs.repartition("a", "b").sortWithinPartitions("a", "b", "first").mapInArrow(_digest_of_runs, "a long, b long, ends_sha256 string")


def trie(conversations: DataFrame, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """The columns ``NODE`` of every node of the trie of rebuilt conversations."""
    rows, turnless = rebuilt(conversations)
    turnless = materialise(turnless, "turnless")
    found = prefixes(rows)
    nodes = accumulate(enumerate_nodes(found, turnless), shard_nodes)
    zero = F.lit(0).cast("long")
    ends = found.filter("last").select("a", "b", "conv_id").unionByName(turnless.select(zero.alias("a"), zero.alias("b"), "conv_id"))
    joined = nodes.join(end_digests(ends), ["a", "b"], "left")
    return joined.withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256))).select(*NODE)
