import itertools
import random

import pytest
from llm_cases import SCHEMA, empty_frame, lowered, odd_frame, odd_rows, spaced
from pyspark.sql import functions as F

from rosterflow.llm import near_dedup
from rosterflow.llm.components import components


def shingle_set(text, width):
    words = spaced(lowered(text))
    return {tuple(words)} if 0 < len(words) < width else {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def brute(rows, width):
    """Smallest id reachable over links of at least 80 percent, by comparing all pairs."""
    sets = [(r[0], shingle_set(r[1], width)) for r in rows]
    parent = {i: i for i, _ in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (a, one), (b, two) in itertools.combinations(sets, 2):
        if a is not None and b is not None and one and two and 100 * len(one & two) >= 80 * len(one | two):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return {(i, len(s), root(i)) for i, s in sets}


def found(documents, width):
    return {tuple(r) for r in near_dedup.link(documents, width).collect()}


@pytest.mark.parametrize("width", [2, 5])
def test_odd_rows(spark, width):
    assert found(odd_frame(spark, "key", "rep"), width) == brute(odd_rows(), width)


def test_empty_table(spark):
    assert found(empty_frame(spark), 2) == set()


def families(seed):
    """Chains and groups of edited copies, unrelated texts, a common passage, short texts."""
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(400)]
    passage = " ".join(rng.choices(vocabulary, k=60))
    rows = []
    for _ in range(12):
        words = rng.choices(vocabulary, k=rng.choice([5, 6, 12, 80, 300]))
        for _ in range(rng.choice([1, 2, 9])):
            rows.append(" ".join(words))
            words = list(words)
            for _ in range(rng.randint(0, max(1, len(words) // 18))):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
    rows += [passage + " " + " ".join(rng.choices(vocabulary, k=rng.choice([10, 40, 120]))) for _ in range(20)]
    rows += [" ".join(rng.choices(["a", "b"], k=rng.randint(1, 5))) for _ in range(25)]
    rng.shuffle(rows)
    return [(i, t, None, None, None) for i, t in enumerate(rows)]


@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_all_pairs(spark, seed):
    rows = families(seed)
    assert found(spark.createDataFrame(rows, SCHEMA), 2) == brute(rows, 2)


@pytest.mark.parametrize("seed", [4, 5])
def test_large_buckets_by_rare_shingles_give_the_same(spark, monkeypatch, seed):
    rows = families(seed)
    monkeypatch.setattr(near_dedup, "LARGE", 2)
    assert found(spark.createDataFrame(rows, SCHEMA), 2) == brute(rows, 2)


def templated(count, seed=1):
    """Pages of one template that are no duplicates (similarity about 0.57), the first ten of them with a near copy."""
    chance = random.Random(seed)
    template = " ".join(f"t{i}" for i in range(120))
    texts = [template + " " + " ".join(f"o{chance.randrange(10**9)}" for _ in range(45)) for _ in range(count)]
    return list(enumerate(texts + [t + " end" for t in texts[:10]]))


def test_templated_pages_meet_only_their_copies(spark):
    for count in (300, 1200):
        rows = templated(count)
        frame = spark.createDataFrame(rows, "doc_id long, text string")
        members = frame.select(F.col("doc_id").alias("rep"), F.col("doc_id").alias("component"))
        assert sorted(map(tuple, near_dedup.rare_pairs(members, frame, 2).collect())) == [(count + i, i) for i in range(10)]
    linked = near_dedup.link(frame, 2).filter("doc_id != component_id").collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in linked) == [(1200 + i, i) for i in range(10)]


def test_shuffled_ids_give_the_same(spark, monkeypatch):
    rows = families(3)
    monkeypatch.setattr(near_dedup, "BROADCAST_ROWS", 0)
    assert found(spark.createDataFrame(rows, SCHEMA), 2) == brute(rows, 2)


def test_one_of_each_group_stays(spark):
    frame = odd_frame(spark, "component_id")
    kept = near_dedup.representatives(frame, 2)
    assert kept.columns == frame.columns
    gone = {i for i, _, c in brute(odd_rows(), 2) if i != c}
    assert sorted(r[0] for r in kept.select("doc_id").collect()) == sorted({r[0] for r in odd_rows() if r[0] is not None} - gone)


def test_texts_of_one_id_are_judged_one_by_one(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(50)) for x in "abc")
    near = a.replace("a7 ", "other ")
    rows = [(1, a), (2, a), (2, b), (3, c), (3, c), (None, b), (None, c + " more"), (None, "alone"), (4, None), (4, ""), (5, near), (6, near + " end"), (6, "x y z")]
    for order in (rows, rows[::-1]):
        kept = near_dedup.representatives(spark.createDataFrame([(*r, "old") for r in order], "doc_id long, text string, document_key string"), 2)
        assert sorted(map(tuple, kept.collect()), key=str) == sorted([(1, a, "old"), (2, b, "old"), (3, c, "old"), (None, "alone", "old"), (4, None, "old"), (4, "", "old"), (6, "x y z", "old")], key=str)


def test_every_pair_under_the_threshold_shares_a_key(spark):
    rng = random.Random(5)
    one = bytes(rng.randrange(256) for _ in range(2 * near_dedup.PLACES))
    rows = [(0, bytearray(one))]
    for i in range(1, 40):
        other = bytearray(one)
        for place in rng.sample(range(near_dedup.PLACES), near_dedup.MOST_ERRORS):
            other[2 * place] ^= 1 + rng.randrange(255)
        rows.append((i, other))
    keyed = spark.createDataFrame(rows, "id int, signature binary").select("id", near_dedup.bucket_keys(F.col("signature")).alias("keys")).collect()
    first = set(keyed[0]["keys"])
    assert len(first) == near_dedup.PLACES
    assert all(first & set(r["keys"]) for r in keyed)


def test_components_of_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(100, 130)]
    star = [(7, i) for i in range(200, 260)]
    edges = [*chain, *star, (5, 5), (None, 3), (1, 7), (300, 301), (301, 300)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {i: 100 for i in range(101, 131)} | {i: 1 for i in [7, *range(200, 260)]} | {301: 300}
    assert components(spark.createDataFrame([], "src long, dst long")).isEmpty()
