"""Sorted projection passes against all pairs."""

from __future__ import annotations

import math

import numpy as np
import pytest

from rosterflow.llm import sorted_passes

SCHEMA = "vec_id long, embedding array<float>, label int, component_id long"


def near(random, centre, count, cosine):
    """Vectors whose cosine with each other is about ``cosine``."""
    noise = random.standard_normal((count, len(centre))) / math.sqrt(len(centre))
    return centre + noise * math.sqrt(1 / cosine - 1)


@pytest.fixture(scope="module")
def vectors():
    random = np.random.default_rng(3)

    def unit(count):
        x = random.standard_normal((count, 64))
        return x / np.linalg.norm(x, axis=1)[:, None]

    rows = [(v, int(i % 3)) for i, v in enumerate(unit(1500))]
    for size, cosine, label in [(2, 0.97, 0), (3, 0.95, 1), (5, 0.94, 2), (700, 0.97, 0), (600, 0.935, 1), (40, 0.93, 2)]:
        rows += [(v, label) for v in near(random, unit(1)[0], size, cosine)]
    rows += [(rows[0][0], 0)] * 30 + [(rows[0][0], 1)]
    return [(i, [float(np.float32(x)) for x in v], label) for i, (v, label) in enumerate(random.permutation(np.array(rows, object)).tolist())]


def expected(rows):
    found = {}
    for label in {r[2] for r in rows}:
        ids = [r[0] for r in rows if r[2] == label]
        x = np.array([r[1] for r in rows if r[2] == label])
        x = x / np.linalg.norm(x, axis=1)[:, None]
        linked = x @ x.T >= sorted_passes.COSINE
        np.fill_diagonal(linked, False)
        least = np.array(ids)
        while True:
            new = np.minimum(least, np.where(linked, least[None], 1 << 60).min(axis=1))
            if (new == least).all():
                break
            least = new
        found |= {i: (int(n), int(c)) for i, n, c in zip(ids, linked.sum(axis=1), least, strict=True)}
    return found


def test_links_and_components_equal_all_pairs(spark, vectors):
    frame = spark.createDataFrame([(*r, -1) for r in vectors], SCHEMA).repartition(5)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in sorted_passes.link(frame).collect()}
    want = expected(vectors)
    assert got.keys() == want.keys()
    links = sum(n for n, _ in want.values())
    assert sum(min(got[i][0], want[i][0]) for i in want) >= 0.99 * links
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(got[i] == want[i] for i in want) >= 0.99 * len(want)


def test_odd_rows_link_with_nothing(spark):
    one = [1.0, 0.0, 0.0]
    rows = [
        (1, one, 0, 9), (2, one, None, 9), (3, None, 0, 9), (4, [], 0, 9), (5, [0.0, 0.0, 0.0], 0, 9), (6, [1.0, None, 0.0], 0, 9),
        (7, [math.nan, 1.0, 0.0], 0, 9), (8, [math.inf, 0.0, 0.0], 0, 9), (9, [1.0, 0.0], 0, 9), (None, one, 0, 9), (10, [2.0, 0.0, 0.0], 0, 9), (11, one, 1, 9), (1, one, 0, 9),
    ]
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in sorted_passes.link(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    alone = [(i, 0, i) for i in (2, 3, 4, 5, 6, 7, 8, 9, 11, None)]
    assert got == sorted([*alone, (1, 2, 1), (1, 2, 1), (10, 2, 1)], key=str)


def test_no_rows(spark):
    assert sorted_passes.link(spark.createDataFrame([], SCHEMA)).collect() == []


def test_rounding_never_decides_wrongly():
    random = np.random.default_rng(5)
    x = near(random, random.standard_normal(64) / 8, 3000, 0.93)
    x /= np.linalg.norm(x, axis=1)[:, None]
    one, two, sure = sorted_passes.near_pairs(*sorted_passes.rounded(x), np.zeros(len(x), int), 0)
    cosine = np.einsum("ij,ij->i", x[one], x[two])
    assert (cosine[sure] >= sorted_passes.COSINE).all()
    pairs = set(zip(one.tolist(), two.tolist(), strict=True))
    exact = x @ x.T
    missed = [(i, j) for i in range(len(x)) for j in range(i + 1, min(len(x), i + 1 + sorted_passes.WINDOW)) if exact[i, j] >= sorted_passes.COSINE and (i, j) not in pairs]
    assert not missed and len(pairs) > len(x)


@pytest.mark.parametrize("count", [3000, 30000])
def test_recall_of_pairs_at_the_threshold(count):
    random = np.random.default_rng(8)
    x = random.standard_normal((count, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    y = x[:300] * 0.935 + np.sqrt(1 - 0.935**2) * (lambda z: z / np.linalg.norm(z, axis=1)[:, None])(np.stack([v - (v @ u) * u for v, u in zip(random.standard_normal((300, 64)), x[:300], strict=True)]))
    rows = np.concatenate([x, y])
    met = np.zeros(300, bool)
    for turn in range(sorted_passes.PASSES):
        place = np.empty(len(rows), int)
        place[np.argsort(sorted_passes.sort_keys(rows, turn), kind="stable")] = np.arange(len(rows))
        met |= np.abs(place[:300] - place[count:]) <= sorted_passes.WINDOW
    assert met.mean() >= 0.9
