"""Phrases by weighted transducers, against plain counting."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from rosterflow.llm import phrase_transducers as pt

SCHEMA = "doc_id long, text string, lang string, rank long, phrase string"


def counted(rows):
    found = Counter()
    for _, text, lang, *_ in rows:
        folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", folded):
            words = re.findall(r"[^\x20\x09]+", piece)
            for n in (1, 2, 3):
                for i in range(len(words) - n + 1):
                    found["und" if lang is None else lang, tuple(words[i : i + n])] += 1
    return found


def expected(rows):
    f = counted(rows)
    totals = Counter()
    for (lang, words), n in f.items():
        totals[lang] += n if len(words) == 1 else 0
    candidates = {key: n for key, n in f.items() if len(key[1]) > 1 and n >= pt.LEAST}
    out = []
    for (lang, words), a in candidates.items():
        longer = [n for (other, w), n in candidates.items() if other == lang and len(w) > len(words) and any(w[i : i + len(words)] == words for i in range(len(w)))]
        if any(100 * n >= 50 * a for n in longer):
            continue
        score, _, left, right = min((1000000 * a * a // (f[lang, words[:k]] * f[lang, words[k:]]), k, f[lang, words[:k]], f[lang, words[k:]]) for k in range(1, len(words)))
        out.append((lang, -score, -a, " ".join(words).encode(), left, right))
    ranked, place = [], Counter()
    for lang, score, a, phrase, left, right in sorted(out):
        place[lang] += 1
        if place[lang] <= pt.TOP:
            ranked.append((lang, place[lang], phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(ranked)


@pytest.fixture(scope="module")
def rows():
    chance = random.Random(4)
    words = [f"{c}{d}" for c in "abcdé" for d in "xyZ"] + ["the", "The", "of", "zürich", "x" * 300]
    out = []
    for i in range(400):
        said = [chance.choices(words, [30] + [1] * (len(words) - 1))[0] for _ in range(chance.randrange(60))]
        for _ in range(chance.randrange(3)):
            said[len(said) // 2 : len(said) // 2] = ["new", "York", "city"]
        text = "".join(w + chance.choice([" ", " ", "  ", "\t", ", ", ".", "\n", "!\r\n"]) for w in said)
        out.append((i, text, chance.choice(["en", "en", "de", None, "e", "und"]), 7, "q"))
    out += [(900, None, "en", 0, ""), (901, "", "de", 0, ""), (902, " ,.; \n", "fr", 0, ""), (903, "only " * 3000, "en", 0, ""), (903, "only " * 3000, "en", 0, "")]
    return out


@pytest.mark.parametrize("range_words", [pt.RANGE_WORDS, 700])
def test_phrases_equal_plain_counting(spark, rows, range_words):
    got = pt.phrases(spark.createDataFrame(rows, SCHEMA).repartition(4), range_words)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == expected(rows)


def test_no_rows(spark):
    assert pt.phrases(spark.createDataFrame([], SCHEMA)).collect() == []


def paths(transducer):
    words = [transducer.lexicon.take(pa.array(c)).to_pylist() for c in transducer.paths()]
    return dict(zip(zip(*words, strict=True), transducer.weights.tolist(), strict=True))


@pytest.mark.parametrize("size", [2, 3])
def test_transducers_hold_and_unite_weighted_paths(size):
    chance = np.random.default_rng(size)
    lexicon = pa.array([b"a", b"ab", b"b", b"c", b"\xc3\xa9"], pa.binary())
    parts, total = [], Counter()
    for _ in range(4):
        table = np.unique(chance.integers(0, 5, (30, size)), axis=0)
        weights = chance.integers(1, 400, len(table))
        part = pt.Transducer.from_bytes(pt.Transducer.build(lexicon, list(table.T), weights).to_bytes())
        names = lexicon.to_pylist()
        assert paths(part) == {tuple(names[i] for i in row): w for row, w in zip(table.tolist(), weights.tolist(), strict=True)}
        assert len(part.labels[0]) == len(np.unique(table[:, 0]))  # common prefixes are one state
        parts.append(part)
        total.update(paths(part))
    assert paths(pt.united(parts)) == dict(total)


def test_composition_finds_the_weights_of_paths():
    counts = pa.table({"lang": ["a", "a", "b", "a"], "phrase": ["x", "x y", "x", "é z"], "f": [5, 3, 9, 2]})
    wanted = pa.table({"lang": ["b", "a", "a", "a", "c"], "phrase": ["x", "x y", "é", "é z", "x"]})
    assert sorted(map(tuple, zip(*pt.composed(wanted, counts).to_pydict().values(), strict=True))) == [("a", "x y", 3), ("a", "é z", 2), ("b", "x", 9)]
    assert pt.composed(wanted, counts.slice(0, 0)).num_rows == 0


def test_ranges_split_a_common_word(spark):
    words = spark.createDataFrame([("en", "the", 400), *(("en", f"w{i:03}", 1) for i in range(600))], "lang string, phrase string, f long")
    bounds = pt.range_bounds(words, 1000, 100)
    assert 3 <= sum(b[1] == b"the" for b in bounds) <= 5
    assert 7 <= len(bounds) <= 10 and bounds == sorted(set(bounds))
