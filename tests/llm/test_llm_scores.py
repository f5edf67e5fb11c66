"""Quality classifier, quality rules, toxicity and language-model scores."""

import collections
import math
import random

import numpy as np
import pyarrow as pa
from llm_cases import MEDIUM, SMALL, empty_frame, lowered, odd_frame, odd_rows, remainder, small, spaced
from pyspark.sql import functions as F

from rosterflow.llm import arrays, learning, ngram_automaton, quality_classifier, quality_rules, toxicity
from rosterflow.llm.queries import QUERIES

LABELS = "doc_id long, quality int, toxic int"
COUNTS = quality_rules.COUNTS


def held_out_accuracy(spark, name, target):
    right = dict(small(f"SELECT doc_id, {target} FROM 'SF/labels.parquet'", MEDIUM))
    rows = [r for r in QUERIES[name](spark, MEDIUM).collect() if r["doc_id"] in right]
    assert all(r["held_out"] == (remainder(r["doc_id"], 5) == 0) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    return sum(r["predicted"] == right[r["doc_id"]] for r in held) / len(held)


def test_held_out_quality(spark):
    assert held_out_accuracy(spark, "op3_quality_classifier", "quality") >= 0.95


def test_held_out_toxicity(spark):
    assert held_out_accuracy(spark, "op5_toxicity", "toxic") >= 0.85


def test_labels_of_held_out_rows_are_not_read(spark):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(200)] + [(3, 1, 1), (None, 1, 1), (7, None, None)], LABELS)
    used = {r["doc_id"]: r["label"] for r in learning.training_labels(labels, "quality").collect()}
    assert set(used) == {i for i in range(200) if remainder(i, 5)}
    assert used[3] == 1


def test_classifiers_without_labels_or_documents(spark):
    labels = spark.createDataFrame([], LABELS)
    for module in (quality_classifier, toxicity):
        model = module.fit(odd_frame(spark), labels)
        scored = module.score(odd_frame(spark, "score", "label"), model)
        assert scored.columns[-1] == "score" and "label" in scored.columns
        assert scored.count() == len(odd_rows())
        assert {r["score"] for r in scored.collect()} == {1 / (1 + math.exp(-model.bias))}
        assert module.score(empty_frame(spark), model).isEmpty()


def brute_counts(text):
    words, text = spaced(text), text or ""
    places = collections.defaultdict(list)
    for i in range(len(words) - 7):
        places[tuple(words[i : i + 8])].append(i)
    repeated = {j for v in places.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
    lines = [line for line in text.split("\n") if spaced(line)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated))


def test_ratios_come_from_counts_over_all_tasks(spark, monkeypatch):
    """Counts of documents that have a feature, by hand, in two levels of sums; and their log ratios."""
    monkeypatch.setattr(toxicity, "TOGETHER", 2)
    settings = toxicity.Settings()
    rows = [("bad word", 1), ("bad bad thing", 1), ("good word", 0), ("thing", 0), ("", 0), ("bad", 1), ("good", 0)]
    negative, positive, counted = toxicity.document_counts(spark.createDataFrame(rows, "text string, label int").repartition(7), settings)
    assert counted.tolist() == [4, 3]
    for label, have in ((0, negative), (1, positive)):
        want = np.zeros(1 << settings.bits)
        for text, of in rows:
            if of == label:
                buckets, _ = toxicity.features(arrays.Texts(pa.array([text])), settings)
                want[np.unique(buckets)] += 1
        assert (have == want).all()
    ratio = toxicity.ratios(negative, positive, settings)
    p, q = positive + settings.smoothing, negative + settings.smoothing
    bucket = int(np.argmax(positive - negative))
    assert math.isclose(ratio[bucket], math.log(p[bucket] / p.sum()) - math.log(q[bucket] / q.sum())) and ratio[bucket] > 0


def test_base_counts_and_rule(spark):
    texts = [t for (t,) in small("SELECT text FROM 'SF/documents.parquet'")]
    base, rows = quality_rules.statistics(pa.array(texts))
    assert list(map(tuple, base.tolist())) == list(map(brute_counts, texts))
    assert rows.shape == (len(texts), len(quality_rules.STATISTICS))
    trees = quality_rules.fit(odd_frame(spark), spark.createDataFrame([], LABELS))
    judged = quality_rules.judge(odd_frame(spark, "kept", "score"), trees).collect()
    expected = collections.Counter((r[0], *brute_counts(r[1])) for r in odd_rows())
    assert collections.Counter((r["doc_id"], *(r[c] for c in COUNTS)) for r in judged) == expected
    for r in judged:
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])
    assert quality_rules.judge(empty_frame(spark), trees).isEmpty()


def test_trees_are_monotonic_and_flattened_right():
    rng = np.random.default_rng(1)
    rows = rng.random((3000, len(quality_rules.STATISTICS)))
    labels = ((rows[:, 2] < 0.6) & (rows[:, 5] > 0.3) ^ (rng.random(3000) < 0.1)).astype(float)
    trees = quality_rules.grow(rows, labels, quality_rules.Settings(trees=25))
    assert ((trees.probability(rows) >= 0.5) == (labels > 0.5)).mean() > 0.85
    for f, way in enumerate(quality_rules.STATISTICS.values()):
        if way:
            moved = np.repeat(rng.random((1, rows.shape[1])), 200, 0)
            moved[:, f] = np.linspace(0, 1, 200)
            assert (way * np.diff(trees.margin(moved)) >= -1e-12).all()

    def walk(node, row):
        while trees.left[node] != node:
            node = trees.left[node] if row[trees.feature[node]] <= trees.cut[node] else trees.right[node]
        return trees.value[node]

    plain = [trees.bias + sum(walk(r, row) for r in trees.roots) for row in rows[:50]]
    assert np.allclose(plain, trees.margin(rows[:50]))


def test_kept_documents_are_the_good_ones(spark):
    right = dict(small("SELECT doc_id, quality FROM 'SF/labels.parquet'", MEDIUM))
    rows = [r for r in QUERIES["op2_quality_rules"](spark, MEDIUM).collect() if r["doc_id"] in right and not r["base_failed"]]
    assert np.mean([r["kept"] == (right[r["doc_id"]] == 1) for r in rows]) >= 0.95


def plain_scores(rows, trained, order, strength):
    """The recursion of the automaton over dictionaries of counts."""
    seqs = [("<s>", *spaced(lowered(t)), "</s>") for _, t in rows]
    counts = collections.Counter()
    for keep, seq in zip(trained, seqs, strict=True):
        if keep:
            for k in range(1, order + 1):
                counts.update((seq[max(0, i - k + 1) : i + 1] for i in range(k - 1 if k > 1 else 1, len(seq))))
    single = {g: c for g, c in counts.items() if len(g) == 1}
    n, v = sum(single.values()), len(single)
    once, twice = sum(c == 1 for c in single.values()), sum(c == 2 for c in single.values())
    discount = once / (once + 2 * twice) if once else 0.5
    out = []
    for seq in seqs:
        base = total = 0.0
        for i in range(1, len(seq)):
            c = counts[(seq[i],)]
            base += math.log10((c + 0.1) / (n + 0.1 * (v + 1)))
            p = (c - discount) / n if c else discount * v / n
            for k in range(2, order + 1):
                if i >= k - 1:
                    history = seq[i - k + 1 : i]
                    h = counts[("</s>",)] if history == ("<s>",) else counts[history]
                    p = (counts[(*history, seq[i])] + strength * p) / (h + strength) if h else p
            total += math.log10(p)
        out.append((len(seq) - 1, sum(counts[(w,)] > 0 for w in seq[1:]), n, base, total))
    return out


def test_automaton_is_the_plain_recursion(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choices(["a", "b", "c", "dd", "E", "é"], k=rng.randint(0, 30)))) for i in range(80)]
    rows += [(r[0] + 1000 if r[0] is not None else 5000 + i, r[1]) for i, r in enumerate(odd_rows())]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3, "doc_id").withColumn("score", F.lit("old"))
    # the third run has many blocks, and batches that other columns cut differently in the two passes
    monkeypatch.setattr(arrays, "_BATCH_BYTES", "spark.test.unused")
    for order, block_bytes, batch_bytes in ((1, 4_000_000, None), (3, 4_000_000, None), (2, 150, "700")):
        settings = ngram_automaton.Settings(order=order, block_bytes=block_bytes)
        if batch_bytes:
            spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", batch_bytes)
        scored = ngram_automaton.score(frame, learning.remainder(F.col("doc_id"), 10) != 0, settings).collect()
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
        expected = plain_scores(rows, [remainder(i, 10) != 0 for i, _ in rows], order, settings.strength)
        by_id = collections.defaultdict(list)
        for (i, _), e in zip(rows, expected, strict=True):
            by_id[i].append(e)
        assert len(scored) == len(rows)
        for r in scored:
            e = by_id[r["doc_id"]][0]
            assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == e[:3]
            assert math.isclose(r["base_score"], e[3], rel_tol=1e-9, abs_tol=1e-9)
            assert math.isclose(r["score"], e[4], rel_tol=1e-9, abs_tol=1e-9)


def test_automaton_beats_the_base_on_held_out_texts(spark):
    rows = [r for r in QUERIES["op6_ngram_automaton"](spark, SMALL).collect() if r["held_out"]]
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_automaton_without_documents(spark):
    assert ngram_automaton.score(empty_frame(spark), F.lit(True)).isEmpty()
    untaught = ngram_automaton.score(odd_frame(spark), F.lit(False)).collect()
    assert len(untaught) == len(odd_rows()) and all(r["n_known"] == 0 and math.isfinite(r["score"]) for r in untaught)


def test_blocks_do_not_depend_on_batches():
    rng = random.Random(2)
    texts = ["x" * rng.choice([0, 0, 1, 5, 30, 200]) for _ in range(300)] + [None, "y" * 500, ""]
    bounds = set()
    for cut in (1, 7, 50, 1000):
        batches = [pa.record_batch([pa.array(texts[i : i + cut], pa.string())], ["text"]) for i in range(0, len(texts), cut)]
        pieces = list(arrays.regular_slices(iter(batches), 0, 100))
        assert [v for p in pieces for v in p.column(0).to_pylist()] == texts
        bounds.add(tuple(p.num_rows for p in pieces))
    assert len(bounds) == 1
