"""From raw documents to token ids: five filtering and encoding stages over the documents table.

Every stage is a function of ``(spark, docs, sf_dir)``. ``run`` writes what a stage returns in the
shared folder and reads it again as the next stage's documents, so that a lost executor costs its
own tasks only. Every stage works on all that its predecessor has kept; all but the last return
the columns of the documents.

SQL can express neither the trained stages nor the encoding, so ``ORACLE_SQL`` is None and the
stages are tested against brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.llm import arrays, decontaminate, near_dedup, piece_codec, quality_classifier, quality_rules
from rosterflow.llm.queries import QUERIES, SQL, piece_digests, piece_model, table
from rosterflow.session import materialise

#: Words of a shingle of the near-duplicate stage, as in the contract of its operator.
SHINGLE_WORDS = 2
LEAST_QUALITY = 0.3

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier gives at least ``LEAST_QUALITY``."""
    model = quality_classifier.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return arrays.where(docs, lambda frame: quality_classifier.score(frame, model), F.col("score") >= LEAST_QUALITY)


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the boosted trees.

    The trees are grown on the whole documents table, since the stage before has removed most of
    what they must tell apart.
    """
    trees = quality_rules.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return arrays.where(docs, lambda frame: quality_rules.judge(frame, trees), F.col("kept"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates."""
    return near_dedup.representatives(docs, SHINGLE_WORDS)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, their number and digest, and the digest of the decoded text."""
    encoded = piece_codec.encode(docs.select("doc_id", "text"), piece_model(), keep=("doc_id",))
    return encoded.select("doc_id", *piece_digests(), "ids")


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", classify),
    ("quality rules", rules),
    ("near-dedup", deduplicate),
    ("benchmark decontamination", without_benchmark),
    ("SentencePiece encoding", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {**QUERIES, "pipeline": run}
SQL = dict(SQL)
