"""Folds and bounded samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows whose remainder is 0 are held out: nothing is learnt from their labels.
FOLDS = 5


def remainder(key: Column, folds: int = FOLDS) -> Column:
    """crc32 of the key written as text, modulo ``folds``; a null key counts as an empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds


def training_labels(labels: DataFrame, target: str) -> DataFrame:
    """One row ``(doc_id, label)`` per document that may be learnt from; of repeated labels the largest counts."""
    return (
        labels.filter(F.col("doc_id").isNotNull() & F.col(target).isin(0, 1) & (remainder(F.col("doc_id")) != 0))
        .groupBy("doc_id")
        .agg(F.max(target).cast("int").alias("label"))
    )


def sample_texts(documents: DataFrame, labels: DataFrame, target: str, rows: int, most_bytes: int, by_label: bool = False) -> tuple[list[bytes], list[int]]:
    """Texts and labels of at most ``rows`` labelled training documents, chosen by a hash of their id.

    ``by_label`` takes at most half of them from either label. The sample is bounded in rows
    and in bytes: texts above ``most_bytes`` are not learnt from (they are still scored).
    The ids are broadcast, their number being bounded by ``rows``.
    """
    known, order = training_labels(labels, target), (F.xxhash64("doc_id"), F.col("doc_id"))
    if by_label:
        halves = [known.filter(F.col("label") == k).orderBy(*order).limit(rows // 2) for k in (0, 1)]
        chosen = halves[0].unionByName(halves[1])
    else:
        chosen = known.orderBy(*order).limit(rows)
    picked = (
        documents.select("doc_id", "text")
        .filter(F.col("text").isNotNull() & (F.octet_length("text") <= most_bytes))
        .join(F.broadcast(chosen), "doc_id")
        .orderBy(*order, "text")
        .limit(rows)
    )
    table = picked.select(F.col("text").cast("binary").alias("text"), "label").toArrow()
    return table.column("text").to_pylist(), table.column("label").to_pylist()
