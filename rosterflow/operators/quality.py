"""Declared keys, not-null columns and value domains, as reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow import schemas as S


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls per column, long form, in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "null_count")


def outside_domain(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Rows whose value is not one of the allowed ones; null passes."""
    return df.filter(~F.col(column).isin(list(allowed)))


def declared_checks(df: DataFrame, table: str) -> DataFrame:
    """Violations of what is declared for a table: ``rule, subject, violations``. Null
    counts and domains are one pass; keys are one aggregation."""
    rules = {
        ("not null", c): F.count_if(F.col(c).isNull()) for c in S.DECLARED_NOT_NULL.get(table, []) if c in df.columns
    }
    rules |= {
        ("domain", c): F.count_if(~F.col(c).isin(allowed)) for c, allowed in S.DECLARED_DOMAINS.get(table, {}).items()
    }
    counts = df.agg(
        F.array(
            *[
                F.struct(F.lit(rule).alias("rule"), F.lit(c).alias("subject"), n.alias("violations"))
                for (rule, c), n in rules.items()
            ]
        ).alias("r")
    ).select(F.inline("r"))
    keys = S.DECLARED_KEYS.get(table)
    if keys is None:
        return counts
    repeated = repeated_keys(df, keys).agg(F.count(F.lit(1)).alias("violations"))
    return counts.unionByName(repeated.withColumns({"rule": F.lit("key"), "subject": F.lit(", ".join(keys))}))
