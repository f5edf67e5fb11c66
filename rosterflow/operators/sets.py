"""Unions and source priority."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterflow.operators.joins import small_side
from rosterflow.operators.shape import conform
from rosterflow.session import materialise


def union_all_as(schema: T.StructType, parts: Sequence[DataFrame]) -> DataFrame:
    """All rows of all parts, each widened to the common schema first."""
    return reduce(DataFrame.unionByName, [conform(p, schema) for p in parts])


def union_distinct(parts: Sequence[DataFrame]) -> DataFrame:
    """Distinct rows of all parts; one shuffle, rows combined before it."""
    return reduce(DataFrame.unionByName, parts).distinct()


def labelled_distinct(df: DataFrame, columns: Sequence[str], label: str, value: str) -> DataFrame:
    return df.select(*columns, F.lit(value).alias(label)).distinct()


def prefer_source(primary: DataFrame, secondary: DataFrame, group: Sequence[str]) -> DataFrame:
    """Per group all primary rows, or all secondary rows where the primary has none. The
    primary side is staged, so it is evaluated once."""
    primary = materialise(primary, "primary-rows")
    covered = small_side(primary.select(*group).distinct())
    return primary.unionByName(secondary.join(covered, list(group), "left_anti"))


def missing_columns(have: Sequence[str], required: Sequence[str]) -> list[str]:
    return [c for c in required if c not in set(have)]
