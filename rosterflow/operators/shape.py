"""Projection, renaming and schema conformance."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterflow.functions import text


def rename_by_position(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Give the first columns the names in order; further columns are dropped."""
    return df.select([F.col(f"`{old}`").alias(new) for old, new in zip(df.columns, names)])


def normalised_headers(columns: Sequence[str]) -> list[str]:
    """Header texts stripped, lower-case, whitespace runs as one underscore."""
    return [re.sub(r"\s+", "_", c.strip().lower()) for c in columns]


def normalise_header_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*normalised_headers(df.columns))


def select_known(df: DataFrame, column_map: Iterable[tuple[str, str]]) -> DataFrame:
    """Known columns under their canonical names in map order; missing ones are skipped."""
    have = set(df.columns)
    return df.select([F.col(f"`{old}`").alias(new) for old, new in column_map if old in have])


def with_literals(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({name: v if isinstance(v, Column) else F.lit(v) for name, v in values.items()})


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Target columns in target order and type; absent ones become typed nulls."""
    have = set(df.columns)
    return df.select(
        [
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def empty_table(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.sparkSession.createDataFrame([], schema)


def strip_strings(df: DataFrame, skip: Iterable[str] = ()) -> DataFrame:
    """Strip every string column but the skipped ones, in one projection."""
    kept = set(skip)
    return df.select(
        [
            text.strip(F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType) and f.name not in kept
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def resolve_column(columns: Sequence[str], name: str) -> str | None:
    """The column of that name in any case."""
    return next((c for c in columns if c.upper() == name.upper()), None)


def random_id() -> Column:
    """Random surrogate key."""
    return F.expr("uuid()")


def stable_id(*parts: Column) -> Column:
    """Surrogate key that a retried task computes again: same parts, same id."""
    return F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts]), 256)


def drop_blank(df: DataFrame, column: str) -> DataFrame:
    """Keep rows whose text has something in it."""
    return df.filter(F.length(text.strip(F.col(column))) > 0)
