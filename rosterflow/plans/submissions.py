"""Typed submission tables and organisation upload rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterflow import schemas as S
from rosterflow.functions import numbers, text
from rosterflow.operators.shape import conform, random_id

_SSA, _SPECIALTY, _BEDS = "ssa_state_county_code", "specialty_code", "number_of_beds"


def _typed(df: DataFrame, schema: T.StructType, codes: dict[str, int]) -> DataFrame:
    """One projection: padded codes, Y/N booleans, bed numbers, stripped text."""

    def value(field: T.StructField) -> Column:
        c = F.col(field.name)
        if field.name in codes:
            return text.pad_code(c, codes[field.name])
        if isinstance(field.dataType, T.BooleanType):
            return text.yes_no(c)
        if field.name == _BEDS:
            return numbers.to_long(c.cast("string"))
        return text.strip(c)

    have = {f.name for f in schema.fields} & set(df.columns)
    parsed = {f.name: value(f) for f in schema.fields if f.name in have and f.name not in _CONTEXT}
    return conform(df.withColumns(parsed), schema)


_CONTEXT = {"id", "organization_id", "source_file_id", "latitude", "longitude", "source_year"}


def provider_rows(df: DataFrame) -> DataFrame:
    """Validated provider rows, typed; input carries ``source_year``."""
    return _typed(df, S.PROVIDER_HSD, {_SSA: 5, _SPECIALTY: 3})


def facility_rows(df: DataFrame) -> DataFrame:
    return _typed(df, S.FACILITY_HSD, {_SSA: 5, _SPECIALTY: 3})


def org_provider_rows(df: DataFrame, row_id: Column | None = None) -> DataFrame:
    """Provider upload rows; input carries ``organization_id`` and ``source_file_id``.

    The id is random unless an expression is given; coordinates stay null."""
    return _typed(df.withColumn("id", random_id() if row_id is None else row_id), S.ORG_PROVIDERS, {_SSA: 5})


def org_facility_rows(df: DataFrame, row_id: Column | None = None) -> DataFrame:
    return _typed(df.withColumn("id", random_id() if row_id is None else row_id), S.ORG_FACILITIES, {_SSA: 5})
