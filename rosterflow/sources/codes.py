"""Valid code sets from the reference tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.functions import text


def ssa_codes(county: DataFrame, years: Iterable[int] | None = None) -> DataFrame:
    """Distinct padded county codes per contract year. Pass the contract years wanted
    to push the filter into the scan."""
    rows = county if years is None else county.filter(F.col("contract_year").isin(list(years)))
    return (
        rows.filter(F.col("ssa_county_code").isNotNull())
        .select("contract_year", text.zero_fill(text.strip(F.col("ssa_county_code")), 5).alias("code"))
        .distinct()
    )


def specialty_codes(specialty_type: DataFrame, category: str, years: Iterable[int] | None = None) -> DataFrame:
    """Distinct specialty codes of a category per contract year."""
    rows = specialty_type.filter(F.col("category") == category)
    if years is not None:
        rows = rows.filter(F.col("contract_year").isin(list(years)))
    return (
        rows.filter(F.col("specialty_code").isNotNull())
        .select("contract_year", text.strip(F.col("specialty_code")).alias("code"))
        .distinct()
    )


def given_codes(spark: SparkSession, codes: Iterable[str], width: int) -> DataFrame:
    """A caller's own code set, digits padded."""
    return spark.createDataFrame([(c,) for c in sorted(codes)], "code string").select(
        F.when(F.col("code").rlike(f"^[0-9]{{1,{width}}}$"), F.lpad("code", width, "0"))
        .otherwise(F.col("code"))
        .alias("code")
    )


def constant_codes(spark: SparkSession, codes: Iterable[str]) -> DataFrame:
    return spark.createDataFrame([(c,) for c in codes], "code string")
