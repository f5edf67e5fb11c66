"""ZIP gazetteer and county boundary tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterflow import schemas as S
from rosterflow.functions import numbers
from rosterflow.functions.geo import known_srid
from rosterflow.operators.shape import drop_blank, normalise_header_columns, resolve_column, select_known

_DOUBLES = ["intptlat", "intptlong", "aland_sqmi", "awater_sqmi"]
_LONGS = ["aland_sqmeters", "awater_sqmeters"]


def gazetteer_table(df: DataFrame, year: int | Column) -> DataFrame:
    """Typed gazetteer rows; rows without an id or a readable coordinate are dropped."""
    known = select_known(
        normalise_header_columns(df).withColumn("source_year", year if isinstance(year, Column) else F.lit(year)),
        [*S.GAZETTEER_COLUMN_MAP, ("source_year", "source_year")],
    )
    typed = {c: numbers.to_double(F.col(c)) for c in _DOUBLES if c in known.columns}
    typed |= {c: numbers.to_long(F.col(c)) for c in _LONGS if c in known.columns}
    out = known.withColumns(typed)
    if "geoid" in out.columns:
        out = drop_blank(out, "geoid")
    return out.dropna(subset=[c for c in ("intptlat", "intptlong") if c in out.columns])


def boundary_table(features: DataFrame, year: int | Column) -> DataFrame:
    """County boundaries from features with a property map; names match in any case."""

    def prop(name: str) -> Column:
        matching = F.map_filter("properties", lambda k, _: F.upper(k) == name)
        return F.get(F.map_values(matching), F.lit(0))

    has_geoid = F.exists(F.map_keys("properties"), lambda k: F.upper(k) == "GEOID")
    checked = F.when(has_geoid, prop("GEOID")).otherwise(F.raise_error(F.lit(S.MSG_NO_GEOID)))
    return (
        features.select(
            checked.alias("geoid"),
            prop("NAME").alias("name"),
            (year if isinstance(year, Column) else F.lit(year)).cast("int").alias("source_year"),
            F.when(known_srid(F.col("srid")).isNotNull(), F.col("geom")).alias("geom"),
        )
    )


def boundary_columns(columns: list[str]) -> tuple[str, str | None]:
    """The id and name columns of a flat feature table; the id is required."""
    geoid = resolve_column(columns, "GEOID")
    if geoid is None:
        raise ValueError(S.MSG_NO_GEOID)
    return geoid, resolve_column(columns, "NAME")


def boundaries_with_county(boundaries: DataFrame, county: DataFrame) -> DataFrame:
    """Boundaries joined to counties of the same year by code."""
    return boundaries.join(
        county,
        (boundaries["geoid"] == county["ssa_county_code"]) & (boundaries["source_year"] == county["contract_year"]),
    )
