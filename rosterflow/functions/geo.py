"""Points and their binary form."""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

WGS84 = 4326
NAD83 = 4269


def point(lon: Column, lat: Column) -> Column:
    """Point as ``struct<lon, lat>``; null unless both are there."""
    return F.when(lon.isNotNull() & lat.isNotNull(), F.struct(lon.alias("lon"), lat.alias("lat")))


@F.pandas_udf(T.BinaryType())
def point_wkb(lon: pd.Series, lat: pd.Series) -> pd.Series:
    """Point as well-known binary, for sinks that take nothing else."""
    return pd.Series(
        [None if pd.isna(x) or pd.isna(y) else struct.pack("<BIdd", 1, 1, x, y) for x, y in zip(lon, lat)],
        dtype=object,
    )


def geography(wkb: Column) -> Column:
    """Built-in GEOGRAPHY value; needs ``spark.sql.geospatial.enabled``."""
    return F.call_function("st_geogfromwkb", wkb)


def known_srid(srid: Column) -> Column:
    """Accept WGS84, and NAD83 as equal to it; any other system is an error."""
    return F.when(srid.isin(WGS84, NAD83), F.lit(WGS84)).otherwise(
        F.raise_error(F.concat(F.lit("unsupported srid: "), F.coalesce(srid.cast("string"), F.lit("none")))).cast("int")
    )
