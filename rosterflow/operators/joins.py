"""Joins that hold when one key carries a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterflow.session import materialise

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024
HOT_KEY_ROWS = 1_000_000


def _planned_bytes(df: DataFrame) -> int | None:
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # a session without the classic plan handle
        return None


def _auto_broadcast_bytes(df: DataFrame) -> int:
    limit = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    units = {"k": 10, "m": 20, "g": 30}
    digits = limit.lower().rstrip("b")
    if digits and digits[-1] in units:
        return int(digits[:-1]) << units[digits[-1]]
    return int(digits)


def _row_bytes(df: DataFrame) -> Column:
    """Bytes of a row: text and binary by length, numbers flat, nested values as JSON."""

    def size(field: T.StructField) -> Column:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(field.name), F.lit(0))
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return F.octet_length(F.to_json(F.struct(field.name)))
        return F.lit(8)

    return reduce(lambda a, b: a + b, [size(f) for f in df.schema.fields])


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast once its size is known to be bounded.

    A side the planner already sees as small needs no mark. Otherwise rows and
    bytes are counted in a distributed aggregate; above the bound the frame comes
    back unmarked and the join shuffles, with adaptive skew splitting.
    """
    planned = _planned_bytes(df)
    if planned is not None and planned <= _auto_broadcast_bytes(df):
        return df
    size = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(_row_bytes(df)), F.lit(0)).alias("b"),
    ).first()
    return F.broadcast(df) if size.n <= max_rows and size.b <= max_bytes else df


def _same_key(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    return reduce(lambda a, b: a & b, [left[a].eqNullSafe(right[b]) for a, b in pairs])


def mark_members(df: DataFrame, valid: DataFrame, keys: Sequence[str], marker: str) -> DataFrame:
    """Add a boolean: is the row's key in the valid set? Every row is kept."""
    members = valid.select(*keys).distinct().withColumn(marker, F.lit(True))
    return df.join(small_side(members), list(keys), "left").withColumn(marker, F.coalesce(F.col(marker), F.lit(False)))


def non_members(df: DataFrame, valid: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in the valid set."""
    return df.join(small_side(valid.select(*keys).distinct()), list(keys), "left_anti")


def codes_or_fallback(codes: DataFrame, fallback: DataFrame) -> DataFrame:
    """The codes, or the fallback set when there are none; one plan, nothing collected."""
    return codes.unionByName(fallback.where(~codes.exists()))


def left_join_flag(df: DataFrame, lookup: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """Attach the distinct flag of a key; unmatched is null, and a key that holds
    several flags repeats the row."""
    return df.join(small_side(lookup.select(*keys, flag).distinct()), list(keys), "left")


def attach(df: DataFrame, dimension: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attach the context row of a key (one per key) to every row."""
    return df.join(small_side(dimension), list(keys))


def full_join_coalesce(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    hot_key_rows: int = HOT_KEY_ROWS,
) -> DataFrame:
    """Full outer join on ``keys``; each value is the left one, else the right one.

    A full join cannot be split when one key is heavy. Keys above ``hot_key_rows``
    on either side are counted first, with map-side combine, and leave the full
    join: matched ones go through an inner join, which adaptive execution splits on
    both sides, and one-sided ones need no join. Null keys match nothing, so they
    bypass the joins too. Both sides are staged, so each is evaluated once.
    """
    keys, values = list(keys), list(values)
    left, right = (materialise(side.select(*keys, *values), "join-side") for side in (left, right))
    keyed = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])

    tagged = left.filter(keyed).select(*keys, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.filter(keyed).select(*keys, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    hot = materialise(
        tagged.groupBy(*keys)
        .agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
        .filter((F.col("_l") > hot_key_rows) | (F.col("_r") > hot_key_rows)),
        "heavy-keys",
    )

    def merged(joined: DataFrame) -> DataFrame:
        return joined.select(*keys, *[F.coalesce(F.col(f"l.{v}"), F.col(f"r.{v}")).alias(v) for v in values])

    unmatched = left.filter(~keyed).unionByName(right.filter(~keyed))
    if hot.isEmpty():
        return merged(left.filter(keyed).alias("l").join(right.filter(keyed).alias("r"), keys, "full")).unionByName(
            unmatched
        )
    hot = small_side(hot)
    cold_l, cold_r = left.filter(keyed).join(hot, keys, "left_anti"), right.filter(keyed).join(hot, keys, "left_anti")
    both = hot.filter((F.col("_l") > 0) & (F.col("_r") > 0))
    one_sided = hot.filter((F.col("_l") == 0) | (F.col("_r") == 0))
    hot_l, hot_r = left.join(both, keys, "left_semi"), right.join(both, keys, "left_semi")
    return (
        merged(cold_l.alias("l").join(cold_r.alias("r"), keys, "full"))
        .unionByName(merged(hot_l.alias("l").join(hot_r.alias("r"), keys)))
        .unionByName(left.join(one_sided, keys, "left_semi"))
        .unionByName(right.join(one_sided, keys, "left_semi"))
        .unionByName(unmatched)
    )
