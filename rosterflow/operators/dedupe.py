"""Row order, first rows and repeated rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterflow.operators.joins import small_side
from rosterflow.session import materialise


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key. The planner limits every map task to one row per
    key before the shuffle, so a heavy key costs no more than a light one."""
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(first)).filter("_rn = 1").drop("_rn")


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key."""
    return keep_first(df, keys, [F.col(c).desc() for c in order])


def later_duplicates(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Every row but the first of its key; null keys count as equal. ``order`` must
    not repeat within a key.

    The first position per key is an aggregate with map-side combine, and only keys
    seen more than once are kept, in a staged table. When they are few, as they
    should be, they are broadcast and the rows never shuffle again; otherwise an
    inner join follows, which adaptive execution splits. No task holds one key's rows.
    """
    position = F.struct(*order) if len(order) > 1 else F.col(order[0])
    repeated = (
        df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
        .agg(F.min(position).alias("_first"), F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1")
        .drop("_n")
    )
    firsts = small_side(materialise(repeated, "repeated-keys"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    return df.join(firsts, same).filter(position > F.col("_first")).select(*df.columns)


def number_rows(staged: DataFrame, file: str, block: str, position: str, out: str) -> DataFrame:
    """1-based row number per file over a staged scan.

    ``position`` ascends inside one ``block`` of a file. Each block's row count and
    first position are aggregated, the running totals run over blocks (one row
    each) and are staged, and every row adds its place in the block: no task sees a
    whole file.
    """
    blocks = staged.groupBy(file, block).agg(F.min(position).alias("_start"), F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(file).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    return (
        staged.join(small_side(materialise(offsets, "block-offsets")), [file, block])
        .withColumn(out, F.col("_before") + F.col(position) - F.col("_start") + 1)
        .drop("_start", "_rows", "_before")
    )
