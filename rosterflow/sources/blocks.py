"""State carried along a file that is read in blocks.

What a block does to a state is one row, and these rows are composed in file order; inside a block
rows are in one task. So no task holds more than a block of a file, and one row for each block.
Rows carry ``source_file``, ``block_start`` and ``line``, which ascends inside a block.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterflow.operators.joins import small_side
from rosterflow.session import materialise

PLACE = ["source_file", "block_start", "line"]
BLOCK = PLACE[:2]


def _ahead():
    return Window.partitionBy("source_file").orderBy("block_start")


def _before():
    return _ahead().rowsBetween(Window.unboundedPreceding, -1)


def _in_block():
    return Window.partitionBy(*BLOCK).orderBy("line")


def running_sums(rows: DataFrame, sums: Mapping[str, Column]) -> DataFrame:
    """Rows with the sums over all rows of their file up to and with them."""
    here = _in_block().rowsBetween(Window.unboundedPreceding, 0)
    totals = rows.groupBy(*BLOCK).agg(*(F.sum(value).alias(f"_{name}") for name, value in sums.items()))
    offsets = totals.select(*BLOCK, *(F.coalesce(F.sum(f"_{name}").over(_before()), F.lit(0)).alias(f"_{name}") for name in sums))
    local = rows.withColumns({name: F.sum(value).over(here) for name, value in sums.items()})
    joined = local.join(small_side(materialise(offsets, "block-offsets")), BLOCK)
    return joined.withColumns({name: F.col(name) + F.col(f"_{name}") for name in sums}).drop(*(f"_{name}" for name in sums))


def next_rows(rows: DataFrame, value: Column) -> DataFrame:
    """Rows with ``next``: the ``value`` of the next row of the file, in its block or a later one."""
    firsts = rows.groupBy(*BLOCK).agg(F.min_by(value, "line").alias("first"))
    firsts = firsts.select(*BLOCK, F.lead("first").over(_ahead()).alias("following"))
    local = rows.withColumn("next", F.lead(value).over(_in_block()))
    joined = local.join(small_side(materialise(firsts, "block-firsts")), BLOCK)
    return joined.withColumn("next", F.coalesce("next", "following")).drop("following")


def toggled(rows: DataFrame, toggles: Column) -> DataFrame:
    """Rows with ``inside``, the state before them, of a machine that is outside at the start of a file: a row that
    ``toggles`` changes the state, any other one ends outside.

    A block maps the state it is entered with to the one it is left with: to a fixed one if
    some row of it resets, else to the same or the other one by its number of rows. So what enters a
    block is what the last resetting block left, changed once for every odd block since.
    """
    rows = rows.withColumn("toggles", F.coalesce(toggles, F.lit(False)))
    resets = F.sum((~F.col("toggles")).cast("int")).over(_in_block().rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("run", F.coalesce(resets, F.lit(0)))
    place = F.row_number().over(Window.partitionBy(*BLOCK, "run").orderBy("line"))
    rows = rows.withColumn("odd", (place - 1) % 2)
    last = rows.groupBy(*BLOCK).agg(F.max_by(F.struct("run", "odd", "toggles"), "line").alias("last"))
    left = F.when(~F.col("last.toggles"), 0).otherwise(1 - F.col("last.odd"))
    fixed = (F.col("last.run") > 0) | ~F.col("last.toggles")
    maps = last.select(*BLOCK, F.when(fixed, left).alias("fixed"), F.when(fixed, 0).otherwise(left).alias("flips"))
    maps = maps.withColumn("flipped", F.sum("flips").over(_ahead().rowsBetween(Window.unboundedPreceding, 0)))
    since = F.struct("fixed", "flipped")
    held = F.last(F.when(F.col("fixed").isNotNull(), since), ignorenulls=True).over(_before())
    maps = maps.withColumns({"held": held, "so_far": F.lag("flipped").over(_ahead())})
    entered = (F.coalesce("held.fixed", F.lit(0)) + F.coalesce("so_far", F.lit(0)) - F.coalesce("held.flipped", F.lit(0))) % 2
    entries = small_side(materialise(maps.select(*BLOCK, entered.alias("entered")), "block-states"))
    state = (F.col("odd") + F.when(F.col("run") == 0, F.col("entered")).otherwise(0)) % 2
    return rows.join(entries, BLOCK).withColumn("inside", state == 1).drop("run", "odd", "toggles", "entered")


def last_before(rows: DataFrame, blocks: DataFrame, value: Column) -> DataFrame:
    """``blocks`` (each once) with ``over``: the ``value`` of the last of the rows in an earlier block of the file."""
    lasts = rows.groupBy(*BLOCK).agg(F.max_by(value, "line").alias("last"))
    return blocks.join(lasts, BLOCK, "left").withColumn("over", F.last("last", ignorenulls=True).over(_before())).drop("last")
