"""Places and running digests inside ordered groups of any size.

Rows are dealt out by ranges of their group and order, so that a group which holds a third of
all rows is spread over many tasks. Each task numbers the part of a group that it holds; what
the parts before it hold is added from a table with one row a task at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from rosterflow.llm import arrays
from rosterflow.session import materialise


def _numbered(at: int, xors: list[int]):
    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId()
        last, held, totals = None, 0, [np.int64(0) for _ in xors]
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(at).to_numpy(zero_copy_only=False)
            new = np.concatenate([[last is None or keys[0] != last], keys[1:] != keys[:-1]])
            heads = np.flatnonzero(new)
            run = np.cumsum(new)  # 0 for the run that goes on from the batch before
            starts = np.concatenate([[-held], heads])
            place = np.arange(len(keys)) - starts[run] + 1
            running = []
            for k, column in enumerate(xors):
                total = np.bitwise_xor.accumulate(batch.column(column).to_numpy(zero_copy_only=False))
                before = np.concatenate([[totals[k]], np.where(heads > 0, total[heads - 1], 0)])
                running.append(total ^ before[run])
                totals[k] = running[-1][-1]
            last, held = keys[-1], int(place[-1])
            added = [pa.array(np.full(len(keys), block, np.int64)), pa.array(place), *(pa.array(v) for v in running)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, "run_block", "place", *(f"running_{k}" for k in range(len(xors)))])

    return part


def ordered_runs(frame: DataFrame, key: str, order: list[Column], label: str, xors: tuple[str, ...] = ()) -> DataFrame:
    """``frame``, staged, with ``place`` (from 1) of each row among those of its ``key``, and running xors.

    ``running_0`` and so on hold the xor of the columns ``xors`` over the rows of the key up
    to and with this one. Key and xors are longs without nulls.
    """
    arrays.prepare(frame.sparkSession)
    added = ["run_block", "place", *(f"running_{k}" for k in range(len(xors)))]
    schema = StructType([*frame.schema, *(StructField(name, LongType()) for name in added)])
    dealt = frame.repartitionByRange(F.col(key), *order).sortWithinPartitions(F.col(key), *order)
    names = frame.columns
    staged = materialise(dealt.mapInArrow(_numbered(names.index(key), [names.index(x) for x in xors]), schema), label)
    last = [F.max_by(name, "place").alias(name) for name in added[2:]]
    parts = staged.groupBy(key, "run_block").agg(F.max("place").alias("held"), *last)
    before = Window.partitionBy(key).orderBy("run_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = [F.coalesce(F.sum("held").over(before), F.lit(0)).alias("held_before"), *(F.coalesce(F.bit_xor(name).over(before), F.lit(0)).alias(f"{name}_before") for name in added[2:])]
    # only the first group of a block can have begun in an earlier one: a row a block at most
    offsets = parts.select(key, "run_block", *carried).filter("held_before > 0")
    joined = staged.join(F.broadcast(offsets), [key, "run_block"], "left")
    place = (F.col("place") + F.coalesce("held_before", F.lit(0))).alias("place")
    running = [F.col(name).bitwiseXOR(F.coalesce(f"{name}_before", F.lit(0))).alias(name) for name in added[2:]]
    return joined.select(*names, place, *running)
