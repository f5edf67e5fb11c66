"""Status of every file as state of a stream over the log, with a timer for files that get stuck.

The state of a file is three entries at most: the newest one, the newest that finished it, and when
it was last submitted again. So a batch costs its own entries, however long the history is, and
a file that is finished stays finished whatever comes later. A file in processing has a time to end;
when it runs out before another entry comes, the file is stuck.

Every call of the store goes from Python to the JVM and back, which takes longer than anything else here.
Files are therefore dealt to :data:`GROUPS` by a hash of their id, and those of a group share one value and one
timer: the calls of a batch are bounded by the groups, however many files it has.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from rosterflow import schemas as S
from rosterflow.session import materialise
from rosterflow.streaming import processor
from rosterflow.streaming.processor import NEVER, FileStatus
from rosterflow.streaming.status import TERMINAL, append_log, log_entries

# the workers that set state up are not given the files of the session, so the processor goes with its code
cloudpickle.register_pickle_by_value(processor)

#: Groups of files in the state. A checkpoint holds by it: with another number a stream must begin with a new one.
GROUPS = 1 << 16

STATES = "file_id string, status string, error_message string, updated_at timestamp, batch_id long, stuck boolean"
_STATES = STATES.replace("updated_at timestamp", "micros long")
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def file_states(log: DataFrame, stuck_after_minutes: int = S.STUCK_AFTER_MINUTES) -> DataFrame:
    """A stream of states from a stream of log entries: a row for every file of a batch, and one with ``stuck`` for a
    file whose time ran out."""
    micros = F.coalesce(F.unix_micros("updated_at"), F.lit(NEVER)).alias("micros")
    seq = F.coalesce("seq", F.lit(NEVER)).alias("seq")
    group = F.pmod(F.xxhash64("file_id"), F.lit(GROUPS)).alias("files")
    # the processor takes the columns in this order
    entries = log.filter(F.col("file_id").isNotNull()).select(group, "file_id", micros, seq, "status", "error_message", "batch_id")
    states = entries.groupBy("files").transformWithState(FileStatus(stuck_after_minutes, TERMINAL), _STATES, "update", "processingTime")
    at = F.when(F.col("micros") > NEVER, F.timestamp_micros("micros"))
    return states.select("file_id", "status", "error_message", at.alias("updated_at"), "batch_id", "stuck")


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """Streams started inside the block keep their state in the store that timers need."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


def run_through(writer: DataStreamWriter, poll_seconds: float = 0.2) -> None:
    """Run a stream of states until it has taken all its input and looked at its timers after that.

    Timers keep such a stream going, so that it would not end by itself even if started with
    ``availableNow``. A batch without input rows comes only when no input is left, but for the first batch of a
    run: that may be one without input which the run before was ended in, done again before anything new is read.
    """
    running, begun = writer.start(), None
    try:
        while True:
            if progress := running.lastProgress:
                begun = progress["batchId"] if begun is None else begun
                if progress["numInputRows"] == 0 and progress["batchId"] > begun:
                    return
            if running.awaitTermination(poll_seconds):
                return
    finally:
        running.stop()


def by_batch(path: str, change: Callable[[DataFrame], DataFrame] = lambda df: df) -> Callable[[DataFrame, int], None]:
    """Sink that writes every batch to a folder of its own, so that a batch that runs again replaces what it wrote."""

    def write(batch: DataFrame, batch_id: int) -> None:
        change(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def state_writer(log: DataFrame, path: str, checkpoint: str, stuck_after_minutes: int = S.STUCK_AFTER_MINUTES) -> DataStreamWriter:
    """The stream that keeps ``path`` as a table of states by batch; start it inside :func:`state_store`."""
    states = file_states(log, stuck_after_minutes)
    return states.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(by_batch(path))


def sweep_writer(log: DataFrame, status_log: str, resend: str, checkpoint: str, stuck_after_minutes: int = S.STUCK_AFTER_MINUTES) -> DataStreamWriter:
    """The stream that puts stuck files back to pending and sends them again, as messages below ``resend``.

    The timer of a file decides, so no sweep reads the history. An entry names the claim that it
    expires, and cannot undo an outcome written meanwhile. Start it inside :func:`state_store`.
    """

    def sweep(batch: DataFrame, batch_id: int) -> None:
        stuck = materialise(batch.filter("stuck").select("file_id", "batch_id"), "stuck-files")
        if stuck.isEmpty():
            return
        claim = F.coalesce("batch_id", F.lit(-1))
        append_log(log_entries(stuck, F.lit("PENDING"), F.lit(None).cast("string"), claim, 3), status_log)
        message = F.to_json(F.struct(F.col("file_id").alias("fileId"), claim.alias("expired")))
        stuck.select(message.alias("value")).write.mode("overwrite").text(f"{resend}/sweep-{batch_id}")

    states = file_states(log, stuck_after_minutes)
    return states.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(sweep)


def read_states(spark: SparkSession, path: str) -> DataFrame:
    """The last state of every file."""
    held = spark.read.schema(f"{STATES}, batch long").parquet(path)
    last = F.struct("batch", "stuck")
    state = F.struct("status", "error_message", "updated_at", "batch_id", "stuck")
    return held.groupBy("file_id").agg(F.max_by(state, last).alias("s")).select("file_id", "s.*")
