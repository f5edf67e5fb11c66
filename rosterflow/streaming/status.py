"""File status from an append-only log of transitions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from rosterflow import schemas as S
from rosterflow.functions import text
from rosterflow.operators.joins import small_side
from rosterflow.session import materialise

CLAIM_STEP, OUTCOME_STEP = 1, 2

#: Parts that the log and the registry are laid out in, by a hash of the file id.
BUCKETS = 128

TERMINAL = ("COMPLETED", "FAILED")


def latest_status(log: DataFrame) -> DataFrame:
    """State per file; works on a streaming log too (update or complete mode).

    A finished file stays finished whatever is appended later, such as the entry of a
    sweep that ran beside the claim: only a re-submission, a pending entry that names no
    claim (its ``batch_id`` is null), opens it again. Otherwise the newest entry holds.
    """
    order = F.struct("updated_at", "seq")
    entry = F.struct("status", "error_message", "updated_at", "batch_id")
    again = (F.col("status") == "PENDING") & F.col("batch_id").isNull()
    folded = log.groupBy("file_id").agg(
        F.max_by(entry, order).alias("newest"),
        F.max_by(entry, F.when(F.col("status").isin(*TERMINAL), order)).alias("finished"),
        F.max(F.when(F.col("status").isin(*TERMINAL), order)).alias("finished_at"),
        F.max(F.when(again, order)).alias("again_at"),
    )
    finished = F.col("finished_at").isNotNull() & (F.col("again_at").isNull() | (F.col("finished_at") > F.col("again_at")))
    return folded.select("file_id", F.when(finished, F.col("finished")).otherwise(F.col("newest")).alias("s")).select("file_id", "s.*")


def current_files(registry: DataFrame, log: DataFrame) -> DataFrame:
    """Registry rows with the status the log has brought them to."""
    newest = latest_status(log).withColumnsRenamed(
        {"status": "_status", "error_message": "_error", "updated_at": "_updated", "file_id": "id"}
    )
    logged = F.col("_status").isNotNull()
    return (
        registry.join(newest, "id", "left")
        .withColumns(
            {
                "status": F.coalesce("_status", "status"),
                "error_message": F.when(logged, F.col("_error")).otherwise(F.col("error_message")),
                "updated_at": F.coalesce("_updated", "updated_at"),
            }
        )
        .drop("_status", "_error", "_updated")
    )


def claimable(status: Column, claimed_by: Column, batch_id: int) -> Column:
    """Pending, or claimed by this very batch before a crash."""
    return (status == "PENDING") | ((status == "PROCESSING") & (claimed_by == batch_id))


def bucket_of(file_id: Column) -> Column:
    """Part of the log and the registry that a file is in."""
    return F.pmod(F.xxhash64(file_id), F.lit(BUCKETS)).cast("int")


def of_files(table: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Rows of the wanted files (``id``, ``bucket``). Where the table is laid out by bucket, only the parts that they
    are in are read: the join prunes the scan by the wanted buckets when it runs."""
    if "bucket" not in table.columns:
        return table.join(wanted.select(F.col("id").alias(key)), key, "left_semi")
    return table.join(wanted.select(F.col("id").alias(key), "bucket"), ["bucket", key], "left_semi").drop("bucket")


def claim(ids: DataFrame, registry: DataFrame, log: DataFrame, batch_id: int) -> DataFrame:
    """Registry rows of the messages that may be processed now, each once however
    often it was delivered; unknown files and files in another state are left out.

    Both tables are cut down to the batch's files first, so only their rows are
    aggregated and joined, and of tables laid out by bucket only their parts are read.
    """
    # the planner prunes by a side that it takes for selective, such as one with a comparison
    wanted = ids.select(F.col("file_id").alias("id")).distinct().withColumn("bucket", bucket_of(F.col("id")))
    wanted = small_side(wanted.filter(F.length("id") > 0))
    files = of_files(registry, wanted, "id")
    entries = of_files(log, wanted, "file_id")
    return current_files(files, entries).filter(claimable(F.col("status"), F.col("batch_id"), batch_id)).drop("batch_id")


def skipped(ids: DataFrame, claimed: DataFrame) -> DataFrame:
    """Delivered ids that are not claimed."""
    done = small_side(claimed.select(F.col("id").alias("file_id")))
    return ids.select("file_id").distinct().join(done, "file_id", "left_anti")


def log_entries(files: DataFrame, status: Column, error: Column, batch_id: int | Column, step: int) -> DataFrame:
    """Transitions to append; messages are cut to the registry's length and a
    completed file carries none."""
    batch = (batch_id if isinstance(batch_id, Column) else F.lit(batch_id)).cast("bigint")
    message = F.when(status == "FAILED", text.clip_message(error)).cast("string")
    return files.select(
        "file_id",
        status.alias("status"),
        message.alias("error_message"),
        F.current_timestamp().alias("updated_at"),
        batch.alias("batch_id"),
        (F.coalesce(batch, F.lit(0)) * 10 + step).alias("seq"),
    )


def append_log(entries: DataFrame, path: str) -> None:
    """Append to the log's buckets, one file each."""
    placed = entries.withColumn("bucket", bucket_of(F.col("file_id")))
    placed.repartition("bucket").write.mode("append").partitionBy("bucket").parquet(path)


def _laid_out(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    buckets = "bucket" in spark.read.parquet(path).columns
    return spark.read.schema(StructType([*schema, StructField("bucket", IntegerType())]) if buckets else schema).parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The log, with its ``bucket`` column where it is laid out by it."""
    return _laid_out(spark, path, S.STATUS_LOG)


def write_registry(registry: DataFrame, path: str) -> None:
    """Lay a registry out by bucket, so that a claim reads the parts of its files only."""
    placed = registry.withColumn("bucket", bucket_of(F.col("id")))
    placed.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    return _laid_out(spark, path, S.ORG_FILES)


def deciding(log: DataFrame) -> DataFrame:
    """The entries of each file that its state follows from: the newest, the newest that finished it, the last
    submission. :func:`latest_status` of them is that of the whole log."""
    order = F.struct("updated_at", "seq")
    entry = F.struct(*S.STATUS_LOG.fieldNames()[1:])
    again = (F.col("status") == "PENDING") & F.col("batch_id").isNull()
    folded = log.groupBy("file_id").agg(
        F.max_by(entry, order).alias("newest"), F.max_by(entry, F.when(F.col("status").isin(*TERMINAL), order)).alias("finished"), F.max_by(entry, F.when(again, order)).alias("again")
    )
    entries = F.filter(F.array_distinct(F.array("newest", "finished", "again")), lambda e: e.isNotNull())
    return folded.select("file_id", F.explode(entries).alias("e")).select("file_id", "e.*")


def compact_log(spark: SparkSession, path: str) -> None:
    """Keep three entries of each file at most, sorted by file in one file a bucket; run it while nothing is appended.

    What is kept is staged first, and every bucket is replaced as a whole, so that a run that breaks off
    can be repeated.
    """
    kept = materialise(deciding(read_log(spark, path)), "compacted-log").withColumn("bucket", bucket_of(F.col("file_id")))
    dealt = kept.repartition("bucket").sortWithinPartitions("bucket", "file_id")
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)


def stuck_files(
    files: DataFrame, now: datetime | Column | None = None, minutes: int = S.STUCK_AFTER_MINUTES
) -> DataFrame:
    """Files in processing since before the limit."""
    clock = F.current_timestamp() if now is None else F.lit(now)
    limit = clock - F.make_dt_interval(mins=F.lit(minutes))
    return files.filter((F.col("status") == "PROCESSING") & (F.col("updated_at") < limit))


def requeue_stuck(registry: DataFrame, log_path: str, now: datetime | None = None) -> DataFrame:
    """Put stuck files back to pending; returns ``fileId`` messages to send again. An
    entry names the claim that it expires, so it cannot undo an outcome written meanwhile."""
    spark = registry.sparkSession
    stuck = stuck_files(current_files(registry, read_log(spark, log_path)), now)
    entries = log_entries(
        stuck.select(F.col("id").alias("file_id"), "batch_id"), F.lit("PENDING"), F.lit(None).cast("string"), F.coalesce("batch_id", F.lit(-1)), 3
    )
    written = materialise(entries, "requeued")
    append_log(written, log_path)
    return written.select(F.col("file_id").alias("fileId"))
