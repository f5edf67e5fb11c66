"""Uploaded-file intake: messages in, organisation tables and file status out.

One streaming query is the only writer of the status log. Every micro-batch claims
its pending files, loads all files of a kind in one job, and appends the outcomes.
A batch that is run again after a crash finds its own claims and repeats the same
replacements.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from rosterflow import schemas as S
from rosterflow.operators.dedupe import later_duplicates
from rosterflow.plans.jobs import load_uploads
from rosterflow.session import materialise, staged_tables
from rosterflow.sources.paths import file_address, object_uri, plain_address, read_path
from rosterflow.streaming import route
from rosterflow.streaming.state import by_batch
from rosterflow.streaming.status import CLAIM_STEP, OUTCOME_STEP, append_log, claim, log_entries, read_log, read_registry


@dataclass(frozen=True)
class IntakeTables:
    """Where the intake reads and writes. ``objects`` is put before bucket and key."""

    registry: str
    status_log: str
    rejected: str
    org_provider: str
    org_facility: str
    objects: str = "s3a://"


def read_messages(spark: SparkSession, folder: str, files_per_trigger: int = 1000) -> DataFrame:
    """Stream of raw message lines from a landing folder."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(folder)


def message_file_id(line: Column) -> Column:
    """File id of a message line; null if it has none."""
    return F.from_json(line, "fileId string")["fileId"]


def parse_messages(lines: DataFrame, column: str = "value") -> DataFrame:
    """Message lines with their file id; a line without one has null."""
    return lines.select(F.col(column).alias("body"), message_file_id(F.col(column)).alias("file_id"))


def drop_redelivered(messages: DataFrame, within: str, key: str = "file_id") -> DataFrame:
    """Drop messages whose key came within the time span, to spare claims; the state of a restarted stream
    still knows them, and holds the keys of the span only. The status check alone decides: a span longer than
    the stuck-file limit would hide re-sent files of equal bodies."""
    return (
        messages.withColumn("ingest_ts", F.current_timestamp())
        .withWatermark("ingest_ts", within)
        .dropDuplicatesWithinWatermark([key])
    )


#: How Spark names a failure of a file that it reads.
_FILE_FAILURE = re.compile(r"\[(PATH_NOT_FOUND|FAILED_READ_FILE)\b")


def existing(spark: SparkSession, paths: list[str]) -> list[str]:
    """The paths that are there. Spark looks them up together; only groups that lack one are halved."""
    if not paths:
        return []
    try:
        spark.read.format("binaryFile").load([read_path(p) for p in paths])
        return paths
    except AnalysisException as error:
        if not _FILE_FAILURE.search(str(error)):
            raise
    half = len(paths) // 2
    return existing(spark, paths[:half]) + existing(spark, paths[half:]) if half else []


def qualified(spark: SparkSession, uri: str) -> str:
    """Address of an object as the readers report it; nothing is asked of its store."""
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return plain_address(path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toUri().toString())


def stored_objects(spark: SparkSession, addresses: list[str]) -> DataFrame:
    """``source_file`` and ``size`` of the objects that exist, listed by Spark without their content."""
    there = existing(spark, addresses)
    found = spark.createDataFrame([(a,) for a in there], "source_file string")
    if not there:
        return found.withColumn("size", F.lit(0).cast("bigint"))
    files = spark.read.format("binaryFile").load([read_path(a) for a in there])
    sizes = files.select(file_address().alias("source_file"), F.col("length").alias("size"))
    # readers leave files without a byte out
    return found.join(sizes, "source_file", "left").withColumn("size", F.coalesce("size", F.lit(0)))


def _problem(uri: Column, size: Column) -> Column:
    """Why a file cannot be read: null if it can, or if it is not there."""
    name = F.substring_index(uri, "/", -1)
    suffix = F.when(name.contains("."), F.concat(F.lit("."), F.lower(F.substring_index(name, ".", -1)))).otherwise("")
    return (
        F.when(uri.isNull(), S.MSG_UNEXPECTED + "no object address")
        .when(size.isNotNull() & ~suffix.isin(".csv", ".xlsx"), F.concat(F.lit(S.MSG_UNSUPPORTED), suffix))
        .when(size == 0, S.MSG_UNEXPECTED + "empty file")
    )


def _unreadable(error: Exception, addresses: list[str]) -> str | None:
    """The file that a failed read names, if the failure is the file's own."""
    if not _FILE_FAILURE.search(str(error)):
        return None
    said = unquote(re.sub("file:/+", "file:///", str(error)))
    named = [a for a in addresses if unquote(a) in said]
    return max(named, key=len) if named else None


def _load_readable(spark: SparkSession, readable: list[tuple[str, str, str]], kind: str, target: str) -> DataFrame:
    """Load files; one that cannot be read fails alone, and one that has gone meanwhile is left out."""
    failed = []
    while readable:
        manifest = spark.createDataFrame(readable, "source_file_id string, organization_id string, source_file string")
        try:
            loaded = load_uploads(spark, manifest, kind, target, [read_path(a) for _, _, a in readable])
            break
        except (PySparkException, Py4JJavaError) as error:
            culprit = _unreadable(error, [a for _, _, a in readable])
            if culprit is None:
                raise  # not the fault of a file: the batch is run again
            if existing(spark, [culprit]):
                failed += [(i, "unreadable file") for i, _, a in readable if a == culprit]
            readable = [r for r in readable if r[2] != culprit]
    else:
        loaded = spark.createDataFrame([], "source_file_id string, rows bigint, error string")
    failures = spark.createDataFrame(failed, "file_id string, error string")
    outcomes = loaded.select(F.col("source_file_id").alias("file_id"), "error").unionByName(failures)
    return outcomes.select("file_id", route.unexpected(F.col("error")).alias("error"))


def _load_kind(spark: SparkSession, claimed: DataFrame, kind: str, tables: IntakeTables) -> DataFrame:
    """Load the claimed files of one kind; returns ``file_id, error``. Files that are
    missing stay in processing, so the sweep sends them again.

    Readers take the addresses of a batch's files from the driver; these are all that it is given.
    """
    uri = object_uri(F.col("s3_bucket"), F.col("s3_key"), tables.objects)
    files = claimed.filter(route.handler(F.col("file_type")) == kind).select("id", "organization_id", uri.alias("uri"))
    address = {r.uri: qualified(spark, r.uri) for r in files.filter("uri IS NOT NULL").select("uri").distinct().collect()}
    named = spark.createDataFrame(list(address.items()), "uri string, source_file string")
    listed = files.join(named, "uri", "left").join(stored_objects(spark, list(dict.fromkeys(address.values()))), "source_file", "left")
    listed = materialise(listed.withColumn("error", _problem(F.col("uri"), F.col("size"))), "listed-files")
    refused = listed.filter(F.col("error").isNotNull()).select(F.col("id").alias("file_id"), "error")
    readable = listed.filter(F.col("error").isNull() & F.col("size").isNotNull()).select("id", "organization_id", "source_file").collect()
    return refused.unionByName(_load_readable(spark, [tuple(r) for r in readable], kind, getattr(tables, kind)))


def process_batch(lines: DataFrame, batch_id: int, tables: IntakeTables) -> None:
    """One micro-batch: reject, claim, load, record. What it stages is deleted when it ends."""
    with staged_tables(lines.sparkSession):
        _process(lines, batch_id, tables)


def _process(lines: DataFrame, batch_id: int, tables: IntakeTables) -> None:
    spark = lines.sparkSession
    messages = materialise(parse_messages(lines), "messages")
    rejected = messages.filter(F.col("file_id").isNull()).select("body", F.lit(batch_id).cast("bigint").alias("batch_id"))
    rejected.write.mode("overwrite").parquet(f"{tables.rejected}/batch={batch_id}")

    ids = messages.filter(F.col("file_id").isNotNull()).select("file_id")
    registry = read_registry(spark, tables.registry)
    claimed = materialise(claim(ids, registry, read_log(spark, tables.status_log), batch_id), "claimed")
    if claimed.isEmpty():
        return
    files = claimed.select(F.col("id").alias("file_id"))
    append_log(log_entries(files, F.lit("PROCESSING"), F.lit(None), batch_id, CLAIM_STEP), tables.status_log)

    refused = claimed.select(F.col("id").alias("file_id"), route.refusal(F.col("file_type")).alias("error"))
    outcomes = refused.filter(F.col("error").isNotNull())
    for kind in route.HANDLERS.values():
        outcomes = outcomes.unionByName(_load_kind(spark, claimed, kind, tables))
    error = F.col("error")
    append_log(log_entries(outcomes, route.outcome_status(error), error, batch_id, OUTCOME_STEP), tables.status_log)


def intake_writer(lines: DataFrame, tables: IntakeTables, checkpoint: str, redelivered_within: str | None = None) -> DataStreamWriter:
    """The streaming query, ready to start with a trigger. Equal messages that a queue delivers again
    ``redelivered_within`` a time span are dropped before any table is read; a sweep's messages differ from those before."""
    if redelivered_within:
        lines = drop_redelivered(lines, redelivered_within, "value").select("value")
    return lines.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, batch_id: process_batch(batch, batch_id, tables)
    )


def stream_rows(spark: SparkSession, folder: str, kind: str, shape: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """New submission CSVs of a folder as typed streaming rows, without a queue. The
    row builders keep no state, so they run on a stream as they are."""
    names = S.SUBMISSION_COLUMNS[kind]
    schema = ", ".join(f"{n} string" for n in names)
    lines = spark.readStream.schema(schema).option("header", True).csv(folder)
    return shape(lines.select(*names, file_address().alias("source_file")))


def folder_writer(rows: DataFrame, path: str, checkpoint: str, keys: Sequence[str], order: Sequence[str]) -> DataStreamWriter:
    """Rows of a folder as they arrive, and the later ones of equal keys in a batch, in tables by batch: one that
    runs again after a crash replaces what it has written."""

    def write(batch: DataFrame, batch_id: int) -> None:
        with staged_tables(batch.sparkSession):
            held = materialise(batch, "folder-rows")
            by_batch(f"{path}/rows")(held, batch_id)
            by_batch(f"{path}/duplicates", lambda df: later_duplicates(df, keys, order))(held, batch_id)

    return rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
