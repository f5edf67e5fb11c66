import json
import os
from datetime import datetime, timedelta

import pytest
from conftest import rows_of
from pyspark.sql import functions as F
from test_sources import HEADER, put

from rosterflow import schemas as S
from rosterflow import session
from rosterflow.sinks.tables import stored_files
from rosterflow.operators.shape import conform
from rosterflow.plans.submissions import org_provider_rows
from rosterflow.queries.files import workbook_bytes
from rosterflow.streaming import intake, route, state, status
from rosterflow.streaming.processor import FileStatus

ROW = "1001,Jane,1234567890,PCP,1,D,100 Main St,Boston,MA,02101,Y,Grp,n,Y,high"


@pytest.fixture
def site(spark, folder):
    """Objects of a bucket, a registry, an empty log and a message folder."""
    os.makedirs(f"{folder}/bucket")
    os.makedirs(f"{folder}/messages")
    put(f"{folder}/bucket", "p 1.csv", f"{HEADER}\n{ROW}\n{ROW}\n")
    put(f"{folder}/bucket", "header_only.csv", HEADER + "\n")
    put(f"{folder}/bucket", "zero.csv", "")
    put(f"{folder}/bucket", "x.pdf", "x")
    put(f"{folder}/bucket", "bad.xlsx", "no zip")
    put(f"{folder}/bucket", "f.xlsx", workbook_bytes({"S": [["h"] * 12, ["1001", "Hosp", "1", "x", "40", "s", "c", "MA", "1", 12, "N", "low"]]}))
    files = [
        ("p1", "PROVIDER", "p 1.csv", "PENDING"),
        ("ph", "PROVIDER", "header_only.csv", "PENDING"),
        ("pz", "PROVIDER", "zero.csv", "PENDING"),
        ("pp", "PROVIDER", "x.pdf", "PENDING"),
        ("px", "PROVIDER", "bad.xlsx", "PENDING"),
        ("gone", "PROVIDER", "missing.csv", "PENDING"),
        ("f1", "FACILITY", "f.xlsx", "PENDING"),
        ("b1", "BENEFICIARY", "p 1.csv", "PENDING"),
        ("u1", "OTHER", "p 1.csv", "PENDING"),
        ("done", "PROVIDER", "p 1.csv", "COMPLETED"),
    ]
    registry = spark.createDataFrame([(i, t, "org", "bucket", k, s) for i, t, k, s in files], "id string, file_type string, organization_id string, s3_bucket string, s3_key string, status string")
    conform(registry, S.ORG_FILES).write.parquet(f"{folder}/registry")
    spark.createDataFrame([], S.STATUS_LOG).write.parquet(f"{folder}/log")
    return intake.IntakeTables(f"{folder}/registry", f"{folder}/log", f"{folder}/rejected", f"{folder}/org_providers", f"{folder}/org_facilities", f"{folder}/")


def send(folder, name, *ids, raw=()):
    put(f"{folder}/messages", name, "\n".join([json.dumps({"fileId": i}) for i in ids] + list(raw)) + "\n")


def run(spark, folder, tables):
    lines = intake.read_messages(spark, f"{folder}/messages")
    intake.intake_writer(lines, tables, f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()


def states(spark, tables):
    registry = spark.read.schema(S.ORG_FILES).parquet(tables.registry)
    current = status.current_files(registry, status.read_log(spark, tables.status_log))
    return {r.id: (r.status, r.error_message) for r in current.collect()}


def test_intake_end_to_end(spark, folder, site):
    everything = ["p1", "ph", "pz", "pp", "px", "gone", "f1", "b1", "u1", "done", "unknown", "p1", "f1"]
    send(folder, "m1.json", *everything, raw=["{not json", '{"other": 1}'])
    run(spark, folder, site)
    found = states(spark, site)
    assert found["p1"] == found["ph"] == found["f1"] == ("COMPLETED", None)
    assert found["pz"] == ("FAILED", "Unexpected processing error: empty file")
    assert found["pp"] == ("FAILED", "Unsupported file type: .pdf")
    assert found["px"][0] == "FAILED" and found["px"][1].startswith("Unexpected processing error: unreadable workbook")
    assert found["b1"] == ("FAILED", "BENEFICIARY file processing is not yet implemented")
    assert found["u1"] == ("FAILED", "Unknown file_type: 'OTHER'")
    assert found["gone"] == ("PROCESSING", None) and found["done"] == ("COMPLETED", None)
    assert spark.read.parquet(site.rejected).count() == 2
    providers = stored_files(spark, site.org_provider)
    assert rows_of(providers, "source_file_id", "ssa_state_county_code", "provider_specialty_code", "letter_of_intent") == [("p1", "01001", "1", True)] * 2
    assert rows_of(stored_files(spark, site.org_facility), "source_file_id", "number_of_beds") == [("f1", 12)]

    send(folder, "m2.json", "p1", "gone")  # delivered again: nothing is claimed
    log_size = status.read_log(spark, site.status_log).count()
    run(spark, folder, site)
    assert status.read_log(spark, site.status_log).count() == log_size

    later = datetime.now() + timedelta(hours=1)
    registry = spark.read.schema(S.ORG_FILES).parquet(site.registry)
    again = status.requeue_stuck(registry, site.status_log, later)
    assert rows_of(again) == [("gone",)] and states(spark, site)["gone"][0] == "PENDING"
    put(f"{folder}/bucket", "missing.csv", f"{HEADER}\n{ROW}\n")
    send(folder, "m3.json", "gone")
    run(spark, folder, site)
    assert states(spark, site)["gone"] == ("COMPLETED", None)
    assert stored_files(spark, site.org_provider).count() == 3


def test_batch_runs_again_after_a_crash(spark, folder, site, monkeypatch):
    lines = spark.createDataFrame([('{"fileId": "p1"}',)], "value string")

    def crash(*_):
        raise RuntimeError("executor lost")

    with monkeypatch.context() as m:
        m.setattr(intake, "load_uploads", crash)
        with pytest.raises(RuntimeError):
            intake.process_batch(lines, 7, site)
    assert states(spark, site)["p1"][0] == "PROCESSING"
    intake.process_batch(lines, 8, site)  # another batch may not take it
    assert states(spark, site)["p1"][0] == "PROCESSING"
    intake.process_batch(lines, 7, site)  # the same batch may
    assert states(spark, site)["p1"] == ("COMPLETED", None)
    ids = rows_of(stored_files(spark, site.org_provider), "id")
    intake.process_batch(lines, 7, site)  # and once more does nothing
    assert rows_of(stored_files(spark, site.org_provider), "id") == ids and len(ids) == 2


def log_frame(spark, *rows):
    entries = [(f, s, e, datetime(2025, 1, 1, 0, m), b, q) for f, s, e, m, b, q in rows]
    return spark.createDataFrame(entries, S.STATUS_LOG)


def test_latest_status(spark):
    log = log_frame(spark, ("a", "PROCESSING", None, 1, 1, 11), ("a", "FAILED", "x", 1, 1, 12), ("b", "PROCESSING", None, 5, 2, 21))
    assert rows_of(status.latest_status(log), "file_id", "status", "error_message") == [("a", "FAILED", "x"), ("b", "PROCESSING", None)]


def test_stuck_limit(spark):
    now = datetime(2025, 1, 1, 0, 30)
    files = spark.createDataFrame(
        [("old", "PROCESSING", now - timedelta(minutes=16)), ("young", "PROCESSING", now - timedelta(minutes=14)), ("done", "COMPLETED", now - timedelta(hours=2))],
        "id string, status string, updated_at timestamp",
    )
    assert rows_of(status.stuck_files(files, now), "id") == [("old",)]


def test_messages_are_cut_and_cleared(spark):
    files = spark.createDataFrame([("a", "e" * 600), ("b", None)], "file_id string, error string")
    out = status.log_entries(files, route.outcome_status(F.col("error")), F.col("error"), 3, 2)
    assert [(r.file_id, r.status, len(r.error_message or ""), r.seq) for r in out.orderBy("file_id").collect()] == [("a", "FAILED", 500, 32), ("b", "COMPLETED", 0, 32)]


def test_redelivery_filter_and_status_run_on_a_stream(spark, folder):
    os.makedirs(f"{folder}/messages")
    send(folder, "a.json", "x", "x", "y")
    parsed = intake.parse_messages(intake.read_messages(spark, f"{folder}/messages"))
    kept = intake.drop_redelivered(parsed, "10 minutes")
    seen = []
    kept.writeStream.option("checkpointLocation", f"{folder}/c1").foreachBatch(lambda df, _: seen.extend(r.file_id for r in df.collect())).trigger(availableNow=True).start().awaitTermination()
    assert sorted(seen) == ["x", "y"]
    log_frame(spark, ("a", "PROCESSING", None, 1, 1, 11), ("a", "COMPLETED", None, 2, 1, 12)).write.parquet(f"{folder}/log")
    live = status.latest_status(spark.readStream.schema(S.STATUS_LOG).parquet(f"{folder}/log"))
    live.writeStream.outputMode("complete").format("memory").queryName("live_status").option("checkpointLocation", f"{folder}/c2").trigger(availableNow=True).start().awaitTermination()
    assert rows_of(spark.table("live_status"), "file_id", "status") == [("a", "COMPLETED")]


def test_row_builders_run_on_a_stream(spark, folder):
    os.makedirs(f"{folder}/in")
    put(f"{folder}/in", "a.csv", f"{HEADER}\n{ROW}\n")

    def shape(df):
        return org_provider_rows(df.withColumns({"organization_id": F.lit("o"), "source_file_id": F.col("source_file")}))

    rows = intake.stream_rows(spark, f"{folder}/in", "org_provider", shape)
    rows.writeStream.option("checkpointLocation", f"{folder}/c").trigger(availableNow=True).format("parquet").option("path", f"{folder}/out").start().awaitTermination()
    assert rows_of(spark.read.parquet(f"{folder}/out"), "ssa_state_county_code", "accepts_new_patients") == [("01001", True)]


def test_a_finished_file_stays_finished(spark):
    t = [datetime(2025, 1, 1, h) for h in range(8)]
    log = [
        ("a", "PROCESSING", None, t[0], 1, 11), ("a", "COMPLETED", None, t[1], 1, 12), ("a", "PENDING", None, t[2], 1, 13),
        ("b", "PROCESSING", None, t[0], 1, 11), ("b", "PENDING", None, t[1], 1, 13),
        ("c", "FAILED", "x", t[1], 1, 12), ("c", "PENDING", None, t[2], None, 0), ("c", "PROCESSING", None, t[3], 2, 21),
        ("d", "FAILED", "x", t[1], 1, 12), ("d", "PENDING", None, t[2], None, 0), ("d", "COMPLETED", None, t[4], 2, 22), ("d", "PENDING", None, t[5], 2, 23),
    ]
    frame = spark.createDataFrame(log, S.STATUS_LOG)
    assert rows_of(status.latest_status(frame), "file_id", "status") == [("a", "COMPLETED"), ("b", "PENDING"), ("c", "PROCESSING"), ("d", "COMPLETED")]


def test_a_file_that_cannot_be_read_fails_alone(spark, folder, site, monkeypatch):
    put(f"{folder}/bucket", "torn.csv", f"{HEADER}\n{ROW}\n")
    put(f"{folder}/bucket", ".torn.csv.crc", b"crc\x00\x00\x00\x02\x00\x00\x00\x00\x01")
    put(f"{folder}/bucket", "late.csv", f"{HEADER}\n{ROW}\n")
    registry = spark.read.schema(S.ORG_FILES).parquet(site.registry)
    for name in ("torn", "late"):
        changed = {"id": F.lit(name), "s3_key": F.lit(f"{name}.csv")}
        registry.filter("id = 'p1'").withColumns(changed).write.mode("append").parquet(site.registry)
    load, calls = intake.load_uploads, []

    def deleted_first(*arguments):
        if not calls:
            os.remove(f"{folder}/bucket/late.csv")
        calls.append(1)
        return load(*arguments)

    monkeypatch.setattr(intake, "load_uploads", deleted_first)
    intake.process_batch(spark.createDataFrame([(f'{{"fileId": "{i}"}}',) for i in ("p1", "torn", "late", "gone")], "value string"), 3, site)
    found = states(spark, site)
    assert found["p1"] == ("COMPLETED", None)
    assert found["torn"] == ("FAILED", "Unexpected processing error: unreadable file")
    assert found["late"] == found["gone"] == ("PROCESSING", None)
    assert stored_files(spark, site.org_provider).count() == 2


def test_a_batch_leaves_no_staged_tables(spark, folder, site, monkeypatch):
    monkeypatch.setattr(session, "shared_folder", lambda _: f"{folder}/shared")
    intake.process_batch(spark.createDataFrame([('{"fileId": "p1"}',)], "value string"), 3, site)
    assert states(spark, site)["p1"] == ("COMPLETED", None)
    assert [n for n in os.listdir(f"{folder}/shared") if not n.startswith(".")] == []


def test_a_claim_reads_the_buckets_of_its_files(spark, folder):
    files = spark.range(300).select(F.col("id").cast("string").alias("id"), F.lit("PROVIDER").alias("file_type"), F.lit("PENDING").alias("status"))
    status.write_registry(conform(files, S.ORG_FILES), f"{folder}/registry")
    ids = spark.createDataFrame([("7",), ("250",)], "file_id string")
    for step in range(3):
        status.append_log(status.log_entries(files.select(F.col("id").alias("file_id")), F.lit("PROCESSING" if step < 2 else "PENDING"), F.lit(None), step, 1), f"{folder}/log")
    registry, log = status.read_registry(spark, f"{folder}/registry"), status.read_log(spark, f"{folder}/log")
    claimed = status.claim(ids, registry, log, 9)
    assert rows_of(claimed, "id") == [("250",), ("7",)]
    plan = claimed._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "PartitionFilters" in line]
    assert sum("dynamicpruning" in line for line in scans) == 2, plan
    status.compact_log(spark, f"{folder}/log")
    compacted = status.read_log(spark, f"{folder}/log")
    assert compacted.count() == 300
    assert rows_of(status.claim(ids, registry, compacted, 9), "id") == [("250",), ("7",)]


def test_compaction_keeps_every_state(spark):
    at = [datetime(2025, 1, 1, h) for h in range(8)]
    log = []
    for f in range(60):
        steps = [("PROCESSING", 1), ("FAILED", 1), ("PENDING", 1), ("PENDING", None), ("PROCESSING", 2), ("COMPLETED", 2), ("PENDING", 2)]
        log += [(str(f), steps[(f * k) % 7][0], "e" if k % 2 else None, at[(k * f) % 8], steps[(f * k) % 7][1], k) for k in range(f % 7 + 1)]
    frame = spark.createDataFrame(log, S.STATUS_LOG)
    kept = status.deciding(frame)
    assert rows_of(status.latest_status(kept)) == rows_of(status.latest_status(frame))
    assert kept.groupBy("file_id").count().agg(F.max("count")).first()[0] <= 3


def test_states_survive_a_restart_and_timers_send_stuck_files_again(spark, folder):
    now = datetime.now()

    def append(*rows):
        entries = spark.createDataFrame([(f, s, e, t, b, q) for f, s, e, t, b, q in rows], S.STATUS_LOG)
        status.append_log(entries, f"{folder}/log")

    def turn():
        log = spark.readStream.schema(S.STATUS_LOG).parquet(f"{folder}/log")
        with state.state_store(spark):
            state.run_through(state.state_writer(log, f"{folder}/states", f"{folder}/c1"))
            log = spark.readStream.schema(S.STATUS_LOG).parquet(f"{folder}/log")
            state.run_through(state.sweep_writer(log, f"{folder}/log", f"{folder}/messages", f"{folder}/c2"))
        return {r.file_id: (r.status, r.stuck) for r in state.read_states(spark, f"{folder}/states").collect()}

    old = now - timedelta(hours=1)
    append(("done", "PROCESSING", None, old, 1, 11), ("done", "COMPLETED", None, old, 1, 12), ("old", "PROCESSING", None, old, 1, 11), ("new", "PROCESSING", None, now, 1, 11))
    assert turn() == {"done": ("COMPLETED", False), "old": ("PROCESSING", True), "new": ("PROCESSING", False)}
    sent = [json.loads(r[0]) for r in spark.read.text(f"{folder}/messages/*").collect()]
    assert sent == [{"fileId": "old", "expired": 1}]
    append(("done", "PENDING", None, now, 1, 13), ("new", "FAILED", "x", now, 1, 12))
    assert turn() == {"done": ("COMPLETED", False), "old": ("PENDING", False), "new": ("FAILED", False)}
    log = status.read_log(spark, f"{folder}/log")
    same = rows_of(status.latest_status(log), "file_id", "status")
    assert same == [("done", "COMPLETED"), ("new", "FAILED"), ("old", "PENDING")]


def test_redelivered_messages_are_dropped_after_a_restart(spark, folder, site, monkeypatch):
    seen = []
    monkeypatch.setattr(intake, "process_batch", lambda lines, *_: seen.extend(r[0] for r in lines.collect()))

    def turn():
        lines = intake.read_messages(spark, f"{folder}/messages")
        intake.intake_writer(lines, site, f"{folder}/checkpoint", "10 minutes").trigger(availableNow=True).start().awaitTermination()

    send(folder, "a.json", "p1", "p1", "f1", raw=["{broken"])
    turn()
    send(folder, "b.json", "p1", "b1", raw=["{broken", '{"fileId": "p1", "expired": 1}'])
    turn()
    assert sorted(seen) == sorted(['{"fileId": "p1"}', '{"fileId": "f1"}', "{broken", '{"fileId": "b1"}', '{"fileId": "p1", "expired": 1}'])


def test_null_types_and_addresses_fail_alone(spark, folder, site):
    columns = spark.read.parquet(site.registry).columns
    good = spark.read.parquet(site.registry).filter("id = 'p1'")
    changed = [good.withColumn("id", F.lit("n1")).withColumn("file_type", F.lit(None).cast("string")), good.withColumn("id", F.lit("n2")).withColumn("s3_key", F.lit(None).cast("string"))]
    for frame in changed:
        frame.select(*columns).write.mode("append").parquet(site.registry)
    intake.process_batch(spark.createDataFrame([(f'{{"fileId": "{i}"}}',) for i in ("p1", "n1", "n2")], "value string"), 3, site)
    found = states(spark, site)
    assert found["p1"] == ("COMPLETED", None) and found["n1"] == ("FAILED", "Unknown file_type: 'None'")
    assert found["n2"][0] == "FAILED" and "no object address" in found["n2"][1]


class Store:
    """Value, timers and calls of one group's store."""

    def __init__(self):
        self.value, self.timers, self.calls = None, set(), 0

    def getValueState(self, *_):
        return self

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls, self.value = self.calls + 1, value

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.calls += 1
        self.timers.remove(at)


class Clock:
    def __init__(self, now):
        self.now = now

    def getCurrentProcessingTimeInMs(self):
        return self.now


def test_files_of_a_group_share_a_value_and_a_timer():
    store, files = Store(), FileStatus(15, status.TERMINAL)
    files.init(store)

    def take(*entries):
        return [(r.file_id, r.status, r.stuck) for r in files.handleInputRows((0,), iter([(0, *e) for e in entries]), Clock(0))]

    def expire(now):
        (gone,) = [t for t in store.timers if t <= now]
        found = [(r.file_id, r.status, r.stuck) for r in files.handleExpiredTimer((0,), Clock(now), None)]
        store.timers.discard(gone)  # as Spark does when it is handled
        return found

    minute = 60_000_000
    assert len(take(*((str(i), i * minute, i, "PROCESSING", None, 1) for i in range(500)))) == 500
    assert store.calls == 3 and store.timers == {15 * 60_000}
    # the first ends, the second is told late that it failed before; the others keep their times
    assert take(("0", 600 * minute, 900, "COMPLETED", None, 1), ("1", 0, 0, "FAILED", "x", 1)) == [("0", "COMPLETED", False), ("1", "FAILED", False)]
    assert store.timers == {17 * 60_000}
    assert expire(18 * 60_000) == [("2", "PROCESSING", True), ("3", "PROCESSING", True)]
    assert store.timers == {19 * 60_000}
    assert take(("2", 700 * minute, 901, "PENDING", None, None)) == [("2", "PENDING", False)]
    assert len(expire(10_000 * 60_000)) == 496 and store.timers == set()
    assert take(("0", 800 * minute, 902, "PENDING", None, None), ("3", 5 * minute, 903, "PENDING", None, 1)) == [("0", "PENDING", False), ("3", "PENDING", False)]


@pytest.mark.parametrize("groups", [1, 7])
def test_states_of_few_groups_are_those_of_the_log(spark, folder, monkeypatch, groups):
    monkeypatch.setattr(state, "GROUPS", groups)
    now = datetime.now()
    steps = [("PROCESSING", 1), ("FAILED", 1), ("PENDING", 1), ("PENDING", None), ("PROCESSING", 2), ("COMPLETED", 2), ("PROCESSING", None)]
    log = []
    for f in range(90):
        at = now - timedelta(days=1) if f % 2 else now
        for k in range(f % 7 + 1):
            name, batch = steps[(f * k + f) % 7]
            log.append((f"f\"{f}é", name, f"e\\{k}" if k % 2 else None, None if f % 13 == 5 and k == 1 else at + timedelta(microseconds=(k * f) % 5), batch, None if k == 2 else k))
    log.append((None, "PENDING", None, now, None, 1))
    for i in range(3):
        spark.createDataFrame(log[i::3], S.STATUS_LOG).coalesce(1).write.mode("append").parquet(f"{folder}/log")
    stream = spark.readStream.schema(S.STATUS_LOG).option("maxFilesPerTrigger", 1).parquet(f"{folder}/log")
    with state.state_store(spark):
        state.run_through(state.state_writer(stream, f"{folder}/states", f"{folder}/checkpoint"))
        metadata = spark.read.format("statestore").option("stateVarName", "files").load(f"{folder}/checkpoint")
        assert metadata.count() <= groups
    found = state.read_states(spark, f"{folder}/states")
    whole = status.latest_status(spark.createDataFrame([e for e in log if e[0]], S.STATUS_LOG))
    columns = ["file_id", "status", "error_message", "updated_at", "batch_id"]
    assert rows_of(found, *columns) == rows_of(whole, *columns)
    stuck = whole.filter((F.col("status") == "PROCESSING") & (F.coalesce("updated_at", F.lit(datetime(1, 1, 1))) < F.lit(now - timedelta(hours=1))))
    assert stuck.count() > 3 and rows_of(found.filter("stuck"), "file_id") == rows_of(stuck, "file_id")


def test_a_batch_done_again_does_not_end_a_run():
    class Run:
        """A stream that goes on with an empty batch of the run before."""

        batches = [None, (5, 0), (5, 0), (6, 3), (7, 0), (8, 0)]

        def start(self):
            return self

        @property
        def lastProgress(self):
            self.at = self.batches.pop(0)
            return self.at and {"batchId": self.at[0], "numInputRows": self.at[1]}

        def awaitTermination(self, _):
            return False

        def stop(self):
            self.stopped = self.at

    run = Run()
    state.run_through(run)
    assert run.stopped == (7, 0)
