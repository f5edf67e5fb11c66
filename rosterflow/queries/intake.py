"""Messages, claims, status and the streaming intake."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow import schemas as S
from rosterflow.operators.quality import declared_checks
from rosterflow.operators.shape import conform
from rosterflow.queries.files import customer_upload
from rosterflow.queries.registry import Tables, query
from rosterflow.session import fresh_path
from rosterflow.sinks.tables import stored_files
from rosterflow.streaming import route, state, status
from rosterflow.streaming.intake import IntakeTables, intake_writer, message_file_id, parse_messages, read_messages

_LINE = """CASE event_id % 4 WHEN 0 THEN '{{"fileId": ' WHEN 1 THEN 'null' ELSE '{{"fileId": "' || CAST(user_id AS {text}) || '"}}' END"""


@query("""
SELECT event_id, CASE WHEN event_id % 4 > 1 THEN CAST(user_id AS VARCHAR) END AS file_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k
FROM events
""")
def json_message_parse(t):
    lines = t.events.select("event_id", "props", F.expr(_LINE.format(text="STRING")).alias("value"))
    return lines.select("event_id", message_file_id(F.col("value")).alias("file_id"), F.from_json("props", "k bigint")["k"].alias("k"))


def registry_of(t: Tables) -> DataFrame:
    """Customers as uploaded files, all pending."""
    kind = (
        F.when(F.col("c_mktsegment") == "BUILDING", "PROVIDER")
        .when(F.col("c_mktsegment") == "MACHINERY", "FACILITY")
        .when(F.col("c_mktsegment") == "FURNITURE", "BENEFICIARY")
        .otherwise(F.col("c_mktsegment"))
    )
    return conform(
        t.customer.select(F.col("c_custkey").cast("string").alias("id"), kind.alias("file_type"), F.lit("PENDING").alias("status")),
        S.ORG_FILES,
    )


_REGISTRY_NULLS = ["organization_id", "uploaded_by_id", "original_name", "s3_bucket", "s3_key", "created_at", "updated_at"]


@query(
    "SELECT 'not null' AS rule, 'id' AS subject, count(*) - count(c_custkey) AS violations FROM customer"
    + " UNION ALL SELECT 'not null', 'file_type', count(*) - count(c_mktsegment) FROM customer"
    + " UNION ALL SELECT 'not null', 'status', count(*) * 0 FROM customer"
    + "".join(f" UNION ALL SELECT 'not null', '{c}', count(*) FROM customer" for c in _REGISTRY_NULLS)
    + " UNION ALL SELECT 'domain', 'file_type', count(*) FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'FURNITURE')"
    + " UNION ALL SELECT 'domain', 'status', count(*) * 0 FROM customer"
    + " UNION ALL SELECT 'key', 'id', count(*) FROM (SELECT c_custkey FROM customer GROUP BY ALL HAVING count(*) > 1)"
)
def quality_declared(t):
    return declared_checks(registry_of(t), "org_files")


def log_of(t: Tables) -> DataFrame:
    """Orders as transitions of their customer's file; a third of the pending ones submit it again."""
    state = F.when(F.col("o_orderstatus") == "F", "FAILED").when(F.col("o_orderstatus") == "O", "PROCESSING").otherwise("PENDING")
    return t.orders.select(
        F.col("o_custkey").cast("string").alias("file_id"),
        state.alias("status"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).alias("error_message"),
        F.col("o_orderdate").cast("timestamp").alias("updated_at"),
        F.when((state != "PENDING") | (F.col("o_orderkey") % 3 != 0), F.col("o_orderkey") % 3).alias("batch_id"),
        F.col("o_orderkey").alias("seq"),
    )


_STATE_SQL = """
moves AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n,
                 CASE WHEN o_orderstatus = 'P' AND o_orderkey % 3 = 0 THEN NULL ELSE o_orderkey % 3 END AS batch_id FROM orders),
marks AS (SELECT o_custkey, max(n) AS newest, max(n) FILTER (o_orderstatus = 'F') AS finished,
                 coalesce(max(n) FILTER (o_orderstatus = 'P' AND batch_id IS NULL), 0) AS again FROM moves GROUP BY o_custkey),
latest AS (SELECT CAST(o_custkey AS VARCHAR) AS id, o_orderstatus AS s, batch_id, o_orderdate FROM moves JOIN marks USING (o_custkey)
           WHERE n = CASE WHEN finished > again THEN finished ELSE newest END),
files AS (SELECT CAST(c_custkey AS VARCHAR) AS id,
                 CASE c_mktsegment WHEN 'BUILDING' THEN 'PROVIDER' WHEN 'MACHINERY' THEN 'FACILITY' WHEN 'FURNITURE' THEN 'BENEFICIARY' ELSE c_mktsegment END AS file_type,
                 CASE s WHEN 'F' THEN 'FAILED' WHEN 'O' THEN 'PROCESSING' ELSE 'PENDING' END AS status, batch_id, o_orderdate
          FROM customer LEFT JOIN latest ON CAST(c_custkey AS VARCHAR) = id)
"""


@query(f"""
WITH {_STATE_SQL}
SELECT id, file_type, status FROM files WHERE id IN (SELECT CAST(user_id AS VARCHAR) FROM events)
AND (status = 'PENDING' OR (status = 'PROCESSING' AND batch_id = 1))
""")
def claim_pending(t):
    ids = t.events.select(F.col("user_id").cast("string").alias("file_id"))
    return status.claim(ids, registry_of(t), log_of(t), 1).select("id", "file_type", "status")


@query(f"""
WITH {_STATE_SQL}
SELECT DISTINCT CAST(user_id AS VARCHAR) AS file_id FROM events WHERE CAST(user_id AS VARCHAR) NOT IN
(SELECT id FROM files WHERE status = 'PENDING' OR (status = 'PROCESSING' AND batch_id = 1))
""")
def claim_skipped(t):
    ids = t.events.select(F.col("user_id").cast("string").alias("file_id"))
    return status.skipped(ids, status.claim(ids, registry_of(t), log_of(t), 1))


@query("""
SELECT CAST(user_id AS VARCHAR) AS file_id, event_type AS status, CASE WHEN event_type = 'error' THEN props END AS error_message,
       event_id % 10 AS batch_id
FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
""")
def current_status(t):
    log = t.events.select(
        F.col("user_id").cast("string").alias("file_id"),
        F.col("event_type").alias("status"),
        F.when(F.col("event_type") == "error", F.col("props")).alias("error_message"),
        F.col("ts").alias("updated_at"),
        (F.col("event_id") % 10).alias("batch_id"),
        F.col("event_id").alias("seq"),
    )
    return status.latest_status(log).drop("updated_at")


def replayed(t: Tables, log: DataFrame, files: int = 4) -> DataFrame:
    """The states that a stream over the log has come to, which gets it in several batches, dealt by file and entry."""
    root = fresh_path(t.spark, "states")
    log.select(*S.STATUS_LOG.fieldNames()).repartition(files, F.xxhash64("file_id", "seq")).write.parquet(f"{root}/log")
    stream = t.spark.readStream.schema(S.STATUS_LOG).option("maxFilesPerTrigger", 1).parquet(f"{root}/log")
    with state.state_store(t.spark):
        state.run_through(state.state_writer(stream, f"{root}/states", f"{root}/checkpoint"))
    return state.read_states(t.spark, f"{root}/states")


@query("""
WITH m AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n,
                  CASE WHEN o_orderstatus = 'P' AND o_orderkey % 3 = 0 THEN NULL ELSE o_orderkey % 3 END AS batch_id FROM orders),
marks AS (SELECT o_custkey, max(n) AS newest, max(n) FILTER (o_orderstatus = 'F') AS finished,
                 coalesce(max(n) FILTER (o_orderstatus = 'P' AND batch_id IS NULL), 0) AS again FROM m GROUP BY o_custkey)
SELECT CAST(o_custkey AS VARCHAR) AS file_id, CASE o_orderstatus WHEN 'F' THEN 'FAILED' WHEN 'O' THEN 'PROCESSING' ELSE 'PENDING' END AS status,
       CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS error_message, batch_id
FROM m JOIN marks USING (o_custkey) WHERE n = CASE WHEN finished > again THEN finished ELSE newest END
""")
def stream_status(t):
    """Status of every file as the state of a stream that the log is replayed to."""
    return replayed(t, log_of(t)).select("file_id", "status", "error_message", "batch_id")


@query(f"""
WITH {_STATE_SQL}
SELECT id FROM files WHERE status = 'PROCESSING' AND CAST(id AS BIGINT) % 2 = 0
""")
def stream_stuck(t):
    """Files whose timer ran out in that stream; entries of odd files are moved a century on and still have time."""
    odd = F.col("file_id").cast("bigint") % 2 == 1
    log = log_of(t).withColumn("updated_at", F.col("updated_at") + F.when(odd, F.make_ym_interval(F.lit(100))).otherwise(F.make_ym_interval(F.lit(0))))
    return replayed(t, log).filter("stuck").select(F.col("file_id").alias("id"))


@query("""
WITH typed AS (SELECT event_id, props, CASE event_type WHEN 'click' THEN 'PROVIDER' WHEN 'view' THEN 'FACILITY' WHEN 'error' THEN 'BENEFICIARY' ELSE event_type END AS file_type FROM events),
routed AS (SELECT event_id, file_type, CASE file_type WHEN 'PROVIDER' THEN 'org_provider' WHEN 'FACILITY' THEN 'org_facility' END AS handler,
       CASE WHEN file_type = 'BENEFICIARY' THEN 'BENEFICIARY file processing is not yet implemented'
            WHEN file_type NOT IN ('PROVIDER', 'FACILITY') THEN 'Unknown file_type: ''' || file_type || '''' END AS error FROM typed)
SELECT event_id, file_type, handler, error, CASE WHEN error IS NULL THEN 'COMPLETED' ELSE 'FAILED' END AS status FROM routed
""")
def route_by_type(t):
    kind = (
        F.when(F.col("event_type") == "click", "PROVIDER")
        .when(F.col("event_type") == "view", "FACILITY")
        .when(F.col("event_type") == "error", "BENEFICIARY")
        .otherwise(F.col("event_type"))
    )
    typed = t.events.select("event_id", kind.alias("file_type"))
    routed = typed.withColumns(
        {"handler": route.handler(F.col("file_type")), "error": route.refusal(F.col("file_type"))}
    )
    return routed.withColumn("status", route.outcome_status(F.col("error")))


@query(f"""
WITH {_STATE_SQL}
SELECT id FROM files WHERE status = 'PROCESSING' AND o_orderdate < TIMESTAMP '2000-01-01 00:10:00' - INTERVAL 15 MINUTE
""")
def stuck_sweep(t):
    now = F.lit("2000-01-01 00:10:00").cast("timestamp")
    return status.stuck_files(status.current_files(registry_of(t), log_of(t)), now).select("id")


@query("""
SELECT 'org_providers' AS target, 'org-1' AS organization_id, count(*) AS n, count(DISTINCT c_custkey) AS codes, true AS all_completed FROM customer
UNION ALL
SELECT 'org_facilities', 'org-1', count(*), count(DISTINCT s_suppkey), true FROM supplier
""")
def stream_intake(t):
    """Customers and suppliers uploaded as files, every event delivered as a message.

    Each file is announced twice; most messages name no known file. The result is
    read back from the tables the stream has filled."""
    spark, root = t.spark, fresh_path(t.spark, "intake")
    uploads = {"PROVIDER": f"{root}/bucket/providers", "FACILITY": f"{root}/bucket/facilities"}
    customer_upload(t).write.options(header=True, escape='"').csv(uploads["PROVIDER"])
    supplier_rows = t.supplier.select(
        *[
            {"ssa_state_county_code": F.col("s_suppkey").cast("string"), "facility_name": F.col("s_name")}
            .get(c, F.lit(None))
            .cast("string")
            .alias(c)
            for c in S.FACILITY_COLUMNS
        ]
    )
    supplier_rows.write.option("header", True).csv(uploads["FACILITY"])
    files = [
        (f"{kind}-{i}", kind, "org-1", "bucket", f.split("/bucket/")[1], "PENDING")
        for kind, folder in uploads.items()
        for i, f in enumerate(spark.read.text(folder).inputFiles())
    ]
    registry = spark.createDataFrame(
        files, "id string, file_type string, organization_id string, s3_bucket string, s3_key string, status string"
    )
    status.write_registry(conform(registry, S.ORG_FILES), f"{root}/registry")
    spark.createDataFrame([], S.STATUS_LOG).write.parquet(f"{root}/log")

    announced = registry.select(F.to_json(F.struct(F.col("id").alias("fileId"))).alias("value"))
    others = t.events.select(F.expr(_LINE.format(text="STRING")).alias("value"))
    announced.unionAll(announced).unionAll(others).write.text(f"{root}/messages")
    tables = IntakeTables(
        f"{root}/registry", f"{root}/log", f"{root}/rejected", f"{root}/org_providers", f"{root}/org_facilities", f"{root}/"
    )
    run = intake_writer(read_messages(spark, f"{root}/messages"), tables, f"{root}/checkpoint", "1 minute").trigger(availableNow=True)
    run.start().awaitTermination()

    log = status.read_log(spark, tables.status_log)
    ended = status.current_files(status.read_registry(spark, tables.registry), log).groupBy("file_type").agg(
        F.bool_and(F.col("status") == "COMPLETED").alias("all_completed")
    )

    def loaded(path: str, target: str, kind: str) -> DataFrame:
        rows = stored_files(spark, path).groupBy("organization_id").agg(
            F.count(F.lit(1)).alias("n"), F.countDistinct("ssa_state_county_code").alias("codes")
        )
        return rows.select(F.lit(target).alias("target"), "organization_id", "n", "codes", F.lit(kind).alias("file_type"))

    both = loaded(tables.org_provider, "org_providers", "PROVIDER").unionByName(
        loaded(tables.org_facility, "org_facilities", "FACILITY")
    )
    return both.join(ended, "file_type").drop("file_type")
