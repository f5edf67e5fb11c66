"""Scalar functions over the driver tables."""

from pyspark.sql import functions as F

from rosterflow.functions import numbers, text
from rosterflow.queries.registry import query

DIRTY_FLAG = "CASE k % 6 WHEN 0 THEN 'Y' WHEN 1 THEN ' no ' WHEN 2 THEN 'True' WHEN 3 THEN '0' WHEN 4 THEN '' END"


def dirty_flag(key: str) -> str:
    return DIRTY_FLAG.replace("k %", f"{key} %")


_CODE5 = """CASE c_custkey % 4
    WHEN 0 THEN ' ' || CAST(c_custkey AS {text}) || chr(9)
    WHEN 1 THEN CAST(c_custkey * 1000 + 999999 AS {text})
    WHEN 2 THEN 'N' || CAST(c_custkey AS {text})
    ELSE CAST(c_nationkey AS {text}) END"""


@query(f"""
WITH raw AS (SELECT c_custkey, trim({_CODE5.format(text='VARCHAR')}, ' ' || chr(9)) AS s FROM customer)
SELECT c_custkey, CASE WHEN regexp_full_match(s, '[0-9]{{1,5}}') THEN lpad(s, 5, '0') ELSE s END AS code FROM raw
""")
def pad_code5(t):
    return t.customer.select("c_custkey", text.pad_code(F.expr(_CODE5.format(text="STRING")), 5).alias("code"))


_CODE3 = """CASE p_partkey % 4 WHEN 0 THEN CAST(p_size AS {text}) WHEN 1 THEN p_brand
    WHEN 2 THEN ' ' || CAST(p_partkey AS {text}) ELSE NULL END"""


@query(f"""
WITH raw AS (SELECT p_partkey, trim({_CODE3.format(text='VARCHAR')}) AS s FROM part)
SELECT p_partkey, CASE WHEN regexp_full_match(s, '[0-9]{{1,3}}') THEN lpad(s, 3, '0') ELSE s END AS code,
       CASE WHEN length(coalesce(s, '')) >= 3 THEN s ELSE lpad(coalesce(s, ''), 3, '0') END AS compared
FROM raw
""")
def pad_code3(t):
    raw = F.expr(_CODE3.format(text="STRING"))
    return t.part.select(
        "p_partkey", text.pad_code(raw, 3).alias("code"), text.check_code(raw, 3).alias("compared")
    )


@query(f"""
SELECT o_orderkey, CASE WHEN upper(trim(raw)) IN ('Y', 'YES', 'TRUE', '1') THEN true
                        WHEN upper(trim(raw)) IN ('N', 'NO', 'FALSE', '0') THEN false END AS flag
FROM (SELECT o_orderkey, {dirty_flag('o_orderkey')} AS raw FROM orders)
""")
def yn_to_bool(t):
    return t.orders.select("o_orderkey", text.yes_no(F.expr(dirty_flag("o_orderkey"))).alias("flag"))


_NUMBER = """CASE (l_orderkey + l_linenumber) % 6 WHEN 0 THEN 'n/a' WHEN 1 THEN ''
    WHEN 2 THEN CAST(l_partkey AS {text}) || '.75' WHEN 3 THEN CAST(l_suppkey AS {text})
    WHEN 4 THEN '-' || CAST(l_suppkey AS {text}) || '.9' ELSE CAST(l_extendedprice AS {text}) END"""


@query(f"""
SELECT l_orderkey, l_linenumber, CAST(trunc(TRY_CAST({_NUMBER.format(text='VARCHAR')} AS DOUBLE)) AS BIGINT) AS amount
FROM lineitem
""")
def safe_int_truncate(t):
    raw = F.expr(_NUMBER.format(text="STRING"))
    return t.lineitem.select("l_orderkey", "l_linenumber", numbers.truncated_long(raw).alias("amount"))


_CAST = """CASE event_id % 5 WHEN 0 THEN CAST(user_id AS {text}) WHEN 1 THEN CAST(user_id AS {text}) || '.0'
    WHEN 2 THEN 'bad' WHEN 3 THEN 'NaN' ELSE CAST(value AS {text}) END"""


@query(f"""
WITH raw AS (SELECT event_id, {_CAST.format(text='VARCHAR')} AS s FROM events)
SELECT event_id, CASE WHEN regexp_full_match(s, '[0-9]+') THEN CAST(s AS BIGINT) END AS whole,
       CASE WHEN s = 'NaN' THEN NULL ELSE TRY_CAST(s AS DOUBLE) END AS number
FROM raw
""")
def nonstrict_casts(t):
    raw = F.expr(_CAST.format(text="STRING"))
    return t.events.select(
        "event_id",
        numbers.to_long(raw).alias("whole"),
        numbers.nan_as_null(numbers.to_double(raw)).alias("number"),
    )


@query("""
WITH raw AS (
    SELECT o_orderkey, o_orderpriority AS a,
           CASE WHEN o_orderkey % 3 = 0 THEN '  Large   Metro (' || o_orderstatus || ')' WHEN o_orderkey % 3 = 1 THEN ' -- ' END AS b
    FROM orders)
SELECT o_orderkey,
       nullif(regexp_replace(regexp_replace(lower(trim(a)), '\\s+', '_', 'g'), '[^a-z0-9_]', '', 'g'), '') AS priority,
       nullif(regexp_replace(regexp_replace(lower(trim(b)), '\\s+', '_', 'g'), '[^a-z0-9_]', '', 'g'), '') AS county_type
FROM raw
""")
def snake_case_type(t):
    county = (
        F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("  Large   Metro ("), "o_orderstatus", F.lit(")")))
        .when(F.col("o_orderkey") % 3 == 1, F.lit(" -- "))
    )
    return t.orders.select(
        "o_orderkey",
        text.snake_case(F.col("o_orderpriority")).alias("priority"),
        text.snake_case(county).alias("county_type"),
    )


_ADDRESS = """CASE o_orderkey % 7 WHEN 0 THEN 'P.O. Box ' || CAST(o_custkey AS {text})
    WHEN 1 THEN 'post office box 9' WHEN 2 THEN '12 Boxwood Rd' WHEN 3 THEN '  ' WHEN 4 THEN NULL
    WHEN 5 THEN 'Suite 4, po  BOX 7' ELSE CAST(o_custkey AS {text}) || ' Main St' END"""
_NPI = """CASE o_orderkey % 4 WHEN 0 THEN substring('123456789', 1, 9) WHEN 1 THEN '12345abcde'
    ELSE ' ' || lpad(CAST(o_orderkey AS {text}), 10, '1') END"""
_ACCURACY = "CASE o_orderkey % 5 WHEN 0 THEN ' HIGH' WHEN 1 THEN 'medium' WHEN 2 THEN 'sure' WHEN 3 THEN '' END"


@query(f"""
SELECT o_orderkey,
       regexp_matches(coalesce({_ADDRESS.format(text='VARCHAR')}, ''),
                      '(?i)\\b(?:p\\.?\\s*o\\.?\\s*box|post\\s*office\\s*box|po\\s*box)\\b') AS po_box,
       regexp_full_match(trim({_NPI.format(text='VARCHAR')}), '[0-9]{{10}}') AS npi_ok,
       lower(trim(coalesce({_ACCURACY}, ''))) IN ('high', 'medium', 'low', '') AS accuracy_ok
FROM orders
""")
def pattern_predicates(t):
    return t.orders.select(
        "o_orderkey",
        text.is_po_box(F.expr(_ADDRESS.format(text="STRING"))).alias("po_box"),
        text.is_npi(F.expr(_NPI.format(text="STRING"))).alias("npi_ok"),
        text.is_accuracy_value(F.expr(_ACCURACY)).alias("accuracy_ok"),
    )


@query("""
SELECT l_orderkey, l_linenumber, l_partkey,
       CASE WHEN p_size = 40 THEN CAST(l_quantity AS BIGINT) END AS beds,
       coalesce(CASE WHEN p_size = 40 THEN CAST(l_quantity AS BIGINT) END, CAST(p_size AS BIGINT), l_suppkey) AS required
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
""")
def conditional_coalesce(t):
    joined = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"), "left")
    beds = F.when(F.col("p_size") == 40, F.col("l_quantity").cast("bigint"))
    return joined.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        beds.alias("beds"),
        F.coalesce(beds, F.col("p_size").cast("bigint"), "l_suppkey").alias("required"),
    )


@query("""
SELECT doc_id, substring('Unexpected processing error: ' || text, 1, 500) AS error_message,
       'Invalid or unknown SSA State/County code: ' || coalesce(CASE WHEN doc_id % 3 > 0 THEN source END, 'None') AS message
FROM documents
""")
def message_format_truncate(t):
    from rosterflow.streaming.route import unexpected
    from rosterflow import schemas as S

    raw = F.when(F.col("doc_id") % 3 > 0, F.col("source"))
    return t.documents.select(
        "doc_id",
        text.clip_message(unexpected(F.col("text"))).alias("error_message"),
        F.concat(F.lit(S.MSG_SSA), text.shown(raw)).alias("message"),
    )


@query("""
SELECT s_suppkey, CASE WHEN lon IS NOT NULL AND lat IS NOT NULL THEN lon END AS point_lon,
       CASE WHEN lon IS NOT NULL AND lat IS NOT NULL THEN lat END AS point_lat
FROM (SELECT s_suppkey, CASE WHEN s_suppkey % 5 > 0 THEN -70.0 - s_nationkey END::DOUBLE AS lon,
             CASE WHEN s_suppkey % 7 > 0 THEN 30.0 + s_nationkey END::DOUBLE AS lat FROM supplier)
""")
def point_from_coordinates(t):
    from rosterflow.functions.geo import point

    lon = F.when(F.col("s_suppkey") % 5 > 0, (F.lit(-70) - F.col("s_nationkey")).cast("double"))
    lat = F.when(F.col("s_suppkey") % 7 > 0, (F.lit(30) + F.col("s_nationkey")).cast("double"))
    return t.supplier.select("s_suppkey", point(lon, lat).alias("p")).select(
        "s_suppkey", F.col("p.lon").alias("point_lon"), F.col("p.lat").alias("point_lat")
    )
