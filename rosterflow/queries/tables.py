"""Projections, filters, joins, sets, dedupe and quality checks."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterflow.operators import dedupe, joins, quality, sets, shape
from rosterflow.queries.registry import query
from rosterflow.sources.codes import constant_codes, given_codes


@query("SELECT s_suppkey AS geoid, s_name AS name, s_nationkey AS source_year FROM supplier")
def positional_rename_select(t):
    return shape.rename_by_position(t.supplier, ["geoid", "name", "source_year"])


@query("""
SELECT CAST(s_suppkey AS VARCHAR) AS npi, trim(s_name) AS provider_name, 'org-1' AS organization_id,
       CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS BOOLEAN) AS letter_of_intent, 2025 AS source_year
FROM (SELECT s_suppkey, '  ' || s_name || ' ' AS s_name FROM supplier)
""")
def conform_to_schema(t):
    target = T.StructType.fromDDL(
        "npi string, provider_name string, organization_id string, latitude double, letter_of_intent boolean, source_year int"
    )
    raw = t.supplier.select(
        F.concat(F.lit("  "), "s_name", F.lit(" ")).alias("provider_name"), F.col("s_suppkey").alias("npi")
    )
    stripped = shape.strip_strings(raw, skip=["npi"])
    return shape.conform(shape.with_literals(stripped, {"organization_id": "org-1", "source_year": 2025}), target)


@query("""
SELECT c_custkey, geoid, lat FROM (
    SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN '  ' WHEN 1 THEN NULL ELSE c_name END AS geoid,
           CASE WHEN c_custkey % 6 < 4 THEN c_acctbal END AS lat, c_mktsegment FROM customer)
WHERE length(trim(geoid)) > 0 AND lat IS NOT NULL AND c_mktsegment = 'BUILDING'
""")
def drop_blank_and_null(t):
    geoid = F.expr("CASE c_custkey % 4 WHEN 0 THEN '  ' WHEN 1 THEN NULL ELSE c_name END")
    rows = t.customer.filter("c_mktsegment = 'BUILDING'").select(
        "c_custkey", geoid.alias("geoid"), F.when(F.col("c_custkey") % 6 < 4, F.col("c_acctbal")).alias("lat")
    )
    return shape.drop_blank(rows, "geoid").dropna(subset=["lat"])


@query("SELECT count(*) AS n, count(*) AS ids, count(*) AS stable_ids FROM customer")
def surrogate_keys(t):
    keyed = t.customer.select(
        shape.random_id().alias("id"), shape.stable_id(F.col("c_nationkey"), F.col("c_custkey")).alias("stable")
    )
    return keyed.agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("ids"), F.countDistinct("stable").alias("stable_ids")
    )


@query("SELECT c_custkey, sha256(CAST(c_nationkey AS VARCHAR) || '|' || CAST(c_custkey AS VARCHAR)) AS id FROM customer")
def stable_keys(t):
    return t.customer.select("c_custkey", shape.stable_id(F.col("c_nationkey"), F.col("c_custkey")).alias("id"))


_LEFT = """SELECT CASE WHEN l_linenumber < 7 THEN l_orderkey END AS ssa, l_linestatus AS specialty,
    CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_quantity AS BIGINT) END AS required, l_suppkey AS ratio FROM lineitem"""
_RIGHT = """SELECT CASE WHEN o_orderkey % 11 > 0 THEN o_orderkey END AS ssa, o_orderstatus AS specialty,
    CAST(floor(o_totalprice) AS BIGINT) AS required, o_custkey AS ratio FROM orders"""


@query(f"""
SELECT ssa, specialty, coalesce(l.required, r.required) AS required, coalesce(l.ratio, r.ratio) AS ratio
FROM ({_LEFT}) l FULL JOIN ({_RIGHT}) r USING (ssa, specialty)
""")
def full_join_coalesce(t):
    left = t.lineitem.select(
        F.when(F.col("l_linenumber") < 7, F.col("l_orderkey")).alias("ssa"),
        F.col("l_linestatus").alias("specialty"),
        F.when(F.col("l_linenumber") % 2 == 0, F.col("l_quantity").cast("bigint")).alias("required"),
        F.col("l_suppkey").alias("ratio"),
    )
    right = t.orders.select(
        F.when(F.col("o_orderkey") % 11 > 0, F.col("o_orderkey")).alias("ssa"),
        F.col("o_orderstatus").alias("specialty"),
        F.floor("o_totalprice").cast("bigint").alias("required"),
        F.col("o_custkey").alias("ratio"),
    )
    return joins.full_join_coalesce(left, right, ["ssa", "specialty"], ["required", "ratio"])


@query("""
SELECT d.doc_id, d.lang, l.is_customized FROM documents d
LEFT JOIN (SELECT DISTINCT doc_id, upper(CASE toxic WHEN 1 THEN 'y' WHEN 0 THEN 'N' END) = 'Y' AS is_customized FROM labels) l
ON d.doc_id = l.doc_id
""")
def left_join_flag(t):
    from rosterflow.functions.text import is_yes_flag

    raw = F.when(F.col("toxic") == 1, "y").when(F.col("toxic") == 0, "N")
    lookup = t.labels.select("doc_id", is_yes_flag(raw).alias("is_customized"))
    return joins.left_join_flag(t.documents.select("doc_id", "lang"), lookup, ["doc_id"], "is_customized")


@query("""
SELECT o_orderkey, o_custkey, 'Invalid customer: ' || CAST(o_custkey AS VARCHAR) AS message FROM orders
WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal > 0)
""")
def membership_invalid(t):
    valid = t.customer.filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    marked = joins.mark_members(t.orders.select("o_orderkey", "o_custkey"), valid, ["o_custkey"], "known")
    return marked.filter(~F.col("known")).select(
        "o_orderkey", "o_custkey", F.format_string("Invalid customer: %d", "o_custkey").alias("message")
    )


@query("""
SELECT s_suppkey, lpad(CAST(s_nationkey AS VARCHAR), 3, '0') AS code FROM supplier
WHERE s_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 2)
""")
def membership_given(t):
    """Suppliers whose code is not in a set that the caller gives, here that of a region's few nations."""
    given = [str(r[0]) for r in t.nation.filter("n_regionkey = 2").select("n_nationkey").collect()]
    suppliers = t.supplier.select("s_suppkey", F.lpad(F.col("s_nationkey").cast("string"), 3, "0").alias("code"))
    return joins.non_members(suppliers, given_codes(t.spark, given, 3), ["code"])


@query("""
WITH codes AS (SELECT DISTINCT c_mktsegment AS code FROM customer WHERE c_mktsegment = 'NO SUCH SEGMENT'),
     valid AS (SELECT code FROM codes UNION ALL
               SELECT code FROM (VALUES ('1-URGENT'), ('2-HIGH')) f(code) WHERE NOT EXISTS (SELECT 1 FROM codes))
SELECT o_orderpriority, o_orderpriority IN (SELECT code FROM valid) AS ok, count(*) AS n
FROM orders GROUP BY ALL
""")
def membership_fallback(t):
    codes = t.customer.filter("c_mktsegment = 'NO SUCH SEGMENT'").select(F.col("c_mktsegment").alias("code")).distinct()
    valid = joins.codes_or_fallback(codes, constant_codes(t.spark, ["1-URGENT", "2-HIGH"]))
    marked = joins.mark_members(
        t.orders.select("o_orderpriority"),
        valid.select(F.col("code").alias("o_orderpriority")),
        ["o_orderpriority"],
        "ok",
    )
    return marked.groupBy("o_orderpriority", "ok").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def region_join(t):
    dimension = t.region.select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    return joins.attach(t.nation, dimension, ["n_regionkey"]).select("n_nationkey", "n_name", "r_name")


@query("""
SELECT DISTINCT p_type AS specialty_code, 'provider' AS category FROM part
UNION SELECT DISTINCT c_mktsegment, 'facility' FROM customer
""")
def distinct_union_category(t):
    return sets.union_distinct(
        [
            sets.labelled_distinct(t.part.select(F.col("p_type").alias("specialty_code")), ["specialty_code"], "category", "provider"),
            sets.labelled_distinct(
                t.customer.select(F.col("c_mktsegment").alias("specialty_code")), ["specialty_code"], "category", "facility"
            ),
        ]
    )


@query("""
SELECT CAST(n_nationkey AS BIGINT) AS k, CAST(n_regionkey AS DOUBLE) AS v FROM nation
UNION ALL SELECT s_suppkey, s_acctbal FROM supplier UNION ALL SELECT c_custkey, CAST(c_nationkey AS DOUBLE) FROM customer
""")
def union_all_widen(t):
    target = T.StructType.fromDDL("k bigint, v double")
    return sets.union_all_as(
        target,
        [
            t.nation.select(F.col("n_nationkey").alias("k"), F.col("n_regionkey").alias("v")),
            t.supplier.select(F.col("s_suppkey").alias("k"), F.col("s_acctbal").alias("v")),
            t.customer.select(F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("v")),
        ],
    )


_LINE_ORDER = "l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"


@query(f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus
FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINE_ORDER}) = 1
""")
def keep_first(t):
    first = dedupe.keep_first(t.lineitem, ["l_orderkey", "l_linenumber"], _LINE_ORDER.split(", "))
    return first.drop("l_shipdate")


@query("""
SELECT event_id, user_id, event_type, 'Duplicate row' AS message
FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) > 1
""")
def duplicate_warnings(t):
    rows = t.events.select("event_id", "user_id", "event_type")
    return dedupe.later_duplicates(rows, ["user_id", "event_type"], ["event_id"]).withColumn(
        "message", F.lit("Duplicate row")
    )


@query("""
SELECT o_custkey, o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'P'
UNION ALL
SELECT o_custkey, o_orderkey, o_orderstatus FROM orders s WHERE o_orderstatus = 'F'
AND NOT EXISTS (SELECT 1 FROM orders p WHERE p.o_orderstatus = 'P' AND p.o_custkey = s.o_custkey)
""")
def prefer_source_fallback(t):
    orders = t.orders.select("o_custkey", "o_orderkey", "o_orderstatus")
    return sets.prefer_source(
        orders.filter("o_orderstatus = 'P'"), orders.filter("o_orderstatus = 'F'"), ["o_custkey"]
    )


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def quality_key_uniqueness(t):
    return quality.repeated_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("""
SELECT 'doc_id' AS column_name, count(*) - count(doc_id) AS null_count FROM documents LEFT JOIN labels USING (doc_id)
UNION ALL SELECT 'quality', count(*) - count(quality) FROM documents LEFT JOIN labels USING (doc_id)
UNION ALL SELECT 'toxic', count(*) - count(toxic) FROM documents LEFT JOIN labels USING (doc_id)
""")
def quality_not_null(t):
    joined = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return quality.null_counts(joined, ["doc_id", "quality", "toxic"])


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus NOT IN ('F', 'O')")
def quality_domain(t):
    return quality.outside_domain(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus", ["F", "O"])
