"""Unpivots and sheet rows."""

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow import schemas as S
from rosterflow.operators import reshape
from rosterflow.queries.registry import query


def sheet_frame(paths: DataFrame, sheet: str, heads: list[list[str | None]], data: DataFrame) -> DataFrame:
    """Sheet rows: the head rows once per workbook path, then the data rows.

    ``paths`` has ``path, source_year``; ``data`` has ``path, source_year, row_idx, cells``."""
    text = json.dumps([{"row_idx": i, "cells": cells} for i, cells in enumerate(heads)])
    head = F.from_json(F.lit(text), "array<struct<row_idx:bigint,cells:array<string>>>")
    top = paths.select("path", "source_year", F.explode(head).alias("h")).select("path", "source_year", "h.*")
    columns = ["path", "source_year", "sheet", "row_idx", "cells"]
    return (
        top.unionByName(data.select("path", "source_year", "row_idx", "cells"))
        .withColumn("sheet", F.lit(sheet))
        .select(columns)
    )


@query("""
WITH w AS (SELECT l_orderkey, count(*) AS lines, CAST(sum(l_quantity) AS BIGINT) AS quantity,
                  max(CASE WHEN l_returnflag = 'R' THEN l_linenumber END)::BIGINT AS returned,
                  min(CASE WHEN l_linestatus = 'F' THEN l_suppkey END) AS first_supplier
           FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, 'lines' AS measure, lines AS amount FROM w UNION ALL SELECT l_orderkey, 'quantity', quantity FROM w
UNION ALL SELECT l_orderkey, 'returned', returned FROM w UNION ALL SELECT l_orderkey, 'first_supplier', first_supplier FROM w
""")
def unpivot_measures(t):
    wide = t.lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum("l_quantity").cast("bigint").alias("quantity"),
        F.max(F.when(F.col("l_returnflag") == "R", F.col("l_linenumber"))).cast("bigint").alias("returned"),
        F.min(F.when(F.col("l_linestatus") == "F", F.col("l_suppkey"))).alias("first_supplier"),
    )
    return wide.unpivot("l_orderkey", ["lines", "quantity", "returned", "first_supplier"], "measure", "amount")


@query("""
WITH cells AS (
    SELECT p_brand, CAST(p_partkey AS VARCHAR) AS ssacd, p_type,
           CASE p_partkey % 3 WHEN 0 THEN CAST(p_size AS VARCHAR) || '.9' WHEN 1 THEN ' ' END AS t1,
           CASE WHEN p_partkey % 4 > 0 THEN CAST(p_size + 10 AS VARCHAR) END AS d1,
           CASE WHEN p_partkey % 5 = 0 THEN 'n/a' ELSE CAST(p_partkey AS VARCHAR) END AS t2,
           CASE WHEN p_partkey % 7 = 0 THEN '3' END AS d2 FROM part),
long AS (SELECT p_brand AS path, ssacd, p_type AS county_designation, '001' AS specialty_code, TRY_CAST(t1 AS DOUBLE) AS t, TRY_CAST(d1 AS DOUBLE) AS d FROM cells
         UNION ALL SELECT p_brand, ssacd, p_type, '040', TRY_CAST(t2 AS DOUBLE), TRY_CAST(d2 AS DOUBLE) FROM cells)
SELECT path, ssacd, county_designation, specialty_code, CAST(trunc(t) AS BIGINT) AS max_time_minutes,
       CAST(trunc(d) AS BIGINT) AS max_distance_miles FROM long WHERE t IS NOT NULL OR d IS NOT NULL
""")
def unpivot_pairs(t):
    size, key = F.col("p_size"), F.col("p_partkey")
    data = t.part.select(
        F.col("p_brand").alias("path"),
        F.lit(2025).alias("source_year"),
        (key + 4).alias("row_idx"),
        F.array(
            F.col("p_name"),
            F.lit("AL"),
            F.lit(None),
            key.cast("string"),
            F.col("p_type"),
            F.when(key % 3 == 0, F.concat(size.cast("string"), F.lit(".9"))).when(key % 3 == 1, F.lit(" ")),
            F.when(key % 4 > 0, (size + 10).cast("string")),
            F.when(key % 5 == 0, F.lit("n/a")).otherwise(key.cast("string")),
            F.when(key % 7 == 0, F.lit("3")),
            F.lit("5"),  # a pair without a code
            F.lit("6"),
            F.lit("odd last column"),
        ).alias("cells"),
    )
    paths = data.select("path", "source_year").distinct()
    blank = [None] * 5
    heads = [["title"], blank + ["PCP", None, "Acute"], blank + [" 001", None, "040 ", None, " "], blank + ["Time", "Distance"]]
    rows = sheet_frame(paths, S.SHEET_TD_PROVIDER, heads, data)
    return reshape.unpivot_pairs(rows, S.SHEET_TD_PROVIDER, "provider").select(
        "path", "ssacd", "county_designation", "specialty_code", "max_time_minutes", "max_distance_miles"
    )


@query("""
WITH s AS (SELECT 'nation ' || CAST(s_nationkey AS VARCHAR) AS path, CAST(s_suppkey AS VARCHAR) AS ssacd, s_name AS county,
                  CASE WHEN s_suppkey % 3 > 0 THEN s_suppkey END AS v1, CASE WHEN s_suppkey % 2 = 0 THEN s_suppkey * 2 END AS v2
           FROM supplier)
SELECT path, ssacd, county, '001' AS specialty_code, v1 AS min_count FROM s
UNION ALL SELECT path, ssacd, county, '9', NULL FROM s
UNION ALL SELECT path, ssacd, county, '040', v2 FROM s
UNION ALL SELECT path, ssacd, county, '11', NULL FROM s
""")
def header_code_rows(t):
    key = F.col("s_suppkey")
    path = F.concat(F.lit("nation "), F.col("s_nationkey").cast("string"))
    data = t.supplier.select(
        path.alias("path"),
        F.lit(2025).alias("source_year"),
        (key + 3).alias("row_idx"),
        F.array(
            F.col("s_name"),
            *[F.lit(None)] * 2,
            key.cast("string"),
            *[F.lit(None)] * 4,
            F.when(key % 3 > 0, key.cast("string")),
            F.concat(key.cast("string"), F.lit(".0")),  # whole-number cast leaves it null
            F.when(key % 2 == 0, (key * 2).cast("string")),
        ).alias("cells"),
    )
    paths = data.select("path", "source_year").distinct()
    # The header row is one cell wider than the data, which short rows fill with null.
    heads = [["title"], ["h"] * 12, [None] * 8 + [" 001", None, "040", ""]]
    rows = sheet_frame(paths, S.SHEET_MIN_PROVIDER, heads, data)
    return reshape.unpivot_counts(rows, S.SHEET_MIN_PROVIDER, "provider").select(
        "path", "ssacd", "county", "specialty_code", "min_count"
    )
