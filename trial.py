"""Time the heavy operators on generated submission rows, a third of them under one key and in one file.

``TRIAL_ROWS`` (10 million) and ``TRIAL_CPUS`` (8) set the size; one JSON line is printed.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow import schemas as S
from rosterflow.operators.dedupe import keep_first
from rosterflow.operators.joins import full_join_coalesce
from rosterflow.operators.validate import duplicate_issues, row_issues
from rosterflow.session import local_session, materialise
from rosterflow.streaming.status import latest_status


def submissions(spark: SparkSession, rows: int) -> DataFrame:
    i = F.col("id")
    hot = i % 3 == 0
    values = {
        "ssa_state_county_code": F.when(hot, "01001").otherwise(F.lpad((i % 3000).cast("string"), 5, "0")),
        "npi": F.lpad(F.when(hot, i % 1000).otherwise(i).cast("string"), 10, "1"),
        "specialty_code": F.lpad((i % 60).cast("string"), 3, "0"),
        "provider_street_address": F.concat(F.lit("12 Main St, Apt "), i.cast("string")),
    }
    columns = [values.get(c, F.lit(None).cast("string")).alias(c) for c in S.PROVIDER_COLUMNS]
    file = F.when(hot, "hot.csv").otherwise(F.concat(F.lit("f"), (i % 50).cast("string")))
    return spark.range(rows).select(*columns, file.alias("source_file"), i.alias("row_index"), F.lit(2025).alias("source_year"))


def seconds(df: DataFrame) -> float:
    start = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 1)


def main() -> None:
    rows, cpus = int(os.environ.get("TRIAL_ROWS", "10000000")), os.environ.get("TRIAL_CPUS", "8")
    spark = local_session(cpus, "rosterflow-trial", "32")
    spark.sparkContext.setLogLevel("ERROR")
    frame = materialise(submissions(spark, rows), "trial")
    codes = spark.range(3000).select(F.lit(2024).alias("contract_year"), F.lpad(F.col("id").cast("string"), 5, "0").alias("code"))
    special = spark.range(1, 30).select(F.lit(2025).alias("contract_year"), F.lpad(F.col("id").cast("string"), 3, "0").alias("code"))
    half = frame.filter("row_index % 2 = 0")
    log = frame.select(
        F.col("npi").alias("file_id"),
        F.when(F.col("row_index") % 5 == 0, "COMPLETED").otherwise("PROCESSING").alias("status"),
        F.lit(None).cast("string").alias("error_message"),
        F.timestamp_seconds("row_index").alias("updated_at"),
        F.lit(1).cast("bigint").alias("batch_id"),
        F.col("row_index").alias("seq"),
    )
    keys = ["source_file", "npi"]
    steps = {
        "row_checks": lambda: row_issues(frame, "provider", codes, special),
        "duplicates": lambda: duplicate_issues(frame),
        "first_row_per_key": lambda: keep_first(frame, ["ssa_state_county_code"], ["row_index"]),
        "full_outer_join": lambda: full_join_coalesce(frame, half.dropDuplicates(keys), keys, ["specialty_code"]),
        "latest_status": lambda: latest_status(log),
    }
    print(json.dumps({"rows": rows, "cpus": cpus, "seconds": {name: min(seconds(step()) for _ in range(2)) for name, step in steps.items()}}))


if __name__ == "__main__":
    main()
