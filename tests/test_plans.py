"""Physical plans: what shuffles, what is broadcast, what is split."""

import contextlib
import re

import pytest
from pyspark.sql import functions as F
from test_reshape import FULL, sheet
from test_validate import GOOD_PROVIDER, PROVIDER, SSA, frame

from rosterflow import schemas as S
from rosterflow.operators import dedupe, joins, reshape, validate
from rosterflow.queries.registry import Tables
from rosterflow.session import materialise
from rosterflow.sources.codes import given_codes

SMALL = "/root/testdata/sf0.01"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """Plan after adaptive execution, from the frame that was executed."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@contextlib.contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k in names:
            spark.conf.unset(k)


@pytest.mark.parametrize("unpivot, name", [(reshape.unpivot_counts, S.SHEET_MIN_PROVIDER), (reshape.unpivot_pairs, S.SHEET_TD_PROVIDER)])
def test_unpivot_never_shuffles_data_rows(spark, unpivot, name):
    text = plan(unpivot(materialise(sheet(spark, FULL), "t", ("sheet",)), name, "provider"))
    data_side = text.split("BroadcastExchange")[0]
    assert "BroadcastHashJoin" in data_side and "Exchange hashpartitioning" not in data_side
    assert "PartitionFilters: [isnotnull(sheet" in text


def test_row_checks_are_one_scan_without_a_shuffle(spark):
    rows = materialise(frame(spark, GOOD_PROVIDER, {}, {"npi": "1"}), "t")
    text = plan(validate.row_issues(rows, "provider", given_codes(spark, SSA, 5), given_codes(spark, PROVIDER, 3)))
    data_side = re.split(r"BroadcastExchange", text)[0]
    assert text.count("FileScan") == 1 and "Exchange hashpartitioning" not in data_side
    assert text.count("BroadcastHashJoin") == 2 and "Python" not in text


def test_yearly_codes_are_one_hash_join_each(spark):
    """Also where the year of all rows is a literal, as in a load of one year."""
    rows = materialise(frame(spark, GOOD_PROVIDER, {}, {"npi": "1"}).drop("source_year"), "t").withColumn("source_year", F.lit(2025))
    codes = [spark.createDataFrame([(y, c) for c in values], "contract_year int, code string") for y, values in ((2024, SSA), (2025, PROVIDER))]
    text = plan(validate.row_issues(rows, "provider", *codes))
    assert "NestedLoop" not in text and "Cartesian" not in text
    checked = text.split("BroadcastExchange")[0]
    assert checked.count("FileScan") <= 1 and "Exchange hashpartitioning" not in checked


def test_keep_first_limits_before_the_shuffle(spark):
    t = Tables(spark, SMALL)
    text = plan(dedupe.keep_first(t.lineitem, ["l_orderkey"], ["l_linenumber"]))
    assert re.search(r"Exchange.*\n.*WindowGroupLimit.*Partial", text)


def test_only_needed_columns_are_read(spark):
    t = Tables(spark, SMALL)
    valid = t.customer.filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    text = plan(joins.mark_members(t.orders.select("o_orderkey", "o_custkey"), valid, ["o_custkey"], "ok"))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in text
    assert "PushedFilters: [IsNotNull(c_acctbal), GreaterThan(c_acctbal,0.0)" in text


def skewed(spark, n=40000):
    """A third of the rows under one key."""
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    return spark.range(0, n, 1, 8).select(key.alias("k"), F.col("id").alias("i"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))


SKEW = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.5",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "20KB",
}


def test_heavy_key_is_split_in_duplicates(spark, monkeypatch):
    monkeypatch.setattr(dedupe, "small_side", lambda df: df)  # too many repeated keys to broadcast
    with settings(spark, **SKEW):
        out = dedupe.later_duplicates(skewed(spark), ["k"], ["i"])
        assert "skew=true" in final_plan(out)
    assert out.count() == len(range(0, 40000, 3)) - 1


def test_rows_do_not_shuffle_when_few_keys_repeat(spark):
    out = dedupe.later_duplicates(skewed(spark), ["k"], ["i"])
    text = final_plan(out)
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


def test_heavy_key_is_split_in_membership(spark, monkeypatch):
    monkeypatch.setattr(joins, "small_side", lambda df: df)  # a valid set too large to broadcast
    with settings(spark, **SKEW):
        valid = spark.range(100000).select(F.col("id").alias("k"))
        out = joins.mark_members(skewed(spark), valid, ["k"], "ok")
        assert "skew=true" in final_plan(out)
    assert out.filter("ok").count() == 40000


def test_heavy_key_is_split_in_full_join(spark):
    with settings(spark, **SKEW):
        left, right = skewed(spark), spark.range(0, 30000, 1, 8).select(F.col("id").alias("k"), F.col("id").alias("i"), F.lit("r").alias("pad"))
        out = joins.full_join_coalesce(left, right, ["k"], ["i", "pad"], hot_key_rows=1000)
        text = final_plan(out)
        assert "skew=true" in text
        assert out.count() == 40000 + (30000 - 1 - len([i for i in range(1, 30000) if i % 3]))
