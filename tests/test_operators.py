import os
import random
from collections import Counter

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from rosterflow import schemas as S
from rosterflow.operators import dedupe, joins, quality, sets, shape
from rosterflow.sources.codes import constant_codes, given_codes, specialty_codes, ssa_codes


def test_rename_by_position_drops_the_rest(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert shape.rename_by_position(df, ["x", "y"]).columns == ["x", "y"]
    assert shape.rename_by_position(df, ["x", "y", "z", "w"]).columns == ["x", "y", "z"]


def test_header_normalising_and_known_columns(spark):
    df = spark.createDataFrame([("1", "n", "x")], "` GEOID ` string, NAME string, `Extra  One` string")
    named = shape.normalise_header_columns(df)
    assert named.columns == ["geoid", "name", "extra_one"]
    assert shape.select_known(named, S.GAZETTEER_COLUMN_MAP).columns == ["geoid", "name"]


def test_conform_fills_orders_and_types(spark):
    df = spark.createDataFrame([("12", "x")], "b string, z string")
    out = shape.conform(df, S.table_schema("a double, b bigint"))
    assert out.dtypes == [("a", "double"), ("b", "bigint")] and rows_of(out) == [(None, 12)]
    assert shape.empty_table(df, S.COUNTY).count() == 0


def test_strip_skips_and_resolves(spark):
    df = spark.createDataFrame([(" a ", " b ", 1)], "x string, y string, n int")
    assert rows_of(shape.strip_strings(df, ["y"])) == [("a", " b ", 1)]
    assert shape.resolve_column(["geoid"], "GEOID") == "geoid" and shape.resolve_column(["x"], "GEOID") is None


def test_ids(spark):
    df = spark.range(100).select(shape.random_id().alias("r"), shape.stable_id(F.lit("f"), F.col("id")).alias("s"))
    assert df.agg(F.countDistinct("r"), F.countDistinct("s")).first() == (100, 100)
    assert rows_of(df, "s") == rows_of(df, "s")


def test_membership_keeps_every_row(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,), ("a",)], "k string")
    valid = spark.createDataFrame([("a",), ("a",), ("c",)], "k string")
    assert rows_of(joins.mark_members(df, valid, ["k"], "ok")) == [(None, False), ("a", True), ("a", True), ("b", False)]
    assert rows_of(joins.non_members(df, valid, ["k"])) == [(None,), ("b",)]


def test_fallback_only_when_empty(spark):
    fixed = constant_codes(spark, ["040", "041"])
    codes = spark.createDataFrame([("001",)], "code string")
    assert rows_of(joins.codes_or_fallback(codes, fixed)) == [("001",)]
    assert rows_of(joins.codes_or_fallback(codes.limit(0), fixed)) == [("040",), ("041",)]


def test_code_sets(spark):
    county = spark.createDataFrame([("1001 ", 2024), ("01001", 2024), (None, 2024), ("2", 2023)], "ssa_county_code string, contract_year int")
    assert rows_of(ssa_codes(county, [2024])) == [(2024, "01001")]
    kinds = spark.createDataFrame([("001", 2025, "provider"), ("040", 2025, "facility")], "specialty_code string, contract_year int, category string")
    assert rows_of(specialty_codes(kinds, "facility")) == [(2025, "040")]
    assert rows_of(given_codes(spark, {"1", "ABC", "040"}, 3)) == [("001",), ("040",), ("ABC",)]


def test_left_join_flag_is_null_and_fans_out(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    lookup = spark.createDataFrame([(1, True), (1, True), (2, True), (2, False)], "k int, flag boolean")
    assert rows_of(joins.left_join_flag(df, lookup, ["k"], "flag")) == [(1, True), (2, False), (2, True), (3, None)]


def brute_full_join(left, right):
    out, matched = [], set()
    for lk, lv in left:
        hits = [i for i, (rk, _) in enumerate(right) if lk is not None and rk == lk]
        matched |= set(hits)
        out += [(lk, lv if lv is not None else right[i][1]) for i in hits] or [(lk, lv)]
    return Counter(out + [r for i, r in enumerate(right) if i not in matched])


@pytest.mark.parametrize("hot_key_rows", [1_000_000, 5])
def test_full_join_against_brute_force(spark, hot_key_rows):
    """Hot on both sides (0), on one side (1, 2), null keys, and fan-out."""
    rng = random.Random(7)
    keys_l = [0] * 12 + [1] * 9 + [rng.randrange(3, 30) for _ in range(40)] + [None] * 3
    keys_r = [0] * 8 + [2] * 9 + [rng.randrange(3, 40) for _ in range(40)] + [None] * 2
    left = [(k, rng.choice([None, i])) for i, k in enumerate(keys_l)]
    right = [(k, rng.choice([None, 1000 + i])) for i, k in enumerate(keys_r)]
    out = joins.full_join_coalesce(
        spark.createDataFrame(left, "k int, v int"), spark.createDataFrame(right, "k int, v int"), ["k"], ["v"], hot_key_rows
    )
    assert Counter(tuple(r) for r in out.collect()) == brute_full_join(left, right)


def test_full_join_one_side_empty(spark):
    left = spark.createDataFrame([(1, 2)], "k int, v int")
    assert rows_of(joins.full_join_coalesce(left, left.limit(0), ["k"], ["v"])) == [(1, 2)]
    assert rows_of(joins.full_join_coalesce(left.limit(0), left, ["k"], ["v"])) == [(1, 2)]


def test_small_side_marks_only_bounded_frames(spark):
    df = spark.range(1000).join(spark.range(1000).withColumnRenamed("id", "j"), F.expr("id = j"))

    def marked(side):
        return "broadcast" in side._jdf.queryExecution().logical().toString().lower()

    assert marked(joins.small_side(df))
    assert not marked(joins.small_side(df, max_rows=999))
    assert not marked(joins.small_side(df, max_bytes=100))


def test_keep_first_and_latest(spark):
    df = spark.createDataFrame([("a", 2, "y"), ("a", 1, "x"), (None, 5, "n"), (None, 4, "m")], "k string, i int, v string")
    assert rows_of(dedupe.keep_first(df, ["k"], ["i"])) == [(None, 4, "m"), ("a", 1, "x")]
    assert rows_of(dedupe.latest_by(df, ["k"], ["i"])) == [(None, 5, "n"), ("a", 2, "y")]


def test_later_duplicates_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice(["hot", "hot", None, "a", "b"]), rng.randrange(3)) for i in range(200)]
    seen, expected = set(), []
    for row in rows:
        if row[1:] in seen:
            expected.append(row)
        seen.add(row[1:])
    out = dedupe.later_duplicates(spark.createDataFrame(rows, "i int, k string, m int").repartition(7), ["k", "m"], ["i"])
    assert sorted(tuple(r) for r in out.collect()) == expected


def test_prefer_source_is_per_group(spark):
    first = spark.createDataFrame([("w1", 1)], "path string, v int")
    second = spark.createDataFrame([("w1", 9), ("w2", 8)], "path string, v int")
    assert rows_of(sets.prefer_source(first, second, ["path"])) == [("w1", 1), ("w2", 8)]


def test_unions(spark):
    a, b = spark.createDataFrame([(1,), (1,)], "v int"), spark.createDataFrame([(1.5,)], "v double")
    assert rows_of(sets.union_all_as(S.table_schema("v double"), [a, b])) == [(1.0,), (1.0,), (1.5,)]
    assert rows_of(sets.union_distinct([a, a])) == [(1,)]
    assert rows_of(sets.labelled_distinct(a, ["v"], "c", "x")) == [(1, "x")]
    assert sets.missing_columns(["a"], ["b", "a", "c"]) == ["b", "c"]


def test_quality_reports(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 3)], "k string, v int")
    assert rows_of(quality.repeated_keys(df, ["k"])) == [("a", 2)]
    assert rows_of(quality.null_counts(df, ["k", "v"])) == [("k", 0), ("v", 1)]
    assert rows_of(quality.outside_domain(df, "k", ["a"])) == [("b", 3)]


def test_declared_checks(spark):
    county = spark.createDataFrame([("1", 2025), ("1", 2025), (None, 2025)], "ssa_county_code string, contract_year int")
    found = {(r.rule, r.subject): r.violations for r in quality.declared_checks(county, "county").collect()}
    assert found == {("not null", "ssa_county_code"): 1, ("not null", "contract_year"): 0, ("key", "ssa_county_code, contract_year"): 1}
    files = spark.createDataFrame([("a", "PROVIDER", "PENDING"), ("b", "X", None)], "id string, file_type string, status string")
    found = {(r.rule, r.subject): r.violations for r in quality.declared_checks(files, "org_files").collect()}
    assert found[("domain", "file_type")] == 1 and found[("domain", "status")] == 0 and found[("not null", "status")] == 1
    assert quality.declared_checks(files.selectExpr("id as npi"), "provider_hsd").count() == 1
