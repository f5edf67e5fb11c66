"""The five standards tables, from the sheet rows of any number of workbooks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow import schemas as S
from rosterflow.functions import numbers, text
from rosterflow.operators.dedupe import keep_first
from rosterflow.operators.joins import full_join_coalesce, left_join_flag
from rosterflow.operators.reshape import (
    COUNT_FIRST_DATA_ROW,
    PAIR_FIRST_DATA_ROW,
    cell,
    named_cell,
    rows_with_layout,
    rows_with_names,
    sheet_layout,
    unpivot_counts,
    unpivot_pairs,
)
from rosterflow.operators.sets import prefer_source, union_all_as, union_distinct
from rosterflow.operators.shape import conform
from rosterflow.session import materialise


def min_counts(rows: DataFrame, category: str, layout: DataFrame | None = None) -> DataFrame:
    sheet = S.SHEET_MIN_PROVIDER if category == "provider" else S.SHEET_MIN_FACILITY
    return unpivot_counts(rows, sheet, category, layout)


def time_distances(rows: DataFrame, category: str, layout: DataFrame | None = None) -> DataFrame:
    sheet = S.SHEET_TD_PROVIDER if category == "provider" else S.SHEET_TD_FACILITY
    return unpivot_pairs(rows, sheet, category, layout)


def con_rows(rows: DataFrame, layout: DataFrame | None = None) -> DataFrame:
    """Certificate-of-need rows with the county code under both lookups.

    The time-distance lookup reads ``ssa`` or else the first column; the credit
    table reads ``ssa``, else the first header that contains it, else the first
    column. ``has_flag`` tells whether the sheet carries the customised flag.
    """
    first_with_ssa = F.array_position(F.transform("names", lambda n: n.contains("ssa")), True).cast("int")
    has_ssa = F.array_contains("names", "ssa")
    return rows_with_names(rows, S.SHEET_CON, layout).select(
        "path",
        F.col("source_year").alias("contract_year"),
        F.when(has_ssa, named_cell("ssa")).otherwise(cell(0)).alias("lookup_ssa"),
        F.when(has_ssa, named_cell("ssa"))
        .when(first_with_ssa > 0, F.get("cells", first_with_ssa - 1))
        .otherwise(cell(0))
        .alias("credit_ssa"),
        named_cell("specialty_code").alias("specialty_code"),
        F.array_contains("names", "td_customized_yn").alias("has_flag"),
        named_cell("td_customized_yn").alias("td_customized_yn"),
    )


def _count_sheet_counties(rows: DataFrame, layout: DataFrame | None) -> DataFrame:
    """County rows of the provider counts sheets. Dedupe happens on the wide rows,
    before any unpivot; a sheet without a specialty column defines none."""
    return (
        rows_with_layout(rows, S.SHEET_MIN_PROVIDER, COUNT_FIRST_DATA_ROW, layout)
        .filter(F.col("width") > len(S.MIN_COUNT_ID_COLUMNS))
        .select("path", "source_year", "row_idx", *[cell(i).alias(n) for i, n in enumerate(S.MIN_COUNT_ID_COLUMNS)])
    )


def _pair_sheet_counties(rows: DataFrame, layout: DataFrame | None) -> DataFrame:
    """County rows of the provider time-distance sheets that have a usable pair."""
    start = len(S.TIME_DISTANCE_ID_COLUMNS)
    pairs = F.floor((F.col("width") - start) / 2).cast("int")
    positions = F.when(pairs > 0, F.sequence(F.lit(0), pairs - 1)).otherwise(F.array().cast("array<int>"))

    def usable(p):
        at = F.lit(start) + 2 * p
        return (text.strip_or_blank(F.get("codes", at)) != "") & F.coalesce(
            numbers.truncated_long(cell(at)), numbers.truncated_long(cell(at + 1))
        ).isNotNull()

    return (
        rows_with_layout(rows, S.SHEET_TD_PROVIDER, PAIR_FIRST_DATA_ROW, layout)
        .filter(F.exists(positions, usable))
        .select(
            "path",
            "source_year",
            "row_idx",
            *[
                (cell(S.TIME_DISTANCE_ID_COLUMNS.index(n)) if n in S.TIME_DISTANCE_ID_COLUMNS else F.lit(None).cast("string")).alias(n)
                for n in S.MIN_COUNT_ID_COLUMNS
            ],
        )
    )


def county_table(rows: DataFrame, layout: DataFrame | None = None) -> DataFrame:
    """One row per county and year of a workbook: first provider-counts row, or first
    time-distance row where the workbook has no provider counts."""
    base = prefer_source(_count_sheet_counties(rows, layout), _pair_sheet_counties(rows, layout), ["path"])
    first = keep_first(base, ["path", "ssacd", "source_year"], ["row_idx"])
    return conform(
        first.select(
            F.col("ssacd").alias("ssa_county_code"),
            F.col("source_year").alias("contract_year"),
            F.col("county").alias("county_name"),
            F.col("st").alias("state_code"),
            text.snake_case(F.col("county_designation")).alias("county_type"),
            numbers.to_long(F.col("total_beneficiaries")).alias("total_medicare_beneficiaries"),
        ),
        S.COUNTY,
    )


def specialty_table(provider_counts: DataFrame, facility_counts: DataFrame) -> DataFrame:
    """Distinct specialty codes per category and year."""
    parts = [
        counts.select("specialty_code", F.lit(category).alias("category"), F.col("source_year").alias("contract_year"))
        for category, counts in (("provider", provider_counts), ("facility", facility_counts))
    ]
    return conform(union_distinct(parts), S.SPECIALTY_TYPE)


_TD_WITH_PATH = S.table_schema(
    "path string, ssacd string, specialty_code string, source_year int, max_time_minutes bigint, max_distance_miles bigint"
)


def time_distance_table(provider_td: DataFrame, facility_td: DataFrame, con: DataFrame) -> DataFrame:
    """All time and distance standards, with the customised flag of the workbook's
    certificate-of-need sheet."""
    td = union_all_as(_TD_WITH_PATH, [provider_td, facility_td]).withColumnsRenamed(
        {"ssacd": "ssa_county_code", "source_year": "contract_year"}
    )
    lookup = con.filter("has_flag").select(
        "path",
        F.col("lookup_ssa").alias("ssa_county_code"),
        "specialty_code",
        text.is_yes_flag(F.col("td_customized_yn")).alias("is_customized"),
    )
    flagged = left_join_flag(td, lookup, ["path", "ssa_county_code", "specialty_code"], "is_customized")
    return conform(
        flagged.withColumn("pct_beneficiaries_required", F.lit(S.PCT_BENEFICIARIES_REQUIRED)), S.TIME_DISTANCE_STANDARD
    )


def _minimums(counts: DataFrame, providers, beds) -> DataFrame:
    return counts.select(
        "path",
        F.col("ssacd").alias("ssa_county_code"),
        "specialty_code",
        F.col("source_year").alias("contract_year"),
        providers.cast("bigint").alias("min_providers_required"),
        beds.cast("bigint").alias("min_beds_required"),
        F.lit(None).cast("double").alias("provider_ratio"),
        numbers.to_double(F.col("pct_95_base_population_ratio")).alias("base_population_ratio_95th_pct"),
    )


def minimum_number_table(provider_counts: DataFrame, facility_counts: DataFrame) -> DataFrame:
    """Provider minimums full-joined with facility rows; a facility count is a bed
    minimum for acute inpatient hospitals and dropped for other specialties."""
    nothing = F.lit(None)
    beds = F.when(F.col("specialty_code") == S.ACUTE_INPATIENT_CODE, F.col("min_count"))
    joined = full_join_coalesce(
        _minimums(provider_counts, F.col("min_count"), nothing),
        _minimums(facility_counts, nothing, beds),
        ["path", "ssa_county_code", "specialty_code", "contract_year"],
        ["min_providers_required", "min_beds_required", "provider_ratio", "base_population_ratio_95th_pct"],
    )
    return conform(joined, S.MINIMUM_NUMBER_STANDARD)


def con_credit_table(con: DataFrame) -> DataFrame:
    return con.select(F.col("credit_ssa").alias("ssa_county_code"), "specialty_code", "contract_year").distinct()


def standards_tables(rows: DataFrame) -> dict[str, DataFrame]:
    """All five tables; sheets are found by name and may be absent. Pass a staged
    ``rows`` table, since every builder scans its sheets; the layouts are staged here."""
    layout = materialise(sheet_layout(rows), "sheet-layouts")
    providers, facilities = min_counts(rows, "provider", layout), min_counts(rows, "facility", layout)
    con = con_rows(rows, layout)
    return {
        "county": county_table(rows, layout),
        "specialty_type": specialty_table(providers, facilities),
        "time_distance_standard": time_distance_table(
            time_distances(rows, "provider", layout), time_distances(rows, "facility", layout), con
        ),
        "minimum_number_standard": minimum_number_table(providers, facilities),
        "con_credit": con_credit_table(con),
    }
