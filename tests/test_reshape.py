import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from rosterflow import schemas as S
from rosterflow.operators import reshape
from rosterflow.plans import standards


def sheet(spark, sheets, year=2025, path="wb"):
    rows = [(path, year, name, i, cells) for name, body in sheets.items() for i, cells in enumerate(body)]
    return spark.createDataFrame(rows, S.SHEET_ROWS)


def ids(code, county="Autauga", ratio="0.5", total="100", kind="Large Metro"):
    return [county, "AL", f"{county}, AL", code, total, kind, ratio, "5"]


def td_ids(code, kind=" Rural "):
    return ["Autauga", "AL", "Autauga, AL", code, kind]


COUNTS = [
    ["title"],
    ["h"] * 11,
    [None] * 8 + [" 001 ", None, "040"],
    ids("01001") + ["3", "12.0", "7"],
    ids("01003", county="Baldwin", total="n/a") + ["x"],
    ids("01001", county="Again") + ["9", "9", "9"],
]
PAIRS = [
    ["title"],
    ["h"],
    [None] * 5 + ["001", None, " ", None, " 040", None, "odd"],
    [None] * 5 + ["Time", "Distance"] * 3,
    td_ids("01001") + ["10.9", "5", "1", "1", None, "n/a", "8"],
    td_ids("01003") + [None, "6", None, None, "20", None],
]
CON = [["SSA", "Specialty Code", "TD Customized (YN)"], ["01001", "001", "y"], ["01001", "001", "N"], ["01003", "001", None]]


def test_counts_keep_nulls_and_short_rows(spark):
    out = reshape.unpivot_counts(sheet(spark, {S.SHEET_MIN_PROVIDER: COUNTS}), S.SHEET_MIN_PROVIDER, "provider")
    assert rows_of(out, "row_idx", "specialty_code", "min_count") == sorted(
        [
            (3, "001", 3), (3, "9", None), (3, "040", 7),
            (4, "001", None), (4, "9", None), (4, "040", None),
            (5, "001", 9), (5, "9", 9), (5, "040", 9),
        ],
        key=str,
    )
    assert out.first().source_table == "provider" and out.first().source_year == 2025


def test_counts_of_a_sheet_without_specialties(spark):
    rows = sheet(spark, {S.SHEET_MIN_PROVIDER: [["t"], ["h"], [None] * 8, ids("01001")]})
    assert reshape.unpivot_counts(rows, S.SHEET_MIN_PROVIDER, "provider").isEmpty()


def test_pairs_skip_blank_codes_and_empty_pairs(spark):
    out = reshape.unpivot_pairs(sheet(spark, {S.SHEET_TD_PROVIDER: PAIRS}), S.SHEET_TD_PROVIDER, "provider")
    assert rows_of(out, "ssacd", "specialty_code", "max_time_minutes", "max_distance_miles") == [
        ("01001", "001", 10, 5),
        ("01003", "001", None, 6),
        ("01003", "040", 20, None),
    ]


@pytest.mark.parametrize("width", [0, 1, 5, 6])
def test_pairs_of_narrow_sheets(spark, width):
    rows = sheet(spark, {S.SHEET_TD_PROVIDER: [["x"] * width] * 6})
    assert reshape.unpivot_pairs(rows, S.SHEET_TD_PROVIDER, "provider").isEmpty()


def test_sheets_too_short_for_data(spark):
    rows = sheet(spark, {S.SHEET_MIN_PROVIDER: COUNTS[:3], S.SHEET_TD_PROVIDER: PAIRS[:4], S.SHEET_CON: CON[:1]})
    assert reshape.unpivot_counts(rows, S.SHEET_MIN_PROVIDER, "p").isEmpty()
    assert reshape.unpivot_pairs(rows, S.SHEET_TD_PROVIDER, "p").isEmpty()
    assert standards.con_rows(rows).isEmpty()


def test_counts_pivot_back_to_the_sheet(spark):
    rng = random.Random(5)
    codes = [f"{i:03d}" for i in range(1, 7)]
    body = {f"{i:05d}": [str(rng.randrange(100)) if rng.random() < 0.8 else None for _ in codes] for i in range(20)}
    grid = [["t"], ["h"], [None] * 8 + codes] + [ids(c) + v for c, v in body.items()]
    out = reshape.unpivot_counts(sheet(spark, {S.SHEET_MIN_PROVIDER: grid}), S.SHEET_MIN_PROVIDER, "provider")
    back = out.groupBy("ssacd").pivot("specialty_code", codes).agg(F.first("min_count"))
    assert {r[0]: [None if v is None else str(v) for v in r[1:]] for r in back.collect()} == body


def test_headers(spark):
    grid = [[" SSA  Code ", None, "###", "Name (x)"], ["a", "b", "c", "d"], ["e"]]
    rows = sheet(spark, {"s": grid})
    wide = reshape.promote_header(rows, "s").orderBy("row_idx")
    assert wide.columns == ["path", "row_idx", "ssa_code", "col_1", "col_2", "name_x", "source_year"]
    assert [tuple(r)[2:] for r in wide.collect()] == [("a", "b", "c", "d", 2025), ("e", None, None, None, 2025)]
    other = sheet(spark, {"s": [["x"], ["1"]]}, path="wb2")
    with pytest.raises(ValueError, match="disagree"):
        reshape.promote_header(rows.unionByName(other), "s")


def all_tables(spark, sheets, **options):
    return standards.standards_tables(sheet(spark, sheets, **options))


FULL = {
    S.SHEET_MIN_PROVIDER: COUNTS,
    S.SHEET_MIN_FACILITY: [["t"], ["h"], [None] * 8 + ["040", "041"], ids("01001", ratio="0.7") + ["12", "4"], ids("01005", ratio="x") + ["2", "5"]],
    S.SHEET_TD_PROVIDER: PAIRS,
    S.SHEET_TD_FACILITY: [["t"], ["h"], [None] * 5 + ["040"], [None] * 5 + ["Time", "Distance"], td_ids("01001") + ["30", "15"]],
    S.SHEET_CON: CON,
}


def test_five_tables(spark):
    tables = all_tables(spark, FULL)
    assert rows_of(tables["county"]) == [
        ("01001", 2025, "Autauga", "AL", "large_metro", 100, None),
        ("01003", 2025, "Baldwin", "AL", "large_metro", None, None),
    ]
    assert rows_of(tables["specialty_type"], "specialty_code", "category") == [
        ("001", "provider"), ("040", "facility"), ("040", "provider"), ("041", "facility"), ("9", "provider"),
    ]
    td = tables["time_distance_standard"]
    assert rows_of(td, "ssa_county_code", "specialty_code", "max_time_minutes", "is_customized") == [
        ("01001", "001", 10, False),
        ("01001", "001", 10, True),  # the pair carries both flags
        ("01001", "040", 30, None),
        ("01003", "001", None, None),
        ("01003", "040", 20, None),
    ]
    assert {r.pct_beneficiaries_required for r in td.collect()} == {90}
    minimum = rows_of(
        tables["minimum_number_standard"].filter("ssa_county_code in ('01001', '01005')"),
        "ssa_county_code", "specialty_code", "min_providers_required", "min_beds_required", "base_population_ratio_95th_pct",
    )
    assert minimum == sorted(
        [
            ("01001", "001", 3, None, 0.5), ("01001", "001", 9, None, 0.5),
            ("01001", "9", None, None, 0.5), ("01001", "9", 9, None, 0.5),
            ("01001", "040", 7, 12, 0.5), ("01001", "040", 9, 12, 0.5),
            ("01001", "041", None, None, 0.7), ("01005", "040", None, 2, None), ("01005", "041", None, None, None),
        ],
        key=lambda r: [(v is not None, str(v)) for v in r],
    )
    assert rows_of(tables["con_credit"]) == [("01001", "001", 2025), ("01003", "001", 2025)]
    for name, schema in [
        ("county", S.COUNTY), ("specialty_type", S.SPECIALTY_TYPE), ("time_distance_standard", S.TIME_DISTANCE_STANDARD),
        ("minimum_number_standard", S.MINIMUM_NUMBER_STANDARD), ("con_credit", S.CON_CREDIT),
    ]:
        assert [(f.name, f.dataType) for f in tables[name].schema] == [(f.name, f.dataType) for f in schema]


def test_facility_only_workbook(spark):
    tables = all_tables(spark, {S.SHEET_MIN_FACILITY: FULL[S.SHEET_MIN_FACILITY], S.SHEET_TD_FACILITY: FULL[S.SHEET_TD_FACILITY]})
    assert tables["county"].isEmpty() and tables["con_credit"].isEmpty()
    assert tables["minimum_number_standard"].count() == 4
    assert rows_of(tables["time_distance_standard"], "is_customized") == [(None,)]


def test_county_from_time_distance_per_workbook(spark):
    """A workbook without provider counts takes its counties from time and distance;
    the other keeps its counts sheet although years and widths differ."""
    first = sheet(spark, {S.SHEET_MIN_PROVIDER: COUNTS, S.SHEET_TD_PROVIDER: PAIRS}, path="a")
    second = sheet(spark, {S.SHEET_TD_PROVIDER: PAIRS}, year=2026, path="b")
    county = standards.county_table(first.unionByName(second))
    assert rows_of(county, "contract_year", "ssa_county_code", "county_type", "total_medicare_beneficiaries") == [
        (2025, "01001", "large_metro", 100),
        (2025, "01003", "large_metro", None),
        (2026, "01001", "rural", None),
        (2026, "01003", "rural", None),
    ]


def test_con_key_columns(spark):
    grid = [["State", "County SSA", "Specialty Code"], ["AL", "01001", "001"]]
    con = standards.con_rows(sheet(spark, {S.SHEET_CON: grid})).first()
    assert (con.lookup_ssa, con.credit_ssa, con.has_flag) == ("AL", "01001", False)
