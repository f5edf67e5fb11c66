import pytest
from conftest import rows_of

from rosterflow import schemas as S
from rosterflow.operators import validate as V
from rosterflow.sources.codes import given_codes, specialty_codes

SSA, PROVIDER, FACILITY = {"01001", "1003", "01010"}, {"001", "3", "006"}, {"040", "041", "053"}

GOOD_PROVIDER = dict(
    ssa_state_county_code="01001",
    name_of_physician_or_mid_level_practitioner="Jane Doe",
    npi="1234567890",
    specialty="Primary Care",
    specialty_code="001",
    provider_street_address="100 Main St",
    provider_city="Boston",
    provider_state="MA",
    provider_zip_code="02101",
    letter_of_intent="",
    accuracy_confidence=None,
)
GOOD_FACILITY = dict(
    ssa_state_county_code="01001",
    facility_name="City Hospital",
    npi="1122334455",
    specialty="Acute Inpatient Hospitals",
    specialty_code="040",
    facility_street_address="500 Hospital Dr",
    facility_city="Boston",
    facility_state="MA",
    facility_zip_code="02102",
    number_of_beds="200",
    letter_of_intent="",
)


def frame(spark, good, *changes, file="f"):
    rows = [{"source_file": file, **good, **c} for c in changes]
    schema = ", ".join(f"{c} string" for c in good) + ", source_file string, row_index bigint, source_year int"
    return spark.createDataFrame(
        [(*[r[c] for c in good], r["source_file"], i, 2025) for i, r in enumerate(rows, 1)], schema
    )


def issues(spark, kind, df, **options):
    codes = PROVIDER if kind == "provider" else FACILITY
    out = V.validate(df, kind, given_codes(spark, SSA, 5), given_codes(spark, codes, 3), **options)
    return rows_of(out, "row_index", "severity", "field", "message")


def test_valid_rows_pass(spark):
    good = frame(spark, GOOD_PROVIDER, {}, {"ssa_state_county_code": " 1003", "npi": "0987654321", "specialty_code": "3"})
    assert issues(spark, "provider", good) == []
    assert issues(spark, "facility", frame(spark, GOOD_FACILITY, {}, {"specialty_code": "053", "npi": "5544332211", "number_of_beds": None})) == []


def test_missing_columns_stop_other_checks(spark):
    df = frame(spark, GOOD_PROVIDER, {"npi": "1"}).drop("provider_city", "provider_state")
    assert issues(spark, "provider", df) == [(0, "error", "schema", "Missing required columns: provider_city, provider_state")]


def test_empty_frame_is_valid(spark):
    assert issues(spark, "provider", frame(spark, GOOD_PROVIDER, {}).limit(0)) == []


@pytest.mark.parametrize(
    "change, field, message",
    [
        ({"npi": "123"}, "npi", S.MSG_NPI),
        ({"npi": None}, "npi", S.MSG_NPI),
        ({"ssa_state_county_code": "99999"}, "ssa_state_county_code", S.MSG_SSA + "99999"),
        ({"ssa_state_county_code": None}, "ssa_state_county_code", S.MSG_SSA + "None"),
        ({"ssa_state_county_code": "0A001"}, "ssa_state_county_code", S.MSG_SSA + "0A001"),
        ({"specialty_code": "7"}, "specialty_code", S.MSG_SPECIALTY["provider"] + "7"),
        ({"specialty_code": None}, "specialty_code", S.MSG_SPECIALTY["provider"] + "None"),
        ({"provider_street_address": "P.O. Box 123"}, "provider_street_address", S.MSG_ADDRESS_PO_BOX),
        ({"provider_street_address": "  "}, "provider_street_address", S.MSG_ADDRESS_BLANK),
        ({"provider_street_address": None}, "provider_street_address", S.MSG_ADDRESS_BLANK),
        ({"letter_of_intent": "Y"}, "letter_of_intent", S.MSG_LOI),
        ({"accuracy_confidence": "certain"}, "accuracy_confidence", S.MSG_ACCURACY),
    ],
)
def test_provider_errors(spark, change, field, message):
    assert issues(spark, "provider", frame(spark, GOOD_PROVIDER, change)) == [(1, "error", field, message)]


def test_letter_of_intent_is_free_for_applicants(spark):
    assert issues(spark, "provider", frame(spark, GOOD_PROVIDER, {"letter_of_intent": "Y"}), applicant=True) == []


@pytest.mark.parametrize("beds, bad", [("0", True), (None, True), ("abc", True), ("0.5", True), ("12.5", False), ("312", False), ("-3", True)])
def test_acute_inpatient_needs_beds(spark, beds, bad):
    found = issues(spark, "facility", frame(spark, GOOD_FACILITY, {"number_of_beds": beds, "specialty_code": "40"}))
    assert found == ([(1, "error", "number_of_beds", S.MSG_BEDS)] if bad else [])


def test_beds_are_not_checked_without_the_column(spark):
    assert issues(spark, "facility", frame(spark, GOOD_FACILITY, {}).drop("number_of_beds")) == []


def test_duplicates_warn_after_padding_and_per_file(spark):
    df = frame(
        spark,
        GOOD_PROVIDER,
        {},
        {"ssa_state_county_code": "1001", "specialty_code": "1"},
        {},
        {"npi": " "},
        {"npi": " "},
        {"source_file": "other"},
    )
    warnings = [i for i in issues(spark, "provider", df) if i[1] == "warning"]
    assert warnings == [(2, "warning", "npi", S.MSG_DUPLICATE), (3, "warning", "npi", S.MSG_DUPLICATE)]


def test_yearly_codes_and_fallback(spark):
    ssa = spark.createDataFrame([(2024, "01001")], "contract_year int, code string")
    old = spark.createDataFrame([(2023, "01001")], "contract_year int, code string")
    kinds = spark.createDataFrame([("099", 2025, "provider")], "specialty_code string, contract_year int, category string")
    df = frame(spark, GOOD_PROVIDER, {"specialty_code": "099"}, {"specialty_code": "29", "npi": "1111111111"})

    def fields(ssa_set, specialty_set):
        return rows_of(V.row_issues(df, "provider", ssa_set, specialty_set), "row_index", "field")

    assert fields(ssa, specialty_codes(kinds, "provider")) == [(2, "specialty_code")]
    assert fields(ssa, specialty_codes(kinds, "facility")) == [(1, "specialty_code")]  # fixed codes 001-029
    assert ("1", "ssa_state_county_code") in [(str(r), f) for r, f in fields(old, specialty_codes(kinds, "provider"))]


def test_gate_report_and_counts(spark):
    df = frame(spark, GOOD_PROVIDER, {}, {"npi": "1", "source_file": "bad"}, {"source_file": "bad", "npi": "2222222222"}, {})
    found = V.validate(df, "provider", given_codes(spark, SSA, 5), given_codes(spark, PROVIDER, 3)).cache()
    assert rows_of(V.passing_rows(df, found), "source_file", "row_index") == [("f", 1), ("f", 4)]
    assert rows_of(V.issue_counts(found)) == [("bad", 1, 0), ("f", 0, 1)]
    assert [r.line for r in V.report_lines(found).collect()] == [
        "Error row 2, npi: NPI must be 10 digits",
        "Warning row 4, npi: Duplicate row (NPI + SSA code + specialty code)",
    ]
    with pytest.raises(V.ValidationFailed):
        V.require_valid(found)
    V.require_valid(found.filter("severity = 'warning'"))


def test_issue_order(spark):
    bad = {
        "ssa_state_county_code": "x",
        "npi": "x",
        "specialty_code": "x",
        "facility_street_address": "",
        "letter_of_intent": "Y",
        "accuracy_confidence": "x",
    }
    df = frame(spark, {**GOOD_FACILITY, "accuracy_confidence": None}, bad)
    out = V.validate(df, "facility", given_codes(spark, SSA, 5), given_codes(spark, FACILITY, 3))
    fields = [r.line.split(", ")[1].split(":")[0] for r in V.report_lines(out).collect()]
    assert fields == ["ssa_state_county_code", "npi", "specialty_code", "facility_street_address", "letter_of_intent", "accuracy_confidence"]
