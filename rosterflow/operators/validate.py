"""Row validation of submissions, as an issues table.

Input rows carry the canonical columns plus ``source_file``, ``row_index`` and
``source_year``. Every row check is a column expression of one scan; the two code
sets are joined as small sides; duplicates are the only shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterflow import schemas as S
from rosterflow.functions import numbers, text
from rosterflow.operators.dedupe import later_duplicates
from rosterflow.operators.joins import mark_members, small_side
from rosterflow.operators.sets import missing_columns


class ValidationFailed(Exception):
    """A submission holds at least one error; ``issues`` has them all."""

    def __init__(self, message: str, issues: DataFrame):
        super().__init__(message)
        self.issues = issues


def _issue(check_no: int, bad: Column, field: str, message: Column | str) -> Column:
    return F.when(
        bad,
        F.struct(
            F.lit("error").alias("severity"),
            F.lit(field).alias("field"),
            (F.lit(message) if isinstance(message, str) else message).alias("message"),
            F.lit(check_no).alias("check_no"),
        ),
    )


def schema_issues(df: DataFrame, kind: str) -> DataFrame | None:
    """The missing-columns issue of a frame that lacks required columns, else None."""
    missing = missing_columns(df.columns, S.REQUIRED_COLUMNS[kind])
    if not missing:
        return None
    row = (None, 0, "error", "schema", S.MSG_MISSING_COLUMNS + ", ".join(missing), 0)
    return df.sparkSession.createDataFrame([row], S.ISSUES)


def header_issues(files: DataFrame) -> DataFrame:
    """Missing-columns issue per file; input ``source_file, missing array<string>``."""
    return files.filter(F.size("missing") > 0).select(
        "source_file",
        F.lit(0).cast("bigint").alias("row_index"),
        F.lit("error").alias("severity"),
        F.lit("schema").alias("field"),
        F.concat(F.lit(S.MSG_MISSING_COLUMNS), F.array_join("missing", ", ")).alias("message"),
        F.lit(0).alias("check_no"),
    )


def damaged_issues(df: DataFrame) -> DataFrame:
    """An error for every row whose quotes do not close."""
    return df.filter("damaged").select(
        "source_file",
        "row_index",
        F.lit("error").alias("severity"),
        F.lit("schema").alias("field"),
        F.lit(S.MSG_DAMAGED).alias("message"),
        F.lit(0).alias("check_no"),
    )


def _known_codes(df: DataFrame, code: str, codes: DataFrame, marker: str, year_offset: int = 0) -> DataFrame:
    """Mark rows whose code is valid; code sets with a ``contract_year`` are matched
    on the row's year plus the offset."""
    if "contract_year" not in codes.columns:
        return mark_members(df, codes.select(F.col("code").alias(code)), [code], marker)
    keyed = codes.select(
        (F.col("contract_year") - year_offset).cast("int").alias("source_year"), F.col("code").alias(code)
    )
    return mark_members(df, keyed, ["source_year", code], marker)


def _checked_rows(df: DataFrame, kind: str, applicant: bool) -> DataFrame:
    """Codes and failed checks of every row. Wide text columns end here: only codes,
    raw codes for the messages, and flags go on to the joins."""
    have = set(df.columns)
    address = F.col(S.ADDRESS_COLUMN[kind])
    narrow = {
        "_s": text.strip_or_blank(F.col("ssa_state_county_code")),
        "_p": text.strip_or_blank(F.col("specialty_code")),
        "_npi_bad": ~text.is_npi(F.col("npi")),
        "_address_blank": text.is_blank(address),
        "_address_box": text.is_po_box(address),
    }
    if kind == "facility" and "number_of_beds" in have:
        beds = F.coalesce(numbers.truncated_long(F.col("number_of_beds").cast("string")), F.lit(0))
        narrow["_no_beds"] = (F.col("_has_beds") & (beds <= 0)) if "_has_beds" in have else beds <= 0
    if not applicant and "letter_of_intent" in have:
        narrow["_loi_bad"] = ~text.is_blank(F.col("letter_of_intent"))
    if "accuracy_confidence" in have:
        narrow["_accuracy_bad"] = ~text.is_accuracy_value(F.col("accuracy_confidence"))
    kept = ["source_file", "row_index", "source_year", "ssa_state_county_code", "specialty_code"]
    rows = df.select(*kept, *[c.alias(n) for n, c in narrow.items()])
    return rows.withColumns(
        {"_ssa": text.zero_fill(F.col("_s"), 5), "_spec": text.zero_fill(F.col("_p"), 3)}
    ).drop("_s", "_p")


def with_fallback_codes(codes: DataFrame, rows: DataFrame, kind: str) -> DataFrame:
    """Yearly codes, and the fixed ones for every year of the rows that has none; a set
    without years stays as it is."""
    if "contract_year" not in codes.columns:
        return codes
    codes = codes.select(F.col("contract_year").cast("int").alias("contract_year"), "code")
    fixed = F.array(*[F.lit(c) for c in S.FALLBACK_SPECIALTY_CODES[kind]])
    # an aggregate and not an anti join, which would be a nested loop where all rows have one literal year
    years = rows.select(F.col("source_year").cast("int").alias("contract_year"), F.lit(False).alias("covered"))
    covered = years.distinct().unionByName(codes.select("contract_year", F.lit(True).alias("covered")).distinct())
    uncovered = covered.groupBy("contract_year").agg(F.max("covered").alias("covered")).filter(~F.col("covered"))
    return codes.unionByName(uncovered.select("contract_year", F.explode(fixed).alias("code")))


def row_issues(
    df: DataFrame,
    kind: str,
    ssa_codes: DataFrame,
    specialty_codes: DataFrame,
    *,
    applicant: bool = False,
    ssa_year_offset: int = -1,
) -> DataFrame:
    """Issues of single rows. ``kind`` is ``provider`` or ``facility``.

    Code sets are frames ``code`` or ``contract_year, code``. A yearly specialty
    set falls back to the fixed codes for years it does not cover; an SSA set does
    not. Every check is evaluated once per row, in generated code; the array of a
    row's checks is exploded and its empty places dropped.
    """
    rows = _checked_rows(df, kind, applicant)
    rows = _known_codes(rows, "_ssa", ssa_codes.filter(F.col("code").rlike("^[0-9]{5}$")), "_ssa_ok", ssa_year_offset)
    rows = _known_codes(rows, "_spec", with_fallback_codes(specialty_codes, df, kind), "_spec_ok")
    spec_ok = F.col("_spec_ok")

    address = S.ADDRESS_COLUMN[kind]
    address_message = F.when(F.col("_address_blank"), S.MSG_ADDRESS_BLANK).otherwise(S.MSG_ADDRESS_PO_BOX)
    raw_ssa, raw_specialty = text.shown(F.col("ssa_state_county_code")), text.shown(F.col("specialty_code"))
    checks: list[tuple[Column, str, Column | str]] = [
        (~F.col("_ssa_ok"), "ssa_state_county_code", F.concat(F.lit(S.MSG_SSA), raw_ssa)),
        (F.col("_npi_bad"), "npi", S.MSG_NPI),
        (~spec_ok, "specialty_code", F.concat(F.lit(S.MSG_SPECIALTY[kind]), raw_specialty)),
        (F.col("_address_blank") | F.col("_address_box"), address, address_message),
    ]
    if "_no_beds" in rows.columns:
        acute = F.col("_spec") == S.ACUTE_INPATIENT_CODE
        checks.append((acute & F.col("_no_beds"), "number_of_beds", S.MSG_BEDS))
    if "_loi_bad" in rows.columns:
        checks.append((F.col("_loi_bad"), "letter_of_intent", S.MSG_LOI))
    if "_accuracy_bad" in rows.columns:
        checks.append((F.col("_accuracy_bad"), "accuracy_confidence", S.MSG_ACCURACY))
    issues = F.array(*[_issue(n, bad, field, message) for n, (bad, field, message) in enumerate(checks, start=1)])
    return (
        rows.select("source_file", "row_index", F.explode(issues).alias("i"))
        .filter("i is not null")
        .select("source_file", "row_index", "i.severity", "i.field", "i.message", "i.check_no")
    )


def duplicate_issues(df: DataFrame) -> DataFrame:
    """A warning for every row but the first with the same NPI and padded codes in
    its file; rows without an NPI take no part."""
    keyed = df.select(
        "source_file",
        "row_index",
        text.strip_or_blank(F.col("npi")).alias("_npi"),
        text.check_code(F.col("ssa_state_county_code"), 5).alias("_ssa"),
        text.check_code(F.col("specialty_code"), 3).alias("_spec"),
    ).filter(F.col("_npi") != "")
    return later_duplicates(keyed, ["source_file", "_npi", "_ssa", "_spec"], ["row_index"]).select(
        "source_file",
        "row_index",
        F.lit("warning").alias("severity"),
        F.lit("npi").alias("field"),
        F.lit(S.MSG_DUPLICATE).alias("message"),
        F.lit(99).alias("check_no"),
    )


def validate(
    df: DataFrame,
    kind: str,
    ssa_codes: DataFrame,
    specialty_codes: DataFrame,
    *,
    applicant: bool = False,
    ssa_year_offset: int = -1,
) -> DataFrame:
    """All issues of a submission frame."""
    missing = schema_issues(df, kind)
    if missing is not None:
        return missing
    return row_issues(
        df, kind, ssa_codes, specialty_codes, applicant=applicant, ssa_year_offset=ssa_year_offset
    ).unionByName(duplicate_issues(df))


def issue_counts(issues: DataFrame) -> DataFrame:
    """Errors and warnings per file."""
    return issues.groupBy("source_file").agg(
        F.count_if(F.col("severity") == "error").alias("errors"),
        F.count_if(F.col("severity") == "warning").alias("warnings"),
    )


def passing_rows(df: DataFrame, issues: DataFrame, group: str = "source_file") -> DataFrame:
    """Rows of the files that hold no error."""
    failed = issues.filter(F.col("severity") == "error").select(group).distinct()
    return df.join(small_side(failed), group, "left_anti")


def require_valid(issues: DataFrame) -> None:
    """Raise when there is any error; warnings pass."""
    if not issues.filter(F.col("severity") == "error").isEmpty():
        raise ValidationFailed("submission holds errors", issues)


def report_line() -> Column:
    return F.format_string(
        "%s row %d, %s: %s", F.initcap(F.col("severity")), F.col("row_index"), F.col("field"), F.col("message")
    )


def report_lines(issues: DataFrame) -> DataFrame:
    """One text line per issue; per file all errors by row and check, then all warnings."""
    return issues.orderBy("source_file", "severity", "row_index", "check_no").select(
        "source_file", report_line().alias("line")
    )
