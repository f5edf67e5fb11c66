"""Batch jobs: read, shape, check, write. Each takes any number of files."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow import schemas as S
from rosterflow.operators.joins import small_side
from rosterflow.operators.shape import stable_id
from rosterflow.operators.validate import (
    damaged_issues,
    duplicate_issues,
    header_issues,
    passing_rows,
    require_valid,
    row_issues,
)
from rosterflow.plans.geography import boundary_table, gazetteer_table
from rosterflow.plans.standards import standards_tables
from rosterflow.plans.submissions import facility_rows, org_facility_rows, org_provider_rows, provider_rows
from rosterflow.session import materialise
from rosterflow.sinks.tables import replace_files, with_point, write_table, write_tables
from rosterflow.sources.boundaries import read_boundaries
from rosterflow.sources.delimited import (
    data_rows,
    file_headers,
    files_without_rows,
    read_any,
    read_gazetteer,
    stage_csv,
    suffix_of,
    with_manifest,
)
from rosterflow.sources.workbook import read_workbooks, stage_workbooks

_TYPED = {"provider": (provider_rows, "provider_hsd"), "facility": (facility_rows, "facility_hsd")}
_ORG_ROWS = {"org_provider": org_provider_rows, "org_facility": org_facility_rows}


def load_file(
    spark: SparkSession,
    path: str,
    table: str = "pipeline_output",
    *,
    sheet: int = 0,
    append: bool = False,
    change: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> None:
    """Any CSV or workbook sheet into a table; ``change`` is the caller's own step."""
    write_table(read_any(spark, path, sheet).transform(change), table, append=append)


def load_standards(
    spark: SparkSession, paths: Sequence[str], year: int | Column, location: str = "", *, append: bool = False, options: Mapping[str, str] | None = None
) -> list[str]:
    """Standards workbooks into the five tables; returns the tables written. ``location``
    is a folder, a catalog prefix or a JDBC address, with the connection's ``options``."""
    rows = materialise(read_workbooks(spark, paths, year), "sheet-rows", ("sheet",))
    return write_tables(standards_tables(rows), S.REFERENCE_TABLES, location, append=append, options=options)


def stage_submissions(spark: SparkSession, paths: Sequence[str], kind: str) -> DataFrame:
    """CSV and workbook submissions, each parsed once, as one staged table."""
    by_suffix = {suffix: [p for p in paths if suffix_of(p) == suffix] for suffix in {suffix_of(p) for p in paths}}
    unsupported = sorted(set(by_suffix) - {".csv", ".xlsx"})
    if unsupported:
        raise ValueError(S.MSG_UNSUPPORTED + unsupported[0])
    parts = []
    if ".csv" in by_suffix:
        parts.append(stage_csv(spark, by_suffix[".csv"], kind))
    if ".xlsx" in by_suffix:
        parts.append(stage_workbooks(spark, by_suffix[".xlsx"], kind)[0])
    return reduce(DataFrame.unionByName, parts)


def submission_issues(
    staged: DataFrame,
    kind: str,
    ssa_codes: DataFrame,
    specialty_codes: DataFrame,
    *,
    applicant: bool = False,
    ssa_year_offset: int = -1,
    empty_files: DataFrame | None = None,
) -> DataFrame:
    """Issues of staged submissions of any number of files; input carries
    ``source_year``. A file that lacks required columns has that one issue only, and so
    has each of ``empty_files`` (``source_file``)."""
    headers = materialise(file_headers(staged, kind, empty_files), "file-headers")
    complete = small_side(headers.filter((F.size("missing") == 0) & F.col("has_rows")).select("source_file", "width"))
    rows = data_rows(staged).join(complete, "source_file")
    if kind == "facility":
        beds_at = S.FACILITY_COLUMNS.index("number_of_beds")
        rows = rows.withColumn("_has_beds", F.col("width") > beds_at)
    return (
        header_issues(headers)
        .unionByName(damaged_issues(rows))
        .unionByName(
            row_issues(
                rows, kind, ssa_codes, specialty_codes, applicant=applicant, ssa_year_offset=ssa_year_offset
            )
        )
        .unionByName(duplicate_issues(rows))
    )


def load_submissions(
    spark: SparkSession,
    paths: Sequence[str],
    year: int | Column,
    kind: str,
    ssa_codes: DataFrame,
    specialty_codes: DataFrame,
    location: str = "",
    *,
    append: bool = False,
    applicant: bool = False,
    strict: bool = False,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Validate submissions and load the files without errors.

    Returns the issues, written once as a table and read back: the gate needs them
    after the report does. ``strict`` raises on any error instead of loading the
    files that pass; when none passes, the table stays as it was.
    """
    typed, table = _TYPED[kind]
    staged = stage_submissions(spark, paths, kind).withColumn(
        "source_year", (year if isinstance(year, Column) else F.lit(year)).cast("int")
    )
    issues = materialise(
        submission_issues(
            staged,
            kind,
            ssa_codes,
            specialty_codes,
            applicant=applicant,
            empty_files=files_without_rows(spark, paths, staged),
        ),
        "issues",
    )
    if strict:
        require_valid(issues)
    write_tables({table: typed(passing_rows(data_rows(staged), issues))}, [table], location, append=append, options=options)
    return issues


def load_uploads(
    spark: SparkSession, manifest: DataFrame, kind: str, target: str, paths: Sequence[str]
) -> DataFrame:
    """Organisation uploads of one kind, replaced per file; no validation runs.

    ``manifest`` holds ``source_file, organization_id, source_file_id`` per file.
    Ids derive from file and row, so a retried load writes the same ones. Returns
    ``source_file_id, rows, error``: an unreadable workbook or a CSV file with an
    unclosed quote has an error, keeps the rows it had, and does not hold up the others.
    """
    csv = [p for p in paths if suffix_of(p) == ".csv"]
    books = [p for p in paths if suffix_of(p) == ".xlsx"]
    staged, unreadable = [], spark.createDataFrame([], "source_file string, error string")
    if csv:
        staged.append(stage_csv(spark, csv, kind))
    if books:
        rows, unreadable = stage_workbooks(spark, books, kind, keep_unreadable=True)
        staged.append(rows)
    rows = reduce(DataFrame.unionByName, staged)
    spoiled = rows.filter("damaged").groupBy("source_file").agg(F.min("row_index").alias("row"))
    spoiled = spoiled.select("source_file", F.concat(F.lit("unclosed quote in row "), F.col("row").cast("string")).alias("error"))
    unreadable = materialise(unreadable.unionByName(spoiled), "unreadable-files")
    rows = rows.join(small_side(unreadable.select("source_file")), "source_file", "left_anti")
    context = with_manifest(data_rows(rows), manifest, ["organization_id", "source_file_id"])
    out = _ORG_ROWS[kind](context, stable_id(F.col("source_file_id"), F.col("row_index")))
    failed = with_manifest(unreadable, manifest, ["source_file_id"]).select("source_file_id", "error")
    readable = manifest.select("source_file_id").join(failed, "source_file_id", "left_anti")
    loaded = replace_files(out, target, readable, scattered=False)
    return loaded.withColumn("error", F.lit(None).cast("string")).unionByName(
        failed.withColumn("rows", F.lit(0).cast("bigint"))
    )


def load_gazetteer(
    spark: SparkSession, paths: Sequence[str], year: int | Column, table: str = "zcta_gazetteer", *, append: bool = False
) -> bool:
    """Gazetteer files into a table with the point of each row; empty input writes nothing."""
    out = with_point(gazetteer_table(read_gazetteer(spark, paths), year), "intptlong", "intptlat", "geom")
    return bool(write_tables({table: out}, [table], append=append))


def load_boundaries(
    spark: SparkSession, path: str, year: int | Column, table: str = "county_boundaries", *, append: bool = False
) -> bool:
    """Boundary files into a table with WKB geometry; empty input writes nothing."""
    out = boundary_table(read_boundaries(spark, path), year)
    return bool(write_tables({table: out}, [table], append=append))
