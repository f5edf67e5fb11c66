"""Raw sheet rows to long tables, for any number of workbooks in one plan.

Input is one row per sheet row: ``path, source_year, sheet, row_idx, cells``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterflow import schemas as S
from rosterflow.functions import numbers, text
from rosterflow.operators.joins import small_side

SHEET_KEY = ["path", "sheet"]
HEAD_ROW, CODE_ROW = 0, 2
COUNT_FIRST_DATA_ROW, PAIR_FIRST_DATA_ROW = 3, 4


def cell(i: Column | int) -> Column:
    """Cell of a row; null past its end."""
    return F.get(F.col("cells"), i if isinstance(i, Column) else F.lit(i))


def sheet_layout(rows: DataFrame) -> DataFrame:
    """One row per sheet: its width (widest row), first row and code row.

    Stage it once for all operators of a job: the planner then knows its size."""

    def row(number: int, name: str) -> DataFrame:
        return rows.filter(F.col("row_idx") == number).select(*SHEET_KEY, F.col("cells").alias(name))

    width = rows.groupBy(*SHEET_KEY).agg(F.max(F.size("cells")).alias("width"))
    return width.join(row(CODE_ROW, "codes"), SHEET_KEY, "left").join(row(HEAD_ROW, "head"), SHEET_KEY, "left")


def rows_with_layout(rows: DataFrame, sheet: str, first_row: int, layout: DataFrame | None = None) -> DataFrame:
    """Rows of a sheet from ``first_row`` on, each with its sheet's layout. Data rows
    stay where they are while the layout is small."""
    rows = rows.filter(F.col("sheet") == sheet)
    layout = sheet_layout(rows) if layout is None else layout.filter(F.col("sheet") == sheet)
    return rows.filter(F.col("row_idx") >= first_row).join(small_side(layout), SHEET_KEY)


def _columns_from(start: int, count: Column) -> Column:
    """Column positions from ``start``; empty when the count is not positive."""
    return F.when(count > 0, F.sequence(F.lit(start), F.lit(start) + count - 1)).otherwise(F.array().cast("array<int>"))


def _id_columns(names: list[str]) -> list[Column]:
    return [cell(i).alias(n) for i, n in enumerate(names)]


def unpivot_counts(rows: DataFrame, sheet: str, source_table: str, layout: DataFrame | None = None) -> DataFrame:
    """One row per data row and specialty column; null counts are kept.

    The code row rides along as one array per sheet.
    """
    start = len(S.MIN_COUNT_ID_COLUMNS)
    data = rows_with_layout(rows, sheet, COUNT_FIRST_DATA_ROW, layout)
    return data.select(
        "path",
        "source_year",
        "row_idx",
        F.lit(source_table).alias("source_table"),
        *_id_columns(S.MIN_COUNT_ID_COLUMNS),
        F.col("cells"),
        F.col("codes"),
        F.explode(_columns_from(start, F.col("width") - start)).alias("_pos"),
    ).select(
        "path",
        "source_year",
        "row_idx",
        "source_table",
        *S.MIN_COUNT_ID_COLUMNS,
        count_code(F.get("codes", F.col("_pos")), F.col("_pos")).alias("specialty_code"),
        numbers.to_long(cell(F.col("_pos"))).alias("min_count"),
    )


def count_code(code: Column, position: Column) -> Column:
    """Stripped code of the code row; a column without one goes by its position."""
    return F.when(F.coalesce(code, F.lit("")) == "", position.cast("string")).otherwise(text.strip(code))


def unpivot_pairs(rows: DataFrame, sheet: str, source_table: str, layout: DataFrame | None = None) -> DataFrame:
    """One row per data row and (time, distance) column pair.

    Pairs without a code and pairs where both values are missing are dropped; an
    odd last column is ignored.
    """
    start = len(S.TIME_DISTANCE_ID_COLUMNS)
    data = rows_with_layout(rows, sheet, PAIR_FIRST_DATA_ROW, layout)
    pairs = F.floor((F.col("width") - start) / 2).cast("int")
    return (
        data.select(
            "path",
            "source_year",
            "row_idx",
            F.lit(source_table).alias("source_table"),
            *_id_columns(S.TIME_DISTANCE_ID_COLUMNS),
            F.col("cells"),
            F.col("codes"),
            F.explode(_columns_from(0, pairs)).alias("_pair"),
        )
        .withColumn("_pos", F.lit(start) + 2 * F.col("_pair"))
        .select(
            "path",
            "source_year",
            "row_idx",
            "source_table",
            *S.TIME_DISTANCE_ID_COLUMNS,
            text.strip(F.get("codes", F.col("_pos"))).alias("specialty_code"),
            numbers.truncated_long(cell(F.col("_pos"))).alias("max_time_minutes"),
            numbers.truncated_long(cell(F.col("_pos") + 1)).alias("max_distance_miles"),
        )
        .filter(F.col("specialty_code") != "")
        .filter(F.coalesce("max_time_minutes", "max_distance_miles").isNotNull())
    )


def header_names(cells: Column) -> Column:
    """Normalised header texts of a header row; a header with nothing left is ``col_i``."""
    return F.transform(
        cells,
        lambda c, i: F.coalesce(text.snake_case(c), F.concat(F.lit("col_"), i.cast("string"))),
    )


def header_layout(rows: DataFrame) -> DataFrame:
    """One row per sheet: the normalised names of its first row."""
    return rows.filter(F.col("row_idx") == HEAD_ROW).select(*SHEET_KEY, header_names(F.col("cells")).alias("names"))


def named_cell(name: str) -> Column:
    """Cell under a header of that name; null when the sheet has none."""
    position = F.array_position(F.col("names"), name).cast("int")
    return F.when(position > 0, F.get(F.col("cells"), position - 1))


def rows_with_names(rows: DataFrame, sheet: str, layout: DataFrame | None = None) -> DataFrame:
    """Data rows of a sheet with a header row, each with its sheet's header names."""
    return rows_with_layout(rows, sheet, HEAD_ROW + 1, layout).withColumn("names", header_names(F.col("head")))


def promote_header(rows: DataFrame, sheet: str) -> DataFrame:
    """Wide frame of a sheet whose workbooks share one header; the header row alone
    is fetched to name the columns."""
    layouts = header_layout(rows.filter(F.col("sheet") == sheet)).select("names").distinct().take(2)
    if len(layouts) > 1:
        raise ValueError(f"workbooks disagree on the header of sheet {sheet!r}")
    names = layouts[0].names if layouts else []
    return rows.filter((F.col("sheet") == sheet) & (F.col("row_idx") > 0)).select(
        "path", "row_idx", *[cell(i).alias(n) for i, n in enumerate(names)], "source_year"
    )
