"""Excel 2007+ workbooks as one long table of raw sheet rows.

Spark lists and ships the files; each task unpacks its workbooks and yields rows in
batches. Cells arrive as text: whole numbers without a fraction, other numbers in
their shortest form, numbers whose style shows a date or a time as such
(``2025-03-01``, ``2025-03-01 08:30:00``, ``08:30:00``).
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator, Sequence
from datetime import datetime, timedelta
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rosterflow import schemas as S
from rosterflow.operators.joins import small_side
from rosterflow.operators.reshape import cell
from rosterflow.session import materialise, ship
from rosterflow.sources.paths import file_address

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL_ID = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_BATCH = 4096
_DECODED = "path string, sheet_no int, sheet string, row_idx bigint, cells array<string>, error string"


#: Numbers of the built-in formats of dates and times.
_DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}
#: What of a format's code is no part of the value: quoted text, escaped characters, colours and conditions.
_NO_VALUE = re.compile(r'"[^"]*"|\\.|_.|\*.|\[(?![hms]+\])[^\]]*\]')


def _text_of(element) -> str:
    """Text of a string item, phonetic hints left out."""
    parts = [t.text or "" for t in element.findall(f"{_MAIN}t")]
    parts += [t.text or "" for r in element.findall(f"{_MAIN}r") for t in r.findall(f"{_MAIN}t")]
    return "".join(parts)


def _number_text(raw: str) -> str:
    value = float(raw)
    return str(int(value)) if value.is_integer() else repr(value)


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Numbers of the cell styles that show a date or a time."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    shown = {int(f.get("numFmtId")): f.get("formatCode") or "" for f in root.iter(f"{_MAIN}numFmt")}
    dates = _DATE_FORMATS - set(shown) | {n for n, code in shown.items() if re.search("[dmyhs]", _NO_VALUE.sub("", code.lower()))}
    styles = root.find(f"{_MAIN}cellXfs")
    return {i for i, style in enumerate(styles if styles is not None else ()) if int(style.get("numFmtId", 0)) in dates}


def _date_text(raw: str, epoch: datetime) -> str:
    """A serial number of days as the date, time or both that it shows, to the second."""
    days = float(raw)
    if not 0 <= days < 2_958_466:  # the last day that a workbook can show is of the year 9999
        return _number_text(raw)
    if epoch.year < 1900 and 1 <= days < 60:
        days += 1  # that calendar has a 29 February in 1900
    at = epoch + timedelta(seconds=round(days * 86_400))
    if days < 1:
        return at.strftime("%H:%M:%S")
    return at.strftime("%Y-%m-%d" if days.is_integer() else "%Y-%m-%d %H:%M:%S")


def _cell_text(element, shared: list[str], dates: set[int], epoch: datetime) -> str | None:
    kind = element.get("t", "n")
    if kind == "inlineStr":
        inline = element.find(f"{_MAIN}is")
        return None if inline is None else _text_of(inline)
    value = element.findtext(f"{_MAIN}v")
    if value is None:
        return None
    if kind == "s":
        return shared[int(value)]
    if kind == "b":
        return "True" if value == "1" else "False"
    if kind != "n":
        return value
    return _date_text(value, epoch) if int(element.get("s", 0)) in dates else _number_text(value)


def _column_no(reference: str) -> int:
    n = 0
    for letter in re.match("[A-Z]+", reference).group():
        n = n * 26 + ord(letter) - 64
    return n - 1


def _sheet_rows(book: zipfile.ZipFile, part: str, shared: list[str], dates: set[int], epoch: datetime) -> Iterator[tuple[int, list[str | None]]]:
    with book.open(part) as stream:
        row_no = -1
        for _, row in ElementTree.iterparse(stream):
            if row.tag != f"{_MAIN}row":
                continue
            given = int(row.get("r", row_no + 2)) - 1
            for absent in range(row_no + 1, given):  # rows without a cell may be left out of the file
                yield absent, []
            row_no = given
            cells: list[str | None] = []
            for element in row.findall(f"{_MAIN}c"):
                column = _column_no(element.get("r")) if element.get("r") else len(cells)
                cells.extend([None] * (column - len(cells)))
                cells.append(_cell_text(element, shared, dates, epoch))
            yield row_no, cells
            row.clear()


def decode_workbook(content: bytes) -> Iterator[tuple[int, str, int, list[str | None]]]:
    """Rows of every sheet in workbook order: ``sheet_no, sheet, row_idx, cells``."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        shared: list[str] = []
        if "xl/sharedStrings.xml" in book.namelist():
            root = ElementTree.fromstring(book.read("xl/sharedStrings.xml"))
            shared = [_text_of(item) for item in root.findall(f"{_MAIN}si")]
        links = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
        targets = {link.get("Id"): link.get("Target") for link in links}
        described = ElementTree.fromstring(book.read("xl/workbook.xml"))
        settings = described.find(f"{_MAIN}workbookPr")
        late = settings is not None and settings.get("date1904") in ("1", "true")
        epoch, dates = datetime(1904, 1, 1) if late else datetime(1899, 12, 30), _date_styles(book)
        for number, sheet in enumerate(described.iter(f"{_MAIN}sheet")):
            target = targets[sheet.get(_REL_ID)]
            part = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
            for row_no, cells in _sheet_rows(book, part, shared, dates, epoch):
                yield number, sheet.get("name"), row_no, cells


def _decode_batches(batches: Iterator[pd.DataFrame], keep_unreadable: bool) -> Iterator[pd.DataFrame]:
    columns = ["path", "sheet_no", "sheet", "row_idx", "cells", "error"]
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            rows: list[tuple] = []
            try:
                for number, sheet, row_no, cells in decode_workbook(content):
                    rows.append((path, number, sheet, row_no, cells, None))
                    if len(rows) == _BATCH:
                        yield pd.DataFrame(rows, columns=columns)
                        rows = []
            except Exception as problem:  # whatever a damaged file makes the decoder raise is that file's problem
                if not keep_unreadable:
                    raise ValueError(f"unreadable workbook {path}: {problem}") from problem
                rows.append((path, None, None, None, None, f"unreadable workbook: {problem or type(problem).__name__}"))
            if rows:
                yield pd.DataFrame(rows, columns=columns)


def decode_contents(files: DataFrame, *, keep_unreadable: bool = False) -> DataFrame:
    """Sheet rows of workbooks given as ``path, content``. An unreadable one fails the
    job, or, when kept, yields a row with its error after the rows read so far."""
    ship(files.sparkSession)
    return files.select("path", "content").mapInPandas(
        lambda batches: _decode_batches(batches, keep_unreadable), _DECODED
    )


def decode_workbooks(spark: SparkSession, paths: Sequence[str], *, keep_unreadable: bool = False) -> DataFrame:
    """Sheet rows of all workbook files."""
    files = spark.read.format("binaryFile").load(list(paths))
    return decode_contents(
        files.select(file_address().alias("path"), "content"), keep_unreadable=keep_unreadable
    )


def read_workbooks(spark: SparkSession, paths: Sequence[str], year: int | Column) -> DataFrame:
    """All sheets of all workbooks; ``year`` is one value or an expression on ``path``."""
    source_year = year if isinstance(year, Column) else F.lit(year)
    rows = decode_workbooks(spark, paths).withColumn("source_year", source_year.cast("int"))
    return rows.select(*S.SHEET_ROWS.fieldNames())


def first_sheet_rows(decoded: DataFrame, sheet: int = 0) -> DataFrame:
    """Rows of one sheet of each workbook, rows without a value left out, numbered
    from 0 for the header. A sheet ends at 1,048,576 rows, so one window per workbook
    stays bounded."""
    filled = decoded.filter((F.col("sheet_no") == sheet) & F.exists("cells", lambda c: c.isNotNull()))
    order = Window.partitionBy("path").orderBy("row_idx")
    return filled.withColumn("row_index", (F.row_number().over(order) - 1).cast("bigint"))


def read_sheet(spark: SparkSession, path: str, sheet: int = 0) -> DataFrame:
    """One sheet of one workbook as text columns named by its first row."""
    if path.lower().endswith(".xls"):
        raise ValueError(S.MSG_UNSUPPORTED + ".xls")
    rows = first_sheet_rows(decode_workbooks(spark, [path]), sheet)
    header = rows.filter("row_index = 0").select("cells").first()
    names = [c or f"col_{i}" for i, c in enumerate(header.cells)] if header else []
    return rows.filter("row_index > 0").select(*[cell(i).alias(n) for i, n in enumerate(names)])


def stage_workbooks(
    spark: SparkSession, paths: Sequence[str], kind: str, *, keep_unreadable: bool = False
) -> tuple[DataFrame, DataFrame]:
    """First sheets of submission workbooks under positional names, shaped like the
    staged CSV rows, and the unreadable workbooks as ``source_file, error``, which
    fail the read unless they are kept."""
    staged = materialise(decode_workbooks(spark, paths, keep_unreadable=keep_unreadable), "staged-sheets")
    unreadable = staged.filter(F.col("error").isNotNull()).select(F.col("path").alias("source_file"), "error")
    names = S.SUBMISSION_COLUMNS[kind]
    rows = (
        first_sheet_rows(staged)
        .select(
            *[cell(i).alias(n) for i, n in enumerate(names)],
            F.col("path").alias("source_file"),
            "row_index",
            F.when(F.col("row_index") == 0, F.size("cells")).alias("cells"),
            F.lit(False).alias("damaged"),
        )
        .join(small_side(unreadable.select("source_file")), "source_file", "left_anti")
    )
    return rows, unreadable
