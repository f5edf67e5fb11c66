"""Delimited text: generic CSV, positional submissions, gazetteers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rosterflow import schemas as S
from rosterflow.operators.dedupe import number_rows
from rosterflow.operators.joins import small_side
from rosterflow.operators.shape import normalised_headers
from rosterflow.sources import blocks
from rosterflow.sources.paths import file_address, plain_address
from rosterflow.session import materialise

_PIPE, _TAB = "|", "\t"


def suffix_of(path: str) -> str:
    name = path.rstrip("/").rsplit("/", 1)[-1]
    return "." + name.rsplit(".", 1)[-1].lower() if "." in name else ""


def read_csv(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """CSV with a header row and inferred types."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def read_any(spark: SparkSession, path: str, sheet: int = 0) -> DataFrame:
    """CSV or workbook by suffix, in any case."""
    from rosterflow.sources.workbook import read_sheet

    suffix = suffix_of(path)
    if suffix == ".csv":
        return read_csv(spark, path)
    if suffix in (".xlsx", ".xls"):
        return read_sheet(spark, path, sheet)
    raise ValueError(S.MSG_UNSUPPORTED + suffix)


def files_without_rows(spark: SparkSession, paths: Sequence[str], staged: DataFrame) -> DataFrame:
    """``source_file`` of the files that gave no row at all, such as files without a byte.

    Readers leave such files out, so their number is compared first; only if some are
    missing do names come to the driver.
    """
    names = spark.read.text(list(paths))._jdf.inputFiles()
    seen = staged.select("source_file").distinct()
    listed = [] if len(names) == seen.count() else [(plain_address(n),) for n in names]
    return spark.createDataFrame(listed, "source_file string").join(seen, "source_file", "left_anti")


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Lines with text, staged in one pass. ``line`` counts all lines of a block,
    ``place`` only those staged, so both ascend within a block without gaps of their own."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    lines = spark.read.text(list(paths)).select(
        F.col("value").alias("raw"),
        file_address().alias("source_file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("line"),
        (quotes % 2 == 1).alias("odd"),
    )
    filled = lines.filter(F.trim("raw") != "")
    return materialise(filled.withColumn("place", F.monotonically_increasing_id()), "staged-lines")


def _open_lines(lines: DataFrame) -> DataFrame:
    """Lines whose last field opens a quote that the line does not close, with the line
    that closes it: ``end_block, end_line``, or null where none does.

    Only lines with an odd number of quotes can open or close one. An opening line goes
    on to the next odd line if that one, read inside quotes, closes the field right
    before a comma or its end; else the quote is a stray one and costs its own line
    only. In a run of lines that could do both, first, third and so on open. Whether a line
    is inside a field is a state that blocks hand on to each other.
    """
    bare = F.replace("raw", F.lit('""'))
    opens = F.regexp_replace(bare, '"[^"]*"', "q").rlike('(^|,)"[^"]*$')
    closes = bare.rlike('^[^"]*"(,|$)')
    odd = lines.filter("odd").select(*blocks.PLACE, opens.alias("opens"), closes.alias("closes"))
    odd = materialise(odd, "odd-lines")
    paired = blocks.next_rows(odd, F.struct("closes", "block_start", "line"))
    state = blocks.toggled(paired, F.col("opens") & F.col("next.closes")).filter(F.col("opens") & ~F.col("inside"))
    starts = F.coalesce(F.col("next.closes"), F.lit(False))
    return state.select(*blocks.PLACE, F.when(starts, F.col("next.block_start")).alias("end_block"), F.when(starts, F.col("next.line")).alias("end_line"))


def _stitched(lines: DataFrame, spans: DataFrame) -> DataFrame:
    """Lines with those of a span joined to one record, which stands at its first line.

    The span that a line is in starts in its own block, or before it; at most one span
    runs over the start of a block, so no task needs a whole file.
    """
    span = F.struct("end_block", "end_line")
    started = spans.select(*blocks.PLACE, F.struct("block_start", "line", span.alias("end")).alias("span"))
    over = blocks.last_before(started, lines.select(*blocks.BLOCK).distinct(), F.col("span"))
    over = small_side(materialise(over.filter(F.col("over.end.end_block") >= F.col("block_start")), "open-blocks"))
    in_block = Window.partitionBy("source_file", "block_start").orderBy("line")
    seen = F.last("span", ignorenulls=True).over(in_block)
    # blank lines are not staged: a gap in the line numbers of a block says how many there were
    gap = F.coalesce(F.col("line") - F.lag("line").over(in_block), F.lit(1)).cast("int")
    marked = lines.join(started, blocks.PLACE, "left").join(over, blocks.BLOCK, "left")
    marked = marked.withColumns({"seen": F.coalesce(seen, F.col("over")), "gap": gap})
    inside = F.struct("block_start", "line") <= F.struct(F.col("seen.end.end_block"), F.col("seen.end.end_line"))
    marked = marked.withColumn("seen", F.when(inside, F.col("seen")))
    parts = marked.filter(F.col("seen").isNotNull())
    piece = F.struct("block_start", "line", F.concat(F.when(F.col("span").isNull(), F.repeat(F.lit("\n"), F.col("gap"))).otherwise(""), F.col("raw")).alias("text"))
    joined = parts.groupBy("source_file", "seen.block_start", "seen.line").agg(F.array_sort(F.collect_list(piece)).alias("pieces"))
    columns = [*blocks.PLACE, "raw"]
    return marked.filter(F.col("seen").isNull()).select(*columns).unionByName(
        joined.select(*blocks.PLACE, F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("raw"))
    )


def stage_csv(spark: SparkSession, paths: Sequence[str], kind: str) -> DataFrame:
    """Rows of CSV files under positional names, numbered per file.

    The text is read once, in splits, and staged as lines. Longer lines are cut to the
    known columns, shorter ones filled with null; blank lines are no rows. The header
    line stays in as row 0, and its number of ``cells`` tells which columns a file
    delivers. Quoted fields may run over line ends: only files that have such fields are
    stitched, block by block. A quote that is never closed makes its own row ``damaged`` and
    no other. The parsed rows are staged, so that each is parsed once.
    """
    names = S.SUBMISSION_COLUMNS[kind]
    lines = _lines(spark, paths)
    opened = materialise(_open_lines(lines), "open-quotes")
    spans, damaged = opened.filter(F.col("end_line").isNotNull()), opened.filter(F.col("end_line").isNull())
    plain = lines
    parts = []
    if not spans.isEmpty():
        touched = small_side(spans.select("source_file").distinct())
        plain = lines.join(touched, "source_file", "left_anti")
        stitched = materialise(_stitched(lines.join(touched, "source_file", "left_semi"), spans), "stitched-lines")
        in_block = Window.partitionBy("source_file", "block_start").orderBy("line")
        parts.append(stitched.withColumn("place", F.row_number().over(in_block).cast("bigint")))
    columns = ["source_file", "block_start", "line", "raw", "place"]
    parts = [number_rows(p.select(*columns), "source_file", "block_start", "place", "_n") for p in [plain, *parts]]
    records = reduce(DataFrame.unionByName, parts).withColumn("row_index", F.col("_n") - 1)
    stray = small_side(damaged.select("source_file", "block_start", "line", F.lit(True).alias("damaged")))
    records = records.join(stray, ["source_file", "block_start", "line"], "left")
    schema = ", ".join(f"{n} string" for n in names)
    parsed = F.from_csv(F.regexp_replace("raw", "^\ufeff", ""), schema, {"escape": '"', "quote": '"', "sep": ","})
    unquoted = F.regexp_replace(F.replace("raw", F.lit('""')), '"[^"]*"', "q")
    cells = F.when(F.col("row_index") == 0, F.size(F.split(unquoted, ",")))
    rows = records.select(
        parsed.alias("r"), "source_file", "row_index", cells.alias("cells"), F.coalesce("damaged", F.lit(False)).alias("damaged")
    ).select(*[f"r.{n}" for n in names], "source_file", "row_index", "cells", "damaged")
    return materialise(rows, "staged-rows")


def file_headers(staged: DataFrame, kind: str, empty_files: DataFrame | None = None) -> DataFrame:
    """One row per file: delivered width, header cells, and the required columns it
    lacks. A file without data rows keeps its own header texts as names, and one of
    ``empty_files`` has no column."""
    names = S.SUBMISSION_COLUMNS[kind]
    required = S.REQUIRED_COLUMNS.get(kind, [])
    headers = staged.filter("row_index = 0").select(
        "source_file", F.least(F.col("cells"), F.lit(len(names))).alias("width"), F.array(*names).alias("header")
    )
    filled = staged.groupBy("source_file").agg((F.max("row_index") > 0).alias("has_rows"))
    found = headers.join(filled, "source_file")
    if empty_files is not None:
        found = found.unionByName(
            empty_files.select(
                "source_file", F.lit(0).alias("width"), F.array().cast("array<string>").alias("header"), F.lit(False).alias("has_rows")
            )
        )
    positions = F.array(*[F.lit(c) for c in required]).cast("array<string>")
    lacking = F.filter(
        positions,
        lambda c: F.when(
            F.col("has_rows"), F.array_position(F.array(*[F.lit(n) for n in names]), c) > F.col("width")
        ).otherwise(~F.coalesce(F.array_contains("header", c), F.lit(False))),
    )
    return found.select("source_file", "width", "header", "has_rows", lacking.alias("missing"))


def data_rows(staged: DataFrame) -> DataFrame:
    return staged.filter("row_index > 0")


def header_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """First line of every file: ``source_file, line``."""
    lines = spark.read.text(list(paths)).select(
        file_address().alias("source_file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("position"),
        "value",
    )
    return (
        lines.filter("block_start = 0")
        .groupBy("source_file")
        .agg(F.min_by("value", "position").alias("line"))
    )


def separator_of(line: Column) -> Column:
    """Pipe when the header line has more than one of them, else tab."""
    return F.when(F.length(line) - F.length(F.replace(line, F.lit(_PIPE))) > 1, _PIPE).otherwise(_TAB)


def read_gazetteer(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Gazetteer files as text columns under normalised headers.

    One scan: every line meets its file's header by a join and is split by that header's
    separator. Only the distinct headers, which are few layouts, come to the driver, to
    name the columns. Files without a line have no rows.
    """
    headers = materialise(header_lines(spark, paths).withColumn("sep", separator_of(F.col("line"))), "gazetteer-headers")
    layouts = headers.select("sep", "line").distinct().collect()
    named = [normalised_headers(h.line.lstrip("\ufeff").split(h.sep)) for h in layouts]
    lines = spark.read.text(list(paths)).select("value", file_address().alias("source_file")).filter(F.trim("value") != "")
    rows = lines.join(small_side(headers), "source_file").filter(F.col("value") != F.col("line"))
    width = max((len(n) for n in named), default=0)
    schema = ", ".join(f"c{i} string" for i in range(max(width, 1)))
    cells = F.when(F.col("sep") == _PIPE, F.from_csv("value", schema, {"sep": _PIPE})).otherwise(F.from_csv("value", schema, {"sep": _TAB}))
    split = rows.select(cells.alias("c"), "sep", "line", "source_file")
    columns = list(dict.fromkeys(n for names in named for n in names)) or [name for name, _ in S.GAZETTEER_COLUMN_MAP]

    def value(column: str) -> Column:
        out = F.lit(None).cast("string")
        for layout, names in zip(layouts, named):
            if column in names:
                same = (F.col("sep") == layout.sep) & (F.col("line") == layout.line)
                out = F.when(same, F.col(f"c.c{names.index(column)}")).otherwise(out)
        return out

    return split.select(*[value(c).alias(c) for c in columns], "source_file")


def with_manifest(rows: DataFrame, manifest: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Attach per-file context (organisation, file id, year) to every row."""
    return rows.join(small_side(manifest.select("source_file", *columns)), "source_file")
