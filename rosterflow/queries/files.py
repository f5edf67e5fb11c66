"""Round trips through files that Spark writes from the driver tables."""

from __future__ import annotations

import io
import struct
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterflow import schemas as S
from rosterflow.operators.reshape import promote_header
from rosterflow.operators.validate import damaged_issues, header_issues
from rosterflow.plans import submissions
from rosterflow.plans.geography import boundary_table
from rosterflow.plans.geography import gazetteer_table as gazetteer
from rosterflow.plans.jobs import load_boundaries, load_uploads
from rosterflow.queries.registry import Tables, query
from rosterflow.queries.submissions import PLACES_SQL, places
from rosterflow.session import fresh_path, ship
from rosterflow.sinks.tables import replaced_rows, replace_files, stored_files, with_point, write_table
from rosterflow.sources.boundaries import read_boundaries, read_geojson
from rosterflow.sources.delimited import data_rows, file_headers, files_without_rows, read_csv, read_gazetteer, stage_csv
from rosterflow.sources.paths import plain_address
from rosterflow.sources.workbook import decode_contents
from rosterflow.streaming.intake import folder_writer, stream_rows

#: Rows of a shapefile layer at most.
LAYER_ROWS = 10_000
#: Rows of a damaged file, about, if all rows are of one part.
FILE_ROWS = 20_000


def customer_upload(t: Tables) -> DataFrame:
    """Customers as provider submission rows under canonical names, all text."""
    values = {
        "ssa_state_county_code": F.col("c_custkey").cast("string"),
        "name_of_physician_or_mid_level_practitioner": F.col("c_name"),
        "npi": F.lpad(F.col("c_custkey").cast("string"), 10, "1"),
        "specialty": F.col("c_mktsegment"),
        "specialty_code": F.col("c_nationkey").cast("string"),
        "provider_street_address": F.concat(F.lit('12 "Main" St, Apt '), F.col("c_custkey").cast("string")),
        "accepts_new_patients": F.when(F.col("c_custkey") % 2 == 0, "Y").otherwise("n"),
    }
    return t.customer.select(
        [values.get(c, F.lit(None)).cast("string").alias(c) for c in S.PROVIDER_COLUMNS]
    )


@query("""
SELECT CASE WHEN length(CAST(c_custkey AS VARCHAR)) <= 5 THEN lpad(CAST(c_custkey AS VARCHAR), 5, '0') ELSE CAST(c_custkey AS VARCHAR) END AS ssa_state_county_code,
       c_name AS provider_name, lpad(CAST(c_custkey AS VARCHAR), 10, '1') AS npi, c_mktsegment AS specialty,
       CASE WHEN length(CAST(c_nationkey AS VARCHAR)) <= 3 THEN lpad(CAST(c_nationkey AS VARCHAR), 3, '0') ELSE CAST(c_nationkey AS VARCHAR) END AS specialty_code,
       '12 "Main" St, Apt ' || CAST(c_custkey AS VARCHAR) AS street, c_custkey % 2 = 0 AS accepts_new_patients, 2025 AS source_year
FROM customer
""")
def io_roundtrip_csv(t):
    folder = fresh_path(t.spark, "csv")
    customer_upload(t).write.options(header=True, escape='"').csv(folder)
    typed = submissions.provider_rows(data_rows(stage_csv(t.spark, [folder], "provider")).withColumn("source_year", F.lit(2025)))
    return typed.select(
        "ssa_state_county_code",
        F.col("name_of_physician_or_mid_level_practitioner").alias("provider_name"),
        "npi",
        "specialty",
        "specialty_code",
        F.col("provider_street_address").alias("street"),
        "accepts_new_patients",
        "source_year",
    )


@query("""
SELECT count(*) AS n, count(*) AS positions, count(*) AS last_positions, 0::BIGINT AS lacking FROM customer
""")
def io_row_numbers(t):
    """Row numbers of staged files: as many as rows, 1 to n in every file."""
    folder = fresh_path(t.spark, "csv")
    customer_upload(t).repartition(5).write.options(header=True, escape='"').csv(folder)
    staged = stage_csv(t.spark, [folder], "provider")
    files = (
        data_rows(staged)
        .groupBy("source_file")
        .agg(F.count(F.lit(1)).alias("n"), F.countDistinct("row_index").alias("d"), F.max("row_index").alias("m"))
    )
    lacking = file_headers(staged, "provider").select("source_file", F.size("missing").alias("k"))
    return files.join(lacking, "source_file").agg(
        F.sum("n").alias("n"),
        F.sum("d").alias("positions"),
        F.sum("m").alias("last_positions"),
        F.sum("k").alias("lacking"),
    )


def write_parts(rows: DataFrame, folder: str, header: str, file_rows: int = FILE_ROWS) -> None:
    """``part, key, line`` as files of bounded size, dealt by a hash of the key: the header,
    then every line and a blank one after it, in order."""
    files = -(-rows.count() // file_rows)
    dealt = rows.select("part", F.pmod(F.xxhash64("key"), F.lit(max(files, 1))).alias("file"), F.concat("line", F.lit("\n")).alias("value"))
    headers = dealt.select("part", "file").distinct().select("part", "file", F.lit(header).alias("value"), F.lit(0).alias("place"))
    lines = headers.unionByName(dealt.withColumn("place", F.lit(1))).repartition("part", "file")
    ordered = lines.sortWithinPartitions("part", "file", "place", "value").drop("place")
    ordered.write.partitionBy("part", "file").text(folder)


@query("""
WITH f AS (SELECT c_custkey, c_name, 'part' || CAST(c_nationkey % 4 AS VARCHAR) || '.csv' AS source_file FROM customer),
kept AS (SELECT source_file, c_custkey, c_name, c_custkey % 7 = 0 AS open FROM f)
SELECT source_file, 'row' AS kind, CAST(c_custkey AS VARCHAR) AS code, CASE WHEN NOT open THEN c_name || CASE WHEN c_custkey % 5 = 0 THEN chr(10) || 'line, two' ELSE '' END END AS detail FROM kept
UNION ALL SELECT source_file, 'issue', CAST(c_custkey AS VARCHAR), 'Quoted value is not closed' FROM kept WHERE open
UNION ALL SELECT 'part4.csv', 'row', CAST(c_custkey AS VARCHAR), c_name || chr(10) || 'line, two' FROM customer
UNION ALL SELECT 'zero.csv', 'issue', '0', 'Missing required columns: ssa_state_county_code, name_of_physician_or_mid_level_practitioner, npi, specialty_code, provider_street_address, provider_city, provider_state, provider_zip_code'
""")
def io_damaged_csv(t):
    """Customers in files with unclosed quotes, quoted line ends, blank lines and a blank
    last header, all of them again in files whose every row runs over a line end, beside a
    file without a byte: every row and every issue of the files."""
    folder = fresh_path(t.spark, "csv")
    name = F.when(F.col("c_custkey") % 7 == 0, F.concat(F.lit('"'), "c_name")).when(
        F.col("c_custkey") % 5 == 0, F.concat(F.lit('"'), "c_name", F.lit('\nline, two"'))
    ).otherwise(F.col("c_name"))
    line = F.concat_ws(",", F.col("c_custkey").cast("string"), name)
    header = ",".join(["h"] * (len(S.PROVIDER_COLUMNS) - 1) + [""])
    rows = t.customer.select((F.col("c_nationkey") % 4).alias("part"), F.col("c_custkey").alias("key"), line.alias("line"))
    over = F.concat_ws(",", F.col("c_custkey").cast("string"), F.concat(F.lit('"'), "c_name", F.lit('\nline, two"')))
    rows = rows.unionByName(t.customer.select(F.lit(4).cast("bigint").alias("part"), F.col("c_custkey").alias("key"), over.alias("line")))
    write_parts(rows, f"{folder}/parts", header)
    fs = t.spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs.getFileSystem(t.spark._jsc.hadoopConfiguration()).create(t.spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/zero.csv")).close()
    paths = [f"{folder}/parts/part=*/file=*", f"{folder}/zero.csv"]
    staged = stage_csv(t.spark, paths, "provider")
    headers = file_headers(staged, "provider", files_without_rows(t.spark, paths, staged))
    address = F.col("source_file")
    file = F.when(address.endswith("zero.csv"), "zero.csv").otherwise(F.concat(F.lit("part"), F.regexp_extract(address, "/part=([0-9])/[^/]*/[^/]*$", 1), F.lit(".csv")))
    rows = data_rows(staged).withColumn("file", file)
    code, read = F.col("ssa_state_county_code"), F.col("name_of_physician_or_mid_level_practitioner")
    issues = header_issues(headers).select(file.alias("source_file"), F.lit("issue").alias("kind"), F.col("row_index").cast("string").alias("code"), F.col("message").alias("detail"))
    found = damaged_issues(rows).join(rows.select("source_file", "row_index", "file", code.alias("code")), ["source_file", "row_index"])
    return (
        rows.select(F.col("file").alias("source_file"), F.lit("row").alias("kind"), code.alias("code"), F.when(~F.col("damaged"), read).alias("detail"))
        .unionByName(issues)
        .unionByName(found.select(F.col("file").alias("source_file"), F.lit("issue").alias("kind"), "code", F.col("message").alias("detail")))
    )


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def io_generic_load(t):
    source, target = fresh_path(t.spark, "csv"), fresh_path(t.spark, "table")
    t.supplier.write.option("header", True).csv(source)
    write_table(read_csv(t.spark, source).transform(lambda df: df), target)
    stored = t.spark.read.parquet(target)
    return stored.select(
        F.col("s_suppkey").cast("bigint"), "s_name", F.col("s_nationkey").cast("int"), "s_acctbal"
    )


@query(f"SELECT *, intptlong AS point_lon, intptlat AS point_lat FROM ({PLACES_SQL})")
def io_gazetteer_sniff(t):
    """Half the places pipe-delimited with one more column, half tab-delimited."""
    delivered = places(t).toDF("GEOID", "NAME", "INTPTLAT", "INTPTLONG", "ALAND", "AWATER", "ALAND_SQMI")
    pipe, tab = fresh_path(t.spark, "places"), fresh_path(t.spark, "places")
    first = F.pmod(F.xxhash64("NAME"), F.lit(2)) == 0
    delivered.filter(first).withColumn("FUNCSTAT", F.lit("S")).write.options(header=True, sep="|").csv(pipe)
    delivered.filter(~first).toDF(*[f" {c} " for c in delivered.columns]).write.options(header=True, sep="\t").csv(tab)
    out = with_point(gazetteer(read_gazetteer(t.spark, [pipe, tab]), 2025), "intptlong", "intptlat", "geom")
    return out.withColumns({"point_lon": F.col("geom.lon"), "point_lat": F.col("geom.lat")}).drop("geom")


@query("""
SELECT c_custkey, c_custkey // 5000 AS file, row_number() OVER (PARTITION BY c_custkey // 5000 ORDER BY c_custkey) AS row_index FROM customer
""")
def io_numbered_rows(t):
    """Customers in files of 5,000 keys each, by key: the number of every row in its file."""
    folder = fresh_path(t.spark, "csv")
    key = F.col("ssa_state_county_code").cast("bigint")
    rows = customer_upload(t).withColumns({"file": F.floor(key / 5000), "key": key})
    rows.repartition("file").sortWithinPartitions("file", "key").drop("key").write.partitionBy("file").options(header=True, escape='"').csv(folder)
    staged = data_rows(stage_csv(t.spark, [folder], "provider"))
    return staged.select(key.alias("c_custkey"), F.regexp_extract("source_file", "/file=([0-9]+)/", 1).cast("bigint").alias("file"), F.col("row_index").cast("bigint").alias("row_index"))


@query("""
SELECT CAST(s_suppkey AS VARCHAR) AS geoid, s_name || '}, {"[' || CAST(s_suppkey % 3 AS VARCHAR) AS name, 2025 AS source_year,
       CASE WHEN s_suppkey % 2 = 0 THEN 1 + 4 + 4 + (1 + 4 + 4 + 4 + 4 * 16) ELSE 1 + 4 + 4 + 2 * (1 + 4 + 4 + 4 + 4 * 16) END AS geom_bytes, 4269 AS srid
FROM supplier
""")
def io_geojson_blocks(t):
    """Suppliers as features of whole collections, with brackets, braces and quotes in their names: read in blocks,
    loaded as a table of boundaries, and read back."""
    folder = fresh_path(t.spark, "collections")
    ring = F.concat(F.lit("[["), "x", F.lit(",0],["), "x", F.lit(",1],[-1,1],["), "x", F.lit(",0]]"))
    name = F.concat("s_name", F.lit('}, {"['), (F.col("s_suppkey") % 3).cast("string"))
    shape = F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit('"Polygon", "coordinates": ['), ring, F.lit("]"))).otherwise(
        F.concat(F.lit('"MultiPolygon", "coordinates": [['), ring, F.lit("], ["), ring, F.lit("]]"))
    )
    properties = F.to_json(F.struct(F.col("s_suppkey").cast("string").alias("GEOID"), name.alias("NAME")))
    feature = F.concat(F.lit('{"type": "Feature", "properties": '), properties, F.lit(', "geometry": {"type": '), shape, F.lit("}}"))
    files = max(1, -(-t.supplier.count() // FILE_ROWS))
    dealt = t.supplier.withColumn("x", F.col("s_nationkey").cast("string")).select(F.pmod(F.xxhash64("s_suppkey"), F.lit(files)).alias("file"), F.col("s_suppkey").alias("key"), feature.alias("value"))
    first = F.row_number().over(Window.partitionBy("file").orderBy("key")) == 1
    lines = dealt.select("file", F.lit(1).alias("place"), "key", F.concat(F.when(first, "").otherwise(","), "value").alias("value"))
    around = [(0, '{"type": "FeatureCollection", "title": "} \\" [", "features": ['), (2, '], "crs": {"type": "name", "properties": {"name": "urn:ogc:def:crs:EPSG::4269"}}}')]
    ends = [dealt.select("file").distinct().select("file", F.lit(place).alias("place"), F.lit(None).cast("bigint").alias("key"), F.lit(text).alias("value")) for place, text in around]
    ordered = lines.unionByName(ends[0]).unionByName(ends[1]).repartition("file").sortWithinPartitions("file", "place", "key")
    ordered.select("file", "value").write.partitionBy("file").text(f"{folder}/all.geojson")
    load_boundaries(t.spark, f"{folder}/all.geojson", 2025, f"{folder}/table")
    srid = read_geojson(t.spark, [f"{folder}/all.geojson"]).select(F.col("properties")["GEOID"].alias("geoid"), "srid")
    stored = t.spark.read.parquet(f"{folder}/table")
    return stored.select("geoid", "name", "source_year", F.octet_length("geom").alias("geom_bytes")).join(srid, "geoid")


@query("""
SELECT 'row' AS kind, c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 2 ELSE 1 END AS n FROM customer
UNION ALL SELECT 'duplicate', c_custkey, 1 FROM customer WHERE c_custkey % 5 = 0
""")
def io_stream_folder(t):
    """Customers' submissions that arrive in a folder, a fifth of them twice: rows and duplicates by batch."""
    root, rows = fresh_path(t.spark, "arrivals"), customer_upload(t)
    again = rows.filter(F.col("ssa_state_county_code").cast("bigint") % 5 == 0)
    rows.unionByName(again).write.options(header=True, escape='"').csv(f"{root}/in")
    # two rows of one file are told apart by a number of their own
    arrived = stream_rows(t.spark, f"{root}/in", "provider", lambda df: df.withColumn("arrival", F.expr("uuid()")))
    folder_writer(arrived, f"{root}/out", f"{root}/checkpoint", ["ssa_state_county_code"], ["source_file", "arrival"]).trigger(availableNow=True).start().awaitTermination()

    def counted(kind: str, name: str) -> DataFrame:
        found = t.spark.read.parquet(f"{root}/out/{name}")
        return found.groupBy(F.col("ssa_state_county_code").cast("bigint").alias("c_custkey")).agg(F.count(F.lit(1)).cast("int").alias("n")).select(F.lit(kind).alias("kind"), "c_custkey", "n")

    return counted("row", "rows").unionByName(counted("duplicate", "duplicates"))


_TYPES = '<?xml version="1.0"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"/>'
_BOOK = (
    '<?xml version="1.0"?><workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    ' xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>{}</sheets></workbook>'
)
_LINKS = (
    '<?xml version="1.0"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{}</Relationships>'
)
_SHEET = '<?xml version="1.0"?><worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{}</sheetData></worksheet>'


def _cell_xml(value) -> str:
    if value is None:
        return "<c/>"
    if isinstance(value, bool):
        return f'<c t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (int, float)):
        return f"<c><v>{value}</v></c>"
    return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(str(value))}</t></is></c>'


def workbook_bytes(sheets: dict[str, list[list]]) -> bytes:
    """Minimal workbook with the given rows of cells per sheet."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        book.writestr("[Content_Types].xml", _TYPES)
        names = [f'<sheet name="{escape(n)}" sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(sheets, 1)]
        links = [f'<Relationship Id="r{i}" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1)]
        book.writestr("xl/workbook.xml", _BOOK.format("".join(names)))
        book.writestr("xl/_rels/workbook.xml.rels", _LINKS.format("".join(links)))
        for i, rows in enumerate(sheets.values(), 1):
            body = "".join(f"<row>{''.join(map(_cell_xml, cells))}</row>" for cells in rows)
            book.writestr(f"xl/worksheets/sheet{i}.xml", _SHEET.format(body))
    return out.getvalue()


def _books_of_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One workbook per batch of rows, under its header."""
    header = [["SSA", "Specialty Code", "TD Customized (YN)", "Balance"]]
    for batch in batches:
        rows = [[int(k), code, flag, float(b)] for k, code, flag, b in batch.itertuples(index=False)]
        yield pd.DataFrame({"path": [f"book-{batch.iloc[0, 0]}"], "content": [workbook_bytes({S.SHEET_CON: header + rows})]})


@query("""
SELECT CAST(s_suppkey AS VARCHAR) AS ssa, s_name AS specialty_code, CASE WHEN s_suppkey % 2 = 0 THEN 'Y' END AS td_customized_yn,
       s_acctbal AS balance, 2025 AS source_year FROM supplier
""")
def io_sheet_rows(t):
    """Suppliers packed into workbooks and unpacked again."""
    rows = t.supplier.select(
        "s_suppkey", "s_name", F.when(F.col("s_suppkey") % 2 == 0, "Y").alias("flag"), "s_acctbal"
    )
    books = rows.mapInPandas(_books_of_batches, "path string, content binary")
    decoded = decode_contents(books).withColumn("source_year", F.lit(2025)).select(*S.SHEET_ROWS.fieldNames())
    wide = promote_header(decoded, S.SHEET_CON).drop("path", "row_idx")
    return wide.withColumn("balance", F.col("balance").cast("double"))


@query("""
SELECT CAST(s_suppkey AS VARCHAR) AS geoid, CASE WHEN s_suppkey % 3 > 0 THEN s_name END AS name, 2025 AS source_year,
       CASE WHEN s_suppkey % 2 = 0 THEN 1 + 4 + 4 + (1 + 4 + 4 + 4 + 4 * 16) ELSE 1 + 4 + 4 + 2 * (1 + 4 + 4 + 4 + 4 * 16) END AS geom_bytes
FROM supplier
""")
def io_boundaries(t):
    """Suppliers as boundary features, one collection per line: polygons and multipolygons."""
    folder = fresh_path(t.spark, "boundaries")
    x = F.col("s_nationkey").cast("string")
    ring = F.concat(F.lit("[["), x, F.lit(",0],["), x, F.lit(",1],[-1,1],["), x, F.lit(",0]]"))
    geometry = F.when(
        F.col("s_suppkey") % 2 == 0, F.concat(F.lit('"Polygon","coordinates":['), ring, F.lit("]"))
    ).otherwise(F.concat(F.lit('"MultiPolygon","coordinates":[['), ring, F.lit("],["), ring, F.lit("]]")))
    name = F.when(F.col("s_suppkey") % 3 > 0, F.concat(F.lit(',"Name":"'), "s_name", F.lit('"'))).otherwise("")
    line = F.concat(
        F.lit('{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"geoid":"'),
        F.col("s_suppkey").cast("string"),
        F.lit('"'),
        name,
        F.lit('},"geometry":{"type":'),
        geometry,
        F.lit("}}]}"),
    )
    t.supplier.select(line.alias("value")).write.text(folder)
    table = boundary_table(read_geojson(t.spark, [folder], one_per_line=True), 2025)
    return table.select("geoid", "name", "source_year", F.octet_length("geom").alias("geom_bytes"))


@F.pandas_udf(T.DoubleType())
def _little_double(values: pd.Series) -> pd.Series:
    return values.map(lambda v: struct.unpack("<d", bytes(v))[0])


def _layer(rows: pd.DataFrame) -> dict[str, bytes]:
    """Parts of the layer that holds rows of ``n_nationkey, s_suppkey, s_name``."""
    shapes, records = [], []
    for number, (x, key, name) in enumerate(rows.itertuples(index=False), 1):
        ring = [x, 0, x, 1, x + 1, 1, x + 1, 0, x, 0]
        content = struct.pack("<I4d2I", 5, 0, 0, 1, 1, 1, 5) + struct.pack("<I10d", 0, *ring)
        shapes.append(struct.pack(">2I", number, len(content) // 2) + content)
        records.append((b"*" if key % 5 == 0 else b" ") + str(key).ljust(10).encode() + f"ñ{name}".encode("latin-1").ljust(30))
    fields = [("GEOID", 10), ("NAME", 30)]
    described = b"".join(f.encode().ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([w]) + b"\0" * 15 for f, w in fields) + b"\r"
    header = struct.pack("<4BIHH20x", 3, 0, 0, 0, len(rows), 32 + len(described), 41)
    return {
        "shp": b"\0" * 100 + b"".join(shapes),
        "dbf": header + described + b"".join(records),
        "cpg": b"ISO-8859-1",
        "prj": b'GEOGCS["GCS_North_American_1983"]',
    }


def write_layers(rows: DataFrame, folder: str, layer_rows: int = LAYER_ROWS) -> None:
    """Rows as layers of at most ``layer_rows`` each, written where the rows are.

    A layer is named by its partition and its place there, so a task that runs again
    writes the same files.
    """

    def written(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = fs.FileSystem.from_uri(plain_address(folder))
        place, number = f"{root}/{TaskContext.get().partitionId()}", 0
        system.create_dir(place)
        for batch in batches:
            for start in range(0, len(batch), layer_rows):
                for suffix, content in _layer(batch.iloc[start : start + layer_rows]).items():
                    with system.open_output_stream(f"{place}/layer{number}.{suffix}") as out:
                        out.write(content)
                number += 1
        yield pd.DataFrame({"layers": [number]})

    rows.mapInPandas(written, "layers long").write.format("noop").mode("overwrite").save()


@query("""
SELECT CAST(s_suppkey AS VARCHAR) AS geoid, 'ñ' || s_name AS name, 2025 AS source_year,
       CAST(s_nationkey AS DOUBLE) AS x0, CAST(s_nationkey + 1 AS DOUBLE) AS x1 FROM supplier WHERE s_suppkey % 5 <> 0
""")
def io_shapefile(t):
    """Suppliers as a folder of layers of bounded size, a fifth of the records deleted, names
    in another code page; the corners of every square are compared."""
    folder = fresh_path(t.spark, "layers")
    ship(t.spark)
    write_layers(t.supplier.select(F.col("s_nationkey").cast("int"), "s_suppkey", "s_name"), folder)
    table = boundary_table(read_boundaries(t.spark, folder), 2025)
    # one polygon of one ring: its points begin after 9 + 9 + 4 bytes
    corners = [_little_double(F.substring("geom", 23 + 16 * i, 8)) for i in (0, 2)]
    return table.select("geoid", "name", "source_year", corners[0].alias("x0"), corners[1].alias("x1"))


def write_books(rows: DataFrame, folder: str, book_rows: int = LAYER_ROWS) -> None:
    """Rows as workbooks of at most ``book_rows`` each under a header, written where the rows are."""
    names = rows.columns

    def written(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = fs.FileSystem.from_uri(plain_address(folder))
        system.create_dir(root)
        number, task = 0, TaskContext.get().partitionId()
        for batch in batches:
            for start in range(0, len(batch), book_rows):
                cells = batch.iloc[start : start + book_rows].astype(object).where(lambda df: df.notna(), None).values.tolist()
                with system.open_output_stream(f"{root}/book-{task}-{number}.xlsx") as out:
                    out.write(workbook_bytes({"rows": [names, *cells]}))
                number += 1
        yield pd.DataFrame({"books": [number]})

    rows.mapInPandas(written, "books long").write.format("noop").mode("overwrite").save()


@query("""
SELECT CASE WHEN length(CAST(c_custkey AS VARCHAR)) <= 5 THEN lpad(CAST(c_custkey AS VARCHAR), 5, '0') ELSE CAST(c_custkey AS VARCHAR) END AS ssa_state_county_code,
       c_name AS provider_name, CASE WHEN c_nationkey % 2 = 0 THEN 'csv' ELSE 'xlsx' END AS kind, c_custkey % 2 = 0 AS accepts_new_patients, 'org-' || CASE WHEN c_nationkey % 2 = 0 THEN 'csv' ELSE 'xlsx' END AS organization_id
FROM customer
""")
def io_mixed_uploads(t):
    """Customers uploaded as CSV files and as workbooks, loaded by one job."""
    folder, rows = fresh_path(t.spark, "uploads"), customer_upload(t)
    ship(t.spark)
    even = F.col("specialty_code").cast("int") % 2 == 0
    rows.filter(even).write.options(header=True, escape='"').csv(f"{folder}/csv")
    write_books(rows.filter(~even), f"{folder}/xlsx")
    files = [(plain_address(f), kind) for kind in ("csv", "xlsx") for f in t.spark.read.format("binaryFile").load(f"{folder}/{kind}").inputFiles()]
    manifest = t.spark.createDataFrame([(f, kind, f"org-{kind}", f"{kind}-{i}") for i, (f, kind) in enumerate(files)], "source_file string, kind string, organization_id string, source_file_id string")
    load_uploads(t.spark, manifest, "org_provider", f"{folder}/table", [f for f, _ in files])
    stored = stored_files(t.spark, f"{folder}/table")
    return stored.select("ssa_state_county_code", "provider_name", F.substring_index("source_file_id", "-", 1).alias("kind"), "accepts_new_patients", "organization_id")


@query("""
SELECT o_custkey, o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'
AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
UNION ALL
SELECT o_custkey, o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'O'
AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
""")
def replace_by_file(t):
    orders = t.orders.select("o_custkey", "o_orderkey", "o_orderstatus")
    ids = t.customer.filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    new = orders.filter("o_orderstatus = 'O'").join(ids, "o_custkey", "left_semi")
    return replaced_rows(orders.filter("o_orderstatus = 'F'"), new, ids, "o_custkey")


@query("""
WITH ids AS (SELECT n_name, n_nationkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey)
SELECT n_name AS source_file_id, c_custkey, 'first' AS load FROM customer JOIN ids ON c_nationkey = n_nationkey WHERE r_name NOT IN ('ASIA', 'EUROPE')
UNION ALL
SELECT n_name, c_custkey, 'second' FROM customer JOIN ids ON c_nationkey = n_nationkey WHERE r_name = 'ASIA' AND c_acctbal > 0
""")
def io_replace_files(t):
    """A table loaded once, then with Asia's files replaced and Europe's emptied."""
    target = fresh_path(t.spark, "uploads")
    books = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("source_file_id"), "r_name"
    )
    rows = t.customer.join(books, "c_nationkey").select("source_file_id", "c_custkey", "c_acctbal", "r_name")
    columns = ["source_file_id", "c_custkey"]
    replace_files(rows.select(*columns, F.lit("first").alias("load")), target, books.select("source_file_id"))
    again = rows.filter("r_name = 'ASIA' AND c_acctbal > 0").select(*columns, F.lit("second").alias("load"))
    replace_files(again, target, books.filter("r_name IN ('ASIA', 'EUROPE')").select("source_file_id"))
    return stored_files(t.spark, target).select("source_file_id", "c_custkey", "load")
