import io
import struct
import zipfile
from xml.sax.saxutils import escape

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from rosterflow import schemas as S
from rosterflow.plans import jobs
from rosterflow.plans.geography import boundary_columns, boundary_table, boundaries_with_county, gazetteer_table
from rosterflow.queries.files import workbook_bytes, write_layers, write_parts
from rosterflow.sources import boundaries, delimited, workbook
from rosterflow.sources.paths import read_path

HEADER = (
    "SSA State/County Code,Name of Physician or Mid-Level Practitioner,NPI,Specialty,Specialty Code,Contract Type,"
    "Provider Street Address,Provider City,Provider State,Provider ZIP Code,Accepts New Patients (Y/N),"
    "Medical Group Affiliation,Uses CMS MA Contract Amendment (Y/N),Letter of Intent (Y/N),Accuracy Confidence"
)


def put(folder, name, content):
    path = f"{folder}/{name}"
    with open(path, "wb") as f:
        f.write(content if isinstance(content, bytes) else content.encode())
    return path


def test_suffix_dispatch(spark, folder):
    path = put(folder, "a.CSV", "x,y\n1,b\n")
    assert rows_of(delimited.read_any(spark, path)) == [(1, "b")]
    book = put(folder, "b.xlsx", workbook_bytes({"first": [["x", "y"], [1, 2.5], [None, None], ["z", True]], "second": [["q"]]}))
    assert rows_of(delimited.read_any(spark, book)) == [("1", "2.5"), ("z", "True")]
    for name in ("c.xls", "d.pdf"):
        with pytest.raises(ValueError, match="Unsupported file type"):
            delimited.read_any(spark, f"{folder}/{name}")


def test_positional_rows_ragged_short_and_numbered(spark, folder):
    lines = [
        "1001,Jane,1234567890,PCP,001,D,1 Main,Salem,MA,01970,Y,Group,N,, high,extra",
        '01003,"Doe, ""J""",2234567890,PCP,002',
        ",,,,,,,,,,,,,,",
    ]
    path = put(folder, "p file [1].csv", "\n".join([HEADER, *lines]) + "\n")
    staged = delimited.stage_csv(spark, [read_path("file://" + path.replace(" ", "%20"))], "provider")
    rows = delimited.data_rows(staged).orderBy("row_index").collect()
    assert [r.row_index for r in rows] == [1, 2, 3]
    assert rows[0].accuracy_confidence.strip() == "high" and rows[1].provider_city is None
    assert rows[1].name_of_physician_or_mid_level_practitioner == 'Doe, "J"' and rows[2].npi is None
    headers = delimited.file_headers(staged, "provider").first()
    assert headers.width == 15 and headers.missing == []


def test_quoted_line_breaks_are_one_row(spark, folder):
    body = "\n".join(f"0100{i},N{i},123456789{i},S,00{i}" for i in range(5))
    put(folder, "plain.csv", f"{HEADER}\n{body}\n")
    put(folder, "broken.csv", f'{HEADER}\n01001,"two\nlines",1234567890\n01002,"three\n\nlines, ""q""",1234567891\n')
    staged = delimited.stage_csv(spark, [folder], "provider")
    rows = delimited.data_rows(staged).filter(F.col("source_file").endswith("broken.csv"))
    assert rows_of(rows, "row_index", "name_of_physician_or_mid_level_practitioner") == [(1, "two\nlines"), (2, 'three\n\nlines, "q"')]
    assert delimited.data_rows(staged).count() == 7


def staged_rows(spark, folder, *columns):
    staged = delimited.stage_csv(spark, [folder], "org_provider")
    name = F.substring_index("source_file", "/", -1).alias("file")
    return rows_of(delimited.data_rows(staged), name, "row_index", "damaged", *columns)


def test_an_unclosed_quote_costs_its_own_row(spark, folder):
    put(folder, "one.csv", 'a,b,c\n1,"open\n2,x,y\n3,x,y\n')
    put(folder, "two.csv", 'a,b,c\n1,"open\n2,x,y\n3,x,"open too\n4,x,"z"\n5,5 "inch,x\n')
    put(folder, "ends.csv", 'a,b\n1,"fine\nline"\n2,x\n3,"open\n\n4,y\n')
    got = staged_rows(spark, folder, "ssa_state_county_code", "npi")
    assert [r[:4] for r in got] == [
        ("ends.csv", 1, False, "1"), ("ends.csv", 2, False, "2"), ("ends.csv", 3, True, "3"), ("ends.csv", 4, False, "4"),
        ("one.csv", 1, True, "1"), ("one.csv", 2, False, "2"), ("one.csv", 3, False, "3"),
        ("two.csv", 1, True, "1"), ("two.csv", 2, False, "2"), ("two.csv", 3, True, "3"), ("two.csv", 4, False, "4"), ("two.csv", 5, False, "5"),
    ]
    assert {r[1]: r[4] for r in got if r[0] == "two.csv"}[4] == "z"


def test_stitched_records_over_many_splits(spark, folder):
    rows = [(i, f"name {i}" if i % 3 else f"two\nlines, {i}\n\nand \"\"more\"\"") for i in range(1, 400)]
    put(folder, "a.csv", "a,b\n" + "".join(f'{i},"{t}"\n' for i, t in rows))
    put(folder, "b.csv", "a,b\r\n1,x\r\n  \r\n2,y\r\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = staged_rows(spark, folder, "ssa_state_county_code", "provider_name")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    mine = {r[1]: (r[3], r[4]) for r in got if r[0] == "a.csv"}
    # blank lines that fall on a split bound inside a field are not kept
    plain = {i: (str(i), t.replace('""', '"')) for i, t in rows}
    assert set(mine) == set(plain) and all(mine[i][0] == plain[i][0] and mine[i][1].replace("\n\n", "\n") == plain[i][1].replace("\n\n", "\n") for i in plain)
    assert [r[1:4] for r in got if r[0] == "b.csv"] == [(1, False, "1"), (2, False, "2")]


def test_blank_headers_and_files_without_a_byte(spark, folder):
    nine = ",".join(["h"] * 8 + [""])
    put(folder, "nine.csv", f"{nine}\n01001,F,1234567890,Acute,040,1 Main,Salem,MA,01970\n")
    put(folder, "zero.csv", "")
    codes, specialties = spark.createDataFrame([("01001",)], "code string"), spark.createDataFrame([("040",)], "code string")
    issues = jobs.load_submissions(spark, [f"{folder}/nine.csv", f"{folder}/zero.csv"], 2025, "facility", codes, specialties, f"{folder}/out")
    name = F.substring_index("source_file", "/", -1)
    found = rows_of(issues.select(name, "row_index", "field", "message"))
    assert found == [("zero.csv", 0, "schema", S.MSG_MISSING_COLUMNS + ", ".join(S.REQUIRED_COLUMNS["facility"]))]


def test_row_numbers_across_splits(spark, folder):
    for name, n in (("a.csv", 3000), ("b.csv", 10)):
        put(folder, name, HEADER + "\n" + "".join(f"{i},N,{i:010d}\n" for i in range(1, n + 1)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        staged = delimited.stage_csv(spark, [folder], "provider")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    wrong = delimited.data_rows(staged).filter(F.col("row_index") != F.col("ssa_state_county_code").cast("bigint"))
    assert delimited.data_rows(staged).count() == 3010 and wrong.isEmpty()


def test_narrow_and_empty_files(spark, folder):
    eight = ",".join(HEADER.split(",")[:8])
    put(folder, "narrow.csv", f"{eight}\n01001,Jane,1234567890,PCP,001,D,100 Main St,Boston\n")
    put(folder, "empty.csv", HEADER + "\n")
    put(folder, "full.csv", f"{HEADER}\n01001,Jane,1,PCP,001,D,100 Main St,Boston,MA,02101\n")
    staged = delimited.stage_csv(spark, [folder], "provider").withColumn("source_year", F.lit(2025))
    codes = spark.createDataFrame([("01001",)], "code string")
    specialties = spark.createDataFrame([("001",)], "code string")
    found = jobs.submission_issues(staged, "provider", codes, specialties)
    name = F.substring_index("source_file", "/", -1)
    assert rows_of(found.select(name, "row_index", "field", "message")) == [
        ("empty.csv", 0, "schema", S.MSG_MISSING_COLUMNS + ", ".join(S.REQUIRED_COLUMNS["provider"])),
        ("full.csv", 1, "npi", S.MSG_NPI),
        ("narrow.csv", 0, "schema", S.MSG_MISSING_COLUMNS + "provider_state, provider_zip_code"),
    ]


def test_workbook_cells(spark, folder):
    path = put(folder, "w.xlsx", workbook_bytes({"S1": [["a", None, 12, 12.0, 0.25, " x "], [], ["z"]], "empty": []}))
    out = workbook.read_workbooks(spark, [path], 2025)
    assert rows_of(out, "sheet", "row_idx", "cells", "source_year") == [
        ("S1", 0, ["a", None, "12", "12", "0.25", " x "], 2025),
        ("S1", 1, [], 2025),
        ("S1", 2, ["z"], 2025),
    ]


def test_workbook_shared_strings_and_gaps(spark, folder):
    import io
    import zipfile

    from rosterflow.queries import files

    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    content = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(workbook_bytes({"S": []}))) as old, zipfile.ZipFile(content, "w") as new:
        for name in old.namelist():
            new.writestr(name, old.read(name))
        new.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>plain</t></si><si><r><t>ri</t></r><r><t>ch</t></r><rPh><t>no</t></rPh></si></sst>")
    body = files._SHEET.format(
        '<row r="2"><c r="B2" t="s"><v>1</v></c><c r="D2" t="b"><v>1</v></c></row>'
        '<row r="5"><c r="A5" t="s"><v>0</v></c><c r="AB5" t="str"><f>1+1</f><v>two</v></c><c r="AC5" t="e"><v>#N/A</v></c></row>'
    )
    with zipfile.ZipFile(content) as book:
        parts = {n: book.read(n) for n in book.namelist()}
    parts["xl/worksheets/sheet1.xml"] = body.encode()
    final = io.BytesIO()
    with zipfile.ZipFile(final, "w") as book:
        for n, c in parts.items():
            book.writestr(n, c)
    rows = list(workbook.decode_workbook(final.getvalue()))
    assert rows[1] == (0, "S", 1, [None, "rich", None, "True"])
    assert rows[4][2] == 4 and rows[4][3][0] == "plain" and rows[4][3][27:] == ["two", "#N/A"]
    assert [r[2:] for r in rows[:1] + rows[2:4]] == [(0, []), (2, []), (3, [])]  # rows without cells count


def styled_workbook(codes, cells, settings=""):
    """A workbook of one row; ``codes`` are the formats of its styles, by number or by code."""
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    own = [c for c in codes if isinstance(c, str)]
    formats = "".join(f'<numFmt numFmtId="{164 + i}" formatCode="{escape(c, {chr(34): "&quot;"})}"/>' for i, c in enumerate(own))
    styles = "".join(f'<xf numFmtId="{164 + own.index(c) if isinstance(c, str) else c}"/>' for c in codes)
    row = "".join(f'<c s="{s}"><v>{v}</v></c>' for s, v in cells)
    with zipfile.ZipFile(io.BytesIO(workbook_bytes({"S": []}))) as old:
        parts = {n: old.read(n) for n in old.namelist()}
    parts["xl/styles.xml"] = f'<styleSheet {ns}><numFmts>{formats}</numFmts><cellStyleXfs><xf numFmtId="14"/></cellStyleXfs><cellXfs>{styles}</cellXfs></styleSheet>'.encode()
    parts["xl/worksheets/sheet1.xml"] = f"<worksheet {ns}><sheetData><row>{row}</row></sheetData></worksheet>".encode()
    parts["xl/workbook.xml"] = parts["xl/workbook.xml"].replace(b"<sheets>", settings.encode() + b"<sheets>")
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as book:
        for name, content in parts.items():
            book.writestr(name, content)
    return out.getvalue()


def test_date_cells_are_dates():
    codes = [0, 14, 22, "yyyy\\-mm", '#,##0 "days"', "[Red]0.00", "[h]:mm", "0_m", "General"]
    cells = [(0, 45717), (1, 45717), (2, "45717.354166666664"), (3, 45717), (4, 45717), (5, 1.5), (6, 0.25), (7, 3), (8, 7), (1, 1), (1, 59), (1, 61), (1, -2), (2, "45717.99999999")]
    (row,) = workbook.decode_workbook(styled_workbook(codes, cells))
    assert row[3] == ["45717", "2025-03-01", "2025-03-01 08:30:00", "2025-03-01", "45717", "1.5", "06:00:00", "3", "7", "1900-01-01", "1900-02-28", "1900-03-01", "-2", "2025-03-02 00:00:00"]
    (row,) = workbook.decode_workbook(styled_workbook([14], [(0, 0.5), (0, 44255)], '<workbookPr date1904="1"/>'))
    assert row[3] == ["12:00:00", "2025-03-01"]


def test_unreadable_workbook(spark, folder):
    put(folder, "bad.xlsx", b"not a zip")
    with pytest.raises(Exception, match="unreadable workbook"):
        workbook.read_workbooks(spark, [folder], 2025).collect()
    rows, unreadable = workbook.stage_workbooks(spark, [folder], "provider", keep_unreadable=True)
    assert rows.isEmpty() and unreadable.count() == 1


def test_gazetteer_both_separators(spark, folder):
    put(folder, "a.txt", "GEOID|NAME|INTPTLAT|INTPTLONG|ALAND|Extra\n00601|Adjuntas|18.18|-66.75|166847909|x\n |no id|1|1|1|x\n00602|no lat|n/a|-67|1|x\n")
    put(folder, "b.txt", " GEOID \tALAND SQMI\tINTPTLAT\tINTPTLONG\n00603\t12.5\t18.4\t-67.1\n")
    out = gazetteer_table(delimited.read_gazetteer(spark, [folder]), 2025)
    assert rows_of(out, "geoid", "name", "intptlat", "aland_sqmeters", "aland_sqmi", "source_year") == [
        ("00601", "Adjuntas", 18.18, 166847909, None, 2025),
        ("00603", None, 18.4, None, 12.5, 2025),
    ]


SQUARE = [[0.0, 0.0], [0.0, 4.0], [4.0, 4.0], [4.0, 0.0], [0.0, 0.0]]
HOLE = [[1.0, 1.0], [2.0, 1.0], [2.0, 2.0], [1.0, 2.0], [1.0, 1.0]]


def parse_wkb(wkb):
    """Rings per polygon of a multipolygon."""
    _, kind, n = struct.unpack_from("<BII", wkb)
    assert kind == 6
    at, polygons = 9, []
    for _ in range(n):
        _, kind, rings = struct.unpack_from("<BII", wkb, at)
        assert kind == 3
        at += 9
        polygons.append([])
        for _ in range(rings):
            (points,) = struct.unpack_from("<I", wkb, at)
            flat = struct.unpack_from(f"<{2 * points}d", wkb, at + 4)
            at += 4 + 16 * points
            polygons[-1].append([list(p) for p in zip(flat[::2], flat[1::2])])
    assert at == len(wkb)
    return polygons


def test_geojson(spark, folder):
    put(
        folder,
        "b.geojson",
        f'{{"type":"FeatureCollection","crs":{{"type":"name","properties":{{"name":"urn:ogc:def:crs:EPSG::4269"}}}},"features":['
        f'{{"type":"Feature","properties":{{"GEOID":"01001","NAME":"Autauga"}},"geometry":{{"type":"Polygon","coordinates":[{SQUARE},{HOLE}]}}}},\n'
        f'{{"type":"Feature","properties":{{"geoid":"01003"}},"geometry":{{"type":"MultiPolygon","coordinates":[[{SQUARE}],[{HOLE}]]}}}}]}}',
    )
    out = boundary_table(boundaries.read_boundaries(spark, f"{folder}/b.geojson"), 2025).orderBy("geoid").collect()
    assert [(r.geoid, r.name, r.source_year) for r in out] == [("01001", "Autauga", 2025), ("01003", None, 2025)]
    assert parse_wkb(out[0].geom) == [[SQUARE, HOLE]] and parse_wkb(out[1].geom) == [[SQUARE], [HOLE]]


def shapefile(folder, stem, shapes, records, prj=None):
    """Write a minimal polygon layer."""
    body = b""
    for number, rings in enumerate(shapes, 1):
        flat = [c for ring in rings for p in ring for c in p]
        starts, n = [], 0
        for ring in rings:
            starts.append(n)
            n += len(ring)
        content = struct.pack("<I4d2I", 5, 0, 0, 4, 4, len(rings), n) + struct.pack(f"<{len(starts)}I", *starts) + struct.pack(f"<{len(flat)}d", *flat)
        body += struct.pack(">2I", number, len(content) // 2) + content
    put(folder, f"{stem}.shp", b"\0" * 100 + body)
    fields = list(records[0])
    descriptors = b"".join(f.encode().ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([20]) + b"\0" * 15 for f in fields) + b"\r"
    header = struct.pack("<4BIHH20x", 3, 0, 0, 0, len(records), 32 + len(descriptors), 1 + 20 * len(fields))
    put(folder, f"{stem}.dbf", header + descriptors + b"".join(b" " + b"".join(str(r[f]).ljust(20).encode() for f in fields) for r in records))
    if prj:
        put(folder, f"{stem}.prj", prj)


def test_shapefile(spark, folder):
    other = [[p[0] + 10, p[1]] for p in SQUARE]
    shapefile(folder, "cb", [[SQUARE, HOLE], [SQUARE, other]], [{"GEOID": "01001", "NAME": "Autauga"}, {"GEOID": "01003", "NAME": "Baldwin"}], 'GEOGCS["GCS_North_American_1983"]')
    features = boundaries.read_boundaries(spark, folder)
    assert {r.srid for r in features.collect()} == {4269}
    out = {r.geoid: parse_wkb(r.geom) for r in boundary_table(features, 2025).collect()}
    assert out == {"01001": [[SQUARE, HOLE]], "01003": [[SQUARE], [other]]}
    county = spark.createDataFrame([("01001", 2025, "x")], "ssa_county_code string, contract_year int, county_type string")
    assert boundaries_with_county(boundary_table(boundaries.read_boundaries(spark, f"{folder}/cb.shp"), 2025), county).count() == 1


def test_only_the_named_shapefile_is_read(spark, folder):
    import os

    os.makedirs(f"{folder}/old")
    for place, stem in ((folder, "county"), (folder, "subcounty"), (f"{folder}/old", "county")):
        shapefile(place, stem, [[SQUARE]], [{"GEOID": stem + place[-3:]}])
    read = boundaries.read_boundaries(spark, f"{folder}/county.shp")
    assert rows_of(read.select(F.col("properties")["GEOID"])) == [("county" + folder[-3:],)]
    assert boundaries.read_boundaries(spark, folder).count() == 3


def test_code_pages_deleted_records_and_unequal_parts(spark, folder):
    shapefile(folder, "a", [[SQUARE], [SQUARE], [SQUARE]], [{"GEOID": "1"}, {"GEOID": "2"}, {"GEOID": "3"}])
    content = open(f"{folder}/a.dbf", "rb").read()
    start = len(content) - 3 * 21
    accented = "Doña Ana".encode("latin-1").ljust(20)
    put(folder, "a.DBF", content[:start] + b" " + accented + b"*" + content[start + 22 :])
    os_remove = __import__("os").remove
    os_remove(f"{folder}/a.dbf")
    put(folder, "a.cpg", "ISO-8859-1")
    assert rows_of(boundaries.read_boundaries(spark, f"{folder}/a.shp").select(F.col("properties")["GEOID"])) == [("3",), ("Doña Ana",)]
    shapefile(folder, "b", [[SQUARE]], [{"GEOID": "1"}, {"GEOID": "2"}])
    with pytest.raises(Exception, match="unreadable shapefile"):
        boundaries.read_boundaries(spark, f"{folder}/b.shp").collect()


def test_layers_are_bounded_and_written_by_tasks(spark, folder):
    import glob
    from rosterflow.session import ship

    ship(spark)
    rows = spark.range(0, 95, 1, 3).selectExpr("CAST(id AS INT) AS n_nationkey", "id AS s_suppkey", "concat('s', id) AS s_name")
    write_layers(rows, f"{folder}/layers", layer_rows=10)
    counts = [struct.unpack("<I", open(p, "rb").read()[4:8])[0] for p in glob.glob(f"{folder}/layers/*/*.dbf")]
    assert len(counts) == 12 and max(counts) == 10 and sum(counts) == 95
    read = boundary_table(boundaries.read_boundaries(spark, f"{folder}/layers"), 2025)
    assert rows_of(read, "geoid", "name") == sorted(((str(i), f"ñs{i}") for i in range(95) if i % 5), key=str)


def test_parts_are_bounded_files_with_a_header_first(spark, folder):
    import glob

    rows = spark.range(0, 400, 1, 3).selectExpr("IF(id < 360, 0, 1) AS part", "id AS key", "concat(id, IF(id % 5 = 0, ',\"a\nb\"', ',a')) AS line")
    write_parts(rows, f"{folder}/parts", "h,", file_rows=50)
    files = [open(p).read() for p in glob.glob(f"{folder}/parts/part=0/file=*/*.txt")]
    assert len(files) == 8 == len(glob.glob(f"{folder}/parts/part=0/file=*"))
    assert len(glob.glob(f"{folder}/parts/part=1/file=*/*.txt")) == len(glob.glob(f"{folder}/parts/part=1/file=*"))
    found = []
    for text in files:
        head, *lines = text.removesuffix("\n\n").replace(',"a\nb"', ',"a b"').replace("h,\n", "h,\n\n", 1).split("\n\n")
        assert head == "h," and lines == sorted(lines) and len(lines) < 90
        found += [int(v.split(",")[0]) for v in lines]
    assert sorted(found) == list(range(360))


def test_any_damage_of_a_workbook_is_its_own(spark, folder):
    good = workbook_bytes({"S": [["a", "b"]]})
    bad_reference = good.replace(b"PK", b"PK")
    damaged = bytearray(good)
    at = good.index(b"worksheets/sheet1.xml") + 25
    damaged[at : at + 8] = b"\xff" * 8
    for name, content in (("good.xlsx", bad_reference), ("flate.xlsx", bytes(damaged)), ("cut.xlsx", good[: len(good) // 2])):
        put(folder, name, content)
    out = workbook.decode_workbooks(spark, [folder], keep_unreadable=True)
    name = F.substring_index("path", "/", -1)
    assert rows_of(out.select(name, F.col("error").isNull())) == [("cut.xlsx", False), ("flate.xlsx", False), ("good.xlsx", True)]


def test_projected_shapefile_is_an_error(spark, folder):
    shapefile(folder, "cb", [[SQUARE]], [{"GEOID": "01001"}], 'PROJCS["x",GEOGCS["GCS_North_American_1983"]]')
    with pytest.raises(Exception, match="unsupported srid"):
        boundary_table(boundaries.read_boundaries(spark, folder), 2025).collect()


def test_boundaries_need_a_geoid(spark, folder):
    shapefile(folder, "cb", [[SQUARE]], [{"NAME": "x"}], 'GEOGCS["WGS_1984"]')
    with pytest.raises(Exception, match="must contain GEOID"):
        boundary_table(boundaries.read_boundaries(spark, folder), 2025).collect()
    assert boundary_columns(["geoid", "x"]) == ("geoid", None)
    with pytest.raises(ValueError, match="must contain GEOID"):
        boundary_columns(["x"])
    with pytest.raises(ValueError, match="Unsupported"):
        boundaries.read_boundaries(spark, f"{folder}/x.gpkg")
