import os

import pytest
from conftest import rows_of
from pyspark.sql import functions as F
from test_reshape import FULL
from test_sources import HEADER, put, shapefile, SQUARE

from rosterflow import schemas as S
from rosterflow.operators.validate import ValidationFailed
from rosterflow.plans import jobs
from rosterflow.plans.submissions import facility_rows, org_facility_rows, org_provider_rows, provider_rows
from rosterflow.queries.files import workbook_bytes
from rosterflow.sinks import tables

GOOD = "1001,Jane Doe,{npi},PCP,1,D,100 Main St,Boston,MA,02101,Y,Grp ,n,,high"


def codes(spark):
    return spark.createDataFrame([(2024, "01001")], "contract_year int, code string"), spark.createDataFrame(
        [(2025, "001")], "contract_year int, code string"
    )


def test_provider_and_facility_rows(spark):
    raw = spark.createDataFrame([(" 1001", "Jane ", " 1234567890", "1", " y ", "n", " Y", None, 2025)], "ssa_state_county_code string, name_of_physician_or_mid_level_practitioner string, npi string, specialty_code string, accepts_new_patients string, uses_cms_ma_contract_amendment string, letter_of_intent string, specialty string, source_year int")
    out = provider_rows(raw)
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in S.PROVIDER_HSD]
    row = out.first()
    assert (row.ssa_state_county_code, row.npi, row.specialty_code) == ("01001", "1234567890", "001")
    assert (row.accepts_new_patients, row.uses_cms_ma_contract_amendment, row.letter_of_intent) == (True, False, "Y")
    beds = spark.createDataFrame([(str(b),) for b in ("12", "12.5", "x")], "number_of_beds string").withColumn("source_year", F.lit(2025))
    assert rows_of(facility_rows(beds), "number_of_beds") == [(None,), (None,), (12,)]
    assert facility_rows(beds.limit(0)).schema["number_of_beds"].dataType.simpleString() == "bigint"


def test_org_rows(spark):
    raw = spark.createDataFrame([("o", "f", "40", "1001", "Y", "7")], "organization_id string, source_file_id string, facility_specialty_code string, ssa_state_county_code string, letter_of_intent string, number_of_beds string")
    out = org_facility_rows(raw)
    assert out.columns == S.ORG_FACILITIES.fieldNames()
    row = out.first()
    assert (row.facility_specialty_code, row.ssa_state_county_code, row.letter_of_intent, row.number_of_beds) == ("40", "01001", True, 7)
    assert len(row.id) == 36 and row.latitude is None
    assert org_provider_rows(raw).columns == S.ORG_PROVIDERS.fieldNames()


def test_submissions_are_gated_per_file(spark, folder):
    good = put(folder, "good.csv", "\n".join([HEADER, GOOD.format(npi="1234567890"), GOOD.format(npi="1234567890")]))
    bad = put(folder, "bad.csv", "\n".join([HEADER, GOOD.format(npi="123"), GOOD.format(npi="2234567890")]))
    grid = [HEADER.split(","), [None] * 3, GOOD.format(npi="3234567890").split(",")]
    book = put(folder, "book.xlsx", workbook_bytes({"Sheet1": grid, "Notes": [["ignore"]]}))
    out = f"{folder}/out/"
    found = jobs.load_submissions(spark, [good, bad, book], 2025, "provider", *codes(spark), location=out)
    name = F.substring_index("source_file", "/", -1)
    assert rows_of(found.select(name, "row_index", "severity", "field")) == [("bad.csv", 1, "error", "npi"), ("good.csv", 2, "warning", "npi")]
    loaded = spark.read.parquet(out + "provider_hsd")
    assert rows_of(loaded, "npi", "ssa_state_county_code", "specialty_code", "source_year") == [
        ("1234567890", "01001", "001", 2025), ("1234567890", "01001", "001", 2025), ("3234567890", "01001", "001", 2025),
    ]
    with pytest.raises(ValidationFailed) as failed:
        jobs.load_submissions(spark, [bad], 2025, "provider", *codes(spark), location=out, strict=True)
    assert rows_of(failed.value.issues, "row_index", "field") == [(1, "npi")]
    jobs.load_submissions(spark, [bad], 2025, "provider", *codes(spark), location=out)
    assert spark.read.parquet(out + "provider_hsd").count() == 3  # nothing passed, so nothing was replaced
    with pytest.raises(ValueError, match="Unsupported file type"):
        jobs.stage_submissions(spark, ["x.pdf"], "provider")


def test_standards_job(spark, folder):
    book = put(folder, "ref.xlsx", workbook_bytes(FULL))
    out = f"{folder}/out/"
    assert jobs.load_standards(spark, [book], 2025, out) == S.REFERENCE_TABLES
    assert spark.read.parquet(out + "county").count() == 2
    only = put(folder, "only.xlsx", workbook_bytes({S.SHEET_MIN_FACILITY: FULL[S.SHEET_MIN_FACILITY]}))
    assert jobs.load_standards(spark, [only], 2026, out, append=True) == ["specialty_type", "minimum_number_standard"]
    assert spark.read.parquet(out + "county").count() == 2  # an empty table leaves the old one
    assert rows_of(spark.read.parquet(out + "specialty_type").groupBy("contract_year").count()) == [(2025, 5), (2026, 2)]


def test_generic_gazetteer_and_boundary_jobs(spark, folder):
    path = put(folder, "x.csv", "a,b\n1,x\n2,y\n")
    jobs.load_file(spark, path, f"{folder}/t")
    jobs.load_file(spark, path, f"{folder}/t", append=True, change=lambda df: df.filter("a = 1"))
    assert rows_of(spark.read.parquet(f"{folder}/t")) == [(1, "x"), (1, "x"), (2, "y")]
    places = put(folder, "g.txt", "GEOID\tINTPTLAT\tINTPTLONG\n00601\t18.1\t-66.7\n")
    assert jobs.load_gazetteer(spark, [places], 2025, f"{folder}/z")
    assert rows_of(spark.read.parquet(f"{folder}/z").select("geoid", "geom.lon", "geom.lat")) == [("00601", -66.7, 18.1)]
    blank = put(folder, "h.txt", "GEOID\tINTPTLAT\tINTPTLONG\n\t18.1\t-66.7\n")
    assert not jobs.load_gazetteer(spark, [blank], 2025, f"{folder}/z")
    shapefile(folder, "cb", [[SQUARE]], [{"GEOID": "01001"}])
    assert jobs.load_boundaries(spark, folder, 2025, f"{folder}/b")
    assert spark.read.parquet(f"{folder}/b").columns == S.COUNTY_BOUNDARIES.fieldNames()


def test_replace_files(spark, folder):
    path, schema = f"{folder}/t", "source_file_id string, v int"

    def load(rows, ids):
        counts = tables.replace_files(spark.createDataFrame(rows, schema), path, spark.createDataFrame([(i,) for i in ids], "source_file_id string"))
        return rows_of(counts)

    assert load([("a", 1), ("a", 2), ("b", 3), ("c=1/x", 4)], ["a", "b", "c=1/x"]) == [("a", 2), ("b", 1), ("c=1/x", 1)]
    assert load([("a", 9)], ["a", "c=1/x", "new"]) == [("a", 1), ("c=1/x", 0), ("new", 0)]
    stored = tables.stored_files(spark, path)
    assert rows_of(stored, "source_file_id", "v") == [("a", 9), ("b", 3)]
    assert stored.filter("updated_at is null or created_at is null").isEmpty()
    assert load([("c=1/x", 5)], ["c=1/x"]) == [("c=1/x", 1)]
    assert rows_of(tables.stored_files(spark, path), "source_file_id", "v") == [("a", 9), ("b", 3), ("c=1/x", 5)]


def test_a_replacement_evaluates_its_rows_once(spark, folder):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    rows = spark.range(50).selectExpr("cast(id % 4 as string) AS source_file_id", "id").mapInPandas(counted, "source_file_id string, id long")
    counts = tables.replace_files(rows, f"{folder}/t", spark.createDataFrame([(str(i),) for i in range(5)], "source_file_id string"), scattered=False)
    assert rows_of(counts) == [("0", 13), ("1", 13), ("2", 12), ("3", 12), ("4", 0)]
    assert seen.value == 50 and tables.stored_files(spark, f"{folder}/t").count() == 50
    only = tables.replace_files(rows.limit(0), f"{folder}/new", spark.createDataFrame([("0",)], "source_file_id string"))
    assert rows_of(only) == [("0", 0)] and tables.stored_files(spark, f"{folder}/new").isEmpty()
    assert tables.replace_files(rows.limit(0), f"{folder}/none", spark.createDataFrame([], "source_file_id string")).isEmpty()


def test_targets(spark, folder, monkeypatch):
    assert [tables.target(at, "county") for at in ("", "s3a://out", "s3a://out/", "db.")] == ["county", "s3a://out/county", "s3a://out/county", "db.county"]
    from pyspark.sql import DataFrameWriter

    calls = []
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, url, table, *a, **k: calls.append((url, table)))
    df = spark.createDataFrame([(1,)], "v int")
    assert tables.write_tables({"county": df, "none": df.limit(0)}, ["county", "none"], "jdbc:postgresql://h/db", options={"user": "u"}) == ["county"]
    assert calls == [("jdbc:postgresql://h/db", "county")]


def test_replaced_rows_and_write_times(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    new = spark.createDataFrame([("a", 3)], "k string, v int")
    ids = spark.createDataFrame([("a",), ("c",)], "k string")
    assert rows_of(tables.replaced_rows(old, new, ids, "k")) == [("a", 3), ("b", 2)]
    assert tables.with_write_times(old).filter("created_at = updated_at").count() == 2


def test_catalog_table(spark):
    df = spark.createDataFrame([(1,)], "v int")
    tables.write_table(df, "written_table")
    tables.write_table(df, "written_table", append=True)
    assert spark.table("written_table").count() == 2
    spark.sql("DROP TABLE written_table")


def test_workers_get_the_package(folder):
    """A session that was started elsewhere, with the package on the driver's path only."""
    import os
    import subprocess
    import sys

    from rosterflow.queries.files import workbook_bytes

    with open(f"{folder}/b.xlsx", "wb") as out:
        out.write(workbook_bytes({"S": [["a"], [1]]}))
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys; sys.path.insert(0, {root!r})
from rosterflow.session import local_session
from rosterflow.sources.workbook import decode_workbooks
spark = local_session("2"); print("rows", decode_workbooks(spark, [{folder + '/b.xlsx'!r}]).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", code], cwd=folder, env=env, capture_output=True, text=True, timeout=120)
    assert "rows 2" in run.stdout, run.stderr[-2000:]


def test_staged_tables_go_with_their_scope(spark):
    from rosterflow import session

    kept = session.materialise(spark.range(3), "kept")
    with session.staged_tables(spark):
        inside = session.materialise(spark.range(5), "inside")
        address = inside.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        assert inside.count() == 5 and os.path.isdir(address)
    assert not os.path.exists(address) and kept.count() == 3
