"""State carried along files that are read in blocks."""

import csv
import io
import json
import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F
from test_sources import HEADER, put

from rosterflow.sources import blocks, boundaries, delimited


@pytest.fixture
def small_blocks(spark):
    """Files are read in many blocks, and shuffles keep all their partitions."""
    held = {"spark.sql.files.maxPartitionBytes": "3000b", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1", "spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("seed", range(3))
def test_states_and_sums_equal_a_walk_along_each_file(spark, seed):
    chance = random.Random(seed)
    rows = []
    for file in ("a", "b", "c"):
        for block in range(12):
            mostly = chance.choice([0.05, 0.5, 1.0])
            rows += [(file, block * 100, 1000 * block + line, chance.random() < mostly, chance.randrange(9)) for line in range(chance.choice([0, 1, 2, 7]))]
    inside, sums, following, wanted = {}, {}, {}, []
    for i, (file, block, line, toggles, n) in enumerate(rows):
        wanted.append((file, line, inside.get(file, False), sums.get(file, 0) + n, next((r[4] for r in rows[i + 1 :] if r[0] == file), None)))
        inside[file] = toggles and not inside.get(file, False)
        sums[file] = sums.get(file, 0) + n
    frame = spark.createDataFrame(chance.sample(rows, len(rows)), "source_file string, block_start long, line long, t boolean, n int")
    out = blocks.toggled(blocks.next_rows(blocks.running_sums(frame, {"total": F.col("n")}), F.col("n")), F.col("t"))
    assert rows_of(out, "source_file", "line", "inside", "total", "next") == sorted(wanted, key=lambda r: [(v is not None, str(v)) for v in r])
    lists = spark.createDataFrame([(f, b * 100) for f in "abc" for b in range(12)], "source_file string, block_start long")
    found = {(r[0], r[1]): r[2] for r in blocks.last_before(frame, lists, F.col("line")).collect()}
    assert found == {(f, b * 100): max((r[2] for r in rows if r[0] == f and r[1] < b * 100), default=None) for f in "abc" for b in range(12)}


def test_a_file_whose_every_row_runs_over_lines_is_spread_over_its_blocks(spark, folder, small_blocks):
    chance = random.Random(1)
    rows = [[str(i), "Ann", f'12 "Main" St\n{"Floor, " * chance.randrange(1, 4)}\nApt {i}'] for i in range(4000)]
    text = io.StringIO()
    csv.writer(text, lineterminator="\n").writerows(rows)
    put(folder, "a.csv", HEADER + "\n" + text.getvalue())
    lines = delimited._lines(spark, [folder])
    assert lines.select("block_start").distinct().count() > 40
    odd = lines.filter("odd")
    state = blocks.toggled(blocks.next_rows(odd.select(*blocks.PLACE), F.lit(True)), F.lit(True))
    tasks = [r["count"] for r in state.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(tasks) == odd.count() > 7000 and max(tasks) < sum(tasks) / 5
    staged = delimited.stage_csv(spark, [folder], "provider")
    read = delimited.data_rows(staged).select("row_index", "ssa_state_county_code", "npi", "damaged").collect()
    assert sorted((r[0], r[1], r[2], r[3]) for r in read) == [(i + 1, str(i), row[2], False) for i, row in enumerate(rows)]


def collection(features, crs="urn:ogc:def:crs:EPSG::4269", **more):
    return {"type": "FeatureCollection", **more, "crs": {"type": "name", "properties": {"name": crs}}, "features": features}


def feature(i, name):
    ring = [[[i, 0], [i, 1], [-1, 1], [i, 0]]]
    geometry = {"type": "Polygon", "coordinates": ring} if i % 2 else {"type": "MultiPolygon", "coordinates": [ring, ring]}
    return {"type": "Feature", "properties": {"GEOID": str(i), "NAME": name, "nested": {"a": [{"b": "}"}]}}, "geometry": geometry}


def test_a_feature_collection_is_read_in_blocks(spark, folder, small_blocks):
    chance = random.Random(2)
    names = ["".join(chance.choices('{}[]",\\: aé\n', k=chance.randrange(12))) for _ in range(600)]
    names[:4] = ["}", '"}', '\\"}{', '"features":[{']
    put(folder, "a.geojson", json.dumps(collection([feature(i, n) for i, n in enumerate(names)], title='x "features" : y}')))
    put(folder, "b.geojson", json.dumps(collection([feature(i, "b") for i in range(600, 603)], "EPSG:4326"), indent=2) + "\n")
    put(folder, "c.geojson", json.dumps(collection([])))
    put(folder, "d.geojson", '{"features": [' + json.dumps(feature(700, "d")) + '], "crs": {"properties": {"name": "EPSG:4269"}}, "type": "FeatureCollection"}')
    read = boundaries.read_geojson(spark, [folder])
    got = {r["id"]: (r["name"], r["srid"], r["path"].rsplit("/", 1)[1]) for r in read.select(F.col("properties")["GEOID"].alias("id"), F.col("properties")["NAME"].alias("name"), "srid", "path").collect()}
    want = {str(i): (n, 4269, "a.geojson") for i, n in enumerate(names)} | {str(i): ("b", 4326, "b.geojson") for i in range(600, 603)} | {"700": ("d", 4269, "d.geojson")}
    assert got == want
    whole = spark.read.schema(boundaries._GEOJSON).option("multiLine", True).json(folder)
    same = whole.select(F.explode("features").alias("f")).select(F.col("f.properties"), F.col("f.geometry.type").alias("kind"))
    assert same.count() == read.count() == len(want)
    pieces = boundaries._pieces(spark, [f"{folder}/a.geojson"])
    assert pieces.select("block_start").distinct().count() > 10


def test_an_unfinished_collection_is_an_error(spark, folder):
    put(folder, "a.geojson", json.dumps(collection([feature(1, "x"), feature(2, "y")]))[:-60])
    with pytest.raises(Exception, match="unfinished"):
        boundaries.read_geojson(spark, [folder]).collect()
