"""County boundary files: GeoJSON and shapefiles as features with WKB geometry."""

from __future__ import annotations

import codecs
import re
import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterflow import schemas as S
from rosterflow.functions.geo import NAD83, WGS84
from rosterflow.operators.joins import small_side
from rosterflow.session import materialise, ship
from rosterflow.sources import blocks
from rosterflow.sources.paths import file_address

_GEOJSON = (
    "crs struct<properties:struct<name:string>>,"
    " features array<struct<properties:map<string,string>,geometry:struct<type:string,coordinates:string>>>"
)
_RINGS = "array<array<array<double>>>"


@F.pandas_udf(T.BinaryType())
def multipolygon_wkb(polygons: pd.Series) -> pd.Series:
    """Multipolygon WKB from nested coordinate lists."""
    return pd.Series([None if p is None else _encode(p) for p in polygons], dtype=object)


def _encode(polygons) -> bytes:
    out = [struct.pack("<BII", 1, 6, len(polygons))]
    for rings in polygons:
        out.append(struct.pack("<BII", 1, 3, len(rings)))
        for ring in rings:
            points = np.array([list(p)[:2] for p in ring], dtype="<f8")
            out.append(struct.pack("<I", len(points)) + points.tobytes())
    return b"".join(out)


def crs_srid(name: Column) -> Column:
    """SRID of a GeoJSON coordinate system name; files without one are WGS84."""
    code = F.regexp_extract(name, r"(?:EPSG:+|epsg/0/)(\d+)$", 1)
    return F.when(name.isNull() | name.endswith("CRS84"), WGS84).otherwise(code.try_cast("int"))


def _pieces(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Files cut after every closing brace, in blocks, with what a piece does to the structure.

    ``quotes`` counts the quotes that no backslash takes; ``braces_0`` and ``brackets_0`` are what
    the piece opens less what it closes if it starts outside of a string, ``braces_1`` and
    ``brackets_1`` if inside. The brace at the end of the piece is not counted.
    """
    bare = F.regexp_replace("raw", r"(?s)\\.", "")
    outside = F.regexp_replace(bare, '"[^"]*("|$)', "")
    after = F.regexp_replace(F.regexp_replace(bare, '^[^"]*("|$)', ""), '"[^"]*("|$)', "")

    def number(text: Column, sign: str) -> Column:
        return F.length(text) - F.length(F.replace(text, F.lit(sign)))

    counts = {"quotes": number(bare, '"')}
    for state, text in enumerate((outside, after)):
        counts[f"braces_{state}"] = number(text, "{")
        counts[f"brackets_{state}"] = number(text, "[") - number(text, "]")
    read = spark.read.option("lineSep", "}").text(list(paths))
    pieces = read.select(F.col("value").alias("raw"), file_address().alias("source_file"), F.col("_metadata.file_block_start").alias("block_start"), F.monotonically_increasing_id().alias("line"))
    return materialise(pieces.withColumns(counts), "geojson-pieces")


def _feature_texts(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``source_file, name, text`` of every feature of the files, ``name`` being the coordinate system's.

    Whether a brace is inside a string, how deep it is, and how many features came before it are
    states that blocks hand on, so that one file is as many tasks as it has blocks. A feature is
    an object of depth two in a list of the collection; it ends where both depths are one again.
    """
    pieces = _pieces(spark, paths)
    marks = blocks.running_sums(pieces.drop("raw"), {"seen": F.col("quotes")})
    within = (F.col("seen") - F.col("quotes")) % 2 == 1
    blank = F.struct("block_start", "line") == F.col("last")
    ends = pieces.groupBy("source_file").agg(F.max(F.struct("block_start", "line")).alias("last"), F.max_by(F.trim(F.translate("raw", "\n\r\t", "   ")) == "", F.struct("block_start", "line")).alias("blank_end"))
    marks = marks.join(small_side(materialise(ends, "geojson-ends")), "source_file")
    closes = ((F.col("seen") % 2 == 0) & ~(blank & F.col("blank_end"))).cast("int")  # what follows the last brace ends in none
    marks = marks.select(
        *blocks.PLACE,
        closes.alias("closes"),
        F.when(within, F.col("braces_1")).otherwise(F.col("braces_0")).alias("opens"),
        F.when(within, F.col("brackets_1")).otherwise(F.col("brackets_0")).alias("lists"),
    )
    marks = materialise(blocks.running_sums(marks, {"depth": F.col("opens") - F.col("closes"), "list_depth": F.col("lists")}), "geojson-depths")
    end = ((F.col("closes") == 1) & (F.col("depth") == 1) & (F.col("list_depth") == 1)).cast("int")
    marks = blocks.running_sums(marks.withColumn("end", end), {"features": F.col("end")})
    fresh = F.col("depth") - F.col("opens") + F.col("closes") < 1  # the piece begins outside of any collection
    marks = marks.select(*blocks.PLACE, (F.col("features") - F.col("end")).alias("feature"), "end", "depth", fresh.alias("fresh"))
    placed = pieces.select(*blocks.PLACE, "raw").join(marks, blocks.PLACE)
    piece = F.struct("block_start", "line", "raw")
    texts = placed.groupBy("source_file", "feature").agg(
        F.array_sort(F.collect_list(piece)).alias("pieces"), F.max("fresh").alias("fresh"), F.max("end").alias("end"), F.max_by("depth", F.struct("block_start", "line")).alias("depth")
    )
    text = F.concat(F.array_join(F.transform("pieces", lambda p: p["raw"]), "}"), F.lit("}"))
    texts = materialise(texts.select("source_file", "fresh", "end", "depth", text.alias("text")), "geojson-features")
    start = r'(?s)^.*?"features"\s*:\s*\['
    # what stands before the first feature and after the last one
    around = texts.filter((F.col("end") == 0) | F.col("fresh")).withColumn("around", F.when(F.col("end") == 0, F.col("text")).otherwise(F.regexp_extract("text", start, 0)))
    named = F.regexp_extract("around", r'(?s)"crs"\s*:\s*\{.*?"name"\s*:\s*"([^"]*)"[^{]*\}', 1)
    whole = F.max(F.when((F.col("end") == 0) & (F.col("depth") != 0), True))
    files = around.groupBy("source_file").agg(F.max(F.nullif(named, F.lit(""))).alias("name"), whole.alias("unfinished"))
    name = F.when(F.col("unfinished"), F.raise_error(F.concat(F.lit("unfinished GeoJSON file "), F.col("source_file")))).otherwise(F.col("name"))
    files = small_side(materialise(files.select("source_file", name.alias("name")), "geojson-files"))
    body = F.when(F.col("fresh"), F.regexp_replace("text", start, "")).otherwise(F.regexp_replace("text", r"^[^{]*", ""))
    return texts.filter("end = 1").join(files, "source_file").select("source_file", "name", body.alias("text"))


_FEATURE = "struct<properties:map<string,string>,geometry:struct<type:string,coordinates:string>>"


def read_geojson(spark: SparkSession, paths: Sequence[str], *, one_per_line: bool = False) -> DataFrame:
    """Polygon and multipolygon features of GeoJSON files, each file read in blocks."""
    ship(spark)
    if one_per_line:
        files = spark.read.schema(_GEOJSON).json(list(paths))
        features = files.select(file_address().alias("path"), crs_srid(F.col("crs.properties.name")).alias("srid"), F.explode("features").alias("f"))
    else:
        texts = _feature_texts(spark, paths)
        features = texts.select(F.col("source_file").alias("path"), crs_srid(F.col("name")).alias("srid"), F.from_json("text", _FEATURE).alias("f"))
    kind, text = F.col("f.geometry.type"), F.col("f.geometry.coordinates")
    polygons = F.when(kind == "Polygon", F.array(F.from_json(text, _RINGS))).when(
        kind == "MultiPolygon", F.from_json(text, f"array<{_RINGS}>")
    )
    return features.select("path", F.col("f.properties").alias("properties"), "srid", multipolygon_wkb(polygons).alias("geom"))


def _encoding(code_page: bytes | None) -> str:
    """Python's name of the encoding that a code page file names; without one UTF-8."""
    named = (code_page or b"").decode("ascii", "replace").strip() or "utf-8"
    for name in (named, f"cp{named}", named.replace("ISO ", "iso"), named.replace("ANSI ", "cp")):
        try:
            return codecs.lookup(name).name
        except LookupError:
            continue
    raise ValueError(f"unknown code page {named}")


def _dbf_records(content: bytes, encoding: str) -> Iterator[dict[str, str] | None]:
    """Attributes of every record; None for one marked as deleted."""
    count, header, width = struct.unpack("<IHH", content[4:12])
    fields, at = [], 32
    while content[at] != 0x0D:
        fields.append((content[at : at + 11].split(b"\0")[0].decode("ascii"), content[at + 16]))
        at += 32
    for i in range(count):
        record = content[header + i * width : header + (i + 1) * width]
        if len(record) < width:
            raise ValueError(f"record {i + 1} of {count} is cut off")
        at, values = 1, {}
        for name, size in fields:
            values[name] = record[at : at + size].decode(encoding).strip(" \0")
            at += size
        yield None if record[:1] == b"*" else values


def _signed_area(ring: np.ndarray) -> float:
    x, y = ring[:, 0], ring[:, 1]
    return float(np.sum(x[:-1] * y[1:] - x[1:] * y[:-1])) / 2


def _holds(ring: np.ndarray, point: np.ndarray) -> bool:
    """Even-odd test of a point against a ring."""
    x0, y0, x1, y1 = ring[:-1, 0], ring[:-1, 1], ring[1:, 0], ring[1:, 1]
    crossing = (y0 > point[1]) != (y1 > point[1])
    with np.errstate(divide="ignore", invalid="ignore"):
        at = (x1 - x0) * (point[1] - y0) / (y1 - y0) + x0
    return bool(np.count_nonzero(crossing & (point[0] < at)) % 2)


def _shp_polygons(content: bytes) -> Iterator[list[list[np.ndarray]] | None]:
    """Polygons per shape: clockwise rings are outer, the others are holes of the
    outer ring around them."""
    at = 100
    while at < len(content):
        (words,) = struct.unpack(">I", content[at + 4 : at + 8])
        body, at = content[at + 8 : at + 8 + words * 2], at + 8 + words * 2
        if struct.unpack("<I", body[:4])[0] not in (5, 15, 25):
            yield None
            continue
        parts, points = struct.unpack("<II", body[36:44])
        starts = list(struct.unpack(f"<{parts}I", body[44 : 44 + 4 * parts])) + [points]
        coords = np.frombuffer(body, "<f8", 2 * points, 44 + 4 * parts).reshape(-1, 2)
        rings = [coords[a:b] for a, b in zip(starts, starts[1:])]
        outer = [[r] for r in rings if _signed_area(r) <= 0]
        for hole in (r for r in rings if _signed_area(r) > 0):
            around = [p for p in outer if _holds(p[0], hole[0])]
            (around[0].append(hole) if around else outer.append([hole]))
        yield outer


def _decode_shapefiles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, shp, dbf, cpg, srid in zip(batch["path"], batch["shp"], batch["dbf"], batch["cpg"], batch["srid"]):
            try:
                rows = [
                    (path, values, srid, None if shape is None else _encode(shape))
                    for values, shape in zip(_dbf_records(dbf, _encoding(cpg)), _shp_polygons(shp), strict=True)
                    if values is not None
                ]
            except ValueError as problem:
                raise ValueError(f"unreadable shapefile {path}: {problem}") from problem
            yield pd.DataFrame(rows, columns=["path", "properties", "srid", "geom"])


def prj_srid(text: Column) -> Column:
    """SRID of a projection file: the two geographic systems that are accepted."""
    geographic = text.startswith("GEOGCS")
    return (
        F.when(text.isNull() | (geographic & text.contains("North_American_1983")), NAD83)
        .when(geographic & text.contains("WGS_1984"), WGS84)
    )


_PARTS = ("shp", "dbf", "prj", "cpg")


def _any_case(word: str) -> str:
    return "".join(f"[{c.lower()}{c.upper()}]" for c in word)


def _layers(files: DataFrame) -> DataFrame:
    """Features of the layers among binary files; the parts of one layer share a stem."""
    stem, part = F.regexp_replace(file_address(), r"\.[^.]+$", ""), F.lower(F.substring_index("path", ".", -1))
    found = files.select(stem.alias("stem"), part.alias("part"), "content")
    parts = [found.filter(F.col("part") == p).select("stem", F.col("content").alias(p)) for p in _PARTS]
    layers = parts[0].join(parts[1], "stem").join(parts[2], "stem", "left").join(parts[3], "stem", "left")
    return layers.select(
        F.concat("stem", F.lit(".shp")).alias("path"), "shp", "dbf", "cpg", prj_srid(F.col("prj").cast("string")).alias("srid")
    ).mapInPandas(_decode_shapefiles, S.BOUNDARY_FEATURES)


def read_shapefiles(spark: SparkSession, folders: Sequence[str]) -> DataFrame:
    """Polygon features of all shapefiles below folders.

    A layer whose numbers of records and shapes differ is an error; deleted records are
    left out; attributes are read in the encoding of the code page file.
    """
    ship(spark)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    return _layers(files.option("pathGlobFilter", "*.{" + ",".join(map(_any_case, _PARTS)) + "}").load(list(folders)))


def read_shapefile(spark: SparkSession, path: str) -> DataFrame:
    """Polygon features of exactly one shapefile, with the parts beside it."""
    ship(spark)
    folder, _, name = path.rstrip("/").rpartition("/")
    stem = re.sub(r"([\\\[\]{}*?])", r"\\\1", name[:-4])
    files = spark.read.format("binaryFile").option("pathGlobFilter", stem + ".{" + ",".join(map(_any_case, _PARTS)) + "}")
    return _layers(files.load(folder or "."))


def read_boundaries(spark: SparkSession, path: str) -> DataFrame:
    """Boundary file or folder by suffix."""
    lower = path.lower().rstrip("/")
    if lower.endswith((".geojson", ".json")):
        return read_geojson(spark, [path])
    if lower.endswith(".shp"):
        return read_shapefile(spark, path)
    if lower.endswith(".gpkg"):
        raise ValueError(S.MSG_UNSUPPORTED + ".gpkg")
    return read_shapefiles(spark, [path])
