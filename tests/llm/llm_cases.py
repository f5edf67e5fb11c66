"""Small documents with every odd case, and plain versions of the word classes and folds."""

import re
import zlib

import duckdb

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def alphanumeric(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


def remainder(key, folds):
    return zlib.crc32(str(key).encode()) % folds


def odd_rows():
    """Null, empty, blank, tied, repeated, accented and very long texts; null ids and other columns."""
    base = " ".join(f"word{i}" for i in range(60))
    long = " ".join(f"w{i % 977}x{i % 13}" for i in range(60_000))
    texts = [None, "", " \n\t ", "one", "One", "one two", base, base, base.replace("word7 ", "other "), "é ü 漢字 ▁ 🎉\x00 #$%", long]
    rows = [(i, t, None if i % 2 else "en", "src0", None) for i, t in enumerate(texts)]
    return [*rows, rows[6], (None, base, None, None, None), (100, "a a a a a a a a a a " * 5, "en", "src1", 1)]


def odd_frame(spark, *clashing):
    """The odd rows, with an extra text column for each clashing name."""
    frame = spark.createDataFrame(odd_rows(), SCHEMA)
    for name in clashing:
        frame = frame.selectExpr("*", f"'old' AS `{name}`")
    return frame


def empty_frame(spark):
    return spark.createDataFrame([], SCHEMA)


def small(query, folder=SMALL):
    return duckdb.sql(query.replace("SF", folder)).fetchall()
