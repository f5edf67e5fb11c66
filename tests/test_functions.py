import math

import pytest
from pyspark.sql import functions as F

from rosterflow.functions import numbers, text
from rosterflow.functions.geo import known_srid, point_wkb


def applied(spark, function, values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(function(F.col("v"))).collect()]


@pytest.mark.parametrize(
    "function, cases",
    [
        (text.strip, {" a\t": "a", "\xa0b\n": "b", "　c d ": "c d", "": "", None: None}),
        (text.strip_or_blank, {None: "", "  ": "", " x": "x"}),
        (lambda c: text.zero_fill(c, 5), {"1": "00001", "123456": "123456", "-1": "-0001", "+12": "+0012", "": "00000"}),
        (lambda c: text.pad_code(c, 5), {" 1001 ": "01001", "123456": "123456", "ab": "ab", "": "", None: None}),
        (lambda c: text.pad_code(c, 3), {"6": "006", "040": "040", "1234": "1234"}),
        (lambda c: text.check_code(c, 3), {None: "000", " 6": "006", "A": "00A"}),
        (
            text.yes_no,
            {"y": True, " YES ": True, "1": True, "true": True, "n": False, "No": False, "0": False, "?": None, "": None, None: None},
        ),
        (text.snake_case, {" Large  Metro ": "large_metro", "CEAC (1)": "ceac_1", "--": None, "": None, None: None}),
        (text.underscore_name, {" ALAND  SQMI ": "aland_sqmi"}),
        (text.shown, {None: "None", "x": "x"}),
        (text.is_npi, {"1234567890": True, " 1234567890 ": True, "123": False, "12345678901": False, None: False, "12345abcde": False}),
        (
            text.is_po_box,
            {
                "P.O. Box 9": True,
                "post office box 9": True,
                "PO BOX 1": True,
                "p o box 1": True,
                "12 Boxwood Rd": False,
                "Depo Boxing": False,
                None: False,
            },
        ),
        (text.is_accuracy_value, {" HIGH": True, "low": True, "": True, None: True, "sure": False}),
        (text.is_yes_flag, {"y": True, "Y": True, " Y": False, "n": False, None: None}),
        (numbers.to_long, {"12": 12, "12.0": None, " 12 ": 12, "x": None, "": None, None: None}),
        (numbers.to_double, {"1.5": 1.5, "5d": None, "2F": None, "0x1p3": None, "1e3": 1000.0, "x": None, None: None}),
        (
            numbers.truncated_long,
            {"12.7": 12, "-12.7": -12, "12": 12, "n/a": None, "NaN": None, "inf": None, "": None, None: None},
        ),
    ],
)
def test_text_and_numbers(spark, function, cases):
    assert dict(zip(cases, applied(spark, function, list(cases)))) == cases


def test_clip_and_nan(spark):
    assert len(applied(spark, text.clip_message, ["x" * 900])[0]) == 500
    assert applied(spark, numbers.nan_as_null, [math.nan, 1.0, None], "double") == [None, 1.0, None]


def test_point_wkb_is_a_point(spark):
    wkb = spark.range(1).select(point_wkb(F.lit(-86.5), F.lit(32.5))).first()[0]
    assert len(wkb) == 21 and wkb[0] == 1 and wkb[1:5] == b"\x01\0\0\0"
    assert spark.range(1).select(point_wkb(F.lit(None).cast("double"), F.lit(1.0))).first()[0] is None


def test_geography_from_point(spark):
    from rosterflow.functions.geo import geography

    spark.conf.set("spark.sql.geospatial.enabled", "true")
    srid = F.call_function("st_srid", geography(point_wkb(F.lit(-86.5), F.lit(32.5))))
    assert spark.range(1).select(srid).first()[0] == 4326


def test_unknown_srid_is_an_error(spark):
    assert applied(spark, known_srid, [4326, 4269], "int") == [4326, 4326]
    with pytest.raises(Exception, match="unsupported srid"):
        applied(spark, known_srid, [3857], "int")
