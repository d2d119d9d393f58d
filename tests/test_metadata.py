import pytest
from pyspark.sql import functions as F

from capture_lake.functions import metadata as M

# The keys are the producer's; the values are made up here.
SAMPLE = {
    "content-hash": "77aa01", "source-zip": "batch-9.zip", "original-path": "/scans/batch-9/p3.tif",
    "image-width": "640", "image-height": "481", "compression-ratio": "7.25",
    "processing-duration-ms": "9", "pdf-producer": "press 4", "pdf-creator": "desk",
    "watcher-version": "3.1",
}


def meta_df(spark, maps):
    return spark.createDataFrame([(i, m) for i, m in enumerate(maps)], "i int, metadata map<string,string>")


def test_values_reach_columns(spark):
    row = meta_df(spark, [SAMPLE]).select(*[v.alias(k) for k, v in M.metadata_columns().items()]).first()
    assert row.file_hash == "77aa01" and row.source_zip == "batch-9.zip"
    assert row.image_width == 640 and row.image_height == 481 and row.compression_ratio == 7.25
    assert row.pdf_producer == "press 4" and row.pdf_creator == "desk" and row.watcher_version == "3.1"


def test_defaults_only_when_missing(spark):
    df = meta_df(spark, [{}, {"pdf-producer": ""}])
    rows = df.select("i", *[v.alias(k) for k, v in M.metadata_columns().items()]).orderBy("i").collect()
    assert rows[0].file_hash == "" and rows[0].pdf_producer == "unknown" and rows[0].watcher_version == "unknown"
    assert rows[0].compression_ratio == 0.0 and rows[0].image_width is None
    assert rows[1].pdf_producer == ""  # present but empty stays empty


@pytest.mark.parametrize("text,expected", [
    (" 12 ", 12), ("\t12\n", 12), ("+5", 5), ("-7", -7), ("1_000", 1000), ("", None), ("1e3", None), ("12.0", None),
    ("1__0", None), ("_1", None), ("abc", None), ("99999999999", None), ("2147483647", 2147483647),
])
def test_int_parse_matches_producer(spark, text, expected):
    got = spark.createDataFrame([(text,)], "s string").select(M.parse_int(F.col("s")).alias("v")).first().v
    assert got == expected


@pytest.mark.parametrize("text,expected", [
    ("2.5", 2.5), (" 3 ", 3.0), ("\t1.5\n", 1.5), ("1e3", 1000.0), (".5", 0.5), ("5.", 5.0), ("1_0.5", 10.5), ("-0.25", -0.25),
    ("1d", None), ("1f", None), ("", None), ("abc", None), ("inf", float("inf")), ("-Infinity", float("-inf")),
])
def test_float_parse_matches_producer(spark, text, expected):
    got = spark.createDataFrame([(text,)], "s string").select(M.parse_double(F.col("s")).alias("v")).first().v
    assert got == expected


def test_float_parse_nan(spark):
    got = spark.createDataFrame([("nan",)], "s string").select(M.parse_double(F.col("s")).alias("v")).first().v
    assert got != got


def test_dimension_fallback_metadata_wins(spark):
    df = spark.createDataFrame([({"image-width": "300"}, 100), ({}, 100)], "metadata map<string,string>, w int")
    got = [r.v for r in df.select(M.meta_int("metadata", M.KEY_IMAGE_WIDTH, F.col("w")).alias("v")).collect()]
    assert got == [300, 100]


def test_parse_errors_listed(spark):
    df = meta_df(spark, [{"image-width": "12.0", "compression-ratio": "x"}, SAMPLE])
    rows = df.select("i", M.parse_errors("metadata").alias("e")).orderBy("i").collect()
    assert len(rows[0].e) == 2 and "image_width" in rows[0].e[0]
    assert rows[1].e == []


def test_log_label_falls_back_to_key_prefix(spark):
    df = spark.createDataFrame([({}, "2024/01/01/abc.png.zst"), ({"content-hash": "h1"}, "k")],
                               "metadata map<string,string>, key string")
    got = [r.v for r in df.select(M.log_label("metadata", "key").alias("v")).collect()]
    assert got == ["2024/01/01/a", "h1"]


def test_pdf_property_absent_is_null(spark):
    df = spark.createDataFrame([({"Producer": "pdfTeX"},), ({},)], "props map<string,string>")
    got = [r.v for r in df.select(M.meta_get("props", "Producer").alias("v")).collect()]
    assert got == ["pdfTeX", None]
