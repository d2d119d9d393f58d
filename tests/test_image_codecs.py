import io
import zipfile

import pytest
from pyspark.sql import functions as F

from capture_lake.functions import image as IMG
from capture_lake.functions.codecs import zip_members, zstd_inflate
from capture_lake.operators import pdf
from conftest import png_bytes, zstd_bytes

REGIONS = {
    "full": (0.0, 0.0, 1.0, 1.0), "top": (0.0, 0.0, 1.0, 0.23), "inner": (0.25, 0.3, 0.75, 0.6),
    "zero_width": (0.3, 0.1, 0.3, 0.9), "zero_height": (0.2, 0.75, 0.8, 0.75), "out": (-0.25, -0.75, 1.25, 2.0),
}


def boxes(spark, w, h):
    rows = [(n, *r) for n, r in REGIONS.items()]
    df = spark.createDataFrame(rows, "name string, x0 double, y0 double, x1 double, y1 double")
    b = IMG.pixel_box(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"), F.lit(w), F.lit(h))
    out = df.select("name", b.alias("b")).select("name", "b.*", IMG.box_ok(F.col("b")).alias("ok"),
                                                 IMG.box_error(F.col("b"), F.lit(w), F.lit(h)).alias("err"))
    return {r.name: r for r in out.collect()}


def test_boxes_truncate_and_flag_zero_area(spark):
    got = boxes(spark, 200, 100)
    assert (got["full"].left, got["full"].upper, got["full"].right, got["full"].lower) == (0, 0, 200, 100)
    assert got["top"].lower == 23 and got["top"].right == 200  # 23 % of 100 px
    c = got["inner"]
    assert (c.left, c.upper, c.right, c.lower, c.ok) == (50, 30, 150, 60, True)
    assert not got["zero_width"].ok and "zero-area" in got["zero_width"].err
    assert not got["zero_height"].ok
    o = got["out"]  # not clamped
    assert (o.left, o.upper, o.right, o.lower, o.ok) == (-50, -75, 250, 200, True)


def test_negative_truncates_toward_zero(spark):
    got = boxes(spark, 7, 7)["out"]
    assert got.left == -1 and got.upper == -5  # -1.75 and -5.25


def test_png_header_dimensions(spark):
    df = spark.createDataFrame([(png_bytes(200, 100),), (b"not an image",), (b"",)], "img binary")
    rows = df.select(IMG.png_width(F.col("img")).alias("w"), IMG.png_height(F.col("img")).alias("h")).collect()
    assert [(r.w, r.h) for r in rows] == [(200, 100), (None, None), (None, None)]


def test_inflate_errors_are_values(spark):
    good = zstd_bytes(png_bytes(100, 50))
    df = spark.createDataFrame([(0, good), (1, b""), (2, b"\x00" * 16), (3, zstd_bytes(b"plain text"))],
                               "i int, blob binary")
    rows = df.select("i", zstd_inflate(F.col("blob")).alias("r")).orderBy("i").collect()
    assert rows[0].r.payload == png_bytes(100, 50) and rows[0].r.error is None
    assert rows[1].r.payload is None and rows[1].r.error.startswith("ValueError")
    assert rows[2].r.payload is None and rows[2].r.error.startswith("ZstdError")
    assert rows[3].r.payload == b"plain text"  # inflates, but is not an image
    dims = df.select(zstd_inflate(F.col("blob")).alias("r")).select(IMG.png_width(F.col("r.payload")).alias("w"))
    assert [r.w for r in dims.collect()] == [100, None, None, None]


def make_zip(members):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        for n, c in members:
            zf.writestr(n, c)
    return buf.getvalue()


def test_first_pdf_in_archive_order_any_case(spark):
    z1 = make_zip([("b.txt", b"x"), ("Z.PDF", b"zz"), ("a.pdf", b"aa")])
    z2 = make_zip([("only.txt", b"t")])
    df = spark.createDataFrame([(1, z1), (2, z2), (3, b"garbage")], "k int, content binary")
    rows = pdf.first_pdf(df).orderBy("k").collect()
    assert (rows[0].pdf_name, rows[0].pdf_bytes) == ("Z.PDF", b"zz")
    assert rows[1].pdf_name is None and rows[1].pdf_bytes is None and rows[1].archive_error is None
    assert rows[2].pdf_name is None and rows[2].archive_error.startswith("BadZipFile")


def test_members_exploded_in_order(spark):
    z = make_zip([("b.txt", b"x"), ("a.pdf", b"aa")])
    df = spark.createDataFrame([(1, z)], "k int, content binary")
    rows = pdf.explode_members(df, "k").collect()
    assert [(r.member_index, r.name, r.size) for r in rows] == [(0, "b.txt", 1), (1, "a.pdf", 2)]
    assert [r.name for r in df.select(F.inline(zip_members("content").members)).collect()] == ["b.txt", "a.pdf"]


@pytest.mark.parametrize("name,ok", [("a.pdf", True), ("A.PdF", True), ("a.pdf.txt", False), ("pdf", False)])
def test_pdf_suffix_predicate(spark, name, ok):
    got = spark.createDataFrame([(name,)], "n string").select(pdf.is_pdf_name(F.col("n")).alias("v")).first().v
    assert got is ok


def test_inflate_and_members_have_no_size_cap():
    from capture_lake.functions import codecs

    big = bytes(64) * (1 << 20)  # 64 MiB from a few bytes
    assert codecs.inflate_one(zstd_bytes(big)) == (big, None)
    name, content, err = codecs.first_member_one(make_zip([("a.pdf", b"y" * 5_000_000)]), ".pdf")
    assert (name, len(content), err) == ("a.pdf", 5_000_000, None)
