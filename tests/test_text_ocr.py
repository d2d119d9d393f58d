import pytest
from pyspark.sql import functions as F

from capture_lake.functions.text import join_pages, unicode_strip
from capture_lake.operators import ocr, pdf

RAW_SCHEMA = "i int, ocr_raw array<array<struct<text:string,confidence:double>>>"


@pytest.mark.parametrize("text,expected", [
    ("  hello  ", "hello"), ("\x1c\x1dx\x1e\x1f", "x"), ("　a b ", "a b"), ("\t\n\r", ""),
    (" x ", "x"), ("a​b", "a​b"),
])
def test_unicode_strip_matches_str_strip(spark, text, expected):
    assert expected == text.strip()
    got = spark.createDataFrame([(text,)], "s string").select(unicode_strip(F.col("s")).alias("v")).first().v
    assert got == expected


def test_pages_joined_with_separator(spark):
    df = spark.createDataFrame([(["cover", "appendix B"],), (["only"],), (["", None, " x "],), (None,),
                                ([" ", "a"],)], "pages array<string>")
    got = [r.v for r in df.select(join_pages(F.col("pages")).alias("v")).collect()]
    assert got == ["cover\n---\nappendix B", "only", "x", "", "---\na"]


def test_ocr_lines_of_one_block(spark):
    df = spark.createDataFrame([(0, [[{"text": "total", "confidence": 0.25}, {"text": "41,50", "confidence": 0.75}]])],
                               RAW_SCHEMA)
    r = ocr.summarize_raw(df).first()
    assert r.ocr_raw_text == "total 41,50"
    assert r.ocr_confidence_mean == pytest.approx(0.5)


def test_ocr_empty_and_null_results(spark):
    df = spark.createDataFrame([(0, [[]]), (1, None), (2, [None]), (3, [])], RAW_SCHEMA)
    rows = ocr.summarize_raw(df).orderBy("i").collect()
    assert [(r.ocr_raw_text, r.ocr_confidence_mean) for r in rows] == [("", 0.0)] * 4


def test_ocr_null_block_and_bad_lines_skipped(spark):
    raw = [None, [{"text": "a", "confidence": 0.5}, None, {"text": None, "confidence": 0.1}],
           [{"text": "b", "confidence": None}, {"text": "c", "confidence": 1.0}]]
    df = spark.createDataFrame([(0, raw)], RAW_SCHEMA)
    r = ocr.summarize_raw(df).first()
    assert r.ocr_raw_text == "a c" and r.ocr_confidence_mean == pytest.approx(0.75)
    lines = ocr.explode_lines(df, ["i"]).orderBy("line_no").collect()
    assert [(x.line_no, x.text) for x in lines] == [(0, "a"), (1, "c")]


def test_grouped_lines_ordered_and_left_joined(spark):
    lines = spark.createDataFrame([("k1", 2, "left", 0.375), ("k1", 1, "right", 0.625)],
                                  "key string, n int, text string, confidence double")
    images = spark.createDataFrame([("k1",), ("k2",)], "key string")
    out = ocr.attach_ocr(images, ocr.summarize_lines(lines, "key", "n"), "key", "key").orderBy("key").collect()
    assert out[0].ocr_raw_text == "right left" and out[0].ocr_confidence_mean == pytest.approx(0.5)
    assert (out[1].ocr_raw_text, out[1].ocr_confidence_mean) == ("", 0.0)


def test_page_rows_skip_empty(spark):
    df = spark.createDataFrame([(1, ["a", "", None, " "])], "d int, pages array<string>")
    rows = pdf.page_rows(df, ["d"], "pages").orderBy("page_no").collect()
    assert [(r.page_no, r.text) for r in rows] == [(0, "a"), (3, " ")]
    assembled = pdf.assemble_pages(pdf.page_rows(df, ["d"], "pages"), "d").first()
    assert assembled.pdf_raw_text == "a\n---"


def test_engine_entries_of_any_shape(spark):
    from capture_lake.operators.ocr import RAW_TYPE, lines_from_engine

    box = [[0, 0], [4, 0], [4, 2], [0, 2]]
    results = [
        [[[box, ["sum", 0.5]], [box, ["9 kg", 1.0]]], [{"text": "net", "confidence": 0.75}]],  # both shapes, two blocks
        [[], None, [[box, [12, "0.25"]]]],  # values are converted
        [[[box], [box, None], [box, ["no score"]], None, {"text": "x"}, []]],  # entries that lack something
        None, [],
    ]
    df = spark.createDataFrame([(i, lines_from_engine(r)) for i, r in enumerate(results)], "i int, ocr_raw " + RAW_TYPE.simpleString())
    got = {r.i: (r.ocr_raw_text, r.ocr_confidence_mean) for r in ocr.summarize_raw(df).collect()}
    assert got == {0: ("sum 9 kg net", 0.75), 1: ("12", 0.25), 2: ("", 0.0), 3: ("", 0.0), 4: ("", 0.0)}
    with pytest.raises(ValueError):
        lines_from_engine([[[box, ["sum", "sure"]]]])
