import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from capture_lake.operators.extractor import run_extractor
from capture_lake.schema import RECORD_COLUMNS, empty_records
from capture_lake.sinks.table import append_records, split_identifier, table_location
from capture_lake.sources.tables import record_exists, table_exists
from capture_lake.session import scratch_path

OUT = T.StructType([T.StructField("n", T.LongType()), T.StructField("pid", T.LongType())])


def test_factory_once_per_task_and_errors_isolated(spark):
    def factory():
        pid = os.getpid()
        calls = {"n": 0}

        def fn(text):
            calls["n"] += 1
            if text == "bad":
                raise ValueError("cannot read")
            return {"n": len(text), "pid": pid}
        return fn

    df = spark.createDataFrame([(i, "bad" if i == 3 else "x" * i) for i in range(20)], "i int, text string").repartition(2)
    out = run_extractor(df, factory, ["text"], OUT, elapsed_col="ms").orderBy("i").collect()
    assert [r.n for r in out if r.i != 3] == [i for i in range(20) if i != 3]
    bad = out[3]
    assert bad.n is None and bad.error == "ValueError: cannot read"
    assert all(r.ms >= 0 for r in out)


def test_empty_policy(spark):
    def factory():
        def fn(b):
            raise RuntimeError("not a pdf")
        return fn

    df = spark.createDataFrame([(1, b"x")], "i int, b binary")
    pages = T.StructType([T.StructField("pages", T.ArrayType(T.StringType()))])
    r = run_extractor(df, factory, ["b"], pages, on_error="empty", empty=[]).first()
    assert r.pages == [] and r.error is None


def test_identifier_rules():
    assert split_identifier("lake.records_raw") == ("lake", "records_raw")
    assert split_identifier("a.b.c") == ("a", "b.c")
    with pytest.raises(ValueError):
        split_identifier("nodotintablename")
    assert table_location("s3a://lake/", "ns.tbl") == "s3a://lake/tbl"


def record(spark, h, day):
    row = {c: None for c in RECORD_COLUMNS}
    row.update(file_hash=h, original_path=f"/p/{h}", source_zip="z.zip", image_width=100, image_height=200,
               compression_ratio=1.5, processing_duration_ms=500, pdf_producer="p", pdf_creator="c",
               ocr_raw_text="t", ocr_confidence_mean=0.9, pdf_raw_text="", watcher_version="1")
    return spark.createDataFrame([row], empty_records(spark).schema).withColumn(
        "processed_at", F.lit(f"{day} 10:00:00").cast("timestamp"))


def test_create_append_and_lookup(spark):
    wh = scratch_path(spark, "wh-test")
    ident = "capture_lake_t.records_sink"
    spark.sql(f"DROP TABLE IF EXISTS {ident}")
    assert not table_exists(spark, ident)
    append_records(empty_records(spark), ident, wh)  # empty append creates the table
    assert table_exists(spark, ident) and spark.table(ident).count() == 0
    counters = append_records(record(spark, "h1", "2024-01-01"), ident, wh)
    assert counters == {"rows_written": 1, "rows_with_hash": 1}
    append_records(record(spark, "h2", "2024-01-02"), ident, wh)
    t = spark.table(ident)
    assert t.count() == 2
    assert sorted(str(r.processed_at_day) for r in t.select("processed_at_day").collect()) == ["2024-01-01", "2024-01-02"]
    assert record_exists(spark, ident, "h1") and not record_exists(spark, ident, "h3")
    loc = table_location(wh, ident).replace("file:", "")
    assert sorted(d for d in os.listdir(loc) if d.startswith("processed_at_day")) == [
        "processed_at_day=2024-01-01", "processed_at_day=2024-01-02"]
    assert not table_exists(spark, "missing_ns.tbl")
    spark.sql(f"DROP TABLE IF EXISTS {ident}")


def test_rest_catalog_conf():
    from capture_lake.sinks.catalog import rest_catalog_conf

    conf = rest_catalog_conf("lake", "http://catalog:8181", "s3://lake", s3_endpoint="http://s3:9000")
    assert conf["spark.sql.catalog.lake.type"] == "rest"
    assert conf["spark.sql.catalog.lake.s3.path-style-access"] == "true"
    assert "spark.sql.catalog.lake.s3.access-key-id" not in conf
    assert "spark.sql.catalog.lake.s3.endpoint" not in rest_catalog_conf("c", "u", "w")


def test_malformed_output_is_a_row_error(spark):
    def factory():
        def fn(i):
            return {"n": "not a number" if i == 2 else i, "pid": 0}
        return fn

    df = spark.createDataFrame([(i,) for i in range(5)], "i int")
    rows = {r.i: r for r in run_extractor(df, factory, ["i"], OUT).collect()}
    assert rows[2].n is None and rows[2].error.startswith("Arrow")
    assert [rows[i].n for i in (0, 1, 3, 4)] == [0, 1, 3, 4] and rows[0].error is None


def test_results_are_held_for_a_part_of_a_batch():
    import pyarrow as pa

    from capture_lake.operators import extractor

    batch = pa.RecordBatch.from_pydict({"k": list(range(1000)), "b": [b"x" * 1024] * 1000})
    parts = list(extractor.in_parts(batch, 64 * 1024))
    assert len(parts) >= 15 and max(p.num_rows for p in parts) <= 64
    assert pa.Table.from_batches(parts).column("k").to_pylist() == list(range(1000))
    assert [p.num_rows for p in extractor.in_parts(batch, 1)] == [1] * 1000  # a row at least
    assert [p.num_rows for p in extractor.in_parts(batch.slice(0, 0))] == [0]


def test_batches_of_a_prepared_session_are_small(spark):
    from capture_lake.session import prepare

    prepare(spark)
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 4 * 1024 * 1024
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 2000
