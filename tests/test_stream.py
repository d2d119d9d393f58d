"""Two-run streaming capture: new files, duplicate files, restart from checkpoint."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from capture_lake.session import scratch_path
from capture_lake.streaming.ingest import retry_queue, start_capture_stream

SCHEMA = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("size", T.LongType()),
    T.StructField("last_modified", T.TimestampType()),
    T.StructField("etag", T.StringType()),
    T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
])


def drop(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)


def meta(h, height="10"):
    return {"content-hash": h, "image-width": "10", "image-height": height}


def run(spark, src, ident, wh, ckpt):
    stream = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(src)
    totals = []
    q = start_capture_stream(spark, stream, ident, wh, ckpt, available_now=True, report=totals.append)
    q.awaitTermination()
    assert q.exception() is None
    return totals


def test_two_runs_with_restart(spark):
    base = scratch_path(spark, "stream-test")
    src, ckpt, wh = f"{base}/in", f"{base}/ckpt", f"{base}/wh"
    ident = "capture_lake_t.stream_records"
    spark.sql(f"DROP TABLE IF EXISTS {ident}")
    t0 = dt.datetime(2024, 1, 1)
    drop(spark, f"{src}/d0", [("a", 1, t0, "", meta("H1")), ("b", 1, t0, "", meta("H1")),
                              ("c", 1, t0, "", meta("")), ("q", 1, t0, "", meta("H9", "0"))])
    (first,) = run(spark, src, ident, wh, ckpt)
    assert (first["total"], first["succeeded"], first["files_extracted"], first["rows_written"]) == (4, 3, 2, 2)
    assert [r for r in first["confidence_histogram"] if r[0] == "count"][0][2] == 2
    assert [r for r in first["duration_histogram"] if r[0] == "count"][0][2] == 2
    drop(spark, f"{src}/d1", [("d", 1, t0, "", meta("H1")), ("e", 1, t0, "", meta("H2")),
                              ("f", 1, t0, "", meta(""))])
    run(spark, src, ident, wh, ckpt)  # restart: d0 is not read again
    spark.catalog.refreshTable(ident)
    rows = sorted((r.original_path, r.file_hash) for r in
                  spark.table(ident).select(F.coalesce("original_path", F.lit("")).alias("original_path"),
                                            "file_hash").collect())
    assert [h for _, h in rows].count("H1") == 1
    assert sorted(h for _, h in rows) == ["", "", "H1", "H2"]
    run(spark, src, ident, wh, ckpt)  # nothing new: no change
    spark.catalog.refreshTable(ident)
    assert spark.table(ident).count() == 4
    spark.sql(f"DROP TABLE IF EXISTS {ident}")


def test_retry_queue_is_the_latest_failure_per_key(spark):
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    log = spark.createDataFrame([
        ("k1", "quarantine", "e", t1), ("k1", "ok", None, t2), ("k2", "quarantine", "old", t1), ("k2", "quarantine", "new", t2),
        ("k3", "quarantine", "e3", t1), ("k4", "ok", None, t1), ("k5", "quarantine", "e5", t1), ("k5", "duplicate", None, t2),
    ], "key string, status string, error string, logged_at timestamp")
    assert sorted((r.key, r.error) for r in retry_queue(log).collect()) == [("k2", "new"), ("k3", "e3")]


def test_failed_copy_does_not_shadow_a_later_good_one(spark):
    base = scratch_path(spark, "stream-shadow")
    src, ckpt, wh = f"{base}/in", f"{base}/ckpt", f"{base}/wh"
    ident = "capture_lake_t.stream_shadow"
    spark.sql(f"DROP TABLE IF EXISTS {ident}")
    t0 = dt.datetime(2024, 1, 1)
    drop(spark, f"{src}/d0", [("a", 1, t0, "", meta("H1", "0")), ("b", 1, t0, "", meta("H1"))])
    run(spark, src, ident, wh, ckpt)
    drop(spark, f"{src}/d1", [("c", 1, t0, "", meta("H2", "0"))])
    run(spark, src, ident, wh, ckpt)
    drop(spark, f"{src}/d2", [("d", 1, t0, "", meta("H2"))])
    run(spark, src, ident, wh, ckpt)
    spark.catalog.refreshTable(ident)
    assert sorted(r.file_hash for r in spark.table(ident).collect()) == ["H1", "H2"]
    spark.sql(f"DROP TABLE IF EXISTS {ident}")


def test_processing_time_trigger(spark):
    base = scratch_path(spark, "stream-timed")
    src, ckpt, wh = f"{base}/in", f"{base}/ckpt", f"{base}/wh"
    ident = "capture_lake_t.stream_timed"
    spark.sql(f"DROP TABLE IF EXISTS {ident}")
    t0 = dt.datetime(2024, 1, 1)
    drop(spark, f"{src}/d0", [("a", 1, t0, "", meta("H1")), ("b", 1, t0, "", meta("H2"))])
    stream = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(src)
    q = start_capture_stream(spark, stream, ident, wh, ckpt, interval="1 second")
    try:
        q.processAllAvailable()
        drop(spark, f"{src}/d1", [("c", 1, t0, "", meta("H1")), ("d", 1, t0, "", meta("H3"))])
        q.processAllAvailable()
    finally:
        q.stop()
    spark.catalog.refreshTable(ident)
    assert sorted(r.file_hash for r in spark.table(ident).collect()) == ["H1", "H2", "H3"]
    spark.sql(f"DROP TABLE IF EXISTS {ident}")


def test_binary_file_listing_stream(spark):
    import os

    from conftest import png_bytes, zstd_bytes
    from capture_lake.streaming.ingest import listing_stream

    base = scratch_path(spark, "stream-files")
    root = base.replace("file:", "") + "/images"
    os.makedirs(f"{root}/2024/01/01")
    for name, w in (("a", 10), ("b", 20)):
        with open(f"{root}/2024/01/01/{name}.png.zst", "wb") as f:
            f.write(zstd_bytes(png_bytes(w, 5)))
    with open(f"{root}/2024/01/01/skip.txt", "wb") as f:
        f.write(b"x")
    manifest = spark.createDataFrame([("2024/01/01/a.png.zst", {"content-hash": "HA", "image-width": "10",
                                                                "image-height": "5"})],
                                     "key string, metadata map<string,string>")
    ident = "capture_lake_t.stream_files"
    spark.sql(f"DROP TABLE IF EXISTS {ident}")
    stream = listing_stream(spark, root, max_files_per_trigger=1)
    q = start_capture_stream(spark, stream, ident, f"{base}/wh", f"{base}/ckpt", available_now=True, manifest=manifest, bounded=True)
    q.awaitTermination()
    assert q.exception() is None
    spark.catalog.refreshTable(ident)
    got = sorted((r.file_hash, r.image_width) for r in spark.table(ident).collect())
    # b has no manifest row: empty map -> no dimensions -> quarantined, not written
    assert got == [("HA", 10)]
    spark.sql(f"DROP TABLE IF EXISTS {ident}")


def test_dedup_keys_stream(spark):
    from capture_lake.streaming.ingest import dedup_keys_stream

    base = scratch_path(spark, "stream-keys")
    schema = "key string, ts timestamp_ntz"
    t0 = dt.datetime(2024, 1, 1)
    spark.createDataFrame([("a", t0), ("a", t0 + dt.timedelta(minutes=1)), ("b", t0)], schema) \
        .write.parquet(f"{base}/in/d0")
    stream = spark.readStream.schema(schema).parquet(f"{base}/in/d0")
    q = (dedup_keys_stream(stream, ["key"], "ts", "10 minutes").writeStream.format("memory")
         .queryName("dedup_keys_out").option("checkpointLocation", f"{base}/ckpt").start())
    q.processAllAvailable()
    q.stop()
    assert sorted(r.key for r in spark.table("dedup_keys_out").collect()) == ["a", "b"]


@pytest.mark.parametrize("dies_at", ["records", "quarantine", "results", "commit", None])
def test_a_batch_that_dies_anywhere_leaves_no_repeated_row(spark, monkeypatch, dies_at):
    """The job is ended before one of its writes, or after the last; the replay gives every row once,
    those without a hash and the failures too."""
    from capture_lake.sinks.commits import Commits
    from capture_lake.sources.tables import read_target
    from capture_lake.streaming import ingest

    base = scratch_path(spark, "stream-replay")
    ident = f"capture_lake_t.stream_replay_{dies_at}"
    spark.sql(f"DROP TABLE IF EXISTS {ident}")
    wh, t0 = f"{base}/wh", dt.datetime(2024, 1, 1)
    frame = lambda rows: spark.createDataFrame(rows, SCHEMA)
    ingest.capture_batch(frame([("z", 1, t0, "", meta("H0"))]), ident, wh, batch_id=0)
    batch = frame([("a", 1, t0, "", meta("H1")), ("e", 1, t0, "", meta("")), ("q", 1, t0, "", meta("", "0"))])

    class Died(Exception):
        pass

    def die(*args, **kw):
        raise Died

    with monkeypatch.context() as m:
        if dies_at == "records":
            m.setattr(ingest, "append_records", die)
        elif dies_at == "commit":
            m.setattr(Commits, "commit", die)
        elif dies_at is not None:
            plain = ingest.table_sidecar
            m.setattr(ingest, "table_sidecar", lambda w, i, what: die() if what == dies_at else plain(w, i, what))
        if dies_at is None:
            assert ingest.capture_batch(batch, ident, wh, batch_id=1)["rows_written"] == 2
        else:
            with pytest.raises(Died):
                ingest.capture_batch(batch, ident, wh, batch_id=1)
            assert [r.file_hash for r in read_target(spark, ident).collect()] == ["H0"]  # nothing staged counts
    again = ingest.capture_batch(batch, ident, wh, batch_id=1)
    assert again.get("skipped", False) == (dies_at is None)
    assert ingest.capture_batch(batch, ident, wh, batch_id=1)["skipped"]
    assert sorted(r.file_hash for r in read_target(spark, ident).collect()) == ["", "H0", "H1"]
    side = {what: ingest.read_sidecar(spark, ingest.table_sidecar(wh, ident, what), ident, wh) for what in ("quarantine", "results")}
    assert [r.key for r in side["quarantine"].collect()] == ["q"]
    assert sorted(r.key for r in side["results"].collect()) == ["a", "e", "q", "z"]
    spark.sql(f"DROP TABLE IF EXISTS {ident}")
