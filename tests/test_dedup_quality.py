import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from capture_lake.operators import dedup, metrics, quality

T0 = dt.datetime(2024, 1, 1)


def batch(spark, rows):
    return spark.createDataFrame(rows, "key string, file_hash string, last_modified timestamp")


def test_anti_join_keeps_empty_hashes(spark):
    b = batch(spark, [("a", "h1", T0), ("b", "h2", T0), ("c", "", T0), ("d", "", T0)])
    target = spark.createDataFrame([("h1",), ("",)], "file_hash string")
    assert sorted(r.key for r in dedup.drop_captured(b, target).collect()) == ["b", "c", "d"]
    assert sorted(r.key for r in dedup.already_captured(b, target).collect()) == ["a"]
    assert dedup.drop_captured(b, None).count() == 4


def test_first_per_hash_is_deterministic(spark):
    b = batch(spark, [("z", "h", T0 + dt.timedelta(minutes=1)), ("y", "h", T0), ("x", "h", T0),
                      ("e1", "", T0), ("e2", "", T0)])
    assert sorted(r.key for r in dedup.first_per_hash(b).collect()) == ["e1", "e2", "x"]


def test_first_per_hash_plans_map_side_limit(spark):
    b = batch(spark, [("x", "h", T0)])
    plan = dedup.first_per_hash(b)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_hot_hash_group(spark):
    # one hash holds a third of the rows: still exactly one winner
    rows = [(f"k{i:05d}", "hot" if i % 3 == 0 else f"h{i}", T0 + dt.timedelta(seconds=i)) for i in range(3000)]
    b = batch(spark, rows).repartition(8)
    out = dedup.first_per_hash(b)
    assert out.count() == 2001
    assert out.where(F.col("file_hash") == "hot").first().key == "k00000"


def test_distinct_keys_minus_seen(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "key string")
    seen = spark.createDataFrame([("b",)], "key string")
    assert [r.key for r in dedup.distinct_keys(df, ["key"], seen).collect()] == ["a"]


def test_hash_exists_point_lookup(spark):
    t = spark.createDataFrame([("h1",)], "file_hash string")
    assert dedup.hash_exists(t, "h1") and not dedup.hash_exists(t, "h2")


def record_rows(spark, rows):
    return spark.createDataFrame(rows, "id int, image_width int, image_height int, ocr_confidence_mean double, "
                                       "compression_ratio double, processing_duration_ms bigint")


def test_rules_null_and_nan(spark):
    df = record_rows(spark, [(0, 10, 10, 0.5, 1.0, 5), (1, 0, 10, 0.5, 1.0, 5), (2, None, 10, 1.5, -1.0, -1),
                             (3, 10, 10, float("nan"), float("nan"), 0)])
    rows = {r.id: r for r in quality.check(df).collect()}
    assert rows[0].status == "ok" and rows[0].error is None
    assert rows[1].status == "quarantine" and rows[1].error == "image_width > 0"
    assert rows[2].error.split(",") == ["image_width > 0", "0 <= ocr_confidence_mean <= 1",
                                        "compression_ratio >= 0", "processing_duration_ms >= 0"]
    assert rows[3].error == "0 <= ocr_confidence_mean <= 1"  # NaN >= 0 holds, NaN BETWEEN fails
    counts = {r.rule: r.n_violations for r in quality.violation_counts(df).collect()}
    assert counts == {"image_width > 0": 2, "image_height > 0": 0, "0 <= ocr_confidence_mean <= 1": 2,
                      "compression_ratio >= 0": 1, "processing_duration_ms >= 0": 1}
    assert quality.check(df, []).where("status = 'ok'").count() == 4  # the rules can be left to reports


def test_histogram_cumulative(spark):
    vals = [0.05, 0.1, 0.2, 0.96, 1.0, 1.5, None]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    rows = metrics.histogram(df, "v", metrics.CONFIDENCE_BOUNDS).collect()
    buckets = {r.le: r.value for r in rows if r.series == "bucket"}
    assert buckets["0.1"] == 2 and buckets["0.3"] == 3 and buckets["0.95"] == 3 and buckets["0.99"] == 4
    assert buckets["1.0"] == 5 and buckets["+Inf"] == 6
    other = {r.series: r.value for r in rows if r.series != "bucket"}
    assert other["count"] == 6 and math.isclose(other["sum"], sum(v for v in vals if v is not None))


def test_batch_outcome(spark):
    res = spark.createDataFrame([("a", "ok", 1), ("b", "duplicate", 0), ("c", "quarantine", 0)],
                                "key string, status string, n_rows bigint")
    r = metrics.batch_outcome(res).first()
    assert (r.total, r.succeeded, r.files_extracted, r.rows_written) == (3, 2, 1, 1)


def test_empty_hash_third_spreads_over_partitions(spark):
    # a third of the batch has an empty hash: on the dedup key they spread
    rows = [(f"k{i:05d}", "" if i % 3 == 0 else f"h{i}", T0) for i in range(6000)]
    b = batch(spark, rows)
    parts = (b.repartition(8, dedup.dedup_key(b)).groupBy(F.spark_partition_id().alias("p")).count()
             .agg(F.max("count").alias("m")).first().m)
    assert parts < 6000 / 8 * 1.5
    # versus partitioning on the raw hash, where all 2000 land in one partition
    raw = b.repartition(8, "file_hash").groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
    assert raw >= 2000


def test_images_without_archive_key_spread_in_j3(spark):
    from capture_lake.plans.capture import attach_intake

    # a third of the images carry no archive key: they must not share one join key
    rows = [(f"k{i:05d}", {} if i % 3 == 0 else {"source-intake-key": f"z{i % 7}.zip"}) for i in range(6000)]
    images = spark.createDataFrame(rows, "key string, metadata map<string,string>")
    intake = spark.createDataFrame([(f"z{j}.zip", f"text{j}") for j in range(7)], "intake_key string, pdf_raw_text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = attach_intake(images, intake)
        assert out.count() == 6000 and out.where(F.col("pdf_raw_text") == "").count() == 2000
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan
        keyed = images.withColumn("k", F.when(F.try_element_at("metadata", F.lit("source-intake-key")).isNotNull(),
                                              F.lit("x")).otherwise(F.concat(F.lit("\u0000"), "key")))
        empty_rows = keyed.where(F.col("k") != "x").repartition(8, "k")
        biggest = empty_rows.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert biggest < 2000 / 8 * 1.6
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
