"""Plan checks: pushed filters, pruned columns, no Python below the dedup join."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from capture_lake.operators import dedup
from conftest import SF_SMALL


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_target_hash_scan_is_pruned_and_pushed(spark, tmp_dir):
    path = f"{tmp_dir}/target"
    spark.createDataFrame([("h1", "p", "x" * 10)], "file_hash string, original_path string, big string") \
        .write.parquet(path)
    target = spark.read.parquet(path)
    batch = spark.createDataFrame([("k", "h1")], "key string, file_hash string")
    plan = plan_of(dedup.drop_captured(batch, target))
    scan = [l for l in plan.split("\n") if "FileScan parquet" in l][0]
    assert "ReadSchema: struct<file_hash:string>" in scan
    assert "PushedFilters: [IsNotNull(file_hash), Not(EqualTo(file_hash,))]" in scan


def test_listing_interval_pushed_to_scan(spark):
    df = E.queries()["list_objects_interval"](spark, SF_SMALL)
    plan = plan_of(df)
    assert "documents.parquet" in plan
    scan = [l for l in plan.split("\n") if "FileScan parquet" in l][0]
    assert "ReadSchema: struct<doc_id:bigint,text:string,source:string,n_chars:bigint>" in scan


def test_histogram_is_one_pass(spark):
    df = E.queries()["confidence_histogram"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("Aggregate") == 1


def test_regions_expand_without_join(spark):
    plan = plan_of(E.queries()["crop_boxes"](spark, SF_SMALL))
    assert "Join" not in plan and "CartesianProduct" not in plan


def test_bounded_batch_filters_target_map_side(spark, tmp_dir):
    path = f"{tmp_dir}/target_big"
    spark.range(5000).selectExpr("md5(cast(id as string)) as file_hash", "'p' as original_path") \
        .write.parquet(path)
    target = spark.read.parquet(path)
    batch = spark.createDataFrame([("k1", "h1"), ("k2", ""), ("k3", "c4ca4238a0b923820dcc509a6f75849b")],
                                  "key string, file_hash string")
    out = dedup.drop_captured(batch, target, bounded=True)
    plan = plan_of(out)
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    assert sorted(r.key for r in out.collect()) == ["k1", "k2"]
    # without a bound: the general join, same answer
    big = dedup.drop_captured(batch, target)
    assert sorted(r.key for r in big.collect()) == ["k1", "k2"]


def test_bounded_listing_filters_manifest_map_side(spark, tmp_dir):
    from capture_lake.sources.listing import attach_metadata

    path = f"{tmp_dir}/manifest_big"
    spark.range(5000).selectExpr("concat('k', cast(id as string)) as key",
                                 "map('content-hash', md5(cast(id as string))) as metadata").write.parquet(path)
    manifest = spark.read.parquet(path)
    listing = spark.createDataFrame([("k1",), ("k7",), ("zz",)], "key string")
    plain = sorted((r.key, r.metadata.get("content-hash")) for r in attach_metadata(listing, manifest).collect())
    reduced = attach_metadata(listing, manifest, bounded=True)
    assert sorted((r.key, r.metadata.get("content-hash")) for r in reduced.collect()) == plain
    assert dict(plain)["zz"] is None
    plan = plan_of(reduced)
    # the scan of the manifest is filtered before anything is exchanged
    scan = plan.index("manifest_big")
    assert plan[:scan].rindex("BroadcastHashJoin") > plan[:scan].rindex("Exchange hashpartitioning(key")


def test_latest_manifest_row_per_key(spark):
    from capture_lake.sources.listing import attach_metadata

    manifest = spark.createDataFrame([("a", {"v": "1"}, 1), ("a", {"v": "2"}, 3), ("a", {"v": "9"}, 2), ("b", {"v": "1"}, 1)],
                                     "key string, metadata map<string,string>, updated_at int")
    listing = spark.createDataFrame([("a",), ("b",), ("c",)], "key string")
    for bounded in (False, True):
        got = sorted((r.key, r.metadata.get("v")) for r in attach_metadata(listing, manifest, bounded=bounded).collect())
        assert got == [("a", "2"), ("b", "1"), ("c", None)]
        twice = attach_metadata(listing, manifest.drop("updated_at").union(manifest.drop("updated_at")), bounded=bounded)
        assert twice.count() == 3
