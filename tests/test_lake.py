"""Hash index, compaction, cumulative metrics, keyed state, streaming counters, object stream."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from capture_lake.operators import hash_index, metrics
from capture_lake.schema import empty_records
from capture_lake.session import scratch_path
from capture_lake.sinks.commits import Commits
from capture_lake.sinks.compact import compact, table_files
from capture_lake.sinks.table import append_records
from capture_lake.sources.tables import read_target, table_place
from test_stream import SCHEMA, drop, meta


def records(spark, n, start=0, day="2024-01-01"):
    rows = spark.range(start, start + n).select(
        F.concat(F.lit("h"), "id").alias("file_hash"), F.lit(f"{day} 10:00:00").cast("timestamp").alias("processed_at"), F.concat(F.lit("p"), "id").alias("original_path"))
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in empty_records(spark).schema if f.name not in rows.columns]
    return rows.select("*", *missing)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_index_is_never_exchanged(spark, monkeypatch):
    base = scratch_path(spark, "index-test")
    ident = f"capture_lake_t.idx_{base[-8:]}"
    commits = Commits(spark, f"{base}_commits")
    spark.sql("CREATE NAMESPACE IF NOT EXISTS capture_lake_t")
    for i in range(3):
        hash_index.append_hashes(records(spark, 500, 500 * i), ident, base, f"b{i}", buckets=16)
        if i < 2:
            commits.commit(f"b{i}", [f"b{i}"])
    batch = spark.createDataFrame([("k1", "h3"), ("k2", "h3"), ("k3", "h700"), ("k4", "h1200"), ("k5", ""), ("k6", None), ("k7", "new")], "key string, file_hash string")
    seen = []
    plain = hash_index.stored
    monkeypatch.setattr(hash_index, "stored", lambda df: seen.append(plan_of(df)) or plain(df))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = {r.key: r.captured for r in hash_index.mark_captured(batch, ident, commits).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert got == {"k1": True, "k2": True, "k3": True, "k4": False, "k5": False, "k6": False, "k7": False}  # b2 was never committed
    (plan,) = seen
    lines = plan.split("\n")
    assert "SortMergeJoin" in plan and "SelectedBucketsCount: 16 out of 16" in plan
    # one exchange: the batch's own, dealt by its key; none between the index and the join
    exchanges = [l for l in lines if "Exchange" in l]
    assert len(exchanges) == 1 and "REPARTITION_BY_NUM" in exchanges[0] and "__dkey" in exchanges[0]
    assert hash_index.hash_exists(spark, ident, "h3", commits) and not hash_index.hash_exists(spark, ident, "h1200", commits)
    assert not hash_index.hash_exists(spark, ident, "", commits)
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")  # only so that the plan tells the buckets
    try:
        lookup = plan_of(spark.table(hash_index.index_name(ident)).where("file_hash = 'h3'"))
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert "SelectedBucketsCount: 1 out of 16" in lookup


def test_the_index_makes_its_namespace(spark):
    base = scratch_path(spark, "index-alone")
    ident = f"lake_{base[-8:]}.records"  # no record was written, so nothing has made the namespace
    commits = Commits(spark, f"{base}_commits")
    assert not hash_index.hash_exists(spark, ident, "h1", commits)
    hash_index.append_hashes(records(spark, 10), ident, base, "b0")
    commits.commit("b0", ["b0"])
    assert hash_index.hash_exists(spark, ident, "h1", commits) and not hash_index.hash_exists(spark, ident, "h10", commits)


def test_compaction_swaps_many_files_for_few(spark):
    base = scratch_path(spark, "compact-test")
    ident = f"capture_lake_t.cmp_{base[-8:]}"
    for i in range(6):
        append_records(records(spark, 100, 100 * i, f"2024-01-0{1 + i % 2}").repartition(3), ident, base)
    append_records(records(spark, 10, 5000), ident, base, batch="never-committed")
    before = sorted(tuple(r) for r in read_target(spark, ident).select("file_hash", "processed_at_day").collect())
    assert len(before) == 600
    done = compact(spark, ident)
    assert done == {"files_before": 18, "files_after": 2}
    assert sorted(tuple(r) for r in read_target(spark, ident).select("file_hash", "processed_at_day").collect()) == before
    assert compact(spark, ident)["files_after"] == 2  # nothing more to gain
    place = table_place(spark, ident)
    live = Commits(spark, f"{place}_commits").live(table_files(spark, place))
    assert live.count() == 2
    append_records(records(spark, 5, 900, "2024-01-02"), ident, base)
    assert read_target(spark, ident).count() == 605


def test_bins_respect_the_target(spark):
    from capture_lake.sinks.compact import plan_bins

    files = spark.createDataFrame([(dt.date(2024, 1, 1 + i % 2), f"b{i % 5}", f"f{i}", 100 + i) for i in range(100)] + [(dt.date(2024, 1, 1), "big", "f", 10_000)],
                                  "processed_at_day date, capture_batch string, name string, length long")
    plan = plan_bins(files, 1000)
    assert plan.where("capture_batch = 'big'").count() == 0
    bins = plan.join(files, ["processed_at_day", "capture_batch", "name"]).groupBy("processed_at_day", "bin").agg(F.sum("length").alias("n")).collect()
    assert max(b.n for b in bins) <= 1000 + 199
    assert len(bins) <= sum(-(-files.where(F.col("length") < 1000).where(F.col("processed_at_day") == d).agg(F.sum("length")).first()[0] // 1000) for d in {b.processed_at_day for b in bins})


def test_states_add_up_to_the_union(spark):
    rows = spark.range(5000).select(
        F.when(F.col("id") % 9 == 0, "quarantine").when(F.col("id") % 10 == 0, "duplicate").otherwise("ok").alias("status"), F.lit(1).cast("bigint").alias("n_rows"),
        (F.col("id") % 101 / 100).alias("ocr_confidence_mean"), (F.col("id") * 7).alias("processing_duration_ms"))
    parts = [metrics.metric_state(rows.where(f"pmod(hash(ocr_confidence_mean), 3) = {i}")) for i in range(3)]
    state = metrics.cumulative(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    once = metrics.metric_state(rows)
    for name in ("conf", "dur"):
        assert [tuple(r) for r in metrics.state_histogram(state, name).collect()] == [
            (s, le, pytest.approx(v)) for s, le, v in metrics.state_histogram(once, name).collect()]
    ok = sorted(r[0] / 1000 for r in rows.where("status = 'ok'").select("processing_duration_ms").collect())
    for q in (0.1, 0.5, 0.99):
        value = state.select(metrics.state_quantile("dur", q)).first()[0]
        assert abs(sum(v <= value for v in ok) / len(ok) - q) < 0.02
    none = metrics.cumulative(metrics.metric_state(rows.limit(0)))
    assert none.first()["total"] == 0 and none.select(metrics.state_quantile("dur", 0.5)).first()[0] is None


def test_keyed_state_and_counters(spark):
    """Copies over three drops, with a restart each: the first passing one is written; the listener's counters
    are the written rows."""
    from capture_lake.streaming.state import CaptureCounters, start_state_stream

    base = scratch_path(spark, "keyed-test")
    t = [dt.datetime(2024, 1, 1, h) for h in range(4)]
    drops = [
        [("a", 1, t[1], "", meta("H1", "0")), ("b", 1, t[0], "", meta("H2")), ("c", 1, t[1], "", meta("H2")), ("e", 1, t[0], "", meta(""))],
        [("d", 1, t[3], "", meta("H1")), ("f", 1, t[2], "", meta("H1")), ("g", 1, t[0], "", meta("H2")), ("e2", 1, t[0], "", meta(""))],
        [("h", 1, t[0], "", meta("H1")), ("i", 1, t[0], "", meta("H3"))],
    ]
    counters = CaptureCounters()
    spark.streams.addListener(counters)
    provider = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    try:
        for i, rows in enumerate(drops):
            drop(spark, f"{base}/in/d{i}", rows)
            stream = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(f"{base}/in")
            q = start_state_stream(spark, stream.withColumn("path", F.col("key")), f"{base}/out", f"{base}/ck", available_now=True)
            q.awaitTermination()
            assert q.exception() is None
        for _ in range(50):
            if counters.totals.get("rows_written") == 5:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(counters)
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", provider)
    out = spark.read.parquet(f"{base}/out")
    assert sorted((r.file_hash, r.image_width) for r in out.collect()) == [("", 10), ("", 10), ("H1", 10), ("H2", 10), ("H3", 10)]
    assert counters.totals == {"rows_written": 5, "rows_with_hash": 3}


def test_a_call_of_the_state_processor_has_many_hashes():
    """The first passing row of each of a group's hashes, over frames and calls, as one frame a call."""
    import pandas as pd

    from capture_lake.streaming.state import FirstPassing

    class Flags(dict):
        containsKey, updateValue = dict.__contains__, dict.__setitem__

    class Handle:
        def getMapState(self, *args):
            return Flags()

        def getValueState(self, *args):  # what one hash a call would need
            raise AssertionError("a state for one hash only")

    p = FirstPassing(1000, ("last_modified", "key"), ["file_hash", "original_path"])
    p.init(Handle())
    frame = lambda *rows: pd.DataFrame([(7, h, t, k, k) for h, t, k in rows], columns=["__group", "file_hash", "last_modified", "key", "original_path"])
    run = lambda *frames: [[tuple(r) for r in f.sort_values("file_hash").itertuples(index=False)] for f in p.handleInputRows((7,), iter(frames), None)]
    assert run(frame(("H1", 2, "b"), ("H2", 1, "z"), ("H1", 2, "a")), frame(("H2", 1, "c"), ("H3", 5, "d"))) == [[("H1", "a"), ("H2", "c"), ("H3", "d")]]
    assert run(frame(("H1", 0, "e"))) == []
    assert run(frame(("H4", 9, "f"), ("H3", 0, "g"))) == [[("H4", "f")]]


def test_object_stream_over_restarts(spark):
    from capture_lake.streaming.objects import object_stream

    base = scratch_path(spark, "objects-test").replace("file:", "")

    def put(*names):
        for n in names:
            os.makedirs(os.path.dirname(f"{base}/in/{n}"), exist_ok=True)
            with open(f"{base}/in/{n}", "wb") as f:
                f.write(n.encode())
        time.sleep(1.0)

    def run():
        q = object_stream(spark, f"{base}/in", settle=0.3).select("key", "size").writeStream.format("parquet").option("path", f"{base}/out").option(
            "checkpointLocation", f"{base}/ck").trigger(availableNow=True).start()
        q.awaitTermination()
        assert q.exception() is None
        return sorted(r.key for r in spark.read.schema("key string, size long").parquet(f"{base}/out").collect())

    put("z.png.zst", "_m/.n/o.png.zst", "a/b/c/d/e.png.zst", "skip.txt")
    assert run() == ["_m/.n/o.png.zst", "a/b/c/d/e.png.zst", "z.png.zst"]
    put("a/a.png.zst", ".b.png.zst")  # keys that sort before those already seen
    assert run() == [".b.png.zst", "_m/.n/o.png.zst", "a/a.png.zst", "a/b/c/d/e.png.zst", "z.png.zst"]
    assert len(run()) == 5
    schema = object_stream(spark, f"{base}/in").schema
    assert isinstance(schema["last_modified"].dataType, T.TimestampType)
