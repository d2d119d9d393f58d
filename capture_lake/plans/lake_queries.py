"""Registered queries of the lake's running parts: publish, index, compaction, metrics, keyed state, retry.

Shapes and oracles are as in :mod:`capture_lake.plans.queries`.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from capture_lake.functions import metadata as M
from capture_lake.operators import dedup, hash_index, metrics, quality
from capture_lake.plans import capture as C
from capture_lake.plans.queries import _RECORDS_SQL, CAPTURES_CTE, FLAGSHIP_SQL, _hist_sql, capture_records_all, query
from capture_lake.session import scratch_path, stored
from capture_lake.sinks.commits import BATCH_COLUMN, Commits, commit_folder
from capture_lake.sinks.compact import compact
from capture_lake.sinks.table import append_records, table_location
from capture_lake.sources import listing as L
from capture_lake.sources import testdata as TD
from capture_lake.sources.tables import read_target
from capture_lake.streaming import ingest
from capture_lake.streaming.state import start_state_stream


def fresh_table() -> str:
    return f"capture_lake_q.records_{uuid.uuid4().hex[:10]}"


@query("publish_replay", f"""with {CAPTURES_CTE},
s as (select *, row_number() over (partition by file_hash order by last_modified, key) rn
      from captures where key like '%.png.zst'),
b as (select *, case when file_hash = '' or rn = 1 then 'first' else 'copy' end as place from s)
select 'records' as what, key, file_hash from b where place = 'first' and size > 0 and size % 997 > 0
union all select 'results', key, file_hash from b""")
def publish_replay(spark, sf_dir):
    """W1 + T3: micro-batches that are replayed, one after it was committed and one after it died before
    its commit, and what readers see: every record and every log row once.  Copies of a hash are in
    one micro-batch here (it is dealt by hash), sizes make no image fail before its copies."""
    caps = TD.captures(spark, sf_dir, with_text=False).where(F.col("key").endswith(L.CAPTURE_SUFFIX))
    rows = stored(caps.select("key", "last_modified", "metadata", F.pmod(F.xxhash64("file_hash"), F.lit(2)).alias("part")))
    ident, wh = fresh_table(), scratch_path(spark, "publish")
    run = lambda i: ingest.capture_batch(rows.where(F.col("part") == i).drop("part"), ident, wh, batch_id=i, copies_at_once=True)
    run(0)
    run(0)  # replay after the commit: skipped
    plain = Commits.commit
    try:
        Commits.commit = lambda *a, **k: (_ for _ in ()).throw(InterruptedError("the job is ended here"))
        run(1)
    except InterruptedError:
        pass
    finally:
        Commits.commit = plain
    run(1)  # replay of the one that died: what it had staged does not count
    records = read_target(spark, ident).select(F.lit("records").alias("what"), F.col("original_path").alias("key"), "file_hash")
    log = ingest.read_sidecar(spark, ingest.table_sidecar(wh, ident, "results"), ident, wh)
    return records.unionByName(log.select(F.lit("results").alias("what"), "key", "file_hash"))


@query("hash_index_dedup", f"""with {CAPTURES_CTE}
select doc_id, key, file_hash, file_hash <> '' and exists
  (select 1 from captures t where t.doc_id % 3 = 0 and t.file_hash = a.file_hash) as captured
from captures a where doc_id % 3 <> 0""")
def hash_index_dedup(spark, sf_dir):
    """J1 + J2 against the bucketed hash index: appended by two committed batches, and by one that was
    never committed (all hashes there are, none counts)."""
    caps = TD.captures(spark, sf_dir, with_text=False).select("doc_id", "key", "file_hash")
    ident, place = fresh_table(), scratch_path(spark, "index")
    commits = Commits(spark, f"{place}_commits")
    target = caps.where(TD.is_target())
    for i in range(2):
        hash_index.append_hashes(target.where(F.col("doc_id") % 2 == i), ident, place, f"b{i}")
        commits.commit(f"b{i}", [f"b{i}"])
    hash_index.append_hashes(caps, ident, place, "died")
    return hash_index.mark_captured(TD.batch(caps), ident, commits)


@query("hash_exists_lookup", f"""with {CAPTURES_CTE},
p as (select min(file_hash) filter (where doc_id % 3 = 0 and file_hash <> '') as a, max(file_hash) filter (where doc_id % 3 = 0) as b from captures)
select 'least' as probe, a as file_hash, true as found from p union all select 'most', b, true from p
union all select 'empty', '', false union all select 'unknown', 'no such hash', false""")
def hash_exists_lookup(spark, sf_dir):
    """Point lookups of captured, empty and unknown hashes, in the table and in the index alike."""
    caps = TD.captures(spark, sf_dir, with_text=False)
    target = stored(TD.target_records(caps))
    ident, place = fresh_table(), scratch_path(spark, "lookup")
    commits = Commits(spark, f"{place}_commits")
    hash_index.append_hashes(target, ident, place, "b0")
    commits.commit("b0", ["b0"])
    some = target.where(dedup.has_hash()).agg(F.min("file_hash").alias("a"), F.max("file_hash").alias("b")).first()
    out = []
    for probe, value in (("least", some["a"]), ("most", some["b"]), ("empty", ""), ("unknown", "no such hash")):
        found = hash_index.hash_exists(spark, ident, value, commits)
        plain = value != "" and dedup.hash_exists(target, value)
        out.append((probe, value, found if found == plain else None))
    return spark.createDataFrame(out, "probe string, file_hash string, found boolean")


@query("compact_table", f"""with x as ({_RECORDS_SQL})
select cast(processed_at as date) as processed_at_day, count(*) as n_rows, sum(image_width)::bigint as width,
       count(distinct original_path) as n_paths, true as fewer_files from x group by 1""")
def compact_table(spark, sf_dir):
    """W1 + W3: a table of many small batches is packed; readers see the same rows of every day in fewer files."""
    caps = stored(capture_records_all(TD.captures(spark, sf_dir, with_text=False)))
    ident, wh = fresh_table(), scratch_path(spark, "compact")
    for i in range(4):
        append_records(caps.where(F.col("doc_id") % 4 == i), ident, wh)
    packed = compact(spark, ident)
    rows = read_target(spark, ident)
    return rows.groupBy("processed_at_day").agg(
        F.count("*").alias("n_rows"), F.sum("image_width").alias("width"), F.count_distinct("original_path").alias("n_paths"),
        F.lit(packed["files_after"] < packed["files_before"]).alias("fewer_files"))


def lineitem_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as per-object results in three batches: a seventh are failures, an eleventh duplicates."""
    li = TD.table(spark, sf_dir, "lineitem")
    n = F.col("l_orderkey") + F.col("l_linenumber")
    status = F.when(n % 7 == 0, quality.STATUS_QUARANTINE).when(n % 11 == 0, quality.STATUS_DUPLICATE).otherwise(quality.STATUS_OK)
    rows = li.select((F.col("l_orderkey") % 3).alias("part"), status.alias("status"), (F.col("l_discount") * 10).alias("ocr_confidence_mean"),
                     F.floor(F.col("l_quantity") * 2500).cast("bigint").alias("processing_duration_ms"))
    return rows.withColumn("n_rows", F.when(F.col("status") == quality.STATUS_OK, 1).otherwise(0).cast("bigint"))


_LI_RESULTS_SQL = """(select l_discount * 10 as conf, floor(l_quantity * 2500) / 1000.0 as dur, (l_orderkey + l_linenumber) % 7 = 0 as bad,
  (l_orderkey + l_linenumber) % 7 <> 0 and (l_orderkey + l_linenumber) % 11 = 0 as dup from lineitem)"""


@query("cumulative_metrics", f"""with c as ({_hist_sql('conf', f'{_LI_RESULTS_SQL} where not bad and not dup', metrics.CONFIDENCE_BOUNDS)}),
d as ({_hist_sql('dur', f'{_LI_RESULTS_SQL} where not bad and not dup', metrics.DURATION_BOUNDS)}),
t as (select count(*) as total, count(*) filter (where not bad) as succeeded, count(*) filter (where not bad and not dup) as n from {_LI_RESULTS_SQL})
select 'confidence' as metric, series, le, value from c union all select 'duration', series, le, value from d
union all select 'total', 'count', null, total::double from t union all select 'succeeded', 'count', null, succeeded::double from t
union all select 'files_extracted', 'count', null, n::double from t union all select 'rows_written', 'count', null, n::double from t
union all select 'median off by at most 2 %', 'check', null, 1.0::double""")
def cumulative_metrics(spark, sf_dir):
    """A5-A8 over the life of the service: three batches' states, written as they come and added up, equal
    the counters and histograms of their union; a quantile of the merged sketches is within 2 % of its rank."""
    rows = stored(lineitem_results(spark, sf_dir))
    place = scratch_path(spark, "metrics")
    for i in range(3):
        metrics.metric_state(rows.where(F.col("part") == i)).write.mode("append").parquet(place)
    state = stored(metrics.cumulative(spark.read.parquet(place)))
    hist = lambda name, metric: metrics.state_histogram(state, name).select(F.lit(metric).alias("metric"), "series", "le", F.round("value", 6).alias("value"))
    out = hist("conf", "confidence").unionByName(hist("dur", "duration"))
    totals = ["total", "succeeded", "files_extracted", "rows_written"]
    counts = state.selectExpr(f"stack({len(totals)}, {', '.join(f'{chr(39)}{t}{chr(39)}, cast({t} as double)' for t in totals)}) as (metric, value)")
    out = out.unionByName(counts.select("metric", F.lit("count").alias("series"), F.lit(None).cast("string").alias("le"), "value"))
    median = state.select(metrics.state_quantile("dur", 0.5).alias("m"))
    ranked = rows.where(F.col("status") == quality.STATUS_OK).select((F.col("processing_duration_ms") / 1000).alias("v")).crossJoin(F.broadcast(median))  # one row
    near = ranked.agg((F.count_if(F.col("v") < F.col("m")) <= 0.52 * F.count("*")).alias("lo"), (F.count_if(F.col("v") <= F.col("m")) >= 0.48 * F.count("*")).alias("hi"))
    check = near.select(F.lit("median off by at most 2 %").alias("metric"), F.lit("check").alias("series"), F.lit(None).cast("string").alias("le"),
                        (F.col("lo") & F.col("hi")).cast("double").alias("value"))
    return out.unionByName(check)


_STREAM_SQL = f"""with {CAPTURES_CTE}
select original_path, file_hash from (
  select key as original_path, file_hash, size,
         row_number() over (partition by file_hash order by last_modified, key) rn
  from captures where key like '%.png.zst' and size > 0 and size % 997 > 0) x
where file_hash = '' or rn = 1"""


def drops_of(spark: SparkSession, sf_dir: str, columns: list[str], n: int = 3) -> tuple[DataFrame, T.StructType]:
    """The captures in ``n`` time-ordered drops (column ``drop_no``), and the schema of a dropped file."""
    caps = TD.captures(spark, sf_dir, with_text=False).select(*columns).withColumn("last_modified", F.col("last_modified").cast("timestamp"))
    lo, hi = caps.agg(F.min("last_modified"), F.max("last_modified")).first()
    span = (hi - lo).total_seconds() + 1
    drop_no = F.least(F.floor((F.unix_timestamp("last_modified") - F.lit(lo.timestamp())) * n / span), F.lit(n - 1)).cast("int")
    staged = stored(caps.withColumn("drop_no", drop_no))
    return staged, T.StructType([staged.schema[c] for c in columns])


@query("stream_keyed_state", _STREAM_SQL)
def stream_keyed_state(spark, sf_dir):
    """T3 + J1 + D2 by keyed state: three drops, each a run of its own from the checkpoint; the stream keeps
    a flag per hash and never reads what it wrote."""
    staged, schema = drops_of(spark, sf_dir, ingest.STREAM_COLUMNS)
    base = scratch_path(spark, "keyed")
    provider = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    try:
        for i in range(3):
            staged.where(F.col("drop_no") == i).select(*ingest.STREAM_COLUMNS).write.parquet(f"{base}/in/drop={i}")
            stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{base}/in")
            q = start_state_stream(spark, stream.where(F.col("key").endswith(L.CAPTURE_SUFFIX)), f"{base}/out", f"{base}/checkpoint", available_now=True)
            q.awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", provider)
    return spark.read.parquet(f"{base}/out").select("original_path", "file_hash")


@query("stream_hash_index", _STREAM_SQL)
def stream_hash_index(spark, sf_dir):
    """T1-T3 with J1 by the hash index: the three drops of ``stream_capture``, the target is not scanned."""
    staged, schema = drops_of(spark, sf_dir, ingest.STREAM_COLUMNS)
    base, ident = scratch_path(spark, "indexed"), fresh_table()
    for i in range(3):
        staged.where(F.col("drop_no") == i).select(*ingest.STREAM_COLUMNS).write.parquet(f"{base}/in/drop={i}")
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{base}/in")
        q = ingest.start_capture_stream(spark, stream.where(F.col("key").endswith(L.CAPTURE_SUFFIX)), ident, f"{base}/wh", f"{base}/checkpoint",
                                        available_now=True, copies_at_once=True, hash_index=True)
        q.awaitTermination()
    return read_target(spark, ident).select("original_path", "file_hash")


@query("stream_seen_keys", "select event_type, user_id, min(event_id) as first_event from events group by 1, 2")
def stream_seen_keys(spark, sf_dir):
    """D1 on a stream: (event_type, user_id) pairs seen once over two drops of events, the watermark wide enough for all.
    The stream tells which pairs are new; the first event of each is looked up for the comparison."""
    ev = TD.table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    base = scratch_path(spark, "seen")
    lo, hi = ev.agg(F.min("ts"), F.max("ts")).first()
    middle = lo + (hi - lo) / 2
    for i, part in enumerate((ev.where(F.col("ts") <= F.lit(middle)), ev.where(F.col("ts") > F.lit(middle)))):
        part.write.parquet(f"{base}/in/drop={i}")
        stream = spark.readStream.schema(ev.schema).option("recursiveFileLookup", "true").parquet(f"{base}/in")
        unique = ingest.dedup_keys_stream(stream, ["event_type", "user_id"], "ts", f"{(hi - lo).days + 2} days")
        q = unique.select("event_type", "user_id").writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/ck").trigger(availableNow=True).start()
        q.awaitTermination()
    once = spark.read.schema("event_type string, user_id bigint").parquet(f"{base}/out")  # a repeated pair would give repeated rows
    first = ev.groupBy("event_type", "user_id").agg(F.min("event_id").alias("first_event"))
    return once.join(first, ["event_type", "user_id"])


@query("retry_run", f"""with {CAPTURES_CTE},
s as (select * from captures where key like '%.png.zst' and doc_id % 3 <> 0)
select key, file_hash, case when size % 997 > 0 and size > 0 then 'first run' else 'retry' end as written_by
from (select *, row_number() over (partition by case when file_hash = '' then key else file_hash end
      order by case when size > 0 and size % 997 > 0 then 0 else 1 end, last_modified, key) rn from s) x where rn = 1""")
def retry_run(spark, sf_dir):
    """T4: a run leaves failures in its log; the queue's objects run again with their metadata mended, and the
    table holds every hash once, by the first run where it had a passing copy, else by the retry."""
    caps = TD.batch(TD.captures(spark, sf_dir, with_text=False)).where(F.col("key").endswith(L.CAPTURE_SUFFIX))
    rows = stored(caps.select("key", "last_modified", "metadata"))
    ident, wh = fresh_table(), scratch_path(spark, "retry")
    ingest.capture_batch(rows, ident, wh, batch_id=0, copies_at_once=True)
    log = ingest.read_sidecar(spark, ingest.table_sidecar(wh, ident, "results"), ident, wh)
    queue = ingest.retry_queue(log).select("key")
    whole = F.map_concat(F.map_filter("metadata", lambda k, _: ~k.isin(M.KEY_IMAGE_WIDTH, M.KEY_IMAGE_HEIGHT)),
                         F.create_map(F.lit(M.KEY_IMAGE_WIDTH), F.lit("7"), F.lit(M.KEY_IMAGE_HEIGHT), F.lit("9999")))
    again = rows.join(queue, "key", "left_semi").withColumn("metadata", whole)
    ingest.capture_batch(again, ident, wh, batch_id=1, copies_at_once=True)
    assert ingest.retry_queue(ingest.read_sidecar(spark, ingest.table_sidecar(wh, ident, "results"), ident, wh)).isEmpty()
    by = F.when(F.col("image_height") == 9999, "retry").otherwise("first run")  # the stand-in heights are under 997
    return read_target(spark, ident).select(F.col("original_path").alias("key"), "file_hash", by.alias("written_by"))


@query("processing_times", f"""with {CAPTURES_CTE}
select key, true as processed_in_run, true as took_time from captures where key like '%.png.zst'""")
def processing_times(spark, sf_dir):
    """Every object's processing moment lies in the run (one for the batch), its time is that of its own extraction."""
    import datetime as dt

    caps = TD.captures(spark, sf_dir, with_text=False).where(F.col("key").endswith(L.CAPTURE_SUFFIX))
    before = dt.datetime.now(dt.timezone.utc) - dt.timedelta(seconds=1)

    def factory():
        import time

        def fn(key):
            time.sleep(0.001)
            return {"n": len(key)}
        return fn

    from capture_lake.operators.extractor import run_extractor

    out_t = T.StructType([T.StructField("n", T.IntegerType())])
    timed = run_extractor(caps.select("key", "metadata"), factory, ["key"], out_t, elapsed_col="ms", passthrough=["key", "metadata"])
    done = stored(C.assemble(timed.withColumn(dedup.HASH, F.lit("")), duration_ms=F.round("ms"), enforce_rules=False))
    after = dt.datetime.now(dt.timezone.utc) + dt.timedelta(seconds=1)
    moments = done.agg(F.count_distinct("processed_at")).first()[0]
    in_run = (F.col("processed_at") >= F.lit(before)) & (F.col("processed_at") <= F.lit(after)) & F.lit(moments == 1)
    return done.select("key", in_run.alias("processed_in_run"), ((F.col("processing_duration_ms") >= 1) & (F.col("processing_duration_ms") < 60_000)).alias("took_time"))


@query("object_stream", f"""with {CAPTURES_CTE}
select '.hidden/' || key as key, length(key)::bigint as size from captures""")
def object_stream(spark, sf_dir):
    """T1 over objects: every capture as an object file under a hidden folder, in two waves with a restart
    between them; the object stream lists each once."""
    import time

    from capture_lake.streaming.objects import object_stream as stream_of

    caps = TD.captures(spark, sf_dir, with_text=False).select("doc_id", "key")
    base = scratch_path(spark, "object-stream")
    for i in range(2):
        wave = caps.where(F.col("doc_id") % 2 == i).select(F.concat(F.lit(".hidden/"), "key").alias("key"), F.col("key").cast("binary").alias("content"),
                                                            F.lit(None).cast("timestamp").alias("last_modified"))
        TD.write_objects(wave, f"{base}/in")
        time.sleep(1.2)
        q = stream_of(spark, f"{base}/in", suffix="", settle=0.5).select("key", "size").writeStream.format("parquet").option("path", f"{base}/out").option(
            "checkpointLocation", f"{base}/ck").trigger(availableNow=True).start()
        q.awaitTermination()
    return spark.read.schema("key string, size bigint").parquet(f"{base}/out")
