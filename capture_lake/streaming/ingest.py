"""Continuous and interval ingest as Structured Streaming.

* T1 continuous: a file-source stream over the image folder with a
  ``processingTime`` trigger (60 s by default); the checkpoint replaces
  re-listing, so each object is read once.
* T2 interval runs: the same query with ``availableNow=True`` (hourly jobs);
  hours missed while the job was down are picked up from the checkpoint.
* T3 cross-batch hash dedup: ``foreachBatch`` runs the batch job's core
  (``capture_rows``) against the target, read through the batch's own session
  after a table refresh (a stale file listing could admit duplicates).
  ``foreachBatch`` is at-least-once; a batch is published in two phases
  (``sinks.commits``), so a replay writes nothing twice wherever the first run died.
* T4 retry: every run appends its per-object results to a log; the objects
  whose latest result is a failure are the queue of a retry run.
"""

from __future__ import annotations

import hashlib
import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from capture_lake.operators import quality
from capture_lake.operators.hash_index import append_hashes, mark_captured
from capture_lake.operators.metrics import metric_state
from capture_lake.plans import capture as C
from capture_lake.session import scratch_path, stored
from capture_lake.sinks.commits import BATCH_COLUMN, new_attempt
from capture_lake.sinks.table import append_records, commits_of
from capture_lake.sources import listing as L
from capture_lake.sources.tables import read_target

Process = Callable[[DataFrame], DataFrame]
log = logging.getLogger(__name__)

# What the results log keeps of every listed object.
LOG_COLUMNS = ["key", "file_hash", "label", "status", "n_rows", "error"]


def table_sidecar(warehouse: str, identifier: str, what: str) -> str:
    """A folder next to the table's own: its quarantine, results log or stream checkpoint."""
    return f"{warehouse.rstrip('/')}/{identifier.split('.', 1)[-1]}_{what}"


def write_results(res: C.CaptureResult, identifier: str, warehouse: str, fmt: str = "parquet",
                  quarantine_path: str | None = None, results_path: str | None = None, name: str | None = None,
                  hash_index: bool = False) -> dict:
    """Stage the records, the failures, the results log and the metrics (all from the stored results),
    then publish them with one commit; ``name`` is the commit's, for a batch that may be replayed.
    ``hash_index``: the hashes go into the bucketed index too.

    Returns (A5, A6) the batch's totals and the write counters, and (A7, A8)
    the two histograms as lists of (series, le, value)."""
    spark = res.results.sparkSession
    attempt = new_attempt(name)
    counters = append_records(res.records, identifier, warehouse, fmt, batch=attempt)
    in_batch = F.lit(attempt).alias(BATCH_COLUMN)
    quarantine_path = quarantine_path or table_sidecar(warehouse, identifier, "quarantine")
    res.quarantine.select("*", in_batch).write.mode("append").parquet(quarantine_path)
    logged = res.results.select(*LOG_COLUMNS, F.current_timestamp().alias("logged_at"), in_batch)
    logged.write.mode("append").parquet(results_path or table_sidecar(warehouse, identifier, "results"))
    state = metric_state(res.results).select("*", in_batch)
    state.write.mode("append").parquet(table_sidecar(warehouse, identifier, "metrics"))
    if hash_index:
        append_hashes(res.records, identifier, table_sidecar(warehouse, identifier, "hashes"), attempt)
    commits_of(spark, identifier, warehouse).commit(name or attempt, [attempt])
    return {
        **res.outcome().first().asDict(), **counters,
        "confidence_histogram": [list(r) for r in res.confidence_histogram().collect()],
        "duration_histogram": [list(r) for r in res.duration_histogram().collect()],
    }


def read_sidecar(spark: SparkSession, path: str, identifier: str, warehouse: str) -> DataFrame:
    """The committed rows of a table's quarantine or results log."""
    return commits_of(spark, identifier, warehouse).published(spark.read.parquet(path))


def capture_batch(batch_df: DataFrame, identifier: str, warehouse: str, process: Process = C.assemble,
                  quarantine_path: str | None = None, batch_id: int | None = None, stream: str = "stream",
                  manifest: DataFrame | None = None, fmt: str = "parquet", results_path: str | None = None,
                  copies_at_once: bool = False, bounded: bool = False, hash_index: bool = False) -> dict:
    """One micro-batch: J1 against the refreshed target, D2 and checks, publish.

    ``manifest``: joined here, pruned to the batch's keys (else the rows bring
    their ``metadata``).  ``bounded``: the source caps a micro-batch
    (``maxFilesPerTrigger``), so its keys and hashes may be broadcast.  ``hash_index``:
    J1 looks hashes up in the bucketed index (kept from the table's first batch on)
    instead of the target.

    ``foreachBatch`` is at-least-once.  The commit is named after ``stream`` and
    ``batch_id``: a replay of a committed batch is skipped whole, and one of a batch
    that died before its commit starts anew, what it had staged does not count.
    Returns (and logs) what ``write_results`` does.
    """
    spark = batch_df.sparkSession
    name = None if batch_id is None else f"{stream}-{int(batch_id)}"
    if name is not None and commits_of(spark, identifier, warehouse).has(name):
        log.info("capture batch %s into %s: already committed, skipped", batch_id, identifier)
        return {"rows_written": 0, "rows_with_hash": 0, "skipped": True}
    if manifest is not None:
        # stored first: the manifest's filter and the join read the listing once
        batch_df = L.attach_metadata(stored(batch_df), manifest, bounded=bounded)
    mark = None
    if hash_index:
        commits = commits_of(spark, identifier, warehouse)
        mark = lambda rows: mark_captured(rows, identifier, commits)
    target = None if hash_index else read_target(spark, identifier)
    res = C.capture_rows(batch_df, target, process, bounded=bounded, copies_at_once=copies_at_once, mark=mark)
    counters = write_results(res, identifier, warehouse, fmt, quarantine_path, results_path, name, hash_index)
    log.info("capture batch %s into %s: %s", batch_id, identifier, counters)
    return counters


def start_capture_stream(spark: SparkSession, source: DataFrame, identifier: str, warehouse: str,
                         checkpoint: str, process: Process = C.assemble,
                         available_now: bool = False, interval: str = "60 seconds",
                         quarantine_path: str | None = None, manifest: DataFrame | None = None,
                         fmt: str = "parquet", results_path: str | None = None, copies_at_once: bool = False,
                         bounded: bool = False, hash_index: bool = False, report: Callable[[dict], None] | None = None):
    """Start the stream: ``source`` is a streaming frame of listing rows, with a
    ``metadata`` map unless ``manifest`` is given (see ``listing_stream``).  Commits are
    named after the checkpoint; ``report`` gets each batch's totals."""
    stream = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:12]

    def each_batch(df: DataFrame, batch_id: int) -> None:
        totals = capture_batch(df, identifier, warehouse, process, quarantine_path, batch_id, stream,
                               manifest=manifest, fmt=fmt, results_path=results_path,
                               copies_at_once=copies_at_once, bounded=bounded, hash_index=hash_index)
        if report is not None:
            report(totals)

    writer = source.writeStream.option("checkpointLocation", checkpoint).foreachBatch(each_batch)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()


def listing_stream(spark: SparkSession, root: str, prefix: str = "", max_files_per_trigger: int = 10_000) -> DataFrame:
    """T1 source: listing rows of new ``.png.zst`` objects under ``root`` (no byte is read).

    The binaryFile stream needs its schema; content is not projected.
    ``maxFilesPerTrigger`` caps each micro-batch (oldest files first), which is
    what lets its keys and hashes be broadcast.  The source reads an object
    once; failures come again through the retry run.
    """
    files = (spark.readStream.format("binaryFile").schema(L.BINARY_FILE_SCHEMA)
             .option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{L.CAPTURE_SUFFIX}")
             .option("maxFilesPerTrigger", max_files_per_trigger).load(root))
    return L.listing_of(files, root, prefix)


def dedup_keys_stream(stream: DataFrame, keys: list[str], event_time: str, delay: str = "1 hour") -> DataFrame:
    """D1 on a stream: drop repeats of ``keys`` seen within the watermark.

    State is kept only for ``delay`` past the latest event time, so it stays
    bounded on an endless stream; event times without a zone are read as UTC.
    """
    ts = F.col(event_time)
    timed = stream.withColumn(event_time, ts.cast("timestamp"))
    return timed.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


def retry_queue(results_log: DataFrame) -> DataFrame:
    """T4: ``(key, error)`` of the objects to run again: those whose latest logged result is a failure.

    Keyed by object, so an object without a hash leaves the queue as well once
    it is captured.  The aggregate combines map-side.
    """
    latest = results_log.groupBy("key").agg(F.max_by(F.struct("status", "error"), F.struct("logged_at", F.col("status") == quality.STATUS_QUARANTINE)).alias("last"))
    return latest.where(F.col("last.status") == quality.STATUS_QUARANTINE).select("key", F.col("last.error").alias("error"))


# ---------------------------------------------------------------------------
# Demo over the stand-in captures: three file drops, three availableNow runs
# ---------------------------------------------------------------------------

STREAM_COLUMNS = ["doc_id", "key", "size", "last_modified", "etag", "metadata"]


def demo_stream_capture(spark: SparkSession, sf_dir: str, drops: int = 3) -> DataFrame:
    from capture_lake.sources import testdata as TD

    caps = TD.captures(spark, sf_dir, with_text=False).select(*STREAM_COLUMNS)
    caps = caps.withColumn("last_modified", F.col("last_modified").cast("timestamp"))
    # Split the objects into time-ordered drops (two scalars reach the driver).
    lo, hi = caps.agg(F.min("last_modified"), F.max("last_modified")).first()
    span = (hi - lo).total_seconds() + 1
    drop_no = F.least(F.floor((F.unix_timestamp("last_modified") - F.lit(lo.timestamp())) * drops / span),
                      F.lit(drops - 1)).cast("int")
    staged = caps.withColumn("drop_no", drop_no)

    base = scratch_path(spark, "stream")
    src_dir, ckpt, wh = f"{base}/incoming", f"{base}/checkpoint", f"{base}/warehouse"
    ident = f"capture_lake_stream.records_{base.rsplit('-', 1)[-1]}"
    schema = T.StructType([staged.schema[c] for c in STREAM_COLUMNS])

    for i in range(drops):
        staged.where(F.col("drop_no") == i).select(*STREAM_COLUMNS).write.mode("overwrite").parquet(f"{src_dir}/drop={i}")
        stream = (spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(src_dir)
                  .where(F.col("key").endswith(L.CAPTURE_SUFFIX)))
        q = start_capture_stream(spark, stream, ident, wh, ckpt, available_now=True, copies_at_once=True)
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    return read_target(spark, ident).select("original_path", "file_hash")
