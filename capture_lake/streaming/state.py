"""J1 and D2 on a stream by keyed state (T3): one flag per hash, nothing read from the target.

The first passing row of a hash is written, by the order of the objects within a micro-batch and by
arrival between micro-batches, and its flag drops every later copy.  A flag lives for ``ttl`` after
the write (a copy that comes later than that is the target's or the index's to know).  Rows without
a hash take no state and pass.

Checked rows are grouped by a digest of their hash (``GROUPS``), so what a call of the processor and a
frame cost is paid for many hashes at once, and a flag costs its look-up and its write alone.  A call
holds one row for each hash of its group in the micro-batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQueryListener

from capture_lake.operators import quality
from capture_lake.operators.dedup import HASH, has_hash
from capture_lake.plans import capture as C
from capture_lake.schema import RECORD_SCHEMA, to_records

# Fixed value: the state store that keyed state needs.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


#: Groups the hashes are dealt to: a call of the processor has the rows of a group, and a flag for each of
#: its hashes.  Fixed for a checkpoint's life.
GROUPS = 2_048
GROUP = "__group"


class FirstPassing(StatefulProcessor):
    """Map state per group of hashes: which of them have been written."""

    def __init__(self, ttl_ms: int, order: tuple[str, ...], columns: list[str]):
        self.ttl_ms, self.order, self.columns = ttl_ms, list(order), columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.written = handle.getMapState("written", "file_hash string", "written boolean", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        best = None
        for frame in rows:
            both = frame if best is None else pd.concat([best, frame])
            best = both.sort_values(self.order).drop_duplicates(HASH)  # one row a hash, however many copies come
        fresh = [not self.written.containsKey((h,)) for h in best[HASH]]
        best = best[fresh]
        for h in best[HASH]:
            self.written.updateValue((h,), (True,))
        if len(best):
            yield best[self.columns]

    def close(self) -> None:
        pass


def first_passing(checked: DataFrame, ttl: str = "7 days", order: tuple[str, ...] = ("last_modified", "key")) -> DataFrame:
    """The records to write of a stream of checked rows (``status`` and the record columns)."""
    names = RECORD_SCHEMA.fieldNames()
    ttl_ms = int(pd.Timedelta(ttl).total_seconds() * 1000)
    passed = checked.where(F.col("status") == quality.STATUS_OK)
    # only what is written or ordered by goes to Python
    dealt = passed.where(has_hash()).select(F.pmod(F.xxhash64(HASH), F.lit(GROUPS)).alias(GROUP), *dict.fromkeys([*names, *order]))
    hashed = dealt.groupBy(GROUP).transformWithStateInPandas(
        FirstPassing(ttl_ms, order, names), RECORD_SCHEMA, "Append", "ProcessingTime")
    return to_records(hashed).unionByName(to_records(passed.where(~has_hash())))


def start_state_stream(spark: SparkSession, source: DataFrame, path: str, checkpoint: str, process: Callable[[DataFrame], DataFrame] = C.assemble,
                       ttl: str = "7 days", available_now: bool = False, interval: str = "60 seconds"):
    """Append the stream's records to Parquet files under ``path`` (the file sink publishes each batch whole).

    Counters (A6) are observed as ``capture_written`` on the way; ``CaptureCounters`` adds them up."""
    from capture_lake.functions import metadata as M

    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    hashed = source.withColumn(HASH, M.meta_string("metadata", M.KEY_CONTENT_HASH, ""))
    out = first_passing(process(hashed), ttl).observe(
        "capture_written", F.count(F.lit(1)).alias("rows_written"), F.count_if(has_hash()).alias("rows_with_hash"))
    writer = out.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    # one batch of what is there: with a lifetime in processing time, availableNow would go on with empty batches
    writer = writer.trigger(once=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()


class CaptureCounters(StreamingQueryListener):
    """A6 on streams: the observed counters of every micro-batch, added up without an action of their own."""

    def __init__(self, metric: str = "capture_written"):
        self.metric, self.totals, self.batches = metric, {}, 0
        self.seen: set[tuple[str, int]] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self.metric)
        at = (str(event.progress.id), event.progress.batchId)
        if row is None or at in self.seen:  # progress without new data repeats the batch
            return
        self.seen = {x for x in self.seen if x[0] != at[0]} | {at}
        self.batches += 1
        for name, value in row.asDict().items():
            self.totals[name] = self.totals.get(name, 0) + (value or 0)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
