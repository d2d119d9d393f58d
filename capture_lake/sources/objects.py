"""Objects of a bucket: frontier listing (S1-S4) and payload reads (S7), in tasks.

Listing goes by folder level: a frame of folders is dealt to tasks, each lists its folders
without their subfolders, and the subfolders found are the next round's frame.  Nothing is
walked on the driver, every name counts (also one that begins with ``_`` or ``.``, which
Spark's file sources never list), and a folder is a stream of names in its task.

Payloads: listing rows are numbered into packs of about ``TASK_BYTES`` of objects, a pack is
a task, and the task opens each of its objects once, whatever their modification times.  Only
listing rows are exchanged, never a payload; Arrow batches are bounded by bytes.

Tasks reach objects through ``Store``: a mounted folder (``file:`` or a bare path), else the
file system that pyarrow has for the scheme (``s3a`` and ``s3n`` as ``s3``, ``gs``, ``abfs``,
``hdfs``), whose credentials come from the executors' environment.
"""

from __future__ import annotations

import datetime as dt
import os
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from capture_lake.session import stored
from capture_lake.sources.listing import filter_listing

#: Bytes of objects per task, what opening one counts for, and bytes of payload per Arrow batch.
TASK_BYTES = 128 * 1024 * 1024
OPEN_BYTES = 64 * 1024
BATCH_BYTES = 4 * 1024 * 1024
#: Most tasks of one round of a listing.
LIST_TASKS = 4_096

FOUND = "path string, is_dir boolean, size bigint, modified bigint"
_FOUND = pa.schema([("path", pa.string()), ("is_dir", pa.bool_()), ("size", pa.int64()), ("modified", pa.int64())])


class Store:
    """Names and bytes under folders of one file system."""

    def __init__(self, root: str):
        scheme = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):", root)
        self.scheme = scheme.group(1) if scheme else "file"
        self.local = self.scheme == "file"

    def bare(self, path: str) -> str:
        """A local path, or what the file system calls the object."""
        if self.local:
            return re.sub(r"^file:(?://[^/]*)?", "", path)
        return re.sub(r"^[^:]*://", "", path)

    def _fs(self, path: str):
        from pyarrow import fs

        uri = re.sub(r"^s3[an]:", "s3:", path)
        return fs.FileSystem.from_uri(uri)

    def entries(self, folder: str) -> Iterator[tuple[str, bool, int, int]]:
        """(path, is folder, size, modification time in microseconds) right under a folder; a missing one has none."""
        if self.local:
            try:
                with os.scandir(self.bare(folder)) as found:
                    for e in found:
                        try:
                            s = e.stat()
                        except FileNotFoundError:  # gone since
                            continue
                        yield f"{folder}/{e.name}", e.is_dir(), s.st_size, s.st_mtime_ns // 1000
            except FileNotFoundError:
                return
        else:
            from pyarrow import fs

            files, base = self._fs(folder)
            for e in files.get_file_info(fs.FileSelector(base, allow_not_found=True)):
                when = e.mtime_ns // 1000 if e.mtime_ns is not None else 0
                yield f"{folder}/{e.base_name}", e.type == fs.FileType.Directory, e.size or 0, when

    def read(self, path: str) -> bytes:
        if self.local:
            with open(self.bare(path), "rb") as f:
                return f.read()
        files, base = self._fs(path)
        with files.open_input_stream(base) as f:
            return f.read()


def qualified(root: str) -> str:
    """The root as it stands in ``path``: with its scheme, without a slash at the end."""
    root = root.rstrip("/")
    return root if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", root) else f"file:{os.path.abspath(root)}"


def start_folder(root: str, prefix: str) -> str:
    """The deepest folder that holds every key with the prefix."""
    folder = prefix.rpartition("/")[0]
    return f"{root}/{folder}" if folder else root


def list_objects(spark: SparkSession, root: str, prefix: str = "", suffix: str | None = None,
                 start: dt.datetime | str | None = None, end: dt.datetime | str | None = None) -> DataFrame:
    """``(key, size, last_modified, etag, path)`` of every object under ``root``, stored.

    One round per folder level; only folders that can hold the prefix are entered."""
    root = qualified(root)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = Store(root)
        for b in batches:
            for folder in b.column(0).to_pylist():
                rows: list[tuple] = []
                for e in store.entries(folder):
                    key = e[0][len(root) + 1:]
                    if not (key.startswith(prefix) or (e[1] and prefix.startswith(key + "/"))):
                        continue
                    rows.append(e)
                    if len(rows) == 10_000:
                        yield _rows(rows)
                        rows = []
                if rows:
                    yield _rows(rows)

    frontier = spark.createDataFrame([(start_folder(root, prefix),)], "path string")
    tasks, files = 1, None
    while True:
        found = stored(frontier.repartition(tasks, "path").mapInArrow(look, FOUND))
        here = found.where(~F.col("is_dir"))
        files = here if files is None else files.unionByName(here)
        frontier = found.where("is_dir").select("path")
        folders = frontier.count()
        if not folders:
            break
        tasks = min(folders, LIST_TASKS)
    listing = files.select(F.substring(F.col("path"), len(root) + 2, 1 << 30).alias("key"), "size",
                           F.timestamp_micros("modified").alias("last_modified"), F.lit("").alias("etag"), "path")
    bounds = [None if b is None else F.lit(b).cast("timestamp") for b in (start, end)]
    return filter_listing(listing, prefix, suffix, *bounds)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _FOUND)], schema=_FOUND)


def in_packs(rows: DataFrame, task_bytes: int = TASK_BYTES, size: str = "size") -> DataFrame:
    """Stored listing rows dealt so that each task has about ``task_bytes`` of objects.

    Rows are numbered through by their running size: a sum per partition reaches the driver, and the
    partitions' offsets go back to the tasks."""
    weight = F.coalesce(F.col(size), F.lit(0)) + OPEN_BYTES
    sums = rows.groupBy(F.spark_partition_id().alias("p")).agg(F.sum(weight).alias("w")).orderBy("p").collect()
    offsets, total = {}, 0
    for s in sums:
        offsets[s["p"]] = total
        total += s["w"]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        at = offsets.get(TaskContext.get().partitionId(), 0)
        for b in batches:
            packs = []
            for n in b.column(b.schema.get_field_index(size)).to_pylist():
                packs.append(at // task_bytes)
                at += (n or 0) + OPEN_BYTES
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(packs, pa.int32())], names=[*b.schema.names, "__pack"])

    packed = rows.mapInArrow(number, T.StructType([*rows.schema.fields, T.StructField("__pack", T.IntegerType())]))
    return packed.repartitionById(max(1, -(-total // task_bytes)), F.col("__pack")).drop("__pack")


def read_payloads(rows: DataFrame, root: str, task_bytes: int = TASK_BYTES, read: Callable[[str], bytes] | None = None) -> DataFrame:
    """Stored listing rows (``path`` under ``root``, ``size``) with their bytes as ``content``.

    Each object is opened once, by the task whose pack it is in.  A row whose object is gone has no
    result row.  ``read`` (path to bytes) takes the place of the store's own."""
    root = qualified(root)
    schema = T.StructType([*rows.schema.fields, T.StructField("content", T.BinaryType())])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = read or Store(root).read
        for b in batches:
            paths = b.column(b.schema.get_field_index("path")).to_pylist()
            take: list[int] = []
            contents: list[bytes] = []
            size = 0
            for i, path in enumerate(paths):
                try:
                    content = get(path)
                except FileNotFoundError:
                    continue
                take.append(i)
                contents.append(content)
                size += len(content)
                if size >= BATCH_BYTES:
                    yield _with_content(b, take, contents)
                    take, contents, size = [], [], 0
            if take:
                yield _with_content(b, take, contents)

    return in_packs(rows, task_bytes).mapInArrow(fetch, schema)


def _with_content(b: pa.RecordBatch, take: list[int], contents: list[bytes]) -> pa.RecordBatch:
    part = b.take(pa.array(take, pa.int64()))
    return pa.RecordBatch.from_arrays([*part.columns, pa.array(contents, pa.binary())], names=[*b.schema.names, "content"])
