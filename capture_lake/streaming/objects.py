"""T1 over objects: a streaming data source of listing rows, with times as offsets.

An offset is a moment; a micro-batch holds the objects modified after its start and not after its
end, whatever their names (those that begin with ``_`` or ``.`` too) and whatever order they came
in.  The end lies ``settle`` seconds in the past, so an object of that moment is listed by then.
Planning lists only a few folder levels, to deal the folders to tasks; the tasks list them.
A replayed micro-batch asks for the same moments again.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from capture_lake.sources.listing import CAPTURE_SUFFIX
from capture_lake.sources.objects import Store, qualified

LISTING = "key string, size bigint, last_modified timestamp, etag string, path string"
#: Folder levels that planning looks into.
DEAL_LEVELS = 2


class Folder(InputPartition):
    """A folder to list: with all below it, or (``deep`` False) its own objects only."""

    def __init__(self, path: str, deep: bool, after: int, until: int):
        self.path, self.deep, self.after, self.until = path, deep, after, until


class ObjectStreamReader(DataSourceStreamReader):
    def __init__(self, options):
        self.root = qualified(options["path"])
        self.prefix, self.suffix = options.get("prefix", ""), options.get("suffix", CAPTURE_SUFFIX)
        self.settle = float(options.get("settle", "2"))

    def initialOffset(self) -> dict:
        return {"modified": -1}

    def latestOffset(self, *_) -> dict:
        return {"modified": int((time.time() - self.settle) * 1_000_000)}

    def _may_hold(self, key: str) -> bool:
        return key.startswith(self.prefix) or self.prefix.startswith(key + "/")

    def partitions(self, start: dict, end: dict) -> list[Folder]:
        store, after, until = Store(self.root), start["modified"], end["modified"]
        out, level = [], [self.root]
        for _ in range(DEAL_LEVELS):
            below = []
            for folder in level:
                out.append(Folder(folder, False, after, until))
                below += [e[0] for e in store.entries(folder) if e[1] and self._may_hold(e[0][len(self.root) + 1:])]
            level = below
        return out + [Folder(f, True, after, until) for f in level]

    def read(self, part: Folder) -> Iterator[tuple]:
        store, folders = Store(self.root), [part.path]
        while folders:
            for path, is_dir, size, modified in store.entries(folders.pop()):
                key = path[len(self.root) + 1:]
                if is_dir:
                    if part.deep and self._may_hold(key):
                        folders.append(path)
                elif part.after < modified <= part.until and key.startswith(self.prefix) and key.endswith(self.suffix):
                    yield key, size, dt.datetime.fromtimestamp(modified / 1_000_000, dt.timezone.utc), "", path

    def commit(self, end: dict) -> None:
        pass


class ObjectStream(DataSource):
    @classmethod
    def name(cls) -> str:
        return "capture_objects"

    def schema(self) -> str:
        return LISTING

    def streamReader(self, schema) -> ObjectStreamReader:
        return ObjectStreamReader(self.options)


def object_stream(spark: SparkSession, root: str, prefix: str = "", suffix: str = CAPTURE_SUFFIX, settle: float = 2.0) -> DataFrame:
    """Listing rows of new objects under ``root``; a micro-batch has as many as came in its time."""
    spark.dataSource.register(ObjectStream)
    reader = spark.readStream.format("capture_objects").option("prefix", prefix).option("suffix", suffix).option("settle", str(settle))
    return reader.load(qualified(root))
