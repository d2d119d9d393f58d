"""Two-phase publish (W1, T3): rows are staged under a batch name, one marker makes them count.

Everything a batch writes (records, failures, results log) carries its attempt's name in the
column ``capture_batch``.  When all of it is written, one small file goes into the commit
folder by a rename, which happens whole or not at all; readers keep the rows whose batch a
commit names.  A job that dies at any step before leaves rows that no reader counts, and its
repetition is a new attempt, so nothing is repeated, also not for objects without a hash.  A
commit may also drop batches (compaction): their rows and the new ones change places at once.

The commit of a name is there once at most, so a replayed micro-batch is told by a look for one file.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_COLUMN = "capture_batch"
COMMIT_SCHEMA = "name string, adds array<string>, drops array<string>"


def new_attempt(name: str | None = None) -> str:
    """A batch name no other attempt has; ``name`` is told first."""
    return f"{name or 'run'}-{uuid.uuid4().hex[:12]}"


class Commits:
    """The commit folder of one table and its sidecars."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def _fs(self):
        return self._path("x").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def has(self, name: str) -> bool:
        return self._fs().exists(self._path(f"{name}.json"))

    def commit(self, name: str, adds: Iterable[str], drops: Iterable[str] = ()) -> bool:
        """Publish; False if the name is committed already (then nothing changes)."""
        if self.has(name):
            return False
        fs, held = self._fs(), self._path(f"_{uuid.uuid4().hex}")  # readers skip names that begin with _
        fs.mkdirs(self._path(".").getParent())
        out = fs.create(held, False)
        out.write(bytearray(json.dumps({"name": name, "adds": list(adds), "drops": list(drops)}).encode()))
        out.close()
        if fs.rename(held, self._path(f"{name}.json")):
            return True
        fs.delete(held, False)
        return False

    def frame(self) -> DataFrame:
        """``(name, adds, drops)`` of every commit."""
        if not self._fs().exists(self._path(".").getParent()):
            return self.spark.createDataFrame([], COMMIT_SCHEMA)
        return self.spark.read.schema(COMMIT_SCHEMA).json(self.folder)

    def live_batches(self) -> DataFrame:
        """``(capture_batch)``: added by a commit and dropped by none."""
        commits = self.frame()
        adds = commits.select(F.explode("adds").alias(BATCH_COLUMN)).distinct()
        return adds.join(commits.select(F.explode("drops").alias(BATCH_COLUMN)).distinct(), BATCH_COLUMN, "left_anti")

    def live(self, df: DataFrame) -> DataFrame:
        """The rows of live batches (the small side is the list of batches; AQE sees its size)."""
        return df.join(self.live_batches(), BATCH_COLUMN, "left_semi")

    def published(self, df: DataFrame) -> DataFrame:
        """The rows of batches that were ever committed: what is kept beside the table (hashes, logs,
        metrics) stays true when a compaction moves the batch's rows."""
        return df.join(self.frame().select(F.explode("adds").alias(BATCH_COLUMN)).distinct(), BATCH_COLUMN, "left_semi")


def commit_folder(location: str) -> str:
    """Where the commits of a table at ``location`` are."""
    return f"{location.rstrip('/')}_commits"
