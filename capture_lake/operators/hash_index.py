"""A bucketed index of captured hashes for J1 and S9 on a large target.

``<table>_hashes`` holds (file_hash, capture_batch), bucketed and sorted by the hash and appended
with each batch.  A batch is dealt to as many partitions as there are buckets and joined bucket
by bucket: the index is never exchanged, whatever its size, and a point lookup reads one bucket.
Which batches count is looked up for the hits only (an attempt that died may have left rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capture_lake.operators.dedup import HASH, KEY, dedup_key, has_hash
from capture_lake.session import stored
from capture_lake.sinks.commits import BATCH_COLUMN, Commits
from capture_lake.sinks.table import create_namespace
from capture_lake.sources.tables import table_exists

#: Buckets of a new index: a few hundred MB of hashes each at the size it is meant for.
BUCKETS = 64


def index_name(identifier: str) -> str:
    return f"{identifier}_hashes"


def append_hashes(records: DataFrame, identifier: str, location: str, batch: str, buckets: int = BUCKETS) -> None:
    """Stage a batch's distinct non-empty hashes; they count once the batch is committed.  The first
    batch creates the table, and its namespace where no record was written before."""
    spark, index = records.sparkSession, index_name(identifier)
    if table_exists(spark, index):
        buckets = index_buckets(spark, identifier)
    rows = records.where(has_hash()).select(HASH, F.lit(batch).alias(BATCH_COLUMN)).distinct()
    writer = rows.repartition(buckets, HASH).write.format("parquet").mode("append").bucketBy(buckets, HASH).sortBy(HASH)
    if not table_exists(spark, index):
        if "." in identifier:
            create_namespace(spark, identifier.split(".", 1)[0], location.rstrip("/").rpartition("/")[0])
        writer = writer.option("path", location)
    writer.saveAsTable(index)
    spark.catalog.refreshTable(index)


def index_buckets(spark: SparkSession, identifier: str) -> int:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {index_name(identifier)}").where("col_name = 'Num Buckets'").select("data_type").collect()
    return int(rows[0][0])


def captured_hits(probes: DataFrame, identifier: str, commits: Commits) -> DataFrame:
    """The distinct ``__dkey`` of ``probes`` (dealt by it to the index's buckets) that a committed batch captured."""
    index = probes.sparkSession.table(index_name(identifier))
    found = index.join(probes.select("__dkey").distinct(), index[HASH] == F.col("__dkey")).select("__dkey", BATCH_COLUMN)
    # stored: the look at the commits would be pushed below the join, onto the whole index
    return commits.published(stored(found)).select("__dkey").distinct()


def mark_captured(batch: DataFrame, identifier: str, commits: Commits, flag: str = "captured", key: str | None = KEY) -> DataFrame:
    """J1 and J2 against the index: every row of the batch, with whether its hash is captured."""
    spark = batch.sparkSession
    if not table_exists(spark, index_name(identifier)):
        return batch.withColumn(flag, F.lit(False))
    dealt = batch.withColumn("__dkey", dedup_key(batch, key=key)).repartition(index_buckets(spark, identifier), "__dkey")
    hits = captured_hits(dealt, identifier, commits).withColumnRenamed("__dkey", "__hit")
    return dealt.join(hits, dealt["__dkey"] == hits["__hit"], "left").withColumn(flag, F.col("__hit").isNotNull()).drop("__hit", "__dkey")


def hash_exists(spark: SparkSession, identifier: str, file_hash: str, commits: Commits) -> bool:
    """Point lookup; the equality reads one bucket of the index."""
    if not file_hash or not table_exists(spark, index_name(identifier)):
        return False
    return not commits.published(spark.table(index_name(identifier)).where(F.col(HASH) == F.lit(file_hash))).limit(1).isEmpty()
