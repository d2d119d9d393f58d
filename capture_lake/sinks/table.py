"""Append records to the day-partitioned target table.

Parquet through the session catalog by default; Iceberg when its runtime is
on the classpath (``fmt="iceberg"``).  One commit per batch, never per row.

Scale notes: all rows of a batch share one ``processed_at`` day, so the frame
is *not* repartitioned by the day column (that would funnel the whole batch
into one task); each task writes its own file into the day folder, and
``maxRecordsPerFile`` bounds the file size.  Under its day a batch has its own folder
(``capture_batch``); ``sinks.commits`` says which batches count, ``read_target`` reads them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from capture_lake.schema import DAY_COLUMN, to_records, with_day
from capture_lake.sinks.commits import BATCH_COLUMN, Commits, commit_folder, new_attempt
from capture_lake.sources.tables import table_exists, table_place

MAX_RECORDS_PER_FILE = 1_000_000


def split_identifier(identifier: str) -> tuple[str, str]:
    """``"<namespace>.<table>"`` split at the first dot."""
    if "." not in identifier:
        raise ValueError(f"table identifier must be '<namespace>.<table>', got: {identifier!r}")
    ns, name = identifier.split(".", 1)
    return ns, name


def table_location(warehouse: str, identifier: str) -> str:
    """Location of a new table: ``warehouse/table`` (the namespace is not part of it)."""
    return f"{warehouse.rstrip('/')}/{split_identifier(identifier)[1]}"


def create_namespace(spark: SparkSession, ns: str, warehouse: str) -> None:
    try:  # errors ignored: the namespace may exist or be managed elsewhere
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS `{ns}` LOCATION '{warehouse.rstrip('/')}/{ns}.db'")
    except Exception:
        pass


def commits_of(spark: SparkSession, identifier: str, warehouse: str) -> Commits:
    """The commits of a table, at its place in the catalog or the one it will get."""
    place = table_place(spark, identifier) if table_exists(spark, identifier) else table_location(warehouse, identifier)
    return Commits(spark, commit_folder(place))


def append_records(df: DataFrame, identifier: str, warehouse: str, fmt: str = "parquet", batch: str | None = None) -> dict:
    """W1 + W2: append ``df`` (projected to the record schema) to ``identifier``,
    creating namespace and table on first write.  An empty frame is still a
    valid append.

    ``batch``: the attempt the rows belong to; the caller commits it.  Without one the
    append is a batch of its own, committed at the end.

    Returns the write counters (A6) gathered by an ``Observation`` on the
    written rows, so counting takes no extra pass over the data:
    ``rows_written`` and ``rows_with_hash``.
    """
    spark = df.sparkSession
    ns, _ = split_identifier(identifier)
    obs = Observation("capture_write")
    records = to_records(df).observe(obs, F.count(F.lit(1)).alias("rows_written"),
                                     F.count_if(F.col("file_hash") != "").alias("rows_with_hash"))
    exists = table_exists(spark, identifier)
    if fmt == "iceberg":
        w = records.writeTo(identifier)
        if exists:
            w.append()
        else:
            create_namespace(spark, ns, warehouse)
            (w.using("iceberg").partitionedBy(F.days("processed_at"))
             .tableProperty("location", table_location(warehouse, identifier)).create())
        return dict(obs.get)
    attempt = batch or new_attempt()
    out = with_day(records).withColumn(BATCH_COLUMN, F.lit(attempt))
    writer = (out.write.format(fmt).mode("append").partitionBy(DAY_COLUMN, BATCH_COLUMN)
              .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE))
    if not exists:
        create_namespace(spark, ns, warehouse)
        writer = writer.option("path", table_location(warehouse, identifier))
    writer.saveAsTable(identifier)
    spark.catalog.refreshTable(identifier)
    if batch is None:
        commits_of(spark, identifier, warehouse).commit(attempt, [attempt])
    return dict(obs.get)
