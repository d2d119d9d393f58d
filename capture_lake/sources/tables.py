"""Catalog helpers for the target table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from capture_lake.operators.dedup import hash_exists
from capture_lake.sinks.commits import BATCH_COLUMN, Commits, commit_folder

# Spark's error conditions for a namespace or table that isn't there.
MISSING_CONDITIONS = ("SCHEMA_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND", "NO_SUCH_NAMESPACE", "NO_SUCH_TABLE")


def table_exists(spark: SparkSession, identifier: str) -> bool:
    """True when the table is in the catalog; False for a missing table or namespace.

    Any other failure (a catalog that is down) is raised: read as "no table"
    it would capture everything again."""
    try:
        return spark.catalog.tableExists(identifier)
    except AnalysisException as exc:
        if exc.getCondition() in MISSING_CONDITIONS:
            return False
        raise


def table_place(spark: SparkSession, identifier: str) -> str:
    """Where the catalog says the table is."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {identifier}").where("col_name = 'Location'").select("data_type").collect()
    return rows[0][0]


def read_target(spark: SparkSession, identifier: str) -> DataFrame | None:
    """The committed rows of the target table, refreshed (a stream's cloned session may
    hold an old file listing), or None when it does not exist yet.  A table without
    batches (another format's own commits) is read as it is."""
    if not table_exists(spark, identifier):
        return None
    spark.catalog.refreshTable(identifier)
    table = spark.table(identifier)
    if BATCH_COLUMN not in table.columns:
        return table
    return Commits(spark, commit_folder(table_place(spark, identifier))).live(table)


def record_exists(spark: SparkSession, identifier: str, file_hash: str) -> bool:
    """One hash, predicate pushed to the scan; False with no table."""
    target = read_target(spark, identifier)
    return target is not None and hash_exists(target, file_hash)
