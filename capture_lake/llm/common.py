"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capture_lake.session import scratch_path, stored  # noqa: F401  (`stored` is used by the operators)

#: Bytes of text that one Arrow batch to a Python worker may hold.
BATCH_BYTES = 4 * 1024 * 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes and rows, so long texts do not pile up in a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


def once(udf):
    """A UDF whose result is also filtered on: the optimizer may not copy it into the filter, which
    would run it twice, in two Python workers a task."""
    return udf.asNondeterministic()


def stored_table(df: DataFrame, name: str) -> DataFrame:
    """`df` as a Parquet table in the shared folder: column pruning and, unlike a
    checkpoint, file sizes that let Catalyst broadcast it only when it is small."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clean_text(col: str = "text"):
    """A null text counts as empty."""
    return F.coalesce(F.col(col), F.lit(""))


def fresh_names(df: DataFrame, *bases: str) -> list[str]:
    """Column names that `df` does not have yet (its own columns may be called anything)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for base in bases:
        name = f"__{base}"
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
