"""Record schema of the capture table (Q1) and the required-column check (Q3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names, order and types of the target table.
RECORD_SCHEMA = T.StructType(
    [
        T.StructField("file_hash", T.StringType()),
        T.StructField("processed_at", T.TimestampType()),
        T.StructField("original_path", T.StringType()),
        T.StructField("source_zip", T.StringType()),
        T.StructField("image_width", T.IntegerType()),
        T.StructField("image_height", T.IntegerType()),
        T.StructField("compression_ratio", T.DoubleType()),
        T.StructField("processing_duration_ms", T.LongType()),
        T.StructField("pdf_producer", T.StringType()),
        T.StructField("pdf_creator", T.StringType()),
        T.StructField("ocr_raw_text", T.StringType()),
        T.StructField("ocr_confidence_mean", T.DoubleType()),
        T.StructField("pdf_raw_text", T.StringType()),
        T.StructField("watcher_version", T.StringType()),
    ]
)
RECORD_COLUMNS = RECORD_SCHEMA.fieldNames()

# Day partition column of the table (W3), derived from processed_at in UTC.
DAY_COLUMN = "processed_at_day"


def empty_records(spark: SparkSession) -> DataFrame:
    """An empty frame with the record schema."""
    return spark.createDataFrame([], RECORD_SCHEMA)


def missing_columns(df: DataFrame) -> list[str]:
    """Record columns absent from ``df`` in schema order; extra columns are fine."""
    have = set(df.columns)
    return [c for c in RECORD_COLUMNS if c not in have]


# Fixed value: the missing-columns message prefix.
MISSING_FIELDS_MESSAGE = "Missing required fields: "


def require_columns(df: DataFrame) -> DataFrame:
    """Raise ``ValueError`` naming every missing record column (Q3)."""
    missing = missing_columns(df)
    if missing:
        raise ValueError(f"{MISSING_FIELDS_MESSAGE}{missing}")
    return df


def to_records(df: DataFrame) -> DataFrame:
    """Select the 14 record columns in order, cast to the record types (Q1)."""
    require_columns(df)
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in RECORD_SCHEMA.fields])


def with_day(df: DataFrame, ts: str = "processed_at") -> DataFrame:
    """Add the ``processed_at_day`` partition value (UTC day of ``ts``)."""
    return df.withColumn(DAY_COLUMN, day_of(F.col(ts)))


def day_of(ts: Column) -> Column:
    return F.to_date(ts)
