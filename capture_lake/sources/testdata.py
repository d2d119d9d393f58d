"""Stand-in inputs derived from the driver's tables.

The driver's tables hold no images, so the capture inputs are reshaped from
them with Spark expressions; every operator stays generic over column names.

* ``captures`` (from ``documents``): one object per document with a key, a
  size, a modification time, an ETag and a content hash, plus the metadata
  map the producer would attach.  Some objects are not images (``.txt``),
  some carry an empty hash, and repeated texts give real hash duplicates.
* already-captured target: the captures with ``doc_id % 3 = 0``; the batch
  being captured is the rest.  Together they cover the whole table.
* OCR lines: ``conversations`` turns, confidence ``1 / (1 + turn)``.
* source archives (intake): ``labels`` rows, the document text as the PDF
  text with one page per line.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from capture_lake.functions import metadata as M

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


# Declared schemas of the driver's tables: reading with a schema skips the
# footer-inference job and pins the types (timestamps carry no zone).
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _opt(key: str, value: Column, present: Column | None = None) -> Column:
    entry = F.struct(F.lit(key).alias("key"), value.alias("value"))
    return entry if present is None else F.when(present, entry)


def capture_metadata() -> Column:
    """The producer's metadata map for a capture row (keys may be missing)."""
    doc_id = F.col("doc_id")
    entries = F.array(
        _opt(M.KEY_CONTENT_HASH, F.col("file_hash")),
        _opt(M.KEY_ORIGINAL_PATH, F.col("key")),
        _opt(M.KEY_SOURCE_ZIP, F.concat(F.col("source"), F.lit(".zip"))),
        _opt(M.KEY_IMAGE_WIDTH, F.col("size").cast("string")),
        _opt(M.KEY_IMAGE_HEIGHT, (F.col("size") % 997).cast("string")),
        _opt(M.KEY_COMPRESSION_RATIO, (F.col("size") / F.lit(1000.0).cast("double")).cast("string")),
        _opt(M.KEY_PDF_PRODUCER, F.col("lang"), doc_id % 2 == 0),
        _opt(M.KEY_PDF_CREATOR, F.col("source"), doc_id % 5 == 0),
        _opt(M.KEY_WATCHER_VERSION, F.concat(F.lit("0."), (doc_id % 4).cast("string")), doc_id % 7 != 0),
        _opt(M.KEY_SOURCE_INTAKE_KEY, intake_key(doc_id)),
    )
    return F.map_from_entries(F.filter(entries, lambda e: e.isNotNull()))


def intake_key(doc_id: Column) -> Column:
    return F.concat(F.lit("intake/"), doc_id.cast("string"), F.lit(".zip"))


def captures(spark: SparkSession, sf_dir: str, with_text: bool = True) -> DataFrame:
    """Listing + hash + metadata stand-in, one row per document."""
    # The text digest is computed once in its own projection; Catalyst keeps
    # it there (an expensive expression is not inlined into several uses).
    d = table(spark, sf_dir, "documents").withColumn("__md5", F.md5(F.col("text")))
    doc_id = F.col("doc_id")
    base = d.select(
        doc_id,
        F.concat(F.col("source"), F.lit("/"), doc_id.cast("string"),
                 F.when(doc_id % 10 == 0, F.lit(".txt")).otherwise(F.lit(".png.zst"))).alias("key"),
        F.col("n_chars").alias("size"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
         + F.make_dt_interval(F.lit(0), F.lit(0), doc_id.cast("int"), F.lit(0))).alias("last_modified"),
        F.concat(F.lit('"'), F.col("__md5"), F.lit('"')).alias("etag"),
        F.when(doc_id % 17 == 0, F.lit("")).otherwise(F.col("__md5")).alias("file_hash"),
        F.col("text"),
        F.col("source"),
        F.col("lang"),
    )
    out = base.withColumn("metadata", capture_metadata())
    return out if with_text else out.drop("text")


def is_target(doc_id: Column | None = None) -> Column:
    """Rows already in the target table before the batch."""
    return (F.col("doc_id") if doc_id is None else doc_id) % 3 == 0


def target_records(caps: DataFrame) -> DataFrame:
    """The already-captured target, as records (hash and path are what dedup reads)."""
    return caps.where(is_target()).select(F.col("file_hash"), F.col("key").alias("original_path"))


def batch(caps: DataFrame) -> DataFrame:
    return caps.where(~is_target())


def ocr_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OCR lines table ``(image_id, line_no, text, confidence)``."""
    c = table(spark, sf_dir, "conversations")
    return c.select(
        F.col("conv_id").alias("image_id"),
        F.col("turn").alias("line_no"),
        F.col("text"),
        (F.lit(1.0) / (F.lit(1.0) + F.col("turn").cast("double"))).alias("confidence"),
    )


def intake_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source archives ``(intake_key, pages)``: one per labelled document."""
    lab = table(spark, sf_dir, "labels").select("doc_id")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lab.join(docs, "doc_id").select(intake_key(F.col("doc_id")).alias("intake_key"),
                                           F.split(F.col("text"), "\n").alias("pages"))


def write_objects(objects: DataFrame, root: str) -> int:
    """Write ``(key, content, last_modified)`` rows as files under ``root``; how many.

    ``root`` is a folder that every node mounts at the same place (a ``file:`` path);
    Spark has no sink for single binary objects.  A task that runs again
    writes the same files again."""
    import os

    base = root.removeprefix("file://").removeprefix("file:")
    if not base.startswith("/"):
        raise ValueError(f"not a mounted folder: {root}")

    def write(batches):
        for b in batches:
            for key, content, seconds in zip(*(b.column(i).to_pylist() for i in range(3))):
                path = os.path.join(base, key)
                os.makedirs(os.path.dirname(path), exist_ok=True)
                with open(path, "wb") as f:
                    f.write(content)
                if seconds is not None:
                    os.utime(path, (seconds, seconds))
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], names=["n"])

    rows = objects.select("key", "content", F.unix_timestamp(F.col("last_modified").cast("timestamp")).alias("seconds"))
    return rows.mapInArrow(write, "n long").agg(F.sum("n")).first()[0] or 0
