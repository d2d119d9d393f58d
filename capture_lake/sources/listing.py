"""Listing rows and their filters (S1-S6, J4); payloads are read in ``sources.objects``.

Listing rows are ``(key, size, last_modified, etag, path)``; the manifest is
``(key, metadata map<string,string>)``.

A bucket (or folder) is read with Spark's ``binaryFile`` source.  Listing
projects only ``path, length, modificationTime``, so file contents are never
read for a listing; the suffix goes to the source as ``pathGlobFilter`` and
the interval bounds become pushed ``modificationTime`` filters, evaluated on
the file status before any byte is read.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the object suffix of capture images.
CAPTURE_SUFFIX = ".png.zst"

MANIFEST_SCHEMA = T.StructType(
    [T.StructField("key", T.StringType()), T.StructField("metadata", T.MapType(T.StringType(), T.StringType()))]
)
BINARY_FILE_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType(), False),
        T.StructField("modificationTime", T.TimestampType(), False),
        T.StructField("length", T.LongType(), False),
        T.StructField("content", T.BinaryType(), True),
    ]
)


def _root_uri_pattern(root: str) -> str:
    # binaryFile reports qualified paths (file:/x/y, s3a://b/x/y); strip the
    # scheme and authority, then the root folder, to get the object key.
    bare = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", root).rstrip("/")
    return r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?" + re.escape(bare) + "/"


def key_of(path: Column, root: str) -> Column:
    return F.regexp_replace(path, _root_uri_pattern(root), "")


def strip_etag(etag: Column) -> Column:
    """Remove surrounding double quotes."""
    return F.btrim(etag, F.lit('"'))


def filter_listing(df: DataFrame, prefix: str = "", suffix: str | None = None,
                   start: dt.datetime | str | None = None, end: dt.datetime | str | None = None,
                   key: str = "key", ts: str = "last_modified") -> DataFrame:
    """S2 prefix, S3 suffix (case-sensitive), S4 interval on any listing frame."""
    out = df
    if prefix:
        out = out.where(F.col(key).startswith(prefix))
    if suffix:
        out = out.where(F.col(key).endswith(suffix))
    if start is not None and end is not None:
        out = out.where((F.col(ts) >= F.lit(start)) & (F.col(ts) < F.lit(end)))
    return out


_GLOB_SPECIAL = re.compile(r"([\\*?\[\]{}])")


def open_files(spark: SparkSession, root: str, prefix: str = "", suffix: str | None = None,
               start: dt.datetime | str | None = None, end: dt.datetime | str | None = None) -> DataFrame:
    """binaryFile scan ``(path, modificationTime, length, content)`` of ``root``.

    A key ``prefix`` is pushed into the path as an escaped glob
    (``root/<prefix>*``) so only matching folders and objects are listed, as an
    object store lists by prefix; interval bounds are pushed filters.  No match
    gives no rows.  A file that goes between listing and reading is skipped by
    the read; callers find it by its missing row.

    Spark's file sources never list names that begin with ``_`` or ``.``; the capture job
    lists with ``sources.objects``, which does."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("ignoreMissingFiles", "true")
    if suffix:
        reader = reader.option("pathGlobFilter", f"*{suffix}")
    path = _GLOB_SPECIAL.sub(r"\\\1", root.rstrip("/"))
    if prefix:
        path = f"{path}/{_GLOB_SPECIAL.sub(r'\\\1', prefix)}*"
    try:
        files = reader.load(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            return spark.createDataFrame([], BINARY_FILE_SCHEMA)
        raise
    if start is not None and end is not None:
        files = files.where((F.col("modificationTime") >= F.lit(start).cast("timestamp"))
                            & (F.col("modificationTime") < F.lit(end).cast("timestamp")))
    return files


def listing_of(files: DataFrame, root: str, prefix: str = "") -> DataFrame:
    """``(key, size, last_modified, etag, path)`` of a file scan; no byte is read.

    The file source has no ETag, so ``etag`` is ``""`` (the producer's default).
    """
    listing = files.select(
        key_of(F.col("path"), root).alias("key"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("last_modified"),
        F.lit("").alias("etag"),
        F.col("path"),
    )
    return filter_listing(listing, prefix=prefix)


def list_objects(spark: SparkSession, root: str, prefix: str = "", suffix: str | None = None,
                 start: dt.datetime | str | None = None, end: dt.datetime | str | None = None) -> DataFrame:
    """Listing of every object under ``root``."""
    return listing_of(open_files(spark, root, prefix, suffix, start, end), root, prefix)


def select_keys(df: DataFrame, keys: Iterable[str], key: str = "key") -> DataFrame:
    """Only the named objects (``--key`` runs)."""
    return df.where(F.col(key).isin(list(keys)))


def latest_manifest(manifest: DataFrame, key: str = "key", version: str = "updated_at") -> DataFrame:
    """One metadata row per key: the latest by ``version`` when the manifest has that column,
    and among equals (or without it) the one whose JSON text is greatest."""
    order = [F.col(version)] if version in manifest.columns else []
    return manifest.groupBy(key).agg(F.max_by("metadata", F.struct(*order, F.to_json("metadata"))).alias("metadata"))


def attach_metadata(listing: DataFrame, manifest: DataFrame, key: str = "key", bounded: bool = False) -> DataFrame:
    """Listing joined to its user metadata; no manifest row = empty map.

    Repeated manifest rows of a key count once (``latest_manifest``).  A manifest
    covers every object ever seen while a batch lists one interval.  ``bounded``
    says that the listing's row count is capped by its source (a stream's
    ``maxFilesPerTrigger``): its keys are broadcast to filter the manifest scan
    map-side, and only the batch's own manifest rows are exchanged.
    """
    m = manifest
    if bounded:
        keys = listing.select(F.col(key).alias("__b")).where(F.col("__b").isNotNull()).distinct()
        m = m.join(F.broadcast(keys), m[key] == F.col("__b"), "left_semi")
    m = latest_manifest(m, key).select(F.col(key).alias("__mkey"), F.col("metadata").alias("__meta"))
    out = listing.join(m, listing[key] == m["__mkey"], "left").drop("__mkey")
    return out.withColumn("metadata", F.coalesce(F.col("__meta"), F.create_map().cast("map<string,string>"))).drop("__meta")
