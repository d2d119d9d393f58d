"""The capture job (M2): new objects in, checked day-partitioned records out.

``assemble`` is the relational core shared by every entry point::

    listing+metadata -> J1 (target) -> A3 OCR text/confidence (left)
      -> J3 source archive text (left) -> P1-P4 typed columns -> Q4 rules
      -> D2 first passing copy per hash -> one stored result row per object

``capture_files`` feeds it from object folders with user extractors (M3) for
OCR and PDF text; the test-data queries feed it from the driver's tables.

Cheap before expensive: dedup runs on listing rows (no payload bytes), so the
payload scan, inflate, OCR and archive reads only touch fresh objects.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from capture_lake.functions import image as IMG
from capture_lake.functions import metadata as M
from capture_lake.functions.codecs import zstd_inflate
from capture_lake.functions.text import join_pages
from capture_lake.operators import dedup, ocr, pdf, quality
from capture_lake.operators.extractor import run_extractor
from capture_lake.operators.metrics import CONFIDENCE_BOUNDS, DURATION_BOUNDS, batch_outcome, histogram
from capture_lake.schema import RECORD_COLUMNS, RECORD_SCHEMA
from capture_lake.session import stored
from capture_lake.sources import listing as L
from capture_lake.sources import objects as O


# What is kept of every listed object (results), beside the record columns.
RESULT_COLUMNS = ["key", "label", "status", "n_rows", "error"]


@dataclass
class CaptureResult:
    """``results``: one stored row per listed object, with RESULT_COLUMNS and the record
    columns (null but for the hash in duplicates).  Everything else is derived from it."""

    results: DataFrame

    @property
    def records(self) -> DataFrame:
        """Good rows: key and record columns."""
        return self.results.where(F.col("status") == quality.STATUS_OK).select("key", *RECORD_COLUMNS)

    @property
    def quarantine(self) -> DataFrame:
        """Failed rows: key, label, error and record columns."""
        return self.results.where(F.col("status") == quality.STATUS_QUARANTINE).select("key", "label", "error", *RECORD_COLUMNS)

    def outcome(self) -> DataFrame:
        """A5/A6 summary of the batch."""
        return batch_outcome(self.results)

    def confidence_histogram(self) -> DataFrame:
        """A7 over the written records' mean OCR confidence."""
        return histogram(self.records, "ocr_confidence_mean", CONFIDENCE_BOUNDS)

    def duration_histogram(self) -> DataFrame:
        """A8 over the written records' processing time, in seconds."""
        return histogram(self.records, F.col("processing_duration_ms") / 1000.0, DURATION_BOUNDS)


# Fixed value: the error of an object that was listed and is gone when it is read.
VANISHED_ERROR = "FileNotFoundError: object vanished before it was read"


def capture_rows(
    listing: DataFrame,
    target: DataFrame | None,
    process: Callable[[DataFrame], DataFrame],
    order: tuple[str, ...] = ("last_modified", "key"),
    bounded: bool = False,
    copies_at_once: bool = False,
    mark: Callable[[DataFrame], DataFrame] | None = None,
) -> CaptureResult:
    """J1, D2 and the checks for listing rows with a ``metadata`` map: what becomes of each.

    As if the objects came one after the other by ``order``: a hash in the
    target, or written by an earlier object of the batch, makes a duplicate;
    else the object is processed, and it is written if it passes all checks.
    So the first *passing* copy of a hash is the record, copies before it are
    failures, copies after it duplicates.

    ``process`` turns listing rows into checked rows (``status``, ``error``, record
    columns).  It is expensive for object files, so first only the first copy of
    each hash with readable metadata is processed; the other copies follow
    where it failed.  ``copies_at_once`` (cheap ``process``) takes all copies in
    one pass.  ``bounded``: see ``dedup.mark_captured``.  ``mark`` sets ``captured`` in the
    place of the target (an index of its hashes).
    """
    hashed = listing.withColumn("file_hash", M.meta_string("metadata", M.KEY_CONTENT_HASH, ""))
    known = dedup.mark_captured(hashed, target, bounded=bounded) if mark is None else mark(hashed)
    marked = stored(known.withColumns(
        {"__ord": F.struct(*order), "__dkey": dedup.dedup_key(hashed), "__bad": M.parse_errors("metadata")}))
    todo = marked.where(~F.col("captured"))
    readable = todo.where(F.size("__bad") == 0)
    extra = ["__ord", "__dkey", "__bad", "captured"]

    def run(rows: DataFrame, store: bool = True) -> DataFrame:
        """Checked rows, stored unless they are used once; listed objects that gave none have vanished."""
        done = process(rows.drop(*extra)).select("key", "status", "error", *RECORD_COLUMNS)
        done = stored(done) if store else done
        found = done.withColumn("__found", F.lit(True)).drop("file_hash")
        joined = rows.select("key", "metadata", "file_hash", "__ord", "__dkey").join(found, "key", "left")
        gone = F.col("__found").isNull()
        return joined.withColumns({
            "status": F.when(gone, F.lit(quality.STATUS_QUARANTINE)).otherwise(F.col("status")),
            "error": F.when(gone, F.lit(VANISHED_ERROR)).otherwise(F.col("error")),
            "processed_at": F.when(gone, F.current_timestamp()).otherwise(F.col("processed_at")),
        }).drop("__found")

    if copies_at_once:
        done = run(todo, store=False)
    else:
        first = stored(dedup.first_per_hash(readable, order))
        done = run(first)
        failed = done.where((F.col("status") != quality.STATUS_OK) & dedup.has_hash()).select("__dkey").distinct()
        others = readable.join(failed, "__dkey", "left_semi").join(first.select("key"), "key", "left_anti")
        others = stored(others)
        if not others.isEmpty():
            done = done.unionByName(run(others))
        # unreadable metadata fails whatever the payload holds
        columns = {c: F.lit(None).cast(RECORD_SCHEMA[c].dataType) for c in RECORD_COLUMNS if c != "file_hash"}
        columns |= {"status": F.lit(quality.STATUS_QUARANTINE), "error": F.concat_ws(",", "__bad"), "processed_at": F.current_timestamp(), "original_path": F.col("key")}
        bad = todo.where(F.size("__bad") > 0).withColumns(columns)
        done = done.unionByName(bad.select(*done.columns))
    done = stored(done)

    # the first copy of each hash that passed (one row per hash: partial minima, no window over copies)
    passed = done.where(F.col("status") == quality.STATUS_OK)
    winners = passed.groupBy("__dkey").agg(F.min("__ord").alias("__won"))
    judged = done.join(winners, "__dkey", "left")
    later = F.col("__ord") > F.col("__won")
    status = F.when(F.coalesce(later, F.lit(False)), F.lit(quality.STATUS_DUPLICATE)).otherwise(F.col("status"))
    judged = judged.withColumn("status", status)
    known = done.select("key")
    rest = marked.join(known, "key", "left_anti").withColumns(
        {"status": F.lit(quality.STATUS_DUPLICATE), "error": F.lit(None).cast("string")})

    def row(df: DataFrame, has_record: bool) -> DataFrame:
        dup = F.col("status") == quality.STATUS_DUPLICATE
        keep = [F.col("file_hash") if c == "file_hash"
                else F.when(~dup, F.col(c)).alias(c) if has_record else F.lit(None).cast(RECORD_SCHEMA[c].dataType).alias(c)
                for c in RECORD_COLUMNS]
        return df.select("key", M.log_label("metadata", "key").alias("label"), "status",
                         F.when(F.col("status") == quality.STATUS_OK, 1).otherwise(0).cast("bigint").alias("n_rows"),
                         F.when(~dup, F.col("error")).alias("error"), *keep)

    return CaptureResult(stored(row(judged, True).unionByName(row(rest, False))))


def assemble(
    fresh: DataFrame,
    ocr_summary: DataFrame | None = None,
    ocr_keys: tuple[str, str] = ("key", "key"),
    intake_text: DataFrame | None = None,
    processed_at: Column | None = None,
    duration_ms: Column | None = None,
    width: Column | None = None,
    height: Column | None = None,
    extra_errors: Column | None = None,
    enforce_rules: bool = True,
) -> DataFrame:
    """Record columns + ``status``/``error`` for fresh rows (no dedup here).

    ``enforce_rules``: rows that break a range rule fail (False: only rows that
    could not be read or parsed do, and the rules are left to reports).

    ``ocr_summary``: ``(key, ocr_raw_text, ocr_confidence_mean)``, joined on
    ``ocr_keys`` = (fresh column, summary column); when None, ``fresh``
    already has the two OCR columns.  ``intake_text``: ``(intake_key,
    pdf_raw_text)`` joined on the ``source-intake-key`` metadata value.
    """
    df = fresh
    if ocr_summary is not None:
        df = ocr.attach_ocr(df, ocr_summary, ocr_keys[0], ocr_keys[1])
    elif "ocr_raw_text" not in df.columns:
        df = df.withColumns({"ocr_raw_text": F.lit(""), "ocr_confidence_mean": F.lit(0.0)})
    if intake_text is not None:
        df = attach_intake(df, intake_text)
    elif "pdf_raw_text" not in df.columns:
        df = df.withColumn("pdf_raw_text", F.lit(""))
    cols = M.metadata_columns("metadata", width, height)
    cols["processed_at"] = F.current_timestamp() if processed_at is None else processed_at
    cols["processing_duration_ms"] = F.lit(0).cast("bigint") if duration_ms is None else duration_ms.cast("bigint")
    df = df.withColumns(cols)
    errs = M.parse_errors("metadata", width, height)
    if extra_errors is not None:
        errs = F.concat(errs, extra_errors)
    return quality.check(df, None if enforce_rules else [], extra_errors=errs)


def attach_intake(df: DataFrame, intake_text: DataFrame) -> DataFrame:
    """Left join to the source archive text; no key, no archive, no PDF or
    a bad archive all give ``""``, never a lost row.

    Images without an archive key join on a per-row value that matches
    nothing (``"\0" || key``) instead of a shared NULL/empty key, so they
    spread over the reducers instead of piling into one.  An archive shared
    by many images is split by AQE's skew join (left side).
    """
    extra = [c for c in intake_text.columns if c not in ("intake_key", "pdf_raw_text")]
    it = intake_text.select(F.col("intake_key").alias("__ikey"), F.col("pdf_raw_text").alias("__pdf"), *extra)
    src = M.meta_get("metadata", M.KEY_SOURCE_INTAKE_KEY)
    row_id = (F.col("key").cast("string") if "key" in df.columns
              else F.xxhash64(*[F.col(c) for c in df.columns]).cast("string"))
    with_key = df.withColumn("__src", F.when(F.coalesce(src != "", F.lit(False)), src)
                             .otherwise(F.concat(F.lit("\u0000"), row_id)))
    joined = with_key.join(it, with_key["__src"] == it["__ikey"], "left")
    return joined.withColumn("pdf_raw_text", F.coalesce(F.col("__pdf"), F.lit(""))).drop("__src", "__ikey", "__pdf")


def run_single(capture: Callable[[list[str]], CaptureResult], key: str) -> dict:
    """Capture one named object (``--key`` runs).

    ``capture(keys)`` runs the job restricted to ``keys``.  A duplicate is a
    success with 0 rows; a quarantined or missing object raises, so the
    caller's job fails.  Only the one key's status reaches the driver.
    """
    res = capture([key])
    rows = res.results.where(F.col("key") == key).select("status", "n_rows", "error").limit(2).collect()
    if not rows:
        raise RuntimeError(f"Processing failed: object not found: {key}")
    bad = [r for r in rows if r.status == quality.STATUS_QUARANTINE]
    if bad:
        raise RuntimeError(f"Processing failed: {key}: {bad[0].error}")
    return {"status": rows[0].status, "key": key, "rows": int(sum(r.n_rows for r in rows))}


# --------------------------------------------------------------------------
# Object folders + extractors (the production path)
# --------------------------------------------------------------------------

# Fixed value: the error of a payload that inflates but is not an image.
NOT_AN_IMAGE_ERROR = "UnidentifiedImageError: cannot identify image file"

OCR_OUTPUT = T.StructType([T.StructField("ocr_raw", ocr.RAW_TYPE)])
PDF_OUTPUT = T.StructType([T.StructField("pages", T.ArrayType(T.StringType()))])


def capture_files(
    spark: SparkSession,
    images_root: str,
    manifest: DataFrame,
    target: DataFrame | None,
    ocr_factory: Callable[[], Callable[[bytes, dict], Any]],
    pdf_factory: Callable[[], Callable[[bytes], Any]] | None = None,
    intake_root: str | None = None,
    start: dt.datetime | str | None = None,
    end: dt.datetime | str | None = None,
    prefix: str = "",
    region: dict | None = None,
    partitions: int | None = None,
    keys: list[str] | DataFrame | None = None,
    enforce_rules: bool = True,
) -> CaptureResult:
    """M2 over object folders.

    ``ocr_factory()`` returns ``fn(image_png_bytes, box) -> nested lines``:
    blocks of ``{"text", "confidence"}`` or of the engine's native
    ``[box, [text, confidence]]`` entries; it is called on fresh rows only.
    ``pdf_factory()`` returns ``fn(pdf_bytes) -> list of page texts``.
    ``partitions`` round-robins the fresh rows before the Python work (the
    byte-packed tasks that read the payloads are used otherwise).
    ``keys``: only these objects; one key is also the listing's prefix.
    """
    if isinstance(keys, list) and len(keys) == 1 and keys[0].startswith(prefix):
        prefix = keys[0]
    listed = O.list_objects(spark, images_root, prefix, L.CAPTURE_SUFFIX, start, end)
    if isinstance(keys, DataFrame):
        listed = listed.join(keys.select("key").distinct(), "key", "left_semi")
    elif keys is not None:
        listed = L.select_keys(listed, keys)
    with_meta = L.attach_metadata(listed, manifest)
    process = payload_process(spark, images_root, ocr_factory, pdf_factory, intake_root, region, partitions, enforce_rules)
    return capture_rows(with_meta, target, process)


def payload_process(
    spark: SparkSession,
    images_root: str,
    ocr_factory: Callable[[], Callable[[bytes, dict], Any]],
    pdf_factory: Callable[[], Callable[[bytes], Any]] | None = None,
    intake_root: str | None = None,
    region: dict | None = None,
    partitions: int | None = None,
    enforce_rules: bool = True,
) -> Callable[[DataFrame], DataFrame]:
    """``process`` of ``capture_rows`` for stored listing rows of objects under ``images_root``."""

    def process(rows: DataFrame) -> DataFrame:
        # archive texts come from the listing rows, so finding the archives never runs the image pipeline
        intake_text = None
        if intake_root is not None and pdf_factory is not None:
            intake_text = archive_texts(spark, intake_root, rows, pdf_factory)
        return assemble_payloads(O.read_payloads(rows, images_root), ocr_factory, intake_text, region, partitions, enforce_rules)

    return process


def assemble_payloads(
    rows: DataFrame,
    ocr_factory: Callable[[], Callable[[bytes, dict], Any]],
    intake_text: DataFrame | None = None,
    region: dict | None = None,
    partitions: int | None = None,
    enforce_rules: bool = True,
) -> DataFrame:
    """Fresh rows with ``metadata`` and zstd ``content`` -> checked records.

    M1 inflate, P7 size, P5/P6 OCR box, M3 OCR (``fail`` policy), E3/A1-A3
    row-local, then the source archive text (J3, ``intake_text`` from
    ``archive_texts``) and the record columns.  Every failure is a per-row
    error routed to quarantine.  Nothing here triggers a job: the extractor
    runs once, when the caller materialises the result.  The image goes to the
    extractor once and does not come back.

    P4: ``processing_duration_ms`` is the time to inflate, to recognise and to
    read the archive's PDF; the write of the batch is not included.
    """
    region = region or IMG.OCR_REGION
    if partitions:
        rows = rows.repartition(partitions)
    rows = rows.withColumn("__img", zstd_inflate(F.col("content"))).drop("content")
    img = F.col("__img.payload")
    rows = rows.withColumns({"__w": IMG.png_width(img), "__h": IMG.png_height(img),
                             "__img_err": F.col("__img.error"), "__img_ms": F.col("__img.ms")})
    box = IMG.pixel_box(F.lit(region["x_min"]), F.lit(region["y_min"]), F.lit(region["x_max"]),
                        F.lit(region["y_max"]), F.col("__w"), F.col("__h"))
    rows = rows.withColumn("__box", box).withColumn("__box_err", IMG.box_error(F.col("__box"), F.col("__w"), F.col("__h")))
    ok_for_ocr = F.col("__img_err").isNull() & F.col("__w").isNotNull() & F.col("__box_err").isNull()
    rows = rows.withColumn("__ocr_in", F.when(ok_for_ocr, img)).drop("__img")

    def ocr_guarded():
        fn = ocr_factory()

        def call(png, box):
            if png is None:
                return None
            return ocr.lines_from_engine(fn(png, box))
        return call

    passing = [c for c in rows.columns if c != "__ocr_in"]
    extracted = run_extractor(rows, ocr_guarded, ["__ocr_in", "__box"], OCR_OUTPUT, on_error="fail",
                              error_col="__ocr_err", elapsed_col="__ocr_ms", passthrough=passing)
    extracted = ocr.summarize_raw(extracted, "ocr_raw")

    not_png = F.when(F.col("__img_err").isNull() & F.col("__w").isNull(), F.lit(NOT_AN_IMAGE_ERROR))
    errors = F.filter(F.array(F.col("__img_err"), not_png, F.col("__box_err"), F.col("__ocr_err")),
                      lambda x: x.isNotNull())
    spent = F.coalesce(F.col("__img_ms"), F.lit(0.0)) + F.col("__ocr_ms")
    if intake_text is not None:
        spent = spent + F.coalesce(F.col("pdf_ms"), F.lit(0))
    return assemble(extracted, None, intake_text=intake_text, duration_ms=F.round(spent),
                    width=F.col("__w"), height=F.col("__h"), extra_errors=errors, enforce_rules=enforce_rules)


def archive_texts(spark: SparkSession, intake_root: str, images: DataFrame,
                  pdf_factory: Callable[[], Callable[[bytes], Any]]) -> DataFrame:
    """Per referenced archive: first PDF member -> pages -> assembled text, and the ms it took.

    The intake folder is listed and semi-joined with the batch's distinct references
    (combined map-side: a ZIP shared by many images is read once); only the archives that
    are left are opened.  A missing archive is simply absent (its images get ``""``).
    """
    refs = images.select(M.meta_get("metadata", M.KEY_SOURCE_INTAKE_KEY).alias("intake_key")).where(
        F.col("intake_key").isNotNull() & (F.col("intake_key") != "")).distinct()
    listed = O.list_objects(spark, intake_root).select(F.col("key").alias("intake_key"), "path", "size")
    present = stored(listed.join(refs, "intake_key", "left_semi"))
    firsts = pdf.first_pdf(O.read_payloads(present, intake_root).select("intake_key", "content"))
    texts = run_extractor(firsts, pdf_factory, ["pdf_bytes"], PDF_OUTPUT, on_error="empty", empty=[],
                          error_col="__pdf_err", elapsed_col="pdf_ms", passthrough=["intake_key"])
    return texts.select("intake_key", join_pages(F.col("pages")).alias("pdf_raw_text"), "pdf_ms")
