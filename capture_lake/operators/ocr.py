"""Recognised-line assembly (E3 flatten, A1 text, A2 mean confidence, A3 pair).

Two forms of the same semantics:

* row-local, when an extractor returns the nested result per image: higher
  order functions on the array, no shuffle at all;
* grouped, when lines arrive as a table ``(key, ordinal, text, confidence)``:
  one ``groupBy`` whose mean combines map-side, left-joined back so images
  without lines get ``("", 0.0)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from capture_lake.functions.text import LINE_SEPARATOR

LINE_TYPE = T.StructType(
    [T.StructField("text", T.StringType()), T.StructField("confidence", T.DoubleType())]
)
RAW_TYPE = T.ArrayType(T.ArrayType(LINE_TYPE))


def _shape(entry):
    """An engine entry in the shape of ``LINE_TYPE``.

    An entry is a mapping with the two fields, or a sequence whose second
    member is the recognised (text, confidence).  What an entry lacks becomes
    NULL; ``flat_lines`` drops such lines in Spark.  A confidence that is not a
    number raises: the image fails."""
    if isinstance(entry, dict):
        pair = [entry.get(f) for f in LINE_TYPE.fieldNames()]
    else:
        read = [*(entry or ()), None, None][1] or ()
        pair = [*read, None, None][:2]
    text, confidence = pair
    return {
        "text": text if text is None else str(text),
        "confidence": confidence if confidence is None else float(confidence),
    }


def lines_from_engine(raw):
    """Python side of E3: an OCR engine's blocks of entries as ``RAW_TYPE`` values, order kept."""
    return raw if raw is None else [[_shape(entry) for entry in block or ()] for block in raw]


def flat_lines(raw: Column) -> Column:
    """Nested blocks -> ARRAY<line> in reading order.

    NULL blocks are dropped before ``flatten`` (which would return NULL),
    then lines lacking text or confidence are dropped.  NULL result -> [].
    """
    blocks = F.filter(raw, lambda b: b.isNotNull())
    lines = F.filter(F.flatten(blocks), lambda l: l.isNotNull() & l["text"].isNotNull() & l["confidence"].isNotNull())
    return F.coalesce(lines, F.array().cast(T.ArrayType(LINE_TYPE)))


def lines_text(lines: Column) -> Column:
    """A1 on an array: texts joined with one space."""
    return F.array_join(F.transform(lines, lambda l: l["text"]), LINE_SEPARATOR)


def lines_mean(lines: Column) -> Column:
    """A2 on an array: unweighted mean confidence, 0.0 when empty."""
    total = F.aggregate(lines, F.lit(0.0).cast("double"), lambda acc, l: acc + l["confidence"])
    return F.when(F.size(lines) > 0, total / F.size(lines)).otherwise(F.lit(0.0))


def summarize_raw(df: DataFrame, raw_col: str = "ocr_raw") -> DataFrame:
    """A3 row-local: add ``ocr_raw_text`` and ``ocr_confidence_mean``."""
    lines = flat_lines(F.col(raw_col))
    return df.withColumn("__lines", lines).withColumns(
        {"ocr_raw_text": lines_text(F.col("__lines")), "ocr_confidence_mean": lines_mean(F.col("__lines"))}
    ).drop("__lines")


def explode_lines(df: DataFrame, key_cols: list[str], raw_col: str = "ocr_raw") -> DataFrame:
    """E3 as rows: ``(*keys, line_no, text, confidence)``, order kept in line_no."""
    return df.select(
        *key_cols, F.posexplode(flat_lines(F.col(raw_col))).alias("line_no", "__line")
    ).select(*key_cols, "line_no", F.col("__line.text").alias("text"),
             F.col("__line.confidence").alias("confidence"))


def summarize_lines(lines: DataFrame, key: str, order: str, text: str = "text",
                    confidence: str = "confidence") -> DataFrame:
    """A1 + A2 over a lines table, one row per key that has lines."""
    return lines.groupBy(key).agg(
        F.expr(f"listagg(`{text}`, '{LINE_SEPARATOR}') WITHIN GROUP (ORDER BY `{order}`)").alias("ocr_raw_text"),
        F.avg(confidence).alias("ocr_confidence_mean"),
    )


def attach_ocr(images: DataFrame, summary: DataFrame, image_key: str, summary_key: str) -> DataFrame:
    """A3: left-join the per-key summary; images without lines get ("", 0.0)."""
    s = summary.withColumnRenamed(summary_key, "__ocr_key")
    out = images.join(s, images[image_key] == s["__ocr_key"], "left").drop("__ocr_key")
    return out.withColumns(
        {
            "ocr_raw_text": F.coalesce(F.col("ocr_raw_text"), F.lit("")),
            "ocr_confidence_mean": F.coalesce(F.col("ocr_confidence_mean"), F.lit(0.0)),
        }
    )
