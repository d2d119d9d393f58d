"""Source archives and page text (E1 members, E2 first PDF, P9, E4 pages, A4).

Archives are opened once per row: ``first_pdf`` walks the names in archive
order and inflates only the first ``.pdf`` member; ``explode_members`` lists
names without inflating anything.  A per-file text extractor (M3) turns PDF
bytes into page texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from capture_lake.functions.codecs import zip_first_member, zip_members
from capture_lake.functions.text import PAGE_SEPARATOR, unicode_strip

# Fixed value: the member suffix that marks the PDF inside an archive.
PDF_SUFFIX = ".pdf"


def is_pdf_name(name: Column) -> Column:
    """Case-insensitive ``.pdf`` suffix."""
    return F.lower(name).endswith(PDF_SUFFIX)


def explode_members(archives: DataFrame, key_col: str, content_col: str = "content") -> DataFrame:
    """One row per member ``(key, member_index, name, size)``; unreadable
    archives give one row with ``error`` and NULL member fields."""
    listed = archives.select(key_col, zip_members(F.col(content_col)).alias("__m"))
    return listed.select(
        key_col,
        F.explode_outer("__m.members").alias("__member"),
        F.col("__m.error").alias("error"),
    ).select(key_col, "__member.member_index", "__member.name", "__member.size", "error")


def first_pdf(archives: DataFrame, content_col: str = "content") -> DataFrame:
    """E1 + E2 + P9 per archive row: adds ``pdf_name``, ``pdf_bytes``,
    ``archive_error``.

    Row-local (no shuffle, every archive stays one row) and one pass: the
    archive is opened once, its names are walked in archive order and the
    first ``.pdf`` (any case) is read, so the archive bytes cross to Python
    once.  ``explode_members`` + ``is_pdf_name`` give the same choice over
    member rows.
    """
    found = archives.withColumn("__f", zip_first_member(PDF_SUFFIX)(F.col(content_col)))
    return found.withColumns(
        {"pdf_name": F.col("__f.name"), "pdf_bytes": F.col("__f.content"), "archive_error": F.col("__f.error")}
    ).drop("__f")


def page_rows(df: DataFrame, key_cols: list[str], pages_col: str) -> DataFrame:
    """Pages as rows ``(*keys, page_no, text)``; NULL and "" pages skipped,
    whitespace-only pages kept."""
    return df.select(*key_cols, F.posexplode(pages_col).alias("page_no", "text")).where(
        F.col("text").isNotNull() & (F.col("text") != F.lit(""))
    )


def assemble_pages(pages: DataFrame, key: str, order: str = "page_no", text: str = "text") -> DataFrame:
    """A4 over a pages table: ``(key, pdf_raw_text)`` joined with the page
    separator in page order, then stripped."""
    sep = PAGE_SEPARATOR.replace("\n", "\\n")
    joined = F.expr(f"listagg(`{text}`, '{sep}') WITHIN GROUP (ORDER BY `{order}`)")
    return pages.groupBy(key).agg(unicode_strip(joined).alias("pdf_raw_text"))
