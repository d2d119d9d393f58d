"""Text helpers for assembled page and line text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Page separator of the assembled PDF text, and the line
# separator of the OCR text.
PAGE_SEPARATOR = "\n---\n"
LINE_SEPARATOR = " "

# The characters the producer's ``str.strip()`` removes: ASCII
# blanks and controls \t \n \x0b \f \r, the separators \x1c-\x1f and \x85,
# and the Unicode spaces U+00A0, U+1680, U+2000-U+200A, U+2028, U+2029,
# U+202F, U+205F, U+3000.  Spark's one-argument trim() removes spaces only.
WHITESPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)


def unicode_strip(c: Column) -> Column:
    """Remove leading and trailing whitespace in the Unicode sense.

    ``btrim`` with an explicit character set walks in from both ends only,
    unlike an anchored regex that scans the whole text.
    """
    return F.btrim(c, F.lit(WHITESPACE_CHARS))


def join_pages(pages: Column) -> Column:
    """Page texts (ARRAY<STRING> in page order) to one stripped text (A4).

    NULL and empty pages are skipped; whitespace-only pages are kept.  A NULL
    array gives ``""``.
    """
    kept = F.filter(pages, lambda p: p.isNotNull() & (p != F.lit("")))
    return F.coalesce(unicode_strip(F.array_join(kept, PAGE_SEPARATOR)), F.lit(""))
