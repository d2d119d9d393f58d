"""Typed columns from a free-form ``map<string,string>`` of object metadata.

P1 string with default, P2 strict int/float parse, P3 dimension fallback,
P10 log-label hash fallback, P12 nullable property lookup.  Everything is a
built-in expression, so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Metadata keys written by the capture producer, with the
# defaults that apply when a key is missing.
KEY_CONTENT_HASH = "content-hash"
KEY_SOURCE_ZIP = "source-zip"
KEY_ORIGINAL_PATH = "original-path"
KEY_IMAGE_WIDTH = "image-width"
KEY_IMAGE_HEIGHT = "image-height"
KEY_COMPRESSION_RATIO = "compression-ratio"
KEY_PROCESSING_DURATION_MS = "processing-duration-ms"
KEY_PDF_PRODUCER = "pdf-producer"
KEY_PDF_CREATOR = "pdf-creator"
KEY_WATCHER_VERSION = "watcher-version"
KEY_SOURCE_INTAKE_KEY = "source-intake-key"

STRING_DEFAULTS = {
    "file_hash": (KEY_CONTENT_HASH, ""),
    "original_path": (KEY_ORIGINAL_PATH, ""),
    "source_zip": (KEY_SOURCE_ZIP, ""),
    "pdf_producer": (KEY_PDF_PRODUCER, "unknown"),
    "pdf_creator": (KEY_PDF_CREATOR, "unknown"),
    "watcher_version": (KEY_WATCHER_VERSION, "unknown"),
}
COMPRESSION_RATIO_DEFAULT = "0.0"

# Number grammars of the producer's language: optional ASCII blanks
# (space, \t \n \v \f \r; not the \x1c-\x1f separators) and sign, digits
# with single underscores between them; floats add a fraction, an exponent
# and the inf/nan words.  Spark's
# cast alone differs on "1_000" (rejects), "1d" (accepts) and "-nan"
# (rejects), so values are checked first, then cast.
_WS = r"[\t\n\x0B\f\r ]"
_DIGITS = r"[0-9](?:_?[0-9])*"
INT_PATTERN = rf"^{_WS}*[+-]?{_DIGITS}{_WS}*$"
FLOAT_PATTERN = rf"^{_WS}*[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?{_WS}*$"
NAN_PATTERN = rf"^{_WS}*[+-]?(?i:nan){_WS}*$"
POS_INF_PATTERN = rf"^{_WS}*\+?(?i:inf|infinity){_WS}*$"
NEG_INF_PATTERN = rf"^{_WS}*-(?i:inf|infinity){_WS}*$"


def _as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def meta_get(metadata: Column | str, key: str) -> Column:
    """Value of ``key``, NULL when the key is missing."""
    return F.try_element_at(_as_col(metadata), F.lit(key))


def meta_string(metadata: Column | str, key: str, default: str) -> Column:
    """Value of ``key``, ``default`` only when the key is missing.

    A present empty string stays empty.
    """
    return F.coalesce(meta_get(metadata, key), F.lit(default))


def parse_int(s: Column) -> Column:
    """Strict int parse: NULL for text the producer's ``int()`` would reject,
    and for values outside INT range (P2)."""
    cleaned = F.regexp_replace(F.trim(s), "_", "")
    return F.when(s.rlike(INT_PATTERN), cleaned.try_cast("int"))


def parse_double(s: Column) -> Column:
    """Strict float parse (P2); NULL when the text is not a float literal."""
    cleaned = F.regexp_replace(F.trim(s), "_", "")
    return (F.when(s.rlike(FLOAT_PATTERN), cleaned.try_cast("double"))
            .when(s.rlike(NAN_PATTERN), F.lit(float("nan")))
            .when(s.rlike(POS_INF_PATTERN), F.lit(float("inf")))
            .when(s.rlike(NEG_INF_PATTERN), F.lit(float("-inf"))))


def meta_int(metadata: Column | str, key: str, fallback: Column | None = None) -> Column:
    """INT from ``key``; when missing, from ``fallback`` (P3: metadata wins)."""
    raw = meta_get(metadata, key)
    if fallback is not None:
        raw = F.coalesce(raw, fallback.cast("string"))
    return parse_int(raw)


def meta_double(metadata: Column | str, key: str, default: str) -> Column:
    return parse_double(meta_string(metadata, key, default))


def log_label(metadata: Column | str, key_col: Column | str) -> Column:
    """Hash used in logs and quarantine labels: the hash, else the first 12
    characters of the object key (P10).  Records keep ``""`` instead."""
    return F.coalesce(meta_get(metadata, KEY_CONTENT_HASH), F.substring(_as_col(key_col), 1, 12))


def metadata_columns(metadata: Column | str = "metadata", width: Column | None = None,
                     height: Column | None = None) -> dict[str, Column]:
    """All metadata-derived record columns with their defaults and parses.

    ``width``/``height`` are the decoded image dimensions used when the
    metadata has none.  Parse failures come out NULL and are caught by the
    quality rules (a NULL violates every rule), so one bad row never aborts
    the batch.
    """
    cols = {name: meta_string(metadata, key, default) for name, (key, default) in STRING_DEFAULTS.items()}
    cols["image_width"] = meta_int(metadata, KEY_IMAGE_WIDTH, width)
    cols["image_height"] = meta_int(metadata, KEY_IMAGE_HEIGHT, height)
    cols["compression_ratio"] = meta_double(metadata, KEY_COMPRESSION_RATIO, COMPRESSION_RATIO_DEFAULT)
    return cols


def parse_errors(metadata: Column | str = "metadata", width: Column | None = None,
                 height: Column | None = None) -> Column:
    """ARRAY of messages for metadata values that fail the strict parse."""
    checks = []
    for name, key, parsed, fallback in (
        ("image_width", KEY_IMAGE_WIDTH, parse_int, width),
        ("image_height", KEY_IMAGE_HEIGHT, parse_int, height),
        ("compression_ratio", KEY_COMPRESSION_RATIO, parse_double, None),
    ):
        raw = meta_get(metadata, key)
        if fallback is not None:
            raw = F.coalesce(raw, fallback.cast("string"))
        elif name == "compression_ratio":
            raw = F.coalesce(raw, F.lit(COMPRESSION_RATIO_DEFAULT))
        checks.append(F.when(raw.isNotNull() & parsed(raw).isNull(),
                             F.concat(F.lit(f"{name}: cannot parse "), F.to_json(F.array(raw)))))
    return F.filter(F.array(*checks), lambda x: x.isNotNull())
