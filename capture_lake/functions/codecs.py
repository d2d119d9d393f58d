"""Payload codecs as Arrow-batched pandas UDFs (M1 inflate, E1 archive members).

The codecs are existing libraries (``zstandard``, ``zipfile``); Spark hands
them one Arrow batch at a time inside the executors.  Errors are values, not
exceptions: each row gets ``error`` set instead of failing the task.
"""

from __future__ import annotations

import io
import time
import zipfile

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

INFLATE_TYPE = T.StructType(
    [T.StructField("payload", T.BinaryType()), T.StructField("error", T.StringType()), T.StructField("ms", T.DoubleType())]
)
MEMBER_TYPE = T.ArrayType(
    T.StructType(
        [
            T.StructField("member_index", T.IntegerType()),
            T.StructField("name", T.StringType()),
            T.StructField("size", T.LongType()),
        ]
    )
)
MEMBERS_TYPE = T.StructType(
    [T.StructField("members", MEMBER_TYPE), T.StructField("error", T.StringType())]
)
FIRST_MEMBER_TYPE = T.StructType(
    [T.StructField("name", T.StringType()), T.StructField("content", T.BinaryType()),
     T.StructField("error", T.StringType())]
)


# Fixed value: the error of an empty payload.
EMPTY_PAYLOAD_ERROR = "ValueError: compressed_bytes must not be empty"


def _err(exc: BaseException) -> str:
    return f"{type(exc).__name__}: {exc}"


def inflate_one(blob: bytes | None) -> tuple[bytes | None, str | None]:
    """Inflate one zstd frame with the streaming reader (no content size needed)."""
    import zstandard

    if blob is None:
        return None, None
    if len(blob) == 0:
        return None, EMPTY_PAYLOAD_ERROR
    try:
        with zstandard.ZstdDecompressor().stream_reader(io.BytesIO(blob)) as reader:
            return reader.read(), None
    except Exception as exc:  # corrupt frame: a per-row error
        return None, _err(exc)


@F.pandas_udf(INFLATE_TYPE)
def zstd_inflate(blobs: pd.Series) -> pd.DataFrame:
    """Inflate a zstd BINARY column to STRUCT(payload, error, ms) (M1); ``ms`` is the time it took."""
    payload, error, ms = [], [], []
    for b in blobs:
        t0 = time.perf_counter()
        data, err = inflate_one(b)
        payload.append(data)
        error.append(err)
        ms.append((time.perf_counter() - t0) * 1000.0)
    return pd.DataFrame({"payload": payload, "error": error, "ms": ms})


@F.pandas_udf(T.BinaryType())
def zstd_compress(blobs: pd.Series) -> pd.Series:
    """Compress a BINARY column with zstd level 1 (writes stand-in payloads)."""
    import zstandard

    cctx = zstandard.ZstdCompressor(level=1)
    return pd.Series([None if b is None else cctx.compress(bytes(b)) for b in blobs])


def list_members_one(blob: bytes | None):
    if blob is None:
        return None, None
    try:
        with zipfile.ZipFile(io.BytesIO(blob)) as zf:
            infos = zf.infolist()
            return [
                {"member_index": i, "name": info.filename, "size": int(info.file_size)}
                for i, info in enumerate(infos)
            ], None
    except Exception as exc:
        return None, _err(exc)


@F.pandas_udf(MEMBERS_TYPE)
def zip_members(blobs: pd.Series) -> pd.DataFrame:
    """Member names of a ZIP in archive order, without reading contents."""
    out = [list_members_one(b) for b in blobs]
    return pd.DataFrame({"members": [o[0] for o in out], "error": [o[1] for o in out]})


def first_member_one(blob: bytes | None, suffix: str):
    """First member (archive order) whose lower-cased name ends with ``suffix``."""
    if blob is None:
        return None, None, None
    try:
        with zipfile.ZipFile(io.BytesIO(blob)) as zf:
            for info in zf.infolist():
                if info.filename.lower().endswith(suffix):
                    return info.filename, zf.read(info), None
            return None, None, None
    except Exception as exc:
        return None, None, _err(exc)


def zip_first_member(suffix: str):
    """Pandas UDF: STRUCT(name, content, error) of the first member whose name
    ends with ``suffix`` (case-insensitive); one pass over each archive, so
    its bytes cross to Python once."""
    suffix = suffix.lower()

    @F.pandas_udf(FIRST_MEMBER_TYPE)
    def first_member(blobs: pd.Series) -> pd.DataFrame:
        out = [first_member_one(b, suffix) for b in blobs]
        return pd.DataFrame({"name": [o[0] for o in out], "content": [o[1] for o in out],
                             "error": [o[2] for o in out]})

    return first_member


@F.pandas_udf(T.BinaryType())
def zip_pack(names: pd.Series, contents: pd.Series) -> pd.Series:
    """Pack ARRAY<name> with ARRAY<content> into one ZIP per row (stand-in archives)."""
    out = []
    for ns, cs in zip(names, contents):
        if ns is None:
            out.append(None)
            continue
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w", compression=zipfile.ZIP_DEFLATED, compresslevel=1) as zf:
            for n, c in zip(ns, cs):
                zf.writestr(n, b"" if c is None else bytes(c))
        out.append(buf.getvalue())
    return pd.Series(out)
