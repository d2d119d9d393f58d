"""Bring-your-own row extractor (M3): OCR engines, PDF readers, image codecs.

``run_extractor`` runs a user function over Arrow batches with
``mapInArrow``.  The function comes from a *factory* called once per task at
the top of the batch iterator, so a heavy model loads once per Python worker
and is reused for every row of the partition (the producer keeps one model
per worker process too).  Pass-through columns travel as Arrow arrays without
conversion; only the input columns are turned into Python values.

Error policy per row:

* ``on_error="fail"`` - outputs NULL, ``error`` holds ``"Type: message"``;
  the row is routed to quarantine by the caller (OCR, inflate policy);
* ``on_error="empty"`` - outputs take ``empty`` and ``error`` stays NULL (the
  PDF policy: an unreadable document gives ``""``).

``elapsed_col`` records the wall time spent in the function per row, in ms.

Partitions: a file scan packs ``maxPartitionBytes`` per task, which bounds the
payloads per task; ``partitions`` (round robin, never a key) raises the
parallelism of a small input.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


#: Bytes of input whose results are held as Python values at once.
PART_BYTES = 1024 * 1024


def in_parts(batch: pa.RecordBatch, part_bytes: int | None = None) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``part_bytes``, of a row at least: parsed results take many times
    the bytes they were read from."""
    n = batch.num_rows
    step = max(1, n * (part_bytes or PART_BYTES) // max(1, batch.nbytes))
    for at in range(0, max(1, n), step):
        yield batch.slice(at, step)


def _normalize(result: Any, fields: list[str]) -> list[Any]:
    if len(fields) == 1 and not isinstance(result, dict | tuple | list):
        return [result]
    if isinstance(result, dict):
        return [result.get(f) for f in fields]
    if len(fields) == 1 and isinstance(result, list):
        return [result]
    return list(result)


def _to_arrow(results: list[list[Any]], arrow_types: list[pa.DataType], errors: list[str | None],
              on_error: str, empty_row: list[Any] | None) -> list[pa.Array]:
    """Column arrays for the outputs.  A value that does not fit its declared
    type is a per-row error too: the batch is converted at once, and only
    when that fails row by row, so one malformed result never fails a task."""
    try:
        return [pa.array(r, type=t) for r, t in zip(results, arrow_types)]
    except (pa.ArrowException, TypeError, ValueError, OverflowError):
        pass
    n = len(errors)
    for i in range(n):
        try:
            for r, t in zip(results, arrow_types):
                pa.array([r[i]], type=t)
        except (pa.ArrowException, TypeError, ValueError, OverflowError) as exc:
            fill = empty_row if (on_error == "empty" and empty_row) else [None] * len(results)
            for r, v in zip(results, fill):
                r[i] = v
            if on_error != "empty":
                errors[i] = f"{type(exc).__name__}: {exc}"
    return [pa.array(r, type=t) for r, t in zip(results, arrow_types)]


def run_extractor(
    df: DataFrame,
    factory: Callable[[], Callable[..., Any]],
    input_cols: Sequence[str],
    output_type: T.StructType,
    on_error: str = "fail",
    empty: Any = None,
    error_col: str = "error",
    elapsed_col: str | None = None,
    passthrough: Sequence[str] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Apply ``factory()(*row[input_cols])`` to every row of ``df``.

    Returns ``passthrough`` columns (default: all of ``df``) + the fields of
    ``output_type`` + ``error_col`` (+ ``elapsed_col``).  ``partitions``
    repartitions the input first (round robin), when given.
    """
    if on_error not in ("fail", "empty"):
        raise ValueError("on_error must be 'fail' or 'empty'")
    keep = list(df.columns if passthrough is None else passthrough)
    names = list(dict.fromkeys([*keep, *input_cols]))
    src = df.select(*names)
    if partitions:
        src = src.repartition(partitions)
    out_fields = [src.schema[c] for c in keep] + list(output_type.fields)
    out_fields.append(T.StructField(error_col, T.StringType()))
    if elapsed_col:
        out_fields.append(T.StructField(elapsed_col, T.LongType()))
    out_schema = T.StructType(out_fields)
    field_names = output_type.fieldNames()
    arrow_types = [to_arrow_type(f.dataType) for f in output_type.fields]
    empty_row = None if empty is None else _normalize(empty, field_names)
    inputs = list(input_cols)

    def run(batches):
        fn = factory()
        for batch in (part for whole in batches for part in in_parts(whole)):
            cols = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in inputs]
            results: list[list[Any]] = [[] for _ in field_names]
            errors: list[str | None] = []
            elapsed: list[int] = []
            for args in zip(*cols) if cols else ([()] * batch.num_rows):
                t0 = time.perf_counter()
                try:
                    vals, err = _normalize(fn(*args), field_names), None
                except Exception as exc:  # per-row isolation
                    if on_error == "empty":
                        vals, err = (empty_row or [None] * len(field_names)), None
                    else:
                        vals, err = [None] * len(field_names), f"{type(exc).__name__}: {exc}"
                elapsed.append(int((time.perf_counter() - t0) * 1000))
                for i, v in enumerate(vals):
                    results[i].append(v)
                errors.append(err)
            arrays = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            arrays += _to_arrow(results, arrow_types, errors, on_error, empty_row)
            arrays.append(pa.array(errors, type=pa.string()))
            if elapsed_col:
                arrays.append(pa.array(elapsed, type=pa.int64()))
            yield pa.RecordBatch.from_arrays(arrays, names=out_schema.fieldNames())

    return src.mapInArrow(run, out_schema)
