"""Quantised vectors and exact integer inner products, for the exact searches.

A component x becomes floor(256 * x), kept as a whole number in a double.  Products
are exact: by matrix product where no sum can reach 2^53, else by integers of any size;
a score that does not fit a long is an error, never a wrong number.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 256


def usable(vector_col: str) -> Column:
    """True for a vector that is there and has only finite components (an empty one has)."""
    inf = float("inf")
    fine = F.forall(F.col(vector_col), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != inf))
    return F.coalesce(fine, F.lit(False))


def whole(vector_col: str) -> Column:
    """array<double> of floor(256 * x); beyond 2^62 a double is whole as it is."""
    def one(x):
        y = x.cast("double") * SCALE
        return F.when(F.abs(y) < float(1 << 62), F.floor(y).cast("double")).otherwise(y)

    return F.transform(F.col(vector_col), one)


def numbered(vectors: DataFrame, vector_col: str, **columns: Column) -> DataFrame:
    """(rid, *columns, q) of the usable rows; rid tells repeated rows apart once this is stored."""
    named = [c.alias(n) for n, c in columns.items()]
    return vectors.where(usable(vector_col)).select(F.monotonically_increasing_id().alias("rid"), *named, whole(vector_col).alias("q"))


def matrix(rows, dims: int | None = None) -> np.ndarray:
    """The vectors as rows of doubles; shorter ones are padded with zeros."""
    rows = list(rows)
    if dims is None:
        dims = max(map(len, rows), default=0)
    if rows and all(len(r) == dims for r in rows):
        return np.array(rows, np.float64).reshape(len(rows), dims)
    out = np.zeros((len(rows), dims))
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def norms(m: np.ndarray) -> np.ndarray:
    """Lengths of the rows; scaled, so that large components do not overflow."""
    if not m.size:
        return np.zeros(len(m))
    top = np.abs(m).max(axis=1)
    safe = np.where(top > 0, top, 1.0)
    return top * np.sqrt(((m / safe[:, None]) ** 2).sum(axis=1))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products (len(a), len(b)) as longs."""
    dims = min(a.shape[1], b.shape[1])
    a, b = a[:, :dims], b[:, :dims]
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if float(np.abs(a).max()) * float(np.abs(b).max()) * dims < 2.0**53:
        return (a @ b.T).astype(np.int64)
    as_ints = lambda m: np.array([[int(x) for x in r] for r in m], object)
    exact = as_ints(a) @ as_ints(b).T
    if max(abs(int(x)) for x in exact.ravel()) >= 1 << 63:
        raise OverflowError("an inner product does not fit a long")
    return exact.astype(np.int64)
