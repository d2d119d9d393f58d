"""Content-hash and key dedup.

Scale notes
-----------
* An empty hash never takes part in a match (P8).  Joining or windowing on
  the raw hash would send every empty-hash row (one "hot" group can hold a
  third of a batch) to a single reducer.  Instead each row gets a *dedup
  key*: its hash, or for an empty hash a per-row value that can never equal
  a hash (``"\0" || key``).  Empty-hash rows then spread evenly, never match
  and always come out first in their own window: one scan, one shuffle, no
  hot partition, and no second pass over the input.
* The anti join (J1) is an equi join on that key: the target's hash column
  is read alone (column pruning) with ``file_hash <> ''`` pushed into the
  scan, and de-duplicated first (map-side combine; the join reuses that
  partitioning), so a hash repeated in the target is never a hot key on the
  side AQE cannot split.  AQE turns it into a broadcast join only when the
  hash side proved small at runtime, and splits skewed partitions of the
  batch side.
* In-batch first-per-hash (D2) is ``row_number() = 1`` over the dedup key,
  planned with a partial ``WindowGroupLimit`` map-side: a hash repeated a
  million times leaves each map task as one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HASH = "file_hash"
KEY = "key"
_NEVER_A_HASH = "\u0000"


def has_hash(col: str = HASH) -> Column:
    """A row takes part in hash dedup only with a non-empty hash."""
    return F.coalesce(F.col(col) != F.lit(""), F.lit(False))


def dedup_key(df: DataFrame, hash_col: str = HASH, key: str | None = KEY) -> Column:
    """The hash, or a unique never-matching value for an empty hash."""
    if key is not None and key in df.columns:
        row_id = F.col(key).cast("string")
    else:  # no key column: a digest of the whole row spreads the rows
        row_id = F.xxhash64(*[F.col(c) for c in df.columns]).cast("string")
    return F.when(has_hash(hash_col), F.col(hash_col)).otherwise(F.concat(F.lit(_NEVER_A_HASH), row_id))


def _target_hashes(target: DataFrame, target_col: str) -> DataFrame:
    return target.select(F.col(target_col).alias("__seen_hash")).where(F.col("__seen_hash") != F.lit(""))


def _captured_hashes(batch: DataFrame, target: DataFrame, hash_col: str, target_col: str, bounded: bool) -> DataFrame:
    """Distinct target hashes as ``__seen_hash``.

    ``bounded`` says that the batch's row count is capped by its source (a
    stream's ``maxFilesPerTrigger``): its hashes are broadcast to filter the
    target scan map-side, and the few hits are what is left to join.  Otherwise
    the distinct target hashes are joined as they are (AQE picks the join)."""
    seen = _target_hashes(target, target_col)
    if bounded:
        probes = batch.select(F.col(hash_col).alias("__b")).where(has_hash("__b")).distinct()
        seen = seen.join(F.broadcast(probes), seen["__seen_hash"] == F.col("__b"), "left_semi")
    # distinct combines map-side: a hash repeated in the target leaves each task once
    return seen.distinct()


def drop_captured(batch: DataFrame, target: DataFrame | None, hash_col: str = HASH,
                  target_col: str = HASH, key: str | None = KEY, bounded: bool = False) -> DataFrame:
    """Rows whose hash is not in ``target`` yet; empty hashes always pass.

    ``target=None`` (no table yet) keeps every row, as on a first run.
    """
    if target is None:
        return batch
    seen = _captured_hashes(batch, target, hash_col, target_col, bounded)
    return batch.join(seen, dedup_key(batch, hash_col, key) == seen["__seen_hash"], "left_anti")


def mark_captured(batch: DataFrame, target: DataFrame | None, hash_col: str = HASH, target_col: str = HASH,
                  key: str | None = KEY, bounded: bool = False, flag: str = "captured") -> DataFrame:
    """J1 and J2 in one pass: every row, with whether its hash is already in ``target``."""
    if target is None:
        return batch.withColumn(flag, F.lit(False))
    seen = _captured_hashes(batch, target, hash_col, target_col, bounded)
    joined = batch.join(seen, dedup_key(batch, hash_col, key) == seen["__seen_hash"], "left")
    return joined.withColumn(flag, F.col("__seen_hash").isNotNull()).drop("__seen_hash")


def already_captured(batch: DataFrame, target: DataFrame | None, hash_col: str = HASH,
                     target_col: str = HASH) -> DataFrame:
    """The rows J1 drops (non-empty hash already in ``target``)."""
    if target is None:
        return batch.limit(0)
    keyed = batch.where(has_hash(hash_col))
    seen = _target_hashes(target, target_col).distinct()
    return keyed.join(seen, keyed[hash_col] == seen["__seen_hash"], "left_semi")


def first_per_hash(batch: DataFrame, order: Sequence[str] = ("last_modified", "key"),
                   hash_col: str = HASH, key: str | None = KEY) -> DataFrame:
    """Keep the first row per non-empty hash by ``order``; keep all
    empty-hash rows.  Deterministic where concurrent writers would race.

    ``row_number() = 1`` lets Catalyst plan a partial ``WindowGroupLimit``
    before the shuffle (one row per hash leaves each map task, so a hot hash
    is cut down map-side) and prune every column the caller does not use.
    """
    w = Window.partitionBy(dedup_key(batch, hash_col, key)).orderBy(*[F.col(c).asc() for c in order])
    return batch.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")


def distinct_keys(batch: DataFrame, keys: Sequence[str], seen: DataFrame | None = None) -> DataFrame:
    """One row per key tuple, minus keys already seen.

    ``dropDuplicates`` aggregates map-side; the anti join against ``seen``
    shuffles on the same keys, so the two share one partitioning.
    """
    out = batch.dropDuplicates(list(keys))
    if seen is not None:
        # distinct first: a hot key on the right of an anti join cannot be
        # split by AQE, but after a map-side combine it is one row per task
        out = out.join(seen.select(*keys).distinct(), on=list(keys), how="left_anti")
    return out


def hash_exists(target: DataFrame, file_hash: str, hash_col: str = HASH) -> bool:
    """Point lookup with the predicate pushed to the scan, one column read."""
    return not target.select(hash_col).where(F.col(hash_col) == F.lit(file_hash)).limit(1).isEmpty()
