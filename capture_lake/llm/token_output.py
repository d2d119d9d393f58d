"""Token-id matrices by best-fit-decreasing packing.

Texts become ids of a public byte-level vocabulary plus a closing id.  Documents
longer than a row are split without loss into full pieces and a rest.  Pieces are
dealt evenly into groups of bounded size; a group is packed best-fit-decreasing,
the fullest row that still has room being found in a segment tree over free
capacities.  Every output row is one row of the matrices: ids and position ids
(which restart with each segment) in fixed width, the cumulative segment
lengths, where positions restart, and which piece of which document each segment
is.  `documents_of` reads the texts' ids back.

Edge cases: a null or empty text is the closing id alone; repeated rows are
packed as often as they occur; a null doc_id stays null in its segment; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capture_lake.llm.common import bounded_batches, clean_text, stored, table

CAPACITY = 2048
#: Characters of text whose pieces one task packs, on average.
GROUP_CHARS = 6_000_000
#: Fills up the end of a row; cumulative lengths tell where the tokens end.
PAD_ID = 0


def byte_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


_encoders: dict = {}


def encoder(path: str):
    """The worker's own encoder for a .tiktoken file; the id after its last rank closes a text."""
    if path not in _encoders:
        import base64

        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encoders[path] = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), max(ranks.values()) + 1
    return _encoders[path]


class FreeTree:
    """How many rows have each free capacity; finds the least capacity that is enough."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)

    def add(self, free: int, change: int) -> None:
        at = self.size + free
        while at:
            self.count[at] += change
            at >>= 1

    def least(self, need: int) -> int | None:
        """The least free capacity of at least `need` that some row has."""
        at = self.size + need
        if self.count[at]:
            return need
        while at > 1:  # up to the first right neighbour that is not empty, then down its left side
            if not at & 1 and self.count[at + 1]:
                at += 1
                while at < self.size:
                    at = 2 * at if self.count[2 * at] else 2 * at + 1
                return at - self.size
            at >>= 1
        return None


def best_fit_decreasing(lengths, capacity: int) -> list[list[int]]:
    """Item numbers of each row, longest items first."""
    tree = FreeTree(capacity)
    with_free: dict[int, list[int]] = {}
    rows: list[list[int]] = []
    free: list[int] = []
    for i in sorted(range(len(lengths)), key=lambda x: (-lengths[x], x)):
        n = int(lengths[i])
        room = tree.least(n)
        if room is None:
            row = len(rows)
            rows.append([])
            free.append(capacity)
        else:
            row = with_free[room].pop()
            tree.add(room, -1)
        rows[row].append(i)
        free[row] -= n
        if free[row]:
            with_free.setdefault(free[row], []).append(row)
            tree.add(free[row], 1)
    return rows


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, ids): ids as little-endian unsigned 16-bit numbers."""
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("array<binary>")
    def cut(text: pd.Series) -> pd.Series:
        enc, end = encoder(path)
        if end >= 1 << 16:
            raise ValueError("ids need more than 16 bits")
        out = []
        for t in text:
            ids = np.append(np.asarray(enc.encode_ordinary(t), "<u2"), np.array([end], "<u2")).tobytes()
            out.append([ids[at : at + 2 * capacity] for at in range(0, len(ids), 2 * capacity)])
        return pd.Series(out)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.posexplode(cut(clean_text())).alias("piece", "ids"))
    return rows.select("doc_id", "piece", (F.col("piece").cast("long") * capacity).alias("start"), "ids")


MATRIX_ROW = (
    "row_id long, n_tokens int, ids binary, positions binary, cu_seqlens array<int>, position_resets array<int>, "
    "doc_ids array<string>, pieces array<int>, starts array<long>"
)


def pack_group(rows: pd.DataFrame, capacity: int, gid: int) -> pd.DataFrame:
    """The matrix rows of one group, the same whatever order its pieces arrive in."""
    rows = rows.sort_values(["doc_id", "piece", "ids"], kind="stable", na_position="last").reset_index(drop=True)
    ids = rows["ids"].tolist()
    lengths = [len(x) // 2 for x in ids]
    counting = np.arange(capacity, dtype="<u2")
    out = []
    doc_ids, pieces, starts = rows["doc_id"].tolist(), rows["piece"].tolist(), rows["start"].tolist()
    for k, items in enumerate(best_fit_decreasing(lengths, capacity)):
        ends = np.cumsum([lengths[i] for i in items]).tolist()
        fill = capacity - ends[-1]
        out.append((
            (gid << 32) + k, ends[-1],
            b"".join(ids[i] for i in items) + int(PAD_ID).to_bytes(2, "little") * fill,
            b"".join(counting[: lengths[i]].tobytes() for i in items) + bytes(2 * fill),
            [0, *ends], [0, *ends[:-1]],
            [None if pd.isna(doc_ids[i]) else doc_ids[i] for i in items], [int(pieces[i]) for i in items], [int(starts[i]) for i in items],
        ))
    return pd.DataFrame(out, columns=[c.split()[0] for c in MATRIX_ROW.split(", ")])


def token_matrices(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, group_chars: int = GROUP_CHARS) -> DataFrame:
    """One row per matrix row (see the module's text for the columns)."""
    chars = docs.agg(F.sum(F.length(clean_text()) + 1)).first()[0] or 0
    groups = max(1, -(-chars // group_chars))
    pieces = token_pieces(docs, path or byte_bpe_path(), capacity)
    # dealt by the number of the stored row: rows that repeat exactly spread like any others, and a task
    # that runs again deals alike
    pieces = stored(pieces.withColumn("row", F.monotonically_increasing_id()))
    dealt = pieces.withColumn("gid", F.pmod(F.xxhash64("row"), F.lit(groups))).drop("row").withColumn("doc_id", F.col("doc_id").cast("string"))

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pack_group(rows, capacity, int(key[0]))

    packed = dealt.groupBy("gid").applyInPandas(run, MATRIX_ROW)
    return packed.withColumn("doc_ids", F.col("doc_ids").cast("array<long>"))


def write_matrices(packed: DataFrame, path: str) -> None:
    """The matrix rows as Parquet: ids and positions are fixed-width little-endian 16-bit rows."""
    packed.write.parquet(path)


def documents_of(packed: DataFrame) -> DataFrame:
    """(doc_id, ids): the ids of every document, its pieces put together again.

    Documents need distinct ids for this."""
    rows = packed.select("ids", F.posexplode("doc_ids").alias("k", "doc_id"), "pieces", "cu_seqlens")
    one = rows.select(
        "doc_id", F.element_at("pieces", F.col("k") + 1).alias("piece"),
        F.expr("substring(ids, 2 * cu_seqlens[k] + 1, 2 * (cu_seqlens[k + 1] - cu_seqlens[k]))").alias("part"),
    )
    parts = one.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("piece", "part"))).alias("parts"))
    return parts.select("doc_id", F.expr("aggregate(parts, X'', (a, x) -> concat(a, x.part))").alias("ids"))


def op6_token_output(spark, sf_dir: str) -> DataFrame:
    return token_matrices(table(spark, sf_dir, "documents"))
