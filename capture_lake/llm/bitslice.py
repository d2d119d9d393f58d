"""Exact top-k inner products over a bit-sliced index.

Components become integers (floor of 256 x).  The index holds blocks of rows;
in a block each dimension is stored as bit slices: one bitmap over the rows per
bit of (value - least value of the block).  A query's score slices come from
bitmap arithmetic alone: every set bit of a query component adds that
dimension's slices (negated ones for a negative component) at its weight, by
carry-save full adders.  The best rows are then picked from the most
significant score slice downward; rows that tie on every slice are the boundary,
resolved exactly by the smaller vec_id.

Each (block of rows, group of queries) pair is one unit of work, so the stated
queries meet all rows in blocks; a block's best rows are merged by a window.

Edge cases: vectors that are null or hold null or non-finite components take no
part; an empty vector takes part with score 0, a shorter one counts as padded with
zeros; rows that repeat a vec_id stay apart, each is a candidate for all rows but
itself; a row without vec_id is no query, as a candidate it comes after equal
scores with one, its id is null; components are exact whatever their size (slices
are as many as the values need), a score that does not fit a long raises an error;
columns beyond the two are not read; empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from capture_lake.llm.common import stored, table
from capture_lake.llm.vectors import matrix, numbered

#: Rows per block of the index and queries per group, on average: a pair moves some 3 MB and keeps a
#: core busy for seconds.
BLOCK_ROWS = 32_768
GROUP_QUERIES = 1_024
#: Most shuffle partitions for (block, group) pairs.
MAX_TASKS = 20_000


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(rid, vec_id, void, q): the rows with usable components; `void` marks those without an id."""
    vec_id = F.coalesce(F.col(id_col).cast("long"), F.lit(0).cast("long"))
    return numbered(vectors, vector_col, vec_id=vec_id, void=F.col(id_col).isNull())


def build_block(rows: pd.DataFrame) -> pd.DataFrame:
    """One index row: ids in ascending order (none last), per dimension its least value and bit slices."""
    rows = rows.sort_values(["void", "vec_id", "rid"])
    n = len(rows)
    whole = matrix(rows["q"])
    dims = whole.shape[1]
    if whole.size and np.abs(whole).max() >= 2.0**61:
        values = np.array([[int(x) for x in r] for r in whole], object).reshape(n, dims)
    else:
        values = whole.astype(np.int64)
    words = -(-n // 64)
    low = [int(x) for x in values.min(axis=0)] if dims else []
    width, slices = [], []
    for d in range(dims):
        above = values[:, d] - low[d]
        bits = int(above.max()).bit_length()
        width.append(bits)
        for j in range(bits):
            packed = np.zeros(words * 8, np.uint8)
            part = np.packbits(((above >> j) & 1).astype(np.uint8), bitorder="little")
            packed[: len(part)] = part
            slices.append(packed)
    blob = np.concatenate(slices).tobytes() if slices else b""
    return pd.DataFrame({
        "block": [int(rows["block"].iloc[0])], "rids": [rows["rid"].to_numpy("<i8").tobytes()], "ids": [rows["vec_id"].to_numpy("<i8").tobytes()],
        "void": [rows["void"].to_numpy(np.uint8).tobytes()], "low": [[str(x) for x in low]], "width": [width], "slices": [blob],
    })


class Block:
    """A block of the index ready for bitmap arithmetic."""

    def __init__(self, rids: bytes, ids: bytes, void: bytes, low, width, slices: bytes):
        self.rids = np.frombuffer(rids, "<i8")
        self.ids = np.frombuffer(ids, "<i8")
        self.void = np.frombuffer(void, np.uint8)
        self.low = [int(x) for x in low]
        self.width = [int(x) for x in width]
        words = -(-len(self.ids) // 64)
        bits = np.frombuffer(slices, "<u8").reshape(-1, words) if words else np.zeros((0, 0), np.uint64)
        self.plain = list(bits)
        self.negated = list(~bits)
        self.first = np.concatenate(([0], np.cumsum(self.width))).astype(int).tolist()
        every = np.zeros(words * 64, np.uint8)
        every[: len(self.ids)] = 1
        self.every = np.packbits(every, bitorder="little").view("<u8")

    def scores(self, query) -> tuple[list[np.ndarray], int]:
        """Score slices from the least significant up, and what to add to their number."""
        columns: list[list[np.ndarray]] = []
        base = 0
        for d, c in enumerate(int(x) for x in query[: len(self.low)]):
            if not c:
                continue
            base += c * self.low[d]
            if c < 0:
                base += c * ((1 << self.width[d]) - 1)
            source = self.plain if c > 0 else self.negated
            size = abs(c)
            for i in range(size.bit_length()):
                if size >> i & 1:
                    for j in range(self.width[d]):
                        while len(columns) <= i + j:
                            columns.append([])
                        columns[i + j].append(source[self.first[d] + j])
        out = []
        at = 0
        while at < len(columns):
            here = columns[at]
            if len(here) > 1 and at + 1 == len(columns):
                columns.append([])
            while len(here) > 2:  # full adder
                a, b, c = here.pop(), here.pop(), here.pop()
                ab = a ^ b
                carry = a & b
                carry |= ab & c
                columns[at + 1].append(carry)
                ab ^= c
                here.insert(0, ab)
            if len(here) == 2:  # half adder
                a, b = here
                columns[at + 1].append(a & b)
                here = [a ^ b]
            out.append(here[0] if here else np.zeros_like(self.every))
            at += 1
        return out, base

    def top(self, query, own: int, k: int) -> list[tuple[int, int, bool, int]]:
        """(rid, id, void, score) of the k best rows but the query's own, ties to smaller ids."""
        slices, base = self.scores(query)
        open_ = self.every.copy()
        for at in np.nonzero(self.rids == own)[0].tolist():
            open_[at // 64] &= ~np.uint64(1 << (at % 64))
        chosen = np.zeros_like(open_)
        need = k
        for s in reversed(slices):
            ones = open_ & s
            n = int(np.bitwise_count(ones).sum())
            if n > need:
                open_ = ones
            else:
                chosen |= ones
                need -= n
                open_ &= ~s
                if not need:
                    break
        rows = _positions(chosen).tolist()
        if need:
            rows += _positions(open_)[:need].tolist()  # equal on every slice: ids ascend in a block
        out = []
        for r in rows:
            score = base + sum((int(s[r // 64]) >> (r % 64) & 1) << w for w, s in enumerate(slices))
            if abs(score) >= 1 << 63:
                raise OverflowError("an inner product does not fit a long")
            out.append((int(self.rids[r]), int(self.ids[r]), bool(self.void[r]), score))
        return out


def _positions(bitmap: np.ndarray) -> np.ndarray:
    return np.nonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))[0]


def build_index(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, int]:
    """The stored index, and the number of blocks; rows are dealt by a hash of their number."""
    blocks = max(1, -(-rows.count() // block_rows))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("rid"), F.lit(blocks)))
    index = dealt.groupBy("block").applyInPandas(build_block, "block long, rids binary, ids binary, void binary, low array<string>, width array<int>, slices binary")
    return stored(index), blocks


def top_k(rows: DataFrame, queries: DataFrame, k: int = 5, block_rows: int = BLOCK_ROWS, group_queries: int = GROUP_QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score) for stored `rows`, and `queries` among them, of (rid, vec_id, void, q)."""
    index, blocks = build_index(rows, block_rows)
    groups = max(1, -(-queries.count() // group_queries))
    asked = queries.withColumn("grp", F.pmod(F.xxhash64("rid", F.lit("query")), F.lit(groups)))
    asked = asked.groupBy("grp").agg(F.collect_list(F.struct("rid", "vec_id", "q")).alias("asked"))
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<bigint>")))
    index = index.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)).cast("array<bigint>")))
    tasks = min(blocks * groups, MAX_TASKS)
    pairs = index.repartition(tasks, "block", "grp").join(asked.repartition(tasks, "block", "grp"), ["block", "grp"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                block = Block(row.rids, row.ids, row.void, row.low, row.width, row.slices)
                found = [(q["rid"], q["vec_id"], *best) for q in row.asked for best in block.top(q["q"], q["rid"], k)]
                yield pd.DataFrame(found, columns=["query", "query_id", "rid", "id", "void", "score"])

    per_block = pairs.mapInPandas(run, "query long, query_id long, rid long, id long, void boolean, score long")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "void", "id", "rid")
    ranked = per_block.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.when(~F.col("void"), F.col("id")).alias("vec_id"), "score")


def op3_bitsliced_topk(spark, sf_dir: str) -> DataFrame:
    rows = stored(quantised(table(spark, sf_dir, "embeddings")))
    return top_k(rows, rows.where("not void and vec_id % 50 = 0"))


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(embedding) = len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 50 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
