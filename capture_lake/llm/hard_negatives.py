"""Hard negatives by anchor-clustered shared lists (after MAXIMUS).

Anchors are clustered by angle.  In a cluster no anchor is further than `spread` from
the centre c, so for an anchor a and a row x

    a.x <= |a| * |x| * cos(max(0, angle(x, c) - spread)) = |a| * bound(x)

One list per cluster holds every row by descending bound; all members of the cluster
share it.  It is cut once into levels, each about eight times as long as the one
before; a row knows its level in every cluster's list.  Members walk their list level
by level: the rows of a level meet the still open members of the cluster in tiles
(blocks of rows, groups of members), scores in a tile are exact.  A member is closed
when what it holds is certified: its fifth best score is above |a| times the largest
bound further down the list, or that bound is below the least score it may take.  The
last level holds the rest of the list, so every member ends certified.

The list is walked twice, first for each anchor's best rows of its own label, then, their
scores known, for the best rows of other labels inside each positive's range of scores.
The centres and the cuts of the levels are fitted on a bounded sample; they decide only
how much is walked, never a result.

Edge cases: rows with a null label, a null vector, or a null or non-finite component take
no part; an empty vector takes part with score 0, a shorter one counts as padded with
zeros; rows that repeat a vec_id, or a whole row, stay apart (each is its own row, ties by
their place in the table); a row without vec_id is no anchor, as a candidate it comes after
equal scores with one, its id is null; columns beyond the three are not read; scores that do
not fit a long raise an error; an empty table, or one without anchors, gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from capture_lake.llm.common import stored, table
from capture_lake.llm.vectors import matrix, norms, numbered, products

#: Bounds of the fitted index: clusters, anchors per cluster aimed at, sampled rows.
MAX_CLUSTERS = 64
CLUSTER_MEMBERS = 64
SAMPLE_ROWS = 4_096
#: Rows of the first level of a list, and how much longer each further level is.
FIRST_LEVEL = 4_096
GROWTH = 8
#: Rows per block, members per group, and members scored at once in a tile.
BLOCK_ROWS = 8_192
GROUP_MEMBERS = 2_048
SLAB = 256
#: Most shuffle partitions for tiles.
MAX_TASKS = 20_000
#: Added to every cosine of a bound, for rounding.
SLACK = 1e-6
LEAST, MOST = -(1 << 63), (1 << 63) - 1

FOUND = "rid long, ask long, cand long, id long, void boolean, score long"


def fit_centres(sample: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Centres of a spherical k-means over the sample's directions."""
    size = norms(sample)
    units = sample[size > 0] / size[size > 0, None]
    if not len(units):
        return np.zeros((1, sample.shape[1]))
    centres = units[np.linspace(0, len(units) - 1, min(k, len(units))).astype(int)]
    for _ in range(rounds):
        near = (units @ centres.T).argmax(axis=1)
        for c in range(len(centres)):
            mine = units[near == c]
            if len(mine):
                total = mine.sum(axis=0)
                length = np.linalg.norm(total)
                centres[c] = total / length if length > 0 else mine[0]
    return centres


def angles(m: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Angle of every row to every centre; a row without a direction has angle 0."""
    dims = centres.shape[1]
    wide = np.zeros((len(m), dims))
    wide[:, : min(dims, m.shape[1])] = m[:, :dims]
    size = norms(m)
    cos = np.where(size[:, None] > 0, wide @ centres.T / np.where(size > 0, size, 1.0)[:, None], 1.0)
    return np.arccos(np.clip(cos, -1.0, 1.0))


def bounds(m: np.ndarray, centres: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """What a member of length one can score at most, (rows, clusters)."""
    cos = np.cos(np.maximum(0.0, angles(m, centres) - spread[None, :]))
    return norms(m)[:, None] * np.minimum(1.0, cos + SLACK)


def cuts_of(sample: np.ndarray, centres: np.ndarray, spread: np.ndarray, n_rows: int) -> np.ndarray:
    """(levels - 1, clusters): the bound above which a row is in level 0, 1, ... of a list."""
    upper = -np.sort(-bounds(sample, centres, spread), axis=0)
    out, at = [], FIRST_LEVEL
    while at < n_rows and len(upper):
        out.append(upper[min(len(upper) - 1, int(at / n_rows * len(upper)))])
        at = at * (GROWTH + 1)
    return np.array(out).reshape(len(out), len(centres))


def levels_of(upper: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """The level of every row in every cluster's list."""
    out = np.zeros(upper.shape, np.int8)
    for cut in cuts:
        out += (upper < cut[None, :]).astype(np.int8)
    return out


BLOCK = "block long, rids binary, ids binary, void binary, labels binary, dims int, vectors binary, levels binary"


def build_blocks(rows: DataFrame, n_rows: int, centres: np.ndarray, spread: np.ndarray, cuts: np.ndarray, block_rows: int) -> DataFrame:
    """Stored blocks of rows by ascending id (those without one last), with the levels of their rows."""
    def build(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["void", "vec_id", "rid"])
        m = matrix(part["q"])
        return pd.DataFrame({
            "block": [int(part["block"].iloc[0])], "rids": [part["rid"].to_numpy("<i8").tobytes()],
            "ids": [part["vec_id"].to_numpy("<i8").tobytes()], "void": [part["void"].to_numpy(np.uint8).tobytes()],
            "labels": [part["label"].to_numpy("<i8").tobytes()], "dims": [m.shape[1]], "vectors": [m.astype("<f8").tobytes()],
            "levels": [levels_of(bounds(m, centres, spread), cuts).tobytes()],
        })

    n_blocks = max(1, -(-n_rows // block_rows))
    dealt = rows.select("rid", "vec_id", "void", "label", "q", F.pmod(F.xxhash64("rid"), F.lit(n_blocks)).alias("block"))
    return stored(dealt.groupBy("block").applyInPandas(build, BLOCK))


def best_of(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k best allowed scores of every row, ties to the left, best first in a row."""
    n = scores.shape[1]
    masked = np.where(allowed, scores, LEAST)
    if n > k:
        kth = np.partition(masked, n - k, axis=1)[:, n - k]
        allowed = allowed & (masked >= kth[:, None])
    r, c = np.nonzero(allowed)
    order = np.lexsort((c, ~scores[r, c], r))  # ~ turns the order of longs round
    r, c = r[order], c[order]
    place = np.arange(len(r)) - np.searchsorted(r, r, side="left")
    return r[place < k], c[place < k]


def best_rows(blocks: DataFrame, n_blocks: int, asks: DataFrame, cuts: np.ndarray, same_label: bool, k: int, group_members: int) -> DataFrame:
    """(rid, ask, cand, id, void, score, rank): the k best rows of every ask.

    `asks` (stored): rid, label, q, norm, cluster and `wanted`, an array of (ask, lo, hi): the scores
    that count, for rows of the same label but the member itself, or of another label."""
    spark = asks.sparkSession
    order = Window.partitionBy("rid", "ask").orderBy(F.desc("score"), "void", "id", "cand")
    best = spark.createDataFrame([], FOUND + ", rank int")
    for level in range(len(cuts) + 1):
        sizes = {r["cluster"]: -(-r["n"] // group_members) for r in asks.groupBy("cluster").agg(F.count("*").alias("n")).collect()}
        if not sizes:
            break
        found = _tiles(blocks, n_blocks, asks, sizes, level, len(cuts[0]) if len(cuts) else None, same_label, k)
        merged = found.unionByName(best.drop("rank")).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        best = stored(merged)
        if level == len(cuts):
            break
        held = best.groupBy("rid", "ask").agg(F.count("*").alias("n"), F.min("score").alias("kth"))
        below = F.col("norm") * F.element_at(F.array(*(F.lit(float(x)) for x in cuts[level])), F.col("cluster") + 1)
        each = asks.select("*", F.explode("wanted").alias("w")).select("*", F.col("w.ask").alias("ask")).join(held, ["rid", "ask"], "left")
        certified = F.coalesce((F.col("n") >= k) & (F.col("kth") > below), F.lit(False)) | (F.col("w.lo").cast("double") > below)
        still = each.where(~certified).groupBy("rid").agg(F.collect_list("w").alias("wanted"))
        asks = stored(asks.drop("wanted").join(still, "rid"))
    return best


def _tiles(blocks: DataFrame, n_blocks: int, asks: DataFrame, sizes: dict[int, int], level: int, clusters: int | None, same_label: bool, k: int) -> DataFrame:
    """Rows of one level of the lists against the open members of their clusters."""
    open_clusters = sorted(sizes)

    def select(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The block's rows that are in this level of an open cluster's list."""
        for batch in batches:
            for row in batch.itertuples(index=False):
                rids = np.frombuffer(row.rids, "<i8")
                levels = np.frombuffer(row.levels, np.int8).reshape(len(rids), -1)
                vectors = np.frombuffer(row.vectors, "<f8").reshape(len(rids), row.dims)
                for c in open_clusters:
                    take = np.nonzero(levels[:, c] == level)[0]
                    if len(take):
                        yield pd.DataFrame({
                            "cluster": [c], "block": [row.block], "rids": [rids[take].tobytes()], "ids": [np.frombuffer(row.ids, "<i8")[take].tobytes()],
                            "void": [np.frombuffer(row.void, np.uint8)[take].tobytes()], "labels": [np.frombuffer(row.labels, "<i8")[take].tobytes()],
                            "dims": [row.dims], "vectors": [vectors[take].tobytes()],
                        })

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        m = matrix(part["q"])
        wanted = [[(w["ask"], w["lo"], w["hi"]) for w in ws] for ws in part["wanted"]]
        flat = np.array([x for ws in wanted for x in ws], "<i8").reshape(-1, 3)
        return pd.DataFrame({
            "cluster": [int(part["cluster"].iloc[0])], "grp": [int(part["grp"].iloc[0])], "m_rids": [part["rid"].to_numpy("<i8").tobytes()],
            "m_labels": [part["label"].to_numpy("<i8").tobytes()], "m_dims": [m.shape[1]], "m_vectors": [m.astype("<f8").tobytes()],
            "counts": [np.array([len(ws) for ws in wanted], "<i4").tobytes()], "wanted": [flat.tobytes()],
        })

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                yield from tile(row, same_label, k)

    per_cluster = F.element_at(F.create_map(*(F.lit(x) for c, n in sizes.items() for x in (c, n))), F.col("cluster"))
    part = "cluster int, block long, rids binary, ids binary, void binary, labels binary, dims int, vectors binary"
    chunks = blocks.mapInPandas(select, part).withColumn("grp", F.explode(F.sequence(F.lit(0), per_cluster - 1).cast("array<bigint>")))
    grouped = asks.withColumn("grp", F.pmod(F.xxhash64("rid", F.lit("grp")), per_cluster.cast("bigint")))
    groups = grouped.select("cluster", "grp", "rid", "label", "q", "wanted").groupBy("cluster", "grp").applyInPandas(
        pack, "cluster int, grp long, m_rids binary, m_labels binary, m_dims int, m_vectors binary, counts binary, wanted binary")
    groups = groups.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)).cast("array<bigint>")))
    tasks = min(n_blocks * sum(sizes.values()), MAX_TASKS)
    on = ["cluster", "grp", "block"]
    return chunks.repartition(tasks, *on).join(groups.repartition(tasks, *on), on).mapInPandas(run, FOUND)


def tile(row, same_label: bool, k: int) -> Iterator[pd.DataFrame]:
    """The k best rows of one chunk of a list for every ask of one group of members."""
    rids, ids = np.frombuffer(row.rids, "<i8"), np.frombuffer(row.ids, "<i8")
    void, labels = np.frombuffer(row.void, np.uint8).astype(bool), np.frombuffer(row.labels, "<i8")
    vectors = np.frombuffer(row.vectors, "<f8").reshape(len(rids), row.dims)
    m_rids, m_labels = np.frombuffer(row.m_rids, "<i8"), np.frombuffer(row.m_labels, "<i8")
    members = np.frombuffer(row.m_vectors, "<f8").reshape(len(m_rids), row.m_dims)
    counts = np.frombuffer(row.counts, "<i4")
    wanted = np.frombuffer(row.wanted, "<i8").reshape(-1, 3)
    first = np.concatenate(([0], np.cumsum(counts)))
    for at in range(0, len(m_rids), SLAB):
        part = slice(at, at + SLAB)
        scores = products(members[part], vectors)
        fits = m_labels[part][:, None] == labels[None, :]
        fits = fits & (m_rids[part][:, None] != rids[None, :]) if same_label else ~fits
        for j in range(int(counts[part].max(initial=0))):
            has = np.nonzero(counts[part] > j)[0]
            ask, lo, hi = wanted[first[:-1][part][has] + j].T
            s = scores[has]
            r, c = best_of(s, fits[has] & (s >= lo[:, None]) & (s <= hi[:, None]), k)
            if len(r):
                yield pd.DataFrame({"rid": m_rids[part][has][r], "ask": ask[r], "cand": rids[c], "id": ids[c], "void": void[c], "score": s[r, c]})


def _percent(p: Column, percent: int, up: bool) -> Column:
    """floor or ceiling of percent * p / 100, without passing 64 bits on the way."""
    rest = F.pmod(p, F.lit(100))
    hundreds = F.call_function("div", p - rest, F.lit(100))
    part = F.ceil(rest * percent / 100) if up else F.floor(rest * percent / 100)
    return (hundreds * percent + part).cast("long")


def hard_negatives(rows: DataFrame, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, clusters: int | None = None,
                   block_rows: int = BLOCK_ROWS, group_members: int = GROUP_MEMBERS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    `rows` (stored): rid, vec_id (0 if `void`), void, label, q and the flag `anchor`.  An anchor's positives are its best
    other rows of the same label; for each, the best rows of another label whose score is `low` to
    `high` percent of the positive's."""
    spark = rows.sparkSession
    n = rows.agg(F.count("*").alias("rows"), F.count_if("anchor").alias("anchors"), F.max(F.size("q")).alias("dims")).first()
    if not n["anchors"]:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    dims = n["dims"]
    by_chance = [F.xxhash64("rid", F.lit("sample")), "rid"]
    some = matrix(rows.where("anchor").orderBy(*by_chance).limit(SAMPLE_ROWS).select("q").toPandas()["q"], dims)
    centres = fit_centres(some, clusters or min(MAX_CLUSTERS, max(1, n["anchors"] // CLUSTER_MEMBERS)))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            m = matrix(b["q"], dims)
            angle = angles(m, centres)
            near = angle.argmin(axis=1)
            yield b.assign(norm=norms(m), cluster=near.astype(np.int32), angle=angle[np.arange(len(m)), near])

    members = stored(rows.where("anchor").select("rid", "vec_id", "label", "q").mapInPandas(
        place, "rid long, vec_id long, label long, q array<double>, norm double, cluster int, angle double"))
    spread = np.zeros(len(centres))
    for r in members.groupBy("cluster").agg(F.max("angle").alias("a")).collect():
        spread[r["cluster"]] = r["a"]
    some = matrix(rows.orderBy(*by_chance).limit(SAMPLE_ROWS).select("q").toPandas()["q"], dims)
    cuts = cuts_of(some, centres, spread, n["rows"])
    n_blocks = max(1, -(-n["rows"] // block_rows))
    blocks = build_blocks(rows, n["rows"], centres, spread, cuts, block_rows)

    asks = members.select("rid", "label", "q", "norm", "cluster", F.array(F.struct(F.lit(0).cast("long").alias("ask"), F.lit(LEAST).alias("lo"), F.lit(MOST).alias("hi"))).alias("wanted"))
    near = best_rows(blocks, n_blocks, stored(asks), cuts, True, positives, group_members)
    near = stored(near.select("rid", F.when(~F.col("void"), F.col("id")).alias("positive_id"), F.col("score").alias("positive_score")))
    p = F.col("positive_score")
    ranges = near.select("rid", p.alias("ask"), _percent(p, low, True).alias("lo"), _percent(p, high, False).alias("hi")).distinct().where("lo <= hi")
    wanted = ranges.groupBy("rid").agg(F.collect_list(F.struct("ask", "lo", "hi")).alias("wanted"))
    asks = stored(asks.drop("wanted").join(wanted, "rid"))
    hard = best_rows(blocks, n_blocks, asks, cuts, False, negatives, group_members)
    out = near.join(hard, (near["rid"] == hard["rid"]) & (near["positive_score"] == hard["ask"])).drop(hard["rid"])
    out = out.join(members.select("rid", F.col("vec_id").alias("anchor_id")), "rid")
    negative = F.when(~F.col("void"), F.col("id")).alias("negative_id")
    return out.select("anchor_id", "positive_id", "rank", negative, "positive_score", F.col("score").alias("negative_score"))


def labelled(vectors: DataFrame) -> DataFrame:
    """The rows that take part, with the labels as the query wants them and the anchors told."""
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    anchor = F.coalesce(F.col("vec_id") % 100 == 0, F.lit(False))
    vec_id = F.coalesce(F.col("vec_id").cast("long"), F.lit(0).cast("long"))
    return numbered(vectors.where("label is not null"), "embedding", vec_id=vec_id, void=F.col("vec_id").isNull(), label=moved, anchor=anchor)


def op13_hard_negatives(spark, sf_dir: str) -> DataFrame:
    return hard_negatives(stored(labelled(table(spark, sf_dir, "embeddings"))))


ORACLE = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(embedding) = len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
), r AS (
  SELECT p.anchor_id, positive_id, other_id AS negative_id, positive_score, score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
   AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM r WHERE rank <= 5
"""
