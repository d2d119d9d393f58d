"""SimHash near-duplicates by deletion-variant signatures.

Two 64-bit fingerprints within three bits differ by at most one bit in one of
their two 32-bit segments.  So each distinct segment value is indexed under its
32 one-wildcard variants; an equality join on the variants finds the values that
are one bit apart, the fingerprints that hold them meet in buckets, and the
full 64 bits are verified there.  A bucket with more than ``MAX_BUCKET``
fingerprints is cut again by the same rule on the bits its members do not share
yet (32, then 16, then 8 bits wide); after that at most 2^11 distinct
fingerprints can share a bucket, so every link is found with bounded buckets.

Linked documents form groups (connected components, found by alternating
large-star and small-star steps on Spark tables).  Inside a bucket a star per
linked set replaces the pairs, which keeps the same groups.

Edge cases: a null text is an empty one; a text without words has fingerprint
zero and is linked like any other; equal rows land in one group; a null
``doc_id`` belongs to the group of its fingerprint (whose id is the smallest
non-null ``doc_id``, or null when there is none).  An empty table gives an empty
result.  Extra columns are ignored by `near_duplicates` and kept by `one_per_group`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capture_lake.llm.common import bounded_batches, clean_text, fresh_names, stored, table

SHINGLE_WORDS = 3
MAX_DISTANCE = 3
SEED = 42
#: Largest bucket that is compared directly; larger ones are cut further.
MAX_BUCKET = 512
#: Variant rows that one task makes, on average.
VARIANTS_PER_TASK = 500_000
#: Shingle hashes counted at a time, so a very long text needs bounded memory.
CHUNK = 1 << 16


def fingerprint(text: str, words_per_shingle: int = SHINGLE_WORDS) -> int:
    """Signed 64-bit SimHash of a whole text (bytes.lower and bytes.split handle exactly
    A-Z and the six ASCII white-space characters)."""
    import xxhash

    h = xxhash.xxh64_intdigest
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(words_per_shingle, len(words))
    spans = zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())
    n = len(words) - k + 1
    hashes = np.fromiter((h(joined[a:b], SEED) for a, b in spans), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, CHUNK):
        part = hashes[i : i + CHUNK]
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits((2 * ones > n).astype(np.uint8), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words_per_shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, th, fp): fingerprint and text hash of every row of `docs`."""
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def simhash(text: pd.Series) -> pd.Series:
        return pd.Series(np.fromiter((fingerprint(t, words_per_shingle) for t in text), np.int64, len(text)))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), simhash(clean_text()).alias("fp"))


def segment_buckets(fps: DataFrame, tasks: int) -> DataFrame:
    """(key, n, base, fp): fingerprints that share a 32-bit segment up to one bit.

    `fps` holds distinct fingerprints; `tasks` shares out the variants (32 of each segment value).  The variants are taken of distinct segment
    values, so a variant matches two values at most, however many rows hold them.
    `base` is where the other, still unshared, half begins."""
    values = fps.select("fp", F.explode(F.array(F.lit(0), F.lit(32))).alias("seg"))
    values = values.withColumn("v", F.expr("shiftrightunsigned(fp, seg) & 4294967295L"))
    counted = values.repartition(tasks, "seg", "v").groupBy("seg", "v").agg(F.count("*").alias("n"))
    variants = counted.select("seg", "v", "n", F.explode(F.sequence(F.lit(0), F.lit(31))).alias("p"))
    variants = variants.withColumn("masked", F.expr("v & ~shiftleft(1L, p)"))
    apart = (
        variants.groupBy("seg", "p", "masked")
        .agg(F.min("v").alias("a"), F.max("v").alias("b"), F.sum("n").alias("n"))
        .where("a <> b")
        .select("seg", F.explode(F.array("a", "b")).alias("v"), "p", "masked", "n")
    )
    same = counted.where("n > 1").select("seg", "v", F.lit(32).alias("p"), F.col("v").alias("masked"), "n")
    index = apart.unionByName(same).select(
        "seg", "v", "n",
        F.expr("shiftleft(cast(seg as long), 38) | shiftleft(cast(p as long), 32) | masked").alias("key"),
    )
    return values.join(index, ["seg", "v"]).select("key", "n", (32 - F.col("seg")).alias("base"), "fp")


def cut_buckets(members: DataFrame, width: int) -> DataFrame:
    """Buckets over (key, base, fp) cut again: of the `width` unshared bits from `base` on,
    one half differs by at most one bit in any linked pair."""
    half = width // 2
    rows = members.select("key", "base", "fp", F.explode(F.array(F.lit(0), F.lit(half))).alias("h"))
    rows = rows.select(
        "key", "fp", "h", (F.col("base") + half - F.col("h")).alias("base"),
        F.expr(f"shiftrightunsigned(fp, base + h) & {(1 << half) - 1}L").alias("v"),
        F.explode(F.sequence(F.lit(0), F.lit(half))).alias("p"),
    )
    # position `half` stands for the value itself, the others for one wildcard bit
    rows = rows.withColumn("masked", F.expr(f"if(p = {half}, v, v & ~shiftleft(1L, p))"))
    rows = rows.select(F.xxhash64("key", "h", "p", "masked").alias("key"), "base", "fp")
    sizes = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    return rows.join(sizes, "key").select("key", "n", "base", "fp")


def links_in_buckets(members: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """(a, b): a star for each linked set inside each bucket of (key, fp)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out_a, out_b = [], []
            for fps in batch["fps"]:
                x = np.unique(np.asarray(fps, np.int64)).view(np.uint64)
                near = np.bitwise_count(x[:, None] ^ x[None, :]) <= max_distance
                left = np.ones(len(x), bool)
                for i in range(len(x)):
                    if not left[i]:
                        continue
                    seen = edge = near[i] & left
                    while edge.any():
                        edge = near[edge].any(axis=0) & left & ~seen
                        seen = seen | edge
                    left &= ~seen
                    seen[i] = False
                    out_b.extend(x[seen].view(np.int64).tolist())
                    out_a.extend([int(x.view(np.int64)[i])] * int(seen.sum()))
            yield pd.DataFrame({"a": np.array(out_a, np.int64), "b": np.array(out_b, np.int64)})

    grouped = members.groupBy("key").agg(F.collect_list("fp").alias("fps"))
    return grouped.select("fps").mapInPandas(run, "a long, b long").distinct()


def links(fps: DataFrame, max_distance: int = MAX_DISTANCE, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """(a, b): links between distinct fingerprints that keep every connected set connected."""
    found = []
    buckets = stored(segment_buckets(fps, max(8, -(-64 * fps.count() // VARIANTS_PER_TASK))))
    width = 32
    while True:
        small = buckets if width <= 8 else buckets.where(F.col("n") <= max_bucket)
        found.append(links_in_buckets(small, max_distance))
        if width <= 8:
            break
        large = buckets.where(F.col("n") > max_bucket)
        if large.isEmpty():
            break
        buckets = stored(cut_buckets(large, width))
        width //= 2
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) of every node of an undirected graph of (a, b) edges; root is the
    smallest node of its connected component.

    Alternating large-star and small-star steps; only minima per node are aggregated,
    and each round's edges are checkpointed.  The driver reads one checksum a round."""
    e = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    for _ in range(max_rounds):
        state = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == before or not state["n"]:
            break
        before = state
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = stored(small.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    roots = e.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def near_duplicates(docs: DataFrame, words_per_shingle: int = SHINGLE_WORDS, max_distance: int = MAX_DISTANCE,
                    max_bucket: int = MAX_BUCKET) -> DataFrame:
    """(doc_id, th, fp, component_id, keeper) for every row of `docs`.

    `component_id` is the smallest doc_id of the row's group; `keeper` marks the rows that
    carry the group's smallest (doc_id, text hash), null ids last."""
    if not 0 <= max_distance <= 3:
        raise ValueError("two segments hold links of at most three bits")
    rows = stored(fingerprints(docs, words_per_shingle))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th")).alias("first")
    nodes = stored(rows.groupBy("fp").agg(first))
    roots = stored(components(links(nodes.select("fp"), max_distance, max_bucket)))
    linked = nodes.join(roots, nodes.fp == roots.node).select("fp", "root", "first")
    groups = linked.groupBy("root").agg(F.min("first").alias("group_first"))
    linked = linked.join(groups, "root").select("fp", "group_first")
    nodes = nodes.join(linked, "fp", "left").select("fp", F.coalesce("group_first", "first").alias("first"))
    out = rows.join(nodes, "fp")
    return out.select(
        "doc_id", "th", "fp", F.col("first.doc_id").alias("component_id"),
        (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("th") == F.col("first.th"))).alias("keeper"),
    )


def one_per_group(docs: DataFrame, **params) -> DataFrame:
    """The rows of `docs`, all columns, with one document of each near-duplicate group."""
    keep = near_duplicates(docs, **params).where("keeper").select("doc_id", "th").distinct()
    no_id, the_id, th = fresh_names(docs, "no_id", "the_id", "th")
    key = [no_id, the_id, th]
    keep = keep.select(F.col("doc_id").isNull().alias(no_id), F.coalesce("doc_id", F.lit(0)).alias(the_id), F.col("th").alias(th))
    doc_id = F.col("doc_id").cast("long")
    keyed = docs.withColumns({no_id: doc_id.isNull(), the_id: F.coalesce(doc_id, F.lit(0)), th: F.xxhash64("text")})
    # the same key columns in the join and in dropDuplicates: the texts are shuffled once
    return keyed.join(keep, key, "left_semi").dropDuplicates(key).select(*docs.columns)


def op4_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "keeper")
