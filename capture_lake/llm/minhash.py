"""Document fingerprints by one-permutation MinHash.

Every shingle of five words (fewer words: the whole text) is hashed once; the
high bits choose one of ``BINS`` bins, and a bin keeps its least hash.  An empty
bin takes the value of a bin that a sequence of hashed choices of its own first
finds filled (optimal densification), so two texts fill their empty bins alike.
Only ``BITS`` low bits of each bin are stored, packed; bits that agree by chance
are taken out of the likeness: (share - c) / (1 - c) with c = 2^-BITS.

`edited_pairs` compares each document with the next one by descending id.  Rows
are dealt into id ranges of bounded text size, the first row of each range goes
along to the range before it, and within a range rows stream by in order, so the
texts are shuffled once and no task holds more than a few of them.

Edge cases: a null text is an empty one; a text without words has the empty
fingerprint, alike to itself (1) and to nothing else (0); rows without an id come
last, by the hash of their text; equal ids are ordered by the hash of their
text; a single row is its own next one; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from capture_lake.llm.common import bounded_batches, clean_text, stored, table

WORDS = 5
BINS = 512
BITS = 4
#: Characters of text per id range, on average, and most ranges.
RANGE_CHARS = 5_000_000
MAX_RANGES = 20_000
TRIES = 64

_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def _choices(start: int) -> np.ndarray:
    """TRIES x BINS: the bins that each bin tries at its tries from `start` on."""
    at = np.arange(start, start + TRIES, dtype=np.uint64)[:, None] * np.uint64(BINS) + np.arange(BINS, dtype=np.uint64)
    return (_mixed(at + np.uint64(0x9E3779B97F4A7C15)) % np.uint64(BINS)).astype(np.int64)


_tables: list[np.ndarray] = []


def _choice_table(k: int) -> np.ndarray:
    while len(_tables) <= k:
        _tables.append(_choices(len(_tables) * TRIES))
    return _tables[k]


_NUMBERS = _mixed(np.arange(1, BINS + 1, dtype=np.uint64))


def shingle_hashes(text: str) -> np.ndarray:
    """A hash of each shingle of a text's words (split at ASCII white space)."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    h = xxhash.xxh64_intdigest
    w = np.fromiter(map(h, words), np.uint64, n)
    k = min(WORDS, n)
    out = w[: n - k + 1].copy()
    for i in range(1, k):
        out = _mixed(out + np.uint64(0x9E3779B97F4A7C15)) ^ w[i : n - k + 1 + i]
    return _mixed(out)


def bins_of(hashes: np.ndarray) -> np.ndarray | None:
    """The low bits of every bin's least hash, empty bins filled; None without hashes.

    A bin's hash is mixed with its number before the bits are taken, so bins that share one
    hash agree by chance each on its own."""
    if not len(hashes):
        return None
    s = np.sort(hashes)
    which = (s >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
    first = np.concatenate(([True], which[1:] != which[:-1]))
    value, filled = np.zeros(BINS, np.uint64), np.zeros(BINS, bool)
    value[which[first]] = s[first]
    filled[which[first]] = True
    empty = np.nonzero(~filled)[0]
    if int(first.sum()) == 1:  # whatever bins are tried, this one is found
        value[:] = s[0]
        empty = empty[:0]
    k = 0
    while len(empty):
        tried = _choice_table(k)[:, empty]
        hit = filled[tried]
        got = hit.any(axis=0)
        source = tried[hit.argmax(axis=0), np.arange(len(empty))]
        value[empty[got]] = value[source[got]]
        empty = empty[~got]
        k += 1
    return (_mixed(value ^ _NUMBERS) & np.uint64((1 << BITS) - 1)).astype(np.uint8)


def pack(bins: np.ndarray | None) -> str:
    """Hexadecimal text, a digit per four bits."""
    if bins is None:
        return ""
    shifts = np.arange(BITS - 1, -1, -1, dtype=np.uint8)
    return np.packbits(((bins[:, None] >> shifts) & 1).ravel()).tobytes().hex()


def unpack(text: str) -> np.ndarray | None:
    if not text:
        return None
    bits = np.unpackbits(np.frombuffer(bytes.fromhex(text), np.uint8)).reshape(BINS, BITS)
    return bits @ (1 << np.arange(BITS - 1, -1, -1))


def likeness(a: np.ndarray | None, b: np.ndarray | None) -> float:
    """Estimated share of common shingles, without what agrees by chance."""
    if a is None or b is None:
        return float(a is b)
    chance = 2.0**-BITS
    return float(min(1.0, max(0.0, (np.mean(a == b) - chance) / (1 - chance))))


def fingerprint(text: str) -> str:
    return pack(bins_of(shingle_hashes(text)))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of every row."""
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("string")
    def make(text: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t) for t in text])

    return docs.select("doc_id", make(clean_text()).alias("fingerprint"))


def _ranges(docs: DataFrame, range_chars: int) -> DataFrame:
    """(part, borrowed, doc_id, th, text): rows by id range, part 0 has the greatest ids; the first
    row of the next part (after the last: of the first) comes along with `borrowed` set."""
    from pyspark.ml.feature import Bucketizer

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(clean_text()).alias("th"), clean_text().alias("text"))
    size = rows.agg(F.sum(F.length("text") + 50).alias("chars"), F.min("doc_id").alias("least")).first()
    parts = int(min(MAX_RANGES, max(1, -(-(size["chars"] or 0) // range_chars))))
    share = (F.col("th").cast("double") + 2.0**63) / 2.0**64
    # descending id as an ascending number; rows without an id lie behind all others
    order = F.coalesce(-F.col("doc_id").cast("double"), F.lit(1.0 - (size["least"] or 0)) + share)
    rows = rows.withColumn("ord", order)
    cuts = rows.approxQuantile("ord", [i / parts for i in range(1, parts)], 0.25 / parts) if parts > 1 else []
    splits = [-float("inf"), *sorted(set(cuts)), float("inf")]
    if len(splits) > 2:
        rows = Bucketizer(splits=splits, inputCol="ord", outputCol="b").transform(rows).withColumn("part", F.col("b").cast("int"))
    else:
        rows = rows.withColumn("part", F.lit(0))
    rows = rows.select("part", F.lit(0).alias("borrowed"), "doc_id", "th", "text")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), (-F.col("doc_id")).alias("down"), "th")
    firsts = stored(rows.groupBy("part").agg(F.min(place).alias("first")))  # a row per range, MAX_RANGES at most
    by_part = Window.orderBy("part")
    last = F.max("part").over(Window.partitionBy())
    to = firsts.select("part", F.coalesce(F.lag("part").over(by_part), last).alias("to"), F.col("first.th").alias("th"), F.col("first.down").alias("down"))
    to = F.broadcast(to.withColumnRenamed("th", "first_th").withColumnRenamed("part", "from"))
    same = (rows["part"] == to["from"]) & (rows["th"] == to["first_th"]) & (-rows["doc_id"]).eqNullSafe(to["down"])
    lent = rows.join(to, same).dropDuplicates(["from"]).select(F.col("to").alias("part"), F.lit(1).alias("borrowed"), "doc_id", "th", "text")
    return rows.unionByName(lent).repartitionById(parts, "part")


def edited_pairs(docs: DataFrame, range_chars: int = RANGE_CHARS) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row."""
    bounded_batches(docs.sparkSession)
    rows = _ranges(docs, range_chars)
    rows = rows.sortWithinPartitions("part", "borrowed", F.desc_nulls_last("doc_id"), "th")
    rows = rows.select("part", "borrowed", F.col("doc_id").cast("string").alias("doc_id"), "text")
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        before = None  # the row that waits for its next one
        for batch in batches:
            out = []
            for part, borrowed, doc_id, text in batch.itertuples(index=False):
                bins = bins_of(shingle_hashes(text))
                if before is not None and before[0] == part:
                    _, id_, old, old_bins = before
                    n = len(old) // 3
                    edited = old[: len(old) - n] + text[:n]
                    edited_bins = bins_of(shingle_hashes(edited)) if edited != old else old_bins
                    out.append((
                        id_, len(old), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), pack(old_bins), pack(edited_bins),
                        likeness(old_bins, edited_bins), likeness(old_bins, bins),
                    ))
                before = None if borrowed else (part, doc_id, text, bins)
            yield pd.DataFrame(out, columns=names)

    schema = "doc_id string, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return rows.mapInPandas(run, schema).withColumn("doc_id", F.col("doc_id").cast("long"))


def op9_document_fingerprints(spark, sf_dir: str) -> DataFrame:
    return edited_pairs(table(spark, sf_dir, "documents"))
