"""Language identification by error-correcting output codes.

Every language gets a binary codeword.  For each code bit a binary n-gram
classifier (smoothed log-odds of hashed character n-grams, languages weighted
alike) predicts which side a text is on; its margin says how surely.  Decoding
sums a logistic loss per bit, weighted by how far apart the two sides of that
bit are, and takes the codeword with the least loss.  How far the two best codewords
are apart by the mean log-odds of an n-gram is compared with the median of all training rows
(copies count once) rightly decoded to the same language: a text at under half of that is flagged as ambiguous, and its score is lower in proportion.

Whether a text is in a learned language at all is told by its mean log share of
n-grams over all languages (`keep_known`): it may lie under the median of the
training rows decoded to the same language by several times their spread, and at
least by ``LEAST_GAP``, but not by more.  How close two languages are plays no part.

Counts are taken over all training rows: each task adds up its own counts per
language and n-gram bucket, so what is shuffled is at most tasks x languages x
``BUCKETS`` rows.  Tasks turn the counts of a block of buckets into the weights of its
code bits, so the driver holds ``BUCKETS`` x bits, however many languages there are:
every language is learned; beyond ``HADAMARD`` of them a codeword has two or more blocks of
``HADAMARD`` bits, and any two differ in half of one block at least.

Edge cases: a null text or one without any letter gets ``und`` with score 0 and
no language when nothing could be learned; rows without a language, or with an
empty one, are not learned from; repeated rows are learned from as often as they
occur and predicted alike; a null id counts as an empty one for the held-out rule.
When nothing could be learned, `keep_known` keeps every text with a letter; texts of
few n-grams hardly tell against a language and stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capture_lake.llm.common import bounded_batches, fresh_names, once, stored, table

UNKNOWN = "und"
#: Hash buckets for character n-grams of 1 to 3 letters.
BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
#: Most languages whose codewords are rows of a Hadamard matrix; and how many languages' sums a task holds before it hands them on.
HADAMARD = 512
#: Buckets whose weights one group of rows makes.
BLOCK = 64
#: Count that every bucket of every language has besides its own.
SMOOTHING = 0.02
#: Largest prime under HADAMARD: the numbers a block of a codeword stands for.
PRIME = 509
#: Share of its language's median gap under which a prediction is flagged as ambiguous.
AMBIGUOUS_SHARE = 0.5
#: How far under its language's median evidence a text stays: so many nats an n-gram at least, or so many times median - lower quartile.
LEAST_GAP, SPREADS = 2.5, 12.0
#: n-grams that count as much as a text's own when its evidence is shrunk to the median.
PRIOR_GRAMS = 32.0
#: Letters whose evidence is held at once, so a very long text needs bounded memory.
CHUNK = 1 << 18

_MULT = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    """Which code points of the basic plane are letters (made once per worker)."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(1 << 16)), bool, 1 << 16))
    return _letters[0]


def letters_of(text: str) -> np.ndarray:
    """Lower-case code points with every run of other characters as one blank, blank at both
    ends; empty when the text has no letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    basic = points < (1 << 16)
    is_letter = _letter_table()[np.where(basic, points, 0)]
    if not basic.all():
        high = ~basic
        is_letter[high] = [chr(c).isalpha() for c in points[high]]
    if not is_letter.any():
        return points[:0]
    shown = np.concatenate(([32], np.where(is_letter, points, 32), [32])).astype(np.uint64)
    keep = np.concatenate(([True], (shown[1:] != 32) | (shown[:-1] != 32)))
    return shown[keep]


def grams(letters: np.ndarray) -> Iterator[np.ndarray]:
    """Bucket numbers of the n-grams of a text, some at a time."""
    step = CHUNK
    for start in range(0, max(1, len(letters)), step):
        part = letters[start : start + step + max(ORDERS) - 1]
        for n in ORDERS:
            m = min(len(part) - n + 1, step)
            if m <= 0:
                continue
            h = np.full(m, n, np.uint64)
            for i in range(n):
                h = (h ^ part[i : i + m]) * _MULT[i]
                h ^= h >> np.uint64(29)
            yield ((h * _MULT[0]) >> np.uint64(64 - 15)).astype(np.int64) & (BUCKETS - 1)


def gram_counts(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, bucket, n) over all rows that have a language and a letter."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, text in zip(b["lang"], b["text"]):
                for g in grams(letters_of(text)):
                    if lang not in sums:
                        sums[lang] = np.zeros(BUCKETS, np.int64)
                    sums[lang] += np.bincount(g, minlength=BUCKETS)
                if len(sums) > HADAMARD:  # many made-up labels: hand on what there is
                    yield from rows(sums)
                    sums = {}
        yield from rows(sums)

    def rows(sums: dict[str, np.ndarray]) -> Iterator[pd.DataFrame]:
        for lang, s in sums.items():
            at = np.nonzero(s)[0]
            yield pd.DataFrame({"lang": lang, "bucket": at.astype(np.int32), "n": s[at]})

    usable = docs.where(f"{lang_col} <> '' and {text_col} is not null").select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    return usable.mapInPandas(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def codewords(k: int) -> np.ndarray:
    """A k x bits matrix of 0/1: all two-sided splits for up to five languages (2^(k-1) - 1
    bits), beyond that rows of a Hadamard matrix (any two differ in half of their bits), and for
    more than HADAMARD languages blocks of such rows: a language's number has digits by PRIME, which are
    the coefficients of a polynomial, and block x stands for its value at x.  Two polynomials agree
    at fewer places than they have coefficients, so two codewords differ in one block at least."""
    if k <= 1:
        return np.zeros((k, 0), np.int8)
    if k <= 5:
        splits = [[1, *((s >> i) & 1 for i in range(k - 1))] for s in range(2 ** (k - 1) - 1)]
        return np.array(splits, np.int8).T
    if k > HADAMARD:
        digits, rest = [], np.arange(k)
        while not digits or rest.any():
            digits.append(rest % PRIME)
            rest = rest // PRIME
        cols = np.arange(HADAMARD)[None, :]
        blocks = [sum(d * x**i for i, d in enumerate(digits)) % PRIME + 1 for x in range(len(digits))]
        return np.concatenate([(np.bitwise_count(v[:, None] & cols) & 1).astype(np.int8) for v in blocks], axis=1)
    order = 1 << int(k).bit_length()
    rows, cols = np.arange(1, k + 1)[:, None], np.arange(order)[None, :]
    code = (np.bitwise_count(rows & cols) & 1).astype(np.int8)
    return code[:, (code.min(axis=0) == 0) & (code.max(axis=0) == 1)]


@dataclass
class Model:
    """langs; code: langs x bits; weights: buckets x bits; alpha: weight of each bit; known: log share
    of each bucket, languages weighted alike; typical: median gap of the training rows of each language."""

    langs: list[str]
    code: np.ndarray
    weights: np.ndarray
    alpha: np.ndarray
    known: np.ndarray | None = None
    typical: dict[str, float] | None = None

    def gap(self, text: str | None) -> tuple[str, float]:
        """(language, how far the second best codeword is off by the mean log-odds of an n-gram)."""
        letters = letters_of(text) if text else ()
        if not len(letters) or len(self.langs) < 2:
            return UNKNOWN, 0.0
        total, n = np.zeros(self.code.shape[1]), 0
        for g in grams(letters):
            total += np.take(self.weights, g, axis=0).sum(axis=0, dtype=np.float64)
            n += len(g)
        loss = self._loss(total / n)
        order = np.argsort(loss, kind="stable")
        return self.langs[order[0]], float(loss[order[1]] - loss[order[0]])

    def _loss(self, margin: np.ndarray) -> np.ndarray:
        """log(1 + e^m) = m + log(1 + e^-m): what all codewords lose, and more where a codeword has 0."""
        return np.logaddexp(0.0, -margin) @ self.alpha + (1 - self.code) @ (margin * self.alpha)

    def evidence(self, text: str | None) -> tuple[str, float, int]:
        """(language, mean log share of the n-grams, their number)."""
        letters = letters_of(text) if text else ()
        if not len(letters) or not self.langs:
            return UNKNOWN, 0.0, len(letters)
        total, share, n = np.zeros(self.code.shape[1]), 0.0, 0
        for g in grams(letters):
            total += np.take(self.weights, g, axis=0).sum(axis=0, dtype=np.float64)
            share += float(np.take(self.known, g).sum())
            n += len(g)
        return self._decode(total, n)[0], share / n, n

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score from 0 to 1, ambiguous)."""
        letters = letters_of(text) if text else ()
        if not len(letters) or not self.langs:
            return UNKNOWN, 0.0, True
        total, n = np.zeros(self.code.shape[1]), 0
        for g in grams(letters) if len(self.langs) > 1 else ():
            total += np.take(self.weights, g, axis=0).sum(axis=0, dtype=np.float64)
            n += len(g)
        return self._decode(total, n)

    def _decode(self, total: np.ndarray, n: int) -> tuple[str, float, bool]:
        """The best codeword by the summed log-odds of `n` n-grams."""
        if len(self.langs) == 1:
            return self.langs[0], 1.0, False
        # mean log-odds, as so many independent n-grams as a few words have at most
        loss = self._loss(total / n * (PRIOR_GRAMS * n / (n + PRIOR_GRAMS)))
        order = np.argsort(loss, kind="stable")
        chance = np.exp(-(loss - loss[order[0]]))
        best = self.langs[order[0]]
        plain = self._loss(total / n)
        apart = float(plain[order[1]] - plain[order[0]])
        typical = (self.typical or {}).get(best, 0.0)
        share = min(1.0, max(0.0, apart) / typical) if typical > 0 else 1.0
        return best, float(chance[order[0]] / chance.sum()) * share, share < AMBIGUOUS_SHARE


def fit(counts: DataFrame) -> Model:
    """The model from (lang, bucket, n) of all languages; (lang, total) and weights by bucket and bit reach the driver."""
    totals = {r["lang"]: r["total"] for r in counts.groupBy("lang").agg(F.sum("n").alias("total")).collect()}
    langs = sorted(totals)
    if not langs:
        return Model([], np.zeros((0, 0), np.int8), np.zeros((BUCKETS, 0), np.float32), np.zeros(0))
    at = {lang: i for i, lang in enumerate(langs)}
    code = codewords(len(langs))
    scale = 1.0 / (np.array([totals[lang] for lang in langs], float) + SMOOTHING * BUCKETS)
    shared = counts.sparkSession.sparkContext.broadcast((at, code, scale))

    def weigh(rows: pd.DataFrame) -> pd.DataFrame:
        where, words, scale_ = shared.value
        lang, slot = rows["lang"].map(where).to_numpy(int), rows["bucket"].to_numpy(int) % BLOCK
        order = np.lexsort((lang, slot))
        lang, slot, n = lang[order], slot[order], rows["n"].to_numpy(float)[order]
        weights, apart, known = block_weights(words, scale_, lang, slot, n)
        return pd.DataFrame({"block": rows["bucket"].iloc[:1].to_numpy(int) // BLOCK, "weights": [weights.tobytes()], "apart": [apart.tobytes()], "known": [known.tobytes()]})

    blocks = counts.groupBy((F.col("bucket") / BLOCK).cast("int").alias("block")).applyInPandas(weigh, "block int, weights binary, apart binary, known binary")
    none = np.zeros(0, int)
    empty = block_weights(code, scale, none, none, np.zeros(0))
    weights, known, apart = np.tile(empty[0], (BUCKETS // BLOCK, 1)), np.tile(empty[2], BUCKETS // BLOCK), np.tile(empty[1], (BUCKETS // BLOCK, 1))
    for r in blocks.collect():
        rows = slice(r["block"] * BLOCK, (r["block"] + 1) * BLOCK)
        weights[rows] = np.frombuffer(r["weights"], np.float32).reshape(BLOCK, -1) if code.shape[1] else 0
        known[rows], apart[r["block"]] = np.frombuffer(r["known"]), np.frombuffer(r["apart"])
    apart = apart.sum(axis=0)
    alpha = apart / max(apart.mean(), 1e-12) if len(apart) else apart
    return Model(langs, code, weights, alpha, known)


def block_weights(code: np.ndarray, scale: np.ndarray, lang: np.ndarray, slot: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log-odds (BLOCK x bits), how far apart the sides of each bit are in this block, and log share of
    each bucket, from counts `n` by language number and bucket of the block, in order of the buckets."""
    k, bits = code.shape
    ones = code.sum(axis=0, dtype=float)
    base = SMOOTHING * scale
    one, all_ = np.tile(base @ code, (BLOCK, 1)), np.full(BLOCK, base.sum())
    for b, start, end in zip(range(BLOCK), np.searchsorted(slot, range(BLOCK)), np.searchsorted(slot, range(BLOCK), "right")):
        share = n[start:end] * scale[lang[start:end]]
        one[b] += share @ code[lang[start:end]]
        all_[b] += share.sum()
    p1, p0 = one / np.maximum(ones, 1), np.maximum(all_[:, None] - one, 1e-300) / np.maximum(k - ones, 1)
    weights = np.clip(np.log(p1) - np.log(p0), -6.0, 6.0)
    return weights.astype(np.float32), ((p1 - p0) * weights).sum(axis=0), np.log(all_ / k)


def predict(docs: DataFrame, model: Model, text_col: str = "text", names: tuple[str, str, str] = ("lang_pred", "score", "ambiguous")) -> DataFrame:
    """`docs` with the predicted language, its score and the ambiguity flag; only the text is read."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, ambiguous boolean")
    def guess(text: pd.Series) -> pd.DataFrame:
        m = shared.value
        return pd.DataFrame([m.predict(t) for t in text], columns=["lang_pred", "score", "ambiguous"])

    (found,) = fresh_names(docs, "found")
    out = docs.withColumn(found, guess(F.col(text_col)))
    kept = [F.col(c) for c in docs.columns if c not in names]
    return out.select(*kept, *(F.col(f"{found}.{c}").alias(n) for c, n in zip(("lang_pred", "score", "ambiguous"), names)))


def held_out(id_col: str = "doc_id"):
    """Rows whose crc32(id as text) leaves remainder 2 by 4 are never learned from."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def calibrated(model: Model, docs: DataFrame) -> Model:
    """The model with the median gap of each language's training rows, all that are rightly decoded, copies once;
    one row a language reaches the driver."""
    if len(model.langs) < 2:
        return model
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, gap double")
    def measure(text: pd.Series) -> pd.DataFrame:
        found = [shared.value.gap(t) for t in text]
        # five digits: the medians are exact and count few distinct values
        return pd.DataFrame([(lang, float(f"{gap:.4e}")) for lang, gap in found], columns=["lang", "gap"])

    usable = docs.where("lang <> '' and text is not null").select("lang", "text")
    told = usable.select("lang", F.xxhash64("text", "lang").alias("h"), once(measure)("text").alias("m")).where(F.col("lang") == F.col("m.lang"))
    single = told.groupBy("h").agg(F.min("lang").alias("lang"), F.min("m.gap").alias("gap"))  # hashes and numbers are exchanged, no text
    rows = single.groupBy("lang").agg(F.percentile("gap", F.lit(0.5)).alias("gap")).collect()
    return replace(model, typical={r["lang"]: r["gap"] for r in rows})


def train(docs: DataFrame) -> Model:
    """The counts are stored: they are summed up by language and by bucket; the texts are read once for them and
    once for the medians."""
    learned = docs.where(~held_out())
    return calibrated(fit(stored(gram_counts(learned))), learned)


def op10_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return predict(rows, train(docs)).drop("text")


def floors(docs: DataFrame, model: Model) -> dict[str, tuple[float, float]]:
    """language -> (median evidence, gap) of all training rows decoded to it; one row a language reaches the driver."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, mean double")
    def weigh(text: pd.Series) -> pd.DataFrame:
        found = [shared.value.evidence(t) for t in text]
        # two decimals: the percentiles are exact and count few distinct values
        return pd.DataFrame([(lang if n else None, round(mean, 2)) for lang, mean, n in found], columns=["lang", "mean"])

    learned = docs.where(~held_out() & (F.col("lang") != "") & F.col("text").isNotNull())
    told = learned.select(once(weigh)("text").alias("e")).select("e.*").where("lang is not null")
    rows = told.groupBy("lang").agg(F.percentile("mean", F.array(F.lit(0.25), F.lit(0.5))).alias("q")).collect()
    return {r["lang"]: (r["q"][1], max(LEAST_GAP, SPREADS * (r["q"][1] - r["q"][0]))) for r in rows}


def explained(model: Model, bounds: dict[str, tuple[float, float]], text: str | None) -> bool:
    """Whether a text has letters and its best codeword's language explains it; without a learned language any letter will do."""
    lang, mean, n = model.evidence(text)
    if not n or lang not in bounds:
        return n > 0
    median, gap = bounds[lang]
    return (mean - median) * n / (n + PRIOR_GRAMS) >= -gap


def keep_known(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of `docs` in a learned language: a text without letters goes, and so does one whose
    evidence is far under that of the training rows of `docs` in its language; an ambiguous one stays."""
    bounds = floors(docs, model) if model.langs else {}
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model, bounds))

    @F.pandas_udf("boolean")
    def known(text: pd.Series) -> pd.Series:
        return pd.Series([explained(*shared.value, t) for t in text], dtype=bool)

    return docs.where(known("text")).select(*docs.columns)
