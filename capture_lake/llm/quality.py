"""Quality classifier with hierarchical empirical Bayes over hosts and paths.

A logistic classifier on text features, fitted on a bounded sample of labelled
rows, gives each document its own evidence.  Grouped aggregation over all
documents turns that evidence into site rates; a site with few documents is
shrunk toward its parent (path toward host, host toward the global rate), with
a strength estimated from the spread between sites (method of moments).  A
document's final log-odds add its own evidence to the shift of its path's
posterior from the global rate, its own share left out.

The host is what stands before the first ``/`` of `source`, the path the next
segment (empty when there is none).

Edge cases: a text that is null or has no word gets quality 0; a null `source`
is the site ``''``; without labels (or with labels of one kind) the classifier is
a constant; labels of a repeated id are averaged, null labels and ids are
ignored; repeated rows are scored alike, and each counts in its site; an empty
table gives an empty result; a label of 0.5 or more counts as good.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from capture_lake.llm.common import bounded_batches, clean_text, fresh_names, once, stored, stored_table, table

#: Labelled rows the classifier is fitted on, about, when there are more.
MAX_LABELLED = 20_000
#: Least quality a document needs to stay.
THRESHOLD = 0.5
RIDGE = 1e-2
FEATURES = ("log_words", "distinct_words", "upper", "symbols", "symbol_runs", "digits", "repeated_lines", "word_length", "lone_symbols")

_kinds: list[np.ndarray] = []


def _byte_kinds() -> np.ndarray:
    """256 x 5: upper, lower or beyond ASCII, digit, white space, symbol."""
    if not _kinds:
        b = bytes(range(256))
        kind = np.zeros((256, 5))
        for i in range(256):
            c = b[i : i + 1]
            kind[i, 0 if c.isupper() else 1 if i > 127 or c.islower() else 2 if c.isdigit() else 3 if c.isspace() else 4] = 1
        _kinds.append(kind)
    return _kinds[0]


def features(text: str) -> list[float] | None:
    """Numbers that describe a whole text; None when it has no word."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    if not words:
        return None
    raw = np.frombuffer(data, np.uint8)
    upper, lower, digit, _, symbol = np.bincount(raw, minlength=256) @ _byte_kinds()
    shown = upper + lower + digit + symbol
    is_symbol = _byte_kinds()[:, 4].astype(bool)[raw]
    runs = int(np.count_nonzero(is_symbol[1:] & is_symbol[:-1]))
    lines = [x for x in data.split(b"\n") if x]
    seen, again = set(), 0
    for x in lines:
        again += len(x) if x in seen else 0
        seen.add(x)
    n = len(words)
    lone = sum(1 for w in words if len(w) == 1 and is_symbol_byte(w))
    return [
        float(np.log1p(n)), len(set(words)) / n**0.9, float(upper / max(1.0, upper + lower)), float(symbol / shown),
        runs / n, float(digit / shown), again / len(data), float(shown / n), lone / n,
    ]


def is_symbol_byte(w: bytes) -> bool:
    return not (w.isalnum() or w[0] > 127)


@dataclass
class Model:
    """A logistic model on standardised features."""

    mean: list[float] = field(default_factory=lambda: [0.0] * len(FEATURES))
    scale: list[float] = field(default_factory=lambda: [1.0] * len(FEATURES))
    weights: list[float] = field(default_factory=lambda: [0.0] * len(FEATURES))
    bias: float = 0.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - np.array(self.mean)) / np.array(self.scale), -8, 8)
        return np.clip(z @ np.array(self.weights) + self.bias, -20, 20)


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> Model:
    """Ridge logistic regression by Newton steps on a sample that the driver holds."""
    good, bad = float(y.sum()), float(len(y) - y.sum())
    if not good or not bad:
        return Model(bias=float(np.log((good + 1) / (bad + 1))))
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    z = np.column_stack([np.clip((x - mean) / scale, -8, 8), np.ones(len(x))])
    ridge = np.diag([RIDGE * len(y)] * (z.shape[1] - 1) + [1e-9])
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge + 1e-9 * np.eye(len(w)), z.T @ (y - p) - ridge @ w)
        w += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return Model(mean.tolist(), scale.tolist(), w[:-1].tolist(), float(w[-1]))


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _features(text: pd.Series) -> pd.Series:
    return pd.Series([features(t) for t in text])


def _site(source):
    """A source without its scheme: `https://a.com/x/y` as `a.com/x/y`."""
    return F.regexp_replace(F.coalesce(source, F.lit("")), r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//", "")


def host_of(source):
    return F.substring_index(_site(source), "/", 1)


def path_of(source):
    """The first part of the path after the host."""
    return F.coalesce(F.try_element_at(F.split(_site(source), "[/?#]"), F.lit(2)), F.lit(""))


def evidence(docs: DataFrame) -> DataFrame:
    """(doc_id, host, path, x) of every row, kept in the shared folder; x is null without words."""
    bounded_batches(docs.sparkSession)
    return stored(docs.select("doc_id", host_of(F.col("source")).alias("host"), path_of(F.col("source")).alias("path"), _features(clean_text()).alias("x")))


def train(rows: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Model:
    """A classifier from labelled rows; of more than `max_labelled` about so many are taken, by a
    hash of their id, so no more than that reaches the driver however large the tables are."""
    told = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("y"))
    labelled = stored(rows.where("x is not null").join(told, "doc_id").select("doc_id", "x", "y"))
    count = labelled.count()
    if count > max_labelled:
        share = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 20))
        labelled = labelled.where(share < int((1 << 20) * max_labelled / count))
    sample = sorted((r["doc_id"], list(r["x"]), r["y"]) for r in labelled.collect())
    if not sample:
        return Model()
    return fit(np.array([x for _, x, _ in sample], float), np.array([y for _, _, y in sample], float))


def _logits(model: Model, rows: list) -> pd.Series:
    """Log-odds of feature rows; null for rows without features."""
    has = np.array([x is not None for x in rows], bool)
    out = np.full(len(rows), np.nan)
    if has.any():
        out[has] = model.logit(np.array([list(x) for x in rows if x is not None], float))
    return pd.Series(out).astype(object).where(pd.Series(has), None)


def _logit_udf(model: Model):
    """Log-odds of a column of features."""

    @F.pandas_udf("double")
    def own(x: pd.Series) -> pd.Series:
        return _logits(model, x.tolist())

    return own


def _text_logit_udf(model: Model):
    """Log-odds of a column of texts: features and model in one Python pass."""

    @F.pandas_udf("double")
    def own(text: pd.Series) -> pd.Series:
        return _logits(model, [features(t) for t in text])

    return own


def _probability(logit):
    return 1 / (1 + F.exp(-logit))


def _log_odds(rate):
    safe = F.least(F.greatest(rate, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(safe / (1 - safe))


@dataclass
class Prior:
    rate: float
    host_strength: float
    path_strength: float


def _strength(within: float, between: float, groups: float, total: float, square: float) -> float:
    """How many documents a parent's rate is worth against a site's own (method of moments)."""
    spread = (between - groups * within) / max(total - square, 1e-9)
    return float(np.clip(within / spread if spread > 0 else 1e6, 1.0, 1e6))


def sites(scored: DataFrame) -> tuple[DataFrame, Prior]:
    """(host, path, n, s, host_n, host_s) over all documents, and the global prior."""
    p = _probability(F.col("logit"))
    by_path = scored.where("logit is not null").groupBy("host", "path").agg(F.count("*").alias("n"), F.sum(p).alias("s"), F.sum(p * p).alias("q"))
    by_path = stored(by_path)
    by_host = stored(by_path.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("s").alias("host_s"), F.sum(F.col("n") * F.col("n")).alias("host_nn"), F.count("*").alias("paths")))
    both = by_path.join(by_host, "host")
    g = by_path.agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"), F.count("*").alias("paths")).first()
    if not g["n"]:
        return both.select("host", "path", "n", "s", "host_n", "host_s"), Prior(0.5, 1.0, 1.0)
    rate = g["s"] / g["n"]
    r_path, r_host = F.col("s") / F.col("n"), F.col("host_s") / F.col("host_n")
    h = by_host.agg(F.count("*").alias("hosts"), F.sum(F.col("host_n") * (r_host - rate) ** 2).alias("between"), F.sum(F.col("host_n") * F.col("host_n")).alias("nn"), F.sum(F.col("host_nn") / F.col("host_n")).alias("inner")).first()
    m = both.agg(F.sum(F.col("n") * (r_path - r_host) ** 2).alias("between"), F.sum(F.col("q") - F.col("n") * r_path * r_path).alias("within")).first()
    within = max(m["within"] / max(g["n"] - g["paths"], 1), 1e-9)
    prior = Prior(
        rate,
        _strength(within, h["between"], h["hosts"] - 1, g["n"], h["nn"] / g["n"]),
        _strength(within, m["between"], g["paths"] - h["hosts"], g["n"], h["inner"]),
    )
    return both.select("host", "path", "n", "s", "host_n", "host_s"), prior


def with_quality(scored: DataFrame, site: DataFrame, prior: Prior, names: tuple[str, str, str] = ("host_rate", "path_rate", "quality")) -> DataFrame:
    """`scored` (host, path, logit) with the posterior rates of its site, its own share left
    out, and the final quality."""
    host_rate, path_rate, quality = names
    own = F.coalesce(_probability(F.col("logit")), F.lit(0.0))
    one = F.when(F.col("logit").isNull(), 0).otherwise(1)
    joined = scored.join(site, ["host", "path"], "left").fillna(0, ["n", "s", "host_n", "host_s"])
    host = (prior.host_strength * prior.rate + F.col("host_s") - own) / (prior.host_strength + F.col("host_n") - one)
    path = (prior.path_strength * F.col(host_rate) + F.col("s") - own) / (prior.path_strength + F.col("n") - one)
    final = _probability(F.col("logit") + _log_odds(F.col(path_rate)) - _log_odds(F.lit(prior.rate)))
    return (
        joined.withColumn(host_rate, F.greatest(host, F.lit(0.0))).withColumn(path_rate, F.greatest(path, F.lit(0.0)))
        .withColumn(quality, F.coalesce(final, F.lit(0.0))).drop("n", "s", "host_n", "host_s")
    )


def score(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, host, path, logit, host_rate, path_rate, quality, keep) of every row of `docs`."""
    rows = evidence(docs)
    model = train(rows, labels, max_labelled)
    scored = stored(rows.withColumn("logit", _logit_udf(model)("x")).drop("x"))
    site, prior = sites(scored)
    return with_quality(scored, stored_table(site, "sites"), prior).withColumn("keep", F.col("quality") >= THRESHOLD)


def keep_good(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs`, all columns, whose quality reaches the threshold.

    The texts are not shuffled: a second pass computes the features again next to the
    text, and the site table is joined on its stored size (broadcast only when small)."""
    rows = evidence(docs)
    model = train(rows, labels, max_labelled)
    site, prior = sites(rows.withColumn("logit", once(_logit_udf(model))("x")).drop("x"))
    site = stored_table(site, "sites")
    (bag,) = fresh_names(docs, "row")
    wide = docs.select(F.struct(*docs.columns).alias(bag), host_of(F.col("source")).alias("host"), path_of(F.col("source")).alias("path"), _text_logit_udf(model)(clean_text()).alias("logit"))
    return with_quality(wide, site, prior).where(F.col("quality") >= threshold).select(f"{bag}.*")


def op5_quality_classifier(spark, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
