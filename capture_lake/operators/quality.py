"""Range rules, violation counts and the good/quarantine split (Q4, Q5, Q6).

Rules are plain Column predicates, so a check is one projection inside
whole-stage codegen and the counts are one aggregate pass (partial
aggregation map-side, a single row shuffled per task).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATUS_OK = "ok"
STATUS_QUARANTINE = "quarantine"
STATUS_DUPLICATE = "duplicate"


# The record range rules (name, predicate).
def record_rules() -> list[tuple[str, Column]]:
    return [
        ("image_width > 0", F.col("image_width") > 0),
        ("image_height > 0", F.col("image_height") > 0),
        ("0 <= ocr_confidence_mean <= 1", F.col("ocr_confidence_mean").between(0.0, 1.0)),
        ("compression_ratio >= 0", F.col("compression_ratio") >= 0.0),
        ("processing_duration_ms >= 0", F.col("processing_duration_ms") >= 0),
    ]


def _failed(rule: Column) -> Column:
    # A NULL value violates its rule.
    return ~F.coalesce(rule, F.lit(False))


def violations(rules: Sequence[tuple[str, Column]] | None = None) -> Column:
    """ARRAY<STRING> of the names of failed rules; empty when the row passes."""
    rules = record_rules() if rules is None else list(rules)
    return F.filter(F.array(*[F.when(_failed(r), F.lit(n)) for n, r in rules]), lambda x: x.isNotNull())


def violation_counts(df: DataFrame, rules: Sequence[tuple[str, Column]] | None = None) -> DataFrame:
    """Q5: ``(rule, n_violations)``, one row per rule, from one aggregate pass."""
    rules = record_rules() if rules is None else list(rules)
    counts = df.agg(*[F.count_if(_failed(r)).alias(f"__r{i}") for i, (_, r) in enumerate(rules)])
    pairs = ", ".join(f"'{n}', `__r{i}`" for i, (n, _) in enumerate(rules))
    return counts.selectExpr(f"stack({len(rules)}, {pairs}) as (rule, n_violations)")


def check(df: DataFrame, rules: Sequence[tuple[str, Column]] | None = None,
          extra_errors: Column | None = None) -> DataFrame:
    """Q4 + Q6: add ``status`` and ``error``.

    ``error`` lists failed rule names (and any ``extra_errors``, an
    ARRAY<STRING> of upstream errors such as codec or parse failures),
    comma separated; NULL when the row is good.
    """
    v = violations(rules)
    if extra_errors is not None:
        v = F.concat(F.coalesce(extra_errors, F.array().cast("array<string>")), v)
    return df.withColumn("__v", v).withColumns(
        {
            "status": F.when(F.size("__v") == 0, F.lit(STATUS_OK)).otherwise(F.lit(STATUS_QUARANTINE)),
            "error": F.when(F.size("__v") > 0, F.concat_ws(",", "__v")),
        }
    ).drop("__v")
