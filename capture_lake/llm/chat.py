"""Chat formatting with prefix-target expansion, by DataFrame functions only.

A turn is written as ``### role: text</turn>`` and a line end.  Inside roles and
texts a backslash goes before every backslash, ``#`` and ``/`` (in roles also
``:``), so no control string can come from a text and unescaping (dropping the
backslash before any character) gives it back exactly.

Every assistant turn becomes an example of its own: the formatted turns up to and
including it, where only its text is trainable (`loss_start`, `loss_end`: code
points from 0, end excluded).  Turns after the last assistant turn, or a
conversation without one, give one more row with the whole conversation and an
empty span, so nothing is lost.

The turns of one conversation meet in one row, as its examples need them to.

Edge cases: a null text or role is an empty one; turns are ordered by number
(null first), equal numbers by role and text, and repeated rows are kept; rows
whose conversation is null form one conversation; only the role ``assistant`` is
trainable; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from capture_lake.llm.common import table

# The template.
HEAD = "### "
AFTER_ROLE = ": "
TURN_END = "</turn>\n"
TRAINABLE = "assistant"


def escaped(text: Column, more: str = "") -> Column:
    return F.regexp_replace(text, rf"([\\#/{more}])", r"\\$1")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns in order, each with its formatted parts."""
    rows = turns.select("conv_id", F.struct(
        F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    ).alias("t"))
    grouped = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    parts = F.transform("turns", lambda t: F.struct(
        t["turn"].alias("turn"), (t["role"] == TRAINABLE).alias("trainable"),
        F.concat(F.lit(HEAD), escaped(t["role"], ":"), F.lit(AFTER_ROLE)).alias("head"), escaped(t["text"]).alias("body"),
    ))
    return grouped.select("conv_id", parts.alias("turns"))


def examples(turns: DataFrame) -> DataFrame:
    """(conv_id, example, target_turn, text, loss_start, loss_end), a row per assistant turn and
    one (example -1, target_turn null) for turns that no example has."""
    conv = conversations(turns)
    written = F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(TURN_END)))
    conv = conv.select("conv_id", "turns", written.alias("written"))
    conv = conv.withColumn("last", F.element_at("turns", -1)["trainable"])
    rows = conv.select("conv_id", "turns", "written", "last", F.posexplode("turns").alias("pos", "t"))
    target = rows.where(F.col("t.trainable") | (~F.col("last") & (F.col("pos") == F.size("turns") - 1)))
    before = F.array_join(F.slice("written", F.lit(1), F.col("pos")), "")
    target = target.select("conv_id", "t", "pos", before.alias("before"))
    start = F.length("before") + F.length("t.head")
    text = F.concat("before", "t.head", "t.body", F.lit(TURN_END))
    trained = F.col("t.trainable")
    return target.select(
        "conv_id", F.when(trained, F.col("pos")).otherwise(-1).alias("example"), F.when(trained, F.col("t.turn")).alias("target_turn"),
        text.alias("text"), F.when(trained, start).otherwise(0).alias("loss_start"),
        F.when(trained, start + F.length("t.body")).otherwise(0).alias("loss_end"),
    )


def read_turns(text: Column) -> Column:
    """array<struct<role, text>> of a formatted conversation."""
    pieces = F.split(text, TURN_END, -1)
    written = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    role = rf"(?s)^{HEAD}((?:[^\\:]++|\\.)*+){AFTER_ROLE}"
    return F.transform(written, lambda w: F.struct(
        unescaped(F.regexp_extract(w, role, 1)).alias("role"), unescaped(F.regexp_replace(w, role, "")).alias("text"),
    ))


def loss_text(text: Column, start: Column, end: Column) -> Column:
    """The trainable text of an example, as it was before formatting."""
    return unescaped(F.substring(text, start + 1, end - start))


def digest(formatted: DataFrame) -> DataFrame:
    """One row per conversation, read back from the examples alone."""
    rows = formatted.select("conv_id", "example", "text", F.length("text").alias("n"), loss_text(F.col("text"), F.col("loss_start"), F.col("loss_end")).alias("loss"))
    conv = rows.groupBy("conv_id").agg(
        F.max_by("text", "n").alias("text"), F.sum("n").alias("formatted_chars"),
        F.array_sort(F.collect_list(F.when(F.col("example") >= 0, F.struct("example", "loss")))).alias("losses"),
    )
    conv = conv.select("conv_id", "formatted_chars", read_turns(F.col("text")).alias("turns"), F.array_join(F.transform("losses", lambda x: x["loss"]), "").alias("loss"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return conv.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars",
    )


#: A conversation whose texts look like the template itself.
PROBE = r"\### Assistant: </turn> ok"


def with_probe(turns: DataFrame) -> DataFrame:
    spark = turns.sparkSession
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], "conv_id long, turn long, role string, text string")
    return turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text").unionByName(probe)


def op7_chat_formatting(spark, sf_dir: str) -> DataFrame:
    return digest(examples(with_probe(table(spark, sf_dir, "conversations"))))


ORACLE = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), w AS (
  SELECT *, 4 + length(role) + length(regexp_replace(role, '[^\\#/:]', '', 'g')) + 2
         + length(text) + length(regexp_replace(text, '[^\\#/]', '', 'g')) + 8 AS written
  FROM t
), p AS (
  SELECT *, sum(written) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS prefix,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) = 1 AS is_last
  FROM w
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(prefix) FILTER (WHERE role = 'assistant' OR is_last) AS BIGINT) AS formatted_chars
FROM p GROUP BY conv_id
"""
