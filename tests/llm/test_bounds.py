"""Byte-bounded tables, hot groups, sites, live ambiguity, codewords of many languages."""

from __future__ import annotations

import random
import sys

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from capture_lake.llm import langid, quality, swap_packing, token_output, tokens, unigram


def blank_free(n, chars=300):
    rnd = random.Random(1)
    return ["".join(chr(rnd.randrange(0x4E00, 0x9FFF)) for _ in range(chars)) for _ in range(n)]


def held(table):
    return sum(sys.getsizeof(k) + sys.getsizeof(v) for k, v in table.items())


def test_token_table_is_bounded_by_bytes(monkeypatch):
    """Texts without blanks are not remembered, many words are so only up to the bound."""
    import public_tokenizers

    monkeypatch.setattr(tokens, "MAX_BYTES", 200_000)
    ids = tokens.BpeIds(public_tokenizers.path("word_bpe_49k.json"))
    whole = lambda t: np.array(ids.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
    texts = blank_free(200)
    assert list(ids.encode_many(texts)) == [whole(t) for t in texts]
    assert held(ids.table.now) < 10_000
    for at in range(0, 20_000, 500):
        words = " ".join(f"w{i}x" for i in range(at, at + 500))
        assert ids.encode(words) == whole(words)
        assert held(ids.table.now) < 500_000 and held(ids.table.older) < 500_000


def test_unit_table_is_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(unigram, "MAX_BYTES", 300_000)
    seg = unigram.Segmenter(unigram.Model.read(unigram.model_path()))
    for t, (ids, _) in zip(blank_free(60), seg.encode(blank_free(60))):
        assert seg.decode(ids) == t
    assert held(seg.ids) < 10_000 and seg.size < 20_000
    for at in range(0, 6_000, 500):
        text = " ".join(f"u{i}v" for i in range(at, at + 500))
        assert seg.decode(seg.encode([text])[0][0]) == text
        assert held(seg.ids) < 600_000


def test_repeated_rows_spread_over_the_groups(spark):
    """3,000 equal rows and 198 others: no group of the packing is much larger than another."""
    same = spark.range(3000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("the same words again " * 20).alias("text"))
    rest = spark.range(198).select((F.col("id") + 100).alias("doc_id"), F.concat(F.lit("other words number "), F.col("id")).alias("text"))
    docs = same.unionByName(rest)
    packed = token_output.token_matrices(docs, group_chars=50_000)
    sizes = [r["n"] for r in packed.select((F.col("row_id") / (1 << 32)).cast("long").alias("g"), F.size("pieces").alias("k")).groupBy("g").agg(F.sum("k").alias("n")).collect()]
    assert sum(sizes) == 3198
    assert len(sizes) > 15 and max(sizes) < 4 * sum(sizes) / len(sizes)


def test_written_matrices_read_back(spark, tmp_dir):
    docs = spark.createDataFrame([(i, f"document {i} says " + "so " * (i * 700)) for i in range(8)] + [(8, None), (9, "")], "doc_id long, text string")
    token_output.write_matrices(token_output.token_matrices(docs), f"{tmp_dir}/m")
    back = {r["doc_id"]: bytes(r["ids"]) for r in token_output.documents_of(spark.read.parquet(f"{tmp_dir}/m")).collect()}
    want: dict = {}
    for r in token_output.token_pieces(docs, token_output.byte_bpe_path(), token_output.CAPACITY).orderBy("doc_id", "piece").collect():
        want[r["doc_id"]] = want.get(r["doc_id"], b"") + bytes(r["ids"])
    assert back == want


def test_sites_of_urls(spark):
    rows = spark.createDataFrame([(s,) for s in ("https://a.com/x/y", "http://b.org/z?q", "//c.d", "src0", "src1/p/q", None, "ftp://e/#f")], "s string")
    got = [tuple(r) for r in rows.select(quality.host_of(F.col("s")), quality.path_of(F.col("s"))).collect()]
    assert got == [("a.com", "x"), ("b.org", "z"), ("c.d", ""), ("src0", ""), ("src1", "p"), ("", ""), ("e", "")]


def test_two_for_one_offers_every_sum():
    lengths = [50, 40, 40, 30, 7]
    search = swap_packing._Search.__new__(swap_packing._Search)
    search.lengths = lengths
    pairs = search._pairs([0, 1, 2, 3, 4])
    sums = {a + b for i, a in enumerate(lengths) for b in lengths[i + 1 :]}
    assert [t for _, t in pairs] == sorted(sums, reverse=True)
    assert all(sum(lengths[i] for i in p) == t and len(set(p)) == 2 for p, t in pairs)


@pytest.mark.parametrize("k, least", [(2, 1), (5, 8), (6, 4), (512, 512), (513, 256), (1200, 256)])
def test_codewords_keep_their_distance(k, least):
    code = langid.codewords(k).astype(np.int16)
    if k > 600:  # every pair with some of them
        some = code[:: 37]
        apart = np.abs(code[:, None, :] - some[None, :, :]).sum(axis=2)
        apart[np.arange(0, k, 37), np.arange(len(some))] = 1 << 14
    else:
        apart = (code @ (1 - code).T) + ((1 - code) @ code.T)
        np.fill_diagonal(apart, 1 << 14)
    assert apart.min() >= least


def test_half_and_half_texts_are_flagged(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(docs)
    long = {lang: [r["text"] for r in docs.where((F.col("lang") == lang) & (F.length("text") > 2000)).orderBy("doc_id").limit(6).collect()] for lang in model.langs}
    langs = [x for x in model.langs if len(long[x]) >= 4]
    for lang in langs:
        for t in long[lang]:
            best, score, ambiguous = model.predict(t)
            assert best == lang and not ambiguous and score > 0.5
    mixed = [long[a][i][:800] + " " + long[b][i][:800] for a, b in zip(langs, langs[1:] + langs[:1]) for i in range(4)]
    found = [model.predict(t) for t in mixed]
    assert sum(f[2] for f in found) >= 0.9 * len(found)
    assert max(f[1] for f in found) < 1.0


def test_a_filtered_udf_runs_once(spark):
    """A filter on a Python result must not bring a second Python pass below it."""
    from capture_lake.llm.common import once

    @F.pandas_udf("n long, word string")
    def measure(text: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"n": text.str.len(), "word": text})

    rows = spark.createDataFrame([("a",), ("bb",)], "text string")
    kept = rows.select(once(measure)("text").alias("m")).select("m.*").where("word is not null and n > 1")
    assert kept._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
    assert [tuple(r) for r in kept.collect()] == [(2, "bb")]
