"""The corpus pipeline, stage by stage, against brute force on a small table."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pytest

import corpus_pipeline as P
from capture_lake.llm import langid, quality, simhash, swap_packing, tokens
from conftest import SF_SMALL

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = [docs.cache()]
    for _, stage in P.STAGES:
        out.append(stage(spark, out[-1], SF_SMALL).cache())
    yield out
    for df in out:  # other tests look at plans over the same files
        df.unpersist()


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_all_but_the_last_keep_the_columns(stages):
    assert [name for name, _ in P.STAGES] == ["quality_classifier", "language_id", "simhash_near_dedup", "pii_surrogates", "best_fit_packing"]
    assert all(df.columns == COLUMNS for df in stages[:-1])


def test_quality_stage(spark, stages):
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    scored = quality.score(stages[0], labels).collect()
    assert set(rows(stages[1])) == {r["doc_id"] for r in scored if r["quality"] >= quality.THRESHOLD}


def test_language_stage(stages):
    model = langid.train(stages[1])
    want = {i for i, r in rows(stages[1]).items() if model.predict(r["text"])[0] != langid.UNKNOWN}
    assert set(rows(stages[2])) == want


def test_near_duplicate_stage(stages):
    before = rows(stages[2])
    ids = sorted(before)
    x = np.array([simhash.fingerprint(before[i]["text"]) for i in ids], np.int64).view(np.uint64)
    group = list(range(len(ids)))
    for i in range(len(ids)):
        for j in np.nonzero(np.bitwise_count(x[i] ^ x[:i]) <= simhash.MAX_DISTANCE)[0]:
            a, b = group[i], group[int(j)]
            group = [min(a, b) if g in (a, b) else g for g in group]
    kept = rows(stages[3])
    assert sorted(kept) == sorted({ids[g] for g in group})
    assert all(kept[i] == before[i] for i in kept)


def test_personal_data_stage(stages):
    before, after = rows(stages[3]), rows(stages[4])
    assert set(before) == set(after)
    found = re.compile(r"[\w.]+@[\w.]+\.com|\b\d{16}\b|\+1 \(\d{3}\) \d{3}-\d{4}|\b(?:\d{1,3}\.){3}\d{1,3}\b|\b[0-9a-f]{40}\b|AKIA\w{16}|password=\w+")
    def counts(m):  # sixteen digits are a card's with an issuer's first digit and a right check digit only
        twice = [int(c) * (2 - i % 2) for i, c in enumerate(m)] if re.fullmatch(r"\d{16}", m) else []
        return not twice or (m[0] in "23456" and sum(x - 9 * (x > 9) for x in twice) % 10 == 0)

    old = {m for r in before.values() for m in found.findall(r["text"]) if counts(m)}
    new = {m for r in after.values() for m in found.findall(r["text"]) if counts(m)}
    no_cards = [{m for r in side.values() for m in found.findall(r["text"]) if not counts(m)} for side in (before, after)]
    assert no_cards[0] == no_cards[1]
    assert old and not old & new and len(old) == len(new)
    for i, r in after.items():
        assert found.sub("", r["text"]) == found.sub("", before[i]["text"])
        assert (r["lang"], r["source"], r["n_chars"]) == (before[i]["lang"], before[i]["source"], before[i]["n_chars"])


def pieces(packed):
    return sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed)


def test_packing_stage_and_run(spark, stages):
    ours = tokens.BpeIds(swap_packing.word_bpe_path())
    want = []
    for i, r in rows(stages[4]).items():
        ids = ours.encode(r["text"]) + bytes(4)
        want += [(i, k, 2048 * k, len(ids[at : at + 8192]) // 4, zlib.crc32(ids[at : at + 8192])) for k, at in enumerate(range(0, len(ids), 8192))]
    assert pieces(stages[5].collect()) == sorted(want)
    whole = P.run(spark, SF_SMALL).collect()
    assert pieces(whole) == sorted(want)
    used = {}
    for r in whole:
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert all(sum(n for _, n in parts) <= 2048 for parts in used.values())
    assert len(used) <= -(-sum(w[3] for w in want) // 2048) + 2
