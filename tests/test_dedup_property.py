"""J1 + D2 against brute force on random batches (hypothesis)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from capture_lake.plans.capture import assemble, capture_rows

T0 = dt.datetime(2024, 1, 1)
# hash, minute, does it pass, can its metadata be read
rows_st = st.lists(st.tuples(st.sampled_from(["", "h1", "h2", "h3"]), st.integers(0, 3), st.booleans(), st.booleans()),
                   min_size=0, max_size=20)
target_st = st.lists(st.sampled_from(["", "h1", "h5"]), max_size=3)


def one_after_the_other(rows, target):
    written, out = {h for h in target if h}, {}
    for key, h, _, passes, readable in sorted(rows, key=lambda r: (r[2], r[0])):
        if h in written:
            out[key] = "duplicate"
        elif passes and readable:
            out[key] = "ok"
            written |= {h} - {""}
        else:
            out[key] = "quarantine"
    return out


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows_st, target_st)
def test_statuses_are_those_of_objects_one_after_the_other(spark, picks, target_hashes):
    rows = [(f"k{i:02d}", h, T0 + dt.timedelta(minutes=m), p, r) for i, (h, m, p, r) in enumerate(picks)]
    listing = spark.createDataFrame(
        [(k, t, {"content-hash": h, "image-width": "1" if r else "x", "image-height": "1" if p else "0"}) for k, h, t, p, r in rows],
        "key string, last_modified timestamp, metadata map<string,string>")
    target = spark.createDataFrame([(h,) for h in target_hashes], "file_hash string") if target_hashes else None
    want = one_after_the_other(rows, target_hashes)
    for bounded, at_once in ((False, True), (True, False)):
        res = capture_rows(listing, target, lambda x: assemble(x), bounded=bounded, copies_at_once=at_once)
        assert {r.key: r.status for r in res.results.collect()} == want
        assert res.outcome().first().total == len(rows)
        assert res.records.count() == sum(x == "ok" for x in want.values())
