"""Page texts, collocations and hard negatives against brute force, and their edge cases."""

from __future__ import annotations

import html
import itertools
import math
import random
import re
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from capture_lake.llm import collocations as co
from capture_lake.llm import hard_negatives as hn
from capture_lake.llm import html_extract as hx
from capture_lake.llm import vectors as vx
from capture_lake.llm.common import stored, table

SF = "/root/testdata/sf0.001"

# --- main texts of pages ----------------------------------------------------

PARA = "The committee met again on Tuesday, and the long report it had asked for was read aloud to everyone present. "


def furnished(article: str, host: str = "news.example.com") -> str:
    return (
        "<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var t='<p>No</p>';</script></head>"
        '<body class="single comments-open with-sidebar"><header><h1>No site</h1><p>No banner of the site</p></header>'
        '<nav><ul><li><a href="/">No</a></li></ul></nav><div class="cookie-notice"><p>No cookies are eaten on this long and windy road, we say.</p></div>'
        '<div id="wrap"><div class="sidebar-left"><p>' + "No sidebar text, however long it may be, is the article. " * 9 + "</p></div>"
        f'<div class="content">{article}</div>'
        '<form action="/s"><label>No</label><input value="No"></form><div class="ad-slot"></div><div class="ad"><p>No advert</p></div>'
        '<section id="comments"><article class="comment"><p>' + "No reader comment, however long it may be, counts. " * 9 + "</p></article></section></div>"
        "<footer><p>No footer</p></footer></body></html>"
    )


@pytest.mark.parametrize("article, expected", [
    (f"<h1>Title</h1><p>{PARA}</p><p>Two</p>", f"Title\n{PARA.strip()}\nTwo"),
    (f"<article><h1>Title</h1><p>{PARA}<p>Two<ul><li>a<li>b</ul></article>", f"Title\n{PARA.strip()}\nTwo\na\nb"),
    (f"<article><p>a&amp;b &lt;i&gt; &#233;&nbsp;x\n\t y &am; caf&eacute</p><p>{PARA}</p></article>", f"a&b <i> é x y &am; café\n{PARA.strip()}"),
    (f"<article><p><b>bold<br>next</p><p>in<i>side</b> word</i></p><p>{PARA}</p></article>", f"bold next\ninside word\n{PARA.strip()}"),
    (f"<article><header><h1>Head</h1><p>by No one</p></header><p>{PARA}</p><aside>No</aside><!-- <p>No --><div class=share-buttons>No</div></article>", f"Head\n{PARA.strip()}"),
    (f"<article><p>{PARA}</p><table><tr><td>1<td>2<tr><td>3</table><pre> x\n  y</pre></article>", f"{PARA.strip()}\n1\n2\n3\nx y"),
    (f"<section><h2>A</h2><p>{PARA}</p></section><section><h2>B</h2><p>{PARA}</p></section>", f"A\n{PARA.strip()}\nB\n{PARA.strip()}"),
    (f"<article><p>1 < 2 > 0 <3 & more</p><p>{PARA}</p>", f"1 < 2 > 0 <3 & more\n{PARA.strip()}"),
])
def test_article_without_furniture(article, expected):
    got = hx.extract(furnished(article), [])
    assert got == expected
    assert "No" not in got.replace("No one", "")


def test_consensus_decides_where_a_page_is_in_doubt(spark):
    """One page has more running text beside its post than in it; the host's other pages tell which container counts."""
    def page(post, aside):
        return f'<body><div class="post-{len(post)}"><p>{post}</p></div><div class="box"><p>{aside}</p></div></body>'

    pages = [(i, f"http://h.example.org/{i}", page(PARA * 6 + str(i), "Short words beside it.")) for i in range(6)]
    pages.append((6, "https://user@H.example.org:8080/6", page(PARA, PARA * 2)))
    pages.append((7, "http://alone.example.org/", page(PARA, PARA * 9)))
    got = {r["page_id"]: r["text"] for r in hx.main_texts(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert all(got[i] == PARA * 6 + str(i) for i in range(6))
    assert got[6] == PARA.strip()
    assert got[7] == f"{PARA.strip()}\n{(PARA * 9).strip()}"  # nothing tells one from the other


def test_given_pages_equal_their_articles(spark):
    """Brute force: the given pages hold their text in one <article>."""
    got = {r["page_id"]: (r["text"], r["n_chars"], r["url"]) for r in hx.op11_html_extraction(spark, SF).collect()}
    pages = table(spark, SF, "pages").collect()
    assert len(got) == len(pages)
    for r in pages:
        parts = re.split(r"</?(?:p|h1)>", re.search(r"<article>(.*?)</article>", r["html"], re.S).group(1))
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in parts]
        text = "\n".join(b for b in blocks if b)
        assert got[r["page_id"]] == (text, len(text), r["url"])


def test_odd_pages(spark):
    deep = "<div>" * 5000 + PARA + "</div>" * 5000
    rows = [(1, None, None), (2, "x", ""), (3, "http://a/", "plain words, no tag"), (4, "http://a/", "<p>one<p>two"), (4, "http://a/", "<p>one<p>two"),
            (None, "http://b/", "<article><p>x</article>"), (5, "//c/", "<nav>only</nav>"), (6, "http://d/", deep), (7, "http://d/", "<div class='x"),
            (8, "http://e/", "<article><a href=x>only a link</a></article><nav>n</nav>"), (9, "http://f/", "<script>x"), (10, "http://g/", "<p>" + "long " * 400_000)]
    frame = spark.createDataFrame([(*r, "k", "h") for r in rows], "page_id long, url string, html string, text string, host string")
    got = sorted(((r["page_id"] or 0, r["url"], r["text"], r["n_chars"]) for r in hx.main_texts(frame).collect()), key=str)
    texts = ["", "", "plain words, no tag", "one\ntwo", "one\ntwo", "x", "", PARA.strip(), "", "only a link", "", ("long " * 400_000).strip()]
    assert got == sorted(((r[0] or 0, r[1], t, len(t)) for r, t in zip(rows, texts)), key=str)
    assert hx.main_texts(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_host_of(spark):
    urls = ["http://A.b/x", "https://u:p@c.d:80?q", "//e.f#g", "h/i", "", None, "ftp://", "http://a@b/@c"]
    got = [r[0] for r in spark.createDataFrame([(u,) for u in urls], "url string").select(hx.host_of(F.col("url"))).collect()]
    assert got == ["a.b", "c.d", "e.f", "", "", "", "", "b"]


# --- collocations -----------------------------------------------------------

def brute_collocations(docs, least, first=2000, most=5, percent=100):
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, most + 1):
                for i in range(len(words) - m + 1):
                    f[lang, tuple(words[i : i + m])] += 1
    cands = {k: a for k, a in f.items() if a >= least and len(k[1]) > 1}
    gone = set()
    for (lang, p), a in cands.items():
        for i, j in itertools.combinations(range(len(p) + 1), 2):
            part = p[i:j]
            if 1 < len(part) < len(p) and 100 * a >= percent * cands.get((lang, part), math.inf):
                gone.add((lang, part))
    rows = []
    for (lang, p), a in cands.items():
        if (lang, p) in gone:
            continue
        score, k = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
        rows.append((lang, -score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]], n[lang]))
    out = []
    for lang, group in itertools.groupby(sorted(rows), key=lambda r: r[0]):
        out += [(lang, i, r[3].decode(), -r[2], r[4], r[5], r[6], -r[1]) for i, r in enumerate(group, 1) if i <= first]
    return out


def frame_of(spark, docs):
    rows = spark.createDataFrame([(lang, t, "x", 1) for lang, t in docs], "lang string, text string, prefix string, words int")
    return rows.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"), "prefix", "words")


def random_docs(seed, n, words, langs):
    rnd = random.Random(seed)
    seps = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "!?"]
    docs = [(rnd.choice(langs), "".join(rnd.choice(words) + rnd.choice(seps) for _ in range(rnd.randrange(60)))) for _ in range(n)]
    fixed = ["New York Stock Exchange opens, new york stock exchange closes", "a a a a a a a", "", None, "...", "É É é É É"]
    return docs + [(rnd.choice(langs), t) for t in fixed for _ in range(4)]


@pytest.mark.parametrize("seed, least, percent", [(1, 4, 100), (2, 6, 80), (3, 2, 100)])
def test_collocations_brute_force(spark, seed, least, percent):
    docs = random_docs(seed, 120, ["the", "of", "New", "york", "Ünder", "x1", "don't", "-", "ß"], ["en", "en", "en", None, ""])
    docs.append(("en", "one two three. " * 400))
    got = [tuple(r) for r in co.best_collocations(frame_of(spark, docs), least=least, subsumed_percent=percent, chunk_chars=700, places=1000, most_entries=50).collect()]
    assert sorted(got) == sorted(brute_collocations(docs, least, percent=percent))


def test_collocations_stay_exact_when_the_bitmap_is_full(spark):
    """Nearly every phrase passes by chance."""
    docs = random_docs(7, 80, [f"w{i}" for i in range(40)] + ["the", "of"], ["en", "de"])
    got = [tuple(r) for r in co.best_collocations(frame_of(spark, docs), least=3, bitmap_bits=1 << 9).collect()]
    assert sorted(got) == sorted(brute_collocations(docs, 3))


def test_collocations_rank_ties_and_limit(spark):
    docs = [("en", f"{a} {b}.") for a, b in itertools.product("zya", "qé") for _ in range(3)]
    got = [tuple(r) for r in co.best_collocations(frame_of(spark, docs), first=4, least=3).orderBy("rank").collect()]
    assert got == brute_collocations(docs, 3, first=4)
    assert [r[2] for r in got] == ["a q", "a é", "y q", "y é"]


def test_collocations_products_past_64_bits(spark, monkeypatch):
    """Counts near 2^40 (stripes made by hand): the products need over 64 bits."""
    big = 1 << 40
    made = [("en", "", 0, ["a", ""], [big, 3]), ("en", "", 1, ["b", ""], [big - 5, 4]), ("en", "a", 0, ["b", ""], [big - 9, 9])]
    monkeypatch.setattr(co, "stripes", lambda *rest: spark.createDataFrame(made, co.STRIPE_DDL))
    row = co.collocations(frame_of(spark, []), most_words=3).collect()
    n = 2 * big + 2
    assert [tuple(r) for r in row] == [("en", "a b", big - 9, big, big - 5, n, 1000 * (big - 9) * n // (big * (big - 5)))]


def stripes_of(docs, most=5):
    """(lang, prefix) -> Counter of next words, the empty word where a piece ends."""
    out = {}
    for lang, text in docs:
        words = text.split()
        for i in range(len(words)):
            for j in range(min(most, len(words) - i + 1)):
                out.setdefault((lang, " ".join(words[i : i + j])), Counter())["".join(words[i + j : i + j + 1])] += 1
    return out


def merged_stripes(batches):
    out = {}
    for b in batches:
        for r in b.to_pylist():
            stripe = out.setdefault((r["lang"], r["prefix"]), Counter())
            assert not set(stripe) & set(r["words"]) - {""}
            stripe.update(dict(zip(r["words"], r["counts"])))
    return out


@pytest.mark.parametrize("one_hash", [False, True])
def test_collocations_stripes_of_many_parcels(monkeypatch, one_hash):
    """Parcels of several tables meet; entries whose hashes are the same stay apart."""
    rnd = random.Random(3)
    docs = [(rnd.choice(["en", "de", ""]), " ".join(rnd.choice(["a", "b", "é", "ab", "日本"]) for _ in range(rnd.randrange(1, 30)))) for _ in range(60)]
    monkeypatch.setattr(co, "MERGED", 40)
    monkeypatch.setattr(co, "OUT_ENTRIES", 7)
    full = {j: np.full(8, 255, np.uint8) for j in range(1, 6)}
    sent = []
    for i in range(0, 60, 10):
        held = co.Table()
        for lang, text in docs[i : i + 10]:
            held.add(pa.array([lang]), *co.stripe_entries(co.Chunk(lang, [text]), full, 5))
        with monkeypatch.context() as m:
            if one_hash:
                m.setattr(co, "runs", lambda columns, f=co.runs: f_with_one_hash(f, columns))
            sent += list(co.parcels(held, 5))
    if one_hash:
        monkeypatch.setattr(co, "runs", lambda columns, f=co.runs: f_with_one_hash(f, columns))
    got = merged_stripes(co.merge_stripes(iter(sorted(sent, key=lambda b: b["part"][0].as_py())), 3))
    want = {}
    for key, stripe in stripes_of(docs).items():
        kept = Counter({w: c for w, c in stripe.items() if w and c >= 3})
        if kept or not key[1]:
            want[key] = kept + Counter({"": sum(stripe.values()) - sum(kept.values())})
    assert {k: +v for k, v in got.items()} == want


def f_with_one_hash(f, columns):
    before, co.extend_hash = co.extend_hash, lambda prefix, word: np.zeros_like(word)
    try:
        return f(columns)
    finally:
        co.extend_hash = before


def test_collocations_groups_of_large_keys():
    keys = np.array([1 << 62, 5, 1 << 62, 0, 5], np.int64)
    for some in (keys, keys[keys < 9], keys[:0]):
        at, which, counts = co.grouped(some)
        assert some[at].tolist() == sorted(set(some.tolist())) and some[at][which].tolist() == some.tolist()
        assert counts.tolist() == [some.tolist().count(k) for k in some[at].tolist()]


def test_collocations_time_where_most_phrases_are_frequent(spark):
    """On a large corpus most phrases occur often enough; their stripes take about 4 times as long as counting buckets (24 times before)."""
    rnd = random.Random(11)
    texts = [" ".join(rnd.choices([f"w{i}" for i in range(400)], k=600)) for _ in range(500)]
    docs = stored(frame_of(spark, [("en", t) for t in texts for _ in range(2)]).select("lang", "text").coalesce(1))
    bits = 1 << 16  # so few that every bucket is heavy
    heavy = co.heavy_buckets(docs, [1, 2, 3, 4, 5], {}, 2, bits, co.CHUNK_CHARS, co.PLACES)
    t0 = time.perf_counter()
    co.heavy_buckets(docs, [1, 2, 3, 4, 5], {}, 2, bits, co.CHUNK_CHARS, co.PLACES)
    t1 = time.perf_counter()
    merged = co.stripes(docs, heavy, 2, 5, bits, co.CHUNK_CHARS, co.ENTRIES)
    t2 = time.perf_counter()
    assert t2 - t1 < 10 * (t1 - t0)
    once = Counter(tuple(w[i : i + 5]) for w in (t.split() for t in texts) for i in range(len(w) - 4))
    got = {(*r["prefix"].split(), r["word"]): r["f"] for r in co.entries(merged).where(F.size(F.split("prefix", " ")) == 4).collect()}
    assert got == {k: 2 * c for k, c in once.items()}


def test_collocations_empty_table(spark):
    assert co.best_collocations(frame_of(spark, [])).collect() == []
    assert co.best_collocations(frame_of(spark, [("en", None), (None, "")])).collect() == []


# --- hard negatives ---------------------------------------------------------

def brute_negatives(rows):
    """rows: (vec_id, vector, label); as the contract says, with rows apart by their place."""
    used = []
    for place, (i, v, label) in enumerate(rows):
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(256 * x) for x in v]
        used.append((place, i, (label + 1) % 10 if i is not None and i % 7 == 0 else label, q))
    out = []
    for place, i, label, q in used:
        if i is None or i % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(q, o[3])), o[1] is None, o[1] or 0, o[0], o[2] == label) for o in used if o[0] != place]
        scored.sort()
        positives = [s for s in scored if s[4]][:5]
        for p in positives:
            ps = -p[0]
            hard = [s for s in scored if not s[4] and 80 * ps <= 100 * -s[0] <= 100 * ps][:5]
            out += [(i, None if p[1] else p[2], rank, None if s[1] else s[2], ps, -s[0]) for rank, s in enumerate(hard, 1)]
    return sorted(out, key=str)


EMB = "vec_id long, embedding array<double>, label int, rid string, q string, void string"


def mined(spark, rows, **how):
    frame = spark.createDataFrame([(*r, "a", "b", "c") for r in rows], EMB).coalesce(1)
    return sorted(map(tuple, hn.hard_negatives(stored(hn.labelled(frame)), **how).collect()), key=str)


def clustered(seed, n, dims=8, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dims))
    return [(i, (centres[i % 6] + 0.3 * rng.normal(size=dims)).tolist(), int(rng.integers(labels))) for i in range(n)]


@pytest.mark.parametrize("clusters", [1, 5])
def test_negatives_brute_force_over_levels(spark, monkeypatch, clusters):
    monkeypatch.setattr(hn, "FIRST_LEVEL", 40)  # five levels or so
    monkeypatch.setattr(hn, "GROWTH", 2)
    rows = clustered(1, 1501)
    got = mined(spark, rows, clusters=clusters, block_rows=97, group_members=4)
    assert got == brute_negatives(rows)
    assert got


def test_negatives_walk_ends_early(spark, monkeypatch):
    """Members close before the last level where the bounds allow it, and nothing changes by it."""
    seen = []
    plain = hn._tiles
    monkeypatch.setattr(hn, "_tiles", lambda blocks, n, asks, sizes, level, *a: seen.append(level) or plain(blocks, n, asks, sizes, level, *a))
    monkeypatch.setattr(hn, "FIRST_LEVEL", 200)
    monkeypatch.setattr(hn, "GROWTH", 1)
    rng = np.random.default_rng(3)
    rows = [(i, ((2.0 if i % 4 == 0 else 0.1) * np.array([1.0, 0.0]) + 0.01 * rng.normal(size=2)).tolist(), int(rng.integers(3))) for i in range(2000)]
    assert mined(spark, rows, clusters=1) == brute_negatives(rows)
    assert max(seen) < 3


def test_negatives_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = clustered(2, 230, dims=3)
    rows += [(100, [1.0, 2.0, 0.5], 1), (100, [1.0, 2.0, 0.5], 1), (100, [0.1], 2), (None, [1.0, 2.0, 0.5], 1), (None, [0.9, 2.0, 0.5], 2), (300, [], 1), (400, [0.0, 0.0, 0.0], 3),
             (500, [1.0, None, 0.0], 1), (600, None, 1), (700, [nan, 1.0, 1.0], 1), (800, [1.0, 1.0, inf], 2), (900, [1.0, 1.0, 1.0], None), (-100, [-1.0, 3.0, 1.0, 4.0], 0), (1000, [1.0] * 9, 1)]
    assert mined(spark, rows) == brute_negatives(rows)


def test_negatives_ties_and_hot_vector(spark):
    rows = [(i, [1.0, 0.5], i % 3) for i in range(400)] + [(1000 + i, [0.9, 0.6], i % 3) for i in range(50)]
    assert mined(spark, rows, block_rows=64) == brute_negatives(rows)


def test_negatives_large_components_are_exact(spark):
    rows = [(0, [3e5 + 1 / 256, 1e6], 1), (1, [3e5, 1e6], 1), (2, [3e5, 1e6 - 1 / 256], 2), (3, [7e6, 6e6], 2), (100, [7e6, 6e6 + 1 / 256], 2), (5, [2.9e5, 1e6], 3), (6, [7e6, 5.9e6], 1)]
    assert mined(spark, rows) == brute_negatives(rows)
    with pytest.raises(Exception, match="does not fit a long"):
        mined(spark, [(0, [1e10], 1), (1, [1e10], 1)])


def test_negatives_empty(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 1)]) == []
    assert mined(spark, [(0, [1.0], 1)]) == []


def test_products_by_either_way():
    a, b = np.array([[2.0**30, -3.0], [5.0, 7.0]]), np.array([[2.0**25, 1.0], [2.0**31, 9.0]])
    assert vx.products(a, b).tolist() == [[int(x[0]) * int(y[0]) + int(x[1]) * int(y[1]) for y in b] for x in a]
    assert vx.products(np.zeros((2, 0)), b).tolist() == [[0, 0], [0, 0]]
