"""Main text of web pages by consensus paths of their hosts.

Every page is read into a tree (lenient, in one pass over its tags).  Furniture is marked:
menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader
comments, by element, role and the words of class and id.  Each container of the page gets
a score: the share of the page's running text it holds, less half the share of the page's
other text, and a little for what its tag and class say.  Containers vote, with their score,
for their generalised path (tags with classes and ids, runs of digits as one sign); Spark adds
up the votes per host.  The second pass reads the page again and takes the containers on the
path its host voted for most, among those paths that are on the page and score at least half
as much as the page's best; a page with none of them, or without a host, uses its own best.

The text of a container: its blocks in page order without what is furniture, character
references decoded, white space (line breaks too) as one space, blocks joined by one \\n.

Edge cases: a null html counts as empty and gives an empty text, as does a page without any text;
broken markup (unclosed or crossed tags, cut references, missing html or body) is read like
browsers do, in the main; a null url, or one without a host, has no consensus; very long pages
are read whole; every row, repeated ones too, gives its row; other columns are not read; an
empty table gives an empty result.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from capture_lake.llm.common import bounded_batches, stored_table, table

# Elements by their role in HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style xmp iframe noembed noframes textarea title".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCKS - set("body caption dd dt head html legend li tbody td tfoot th thead tr".split())
#: An opening tag ends open elements of the first set, up to one of the second.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}), "thead": ({"thead", "tbody", "tfoot"}, {"table"}), "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
    "a": ({"a"}, {"td", "th", "table"}),
} | {f"h{i}": ({f"h{j}" for j in range(1, 7)}, BLOCKS - {f"h{j}" for j in range(1, 7)}) for i in range(1, 7)}
P_SCOPE = set("table td th caption button object html".split())
CONTAINERS = set("article main section div td body center form".split())
# What is not the article, by element, role, and word of a class or id.
FURNITURE_TAGS = set(
    "script style noscript template head title nav footer aside iframe button select textarea svg math object canvas audio video map dialog menu datalist".split()
)
FURNITURE_ROLES = set("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
FURNITURE_WORDS = set(
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar aside footer header masthead banner ad ads adv advert adverts advertisement advertising adsense "
    "sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login "
    "share sharing social related recommended recommendations comment comments commentlist disqus respond replies discussion widget widgets toolbar pagination "
    "pager copyright skip hidden".split()
)
COMMENT_WORDS = set("comment comments commentlist disqus respond replies discussion".split())
GOOD_WORDS = set("article articlebody content entry post story main text body".split())

TAG = re.compile(r"<(?:!--(?:-?>|.*?(?:--!?>|\Z))|(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(>?)|[!?/][^>]*+>?)", re.S)
ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
DIGITS = re.compile(r"\d+")
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
#: A block of this many characters outside of links counts as running text in full.
LONG_BLOCK = 60
#: Most different paths of a host that are kept for the second pass; pages with none of them use their own best.
HOST_PATHS = 16


class Page:
    """A page as a tree of elements, numbered in page order (0 is the page itself), and its pieces of text."""

    def __init__(self, source: str):
        self.tag, self.parent, self.label = [""], [-1], [""]
        self.own, self.guarded = [False], [False]  # furniture by itself; and only if it holds no article
        self.texts: list[tuple[int, int, str]] = []  # (element, block number, text)
        self.block = 0
        self._read(source)
        self._finish()

    def _read(self, source: str) -> None:
        stack, opened = [0], {}
        at, n = 0, len(source)
        lower = None

        def pop(to: int) -> None:
            """Close the elements from place `to` of the stack on."""
            while len(stack) > to:
                t = self.tag[stack.pop()]
                opened[t] -= 1
                if t in BLOCKS:
                    self.block += 1

        def end_of(names: set, scope: set) -> None:
            if any(opened.get(x) for x in names):
                for i in range(len(stack) - 1, 0, -1):
                    t = self.tag[stack[i]]
                    if t in names:
                        pop(i)
                        return
                    if t in scope:
                        return

        for m in iter(lambda: TAG.search(source, at), None):
            if m.start() > at:
                self._text(stack[-1], source[at : m.start()])
            at = m.end()
            name = m.group(2)
            if name is None:
                continue
            if not m.group(4):  # an unclosed quote or the end of the page: the tag ends at the next >
                close = source.find(">", at)
                at = n if close < 0 else close + 1
                if close < 0:
                    break
            name = name.lower()
            if m.group(1):
                if name == "br":
                    self._text(stack[-1], " ")
                elif name == "p" and not opened.get("p"):
                    self.block += 1
                elif opened.get(name) and name not in ("html", "body"):
                    i = len(stack) - 1
                    crossed = False
                    while self.tag[stack[i]] != name:
                        crossed = crossed or self.tag[stack[i]] in BLOCKS
                        i -= 1
                    if crossed and name not in BLOCKS:  # an inline element that closes inside a block opened in it
                        del stack[i]
                        opened[name] -= 1
                    else:
                        pop(i)
                continue
            if name in ("html", "body", "head") and opened.get(name):
                continue
            if name in CLOSES_P and opened.get("p"):
                end_of({"p"}, P_SCOPE)
            if name in ENDS:
                end_of(*ENDS[name])
            if name in BLOCKS:
                self.block += 1
                if opened.get("head") and name != "head":
                    end_of({"head"}, set())
            if name == "br":
                self._text(stack[-1], " ")
            node = self._element(name, stack[-1], m.group(3))
            if name in RAW:
                lower = source.lower() if lower is None else lower
                close = _raw_end(lower, name, at)
                at = n if close < 0 else close
                stack.append(node)
                opened[name] = opened.get(name, 0) + 1
            elif name not in VOID:
                stack.append(node)
                opened[name] = opened.get(name, 0) + 1
        if at < n:
            self._text(stack[-1], source[at:])

    def _text(self, node: int, text: str) -> None:
        self.texts.append((node, self.block, html_lib.unescape(text) if "&" in text else text))

    def _element(self, name: str, parent: int, rest: str) -> int:
        attrs = {}
        if "=" in rest or rest.strip(" /\n\t"):
            for a in ATTR.finditer(rest):
                attrs.setdefault(a.group(1).lower(), html_lib.unescape(a.group(2) or a.group(3) or a.group(4) or ""))
        classes, ident = attrs.get("class", "").split(), attrs.get("id", "").strip()
        label = name
        if classes or ident:
            label += "".join(sorted({"." + DIGITS.sub("0", c.lower()) for c in classes})) + ("#" + DIGITS.sub("0", ident.lower()) if ident else "")
        words = {w.lower() for c in (*classes, ident) for w in (*WORDS.findall(c), c)} if classes or ident else set()
        sure = (name in FURNITURE_TAGS or "hidden" in attrs or attrs.get("aria-hidden") == "true" or bool(HIDING.search(attrs.get("style", "")))
                or (name in BLOCKS and bool(words & COMMENT_WORDS) and name not in ("html", "body", "main")))
        maybe = name in ("form", "header") or attrs.get("role", "").lower() in FURNITURE_ROLES or bool(words & FURNITURE_WORDS)
        self.tag.append(name)
        self.parent.append(parent)
        self.label.append(label)
        self.own.append(sure)
        self.guarded.append(maybe and name not in ("html", "body", "article", "main"))
        return len(self.tag) - 1

    def _finish(self) -> None:
        n = len(self.tag)
        self.end = list(range(1, n + 1))
        article = [t in ("article", "main") for t in self.tag]
        headline = [t == "h1" for t in self.tag]
        for i in range(n - 1, 0, -1):
            p = self.parent[i]
            self.end[p] = max(self.end[p], self.end[i])
            article[p] = article[p] or article[i]
            headline[p] = headline[p] or headline[i]
        self.dropped, self.link = [False] * n, [False] * n
        in_article = [False] * n
        for i in range(1, n):
            p, t = self.parent[i], self.tag[i]
            in_article[i] = in_article[p] or t in ("article", "main")
            drop = self.own[i] or (self.guarded[i] and not article[i] and not (t == "form" and headline[i]))
            # the headline of an article stands in its header at times
            keep = self.dropped[p] and t in _HEADINGS and in_article[i] and self.tag[p] in ("header", "hgroup") and not self._dropped_above_header(p)
            self.dropped[i] = (self.dropped[p] and not keep) or drop
            self.link[i] = self.link[p] or t == "a"

    def _dropped_above_header(self, i: int) -> bool:
        while self.tag[i] in ("header", "hgroup"):
            if self.own[i]:
                return True
            i = self.parent[i]
        return self.dropped[i]

    def path(self, i: int) -> str:
        out = []
        while i > 0:
            out.append(self.label[i])
            i = self.parent[i]
        return ">".join(reversed(out))

    def scores(self) -> dict[int, float]:
        """The score of every container that holds text which is no furniture."""
        n = len(self.tag)
        plain, linked, where = {}, {}, {}
        good, junk, any_text = [0.0] * n, [0.0] * n, [0] * n
        for node, block, text in self.texts:
            size = len(text) - sum(map(text.count, " \n\t\r"))
            if not size:
                continue
            if self.dropped[node]:
                junk[node] += size
                continue
            any_text[node] += size
            if self.link[node]:
                linked[block] = linked.get(block, 0) + size
            else:
                plain[block] = plain.get(block, 0) + size
            where.setdefault(block, node)
        for block, node in where.items():
            p, ln = plain.get(block, 0), linked.get(block, 0)
            weight = min(1.0, p / LONG_BLOCK) * p / (p + ln)
            good[node] += (p + ln) * weight
            junk[node] += (p + ln) * (1 - weight)
        for i in range(n - 1, 0, -1):
            p = self.parent[i]
            good[p] += good[i]
            junk[p] += junk[i]
            any_text[p] += any_text[i]
        all_good, all_junk = good[0] or 1.0, junk[0] or 1.0
        out = {}
        for i in range(n):
            if any_text[i] and not self.dropped[i] and (i == 0 or self.tag[i] in CONTAINERS):
                hint = 0.25 if self.tag[i] == "article" else 0.15 if self.tag[i] == "main" else 0.1 if set(WORDS.findall(self.label[i])) & GOOD_WORDS - {self.tag[i]} else 0.0
                out[i] = good[i] / all_good - 0.5 * junk[i] / all_junk + hint + 0.5  # never below 0
        return out

    def text(self, roots: list[int]) -> str:
        """The blocks under the given elements (in page order, none inside another)."""
        blocks: list[str] = []
        spans = [(r, self.end[r]) for r in roots]
        at, current, pieces = 0, None, []

        def close() -> None:
            whole = " ".join("".join(pieces).split())
            if whole:
                blocks.append(whole)
            pieces.clear()

        for node, block, text in self.texts:
            if block != current:
                close()
                current = block
            inside = any(lo <= node < hi for lo, hi in spans[at:]) if len(spans) > 1 else spans[0][0] <= node < spans[0][1]
            if inside and not self.dropped[node]:
                pieces.append(text)
        close()
        return "\n".join(blocks)


_HEADINGS = {f"h{i}" for i in range(1, 7)}


def _raw_end(lower: str, name: str, at: int) -> int:
    """Where the closing tag of a raw text element starts; -1 if there is none."""
    while True:
        at = lower.find("</" + name, at)
        if at < 0 or lower[at + len(name) + 2 : at + len(name) + 3] in ("", " ", "\t", "\n", "\r", "\f", "/", ">"):
            return at
        at += 2


def votes_of(source: str) -> list[tuple[str, float]]:
    """(path, score) of the page's containers that score at least half of its best."""
    page = Page(source)
    scores = page.scores()
    best = max(scores.values(), default=0.0)
    out: dict[str, float] = {}
    for i, s in scores.items():
        if s >= best / 2:
            p = page.path(i)
            out[p] = max(out.get(p, 0.0), s)
    return list(out.items())


def extract(source: str, paths: list[str]) -> str:
    """The page's main text, `paths` being those of its host by descending votes."""
    page = Page(source)
    scores = page.scores()
    if not scores:
        return ""
    best = max(scores.values())
    if paths:
        on_page: dict[str, list[int]] = {}
        for i in scores:
            on_page.setdefault(page.path(i), []).append(i)
        for p in paths:
            if p in on_page and max(scores[i] for i in on_page[p]) >= best / 2:
                return page.text(_outermost(page, on_page[p]))
    # of equals, the innermost
    return page.text([max(scores, key=lambda i: (scores[i], i))])


def _outermost(page: Page, nodes: list[int]) -> list[int]:
    out: list[int] = []
    for i in sorted(nodes):
        if not out or i >= page.end[out[-1]]:
            out.append(i)
    return out


def host_of(url: Column) -> Column:
    """The host of a url in lower case, without user and port; empty if it has none."""
    site = F.regexp_extract(F.coalesce(url, F.lit("")), r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#\\\s]*)", 1)
    return F.lower(F.regexp_replace(F.regexp_replace(site, r"^.*@", ""), r":[0-9]*$", ""))


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, paths): every host's paths by descending votes, of `pages` with host and html."""
    def vote(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [(h, p, s) for h, source in zip(b["host"], b["html"]) for p, s in votes_of(source)]
            yield pd.DataFrame(found, columns=["host", "path", "score"])

    votes = pages.where("host <> ''").select("host", "html").mapInPandas(vote, "host string, path string, score double")
    # rounded before they are added up, so the order of adding does not matter
    tally = votes.groupBy("host", "path").agg(F.sum(F.round(F.col("score") * 1000).cast("bigint")).alias("votes"))
    order = Window.partitionBy("host").orderBy(F.desc("votes"), F.desc(F.length("path")), "path")
    best = tally.withColumn("place", F.row_number().over(order)).where(F.col("place") <= HOST_PATHS)
    listed = F.array_sort(F.collect_list(F.struct("place", "path")))
    return best.groupBy("host").agg(F.transform(listed, lambda x: x["path"]).alias("paths"))


def main_texts(pages: DataFrame, url_col: str = "url", html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """`keep` columns, text and n_chars of every page."""
    bounded_batches(pages.sparkSession)
    kept = [F.col(c).alias(f"k{i}") for i, c in enumerate(keep)]
    rows = pages.select(*kept, host_of(F.col(url_col)).alias("host"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    # a written table: Catalyst sends it to all tasks only while it is small, else it joins by host and splits hot ones
    paths = stored_table(host_paths(rows), "host_paths")

    @F.pandas_udf("string")
    def text_of(source: pd.Series, known: pd.Series) -> pd.Series:
        return pd.Series([extract(s, [] if p is None else list(p)) for s, p in zip(source, known)], dtype=object)

    out = rows.join(paths, "host", "left").select(*(F.col(f"k{i}").alias(c) for i, c in enumerate(keep)), text_of("html", "paths").alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("bigint"))


def op11_html_extraction(spark, sf_dir: str) -> DataFrame:
    return main_texts(table(spark, sf_dir, "pages"))
