"""Main text of web pages by nearest-URL differencing.

1. A page is parsed into *lines*, the texts of its blocks in page order, each with the
   region it stands in: the article, a part that its tag or class names as
   not text (menu, footer, advert, comments, ...), or anything else.
2. Pages are ordered by host and URL path.  Each is paired with the neighbour whose path
   shares the longest beginning with its own (the one before it, if both do).
3. Their lines are aligned by a longest common subsequence; shared lines are the site's
   template and go.  A pair that shares more than half of the text that could be
   either page's content (and over nine tenths of its article, if it has one) is two
   copies of one page: the other neighbour is taken then, or none.
4. The markup corrects the result where it is beyond doubt: lines of the article go back
   in even if the neighbour quotes them (but not what both neighbours hold), and named
   boilerplate goes even if it is unlike the neighbour's.  A class that only qualifies
   (``has-sidebar``, ``comments-open``) names nothing.  Lines outside the article
   stay if the neighbour doesn't share them.

Ordering needs no task per host or path: a sample of pages, drawn by their bytes
(``KEYS_PER_PART`` per part), cuts the global (host, path, page, url) order into parts of
about ``PART_BYTES`` or less, every page goes to its part, and the first and last page
of each part are sent to the neighbouring parts too.  So the cuts don't influence
the result; only rows with one page id and one url stay together.

Defined cases: null or empty html has the empty text; a null url has an empty host and
path (such pages neighbour each other); equal rows are equal neighbours and so
copies; unclosed tags, comments and scripts end with the page; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm.common import bucket_count, only, total_bytes
from ledgerlift.llm.url_filter import url_parts

# Fixed tag and class words.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|iframe|svg|math|object|select|textarea|title|button)"
    r"(?=[\s/>])(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*\"|'[^']*'|[\"'])*?)>"
    r"|<[!?][^>]*(?:>|\Z)", re.DOTALL | re.IGNORECASE)
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt
fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav
ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNTRACKED = frozenset("p li dt dd tr td th option h1 h2 h3 h4 h5 h6 html body hr thead tbody tfoot".split())
BOILERPLATE_TAGS = frozenset("nav footer aside form menu dialog head search".split())
BOILERPLATE_WORDS = frozenset("""ad ads adv advert adverts advertisement advertising banner banners breadcrumb
breadcrumbs comment comments consent cookie cookies disqus footer gdpr menu modal nav navbar navigation newsletter
notice notices overlay pager pagination paywall popup promo promoted promotion related replies reply
respond share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar widget""".split())
# Words that make a class a statement about a page or its layout.
MODIFIERS = frozenset("""can category closed disabled enabled format has have is js layout no non not open opened
tag tagged with without""".split())
ATTRIBUTE = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
WORD = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

OTHER, ARTICLE, BOILERPLATE = range(3)
KEYS_PER_PART = 16
PARTS_PER_PARTITION = 4
PART_BYTES = 8 << 20
PAGE_BYTES = 1 << 10          # what a page counts besides its html


def region(tag: str, attrs: str, outer: int) -> int:
    """The region inside a new element."""
    if tag == "main":
        return ARTICLE
    if outer == BOILERPLATE or tag in BOILERPLATE_TAGS or (tag == "header" and outer != ARTICLE):
        return BOILERPLATE
    if attrs:
        for m in ATTRIBUTE.finditer(attrs):
            for name in (m[1] or m[2] or m[3] or "").split():
                found = WORD.findall(CAMEL.sub(" ", name).lower())
                if not BOILERPLATE_WORDS.isdisjoint(found) and MODIFIERS.isdisjoint(found):
                    return BOILERPLATE
    return ARTICLE if tag == "article" else outer


def page_lines(page: str | None) -> list[tuple[str, int]]:
    """``(text, region)`` of each block with text, in page order."""
    if not page:
        return []
    lines: list[tuple[str, int]] = []
    stack: list[tuple[str, int]] = []
    here, pieces, at = OTHER, [], 0

    def flush():
        text = "".join(pieces)
        pieces.clear()
        text = " ".join((html.unescape(text) if "&" in text else text).split())
        if text:
            lines.append((text, here))
    for m in TOKEN.finditer(page):
        if m.start() > at:
            pieces.append(page[at:m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue  # a comment, a declaration, or an element without text
        tag = tag.lower()
        if tag == "br":
            pieces.append(" ")
        if tag not in BLOCKS:
            continue
        flush()
        if tag in UNTRACKED or tag in VOID:
            if tag == "body" and not m["close"]:
                stack, here = [], OTHER  # an unclosed head ends here
            continue
        if not m["close"]:
            stack.append((tag, here))
            here = region(tag, m["attrs"], here)
        else:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    here = stack[i][1]
                    del stack[i:]
                    break
    pieces.append(page[at:])
    flush()
    return lines


def common_lines(a: list, b: list) -> list[bool]:
    """Which lines of ``a`` lie on a longest common subsequence with ``b`` (Hunt and Szymanski)."""
    mark = [False] * len(a)
    lo, hi_a, hi_b = 0, len(a), len(b)
    while lo < min(hi_a, hi_b) and a[lo] == b[lo]:
        mark[lo] = True
        lo += 1
    while hi_a > lo and hi_b > lo and a[hi_a - 1] == b[hi_b - 1]:
        hi_a, hi_b = hi_a - 1, hi_b - 1
        mark[hi_a] = True
    places: dict = {}
    for j in range(hi_b - 1, lo - 1, -1):  # descending, so one line is used once
        places.setdefault(b[j], []).append(j)
    ends: list[int] = []        # smallest end in b of a common subsequence of each length
    chain: list[tuple] = []     # its last match, linked backwards
    for i in range(lo, hi_a):
        for j in places.get(a[i], ()):
            k = bisect_left(ends, j)
            link = (i, chain[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                chain.append(link)
            elif j < ends[k]:
                ends[k], chain[k] = j, link
    link = chain[-1] if chain else None
    while link:
        mark[link[0]] = True
        link = link[1]
    return mark


def _shared_start(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def main_text(lines: list[tuple[str, int]], neighbours: list[list[tuple[str, int]]]) -> str:
    """Lines left after differencing with the first neighbour that isn't a copy, and the exact check."""
    texts, has_article = [t for t, _ in lines], any(r == ARTICLE for _, r in lines)

    def share(mark, *regions):
        """Tenths of the text in these regions that are marked, rounded up."""
        sizes = [(len(t), m) for (t, r), m in zip(lines, mark, strict=True) if r in regions]
        return -(-10 * sum(n for n, m in sizes if m) // max(sum(n for n, _ in sizes), 1))
    shared, marks = None, []
    for other in neighbours:
        mark = common_lines(texts, [t for t, _ in other])
        copy = share(mark, OTHER, ARTICLE) > 5
        if not copy:
            marks.append(mark)
        # what lies outside an article of its own is template, even if much of the article is quoted
        if shared is None and (not copy or has_article and share(mark, ARTICLE) <= 9):
            shared = mark
    shared = shared or [False] * len(lines)
    by_all = [all(m) for m in zip(*marks, strict=True)] if len(marks) > 1 else [False] * len(lines)
    return "\n\n".join(t for (t, r), m, every in zip(lines, shared, by_all, strict=True)
                       if r != BOILERPLATE and not (every if r == ARTICLE else m))


def _part_of(bounds):
    """mapInArrow: (page, url, host, path) -> part, key fields."""
    def run(batches):
        for batch in batches:
            yield batch.append_column("part", pa.array([bisect_right(bounds, _null_safe(k)) for k in _keys(batch)],
                                                       pa.int32()))
    return run


def _keys(batch) -> list[tuple]:
    return list(zip(*(batch.column(c).to_pylist() for c in ("host", "path", "page", "url")), strict=True))


def _place(bounds, edges):
    """mapInArrow: pages with html -> their part, and edge pages also the neighbouring parts."""
    def run(batches):
        for batch in batches:
            keys = [_null_safe(k) for k in _keys(batch)]
            part = [bisect_right(bounds, k) for k in keys]
            take, to, guest = list(range(len(part))), list(part), [False] * len(part)
            for i, k in enumerate(keys):
                for place, other in edges.get(part[i], ()):
                    if place == k:
                        take.append(i)
                        to.append(other)
                        guest.append(True)
            for lo in range(0, len(take), 500):
                some = batch.take(pa.array(take[lo:lo + 500]))
                yield some.append_column("part", pa.array(to[lo:lo + 500], pa.int32())) \
                    .append_column("guest", pa.array(guest[lo:lo + 500]))
    return run


def _null_safe(key) -> tuple:
    """An order of (host, path, page, url) with nulls first."""
    host, path, page, url = key
    return host, path, page is not None, page or 0, url is not None, url or ""


def _extract(table: pa.Table) -> pa.Table:
    """applyInArrow, one part: the main text of its own pages."""
    rows = sorted(table.to_pylist(), key=lambda r: _null_safe((r["host"], r["path"], r["page"], r["url"])))
    parsed: list = [None] * len(rows)

    def lines(i):
        if parsed[i] is None:
            parsed[i] = page_lines(rows[i]["html"])
        return parsed[i]
    out = {"page": [], "url": [], "text": []}
    for i, row in enumerate(rows):
        if row["guest"]:
            continue
        near = [j for j in (i - 1, i + 1) if 0 <= j < len(rows) and rows[j]["host"] == row["host"]]
        near.sort(key=lambda j: -_shared_start(rows[j]["path"], row["path"]))  # stable: the one before first
        out["page"].append(row["page"])
        out["url"].append(row["url"])
        out["text"].append(main_text(lines(i), [lines(j) for j in near]))
        if i > 1:
            parsed[i - 2] = None
    return pa.table({"page": pa.array(out["page"], pa.int64()), "url": pa.array(out["url"], pa.string()),
                     "text": pa.array(out["text"], pa.string())})


def cuts(rows: DataFrame) -> list[tuple]:
    """Where parts begin in the (host, path, page, url) order: quantiles of a bounded sample of pages,
    drawn without replacement in proportion to their bytes.  For the cuts only."""
    weight = F.coalesce(F.octet_length("html"), F.lit(0)) + PAGE_BYTES
    parts = PARTS_PER_PARTITION * bucket_count(rows, total_bytes(rows, F.col("html")),
                                               PARTS_PER_PARTITION * PART_BYTES)
    sample = (rows.select("host", "path", "page", "url", (-F.log(1 - F.rand(1)) / weight).alias("draw"))
              .orderBy("draw").limit(parts * KEYS_PER_PART).collect())
    keys = sorted(_null_safe((r["host"], r["path"], r["page"], r["url"])) for r in sample)
    return sorted({keys[i * len(keys) // parts] for i in range(1, parts)}) if keys else []


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                 html_col: str = "html") -> DataFrame:
    """``id_col, url_col, text, n_chars`` of every page."""
    rows = only(pages, page=id_col, url=url_col, html=html_col).withColumn("page", F.col("page").cast("long"))
    host, path = url_parts(F.col("url"))
    rows = rows.withColumns({"host": host, "path": path})
    names = rows.select("page", "url", "host", "path")
    bounds = cuts(rows)
    # first and last page of each part: one row per part
    ends = (names.mapInArrow(_part_of(bounds), "page long, url string, host string, path string, part int")
            .withColumn("key", F.struct("host", "path", F.col("page").isNotNull().alias("p"), "page",
                                        F.col("url").isNotNull().alias("u"), "url"))
            .groupBy("part").agg(F.min("key").alias("low"), F.max("key").alias("high")).orderBy("part").collect())
    edges: dict[int, list] = {}
    for before, after in zip(ends, ends[1:]):
        for row, place, other in ((before, "high", after["part"]), (after, "low", before["part"])):
            k = row[place]
            edges.setdefault(row["part"], []).append(
                (_null_safe((k["host"], k["path"], k["page"], k["url"])), other))
    placed = rows.mapInArrow(_place(bounds, edges), "page long, url string, html string, host string, "
                             "path string, part int, guest boolean")
    texts = placed.groupBy("part").applyInArrow(_extract, "page long, url string, text string")
    return texts.select(F.col("page").alias(id_col), F.col("url").alias(url_col), "text",
                        F.length("text").cast("long").alias("n_chars"))
