import random
from collections import Counter

from ledgerlift.llm import page_text as P

SCHEMA = "page_id long, url string, html string, page string, host string, text string, part string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * 4) for r in rows], SCHEMA)


def texts(df):
    return {(r.page_id, r.url): r.text for r in P.extract_text(df).collect()}


def text(page, *near):
    return P.main_text(P.page_lines(page), [P.page_lines(n) for n in near])


def test_blocks_and_references():
    assert text(None) == text("") == text("<!-- only -->") == ""
    assert text("<p>a&amp;b <b>c</b>d<br>e&nbsp;&eacute;\n\t f<p>next") == "a&b cd e é f\n\nnext"
    assert text("plain & text < 3 <i>x</i>") == "plain & text < 3 x"
    assert text("<script>var a='<p>no</p>';</script><style>p{}</style><P CLASS='x>y'>yes</P><script>open") == "yes"
    assert text("<p>cut <!-- a > b --> here<!-- never closed <p>no") == "cut here"


def test_named_boilerplate_and_the_article():
    page = ("<head><title>t</title></head><body><header>site</header><nav><ul><li>menu</ul></nav>"
            "<div class='ad-banner'>buy<div>more</div></div><article><header><h1>Title</h1></header><p>One.<p>Two."
            "<aside>see also</aside><div id=userComments><p>nice</div><p>Three.</article>"
            "<form><p>mail</form><section class=comments><article><p>first!</article></section><footer>end</footer>")
    assert text(page) == "Title\n\nOne.\n\nTwo.\n\nThree."


def test_lines_shared_with_the_neighbour_go():
    def page(body):
        return f"<div>Site name</div><div><p>Welcome all</p>{body}<p>Imprint</p></div>"
    a, b = page("<p>first long text of this page</p><p>and more of it</p>"), page("<p>quite another one, long enough</p>")
    assert text(a, b) == "first long text of this page\n\nand more of it"
    assert text(b, a) == "quite another one, long enough"
    # a copy is no template: the other neighbour decides
    assert text(a, a, b) == text(a, b)
    assert text(a, a) == text(a)
    # what the article itself holds stays, even if the neighbour quotes it
    c, d = ("<p>menu</p><article><p>" + x + "</p><p>the same quotation</p></article>" for x in ("one text", "other"))
    assert text(c, d) == "one text\n\nthe same quotation"


def lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in reversed(range(len(a))):
        for j in reversed(range(len(b))):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
    return best[0][0]


def test_longest_common_subsequence():
    rnd = random.Random(1)
    for _ in range(500):
        a, b = ([rnd.randint(0, 4) for _ in range(rnd.randint(0, 12))] for _ in range(2))
        common = [x for x, m in zip(a, P.common_lines(a, b)) if m]
        rest = iter(b)
        assert len(common) == lcs(a, b) and all(x in rest for x in common)


def brute(rows):
    """Neighbours in the whole (host, path, page, url) order."""
    from tests.llm.test_url_filter import parts

    rows = sorted(({"page": p, "url": u, "html": h, "host": parts(u)[0], "path": parts(u)[1]} for p, u, h in rows),
                  key=lambda r: P._null_safe((r["host"], r["path"], r["page"], r["url"])))
    out = Counter()
    for i, r in enumerate(rows):
        near = [rows[j] for j in (i - 1, i + 1) if 0 <= j < len(rows) and rows[j]["host"] == r["host"]]
        near.sort(key=lambda n: -P._shared_start(n["path"], r["path"]))
        out[r["page"], r["url"], text(r["html"], *(n["html"] for n in near))] += 1
    return out


def test_every_page_meets_its_neighbours_across_parts(spark, monkeypatch):
    """One hot host, many parts: the cuts don't change what a page is compared with."""
    monkeypatch.setattr(P, "KEYS_PER_PART", 3)
    rnd = random.Random(4)
    rows = []
    for i in range(300):
        host = "hot.net" if i % 3 == 0 else f"h{rnd.randint(0, 40)}.net"
        body = "".join(f"<p>{rnd.choice('abcdefgh')} line {rnd.randint(0, 30)}</p>" for _ in range(6))
        rows.append((i, f"http://{host}/{rnd.randint(0, 60)}/x{i % 7}", f"<div>{host} menu</div>{body}"))
    rows += [(None, None, "<p>no url</p>"), (None, None, None), (7, "", "<p>x"), (8, "http://one.net/", "<p>alone")]
    rows += rows[10:13]
    got = Counter((r.page_id, r.url, r.text) for r in P.extract_text(frame(spark, rows).repartition(5)).collect())
    assert got == brute(rows)


def test_tables(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = [tuple(r) for r in pages.select("page_id", "url", "html").collect()]
    got = P.extract_text(pages).collect()
    assert Counter((r.page_id, r.url, r.text) for r in got) == brute(rows)
    assert all(r.n_chars == len(r.text) for r in got)
    html = {p: h for p, _, h in rows}
    for r in got:  # the article's paragraphs, all of them
        assert r.text.count("\n\n") + 1 == len(P.page_lines(html[r.page_id].split("<article>")[1].split("</article>")[0]))


def test_no_rows(spark):
    assert P.extract_text(frame(spark, [])).collect() == []


def test_differencing_decides_beside_and_inside_articles():
    def page(body, teaser):
        return f"<div>Site name</div><div>{body}</div><article><p>teaser {teaser}</p></article><div>Imprint</div>"
    a, b = page("<p>the long main text of this page</p>", "one"), page("<p>quite another main text, long enough</p>", "two")
    assert text(a, b) == "the long main text of this page\n\nteaser one"
    # a site line inside the article that both neighbours hold
    c, d, e = (f"<article><p>{x} text of the page, long enough</p><p>Share this now</p></article>" for x in ("one", "two", "third"))
    assert text(c, d, e) == "one text of the page, long enough"


def test_modifier_classes_name_no_boilerplate():
    assert text("<div class='page has-sidebar'><article class='post comments-open tag-social'><p>kept</p></article>"
                "<div class='sidebar'>gone</div></div>") == "kept"
    assert text("<div id=sidebarLeft><main><p>kept</p></main></div><div class='share-links open'>gone</div>") == "kept"


def test_a_hot_path_and_large_pages_span_parts(spark):
    """One path with most rows, and one with most bytes: no part holds much more than its share."""
    from pyspark.sql import functions as F

    rows = [(i, f"http://one.net/index.php?id={i}", f"<div>menu</div><p>text {i}</p>") for i in range(3000)]
    rows += [(i, f"http://two.net/index.php?id={i}", f"<div>menu</div><p>{'long ' * 2000}{i}</p>") for i in range(600)]
    rows += [(i, None, f"<p>no url {i}</p>") for i in range(1000)]
    df = frame(spark, rows).repartition(5)
    host, path = P.url_parts(F.col("url"))
    keyed = df.select(F.col("page_id").alias("page"), "url", "html").withColumns({"host": host, "path": path})
    bounds = P.cuts(keyed)
    loads = Counter()
    for p, u, h in rows:
        key = P._null_safe(("" if u is None else u[7:14], "" if u is None else "/index.php", p, u))
        loads[P.bisect_right(bounds, key)] += len(h) + P.PAGE_BYTES
    assert max(loads.values()) < 3 * sum(loads.values()) / 32
    got = Counter((r.page_id, r.url, r.text) for r in P.extract_text(df).collect())
    assert got == brute(rows)
