import pytest
from pyspark.sql import functions as F

from corpusmill.llm import html

CASES = [
    (None, ""),
    ("", ""),
    ("just &lt;text&gt; &amp; &eacute;&#65;&nbsp;b", "just <text> & éA b"),
    ("<p>a\n  b<br>c</p><p> <b>d</b>e </p>", "a b c\nde"),
    ("<nav>x</nav><article><h1>T</h1><p>one<p>two</article><footer>f</footer>", "T\none\ntwo"),
    ("<article><header><h1>T</h1><p>by</p></header><p>x</p><aside>s</aside></article><p>out</p>", "T\nx"),
    ("<article>a<section class='comments'><p>c</p></section></article><article class='comment'>d</article>", "a"),
    ("<script>var t='</p>';</script><style>p{}</style><p>x<!-- no --></p><form><p>f</p></form>", "x"),
    ("<article><p>a <i title='x > y'>b</i></p><p>cut &am", "a b\ncut &am"),
    ("<article><p>a</p><p", "a"),
    ("<div class='cookie-notice'>n</div><div id=\"main\"><p>1 < 2</p></div><div role='navigation'>m</div>", "1 < 2"),
    ("<main><p>m</p><div class='ad'>buy</div><ul><li>i<li>j</ul></main>", "m\ni\nj"),
    ("<!-- open <p>x</p>", ""),
    ("<main><p>lead</p><article>a long story</article><article class='teaser'>short</article></main>", "a long story"),
    ("<article><div class='post-header'><h1>T</h1><span>by X</span></div><p>x</p><div style='display: none'>no</div></article>", "T\nx"),
    ("<article>a<script>b", "a"),
]


@pytest.mark.parametrize(("page", "want"), CASES)
def test_main_text(page, want):
    assert html.main_text(page) == want


def test_what_all_pages_of_a_host_share_goes(spark):
    pages = [(i, f"https://a.org/{i}", f"<body><div><p>Share this with friends</p></div><div class='c'><p>story {i}</p><p>more {i * i}</p></div><div><p>Read on</p></div></body>") for i in range(30)]
    pages += [(100 + i, f"http://b.org/{i}", "<body><p>the same page</p></body>") for i in range(30)]  # copies are one page
    pages += [(200, None, "<p>x</p>"), (201, "nonsense", "<p>y</p>"), (202, "https://a.org/e", None), (5, pages[5][1], pages[5][2])]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    rows = html.extract(df).collect()
    assert len(rows) == len(pages)
    got = {r.page_id: r.text for r in rows}
    assert all(got[i] == f"story {i}\nmore {i * i}" for i in range(30)) and got[100] == "the same page"
    assert (got[200], got[201], got[202]) == ("x", "y", "") and all(r.n_chars == len(r.text) for r in rows)
    assert html.extract(df.limit(0)).count() == 0


def test_tables_pages(spark, sf_dir):
    """The pages' articles, cut out by their marks."""
    import re
    from html import unescape

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r.page_id: r.text for r in html.extract(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        cut = (" ".join(unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article))
        assert got[r.page_id] == "\n".join(b for b in cut if b)


def layout(i, lead, rest):
    """A page without article tags or telling classes: two layouts, each with frames of its own."""
    if i % 3:
        return f"<body><div class='u1'><p>Our site {i % 2}</p></div><div class='u2'><h1>{lead}</h1><div class='u3'>{''.join(f'<p>{x}</p>' for x in rest)}</div></div><div class='u4'><p>All rights</p></div></body>"
    return f"<body><table><tr><td class='v1'><p>Menu of a kind</p></td><td class='v2'>{''.join(f'<div>{x}</div>' for x in rest)}<p>Read more of this</p></td></tr></table></body>"


def brute_templates(pages, least_pages=3, share=0.5):
    """The classes and slots of one host, from whole occurrence vectors."""
    trees = {html: html_page(html) for html in pages}
    vectors, weights, depths = {}, {}, {}
    for page, tree in trees.items():
        slots, total = tree.slots()
        for path, n, depth, weight in slots:
            vectors.setdefault(path, {})[page] = n
            depths[path] = depth
            weights.setdefault(path, []).append((weight, total))
        for at, _, _, text in tree.blocks:
            mine = vectors.setdefault(tree.token(at, text), {})
            mine[page] = mine.get(page, 0) + 1
    valid = {t: frozenset(v) for t, v in vectors.items() if set(v.values()) == {1}}
    nodes = {t: v for t, v in valid.items() if t in depths}
    out = {}
    for page in trees:
        mine = [t for t, v in nodes.items() if page in v and (not depths[t] or sum(w for w, _ in weights[t]) >= share * sum(a for _, a in weights[t]))]
        fixed = {t for t, v in valid.items() if t not in depths and page in v and len(v) >= least_pages and v in nodes.values()}
        out[page] = max(mine, key=lambda t: (depths[t], t)), fixed
    return out


def html_page(text):
    return html.Page(text)


def test_classes_and_slots_by_brute_force(spark):
    story = lambda i, k: f"story {i} part {k} " + "words of it " * (3 + (i * 7 + k) % 5)
    pages = [layout(i, f"Title {i}", [story(i, k) for k in range(1 + i % 4)]) for i in range(24)]
    rows = [(i, f"https://c.org/{i}", p) for i, p in enumerate([*pages, pages[3]])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    known = html.templates(df.selectExpr("'c.org' host", "xxhash64(html) page", "html")).first()
    want = brute_templates(set(pages))
    for page in pages:
        tree = html.Page(page)
        mine = {tree.token(at, text) for at, _, _, text in tree.blocks}
        assert (tree.node(frozenset(known.good), frozenset(known.bad)), mine & set(known.fixed)) == want[page]
    texts = {r.page_id: r.text for r in html.extract(df).collect()}
    for i in range(24):
        rest = [" ".join(story(i, k).split()) for k in range(1 + i % 4)]
        assert texts[i] == "\n".join([f"Title {i}", *rest] if i % 3 else rest)


ODD = [
    ("<form><div class='menu-free'><article><p>a</p></article></div></form>", "a"),
    ("<article><div title='the hidden door'><p>kept?</p></div><section class='search-results'>and this</section></article>", "kept?\nand this"),
    ("<div class='content no-sidebar has-comments'><p>whole</p></div>", "whole"),
    ("<article>a<div hidden>b</div><div aria-hidden=true>c</div></article>", "a"),
]


@pytest.mark.parametrize(("page", "want"), ODD)
def test_marks_that_holders_have(page, want):
    assert html.main_text(page) == want


def test_deep_pages_take_little_memory():
    import time
    import tracemalloc

    for page in ("<div class='a b'>" * 50_000 + "x", "<div>" * 500 + "</p></span></section>" * 20_000 + "x"):
        tracemalloc.start()
        began = time.perf_counter()
        assert html.main_text(page) == "x"
        assert tracemalloc.get_traced_memory()[1] < 100e6 and time.perf_counter() - began < 20
        tracemalloc.stop()


THREAD = "<div class='discussion'>" + "".join(f"<p>Reader {k:02d}: I disagree with all of it, and here is why, at length.</p>" for k in range(8)) + "</div>"


@pytest.mark.parametrize("wrap", ["{}", "<main>{}</main>", "<main><div class='col'>{}</div></main>"])
def test_a_marked_article_never_loses_to_a_thread(spark, wrap):
    page = lambda k: "<html><body><header>Site</header>" + wrap.format(f"<article class='post'><h1>T{k}</h1><p>Short article number {k}.</p></article>{THREAD}") + "<footer>About</footer></body></html>"
    assert html.main_text(page(0)) == "T0\nShort article number 0."
    rows = spark.createDataFrame([(k, f"http://one.example/{k}", page(k)) for k in range(6)], "page_id long, url string, html string")
    assert {r.page_id: r.text for r in html.extract(rows).collect()} == {k: f"T{k}\nShort article number {k}." for k in range(6)}


def test_cards_marked_as_articles_do_not_count_as_one():
    cards = "".join(f"<article><h3>Card {k}</h3><p>Teaser {k}.</p></article>" for k in range(4))
    body = "".join(f"<p>Paragraph {k} of the long text that the page is about, word after word.</p>" for k in range(12))
    assert html.main_text(f"<body><div class='story'><h1>Title</h1>{body}</div><div class='more'>{cards}</div></body>").startswith("Title\nParagraph 0")
