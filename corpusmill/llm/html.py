"""HTML main-text extraction by equivalence-class template deduction over pages of the same host."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, written

# Fixed values of HTML: elements whose content is no text, elements that break a block, and those that hold blocks.
_RAW = "script style noscript template title textarea iframe noembed noframes xmp svg math canvas object audio video".split()
_BREAKS = "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split()
_HOLDERS = "article aside blockquote body center details dialog div dl fieldset figure footer form header main menu nav ol section select table ul button head label".split()
_VOID = "area base br col embed hr img input link meta param source track wbr".split()
# Elements that may be the region of an article, and those that mark one.
_REGIONS = "article body center details dialog div fieldset form main section table td".split()
_MARKS = "article main".split()
# Fixed values, used within the region only, and to weigh what may be the region: what is not the article's text, by element, by
# role, by words of class or id (also as part of a hyphenated name), and by whole names of class or id.
_APART = "nav aside footer menu".split()
_APART_LATER = "form button select dialog label".split()
_APART_ROLES = "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar".split()
_APART_WORDS = "nav navbar breadcrumb breadcrumbs footer sidebar ad ads adv advert adverts advertisement adsense sponsor sponsored promo cookie cookies consent gdpr newsletter subscribe paywall pagination pager comment comments commentlist disqus".split()
_APART_NAMES = "navigation menu masthead topbar aside rail widget promoted banner notice alert popup modal overlay subscription signup login social share sharing related recommended trending toolbar respond reply replies form search skip hidden".split()
#: Names that begin so tell of a holder of the article, not of what is apart.
_HOLDER_NAMES = ("no-", "has-", "with-", "without-", "is-")

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*\Z|<|[^<]+""", re.DOTALL)
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_HIDING = re.compile(r"display\s*:\s*none", re.IGNORECASE)
_RAW_SET, _BREAK_SET, _HOLDER_SET, _VOID_SET, _REGION_SET, _MARK_SET = map(frozenset, (_RAW, _BREAKS, _HOLDERS, _VOID, _REGIONS, _MARKS))
_APART_SET, _LATER_SET, _ROLE_SET, _WORD_SET, _NAME_SET = map(frozenset, (_APART, _APART_LATER, _APART_ROLES, _APART_WORDS, _APART_NAMES))
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

#: How an element stands by its marks: not apart; a header, of which headings stay; apart; apart unless that would leave
#: too little of the page.
PLAIN, HEADER, APART, LATER = 0, 1, 2, 3
#: Text within marked articles or main parts weighs so many times as much as other text where the region is chosen; if a
#: page has one article with text, nothing else weighs.
_MARKED = 4


def _kind(tag: str, attrs: str) -> tuple[str, int, bool]:
    """The path step of an element (its name and classes), how it stands, and whether it marks an article."""
    found = {}
    for name, value in _ATTR.findall(attrs) if attrs else ():
        found.setdefault(name.lower(), value.strip("\"'").lower())
    classes = found.get("class", "").split()
    step, role = ".".join([tag, *classes]), found.get("role")
    mark = tag in _MARK_SET or role in ("main", "article") or found.get("itemprop") == "articlebody"
    if "hidden" in found or found.get("aria-hidden") == "true" or _HIDING.search(found.get("style", "")) or tag in _APART_SET or role in _ROLE_SET:
        return step, APART, False
    if tag in ("html", "body", "main"):
        return step, PLAIN, mark
    names = [n for n in (*classes, *found.get("id", "").split()) if not n.startswith(_HOLDER_NAMES)]
    words = {w for n in names for w in re.split(r"[-_]+", n)}
    if tag == "article":
        return step, APART if words & {"comment", "comments", "reply"} else PLAIN, mark
    if words & _WORD_SET:
        return step, APART, False
    if tag == "header" or "header" in words:
        return step, HEADER, False
    return step, LATER if tag in _LATER_SET or not _NAME_SET.isdisjoint(names) else PLAIN, mark


def _hash(*parts: object) -> int:
    return xxhash.xxh3_64_intdigest("\0".join(map(str, parts))) - (1 << 63)


class Page:
    """A page's tree of holding elements, in page order, and its blocks of text. Element 0 is the page itself. An element
    has its name, the hash of its path, its parent, how it stands, whether it marks an article, and the number of the
    first element after it; a block has its element, whether it is a heading, how many of its characters
    are in links, and its text. Markup that is cut off or left open ends with the page. One step of the path
    is kept for each open element, so memory is in proportion to the page, however deep it is."""

    def __init__(self, html: str | None):
        self.tags, self.paths, self.parents, self.depths, self.kinds, self.marks = [""], [_hash("page")], [0], [0], [PLAIN], [False]
        self.ends: list[int] = [0]
        self.blocks: list[tuple[int, bool, int, str]] = []
        self._read(html or "")

    def _read(self, html: str) -> None:
        stack, opened = [0], Counter()
        run: list[str] = []
        linked, link, heading, skip_to = 0, False, "", 0

        def flush() -> None:
            nonlocal linked
            if run:
                text = " ".join("".join(run).split())
                run.clear()
                if text:
                    self.blocks.append((stack[-1], bool(heading), min(linked, len(text)), text))
            linked = 0

        for m in _TOKEN.finditer(html):
            if m.start() < skip_to:
                continue
            tag = m[2] or m[5]
            if tag is None:
                token = m[0]
                if token[0] != "<" or token == "<":
                    run.append(token := unescape(token))
                    linked += len(token) if link else 0
                continue
            tag = tag.lower()
            if not (m[1] or m[4]):
                attrs = m[3] if m[2] else m[6]
                if tag in _RAW_SET:
                    if not attrs.endswith("/"):
                        end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(html, m.end())
                        skip_to = end.end() if end else len(html)
                    continue
                if tag == "a":
                    link = True
                if tag == "br":
                    run.append(" ")
                if tag in _BREAK_SET or tag in _HOLDER_SET:
                    flush()
                    if tag in _HEADINGS:
                        heading = tag
                if tag in _HOLDER_SET and not attrs.endswith("/"):
                    step, kind, mark = _kind(tag, attrs)
                    up = stack[-1]
                    stack.append(len(self.tags))
                    opened[tag] += 1
                    for column, value in ((self.tags, tag), (self.paths, _hash(self.paths[up], step)), (self.parents, up), (self.depths, self.depths[up] + 1), (self.kinds, kind), (self.marks, mark), (self.ends, 0)):
                        column.append(value)
            else:
                if tag == "a":
                    link = False
                if tag in _BREAK_SET or tag in _HOLDER_SET:
                    flush()
                    if tag in _HEADINGS:
                        heading = ""
                if opened[tag] and tag in _HOLDER_SET:
                    while True:
                        at = stack.pop()
                        self.ends[at] = len(self.tags)
                        opened[self.tags[at]] -= 1
                        if self.tags[at] == tag:
                            break
        flush()
        for at in stack:
            self.ends[at] = len(self.tags)

    def cuts(self, root: int, later: bool = True) -> list[int]:
        """For the elements from `root` to its end how far marks at or above them, but below `root`, cut them off."""
        out = [PLAIN]
        for i in range(root + 1, self.ends[root]):
            kind = self.kinds[i]
            kind = (APART if later else PLAIN) if kind == LATER else kind
            out.append(max(out[self.parents[i] - root], kind))
        return out

    def _only_article(self, cut: list[int], told: list[tuple[int, int]]) -> int | None:
        """The article element, if just one that is in no other has any of the text of `told` (element, characters)."""
        outer = [None] * len(self.tags)
        for i in range(1, len(self.tags)):
            above = outer[self.parents[i]]
            outer[i] = above if above is not None else i if self.tags[i] == "article" and cut[i] == PLAIN else None
        found = {outer[at] for at, n in told if n and outer[at] is not None}
        return found.pop() if len(found) == 1 else None

    def slots(self) -> tuple[list[tuple[int, int, int, int]], int]:
        """(path, how many elements of the page have it, depth, weight of the text within) of the paths that may be an
        article's region, and the weight of all. Links, what marks set apart and what is outside of a page's only article weigh nothing; if nearly all
        is apart only by marks that holders of articles have, too, then these do not count."""
        sums = []
        for later in (True, False):
            cut, weight, marked = self.cuts(0, later), [0] * len(self.tags), [False]
            for i in range(1, len(self.tags)):
                marked.append(self.marks[i] or marked[self.parents[i]])
            told = [(at, len(text) - linked) for at, heading, linked, text in self.blocks if cut[at] == PLAIN or heading and cut[at] == HEADER]
            only = self._only_article(cut, told)
            for at, n in told:
                weight[at] += n * (_MARKED if marked[at] else 1) if only is None or only <= at < self.ends[only] else 0
            for i in range(len(self.tags) - 1, 0, -1):
                weight[self.parents[i]] += weight[i]
            sums.append((cut, weight))
        cut, weight = sums[0] if sums[0][1][0] * 4 >= sums[1][1][0] else sums[1]
        out: dict[int, tuple[int, int, int]] = {self.paths[0]: (1, 0, weight[0])}
        for i in range(1, len(self.tags)):
            if self.tags[i] in _REGION_SET and cut[i] == PLAIN:
                n, _, w = out.get(self.paths[i], (0, 0, 0))
                out[self.paths[i]] = n + 1, self.depths[i], w + weight[i]
        return [(path, *x) for path, x in out.items()], weight[0]

    def node(self, good: frozenset[int] = frozenset(), bad: frozenset[int] = frozenset(), share: float = 0.5) -> int:
        """The path of the deepest node that holds the article: one of the `good` of the page's host, or a path that
        no other page of the host has, occurs once and has `share` of the page's text."""
        slots, total = self.slots()
        return max((depth, path) for path, n, depth, weight in slots if not depth or path in good or path not in bad and n == 1 and weight >= share * total)[1]

    def region(self, path: int) -> int:
        """The element of the page at `path`, or one above: as far up as what an element has beside it is only
        headings, or is part of an inner element without marked frame parts and with less text in links than
        outside of them. An article is never left."""
        root = self.paths.index(path) if path in self.paths else 0
        held: dict[int, list[tuple[bool, int, int]]] = {}
        for at, heading, linked, text in self.blocks:
            held.setdefault(at, []).append((heading, linked, len(text)))
        while root and self.tags[root] != "article":
            up = self.parents[root]
            around = (*range(up + 1, root), *range(self.ends[root], self.ends[up]))
            cut, framed = {up: PLAIN}, self.tags[up] in ("", "html", "body")
            for i in around:  # each element is around one root only
                kind = APART if self.kinds[i] == LATER else self.kinds[i]
                cut[i] = max(cut[self.parents[i]], kind)
                framed = framed or kind == APART
            beside = [x for i in cut for x in held.get(i, ()) if cut[i] == PLAIN or x[0] and cut[i] == HEADER]
            framed = framed or 2 * sum(x[1] for x in beside) > sum(x[2] for x in beside)
            if framed and not (beside and all(x[0] for x in beside)):
                break
            root = up
        return root

    def text(self, path: int | None = None, fixed: frozenset[int] = frozenset()) -> str:
        """The blocks within the region at `path` that no mark in it sets apart and that are not `fixed`."""
        root = self.region(self.paths[0] if path is None else path)
        cut, out = self.cuts(root), []
        for at, heading, _, text in self.blocks:
            if root <= at < self.ends[root] and (cut[at - root] == PLAIN or heading and cut[at - root] == HEADER) and not (fixed and self.token(at, text) in fixed):
                out.append(text)
        return "\n".join(out)

    def token(self, at: int, text: str) -> int:
        return _hash(self.paths[at], text)


def _tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each page its tokens, with how often each occurs: paths that may be a region (depth not null), with the weight of
    the text within them and of all the page's, and blocks of text at their paths."""
    for batch in batches:
        rows = []
        for host, page, html in zip(batch["host"], batch["page"], batch["html"], strict=True):
            tree = Page(html)
            slots, total = tree.slots()
            rows += [(host, page, path, n, depth, weight, total) for path, n, depth, weight in slots]
            rows += [(host, page, token, n, None, 0, 0) for token, n in Counter(tree.token(at, text) for at, _, _, text in tree.blocks).items()]
        out = pd.DataFrame(rows, columns=["host", "page", "token", "n", "depth", "weight", "total"])
        yield out.astype({"depth": "Int64"})


def host_of(url: str = "url"):
    """Lower-case host of a URL, or the whole text where there is none; null stays null."""
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host).otherwise(F.col(url))


def templates(pages: DataFrame, least_pages: int = 3, share: float = 0.5) -> DataFrame:
    """host, good, bad (hashes of paths), fixed (hashes of blocks of text) from `pages` (host, page, html), where `page` is
    a hash of html and equal pages count as one: the host's template.

    A token's occurrence vector has its count on each page of the host. Tokens with equal vectors are an
    equivalence class; a vector is held as the xor of a hash of each page and count, so no group of pages is
    gathered. A class is valid if it occurs once on each of its pages. Its paths are nodes of the template
    and nest in each other as the page's elements do; what a node holds beside the nodes in it is its slot. The
    nodes with at least `share` of the text on the pages of their class are `good`: they are nested, so in the deepest
    on a page begin the slots of its article. `bad` are all other paths of several pages; what only one page
    has is left to that page. Blocks of text of a valid class that has a node, too, and is on `least_pages` pages or
    more, are the template's own and `fixed`. A host's row grows with the variety of its pages' structure, not with
    their number."""
    seen = pages.mapInPandas(_tokens, "host string, page long, token long, n int, depth int, weight long, total long")
    seen = seen.groupBy("host", "token", "page").agg(*[F.max(c).alias(c) for c in ("n", "depth", "weight", "total")])
    classes = seen.groupBy("host", "token").agg(F.bit_xor(F.xxhash64("page", "n")).alias("vector"), F.count("*").alias("pages"), F.max("n").alias("most"), F.sum("weight").alias("weight"), F.sum("total").alias("total"), F.max("depth").alias("depth"))
    classes = written(classes.where((F.col("pages") > 1) | F.col("depth").isNotNull()))
    valid, node = F.col("most") == 1, F.col("depth").isNotNull()
    good = node & valid & (F.col("weight") >= F.col("total") * F.lit(share))
    paths = classes.where(node & (F.col("pages") > 1)).groupBy("host").agg(F.collect_list(F.when(good, F.col("token"))).alias("good"), F.collect_list(F.when(~good, F.col("token"))).alias("bad"))
    nodes = classes.where(node & valid).select("host", "vector").distinct()
    fixed = classes.where(~node & valid & (F.col("pages") >= least_pages)).join(nodes, ["host", "vector"], "left_semi")
    return paths.join(fixed.groupBy("host").agg(F.collect_list("token").alias("fixed")), "host", "left")


def main_text(html: str | None) -> str:
    """The main text of a page that stands alone: every path that occurs once is a node."""
    tree = Page(html)
    return tree.text(tree.node())


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for each row of `pages` (page_id, url, html; others are ignored).

    Null or empty html gives an empty text. Repeated rows give a row each. Pages of unknown host (a null
    url) stand alone. An empty table gives an empty one. Each page is parsed whole in its task; html moves only
    where the hosts' templates are too large for Spark to broadcast."""
    small_batches(pages.sparkSession)
    pages = pages.select("page_id", "url", "html", host_of().alias("host"))
    known = written(templates(pages.where(F.col("host").isNotNull()).select("host", F.xxhash64("html").alias("page"), "html")))
    pages = pages.join(known, "host", "left").select("page_id", "url", "html", "good", "bad", "fixed")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        some = lambda x: frozenset(x) if x is not None else frozenset()
        for batch in batches:
            texts = []
            for html, good, bad, fixed in zip(batch["html"], batch["good"], batch["bad"], batch["fixed"], strict=True):
                tree = Page(html)
                texts.append(tree.text(tree.node(some(good), some(bad)), some(fixed)))
            yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    return pages.mapInPandas(run, f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long")
