"""HTML extraction by consensus host paths.

Each page is parsed leniently into block texts under their elements; menus,
headers, footers, sidebars, notices, adverts, forms, comments and hidden parts
are cut by tag, role and class words.  A cut by class word, role, form or header
spares an element that holds most of the page's running text, unless main text
stands outside it (a page in one form, a layout named after its sidebar).
Containers are scored by the running text they hold (links count against it,
distance discounts it).  A page votes for the generalised tag-class paths of its
best containers; Spark averages the votes per host and path over the pages that
have it; every page meets the votes for its own paths and is extracted again
from the best-voted one.  A page
without any of its host's paths uses its own best container.  Where much running
text lies elsewhere, it is extracted too, unless the host's pages show it to be
beside the main text.

A path is a chained 64-bit hash, so a page costs its size however deep it nests.
Votes are combined map-side, and pages meet them in a join by path: nothing is
gathered per host, and no number of paths is cut.

Results by case: null and empty html give an empty text; a null or odd url
belongs to the host ""; repeated rows are extracted once each; ties between
paths go to the smaller hash; an empty table gives no rows; other columns are
ignored.  Pages are parsed whole, in time linear in their length; a ``br`` is
white space, table rows are blocks.
"""

from __future__ import annotations

import hashlib
import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import importable, materialize

# HTML element classes
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template svg math".split())
_BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
                   "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary "
                   "table tbody tfoot thead tr caption ul".split())
_CLOSES_P = _BLOCK - {"body", "html", "tr", "tbody", "thead", "tfoot", "caption", "li", "dd", "dt"}
_SELF = {"li": ("ul", "ol", "menu"), "dd": ("dl",), "dt": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"),
         "option": ("select",), "p": ("body", "div", "article", "section", "main", "td", "li", "blockquote")}
_CUT_TAGS = frozenset("nav footer aside button select menu dialog head object canvas audio video input label".split())
_CUT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
# Words of class and id names
_CUT_WORDS = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promoted promotion "
                       "cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup "
                       "login social share sharing related recommended recommendations sidebar menu nav navbar navigation "
                       "breadcrumb breadcrumbs footer widget widgets "
                       "toolbar pagination pager copyright disclaimer alert skip hidden topbar teaser teasers banner".split())
_COMMENT_WORDS = frozenset("comments comment commentlist disqus respond replies".split())  # never spared
_HEAD_WORDS = frozenset("header masthead".split())
_NOT_AFTER = frozenset("with has no without".split())
_GOOD_WORDS = frozenset("article content entry main post story text body page".split())
_HOLDERS = frozenset("article main section div td body blockquote center".split())

_NAME = re.compile(r"/?[a-zA-Z][^\s/><]*")
_SPECIAL = re.compile(r"[>\"']")
_ATTR = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORDS = re.compile(r"[a-z]+")
_HOST = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class _Node:
    """An element: its path's hash, whether it is cut (``hard``: with all it holds; ``soft``: unless
    spared), the nearest block around it and, of a block, the inline elements open in it by tag."""
    __slots__ = ("tag", "name", "parent", "hard", "soft", "in_main", "good", "depth", "link", "key", "block", "inline")

    def __init__(self, tag, name, parent, hard=False, soft=False, in_main=False, good=False):
        self.tag, self.name, self.parent, self.hard, self.soft, self.in_main = tag, name, parent, hard, soft, in_main
        self.depth = parent.depth + 1 if parent else 0
        self.good = good or bool(parent and parent.good)
        self.link = tag == "a" or bool(parent and parent.link)
        self.key = int.from_bytes(hashlib.blake2b(f"{parent.key}>{name}".encode("utf-8", "surrogatepass"), digest_size=8).digest(),
                                  "big", signed=True) if parent else 0
        self.inline = {}
        self.block = self if parent is None or tag in _BLOCK or tag in ("td", "th") else parent.block


def _open(tag: str, attrs: str, parent: _Node) -> _Node:
    hard, soft, main = parent.hard or tag in _CUT_TAGS, tag == "form", parent.in_main or tag in ("article", "main")
    name, good = tag, False
    if attrs:
        got = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(attrs)}
        cls, ident = got.get("class", ""), got.get("id", "")
        if cls:  # the first class, numbers generalised
            name = f"{tag}.{re.sub(r'[0-9]+', '#', cls.split()[0])}" if cls.split() else tag
        if tag not in ("html", "body") and not hard:
            words = _WORDS.findall(_CAMEL.sub(" ", f"{cls} {ident}").lower())
            for before, w in zip(["", *words], words):
                if before not in _NOT_AFTER:
                    hard = hard or w in _COMMENT_WORDS
                    soft = soft or w in _CUT_WORDS or (w in _HEAD_WORDS and not main)
            good = any(w in _GOOD_WORDS for w in words) and not soft
            style = got.get("style", "").replace(" ", "").lower()
            soft = (soft or got.get("role", "").lower() in _CUT_ROLES or "hidden" in got
                    or got.get("aria-hidden", "").lower() == "true" or "display:none" in style or "visibility:hidden" in style)
    if tag == "header" and not parent.in_main:
        soft = True
    return _Node(tag, name, parent, hard, soft, main, good)


class _Tokens:
    """(text before, "/" or "", tag, attributes) in order, in time linear in the page: where no end of a tag
    follows, its ``<`` is text; an end inside quotes counts only if no other does.  Comments have no tag."""

    def __init__(self, page: str):
        self.page, self.at, self.start = page, 0, 0

    def skip(self, to: int) -> None:
        self.at = self.start = to

    def __iter__(self):
        page, size = self.page, len(self.page)
        open_ended = False  # no ">" from here on
        failed: set[int] = set()  # opening quotes from which no end of a tag is reached
        while True:
            lt = page.find("<", self.at)
            if lt < 0 or lt + 1 >= size:
                yield page[self.start:], "", "", ""
                return
            begin = self.start
            if page[lt + 1] in "!?":
                comment = page.startswith("<!--", lt)
                end = page.find("-->", lt + 4) if comment else page.find(">", lt)
                self.skip(size if end < 0 else end + (3 if comment else 1))
                yield page[begin:lt], "", "", ""
                continue
            m = _NAME.match(page, lt + 1)
            # not a tag, or another one begins within its name: this "<" is text
            if m is None or open_ended or page[m.end():m.end() + 1] == "<":
                self.at = lt + 1
                continue
            p, seen, end = m.end(), [], -1
            while (q := _SPECIAL.search(page, p)) is not None:
                if q[0] == ">":
                    end = q.start()
                    break
                if q.start() in failed:
                    break
                seen.append(q.start())
                p = page.find(q[0], q.end()) + 1
                if not p:
                    break
            if end < 0:
                failed.update(seen)
                end = page.find(">", m.end())
                if end < 0:
                    open_ended = True
                    self.at = lt + 1
                    continue
            self.skip(end + 1)
            yield page[begin:lt], "/" if m[0][0] == "/" else "", m[0].lstrip("/").lower(), page[m.end():end]


def parse(page: str) -> list[tuple[_Node, str, int]]:
    """(element, text, characters in links) of every kept block, in page order."""
    root = _Node("", "", None)
    top, blocks = root, []
    pieces: list[str] = []
    owner, linked = root, 0
    low = None
    open_blocks: dict[str, int] = {}

    def flush():
        nonlocal pieces, linked
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                blocks.append((owner, text, min(linked, len(text))))
        pieces, linked = [], 0

    def put(s):
        nonlocal owner, linked
        if s and not top.hard:
            if not pieces:
                owner = top.block
            pieces.append(s)
            if top.link:
                linked += len(s.strip())

    def leave(n):
        """Close all up to and with n."""
        nonlocal top
        while True:
            m, top = top, top.parent
            if m.block is m:
                open_blocks[m.tag] -= 1
            else:
                m.block.inline[m.tag] -= 1
            if m is n:
                return

    size = len(page)
    tokens = _Tokens(page)
    for text, closing, tag, attrs in tokens:
        put(text)
        if not tag:
            continue
        is_block = tag in _BLOCK
        if closing:
            if is_block:
                flush()
            if is_block or tag in ("td", "th"):
                if open_blocks.get(tag):
                    n = top.block
                    while n.tag != tag:
                        n = n.parent.block
                    leave(n)
            elif top.block.inline.get(tag):  # an inline end tag doesn't close blocks
                n = top
                while n.tag != tag:
                    n = n.parent
                leave(n)
        elif tag in _RAW:
            low = page.lower() if low is None else low
            at = tokens.at
            if len(low) != size:  # lower-casing changed lengths: search the text itself
                e = re.compile(rf"</{re.escape(tag)}", re.I).search(page, at)
                end = e.start() if e else -1
            else:
                end = low.find(f"</{tag}", at)
            tokens.skip(size if end < 0 else (page.find(">", end) + 1 or size))
        else:
            if tag in ("br", "td", "th"):
                put(" ")
            elif is_block:
                flush()
            if not (tag in _VOID or attrs.rstrip().endswith("/") and not is_block):
                n = top.block
                if tag in _CLOSES_P and n.tag == "p" or tag == "p" and n.tag == "p":
                    leave(n)
                elif tag in _SELF:
                    bounds = _SELF[tag]
                    if tag == "option":
                        n = top if top.tag == "option" else root
                    while n.parent is not None and n.tag != tag:
                        if n.tag in bounds or n.tag in _BLOCK and n.tag != "p" or n.tag in ("td", "th") and tag not in ("td", "th", "tr"):
                            n = root
                            break
                        n = n.parent.block
                    if n.parent is not None:
                        leave(n)
                top = _open(tag, attrs, top)
                if top.block is top:
                    open_blocks[tag] = open_blocks.get(tag, 0) + 1
                else:
                    top.block.inline[tag] = top.block.inline.get(tag, 0) + 1
    flush()
    return _kept(blocks)


def _ancestry(blocks) -> list[_Node]:
    """The elements of the blocks and all around them, inner ones first."""
    seen: dict[int, _Node] = {}
    for n, _, _ in blocks:
        while n is not None and id(n) not in seen:
            seen[id(n)] = n
            n = n.parent
    return sorted(seen.values(), key=lambda n: -n.depth)


def _held(blocks, nodes) -> dict[int, int]:
    """The running text in each element."""
    held = dict.fromkeys(map(id, nodes), 0)
    for n, text, linked in blocks:
        held[id(n)] += running(text, linked)
    for n in nodes:
        if n.parent is not None:
            held[id(n.parent)] += held[id(n)]
    return held


def _kept(blocks, most: float = 0.5):
    """The blocks outside cut elements.  An element with ``most`` of the page's running text is not
    cut, unless main text (in an article, main or container so named) stands outside all cut ones."""
    nodes = _ancestry(blocks)
    if not any(n.soft for n in nodes):
        return blocks
    under: dict[int, bool] = {}
    for n in reversed(nodes):
        under[id(n)] = n.soft or n.parent is not None and under[id(n.parent)]
    if not any((n.in_main or n.good) and not under[id(n)] and running(t, k) for n, t, k in blocks):
        held = _held(blocks, nodes)
        total = sum(running(t, k) for _, t, k in blocks)
        for n in reversed(nodes):
            soft = n.soft and not (total and held[id(n)] >= most * total)
            under[id(n)] = soft or n.parent is not None and under[id(n.parent)]
    return [b for b in blocks if not under[id(b[0])]]


def best_containers(blocks, most: int = 3) -> list[tuple[int, float]]:
    """(path, score) of the best containers of a page; scores sum to 1 at most."""
    nodes = _ancestry(blocks)
    score = dict.fromkeys(map(id, nodes), 0.0)
    for n, text, linked in blocks:
        score[id(n)] += len(text) - 2.0 * linked
    by_path: dict[int, float] = {}
    for n in nodes:  # the page itself holds what no element does
        s = score[id(n)]
        if n.tag in _HOLDERS or n.parent is None:
            mine = s * (1.6 if n.tag in ("article", "main") else 0.6 if n.tag in ("body", "") else 1.25 if n.good else 1.0)
            if mine > 0:
                by_path[n.key] = by_path.get(n.key, 0.0) + mine
            s *= 0.85
        if n.parent is not None:
            score[id(n.parent)] += s
    top = sorted(by_path.items(), key=lambda x: (-x[1], x[0]))[:most]
    total = sum(s for _, s in top)
    return [(p, s / total) for p, s in top]


def within(blocks, paths) -> list[bool]:
    """Of every block, whether it is under an element with one of the paths."""
    paths, known = set(paths), {}
    for n in reversed(_ancestry(blocks)):
        known[id(n)] = n.key in paths or n.parent is not None and known[id(n.parent)]
    return [known[id(n)] for n, _, _ in blocks]


def running(text: str, linked: int) -> int:
    """Characters outside links, of a block that is not mostly links."""
    return len(text) - linked if 2 * linked <= len(text) else 0


def shares(blocks) -> dict[int, float]:
    """The share of the page's running text under each path of a container."""
    nodes = _ancestry(blocks)
    held = _held(blocks, nodes)
    total = sum(running(t, k) for _, t, k in blocks)
    # of nested elements with one path, the outer one counts; sums over one page don't exceed it
    out: dict[int, float] = {}
    for n in nodes:
        if n.tag in _HOLDERS and n.parent is not None:
            out[n.key] = out.get(n.key, 0.0) + held[id(n)]
    return {p: min(1.0, r / total) for p, r in out.items()} if total else {}


def extract(page: str | None, host_paths, least_share: float = 0.3, whole=(), minor=(), most_left: float = 0.1) -> str:
    """Main text: blocks under the best-voted path of the host that holds a fair
    share of the page's text, or under the page's own best container.  If more
    than ``most_left`` of the running text is elsewhere, those blocks are main
    text too, but for what the host's pages show to be beside it: blocks under
    one of its ``minor`` paths, where the path taken is a ``whole`` one."""
    if not page:
        return ""
    blocks = parse(page)
    total, main = sum(len(t) for _, t, _ in blocks), None
    for path in host_paths or ():
        got = sum(len(t) for (_, t, _), x in zip(blocks, within(blocks, [path])) if x)
        if got and got >= least_share * total:
            main = path
            break
    if main is None:
        own = best_containers(blocks, 1)
        main = own[0][0] if own else 0
    inside = within(blocks, [main])
    text = sum(running(t, k) for _, t, k in blocks)
    if text and sum(running(t, k) for (_, t, k), x in zip(blocks, inside) if not x) > most_left * text:
        beside = within(blocks, minor or ()) if main in (whole or ()) else [False] * len(blocks)
        inside = [x or (not y and running(t, k) > 0) for (_, t, k), x, y in zip(blocks, inside, beside)]
    return "\n\n".join(t for (_, t, _), x in zip(blocks, inside) if x)


def host_of(url: str | None) -> str:
    m = _HOST.match(url or "")
    return m[1].lower().removeprefix("www.") if m else ""


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                  whole_share: float = 0.8, minor_share: float = 0.2) -> DataFrame:
    """(page_id, url, text) of every page.

    Over a host's pages (three at least), a path that holds ``whole_share`` of
    the running text on average is the whole main text, and one that holds less
    than ``minor_share`` is minor."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = pages.sparkSession
    importable(spark)
    src = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"),
                       F.col(f"`{html_col}`").cast("string").alias("html"))
    host = F.regexp_replace(F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), _HOST.pattern, 1)), r"^www\.", "")
    # equal pages of a host have equal votes: a page is known by a hash of its host and html
    src = src.withColumn("k", F.xxhash64(host, F.col("html").isNull(), "html")).withColumn("h", F.xxhash64(host))

    def vote(batches):
        for b in batches:
            cols = [[] for _ in range(5)]
            for k, h, page in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                blocks = parse(page.as_py() or "")
                voted, held = dict(best_containers(blocks)), shares(blocks)
                for p in voted.keys() | held.keys():
                    # whole votes and shares sum alike in any order
                    for c, x in zip(cols, (k, h, p, round(voted.get(p, 0.0) * 1_000_000), round(held.get(p, 0.0) * 1_000_000))):
                        c.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["k", "h", "path", "votes", "share"])

    own = materialize(spark, src.select("k", "h", "html").mapInArrow(vote, "k long, h long, path long, votes long, share long"),
                      "html-votes")
    votes = own.groupBy("h", "path").agg(F.sum("votes").alias("votes"), F.sum("share").alias("share"), F.count(F.lit(1)).alias("pages"))
    # a path of one page tells it nothing that it does not see itself
    votes = votes.where("pages > 1").withColumn("mean", F.when(F.col("pages") >= 3, F.col("share") / F.col("pages") / 1e6))
    # the mean vote of the pages that have the path, drawn to 0 where they are few: a container that
    # every layout of a host shares does not outvote those of the layouts by its number of pages
    votes = votes.withColumn("votes", F.col("votes") / (F.col("pages") + 2))
    votes = votes.select("h", "path", "votes", (F.col("mean") >= whole_share).alias("whole"), (F.col("mean") < minor_share).alias("minor"))
    met = own.select("k", "h", "path").distinct().join(votes, ["h", "path"]).where("votes > 0 or minor")

    def listed(keep):  # the host's paths that the page has, best first
        pairs = F.collect_list(F.when(keep, F.struct((-F.col("votes")).alias("votes"), "path")))
        return F.transform(F.sort_array(pairs), lambda x: x["path"])

    lists = met.groupBy("k").agg(listed(F.col("votes") > 0).alias("paths"), listed((F.col("votes") > 0) & F.col("whole")).alias("whole"),
                                 listed(F.col("minor")).alias("minor"))
    schema = T.StructType([*src.schema.fields[:2], T.StructField("text", T.StringType())])
    arrow = to_arrow_schema(schema)

    def again(batches):
        for b in batches:
            text = [extract(h.as_py(), p, whole=w, minor=m)
                    for h, p, w, m in zip(b.column(2), *(b.column(k).to_pylist() for k in (3, 4, 5)))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(text, pa.string())], schema=arrow)

    return src.join(lists, "k", "left").select("page_id", "url", "html", "paths", "whole", "minor").mapInArrow(again, schema)
