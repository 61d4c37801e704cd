"""HTML extraction with a site style tree.

Every page becomes a light tree of elements.  Pages of one host are merged
into a site style tree: a style node is a path of tags and classes; for each
node the tree knows on how many (distinct) pages it stands, the distribution
of its presentations (sequences of child tags) and of its contents.  The
importance of a node is the normalised entropy of the two: what looks and
reads the same on page after page is a template.  A page keeps its article
(or main element; without either, its body) without branches that are noise
by meaning (menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles, comments) and without containers of low importance.  Class
and id words are no proof of noise: article, main and what holds most of the
text are exempt, so is a form around an article, main or h1, and of doubtful
words (``_MAYBE``) the tree's importance decides.  Importance is smoothed: few
pages move it little from "keep" (marked elements: from "drop"), without a
least number of pages.

The statistics are one small row per page and style node, counted by key with
partial aggregation, so a host with a third of all pages is not one group;
the low nodes per host are few and are joined back to the pages.

Defined cases: null html is empty, text ''; null url has host ''; repeated
pages count once in the tree and are all returned; broken markup is repaired
like a browser does (open paragraphs end at the next block); elements may be
nested at any depth (the time is linear in the page's length, as paths and
contents are hashed from one element to the next); an empty table gives an
empty one; extra columns are ignored.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growlytics.llm.common import by_value, pick, small, staged

by_value(__name__)
LOW = 0.3
#: Pages that count beside those seen: as many important ones for a plain
#: element, as many unimportant ones for an element that a word marks.
KEEP_PAGES, DROP_PAGES = 3, 18
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_ATTR = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_RAW = frozenset("script style textarea title noscript template iframe svg canvas select noembed".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
                   "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary "
                   "table tbody tfoot thead caption tr ul option xmp".split())
_CONTAINER = frozenset("aside center details dir div dl fieldset figure footer form header menu nav ol section table ul".split())
_NOISE_TAGS = frozenset("head nav footer aside button input label menu dialog option audio video".split()) | _RAW
_NOISE = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored navbar nav navigation breadcrumb breadcrumbs "
                   "footer masthead cookie cookies consent gdpr popup modal overlay newsletter subscribe subscription signup login "
                   "comment comments disqus toolbar pagination pager copyright".split())
#: Words that also stand on article text: they only mark, see ``judge``.
_MAYBE = frozenset("promo promotion banner sidebar menu notice notices alert share sharing social reply replies discussion related "
                   "recommended widget".split())
_FREE = frozenset("html body main article".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar toolbar".split())
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_STOP = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}


class Node:
    __slots__ = ("tag", "style", "noise", "mark", "kids", "path")

    def __init__(self, tag, style="", noise=False, path="", mark=""):
        self.tag, self.style, self.noise, self.mark, self.kids = tag, style, noise, mark, []
        # a path is a hash of its parent's and the element: as long at any depth
        self.path = xxhash.xxh3_64_hexdigest(f"{path}/{tag}{style}".encode("utf-8", "replace")) + ("!" if mark == "maybe" else "")


def _element(tag: str, attrs: str, up: Node, in_article: bool) -> Node:
    noise = tag in _NOISE_TAGS or tag == "header" and not in_article
    style = mark = ""
    if attrs.strip(" /"):
        got = {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(attrs)}
        names = f"{got.get('class', '')} {got.get('id', '')}"
        if names.strip():
            style = "." + ".".join(sorted(got.get("class", "").lower().split()))
            parts = {x for x in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", names).lower()) if x}
            if tag not in _FREE:
                sure = parts & _NOISE or not in_article and parts & {"header", "masthead", "topbar"}
                mark = "noise" if sure else "maybe" if parts & _MAYBE else ""
        noise = noise or got.get("role", "").lower() in _ROLES or "hidden" in got or got.get("aria-hidden") == "true" \
            or "display:none" in got.get("style", "").replace(" ", "").lower()
    if tag == "form" and not mark:  # a form may be the whole page: see ``judge``
        mark = "form"
    return Node(tag, style, noise, up.path, mark)


def parse(source) -> Node:
    """The tree of a page; kids are nodes and texts."""
    root = Node("#")
    stack, at, inside = [root], 0, 0
    source = source or ""
    n = len(source)
    while at < n:
        m = _TAG.search(source, at)
        if not m:
            stack[-1].kids.append(source[at:])
            break
        if m.start() > at:
            stack[-1].kids.append(source[at:m.start()])
        at = m.end()
        close, tag, attrs = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if close:
            if tag in ("p", "br") or any(x.tag == tag for x in stack):
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == tag:
                        inside -= sum(x.tag in ("article", "main") for x in stack[i:])
                        del stack[i:]
                        break
                    if stack[i].tag in ("article", "main", "body", "table") and tag not in ("article", "main", "body", "html", "table") \
                            and not any(x.tag == tag for x in stack[i:]):
                        break
            continue
        if tag in _BLOCK:  # an open paragraph ends here, with what is open in it
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    del stack[i:]
                    break
                if stack[i].tag in _BLOCK or stack[i].tag in ("td", "th"):
                    break
        if tag in _CLOSES:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in _CLOSES[tag]:
                    del stack[i:]
                    break
                if stack[i].tag in _STOP[tag]:
                    break
        node = _element(tag, attrs or "", stack[-1], inside > 0)
        stack[-1].kids.append(node)
        if tag in _RAW or tag == "xmp":
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(source, at)
            if tag == "xmp":
                node.kids.append(html.escape(source[at:end.start() if end else n]))
            at = end.end() if end else n
        elif tag not in _VOID and not (attrs or "").rstrip().endswith("/"):
            stack.append(node)
            inside += tag in ("article", "main")
    return root


def _all(root: Node):
    todo = [root]
    while todo:
        x = todo.pop()
        yield x
        todo.extend(k for k in reversed(x.kids) if not isinstance(k, str))


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "replace")) - 2**63


def style_nodes(root: Node) -> dict[str, tuple[int, int]]:
    """Path -> (presentation, content) hashes of a page's containers and of
    what a word marks (such paths end in '!'); equal paths of a page are one
    style node.  Contents are hashed from the leaves up, in one pass."""
    out: dict[str, list] = {}
    content: dict[int, str] = {}
    order = list(_all(root))
    for x in reversed(order):
        parts = [" ".join(k.split()) if isinstance(k, str) else content[id(k)] for k in x.kids]
        parts = [k for k in parts if k]
        # an element with one part has that part's content
        content[id(x)] = "" if x.tag in _RAW or not parts else parts[0] if len(parts) == 1 and len(parts[0]) <= 64 else f"{_hash(chr(31).join(parts)):x}"
    for x in order:
        if x.tag in _CONTAINER or x.mark == "maybe":
            shape = " ".join(dict.fromkeys(k.tag for k in x.kids if not isinstance(k, str)))
            out.setdefault(x.path, []).append((shape, content[id(x)]))
    return {p: tuple(_hash(repr([v[i] for v in vs])) for i in (0, 1)) for p, vs in out.items()}


def _sizes(root: Node) -> dict[int, int]:
    """Characters that each element holds, without what is noise."""
    size: dict[int, int] = {}
    for x in reversed(list(_all(root))):  # kids first
        own = sum(len("".join(k.split())) for k in x.kids if isinstance(k, str))
        size[id(x)] = 0 if x.noise else own + sum(size[id(k)] for k in x.kids if not isinstance(k, str))
    return size


def judge(root: Node, high: frozenset) -> None:
    """Makes marked elements noise, but none that holds most of the page's text
    (of those with a clear word: and an article, main or h1), none with a
    doubtful word that the style tree found important (``high``), and no form
    that holds an article, main or h1 or most of the text."""
    if not any(x.mark for x in _all(root)):
        return
    size, holds = _sizes(root), {}
    for x in reversed(list(_all(root))):
        holds[id(x)] = x.tag in ("article", "main", "h1") or any(holds[id(k)] for k in x.kids if not isinstance(k, str))
    for x in _all(root):
        if x.mark:
            most, whole = 2 * size[id(x)] > size[id(root)], holds[id(x)]
            if x.mark == "form":
                stays = most or whole
            else:
                stays = most and (x.mark == "maybe" or whole) or x.mark == "maybe" and x.path in high
            x.noise = x.noise or not stays


def _outermost(root: Node, tag: str) -> list[Node]:
    found, todo = [], [root]
    while todo:
        x = todo.pop()
        if x.tag == tag and not x.noise:
            found.append(x)
        elif not (x.noise and x.tag != "#"):
            todo.extend(k for k in reversed(x.kids) if not isinstance(k, str))
    return found


def _top(root: Node) -> list[Node]:
    """The outermost articles, else main elements, else the body; articles that
    hold less than half of the main element's text, or a quarter of the body's
    where there is none, are cards in it and not the page's text."""
    size = _sizes(root)
    held = lambda nodes: sum(size[id(x)] for x in nodes)
    article, main, body = (_outermost(root, tag) for tag in ("article", "main", "body"))
    body = body or [root]
    if held(article) and (2 * held(article) >= held(main) if held(main) else 4 * held(article) >= held(body)):
        return article
    return main if held(main) else body if held(body) else [root]


def blocks(nodes: list[Node], low: frozenset) -> list[str]:
    out: list[str] = []
    cur: list[str] = []

    def flush():
        text = " ".join(html.unescape("".join(cur)).split())
        cur.clear()
        if text:
            out.append(text)

    todo: list = list(reversed(nodes))
    while todo:
        x = todo.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            cur.append(x)
        elif x.noise or x.tag in _CONTAINER and x.path in low:
            if x.tag in _BLOCK:
                flush()
            else:
                cur.append(" " if x.tag in _VOID else "")
        elif x.tag in _BLOCK:
            flush()
            todo.append(None)
            todo.extend(reversed(x.kids))
        else:
            if x.tag in ("br", "td", "th"):
                cur.append(" ")
            todo.extend(reversed(x.kids))
    flush()
    return out


def extract(source, low: frozenset = frozenset(), high: frozenset = frozenset()) -> str:
    """The main text of one page; ``low`` are the unimportant style paths,
    ``high`` the important ones of marked elements.  If the words leave
    nothing, they do not count."""
    root = parse(source)
    judge(root, high)
    top = _top(root)
    return "\n\n".join(blocks(top, low) or (blocks(top, frozenset()) if low else []) or blocks(_top(parse(source)), frozenset()))


def _statistics(frames):
    for f in frames:
        rows = []
        for host, page in zip(f["host"], f["html"]):
            mark = xxhash.xxh3_64_intdigest((page or "").encode("utf-8", "replace")) - 2**63
            rows += [(host, path, mark, shape, content) for path, (shape, content) in style_nodes(parse(page)).items()]
        yield pd.DataFrame(rows, columns=["host", "path", "page", "shape", "content"])


def style_tree(pages: DataFrame) -> DataFrame:
    """host, path, pages, importance of every style node: nine parts entropy of
    content, one part entropy of presentation, each relative to the most that
    so many pages can have.  Few pages say little: as if ``KEEP_PAGES`` more
    pages had shown it important or, for a marked element, ``DROP_PAGES`` more
    unimportant, at any number of pages."""
    rows = pages.mapInPandas(_statistics, "host string, path string, page long, shape long, content long")
    rows = staged(rows.distinct(), "style-nodes")
    key = ["host", "path"]

    def entropy(of: str) -> DataFrame:
        n = rows.groupBy(*key, of).agg(F.count("*").alias("n")).groupBy(*key).agg(
            F.sum("n").alias("m"), F.sum(F.col("n") * F.log("n")).alias("s"))
        bits = F.log("m") - F.col("s") / F.col("m")
        return n.select(*key, "m", F.when(F.col("m") > 1, bits / F.log("m")).otherwise(1.0).alias(of))

    both = entropy("content").join(entropy("shape").drop("m"), key)
    seen = F.col("m") * (0.9 * F.col("content") + 0.1 * F.col("shape"))
    marked = F.col("path").endswith("!")
    smooth = F.when(marked, seen / (F.col("m") + DROP_PAGES)).otherwise((seen + KEEP_PAGES) / (F.col("m") + KEEP_PAGES))
    return both.select(*key, F.col("m").alias("pages"), smooth.alias("importance"))


def _extracted(frames):
    for f in frames:
        some = ([frozenset(x) if x is not None else frozenset() for x in f[c]] for c in ("low", "high"))
        text = [extract(h, *x) for h, *x in zip(f["html"], *some)]
        yield pd.DataFrame({"page_id": f["page_id"], "url": f["url"], "text": text, "n_chars": np.fromiter(map(len, text), np.int64, len(text))})


def main_text(pages: DataFrame, low: float = LOW) -> DataFrame:
    """page_id, url, text, n_chars for every page."""
    rows = pick(pages, page_id="long", url="string", html="string")
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/:?#]*)", 1))
    rows = rows.withColumn("host", host)
    tree = style_tree(rows.select("host", "html"))
    poor = F.col("importance") < low
    tree = tree.where(poor | F.col("path").endswith("!"))
    paths = tree.groupBy("host").agg(F.collect_list(F.when(poor, F.col("path"))).alias("low"), F.collect_list(F.when(~poor, F.col("path"))).alias("high"))
    rows = rows.join(small(staged(paths, "style-low")), "host", "left")
    return rows.select("page_id", "url", "html", "low", "high").mapInPandas(_extracted, "page_id long, url string, text string, n_chars long")
