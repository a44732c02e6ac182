"""Main text of web pages by tree scoring.

A page becomes a tree of blocks.  Each paragraph gives points for its length
and its commas to its ancestors, halved at every level and discounted by its
link density.  The best container is the article; siblings that score like it
are kept with it.  Inside the chosen containers everything is kept but what is
never article text: menus, forms, scripts, asides, comments and so on.  Of an
article's own header its headings are kept.

A class or id that names such a part says so plainly (``comments``,
``cookie-notice``), among other words (``content-sidebar-wrap``), or only perhaps
(``related``, ``social-history``).  Names alone decide nothing.  A part that is
named plainly goes if the page has text without it.  One that is named among
other words, or is a form, goes unless most of the page's text is in it, of
which little is in links: then it is what holds the article.  What is perhaps
such a part hands on no points, and is kept inside an article if it reads like
the article: long enough and with few links.

Of containers that score alike the first in the page is taken.

A page is read once, in time linear in its length, however its tags are nested.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm import common

#: What HTML defines or what pages call such parts.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template iframe svg math canvas object textarea select title xmp noembed noframes".split())
_SKIP = frozenset("head nav header footer aside button fieldset dialog menu audio video map label".split())
_BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option optgroup p pre search section summary table tbody td tfoot th thead tr ul".split()
)
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar".split())
_NEVER = "ads? adverts? advertisement advertising adsense sponsor sponsored sponsors sidebar side-?bar comments? disqus replies respond nav navbar navigation breadcrumbs? footer masthead cookies? consent gdpr notice popup modal newsletter subscribe subscription signup outbrain taboola pagination pager login".split()
_PERHAPS = "banner promo promoted menu header overlay share sharing social related recommended toolbar disclaimer copyright skip form search tags".split()


def _names(words: list[str], more: str = "") -> re.Pattern:
    return re.compile(rf"(?:^|[\s_-])(?<!has-)(?<!with-)(?<!no-)(?:{'|'.join(words)})(?:$|[\s_-]){more}", re.I)


#: Words that a plain name may have beside those: where a part is, or what holds it.
_BESIDE = re.compile(r"left|right|top|bottom|site|global|primary|secondary|main|list|area|box|section|block|container|inner|widget|bar|form|banner|item|items|text|policy|the|[0-9]+", re.I)
#: A part named among other words is kept with so large a share of the page's text, one that is named as content too with less; a plainly named one only if it is long and no more text than this is elsewhere.
MOST, SOME, ELSEWHERE, LONG = 0.5, 0.25, 120, 400
_BAD, _DOUBTFUL = _names(_NEVER, r"|(?:^|\s)widget(?:$|\s|-area|_)"), _names(_PERHAPS)
#: What is perhaps no article text is kept from so many characters on, if no more than this share of them are in links.
DOUBT_CHARS, DOUBT_LINKS = 200, 0.25
_GOOD = re.compile(r"(?:^|[\s_-])(?:article|main|content|post|entry|story|body|text|blog)(?:$|[\s_-])", re.I)
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>\x00]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>\x00]*)([^>]*)>?", re.S)
_ATTR = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
_SPACE = re.compile(r"\s+")
#: What opening one of these closes, as far up as the stop set.
_P_STOPS = ("p", "button", "td", "th", "li", "div", "article", "section", "body")
_P_CLOSERS = _BLOCK - frozenset("body br caption head html option optgroup td th tr tbody thead tfoot".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_SELF = {"li": ("li", frozenset({"ul", "ol", "menu"})), "dt": ("dt dd", frozenset({"dl"})), "dd": ("dt dd", frozenset({"dl"})), "option": ("option", frozenset({"select"})), "tr": ("tr td th", frozenset({"table"})), "td": ("td th", frozenset({"tr", "table"})), "th": ("td th", frozenset({"tr", "table"}))}


class _Node:
    __slots__ = ("tag", "parent", "kids", "skip", "good", "doubt", "named", "score", "size", "links")

    def __init__(self, tag: str, parent: _Node | None, skip: bool = False, good: bool = False, doubt: bool = False, named: float = 0):
        self.tag, self.parent, self.skip, self.good, self.doubt, self.named = tag, parent, skip, good, doubt, named
        self.kids: list = []
        self.score, self.size, self.links = 0.0, 0, 0


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): m[2] if m[2] is not None else m[3] if m[3] is not None else m[4] or "" for m in _ATTR.finditer(raw)} if raw.strip(" /\t\r\n") else {}


def _plain(name: str) -> bool:
    """Whether a class or id is the name of such a part and no more."""
    return any(_BAD.search(token) and all(_BAD.search(w) or _BESIDE.fullmatch(w) for w in re.split("[-_]", token) if w) for token in name.split())


def _looks_bad(tag: str, attrs: dict[str, str]) -> tuple[bool, bool, bool, float]:
    """Whether an element is never article text, whether it names an article, whether it is perhaps no article text; and if its name is that of
    such a part the share of the page's text with which it is kept all the same (2: plainly named)."""
    if tag in _SKIP:
        return True, False, False, 0
    form = MOST if tag == "form" else 0
    if not attrs:
        return False, tag in ("article", "main"), False, form
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in attrs.get("style", "").replace(" ", "").lower():
        return True, False, False, 0
    if attrs.get("role", "").lower() in _ROLES:
        return True, False, False, 0
    name = f"{attrs.get('class', '')} {attrs.get('id', '')}"
    good = tag in ("article", "main") or attrs.get("role") in ("main", "article") or bool(_GOOD.search(name))
    if tag in ("body", "html", "article", "main", "a", "b", "i", "em", "strong", "p", "span") or (tag in ("h1", "h2", "h3") and not attrs.get("id")):
        return False, good, False, 0
    doubt = bool(_DOUBTFUL.search(name))
    if _BAD.search(name):
        return False, good, False, 2 if _plain(name) and not form else SOME if good and not form else MOST
    return False, good and not doubt, doubt and not form, form


class _Open:
    """The open elements, the innermost last, and for each tag at which depths it is open."""

    def __init__(self, root: _Node):
        self.nodes, self.depths = [root], {}

    @property
    def node(self) -> _Node:
        return self.nodes[-1]

    def push(self, node: _Node) -> None:
        self.depths.setdefault(node.tag, []).append(len(self.nodes))
        self.nodes.append(node)

    def close(self, depth: int) -> None:
        """Closes the element at a depth and all inside it."""
        while len(self.nodes) > depth:
            self.depths[self.nodes.pop().tag].pop()

    def last(self, tags: Iterable[str]) -> int:
        """The depth of the innermost open element of some tags; 0 if none is."""
        return max((d[-1] for t in tags if (d := self.depths.get(t))), default=0)


def parse(page: str) -> _Node:
    """The tree of a page; text is a kid string. Unclosed and stray tags are mended as browsers do, roughly."""
    root = _Node("#root", None)
    stack = _Open(root)
    at, end = 0, len(page)
    while at < end:
        lt = page.find("<", at)
        if lt < 0:
            stack.node.kids.append(page[at:])
            break
        if lt > at:
            stack.node.kids.append(page[at:lt])
        m = _TOKEN.match(page, lt)
        if not m:
            stack.node.kids.append("<")
            at = lt + 1
            continue
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            if depth := stack.last((tag,)):
                stack.close(depth)
            continue
        raw = (m[3] if m[2] else m[6]) or ""
        if tag in _RAW:
            if not raw.rstrip().endswith("/") or tag not in ("svg", "math"):
                close = _closing(tag).search(page, at)
                at = close.end() if close else end
            if tag != "title":
                stack.node.kids.append(_Node(tag, stack.node, skip=True))
            continue
        if tag in ("body", "html"):
            if tag == "body" and (depth := stack.last(("head",))):
                stack.close(stack.depths["head"][0])
            if stack.last((tag,)):
                continue
        if tag in _P_CLOSERS and (depth := stack.last(_P_STOPS)) and stack.nodes[depth].tag == "p":
            stack.close(depth)
        if tag in _SELF:
            closes, stops = _SELF[tag]
            if (depth := stack.last(closes.split())) > stack.last(stops):
                stack.close(depth)
        kid = _Node(tag, stack.node, *_looks_bad(tag, _attributes(raw)))
        stack.node.kids.append(kid)
        if tag not in _VOID and not ((m[3] or "").endswith("/") and tag not in _BLOCK):
            stack.push(kid)
    return root


@cache
def _closing(tag: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(tag)}\s*>", re.I)


def _up(node: _Node | None) -> Iterator[_Node]:
    while node is not None:
        yield node
        node = node.parent


def _reads_like_text(node: _Node) -> bool:
    return node.size >= DOUBT_CHARS and node.links <= DOUBT_LINKS * node.size


def _headings(header: _Node) -> Iterator[_Node]:
    """The headings of an article's own header, in page order."""
    stack = [header]
    while stack:
        n = stack.pop()
        if n.tag in _HEADINGS:
            yield n
        elif n is header or not n.skip:
            stack += [k for k in reversed(n.kids) if isinstance(k, _Node)]


def _blocks(top: _Node, into: list[str], article: bool = False) -> None:
    """Text blocks below a node in page order, without skipped parts; ``article``: below an article element, whose headers' headings count."""
    part: list[str] = []

    def end() -> None:
        text = _SPACE.sub(" ", html.unescape("".join(part))).strip()
        part.clear()
        if text:
            into.append(text)

    stack: list = [iter(top.kids)]
    tags = [top.tag]
    while stack:
        kid = next(stack[-1], None)
        if kid is None:
            stack.pop()
            if tags.pop() in _BLOCK:
                end()
        elif isinstance(kid, str):
            part.append(kid)
        elif kid.skip and kid.tag == "header" and (article or top.tag == "article" or "article" in tags):
            end()
            for h in _headings(kid):
                _blocks(h, into)
        elif not kid.skip and (not kid.doubt or _reads_like_text(kid)):
            if kid.tag in _BLOCK:
                end()
            if kid.kids:
                stack.append(iter(kid.kids))
                tags.append(kid.tag)
        elif kid.tag in _BLOCK:
            end()
    end()


def _order(root: _Node) -> list[_Node]:
    """All nodes that aren't left out, in page order."""
    order: list[_Node] = []
    stack = [root]
    while stack:
        n = stack.pop()
        order.append(n)
        stack += [k for k in reversed(n.kids) if isinstance(k, _Node) and not k.skip]
    return order


def _leave_out(root: _Node) -> None:
    """Leaves out what is named like a part that is no article text and reads like one."""
    order = _order(root)
    if not any(n.named for n in order):
        return
    size: dict[int, int] = {}
    links: dict[int, int] = {}
    inside: dict[int, int] = {}
    for n in reversed(order):
        kids = [k for k in n.kids if isinstance(k, _Node) and not k.skip]
        size[id(n)] = sum(len(k.strip()) for k in n.kids if isinstance(k, str)) + sum(size[id(k)] for k in kids)
        links[id(n)] = size[id(n)] if n.tag == "a" else sum(links[id(k)] for k in kids)
        # Text that stays in any case: what isn't in a part with such a name, nor in links.
        inside[id(n)] = 0 if n.named == 2 or n.tag == "a" else sum(len(k.strip()) for k in n.kids if isinstance(k, str)) + sum(inside[id(k)] for k in kids)
    total, sure = size[id(root)] - links[id(root)], inside[id(root)]
    left: set[int] = set()
    for n in order:
        if n.parent is not None and id(n.parent) in left:
            left.add(id(n))
            continue
        if not n.named:
            continue
        own = size[id(n)] - links[id(n)]
        few = links[id(n)] <= DOUBT_LINKS * size[id(n)]
        if not (few and (sure <= ELSEWHERE and own >= max(LONG, MOST * total) if n.named == 2 else own >= max(DOUBT_CHARS, n.named * total))):
            n.skip = True
            left.add(id(n))


def _measure(root: _Node) -> list[_Node]:
    """Adds sizes and link sizes up the tree and hands points of paragraphs to their ancestors; returns the containers in page order."""
    order = _order(root)
    own: dict[int, list[int]] = {}
    for n in reversed(order):
        flat = "".join(k if isinstance(k, str) else " " for k in n.kids)
        mine = len(flat.strip())
        commas = flat.count(",") + flat.count("、") + flat.count("，") if mine else 0
        n.size += mine
        if n.tag == "a":
            n.links = n.size
        tally = own.pop(id(n), [0, 0])
        tally[0] += mine
        tally[1] += commas
        if n.tag in _BLOCK or n.parent is None:
            if tally[0] >= 20:
                density = min(1.0, n.links / max(1, n.size))
                points = (1 + tally[1] + min(tally[0] / 100, 30)) * (1 - density)
                share, up = 1.0, (n.parent if n.tag in ("p", "li", "td", "pre", "blockquote", "dd", "h1", "h2", "h3", "h4") else n)
                while up is not None and share > 0.03 and not up.doubt:
                    up.score += points * share
                    share /= 2
                    up = up.parent
        elif n.parent is not None:
            up = own.setdefault(id(n.parent), [0, 0])
            up[0] += tally[0]
            up[1] += tally[1]
        if n.parent is not None:
            n.parent.size += n.size
            n.parent.links += n.links
    return [n for n in order if n.tag in _BLOCK and not n.doubt and n.tag not in ("p", "br", "hr", "html", "h1", "h2", "h3", "h4", "h5", "h6", "li")]


def extract(page: str | None) -> str:
    """The article of a page, blocks joined by one space; empty if there is none."""
    if not page:
        return ""
    root = parse(page)
    _leave_out(root)
    containers = _measure(root)
    rank = {id(n): n.score * (1 - min(1.0, n.links / max(1, n.size))) * (2.0 if n.good else 1.0) for n in containers}
    best = max(containers, key=lambda n: rank[id(n)], default=None)
    if best is None or rank[id(best)] <= 0:
        best = next((n for n in containers if n.good and n.size), root)
    above = [up for up in _up(best.parent) if up.good and up.tag in ("article", "main")]
    best = above[0] if above else best
    article = any(up.tag == "article" for up in _up(best))
    found: list[str] = []
    if best.parent is None:
        _blocks(best, found)
        return " ".join(found)
    least = 0.2 * max(rank.get(id(best), 0.0), 1.0)
    # Between a headline and the article stands what leads into it, however short.
    before, headed = True, False
    for kid in best.parent.kids:
        if isinstance(kid, str) or kid.skip:
            continue
        before, headed = before and kid is not best, headed or kid.tag in ("h1", "h2")
        dense = kid.links / max(1, kid.size)
        alike = kid is best or (best.tag not in ("article", "main", "body") and ((rank.get(id(kid), 0.0) >= least and dense < 0.3) or (kid.tag == "p" and (kid.size > 80 or (before and headed)) and dense < 0.25) or kid.tag == "h1"))
        if alike and (kid is best or not kid.doubt or _reads_like_text(kid)):
            _blocks(kid, found, article)
    return " ".join(found)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, urls, pages = (batch.column(i) for i in range(3))
        for lo, hi in common.text_slices(pages):
            texts = [extract(p) for p in pages.slice(lo, hi - lo).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [ids.slice(lo, hi - lo).cast(pa.int64()), urls.slice(lo, hi - lo).cast(pa.string()), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )


def html_extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages``.

    A null or empty page, or one without an article, has an empty text.  Very
    long pages are read whole.  Rows are independent: no shuffle, repeated rows
    give repeated results, other columns are ignored.
    """
    common.short_batches(pages.sparkSession)
    return pages.select("page_id", "url", "html").mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
