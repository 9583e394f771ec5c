"""Main text of web pages by composite text density.

Each page becomes a flat table of element nodes.  A node's composite density is its
characters per tag, damped by the share of linked characters and linked tags; a
node's density sum adds up the densities of its children.  The node with the largest sum
marks the main text; the smallest density on its path up to the body is the threshold,
and walking down from the body, every node above the threshold contributes its
maximum-sum subtree.  An <article> or <main> element on that path is taken whole.  Elements that never hold article text (navigation, forms,
scripts and the like, by element name or by a class or id word) are cut before densities
are computed.  A word is a vote only: what holds the article or most of the text stays.

All work on a page is local to it, in one linear pass over its tokens, so Spark only
maps; pages are never shuffled.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*+)(>|\Z)|[^<]+|<""", re.S)
#: For the rest of a page from a tag on whose quotes never close: any ">" ends a tag.
_LOOSE = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)([^>]*)(>|\Z)|[^<]+|<""", re.S)
_TAG = re.compile(r"</?[A-Za-z]")
_ATTR = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_SPACE = re.compile(r"\s+")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Content is not markup up to the matching end tag.
RAW = frozenset("script style textarea title noscript xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img".split()
)
#: Elements that hold no article text.
NOISE = frozenset("nav header footer aside form script style noscript template button select option textarea iframe object svg canvas menu dialog head title input label fieldset noembed noframes audio video map".split())
#: Words of a class, id or role that mark menus, notices, adverts, side matter and reader comments.
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus dropdown footer header masthead menu modal nav navbar navigation newsletter notice notices pagination popup promo promoted related replies reply respond share sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)
#: A name that begins with one of these tells of something elsewhere ("has-sidebar").
_ABOUT = frozenset("has with without no is".split())
#: Whatever their class says of the page, these are never cut by name; an article only as a reader comment.
_FRAMES = frozenset("html body main".split())
_COMMENTS = frozenset("comment comments disqus replies reply".split())
#: A new block of this kind ends an open paragraph or list item.
_ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table", "tbody", "thead", "tfoot"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}


class Node:
    __slots__ = ("tag", "parent", "kids", "chars", "tags", "link_chars", "link_tags", "noise", "named", "density", "total", "best")

    def __init__(self, tag: str, parent: Node | None, noise: bool, named: frozenset[str] = frozenset()) -> None:
        self.tag, self.parent, self.noise = tag, parent, noise
        self.named = named  # noise words of its class, id or role: votes, see _cut_named
        self.kids: list = []  # nodes and strings, in page order
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0
        self.best: Node | None = None


def _noise_words(tag: str, attrs: str) -> frozenset[str]:
    """Noise words that count for this element in the first class, id or role that has any."""
    if "=" in attrs and tag not in _FRAMES:
        cut = _COMMENTS if tag == "article" else NOISE_WORDS
        for m in _ATTR.finditer(attrs):
            for name in (m[2] or m[3] or m[4] or "").split():
                words = [w.lower() for w in _WORDS.findall(name)]
                if words and words[0] not in _ABOUT and not cut.isdisjoint(words):
                    return cut.intersection(words)
    return frozenset()


def _is_noise(tag: str, attrs: str) -> bool:
    return tag in NOISE or bool(_noise_words(tag, attrs))


def parse(page: str) -> Node:
    """The element tree of a page.  Never fails: whatever is not markup is text."""
    root = Node("#root", None, False)
    here, at, n, token = root, 0, len(page), _TOKEN
    open_: Counter[str] = Counter()  # by tag: an end tag of none that is open costs nothing

    def close(node: Node) -> Node:
        """Close everything down to ``node``."""
        nonlocal here
        while here is not node.parent:
            open_[here.tag] -= 1
            here = here.parent
        return here

    while at < n:
        m = token.match(page, at)
        if m[0] == "<" and token is _TOKEN and _TAG.match(page, at):
            token = _LOOSE
            continue
        at = m.end()
        tag = m[2]
        if tag is None:
            if not page.startswith(("<!", "<?"), m.start()):
                here.kids.append(m[0])
            continue
        if not m[4]:  # cut off inside a tag
            break
        tag = tag.lower()
        if m[1]:
            node = here if open_[tag] else root
            while node is not root and node.tag != tag:
                # A stray end tag closes nothing outside its list or table.
                node = root if node.tag in _SCOPE.get(tag, ()) else node.parent
            if node is not root:
                close(node)
            continue
        if tag in _ENDS_P:
            node = here
            while node.tag in INLINE:
                node = node.parent
            if node.tag == "p":
                close(node)
        elif tag in _SAME and any(open_[t] for t in _SAME[tag]):
            node = here
            while node is not root and node.tag not in _SCOPE[tag] and node.tag not in _SAME[tag]:
                node = node.parent
            if node.tag in _SAME[tag]:
                close(node)
                if tag == "tr" and here.tag == "tr":
                    close(here)
        noise = here.noise or tag in NOISE
        node = Node(tag, here, noise, frozenset() if noise else _noise_words(tag, m[3]))
        here.kids.append(node)
        if tag in VOID or m[3].endswith("/"):
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.I).search(page, at)
            node.kids.append(page[at : end.start() if end else n])
            stop = page.find(">", end.end()) if end else -1
            at = stop + 1 if stop >= 0 else n
            continue
        here = node
        open_[tag] += 1
    return root


def _visible(text: str) -> int:
    return len("".join(html.unescape(text).split()) if "&" in text else "".join(text.split()))


def _measure(root: Node) -> list[Node]:
    """Fill in counts bottom-up without recursion; returns the nodes in page order."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(k for k in reversed(node.kids) if isinstance(k, Node) and not k.noise)
    for node in reversed(order):
        node.chars = node.tags = node.link_chars = node.link_tags = 0
        for k in node.kids:
            if isinstance(k, str):
                node.chars += _visible(k)
            elif not k.noise:
                own = int(k.tag not in INLINE or k.tag == "a")  # formatting is no structure
                node.chars += k.chars
                node.tags += k.tags + own
                node.link_chars += k.chars if k.tag == "a" else k.link_chars
                node.link_tags += k.tags + own if k.tag == "a" else k.link_tags
    return order


def _density(node: Node, share: float) -> float:
    """Characters per tag, times a logarithm that links pull down in its argument and push up in its base."""
    c = node.chars
    if not c:
        return 0.0
    tags, linked, link_tags = max(node.tags, 1), max(node.link_chars, 1), max(node.link_tags, 1)
    plain = max(c - node.link_chars, 1)
    base = math.log(c / plain * node.link_chars + share * c + math.e)
    inner = c / linked * tags / link_tags
    return c / tags * max(math.log(inner), 0.0) / max(math.log(base), 0.1)


def _densities(order: list[Node], body: Node) -> None:
    """Density of every node, the sum over its children, and the best node below it.

    Formatting elements are transparent: blocks inside them count for the next block
    above, and they are never the best node themselves."""
    share = body.link_chars / body.chars if body.chars else 0.0
    for node in reversed(order):
        node.density = _density(node, share)
        kids = [k for k in node.kids if isinstance(k, Node) and not k.noise]
        node.total = sum(k.total if k.tag in INLINE else k.density for k in kids)
        below = [k.best for k in kids if k.best is not None]
        node.best = max(below if node.tag in INLINE else [node, *below], key=lambda x: x.total, default=None)


def _cut_named(order: list[Node]) -> list[Node]:
    """Cut the elements whose names tell of noise; returns those that were cut.

    What holds the body, or the article or main element with the most text, stays whatever its name says."""
    named = [x for x in order if x.named]
    holds = set()
    for tag in ("article", "main", "body") if named else ():
        own = [x for x in order if x.tag == tag and not x.named]
        if own:
            up = max(own, key=lambda x: x.chars - x.link_chars).parent
            while up is not None:
                holds.add(up)
                up = up.parent
    cut = [x for x in named if x not in holds]
    for x in cut:
        x.noise = True
    return cut


#: Visible characters outside links below which what is left of a page is no prose.
PROSE = 80


def _plain(node: Node) -> int:
    return node.chars - node.link_chars


def _main_nodes(root: Node) -> list[Node]:
    """The nodes of the article: names cut first.  Where they leave neither an article element nor prose, an element that holds most of the page's text
    outside links (and is not named for reader comments) comes back, and if there is none, all of them."""
    order = _measure(root)
    whole = _plain(order[0])
    most = {x for x in order if x.named and 2 * _plain(x) > whole and (x.tag == "article" or _COMMENTS.isdisjoint(x.named))}
    cut = _cut_named(order)
    found = _main_of(root, _measure(root))
    if not cut or sum(map(_plain, found)) >= PROSE or any(x.tag == "article" and x.chars for x in found):
        return found
    for back in ([x for x in cut if x in most], cut):
        for x in back:
            x.noise = False
        again = _main_of(root, _measure(root)) if back else []
        if sum(map(_plain, again)) > sum(map(_plain, found)):
            return again
    return found


def _main_of(root: Node, order: list[Node]) -> list[Node]:
    body = next((x for x in order if x.tag == "body"), root)
    _densities(order, body)
    top = body.best
    if top is None or not top.chars:
        return []
    least, node, named = body.density, top, []
    while node is not None and node is not body:
        least = min(least, node.density)
        if node.tag in ("article", "main"):
            named.append(node)
        node = node.parent
    if named:  # an element on the path says by its name that it is the article
        chosen = next((x for x in reversed(named) if x.tag == "article"), named[-1])
        # A page may hold several: its neighbours of the same kind that are prose, not lists of links.
        return [x for x in order if x is chosen or (x.tag == chosen.tag and x.parent is chosen.parent and _plain(x) >= PROSE and 2 * x.link_chars < x.chars)]
    marked, stack, chosen = [], [body], set()
    while stack:
        node = stack.pop()
        if node.density < least or not node.chars or node.best is None:
            continue
        best, up = node.best, node.best
        while up is not None and id(up) not in chosen:
            up = up.parent
        if up is None:
            chosen.add(id(best))
            marked.append(best)
        stack.extend(k for k in reversed(node.kids) if isinstance(k, Node) and not k.noise)
    return [x for x in order if id(x) in chosen]


def _blocks(node: Node, out: list[str], done: set[int]) -> None:
    """Text blocks of a subtree in page order, each with single spaces."""
    line: list[str] = []

    def flush() -> None:
        text = _SPACE.sub(" ", html.unescape("".join(line))).strip()
        if text:
            out.append(text)
        line.clear()

    stack: list = [node]
    while stack:
        x = stack.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            line.append(x)
        elif x.tag == "br":
            line.append(" ")
        elif not x.noise and id(x) not in done:
            done.add(id(x))
            if x.tag not in INLINE:
                flush()
                stack.append(None)
            stack.extend(reversed(x.kids))
    flush()


def main_text(page: str | None) -> str:
    """The article of one page: blocks joined by an empty line; empty if there is none."""
    if not page:
        return ""
    out: list[str] = []
    done: set[int] = set()
    for node in _main_nodes(parse(page)):
        _blocks(node, out, done)
    return "\n\n".join(out)


def extract_text(pages: DataFrame) -> DataFrame:
    """pages -> page_id, url, text, n_chars (code points); one row a page row.

    Null or empty html gives an empty text.  Nulls in other columns pass through; pages of any length are read whole;
    repeated rows come back as often as they stand; further columns are ignored, whatever their names.  Empty
    input gives no rows.
    """

    @pandas_udf("string")
    def main(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in pages:
            yield pd.Series([main_text(p) for p in batch], dtype=object)

    out = pages.select("page_id", "url", main(F.col("html")).alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
