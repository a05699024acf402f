"""Main text of web pages by tree scoring.

A page is read into a light tree (tags, class and id words, text), with the closing rules of HTML that
matter for text: paragraphs, list items and cells end where the next one or a block begins, end tags
without a start are ignored, scripts and styles are skipped to their end tag. Menus, headers, footers,
sidebars, notices, adverts, forms and comments are taken out by element, role and class or id word.

What is left is scored: a paragraph earns points for its length and commas, less the share of its
text in links; it passes them to its parent in full, to its grandparent by half, and less to those
above. The best scored element leads to the container: the article it is part of, or else the outermost
element that a climb from it reaches without taking in text that is mostly links, with what stands beside
it in the body. All blocks that remain in there are returned, in page order, one per line, whatever
their length; white space within a block becomes one space.

Edge cases: a null or empty page, or one without any text outside what is taken out, gives an empty
text. A page cut off inside a tag loses that tag only. Depth and length are not limited (no
recursion, linear scanning). Repeated rows each get their result; an empty table gives an empty
result; columns of other names are left out.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

TOKEN = re.compile(
    r"<!--(?:(?!-->).)*+(?:-->|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*+)(?P<rest>(?:[^>=]++|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))?+)*+)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*("[^"]*"?|'[^']*'?|[^\s>]+)|([^\s=/"'>]+)""")
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot "
    "th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: Blocks that hold running text.
PROSE = HEADINGS | frozenset("p blockquote pre table ul ol dl figure".split())
#: What a start tag ends, if open, and the elements the search for it does not leave.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: Elements and roles that never hold the main text.
APART = frozenset(
    "head script style noscript template nav footer aside form button select input textarea iframe svg canvas object embed audio "
    "video dialog menu title xmp noembed noframes datalist".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
#: Words of a class or id that tell such parts.
TELLING = frozenset(
    "ad ads adbox adslot adunit adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notification popup modal overlay lightbox newsletter subscribe subscription signup login register paywall share sharing "
    "social sidebar related recommended recommendations trending popular nav navbar navigation menu breadcrumb breadcrumbs pagination "
    "pager footer masthead toolbar topbar widget skip searchbox search side aside rail crumb crumbs alert disclaimer copyright promoted "
    "sponsors teaser teasers".split()
)
#: Of these, words that class names use in other senses too: they tell only beside words of layout.
AMBIGUOUS = frozenset(
    "alert banner consent copyright disclaimer login menu modal navigation notice notification overlay popular promoted promotion recommended "
    "register related search share sharing side sidebar signup skip social sponsor sponsored subscribe subscription teaser teasers trending "
    "comment comments discussion reply replies respond response responses".split()
)
LAYOUT = frozenset(
    "bar block body bottom box btn button buttons col column container content entries entry feed fixed float footer form full global group header "
    "icon icons image images inner item items js large left line link links list lists mobile module nav outer page panel post posts row "
    "section site small sticky tab tabs text title tool tools top unit view widgets wrap wrapper area article articles author".split()
)
COMMENTS = frozenset("comment comments commentlist disqus respond reply replies discussion responses".split())
#: Text of which more than this share is in links is navigation.
LINKED = 0.5


class Node:
    __slots__ = ("tag", "words", "role", "hidden", "parent", "children", "score", "gone")

    def __init__(self, tag: str, parent: Node | None, words: frozenset = frozenset(), role: str = "", hidden: bool = False):
        self.tag, self.parent, self.words, self.role, self.hidden = tag, parent, words, role, hidden
        self.children: list = []
        self.score = 0.0
        self.gone = False


_NO_WORDS: frozenset = frozenset()


def _told(words: frozenset) -> frozenset:
    """The words of one class name or id, without ambiguous ones that stand beside words of a subject
    (a ``share-price`` is no share bar, a ``share-bar`` is)."""
    own = words & AMBIGUOUS
    return words - own if own and words - own - LAYOUT - TELLING - COMMENTS else words


def _attributes(rest: str) -> tuple[frozenset, str, bool]:
    words, role, hidden = _NO_WORDS, "", False
    for m in ATTRIBUTE.finditer(rest):
        name = (m[1] or m[3]).lower()
        value = (m[2] or "").strip("\"'")
        if name in ("class", "id"):
            for name_ in value.split():
                words |= _told(frozenset(w.lower() for w in WORDS.findall(name_)))
        elif name == "role":
            role = value.lower()
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            hidden = True
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            hidden = True
    return words, role, hidden


def parse(page: str) -> Node:
    """The tree of a page, below a root of its own."""
    root = node = Node("#root", None)
    at, size = 0, len(page)
    while at < size:
        start = page.find("<", at)
        if start < 0:
            start = size
        if start > at:
            node.children.append(html.unescape(page[at:start]))
        if start == size:
            break
        m = TOKEN.match(page, start)
        if m is None:
            node.children.append("<")
            at = start + 1
            continue
        at = m.end()
        if m["tag"] is None:
            continue
        tag = m["tag"].lower()
        if m["end"]:
            node = _close(node, tag)
            continue
        if tag in BLOCK:
            node = _end_open(node, {"p"}, {"td", "th", "button", "li", "div", "section", "article", "blockquote", "table"}) if tag != "html" else node
        if tag in ENDS:
            node = _end_open(node, *ENDS[tag])
        rest = m["rest"]
        child = Node(tag, node, *(_attributes(rest) if rest else ()))
        node.children.append(child)
        if tag in RAW:
            close = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.I).search(page, at)
            at = page.find(">", close.end()) + 1 if close else size
            at = at or size
        elif tag not in VOID and not rest.endswith("/") or tag in ("p", "div", "span", "a"):
            node = child
    return root


def _end_open(node: Node, tags: set, within: set) -> Node:
    """The parent of the nearest open element of ``tags``, if there is one inside ``within``."""
    at: Node | None = node
    while at is not None and at.parent is not None:
        if at.tag in tags:
            return at.parent
        if at.tag in within:
            break
        at = at.parent
    return node


def _close(node: Node, tag: str) -> Node:
    """An end tag closes up to its element; one of inline elements does not close blocks."""
    at = node
    while at.parent is not None:
        if at.tag == tag:
            return at.parent
        if tag not in BLOCK and at.tag in BLOCK:
            break
        at = at.parent
    return node


def _walk(top: Node) -> Iterator[Node]:
    """The elements below ``top`` that were not taken out, in page order."""
    todo = [top]
    while todo:
        node = todo.pop()
        yield node
        todo.extend(c for c in reversed(node.children) if isinstance(c, Node) and not c.gone)


def _holds_article(node: Node) -> bool:
    for n in _walk(node):
        if n.tag in ("article", "main", "h1") and not n.words & COMMENTS and not (n.parent is not None and n.parent.words & COMMENTS):
            return True
    return False


def _in_article(node: Node) -> bool:
    at = node.parent
    while at is not None:
        if at.tag in ("article", "main"):
            return True
        at = at.parent
    return False


def prune(root: Node) -> None:
    """Take out what never is main text."""
    for node in _walk(root):
        prose = False  # a paragraph came before: a list of links is one of references, not a menu
        for c in node.children:
            if not isinstance(c, Node):
                continue
            prose = prose or c.tag in ("p", "blockquote", "pre")
            if c.tag in APART or c.hidden or c.role in ROLES:
                c.gone = True
            elif c.tag == "header" and not _in_article(c):
                c.gone = not any(n.tag in ("article", "main", "p") for n in _walk(c))
            elif "header" in c.words and not _in_article(c) and c.tag not in ("html", "body", "main", "article"):
                c.gone = not any(n.tag in ("article", "main", "p") or n.tag in HEADINGS for n in _walk(c))
            elif c.words & COMMENTS and c.tag not in ("html", "body", "main"):
                c.gone = not _holds_article(c)
            elif c.words & TELLING and c.tag not in ("html", "body", "main", "article", "h1"):
                c.gone = not _holds_article(c)
            elif c.tag in ("ul", "ol") and not prose and not _in_article(c) and _only_links(c):
                c.gone = True


def _text(node: Node, links_only: bool = False) -> str:
    out: list[str] = []
    todo: list = [(node, not links_only)]
    while todo:
        n, take = todo.pop()
        if isinstance(n, str):
            if take:
                out.append(n)
            continue
        take = take or n.tag == "a"
        if n.tag == "br":
            out.append(" ")
        todo.extend((c, take) for c in reversed(n.children) if isinstance(c, str) or not c.gone)
    return " ".join("".join(out).split())


def _inline(node: Node) -> tuple[str, float]:
    """The text of an element outside the blocks in it, and the share of it in links."""
    out: list[str] = []
    linked = 0
    todo: list = [(node, False)]
    while todo:
        n, link = todo.pop()
        if isinstance(n, str):
            out.append(n)
            linked += len("".join(n.split())) if link else 0
        elif n.tag == "br":
            out.append(" ")
        elif n is node or n.tag not in BLOCK:
            todo.extend((c, link or n.tag == "a") for c in reversed(n.children) if isinstance(c, str) or not c.gone)
    words = "".join(out).split()
    return " ".join(words), linked / max(1, sum(map(len, words)))


def _only_links(node: Node) -> bool:
    if sum(n.tag == "a" for n in _walk(node)) < 3:
        return False
    return len(_text(node, True)) >= 0.9 * len(_text(node))


def score(root: Node) -> Node | None:
    """Scores the tree and returns the best container."""
    for node in _walk(root):
        own = node.tag in ("p", "pre", "blockquote", "td", "li", "dd")
        if not own and node.tag in BLOCK and node.tag not in HEADINGS:
            own = any(isinstance(c, str) and not c.isspace() for c in node.children)
        if not own:
            continue
        text, linked = _inline(node)
        if not text:
            continue
        points = (0.1 + min(3.0, len(text) / 100) + text.count(",") + text.count("，")) * (1 - linked)
        at, level = node.parent, 1
        while at is not None and level <= 5:
            at.score += points if level == 1 else points / 2 if level == 2 else points / (3 * level)
            at, level = at.parent, level + 1
    best = None
    for node in _walk(root):
        if node.tag in BLOCK and (node.score > 0) and (best is None or node.score > best.score):
            best = node
    return best


def _measured(root: Node) -> dict[int, tuple[int, int]]:
    """For each remaining element its characters but white space, and those of them in links."""
    found: dict[int, list[int]] = {}
    todo: list = [(root, False, False)]
    while todo:
        n, link, done = todo.pop()
        if done:
            if n.parent is not None and id(n.parent) in found:
                own, up = found[id(n)], found[id(n.parent)]
                up[0] += own[0]
                up[1] += own[1]
            continue
        found[id(n)] = here = [0, 0]
        todo.append((n, link, True))
        link = link or n.tag == "a"
        for c in n.children:
            if isinstance(c, str):
                size = len("".join(c.split()))
                here[0] += size
                here[1] += size if link else 0
            elif not c.gone:
                todo.append((c, link, False))
    return {k: (v[0], v[1]) for k, v in found.items()}


def container(root: Node) -> Node:
    """The element whose remaining blocks, all of them, are the main text: the article that holds the
    best-scored element, or else the outermost element above it that the climb reaches. The climb goes on while
    what an ancestor adds is not mostly links. Under ``body``, parts beside it stay if they hold a
    block of prose and are not mostly links; the others are taken out."""
    best = score(root)
    if best is None:
        return root
    at: Node | None = best
    found = None
    while at is not None:  # an article is kept whole
        if at.tag in ("article", "main") and not at.words & COMMENTS:
            found = at
            if at.tag == "article":
                break
        at = at.parent
    if found is not None:
        return found
    sizes = _measured(root)
    at = best
    while at.parent is not None and at.parent.tag not in ("body", "html", "#root"):
        (own, linked), (more, more_linked) = sizes[id(at)], sizes[id(at.parent)]
        if more_linked - linked > LINKED * (more - own):
            return at
        at = at.parent
    if at.parent is None:
        return at
    for c in at.parent.children:
        if isinstance(c, Node) and c is not at and not c.gone and c.tag in BLOCK:
            prose = any(n.tag in PROSE for n in _walk(c))
            c.gone = not prose or sizes[id(c)][1] > LINKED * sizes[id(c)][0]
    return at.parent


def blocks(top: Node) -> list[str]:
    """The blocks of text below ``top``, in page order."""
    out: list[str] = []
    part: list[str] = []

    def flush() -> None:
        text = " ".join("".join(part).split())
        part.clear()
        if text:
            out.append(text)

    todo: list = [(top, False)]
    while todo:
        n, ended = todo.pop()
        if isinstance(n, str):
            part.append(n)
        elif n.tag == "br":
            part.append(" ")
        elif ended:
            flush()
        else:
            if n.tag in BLOCK or n is top:
                flush()
                todo.append((n, True))
            todo.extend((c, False) for c in reversed(n.children) if isinstance(c, str) or not c.gone)
    flush()
    return out


def main_text(page: str) -> str:
    root = parse(page)
    prune(root)
    return "\n".join(blocks(container(root)))


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The kept columns and ``text`` of every page."""
    small_batches(pages.sparkSession)
    rows = pages.select(*keep, F.col(html_col).alias("_html"))
    names = [*keep, "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(p or "") for p in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(texts, pa.string())], names)

    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInArrow(run, f"{schema}, text string")
