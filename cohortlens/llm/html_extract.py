"""Main text of web pages by tree scoring.

A page becomes a tree of its elements; parts that are never article text by
their tag (navigation, headers, footers, asides, scripts, ...) are left out of
it. Paragraphs get points for their length and their commas. Classes, ids and
roles that name page furniture (comments, sidebars, adverts, forms) cut a part
only if the page has paragraphs outside such parts: a part that holds the
page's text is kept whatever its name. A name that merely mentions such a word
cuts link boxes only and costs score.

Paragraphs then pass their points to their ancestors, the nearer the more; a
container's score is discounted by its link density. The best container is
kept, with siblings that score well or read as text, and inside it everything
but link boxes ahead of the text or, after it, lists of short links alone.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from cohortlens.llm.common import prepare, table

# HTML element names by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
DROPPED = frozenset("""script style textarea title xmp noembed noframes iframe noscript template head nav header footer aside
    button select option datalist input label fieldset legend svg math canvas object applet audio video map menu dialog""".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dir div dl dt fieldset figcaption figure footer form h1 h2
    h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr caption
    ul""".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
# An opening tag ends the open element of a set, unless one of the barriers lies between.
ENDED_BY = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
            "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
            "option": ({"option"}, {"select"})}
CLOSES_P = BLOCK - {"html", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "legend", "summary"}
# Words that name page furniture, words that only say of what kind a box is, and words before a part's name.
FURNITURE = frozenset("""ad ads adbox advert adverts advertisement advertising adsense sponsor sponsors sponsored promo promos promotion banner popup
    modal overlay cookie cookies consent gdpr notice notices alert alerts newsletter subscribe subscription signup login nav navbar navigation
    menu menus topnav breadcrumb breadcrumbs pager pagination header masthead footer sidebar rail aside complementary contentinfo widget
    widgets related recommended recommendations share sharing social toolbar comment comments commentlist respond reply replies disqus
    discussion outbrain taboola skip search hidden metadata tags tagcloud""".split())
BOXES = frozenset("""list lists wrap wrapper container box block area section slot inner outer panel bar row col column item items link
    links unit module holder group thread form field posts articles stories""".split())
LAYOUT = frozenset("has with without no is two three".split())
_PARTS = re.compile(r"[-_:]+|(?<=[a-z])(?=[A-Z])")
_ARTICLE = re.compile(r"(?:^|[\s_-])(?:article|body|content|entry|main|post|story|text|blog)(?:$|[\s_-])", re.I)
_TOKEN = re.compile(r"""<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)
    |<([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+>|[^>]*+(?:>|\Z))""".replace("\n    ", ""), re.S)
_NAMED = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_SPACE = re.compile(r"\s+")
LEAST, FULL = 25, 300
SHORT_LINK = 20      # characters of a link in a list of links alone
FREE, SHARE = 3.0, 0.2  # points outside furniture that make a page's text: so many, or such a share of a part's own


class Node:
    """An element: its children are nodes and text pieces (raw, undecoded)."""

    __slots__ = ("tag", "parent", "children", "score", "names", "length", "linked", "points", "held", "furniture")

    def __init__(self, tag: str, parent: "Node | None", names: str = "", furniture: int = 0):
        self.tag, self.parent, self.names, self.furniture = tag, parent, names, furniture
        self.children: list[Node | str] = []
        self.score, self.length, self.linked = 0.0, 0, 0
        self.points = self.held = 0.0  # as a paragraph, and of all paragraphs inside


def _called(name: str) -> int:
    """2 if a class, id or role names furniture, 1 if it mentions some. The
    last part of a compound that is not a kind of box is what it names."""
    parts = [p.lower() for p in _PARTS.split(name) if p]
    if not parts or parts[0] in LAYOUT:  # has-sidebar says something about other parts
        return 0
    named = [p for p in parts if p not in BOXES and not any(c.isdigit() for c in p)]
    if named and named[-1] in FURNITURE and (len(parts) == 1 or named[-1] != "hidden"):
        return 2
    return int(any(p in FURNITURE and p != "hidden" for p in named))


def _furniture(tag: str, attributes: str) -> tuple[bool, str, int]:
    """(left out whatever it holds, names, how far they call it furniture)."""
    if tag in DROPPED:
        return True, "", 0
    called = 2 if tag == "form" else 0
    if not attributes or tag in ("html", "body"):
        return False, "", called
    names = []
    for key, a, b, c in _NAMED.findall(attributes):
        key, value = key.lower(), a or b or c
        if key == "hidden" or key == "aria-hidden" and value == "true":
            return True, "", 0
        if key == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return True, "", 0
        else:
            names += value.split()
    if tag not in ("article", "main"):
        called = max([called, *(_called(x) for x in names)])
    return False, " ".join(names), called


def parse(page: str) -> Node:
    """The tree of a page without its furniture. Unclosed elements end with
    their parents, stray end tags are ignored, a cut-off tag is dropped."""
    root = Node("#root", None)
    stack, skipped = [root], 0  # skipped: depth of the stack's part that is left out
    at, n = 0, len(page)
    while at < n:
        cut = page.find("<", at)
        if cut < 0:
            cut = n
        if cut > at and not skipped:
            stack[-1].children.append(page[at:cut])
        if cut == n:
            break
        m = _TOKEN.match(page, cut)
        if not m:  # a bare <
            if not skipped:
                stack[-1].children.append("&lt;")
            at = cut + 1
            continue
        at = m.end()
        end, tag, rest = m.group(1), m.group(2), m.group(3)
        if end:
            end = end.lower()
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == end:
                    del stack[depth:]
                    skipped = min(skipped, len(stack)) if skipped < len(stack) else 0
                    break
                if stack[depth].tag in ("td", "th", "table") and end not in BLOCK:
                    break
            continue
        if not tag:
            continue
        tag = tag.lower()
        if not rest.endswith(">"):
            break
        if tag in CLOSES_P:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == "p":
                    del stack[depth:]
                    break
                if stack[depth].tag in BLOCK or stack[depth].tag in ("button", "object"):
                    break
        if tag in ENDED_BY:
            ended, barrier = ENDED_BY[tag]
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag in ended:
                    del stack[depth:]
                    break
                if stack[depth].tag in barrier:
                    break
        if skipped and len(stack) <= skipped:
            skipped = 0
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)|\Z", re.I).search(page, at)
            at = close.end()
            continue
        if tag in VOID or rest.endswith("/>") and tag not in BLOCK:
            if not skipped and tag in ("br", "hr", "wbr"):
                stack[-1].children.append(Node(tag, stack[-1]))
            continue
        left_out, names, called = (True, "", 0) if skipped else _furniture(tag, rest[:-1])
        node = Node(tag, stack[-1], names, called)
        if left_out:
            skipped = skipped or len(stack)
        else:
            stack[-1].children.append(node)
        stack.append(node)
    return root


def _measure(root: Node) -> list[Node]:
    """Text lengths, link text lengths and paragraph points of a tree, bottom
    up; its nodes in page order."""
    order, todo = [], [(root, False)]
    while todo:
        cur, link = todo.pop()
        link = link or cur.tag == "a"
        order.append((cur, link))
        todo.extend((c, link) for c in reversed(cur.children) if isinstance(c, Node))
    for cur, _ in order:
        cur.length = cur.linked = 0
        cur.score = cur.points = cur.held = 0.0
    for cur, link in reversed(order):
        own = sum(len(_SPACE.sub(" ", c).strip()) for c in cur.children if isinstance(c, str))
        cur.length += own
        cur.linked += own if link else 0
        cur.points = _points(cur)
        cur.held += cur.points
        if cur.parent:
            cur.parent.length += cur.length
            cur.parent.linked += cur.linked
            cur.parent.held += cur.held
    return [cur for cur, _ in order]


_BOX = ("div", "section", "article", "main", "body")


def _blocky(node: Node) -> bool:
    return any(isinstance(c, Node) and c.tag in BLOCK for c in node.children)


def _points(node: Node) -> float:
    """A paragraph's points: for its length and its commas."""
    if node.tag not in ("p", "pre", "blockquote", "td", "dd", "li", *_BOX):
        return 0.0
    if _blocky(node):
        text = " ".join(_SPACE.sub(" ", c).strip() for c in node.children if isinstance(c, str))
        length = len(text)
    else:
        text, length = _flat(node), node.length
    return 1 + text.count(",") + min(length / 100, FULL / 100) if length >= LEAST else 0.0


def _score(order: list[Node]) -> None:
    """Every paragraph's points passed on to its container and three more."""
    for cur in order:
        to, share = (cur if cur.tag in _BOX or _blocky(cur) else cur.parent), 1.0
        for up in range(4 if cur.points else 0):
            if to is None or to.tag == "#root":
                break
            to.score += cur.points * share
            to, share = to.parent, 0.5 if up == 0 else 1 / (3 * (up + 1))


def _prune(root: Node) -> None:
    """Cut furniture by name. A part so named stays, with its own furniture
    judged in turn, if it holds a good paragraph at least and nearly all of the
    points outside such parts would go with it; where an article element has
    text of its own, none stays."""

    def free(top: Node) -> tuple[float, bool]:
        """Points of a part outside the furniture in it, and whether an
        article element there has text."""
        total, article, todo = top.held, False, [(top, top.tag in ("article", "main"))]
        while todo:
            cur, inside = todo.pop()
            for c in cur.children:
                if isinstance(c, str):
                    article = article or inside and not c.isspace()
                elif c.furniture == 2:
                    total -= c.held
                else:
                    todo.append((c, inside or c.tag in ("article", "main")))
        return total, article

    todo = [(root, *free(root))]
    while todo:
        cur, outside, article = todo.pop()
        kept: list[Node | str] = []
        for c in cur.children:
            if isinstance(c, Node):
                if c.furniture == 2 and (article or c.held < FREE or outside >= FREE or outside >= SHARE * c.held):
                    continue
                if c.furniture == 1 and not c.points and _density(c) > 0.5:
                    continue
                todo.append((c, *(free(c) if c.furniture == 2 else (outside, article))))
            kept.append(c)
        cur.children = kept


def _flat(node: Node) -> str:
    parts, todo = [], [node]
    while todo:
        cur = todo.pop()
        if isinstance(cur, str):
            parts.append(cur)
        else:
            todo.extend(reversed(cur.children))
    return "".join(parts)


def _density(node: Node) -> float:
    return node.linked / node.length if node.length else 0.0


def _worth(node: Node) -> float:
    bonus = 1.25 if node.tag in ("article", "main") or node.names and _ARTICLE.search(node.names) else 1.0
    return node.score * bonus * (0.5 if node.furniture else 1.0) * (1 - _density(node))


def main_nodes(root: Node) -> list[Node]:
    """The best container and the siblings kept with it, in page order."""
    _measure(root)
    _prune(root)
    _score(_measure(root))
    best, todo = None, [root]
    while todo:
        cur = todo.pop()
        if cur.score > 0 and cur.tag not in ("p", "a") and (best is None or _worth(cur) > _worth(best)):
            best = cur
        todo.extend(reversed([c for c in cur.children if isinstance(c, Node)]))
    if best is None:
        return [root]
    up = best
    while up.parent and up.parent.tag != "#root":  # a container inside an article stands for the article
        up = up.parent
        if up.tag in ("article", "main") and _density(up) < 0.5:
            best = up
            break
    if best.parent is None or best.tag in ("article", "main", "body"):
        return [best]
    least, kept = max(5.0, 0.2 * _worth(best)), []
    for c in best.parent.children:
        if not isinstance(c, Node):
            continue
        text_like = c.tag in HEADING and _density(c) < 0.5 or c.tag in ("p", "pre", "blockquote") and c.length and _density(c) < 0.25
        if c is best or c.tag in BLOCK and (_worth(c) >= least or text_like):
            kept.append(c)
    return kept


def _short_links(node: Node) -> bool:
    """Whether a box has links alone, short ones on average."""
    links, todo = [], [node]
    while todo:
        cur = todo.pop()
        if cur.tag == "a":
            links.append(cur.length)
        else:
            todo.extend(c for c in cur.children if isinstance(c, Node))
    return bool(links) and node.linked >= 0.9 * node.length and sum(links) / len(links) < SHORT_LINK


def _link_boxes(nodes: list[Node]) -> set[Node]:
    """The boxes of links that are no part of the text: those ahead of its
    first paragraph, and lists of short links after its last one."""
    place, paragraphs, boxes, todo = 0, [], [], [(top, False) for top in reversed(nodes)]
    while todo:
        cur, inside = todo.pop()
        place += 1
        box = cur.tag in ("ul", "ol", "div", "section", "table", "dl") and cur not in nodes and cur.length and _density(cur) > 0.5
        if box and not inside:
            boxes.append((place, cur))
        elif not inside and cur.points and _density(cur) <= 0.5:
            paragraphs.append(place)
        todo.extend((c, inside or bool(box)) for c in reversed(cur.children) if isinstance(c, Node))
    first, last = (paragraphs[0], paragraphs[-1]) if paragraphs else (place + 1, place + 1)
    return {box for at, box in boxes if at < first or at > last and _short_links(box)}


def blocks_of(nodes: list[Node]) -> list[str]:
    """The text blocks of the kept parts, decoded, white space joined."""
    out: list[str] = []
    piece: list[str] = []
    left_out = _link_boxes(nodes)

    def flush() -> None:
        text = " ".join("".join(piece).split())
        if text:
            out.append(text)
        piece.clear()

    for top in nodes:
        todo: list = [top]
        while todo:
            cur = todo.pop()
            if cur is None:
                flush()
            elif isinstance(cur, str):
                piece.append(html.unescape(cur))
            elif cur.tag in ("br", "wbr"):
                piece.append(" " if cur.tag == "br" else "")
            elif cur.tag in BLOCK:
                if cur in left_out:
                    continue
                flush()
                todo.append(None)
                todo.extend(reversed(cur.children))
            else:
                todo.extend(reversed(cur.children))
        flush()
    return out


def extract(page: str | None) -> str:
    """Main text of one page; null, empty and text-free pages give ''."""
    return "\n\n".join(blocks_of(main_nodes(parse(page)))) if page else ""


def extract_pages(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html; other columns are
    ignored): page_id, url, text, n_chars. Null or empty html gives an empty
    text; null or repeated page_ids and urls are kept as they are; every page
    is read whole."""
    prepare(pages.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                texts = [extract(x) for x in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, type=pa.string()),
                                                  pa.array([len(t) for t in texts], type=pa.int64())],
                                                 names=["page_id", "url", "text", "n_chars"])

    rows = pages.selectExpr("cast(page_id as long) page_id", "cast(url as string) url", "cast(html as string) html")
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return extract_pages(table(spark, sf_dir, "pages"))
