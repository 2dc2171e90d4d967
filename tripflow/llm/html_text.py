"""Main text of web pages by composite text density.

A page is read into a tree. What isn't main text by its element or name (menus, headers, footers,
sidebars, notices, adverts, forms, comments) is marked as it is met and left out once the tree is
whole, unless the main text proves to lie in it (see ``leave_out``). For every node left the link-adjusted characters per tag are computed, and summed over its children. The subtree with
the largest sum is main text; the smallest density on its path to the body is the threshold that
other subtrees must reach to be main text too.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.words import groups

# Element names of HTML by what they do to text.
_VOID = frozenset("area base br col embed hr img input link meta source track wbr param".split())
_RAW = frozenset("script style textarea title xmp noembed noframes".split())
_DROPPED = frozenset(
    "head nav header footer aside form menu dialog button select option noscript template iframe object svg math canvas audio video "
    "script style textarea title xmp noembed noframes".split()
)
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s samp small span strike strong sub sup "
    "time tt u var wbr img nobr".split()
)
_CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr main menu nav ol p pre section table ul".split()
)
_SAME_CLOSES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
_SAME_CLOSES |= dict.fromkeys(("tbody", "thead", "tfoot"), ("table",))
_SAME_GROUPS = (("dt", "dd"), ("td", "th"), ("tbody", "thead", "tfoot"))
_KEPT = frozenset(("html", "body", "article", "main"))
# Never shown as text of the page, whatever they contain.
_NEVER = frozenset("head select option noscript template iframe object svg math canvas audio video".split())
# Elements that a head may hold; anything else ends it.
_IN_HEAD = frozenset("base link meta noscript script style template title noframes".split())
# What a list item or cell can't close from within.
_HELD = _DROPPED - {"option"} | {"table", "td", "th"}
_ENDS_HELD = frozenset("template object svg math".split())
# Words of names in class, id or role of what isn't main text.
_ASIDE_WORD = re.compile(
    r"ads?|adverts?|advertise\w*|adsense|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notice|newsletter|subscribe|"
    r"sidebar|comments?|commentlist|disqus|respond|share|sharing|social|related|recommend\w*|menu|nav|navbar|navigation|breadcrumbs?|"
    r"footer|header|masthead|popup|modal|overlay|login|signup|search|toolbar|pagination|pager|contentinfo|complementary",
    re.IGNORECASE,
)
# Words that may stand beside them: the name is still one of the element itself. Any other word (has,
# no, with, layout, results, history, work ...) makes it a name of something else.
_BESIDE = frozenset(
    "site page global main top bottom primary secondary post posts article articles box bar block area list links link buttons button "
    "icons icon form widget widgets section panel message dialog unit slot item items".split()
)
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
_SHOWN, _BY_NAME, _BY_ELEMENT, _HIDDEN = range(4)
_ATTRIBUTE = re.compile(r"""(?:^|[\s"'])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.IGNORECASE)
_MARK = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*+)((?>[^>"']++|"[^"]*"|'[^']*')*+|[^>]*+)>""", re.DOTALL
)


class Node:
    __slots__ = ("name", "parent", "children", "aside", "home", "chars", "tags", "link_chars", "link_tags", "density", "sum")

    def __init__(self, name: str, parent: Node | None, aside: int = _SHOWN, home: bool = False):
        self.name, self.parent = name, parent
        # Why it may be left out, and whether the page says that main text lies in it.
        self.aside, self.home = aside, home
        # Nodes and strings in page order.
        self.children: list[Node | str] = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.sum = 0.0


def _stands_for_aside(value: str) -> bool:
    """Whether one of the names in an attribute is that of a menu, sidebar, notice or the like itself."""
    for name in value.lower().split():
        words = [w for w in re.split("[_-]", name) if w]
        asides = [bool(_ASIDE_WORD.fullmatch(w)) for w in words]
        if any(asides) and all(a or w in _BESIDE for a, w in zip(asides, words, strict=True)):
            return True
    return False


def _aside(name: str, attributes: str) -> tuple[int, bool]:
    """Why an element may be left out, and whether the page says that main text lies in it."""
    if name in _NEVER:
        return _HIDDEN, False
    found = _BY_NAME if name == "form" else _BY_ELEMENT if name in _DROPPED else _SHOWN
    home = name in ("article", "main")
    if not attributes or name in _KEPT:
        return found, home
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            found = max(found, _BY_ELEMENT)
        elif key == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE):
                found = max(found, _BY_ELEMENT)
        elif key == "role" and value.lower() in ("main", "article"):
            home = True
        # Headings have ids made of their text.
        elif key in ("class", "id", "role") and not (key == "id" and name in _HEADINGS) and _stands_for_aside(value):
            found = max(found, _BY_NAME)
    return found, home


def parse(page: str) -> Node:
    """Tree of the page. Elements left open end with their parent or the page, or with the tag that
    implies their end, whether they may be left out or not."""
    root = Node("html", None)
    node, at = root, 0

    size = len(page)
    while at < size:
        mark = _MARK.search(page, at)
        text = page[at : mark.start()] if mark else page[at:]
        if text:
            if node.name == "head" and not text.isspace():
                node = node.parent
            node.children.append(html.unescape(text))
        if not mark:
            break
        at = mark.end()
        if mark[2] is None:
            continue
        name, closing = mark[2].lower(), mark[1] == "/"
        if closing:
            up = node
            while up is not root and up.name != name:
                # An inline element can't close what is outside its block, and nothing what is outside foreign content.
                if name in _INLINE and up.name not in _INLINE or up.name in _ENDS_HELD:
                    up = root
                    break
                up = up.parent
            if up is not root:
                node = up.parent
            elif name == "p" or name == "br":
                node.children.append(" ")
            continue
        if name in _RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>|\Z", re.IGNORECASE).search(page, at)
            at = end.end()
            continue
        if node.name == "head" and name not in _IN_HEAD:
            node = node.parent
        if name in ("html", "body"):
            continue
        if name in _VOID:
            node.children.append(Node(name, node))
            continue
        if mark[3].endswith("/") and name not in _INLINE and name in ("svg", "math"):
            continue
        if name in _CLOSES_P:
            up = node
            while up is not root and up.name in _INLINE:
                up = up.parent
            if up.name == "p":
                node = up.parent
        if name in _SAME_CLOSES:
            up, stop = node, _SAME_CLOSES[name]
            same = next((g for g in _SAME_GROUPS if name in g), (name,))
            # Cells and rows end whatever is left open in them but a table; items don't end what holds them.
            held = () if "table" in stop else _HELD
            while up is not root and up.name not in same and up.name not in stop and up.name not in held:
                up = up.parent
            if up.name in same:
                node = up.parent
        child = Node(name, node, *_aside(name, mark[3]))
        node.children.append(child)
        node = child
    return root


def _cut(root: Node, least: int) -> bool:
    """Leaves out what is marked so or higher; whether anything marked is left."""
    left, stack = False, [root]
    while stack:
        node = stack.pop()
        node.children = [c for c in node.children if isinstance(c, str) or c.aside < least]
        below = [c for c in node.children if isinstance(c, Node)]
        left = left or any(c.aside for c in below)
        stack += below
    return left


def leave_out(root: Node) -> None:
    """Takes out of the tree what isn't main text by its element or name.

    A guess by name gives way to what the page shows. Marked elements around an article or main
    element stay if the page has none elsewhere. Those that are marked by name, forms too, also stay
    if they hold the largest density sum, unless an article or main element stands apart from them.
    """
    if not _cut(root, _HIDDEN):
        return
    # Parents first, so that each node knows whether it lies in a marked one.
    homes, free, stack = [], [], [(root, False)]
    while stack:
        node, within = stack.pop()
        within = within or node.aside > _SHOWN
        if node.home:
            (homes if within else free).append(node)
        stack += [(c, within) for c in node.children if isinstance(c, Node)]
    if not free:
        seen = set()
        for node in homes:
            # Up to where another one has been.
            while node and id(node) not in seen:
                seen.add(id(node))
                node.aside = _SHOWN
                node = node.parent
        free = homes
    if _cut(root, _BY_ELEMENT):
        best = max(measure(root), key=lambda n: (n.sum, n.density))
        over = {id(n) for n in _path(best)}
        if not free or any(id(h) in over for h in free):
            for node in _path(best):
                node.aside = _SHOWN
        _cut(root, _BY_NAME)


def _in_order(root: Node) -> list[Node]:
    """Nodes, parents before children."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack += [c for c in node.children if isinstance(c, Node)]
    return out


def measure(root: Node) -> list[Node]:
    """Characters, tags and densities of every node; returns the nodes, parents first."""
    nodes = _in_order(root)
    for node in nodes:
        node.chars = node.tags = node.link_chars = node.link_tags = 0
        node.density = node.sum = 0.0
    for node in reversed(nodes):
        own = 0
        for child in node.children:
            if isinstance(child, str):
                own += len("".join(child.split()))
            else:
                node.chars += child.chars
                node.tags += child.tags + 1
                node.link_chars += child.link_chars
                node.link_tags += child.link_tags
        node.chars += own
        if node.name == "a":
            node.link_chars, node.link_tags = node.chars, node.link_tags + 1
    share = root.link_chars / max(root.chars, 1)
    for node in nodes:
        c, t, lc, lt = node.chars, max(node.tags, 1), max(node.link_chars, 1), max(node.link_tags, 1)
        if c:
            plain = max(c - node.link_chars, 1)
            base = math.log(c / plain * node.link_chars + share * c + math.e)
            # The base is 1 for a page without links: then the logarithm itself is taken.
            spread = math.log(max(c / lc * t / lt, 1.0)) / (math.log(base) or 1.0) if base > math.e**0.5 else math.log(max(c / lc * t / lt, 1.0))
            node.density = c / t * spread
        if node.parent:
            node.parent.sum += node.density
    return nodes


def _path(node: Node) -> list[Node]:
    out = [node]
    while out[-1].parent:
        out.append(out[-1].parent)
    return out


def main_nodes(root: Node) -> list[Node]:
    """Roots of the subtrees that are main text."""
    nodes = measure(root)
    if not root.chars:
        return []
    best = max(nodes, key=lambda n: (n.sum, n.density))
    threshold = min(n.density for n in _path(best))
    # The element that stands for the article holds it whole.
    for node in _path(best):
        if node.name in ("article", "main"):
            best = node
            break
    chosen = [best]
    on_path = {id(n) for n in _path(best)}
    for node in _path(best)[1:]:
        chosen += [c for c in node.children if isinstance(c, Node) and id(c) not in on_path and c.density >= threshold and c.chars and best.name not in ("article", "main")]
        if best.name in ("article", "main"):
            chosen += [c for c in node.children if isinstance(c, Node) and id(c) not in on_path and c.name == best.name]
    return chosen


def _blocks(node: Node, out: list[str], block: list[str]) -> None:
    """Texts of the blocks under a node, in page order, without recursion."""
    stack: list[Node | str | None] = [node]
    while stack:
        top = stack.pop()
        if isinstance(top, str):
            block.append(top)
        elif top is None:
            out.append("".join(block))
            block.clear()
        elif top.name in _INLINE:
            stack += reversed(top.children)
        else:
            stack += [None, *reversed(top.children), None]


def main_text(page: str | None) -> str:
    """Main text of a page: character references decoded, white space in a block one space, blocks
    in page order joined by one space. Empty for a null or empty page and one without text."""
    if not page:
        return ""
    root = parse(page)
    leave_out(root)
    chosen = {id(n) for n in main_nodes(root)}
    out: list[str] = []
    block: list[str] = []
    # In page order: the nodes were chosen outermost, none within another.
    stack: list[Node] = [root]
    while stack:
        node = stack.pop()
        if id(node) in chosen:
            _blocks(node, out, block)
            out.append("".join(block))
            block.clear()
        else:
            stack += reversed([c for c in node.children if isinstance(c, Node)])
    return " ".join(x for x in (" ".join(b.split()) for b in out) if x)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in groups(batches, "html"):
        texts = pa.array([main_text(p) for p in batch.column("html").to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays([batch.column("row_id"), batch.column("url"), texts], names=["row_id", "url", "text"])


def extract(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """(page_id, url, text) for each row; see ``main_text``.

    Repeated rows are read alike, null ids and urls stay null, an empty table gives an empty result.
    Other columns are not read. Each page is read where it lies, whole.
    """
    rows = pages.select(F.col(id_column).alias("row_id"), F.col(url_column).cast("string").alias("url"), F.col(html_column).cast("string").alias("html"))
    id_type = dict(rows.dtypes)["row_id"]
    return rows.mapInArrow(_rows, f"row_id {id_type}, url string, text string").withColumnsRenamed({"row_id": id_column, "url": url_column})
