"""Main text of web pages by composite text density (operator 7).

A page becomes a tree. For every node the composite density is the link-adjusted number of characters per
tag: C / T * log(C / LC * T / LT) to a base that grows with the page's share of links, where C and T are
characters and tags below the node, LC and LT those in links, and the other characters stand in for none. Child
densities are summed for each node; the block of the largest sum, or the one block below it that holds nearly
all of its text, is the core. The smallest density on the path from the body to the core is the threshold.

Tags, roles, classes and ids are hints that enter the densities: text of what they name as a menu, header, footer,
sidebar, notice, advert, form or reader comment counts as link text, so its density is next to none, unless that
holds the only <article> or <main>, or most of the text outside links of a page that has none with text of its own; a
short open <article> stands beside comments of any length. A sum below an <article> or <main> counts twice. A core below an <article> grows to it where its density stays near the core's.

Outside the core every block that reaches the threshold, and has a node whose density comes near those of the
core's children, gives its node of the largest sum; a core whose <article> holds most of the plain text needs
none. The last <h1> before the core, and headings right before it, belong to it. Inside, what is hinted at and lists of
links below the threshold are left out. Scripts, styles, form controls and the like have no text.

The text of the article's blocks then has its character references decoded, white space turned into one
blank and ends trimmed; blocks that aren't empty are joined by a line feed in page order.

Defined cases: a null or text-less page gives an empty text; a page whose text is all in links gives all of it;
markup that is cut off, unclosed or wrongly nested is read as browsers would roughly read it: an open comment,
script or style runs to the end, an end tag closes the nearest open element of its name, and <p>, <li> and the
like close their open sibling; very long pages are read whole, and depth is kept on a list, never on the call
stack; repeated rows each get a result; columns named text or n_chars, in any case, are replaced, all others stay as they
are, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from terrafold.llm.common import with_results

# Fixed values of HTML: elements without content, with raw text, that break lines, and that close an open sibling.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
# Elements, roles and words of class or id that mark what isn't article text.
CUT_TAGS = frozenset("aside button dialog footer form head iframe input label map menu nav noscript object script select style svg template textarea canvas audio video".split())
CUT_ROLES = frozenset("banner navigation complementary contentinfo search form dialog alert alertdialog menu menubar toolbar".split())
CUT_WORDS = frozenset(
    "ad|ads|adsbygoogle|adslot|adbox|adv|advert|adverts|advertisement|advertising|banner|sponsor|sponsored|promo|promotion|nav|navbar|navigation|menu|menus|breadcrumb|breadcrumbs|sidebar|aside|"
    "footer|foot|header|masthead|topbar|cookie|cookies|consent|gdpr|notice|notices|alert|popup|modal|overlay|newsletter|subscribe|signup|login|search|comment|comments|commentlist|disqus|discussion|replies|"
    "reply|responses|related|recommended|share|sharing|social|widget|pagination|pager|toolbar|skip|copyright|disclaimer".split("|")
)
#: Words that may stand beside them in a compound name of the same thing, as in ad-slot or site-footer.
BESIDE = frozenset("side bar site page main global top bottom left right center primary secondary slot box block list area container wrapper wrap inner unit section panel item items form link links buttons icons post posts content articles".split())
#: Sections of an article that go by such a word.
OWN_SECTIONS = frozenset("discussion responses related notice notices alert disclaimer".split())
_PARTS = re.compile(r"[_-]+")
#: Elements whose content is no text of the page.
TEXTLESS = RAW | frozenset("audio button canvas dialog head iframe input label map noscript object select svg template video".split())
#: What stays hinted at whatever it holds.
KEPT_CUT = TEXTLESS | frozenset(("menu", "nav"))
#: Blocks that hold other blocks, so that a list of links may be one.
HOLDERS = BLOCKS - frozenset("address blockquote br caption dd dt figcaption h1 h2 h3 h4 h5 h6 hr legend li option p pre summary".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Share of the text that makes a block stand for the one round it; of the core's density that others, and an <article> round it, must reach.
NEARLY_ALL, NEAR, GROWS = 0.8, 0.4, 0.3
# Headers that belong to an article, by their class or id.
OWN_HEADER = re.compile(r"^(?:article|entry|post|story|content)[_-]*(?:header|head|title)$", re.I)
TITLE_WORDS = re.compile(r"^[\w-]*(?:header|masthead)$", re.I)
_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|$)|'[^']*(?:'|$))*)(?:>|$)", re.S)
_ATTR = re.compile(r"(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("chars", "children", "cut", "density", "link_chars", "link_tags", "linked", "parent", "tag", "tags", "total")

    def __init__(self, tag: str, parent: Node | None, cut: bool):
        self.tag, self.parent, self.cut = tag, parent, cut
        self.children: list[Node | str] = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0
        self.linked = False

    @property
    def plain(self) -> int:
        return self.chars - self.link_chars


def names_boilerplate(token: str) -> bool:
    """Whether a class or id names boilerplate as a whole; has-sidebar or page-header-fixed name what is round it."""
    if token == "side-bar":
        return True
    parts = [x for x in _PARTS.split(token) if x]
    return any(x in CUT_WORDS for x in parts) and all(x in CUT_WORDS or x in BESIDE or x.isdigit() for x in parts)


def boilerplate(tag: str, attrs: str, inside: bool) -> bool:
    """Whether an element is hinted at. inside: it stands in an <article>, whose own <header> is not."""
    if tag in CUT_TAGS or tag == "header" and not inside:
        return True
    if not attrs or tag in ("html", "body", "article", "main"):
        return False
    for name, a, b, c in _ATTR.findall(attrs):
        name, value = name.lower(), a or b or c
        if name in ("class", "id"):
            own = OWN_HEADER.search(value) or inside and (TITLE_WORDS.search(value) or tag == "section" and value.lower() in OWN_SECTIONS)
            if not own and any(map(names_boilerplate, value.lower().split())):
                return True
        elif name == "role":
            if value.lower() in CUT_ROLES:
                return True
        elif name == "style":
            if _HIDDEN.search(value):
                return True
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
    return False


def parse(page: str) -> Node:
    """The page's tree; text is kept as written."""
    root = node = Node("html", None, False)
    at, article = 0, 0
    size = len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        if m is None:
            node.children.append(page[at:])
            break
        if m.start() > at:
            node.children.append(page[at : m.start()])
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:
            if tag in VOID:
                continue
            up = node
            while up is not None and up.tag != tag:
                if up.tag in ("article", "main", "td", "table", "body") and tag not in BLOCKS:
                    up = None
                    break
                up = up.parent
            if up is not None and up.parent is not None:
                while node is not up:
                    article -= node.tag == "article"
                    node = node.parent
                article -= node.tag == "article"
                node = node.parent
            continue
        if tag in ("html", "body"):
            continue
        if tag in BLOCKS and tag != "br":  # a block ends an open paragraph, and what is open in it
            up = node
            while up.parent is not None and up.tag not in ("p", "article", "body", "main", "td", "div", "li", "section", "button"):
                up = up.parent
            if up.tag == "p":
                node = up.parent
        if tag in CLOSES:
            ends, stops = CLOSES[tag]
            up = node
            while up.parent is not None and up.tag not in ends and up.tag not in stops:
                up = up.parent
            while up.tag in ends and up.parent is not None:
                node = up = up.parent
        new = Node(tag, node, boilerplate(tag, m[3], article > 0))
        node.children.append(new)
        if tag in RAW:
            end = re.compile(rf"</{tag}[\s/>]", re.I).search(page, at)
            at = page.find(">", end.start()) + 1 or size if end else size
        elif tag not in VOID and not m[3].rstrip().endswith("/"):
            node = new
            article += tag == "article"
    return root


def restore(root: Node) -> None:
    """Takes back the hints round an <article> or <main> where none stands outside cuts, and, where the page has no open one
    with text, round blocks with most of the page's text. Text in links doesn't count.

    An open <article> or <main> with text keeps the page's hints however short it is, beside comments or an aside of any length."""
    order, stack = [], [(root, False, False)]
    plain: dict[Node, int] = {}
    marks, open_marks = [], []
    while stack:
        node, cut, link = stack.pop()
        if node.tag in KEPT_CUT:
            continue
        cut, link = cut or node.cut, link or node.tag == "a"
        order.append(node)
        plain[node] = 0 if link else sum(len(c.strip()) for c in node.children if isinstance(c, str))
        if node.tag in ("article", "main"):
            marks.append(node)
            if not cut:
                open_marks.append(node)
        stack.extend((c, cut, link) for c in node.children if isinstance(c, Node))
    if not any(n.cut for n in order):
        return
    shown = {n: 0 if n.cut else plain[n] for n in order}
    for node in reversed(order):
        if node.parent is not None:
            plain[node.parent] += plain[node]
            if not node.cut:
                shown[node.parent] += shown[node]
    if marks and not open_marks:
        up = max(marks, key=plain.__getitem__)
        while up is not None:
            up.cut, up = False, up.parent
    if not any(shown[n] for n in open_marks):
        for node in order:
            if plain[node] * 2 > plain[root] and any(isinstance(c, Node) and c.tag in BLOCKS and plain.get(c) for c in node.children):
                node.cut = False


def measure(root: Node) -> list[Node]:
    """Sets counts and densities; gives the nodes that have text, parents first. Hinted text counts as link text."""
    order, stack = [], [(root, False)]
    while stack:
        node, linked = stack.pop()
        if node.tag in TEXTLESS:
            node.cut = True
            continue
        order.append(node)
        node.linked = linked = linked or node.cut or node.tag == "a"
        for child in reversed(node.children):
            if isinstance(child, Node):
                stack.append((child, linked))
            else:
                n = len(child.strip())
                node.chars += n
                if linked:
                    node.link_chars += n
    for node in reversed(order):
        if node.parent is not None:
            up = node.parent
            up.chars += node.chars
            up.link_chars += node.link_chars
            up.tags += node.tags + 1
            up.link_tags += node.link_tags + (node.cut or node.tag == "a")
    share = root.link_chars / max(1, root.chars)
    for node in reversed(order):
        node.density = density(node, share)
        if node.parent is not None:
            node.parent.total += node.density
    return order


def density(node: Node, share: float) -> float:
    """Composite text density; share: of the page's characters that are in links."""
    c, t = node.chars, max(1, node.tags)
    if not c:
        return 0.0
    lc, lt = max(1, node.link_chars), max(1, node.link_tags)
    bend = math.log(c * node.link_chars / max(1, node.plain) + share * c + math.e)
    return c / t * max(0.0, math.log(max(1.0, c / lc * t / lt)) / bend + 1e-9)


def strength(node: Node) -> float:
    return node.total or node.density


def core_of(full: list[Node]) -> Node:
    """The holder of blocks of the largest sum, then the one below that has nearly all of its plain text, and so on."""
    doubled = {n for n in full if n.tag in ("article", "main")}
    for node in full:
        if node.parent in doubled:
            doubled.add(node)
    holders = [n for n in full if n.parent is None or n.tag in HOLDERS]
    core = max(holders, key=lambda n: strength(n) * (2 if n in doubled else 1))
    while True:
        below = [c for c in core.children if isinstance(c, Node) and c.tag in HOLDERS and c.plain >= NEARLY_ALL * core.plain]
        if not below:
            break
        core = below[0]
    up = core
    while up is not None and up.tag not in ("article", "main"):
        up = up.parent
    return up if up is not None and up.density >= GROWS * core.density else core


def article_of(root: Node, order: list[Node]) -> tuple[list[Node], float]:
    """The nodes whose texts are the page's article, in page order and none within another; and the threshold."""
    full = [n for n in order if n.plain > 0]
    if not full:
        return [root], 0.0
    core = core_of(full)
    path = [core]
    while path[-1].parent is not None:
        path.append(path[-1].parent)
    threshold = min(n.density for n in path)
    parts = [c for c in core.children if isinstance(c, Node) and c.plain > 0 and c.tag in BLOCKS] or [core]
    near = NEAR * sum(n.density * n.plain for n in parts) / sum(n.plain for n in parts)
    best: dict[Node, Node] = {}  # below each node, the node of the largest sum; the outer one of equal sums
    peak: dict[Node, float] = {}
    for node in reversed(full):
        if node not in best or strength(node) >= strength(best[node]):
            best[node] = node
        peak[node] = max(peak.get(node, 0.0), node.density)
        up = node.parent
        if up is not None:
            if up not in best or strength(best[node]) >= strength(best[up]):
                best[up] = best[node]
            peak[up] = max(peak.get(up, 0.0), peak[node])
    on_path = set(path)
    chosen = {core}
    if core.tag != "article" or 2 * core.plain < root.plain:
        chosen |= {best[n] for n in full if n not in on_path and n.tag in BLOCKS and not n.linked and n.density >= threshold and peak[n] >= near}
    out, pending, title = [], [], None
    stack, found = [root], False
    while stack:
        node = stack.pop()
        if node in chosen:
            if node is core:
                found = True
                if title is not None and title not in pending:
                    out.append(title)
            out.extend(pending)
            pending, title = [], title if not found else None
            out.append(node)
        elif node.tag in HEADINGS and not node.linked and node.plain > node.link_chars and not found:
            pending.append(node)
            if node.tag == "h1":
                title = node
        else:
            if node.tag in BLOCKS and node.chars and node not in on_path and node.tag not in HOLDERS:
                pending = []
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node) and not c.cut)
    if title in out:
        place = {n: i for i, n in enumerate(order)}
        out.sort(key=place.__getitem__)
    return out, threshold


def list_of_links(node: Node, threshold: float) -> bool:
    return node.tag in HOLDERS and node.link_tags > 2 and node.link_chars > node.plain and node.density < threshold


def blocks_of(node: Node, threshold: float = 0.0) -> list[str]:
    """The texts between block boundaries below a node, in page order."""
    out: list[str] = []
    run: list[str] = []

    def flush() -> None:
        text = _SPACE.sub(" ", html.unescape("".join(run))).strip() if run else ""
        if text:
            out.append(text)
        run.clear()

    stack: list[tuple[Node | str, bool]] = [(node, False)]
    while stack:
        item, leave = stack.pop()
        if isinstance(item, str):
            run.append(item)
        elif leave:
            flush()
        elif not item.cut and (item is node or not list_of_links(item, threshold)):
            if item.tag in BLOCKS:
                flush()
                stack.append((item, True))
            stack.extend((c, False) for c in reversed(item.children))
    flush()
    return out


def extract(page: str | None) -> str:
    if not page:
        return ""
    root = parse(page)
    restore(root)
    nodes, threshold = article_of(root, measure(root))
    return "\n".join(b for node in nodes for b in blocks_of(node, threshold))


def extract_pages(pages: DataFrame) -> DataFrame:
    """`pages` without html, and text, n_chars."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(x) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*batch.schema.names, "text", "n_chars"])

    return with_results(pages, step, "text string, n_chars bigint", "html", drop=("html",))


def query(spark, sf_dir: str) -> DataFrame:
    return extract_pages(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
