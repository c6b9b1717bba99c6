"""Main text of web pages by tree scoring.

A page becomes a tree.  Furniture goes first: elements that never hold an
article (navigation, asides, forms, scripts ...) and those whose class, id or
role names furniture.  Each paragraph then gives points for its length and its
commas to its parent, half of them to its grandparent; points shrink with the
share of text inside links.  The container with the most points is kept with
the siblings that look like its continuation, and so is each container around it
up to an <article> or <main> that encloses them, with articles beside that one.
Blocks come in page order, one to a line.

Defined cases: a null or empty page gives an empty text; unclosed and truncated
markup is read as far as it goes; nesting of any depth is fine; of containers with
equal points the first counts; repeated rows give equal rows, columns that aren't
kept are ignored, and an empty table gives no rows.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed sets of element names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
DROPPED = frozenset(
    "head script style noscript template iframe object embed svg canvas audio video map form button input select option textarea "
    "nav footer aside dialog menu title xmp noembed noframes".split()
)
PARAGRAPHS = frozenset("p pre td blockquote dd li".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ROOTS = frozenset("html body article main".split())
CLOSES_P = BLOCK - {"caption", "td", "th", "tr", "tbody", "thead", "tfoot", "html", "body"}
#: A start tag of the key ends an open element of the value, up to the nearest element that limits it.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
LIMITS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
#: Words of class, id and role that name furniture, and words that clear an element of it.
FURNITURE = frozenset(
    "ad ads adv advert adverts advertisement advertising banner banners sponsor sponsored promo promoted promotion "
    "sidebar side rail widget widgets comment comments commentlist disqus respond reply replies discussion cookie cookies consent gdpr "
    "notice notices notification alert popup modal overlay paywall newsletter subscribe subscription signup login share sharing social "
    "related recommended recommendations recommend more-stories breadcrumb breadcrumbs pagination pager menu menus nav navbar navigation "
    "topnav toolbar topbar masthead footer foot header copyright search skip toc tags navigation complementary contentinfo hidden".split()
)
ARTICLE = frozenset("article content main body post entry story text page".split())

_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_COMMENT_END = re.compile(r"--!?>")
_MARK = re.compile("[\"'>]")
_OPENS = re.compile(r"<[a-zA-Z/!?]")
_ATTR = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SPACE = re.compile(r"\s+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    __slots__ = ("tag", "parent", "children", "drop", "inside", "headers", "score", "chars", "linked", "commas")

    def __init__(self, tag: str, parent: Node | None, drop: bool = False):
        self.tag, self.parent, self.drop = tag, parent, drop
        #: Whether it is or lies in an article or a main part.
        self.inside: bool = tag in ("article", "main") or parent is not None and parent.inside
        #: <header> elements around.
        self.headers: int = parent.headers + (parent.tag == "header") if parent else 0
        self.children: list[Node | str] = []
        self.score, self.chars, self.linked, self.commas = 0.0, 0, 0, 0


def _furniture(tag: str, attributes: str) -> bool:
    if tag in DROPPED:
        return True
    if not attributes or tag in ROOTS:
        return False
    for m in _ATTR.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name in ("class", "id", "role"):
            for token in value.split():
                words = {w.lower() for w in _WORDS.findall(token)} | {token.lower()}
                if words & FURNITURE and not words & ARTICLE:
                    return True
        elif name == "style" and _HIDDEN.search(value) or name == "aria-hidden" and value.lower() == "true":
            return True
    return bool(re.search(r"(?:^|\s)hidden(?:\s|/|$)", _ATTR.sub("", attributes)))


class _Ends:
    """Where tags end: at the first > that is not in quotes, else at the first >.

    What follows a quote or a > outside of quotes is the same for all tags, so it is
    worked out once.
    """

    def __init__(self, page: str):
        self.page = page
        self.known: dict[int, int] = {}

    def __call__(self, at: int) -> int:
        page, seen, found = self.page, [], -1
        first = page.find(">", at)
        if page.find('"', at, first) < 0 and page.find("'", at, first) < 0:
            return first
        mark = _MARK.search(page, at)
        while mark:
            i = mark.start()
            if i in self.known:
                found = self.known[i]
                break
            seen.append(i)
            if page[i] == ">":
                found = i
                break
            close = page.find(page[i], i + 1)
            mark = _MARK.search(page, close + 1) if close >= 0 else None
        self.known.update(dict.fromkeys(seen, found))
        return found if found >= 0 else first


class _Stack:
    """Open elements, and for each tag where they are."""

    def __init__(self, root: Node):
        self.nodes = [root]
        self.places: defaultdict[str, list[int]] = defaultdict(list)
        self.blocks: list[int] = []  # but for p

    def push(self, node: Node) -> None:
        self.places[node.tag].append(len(self.nodes))
        if node.tag in BLOCK and node.tag != "p":
            self.blocks.append(len(self.nodes))
        self.nodes.append(node)

    def last(self, tags) -> int:
        return max((self.places[t][-1] for t in tags if self.places[t]), default=0)

    def cut(self, at: int) -> None:
        """End all from this place on."""
        while len(self.nodes) > at:
            tag = self.nodes.pop().tag
            self.places[tag].pop()
            if tag in BLOCK and tag != "p":
                self.blocks.pop()

    def end(self, tag: str) -> None:
        """An end tag: a block ends wherever it is open, p and inline elements only within the innermost other block."""
        places = self.places[tag]
        if not places:
            return
        if tag in BLOCK and tag != "p":
            return self.cut(places[-1])
        limit = self.blocks[-1] if self.blocks else 0
        if tag != "p" and self.places["p"]:
            limit = max(limit, self.places["p"][-1])
        if places[-1] > limit:
            self.cut(places[-1])


def parse(page: str) -> list[Node]:
    """All nodes of a page in the order they begin; the first is the root.  Takes time in proportion to the page."""
    root = Node("#root", None)
    nodes, stack, at, text_at = [root], _Stack(root), 0, 0
    ends, raw_ends = _Ends(page), {}
    # A tag that the page breaks off in goes.
    broken = _OPENS.search(page, page.rfind(">") + 1)
    end = broken.start() if broken else len(page)

    def flush(to: int) -> None:
        if to > text_at:
            stack.nodes[-1].children.append(page[text_at:to])

    while True:
        start = page.find("<", at, end)
        if start < 0:
            break
        name = _NAME.match(page, start)
        if not name:
            if page.startswith("<!--", start):
                close = _COMMENT_END.search(page, start + 4)
                stop = close.end() if close else len(page)
            elif page[start + 1 : start + 2] in ("!", "?", "/"):
                stop = page.find(">", start) + 1
            else:
                at = start + 1
                continue
            flush(start)
            at = text_at = stop
            continue
        flush(start)
        close = ends(name.end())
        attributes = page[name.end() : close]
        at = text_at = close + 1
        tag = name[2].lower()
        if name[1]:
            stack.end(tag)
            continue
        if tag in CLOSES_P and (open_p := stack.places["p"]) and open_p[-1] > (stack.blocks[-1] if stack.blocks else 0):
            stack.cut(open_p[-1])
        if tag in ENDS and (old := stack.last(ENDS[tag])) > stack.last(LIMITS[tag]):
            stack.cut(old)
        top = stack.nodes[-1]
        node = Node(tag, top, top.drop or _furniture(tag, attributes))
        if tag == "header" and not node.drop:
            node.drop = not stack.last(("article", "main"))
        top.children.append(node)
        nodes.append(node)
        if tag in RAW:
            if at < raw_ends.get(tag, (0, 0))[0]:
                found = raw_ends[tag]
            else:
                m = re.compile(rf"</{tag}(?=[\s/>])[^>]*>|</{tag}\Z", re.I).search(page, at, end)
                found = raw_ends[tag] = (m.start(), m.end()) if m else (end, end)
            at = text_at = found[1]
        elif tag not in VOID:
            stack.push(node)
    flush(end)
    return nodes


def _measure(nodes: list[Node]) -> None:
    """Characters, commas and linked characters of every kept node."""
    for node in reversed(nodes):
        if node.drop:
            continue
        for child in node.children:
            if isinstance(child, str):
                text = _SPACE.sub(" ", child).strip()
                node.chars += len(text)
                node.commas += text.count(",") + text.count("，") + text.count("、")
            elif not child.drop:
                node.chars += child.chars
                node.commas += child.commas
                node.linked += child.linked
        if node.tag == "a":
            node.linked = node.chars


def _density(node: Node) -> float:
    return node.linked / node.chars if node.chars else 0.0


def _points(node: Node) -> float:
    return 1 + node.commas + min(node.chars / 100, 3)


def _best(nodes: list[Node]) -> Node:
    for node in nodes:
        if node.drop or not node.chars or node.tag not in PARAGRAPHS:
            continue
        points, parent = _points(node) * (1 - _density(node)), node.parent
        parent.score += points
        if parent.parent is not None:
            parent.parent.score += points / 2
    found = max((n for n in nodes if not n.drop), key=lambda n: n.score * (1 - _density(n)))
    if not found.score:
        # No paragraphs at all: the body, or everything.
        found = next((n for n in nodes if n.tag == "body"), nodes[0])
    return found


def _continues(child: Node, least: float, inside: bool) -> bool:
    """Whether a sibling of the kept container goes on with its text; inside an article most things do."""
    if child.drop or not child.chars:
        return False
    density = _density(child)
    if child.tag in HEADINGS or child.score * (1 - density) >= least:
        return True
    return density <= 0.5 if inside else child.tag in PARAGRAPHS and density < 0.25


def _chosen(nodes: list[Node]) -> list[Node | str]:
    """The kept nodes and loose texts in page order."""
    best = _best(nodes)
    if best.tag in ("#root", "html", "body"):
        return [best]
    least = max(10.0, 0.2 * best.score)
    around = best
    while around is not None and around.tag not in ("article", "main"):
        around = around.parent
    inside = around is not None
    before: list[list[Node | str]] = []  # innermost first
    after: list[list[Node | str]] = []
    node = best
    while node.parent is not None and node is not around:
        at = next(i for i, child in enumerate(node.parent.children) if child is node)
        fits = lambda child: inside if isinstance(child, str) else _continues(child, least, inside)
        before.append([c for c in node.parent.children[:at] if fits(c)])
        after.append([c for c in node.parent.children[at + 1 :] if fits(c)])
        if not inside:
            break
        node = node.parent
    if inside and around.tag == "article":
        beside = around.parent.children
        at = next(i for i, child in enumerate(beside) if child is around)
        own = lambda c: isinstance(c, Node) and c.tag == "article" and not c.drop and _weight(c) >= 0.2 * best.score
        before.append([c for c in beside[:at] if own(c)])
        after.append([c for c in beside[at + 1 :] if own(c)])
    return [*(c for level in reversed(before) for c in level), best, *(c for level in after for c in level)]


def _weight(node: Node) -> float:
    """The most points of any container within."""
    best, todo = 0.0, [node]
    while todo:
        n = todo.pop()
        best = max(best, n.score * (1 - _density(n)))
        todo.extend(c for c in n.children if isinstance(c, Node) and not c.drop)
    return best


def _menu(node: Node) -> bool:
    """A list or box that is made of links, on a page that marks no article; inside one, links are its own."""
    return not node.inside and node.tag in ("ul", "ol", "div", "table", "section") and node.linked > 0.6 * node.chars and node.linked > 0 and sum(isinstance(c, Node) for c in node.children) > 2


def blocks(page: str) -> list[str]:
    """Texts of the article's blocks in page order."""
    nodes = parse(page)
    _measure(nodes)
    out: list[str] = []
    line: list[str] = []

    def close() -> None:
        text = _SPACE.sub(" ", entities.unescape("".join(line))).strip()
        if text:
            out.append(text)
        line.clear()

    chosen = _chosen(nodes)
    for top in chosen:
        todo: list[tuple[Node | str, bool]] = [(top, False)]  # whether a node ends here
        # A kept part may be one of a header.
        headers, headings = 0 if isinstance(top, str) else top.headers, 0
        while todo:
            item, ends = todo.pop()
            if isinstance(item, str):
                # Of a header only its headings belong to the article.
                if not headers or headings:
                    line.append(item)
                continue
            step = -1 if ends else 1
            if not ends and (item.drop or (item is not top or len(chosen) > 1) and _menu(item)):
                continue
            if item.tag == "br":
                line.append(" " if ends else "")
            elif item.tag in BLOCK:
                close()
                headers += step * (item.tag == "header")
                headings += step * (item.tag in HEADINGS)
            if not ends:
                todo.append((item, True))
                todo.extend((child, False) for child in reversed(item.children))
        if not isinstance(top, str) and top.tag in BLOCK:
            close()
    close()
    return out


def main_text(page: str | None) -> str:
    return "\n".join(blocks(page)) if page else ""


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), 256):
            some = batch.slice(at, 256)
            texts = [main_text(x) for x in some.column(len(some.schema) - 1).to_pylist()]
            arrays = [some.column(i) for i in range(len(some.schema) - 1)]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*some.schema.names[:-1], "text", "n_chars"])


def extract(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns keep of pages, then text and n_chars."""
    rows = pages.select(*[F.col(c) for c in keep], F.col(html).alias("_html"))
    schema = pages.select(*keep).schema.add("text", "string").add("n_chars", "long")
    return rows.mapInArrow(_extract, schema)
