"""HTML pages as a table of nodes in document order.

key, pos, last, parent, tag, attrs, text, inside: a row for each element and each
piece of text.  `pos` numbers the nodes as they begin, `last` is the number of the
last node inside an element, so what follows an element are the nodes above its
`last`.  `inside` lists the open elements of the tags in HOLDERS around a node, outermost
first; so the text of tables, cells, links and headings is a grouping, not a search.

A page is parsed in pieces and its rows leave in batches; memory is for the open
elements.  An end tag without an open element costs nothing, and one with it ends
the elements that it pops, so any nesting takes time in proportion to the page.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut, spread
from .text import squeeze, strip

HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
HOLDERS = frozenset(("table", "tr", "td", "th", "caption", "a", *HEADINGS))
FIELDS = "pos int, last int, parent int, tag string, attrs map<string,string>, text string, inside array<int>"
TEXT = "#text"
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SILENT = frozenset(("script", "style"))
#: What the start of an element ends, within the innermost table.
_CELL, _ROW = ("td", "th", "caption", "p"), ("td", "th", "tr", "caption", "p")
_ENDS = {"td": _CELL, "th": _CELL, "tr": _ROW, "a": ("a",)} | dict.fromkeys(("thead", "tbody", "tfoot"), (*_ROW, "thead", "tbody", "tfoot"))
_ENDS |= dict.fromkeys(("p", "div", "table", "ul", "ol", *HEADINGS), ("p",))
_PIECE, _BATCH = 1 << 16, 1 << 13


class _Nodes(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[tuple] = []
        self.count = 0
        #: Open elements: tag, pos, parent, attributes, holders around.
        self.open: list[tuple[str, int, int, dict, list[int]]] = []
        self.holders: list[int] = []
        #: Open elements by tag, for the page and for each open table.
        self.scopes = [Counter()]
        self.pieces: list[str] = []

    def _number(self) -> int:
        self.count += 1
        return self.count - 1

    def _parent(self) -> int:
        return self.open[-1][1] if self.open else -1

    def _flush(self) -> None:
        text, self.pieces = "".join(self.pieces), []
        if text and (self.holders or not text.isspace()):
            pos = self._number()
            self.rows.append((pos, pos, self._parent(), TEXT, None, text, list(self.holders)))

    def _pop(self) -> str:
        tag, pos, parent, attrs, around = self.open.pop()
        if tag == "table":
            self.scopes.pop()
        self.scopes[-1][tag] -= 1
        if tag in HOLDERS:
            self.holders.pop()
        self.rows.append((pos, self.count - 1, parent, tag, list(attrs.items()) or None, None, around))
        return tag

    def handle_starttag(self, tag, attrs):
        self._flush()
        scope = self.scopes[-1]
        for other in _ENDS.get(tag, ()):
            while scope[other] > 0:
                self._pop()
        named: dict[str, str] = {}
        for name, value in attrs:
            named.setdefault(name, value or "")
        pos, around = self._number(), list(self.holders)
        if tag in _VOID:
            self.rows.append((pos, pos, self._parent(), tag, list(named.items()) or None, None, around))
            return
        self.open.append((tag, pos, self._parent(), named, around))
        scope[tag] += 1
        if tag == "table":
            self.scopes.append(Counter())
        if tag in HOLDERS:
            self.holders.append(pos)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        self._flush()
        if tag == "table":
            if len(self.scopes) > 1:
                while self._pop() != "table":
                    pass
        elif self.scopes[-1][tag] > 0:
            while self._pop() != tag:
                pass

    def handle_data(self, data):
        if not self.open or self.open[-1][0] not in _SILENT:
            self.pieces.append(data)

    def finish(self) -> None:
        self._flush()
        while self.open:
            self._pop()


def _closed(html: str) -> str:
    """The page without tags and comments that never end, for which the parser would search again and again."""
    end = html.rfind(">") + 1
    html = html[:end] + html[end:].split("<", 1)[0]
    comment = html.find("<!--", html.rfind("-->") + 1)
    return html if comment < 0 else html[:comment]


def _rows(html: str) -> Iterator[list[tuple]]:
    parser, html = _Nodes(), _closed(html)
    for at in range(0, len(html), _PIECE):
        parser.feed(html[at : at + _PIECE])
        if len(parser.rows) >= _BATCH:
            yield parser.rows
            parser.rows = []
    parser.close()
    parser.finish()
    yield parser.rows


_TYPES = [pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.map_(pa.string(), pa.string()), pa.string(), pa.list_(pa.int32())]
_NAMES = [f.split()[0] for f in FIELDS.split(", ")]


def parse_nodes(docs: DataFrame, key: str = "doc", html: str = "html", once: bool = True) -> DataFrame:
    """The nodes of each page; a null or empty page has none.

    once: the nodes are written to the checkpoint folder, as most operators read them several times.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, rows = [], []
            for i, h in enumerate(batch.column(1)):
                for some in _rows(h.as_py() or ""):
                    keys += [i] * len(some)
                    rows += some
                    if len(rows) >= _BATCH:
                        yield put(batch, keys, rows)
                        keys, rows = [], []
            if rows:
                yield put(batch, keys, rows)

    def put(batch, keys, rows):
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), _TYPES, strict=True)]
        return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keys, pa.int32())), *columns], [key, *_NAMES])

    out = spread(docs.select(F.col(key), F.col(html))).mapInArrow(run, f"{key} {kind}, {FIELDS}")
    return cut(out) if once else out


def elements(nodes: DataFrame, *tags: str) -> DataFrame:
    return nodes.where(F.col("tag").isin(*tags))


def by_place(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """A join of rows made of nodes, by sorting.

    Their sizes are guessed from the file that the pages come from, which is far smaller: else Spark sends whole sides to the driver.
    """
    return left.join(right.hint("merge"), on, how)


def contents(nodes: DataFrame, key: str, *tags: str, between: str = "", each=None) -> DataFrame:
    """key, pos, content: the text inside each element of these tags that has any.

    each: what is done to a piece first; pieces that become empty are left out.
    """
    piece = F.col("text") if each is None else each(F.col("text"))
    parts = nodes.where(F.col("tag") == TEXT).select(key, F.col("pos").alias("_at"), piece.alias("_text"), F.explode("inside").alias("pos"))
    parts = by_place(parts.where("_text <> ''"), elements(nodes, *tags).select(key, "pos"), [key, "pos"], "left_semi")
    ordered = F.sort_array(F.collect_list(F.struct("_at", "_text")))
    return parts.groupBy(key, "pos").agg(F.array_join(F.transform(ordered, lambda x: x["_text"]), between).alias("content"))


def folded(c: Column) -> Column:
    """Lower case, white space and no-break spaces as single blanks."""
    return F.lower(strip(squeeze(F.replace(c, F.lit(" "), F.lit(" ")))))


def tables_of(nodes: DataFrame, key: str) -> DataFrame:
    """key, pos, last, attrs, table_idx of each table; the index counts them as they begin."""
    w = Window.partitionBy(key).orderBy("pos")
    return elements(nodes, "table").select(key, "pos", "last", "attrs", (F.row_number().over(w) - 1).alias("table_idx"))
