"""Tables of HTML documents as long cells, with the standard library's parser."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread

#: Cells that leave a task together.
ROWS = 1 << 14
CELLS = "table_idx int, row_idx int, col_idx int, text string, is_th boolean, title_cues int"
#: The HTML standard's limits on spans; a browser cuts longer ones, too.
SPANS = {"colspan": 1000, "rowspan": 65534}
TITLE = "summary compensation table"
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Open elements that the start of an element ends, within the innermost table.
_ENDS = {"td": {"td", "th", "caption", "p"}, "tr": {"td", "th", "tr", "caption", "p"}, "li": {"li", "p"}} | dict.fromkeys(("p", "div", "table", "ul", "ol", "h1", "h2", "h3", "h4", "h5", "h6"), {"p"})
_ENDS |= {"th": _ENDS["td"]} | dict.fromkeys(("thead", "tbody", "tfoot"), _ENDS["tr"] | {"thead", "tbody", "tfoot"})


class _Tables(HTMLParser):
    """Cells of all tables; spans repeat a cell's text, unclosed cells and rows end at the next."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.done: list[tuple[int, int, int, str, bool]] = []
        self.open: list[dict] = []
        self.count = 0

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.open.append({"id": self.count, "row": -1, "col": 0, "cell": None, "down": {}})
            self.count += 1
        elif self.open and tag == "tr":
            self._end_cell()
            t = self.open[-1]
            t["row"] += 1
            t["col"] = 0
        elif self.open and tag in ("td", "th"):
            self._end_cell()
            t = self.open[-1]
            t["row"] = max(t["row"], 0)
            a = dict(attrs)
            span = lambda n: min(SPANS[n], int(a[n])) if str(a.get(n) or "").isdecimal() and int(a[n]) > 0 else 1
            t["cell"] = {"text": [], "th": tag == "th", "cols": span("colspan"), "rows": span("rowspan")}
        elif self.open and tag in ("br", "p", "div") and self.open[-1]["cell"]:
            self.open[-1]["cell"]["text"].append(" ")

    def handle_endtag(self, tag):
        if not self.open:
            return
        if tag in ("td", "th", "tr"):
            self._end_cell()
        elif tag == "table":
            self._end_cell()
            self.open.pop()

    def handle_data(self, data):
        if self.open and self.open[-1]["cell"]:
            self.open[-1]["cell"]["text"].append(data)

    def _end_cell(self):
        t = self.open[-1]
        cell, t["cell"] = t["cell"], None
        if not cell:
            return
        text = " ".join("".join(cell["text"]).split())
        while (t["row"], t["col"]) in t["down"]:
            t["col"] += 1
        for c in range(cell["cols"]):
            for r in range(cell["rows"]):
                if r:
                    t["down"][t["row"] + r, t["col"] + c] = True
                self.done.append((t["id"], t["row"] + r, t["col"] + c, text, cell["th"]))
        t["col"] += cell["cols"]


class _Titles(HTMLParser):
    """Tables whose caption has TITLE, and tables that hold an element with TITLE or begin next after one."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.captioned: set[int] = set()
        self.near: set[int] = set()
        #: Open elements: tag, where their text begins, number of a table.
        self.open: list[tuple[str, int, int]] = []
        self.text, self.last, self.count = "", -1, 0
        self.gone = 0

    def handle_starttag(self, tag, attrs):
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == "table":
                break
            if self.open[at][0] in _ENDS.get(tag, ()):
                self._end(at)
        if tag not in _VOID:
            self.open.append((tag, self.gone + len(self.text), self.count if tag == "table" else -1))
            self.count += tag == "table"

    def handle_endtag(self, tag):
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == tag:
                return self._end(at)
            if self.open[at][0] == "table":
                return None

    def handle_data(self, data):
        data = re.sub(r"[ \t\r\n]+", " ", data.translate(_LOWER))
        text = self.text + (data[1:] if self.text.endswith(" ") and data.startswith(" ") else data)
        found = text.rfind(TITLE)
        if found >= 0:
            self.last = self.gone + found
        # Only what may begin a title is kept.
        drop = max(0, len(text) - len(TITLE))
        self.text, self.gone = text[drop:], self.gone + drop

    def _end(self, at):
        """End the open elements from this place on."""
        while len(self.open) > at:
            tag, begin, _ = self.open.pop()
            if self.last >= begin:
                tables = [n for t, _, n in self.open if t == "table"]
                self.near.update(tables[-1:])
                self.near.add(self.count)  # the next table to begin, if one does
                if tag == "caption" and self.open and self.open[-1][0] == "table":
                    self.captioned.add(tables[-1])


class _Page(HTMLParser):
    """Cells and title cues of a page that is read once."""

    def __init__(self, html: str | None) -> None:
        super().__init__(convert_charrefs=True)
        self.tables, self.titles = _Tables(), _Titles()
        self.feed(html or "")
        self.close()

    def handle_starttag(self, tag, attrs):
        self.tables.handle_starttag(tag, attrs)
        self.titles.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        self.tables.handle_endtag(tag)
        self.titles.handle_endtag(tag)

    def handle_data(self, data):
        self.tables.handle_data(data)
        self.titles.handle_data(data)

    def cues(self) -> dict[int, int]:
        """How many of the two title cues a table has, for those that have one."""
        titles = self.titles
        titles._end(0)
        return {n: (n in titles.captioned) + (n in titles.near) for n in titles.near | titles.captioned}

    def cells(self) -> list[tuple[int, int, int, str, bool]]:
        tables = self.tables
        while tables.open:
            tables._end_cell()
            tables.open.pop()
        return sorted(tables.done)


def title_cues(html: str | None) -> dict[int, int]:
    return _Page(html).cues()


def cells_of(html: str | None) -> list[tuple[int, int, int, str, bool]]:
    return _Page(html).cells()


def parse_tables(docs: DataFrame, key: str = "doc", html: str = "html") -> DataFrame:
    """key, table_idx, row_idx, col_idx, text, is_th, title_cues: one row per cell of every table."""

    types = [pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.bool_(), pa.int32()]
    names = [f.split()[0] for f in CELLS.split(", ")]

    def put(batch, keys, rows):
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), types, strict=True)]
        return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keys, pa.int32())), *columns], [key, *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, rows = [], []
            for i, h in enumerate(batch.column(1)):
                page = _Page(h.as_py())
                cues = page.cues()
                for c in page.cells():
                    keys.append(i)
                    rows.append((*c, cues.get(c[0], 0)))
                    if len(rows) >= ROWS:
                        yield put(batch, keys, rows)
                        keys, rows = [], []
            if rows:
                yield put(batch, keys, rows)

    kind = docs.schema[key].dataType.simpleString()
    return spread(docs.select(F.col(key), F.col(html))).mapInArrow(run, f"{key} {kind}, {CELLS}")
