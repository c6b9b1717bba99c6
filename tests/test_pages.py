"""Nodes of odd pages, places of tables, ownership features, header runs, sections, nested records."""

import datetime
import json
import time

import pytest
from pyspark.sql import functions as F

from cornice.functions import lines, nodes
from cornice.operators import header_runs, members, ownership, pages, sections

PAGE = """<h1>First</h1><a href="#sct">the Summary <b>Compensation</b> Table</a><a href='#x y'>SUMMARY COMPENSATION TABLE</a>
<a href="#none">summary compensation table</a><a name="z">summary compensation table</a><a href="#sct">summary  compensation table</a>
<table><tr><td>skip<a name="x y"></a></table><div id=sct><table class=a><tr><td>inside</table></div><h2></h2>
<table><caption> Cap <i>one</i></caption><tr><td>1<td>2</table><h3>Third</h3><p>x<p id=sct>second of the name<table><tr><td>a<table><tr><td>b</table></table>"""


def parsed(spark, *html):
    return nodes.parse_nodes(spark.createDataFrame(list(enumerate(html)), "doc int, html string"), "doc")


@pytest.mark.parametrize("odd", ["<a " * 300000, "<!--" * 200000, "<div>" * 50000 + "</section>" * 50000, "<p>x<" * 50000, "<table>" * 3000 + "</tr>" * 3000, "<a b='" * 50000 + ">"])
def test_odd_pages_take_time_in_proportion(odd):
    began = time.time()
    assert sum(map(len, nodes._rows(odd))) >= 0
    assert time.time() - began < 5


def test_nodes_are_intervals(spark):
    rows = {r.pos: r for r in parsed(spark, PAGE, None, "", "plain &amp; simple", "<script>if (a < b) '<td>'</script></td></table>x").where("doc = 0").collect()}
    assert sorted(rows) == list(range(len(rows)))
    for r in rows.values():
        assert r.last >= r.pos and (r.parent == -1 or rows[r.parent].pos < r.pos <= rows[r.parent].last)
        assert all(rows[i].pos < r.pos <= rows[i].last and rows[i].tag in nodes.HOLDERS for i in r.inside)
    other = parsed(spark, None, "", "plain &amp; simple", "<script>if (a < b) '<td>'</script></td></table>x")
    assert [(r.doc, r.tag, r.text) for r in other.orderBy("doc", "pos").collect()] == [(2, "#text", "plain & simple"), (3, "script", None), (3, "#text", "x")]


def test_long_page_leaves_in_batches(spark):
    got = parsed(spark, "<p>a" * 60000, "<p>b").groupBy("doc").count().collect()
    assert {r.doc: r["count"] for r in got} == {0: 120000, 1: 2}


def test_tables_after_anchors(spark):
    got = pages.tables_after_anchors(parsed(spark, PAGE, None, "<a href='#t'>summary compensation table</a><p id=t>end"), "doc").orderBy("doc", "pos").collect()
    # A table inside the target, or around it, isn't the one after it.
    assert [(r.doc, r.href, r.target is not None, r.table_idx) for r in got] == [(0, "#sct", True, 2), (0, "#x y", True, 1), (0, "#none", False, None), (2, "#t", True, None)]
    assert got[0].text == "the Summary Compensation Table"


def test_titled_tables(spark):
    got = pages.titled_tables(parsed(spark, PAGE, "<table></table><h1>late</h1>"), "doc").orderBy("doc", "table_idx").collect()
    assert [r.title for r in got] == ["First", "First", "Capone", "Third", "Third", "Table_1"]
    assert pages.titled_tables(parsed(spark, PAGE, PAGE.replace("<i>one</i>", "").replace(" Cap ", "")), "doc").where("doc = 1 and table_idx = 2").first().title == "Table_3"


def test_index_documents(spark):
    row = "<tr><td>{}</td><td>{}</td></tr>"
    files = "<table class='TABLEFILE2'>" + row.format("DEF 14A", "<a href=h.htm>") + row.format("DEF 14A", "<a>no</a><a href=a.htm>") + row.format("DEF<br>14A", "<a href=b.pdf>") + row.format("x def14a", "<a href='/c.HTM'>") + "</table>"
    html = [files + "<a href=t.TXT>", "<a href=first.html>" + files.replace("tableFILE", "other").replace("TABLEFILE", "other"), "<a name=x>", None]
    df = spark.createDataFrame([(i, h, "https://e.org/d/i.htm") for i, h in enumerate(html)], "doc int, html string, url string")
    got = pages.index_documents(nodes.parse_nodes(df, "doc"), df, "doc", "url", "DEF 14A").orderBy("doc").collect()
    assert [(r.html_url, r.txt_url) for r in got] == [("https://e.org/c.HTM", "https://e.org/d/t.TXT"), ("https://e.org/d/first.html", None), (None, None), (None, None)]


def test_ownership_features(spark):
    rows = [["Name", "Shares", "%"], ["Ann Roe, 5 Elm", "1,200", "", "5", "%"], ["Bob", "250000", "*"], ["as a group"], ["", " "], []]
    html = "<table>" + "".join("<tr>" + "".join(f"<td><b>{c}</b>" for c in r) for r in rows) + "</table><table></table>"
    got = ownership.scored_ownership(parsed(spark, html), "doc").orderBy("table_idx").collect()
    r = got[0].asDict()
    # Widths 3, 4, 3, 1: the upper median is 3.
    assert [r[c] for c in ownership.FEATURES[:7]] == [3, 6, 2, 2, 1, 1, 1]
    assert r["first_col_avg_len"] == (4 + 14 + 3 + 10) / 4 and r["other_cols_avg_len"] == (8 + 9 + 8) / 3
    points = 12 * 2 / 6 + 10 * 2 / 6 + 6 * ((31 / 4 + 1) / (25 / 3 + 1) - 1 if 31 / 4 > 25 / 3 else 0) + 2 + 2 * r["ownership_hits"] + 4 + 1.5
    assert abs(r["score"] - points) < 1e-9 and r["kind"] == "beneficial_owner"
    assert got[1].score == -10 and got[1].row_count == 0


def test_ownership_pair_falls_back(spark):
    rows = [("a", 0, 5.0, "management"), ("a", 1, 5.0, "management"), ("b", 0, 1.0, "beneficial_owner"), ("c", 0, 0.0, "management"), ("d", 0, 3.0, "management"), ("d", 1, 9.0, "beneficial_owner")]
    got = ownership.ownership_pair(spark.createDataFrame(rows, "doc string, table_idx int, score double, kind string"), "doc").collect()
    assert {(r.doc, r.kind): r.table_idx for r in got} == {("a", "beneficial_owner"): 0, ("a", "management"): 0, ("b", "beneficial_owner"): 0, ("d", "beneficial_owner"): 1, ("d", "management"): 0}


def cells(spark, *tables):
    rows = [("t", n, r * 2, c, x) for n, table in enumerate(tables) for r, row in enumerate(table) for c, x in enumerate(row)]
    return spark.createDataFrame(rows, "doc string, table_idx int, row_idx int, col_idx int, text string")


def test_header_runs(spark):
    df = cells(spark, [["1", None], [" 2 ", ""], ["Name", "All"], ["x", "other (a)"], ["Ann", "5"]], [["7"], ["8"]], [["plain", "words"], ["1", "2"]])
    left = header_runs.without_number_rows(df, 2)
    assert {(r.table_idx, r.row_idx) for r in left.collect()} == {(0, 4), (0, 6), (0, 8), (2, 0), (2, 2)}
    assert {(r.table_idx, r.row_idx) for r in header_runs.without_number_rows(df, 1).collect()} >= {(0, 2), (1, 2)}
    got = header_runs.with_header_run(left, 4).collect()
    assert {(r.name, r.text) for r in got if r.table_idx == 0} == {("Name x", "Ann"), ("All other", "5")}
    # Without any word the run is one row.
    assert {(r.name, r.text) for r in got if r.table_idx == 2} == {("plain", "1"), ("words", "2")}
    best = {r.table_idx: (r.row_idx, r.score) for r in header_runs.best_header_row(df).collect()}
    assert best == {0: (4, 1), 1: (0, 0), 2: (0, 0)}
    assert {(r.table_idx, r.k, r.score) for r in header_runs.scored_header_rows(df, 4).collect()} == {(0, 3, 10), (1, 1, 0), (2, 1, 0)}
    assert header_runs.with_header_run(df.limit(0), 3).count() == 0


def test_sections(spark):
    text = "A 1 1.0\r\nSECURITY OWNERSHIP of\x85 Ann  Roe   1,2 3.25% x , , 1.0\nBob 5 1.0 audit committee\nC 1 1.0"
    df = spark.createDataFrame([("a", text), ("b", None), ("c", ""), ("d", "beneficial ownership director compensation\nA 1 1.0")], "k string, t string")
    got = sections.ownership_lines(df, "k", "t").collect()
    assert [(r.i, r.name, r.shares, r.percent) for r in sorted(got, key=lambda r: r.i)] == [(2, "Ann  Roe", 12, 3.25), (4, "Bob", 5, 1.0)]
    assert [(r.k, r.i) for r in sections.section_lines(df, "k", "t").where("k = 'd'").collect()] == [("d", 0)]
    assert lines.text_lines(spark.createDataFrame([("a", "x\n\n"), ("b", "\n"), ("c", "")], "k string, t string"), "k", "t").groupBy("k").count().orderBy("k").collect() == [("a", 2), ("b", 1)]


def test_members(spark):
    df = spark.createDataFrame([(1, [("a", 1), None]), (2, []), (3, None)], "id int, m array<struct<n:string,x:int>>")
    got = members.explode_members(df, "m", {"id": "id", "gone": "nope"}, {"n": "n", "y": "z"}).collect()
    assert [tuple(r) for r in got] == [(1, None, "a", None), (1, None, None, None)]
    assert members.explode_members(df, "m", {"id": "id"}, {"n": "n"}, keep_empty=True).count() == 4
    text = '{"data":[{"id":1,"directors":[{"name":"q","committeeMemberships":["x"]}]},{"directors":null}]}'
    got = members.directors(spark.createDataFrame([(text,), ("{}",), ("no",), (None,)], "j string"), "j").collect()
    assert [(r.id, r.name, r.committee_memberships, len(r)) for r in got] == [("1", "q", '["x"]', 14)]


def test_year_records(spark):
    rows = [
        ("d", 'Ann "A"', "2001.0", 1, {"salary": "1,0", "salary_2": " 5 ", "total": None, "stock_awards": "7", "note": " x ", "blank": " ", "nul": None, "position": "CEO", "year": "2001"}),
        ("d", 'Ann "A"', "FY 1999", 3, {"total": "9"}),
        ("d", 'Ann "A"', "2001", 2, {"salary": "3"}),
        ("d", "Bob", "none", 2, {"salary": "3"}),
        ("d", None, "2001", 2, {}),
        ("e", "C", " 2003 ", 2, {}),
    ]
    df = spark.createDataFrame(rows, "doc string, who string, y string, i int, v map<string,string>")
    got = {r.doc: json.loads(r.executives) for r in members.year_records(df, "doc", "who", "y", "v", "i").collect()}
    first = {"year": 2001, "position": "CEO", "salary": 0.0, "salary_2": 5.0, "total": 0.0, "other_fields": {"stock_awards": "7", "note": "x", "nul": "nan"}}
    assert got["d"] == [{"executive_name": 'Ann "A"', "compensation_data": [{"year": 1999, "position": "", "total": 9.0}, first]}]
    assert got["e"] == [{"executive_name": "C", "compensation_data": [{"year": 2003, "position": ""}]}]
    less = json.loads(members.year_records(df, "doc", "who", "y", "v", "i", missing=None).where("doc = 'd'").first().executives)
    assert "nul" not in less[0]["compensation_data"][1]["other_fields"]


def test_iso_dates(spark):
    at = datetime.datetime(2001, 1, 1, 2, 3, 4)
    df = spark.createDataFrame([(datetime.date(2001, 2, 3), [{"a": at, "b": None}], (1, at.replace(microsecond=50)), "z", None), (None, None, None, None, None)], "d date, l array<map<string,timestamp>>, s struct<i:int,t:timestamp_ntz>, `a.b` string, n array<struct<d:date>>")
    got = members.iso_dates(df).collect()
    assert tuple(got[0]) == ("2001-02-03", [{"a": "2001-01-01T02:03:04", "b": None}], (1, "2001-01-01T02:03:04.000050"), "z", None)
    assert tuple(got[1]) == (None,) * 5 and members.iso_dates(spark.range(1)).columns == ["id"]


def test_merged_fields(spark):
    from cornice.operators import cells as C

    names = ["pay_2", "pay", "note", "pay", None, "pay"]
    rows = [["1", "1.0", None, "2", "z", " "], [None, "0", "n", "x", "z", "y"], ["0.0", " ", "", None, "z", "-3"]]
    df = spark.createDataFrame([("d", 0, r, c, n, x) for r, row in enumerate(rows) for c, (n, x) in enumerate(zip(names, row))], "doc string, table_idx int, row_idx int, col_idx int, name string, text string")
    got = {r.row_idx: r.fields for r in C.merged_fields(df).collect()}
    # The first column has the number 2 itself, so another value takes 3.
    assert got == {0: {"note": None, "pay_2": "1", "pay_3": "2"}, 1: {"note": "n", "pay_2": "x", "pay_3": "y"}, 2: {"note": "", "pay_2": "-3"}}


def test_sct_json(spark):
    from cornice.operators import cells as C

    rows = [("d", 0, 0, 0, 'A "q"', 2001, {"b": "2", "a": None}), ("d", 0, 1, 0, 'A "q"', 2001, {"b": "3"}), ("d", 0, 2, 0, None, 1999, {}), ("d", 0, 2, 1, "B", None, {"x": "1"}), ("e", 0, 0, 0, "B", None, {})]
    df = spark.createDataFrame(rows, "doc string, table_idx int, row_idx int, slot int, executive string, year int, fields map<string,string>")
    reports = spark.createDataFrame([("d", "abc", "2002-03-04"), ("e", "x", "y")], "doc string, ticker string, report_date string")
    got = [json.loads(r.json) for r in C.sct_json(df, reports).collect()]
    assert got == [{"company": {"ticker": "ABC", "report_year": "2002", "summary_compensation_table": [{"report_date": "2002-03-04", "executives": {'A "q"': {"2001": {"b": "3"}}, "unknown": {"1999": {}}}}]}}]


def test_extraction_entries(spark):
    from cornice.operators import extract_index as X

    schema = "ticker string, form string, report_date string, at int, kind string, status string, csv_relpath string, csv_rows int, normalized boolean, bo_html_relpaths array<string>"
    key = ("T", "F", "d")
    rows = [(*key, 1, "csv", "extracted", "a.csv", 5, True, None), (*key, 2, "csv", "extracted", "b.csv", None, None, None), (*key, 3, "status", "no_sct_found", None, None, None, None), ("T", None, "d", 4, "csv", "x", "y", 1, None, None), ("T", "G", "d", 0, "bo", "extracted", None, None, None, ["p", "q"])]
    df = spark.createDataFrame(rows, schema)
    e = {r.form: r for r in X.folded_entries(df).collect()}
    # A later record of tables sets the number of rows to null; a status alone leaves them.
    assert (e["F"].status, e["F"].csv_relpath, e["F"].csv_rows, e["F"].normalized, e["F"].at) == ("no_sct_found", "b.csv", None, True, 3)
    half = X.fold_into(X.folded_entries(df.where("at <= 1")), df.where("at > 1"))
    assert sorted(map(str, half.select(X.folded_entries(df).columns).collect())) == sorted(map(str, e.values()))
    got = {(r.ticker, r.form): (r.n_entries, r.count_csv, r.count_bo, r.count_txt) for r in X.entry_counts(X.folded_entries(df)).collect()}
    assert got == {("T", "F"): (1, 1, 0, 0), ("T", "G"): (1, 0, 2, 0), ("T", None): (2, 1, 2, 0), (None, None): (2, 1, 2, 0)}


def test_drawn_tables(spark):
    from cornice.operators import ascii_tables as A

    text = "Title\n\nName   Position   Year\n ---  --- \nAnn  CEO\nalone\nBob  x  y  z\n"
    df = spark.createDataFrame([("a", text), ("b", "one\ntwo  three"), ("c", None), ("d", "A  B\n__  --")], "k string, t string")
    got = {(r.doc, r.row_idx, r.head): r.text for r in A.ascii_cells(df, "k", "t").collect()}
    assert got == {("a", 0, "Name"): "Ann", ("a", 0, "Position"): "CEO", ("a", 0, "Year"): "", ("a", 1, "Name"): "Bob", ("a", 1, "Position"): "x", ("a", 1, "Year"): "y"}
    rows = [["x", "1", None], ["Name", "Total  pay", None], ["Ann", "5", None]]
    df = spark.createDataFrame([("t", 0, r, c, f"h{c}", x) for r, row in enumerate(rows) for c, x in enumerate(row)], "doc string, table_idx int, row_idx int, col_idx int, head string, text string")
    assert [(r.name, r.text) for r in A.with_found_header(df).orderBy("col_idx").collect()] == [("Name", "Ann"), ("Total pay", "5")]
    plain = A.with_found_header(df.where("row_idx <> 1"))
    assert {(r.name, r.text) for r in plain.collect()} == {("h0", "x"), ("h0", "Ann"), ("h1", "1"), ("h1", "5")}
