"""Behaviours with nulls, ties and odd input, one for each decision."""

from pyspark.sql import functions as F

from cornice.functions import text as T
from cornice.functions.htmlkit import cells_of
from cornice.operators import cells as C
from cornice.operators import enrich, jsonquery, sequence, state


def test_latest_row_prefers_null_dates(spark):
    msf = spark.createDataFrame([(1, None, 3), (1, "2020-01-31", 1), (2, "2019-01-31", 2)], "permno int, date string, hexcd int")
    assert {tuple(r) for r in enrich.latest_code(msf, "permno", "date", "hexcd").collect()} == {(1, 3), (2, 2)}


def test_open_link_wins(spark):
    rows = [(1, "001", "LC", "P", "2010-12-31"), (1, "002", "LC", "P", None), (1, "003", "LX", "P", None)]
    link = spark.createDataFrame(rows, "lpermno int, gvkey string, linktype string, linkprim string, linkenddt string")
    assert [r.gvkey for r in enrich.links(link).collect()] == ["002"]


def test_turnover_counts_null_names(spark):
    rows = [("g", 2001, "A"), ("g", 2001, "B"), ("g", 2003, "B"), ("g", 2003, "C"), ("g", 2003, "D"), ("g", 2003, None)]
    df = spark.createDataFrame(rows, "g string, y int, m string")
    assert [tuple(r) for r in sequence.turnover(df, "g", "y", "m").collect()] == [("g", 2003, 3, 1)]
    assert {(r.y, r.members) for r in sequence.members_per_year(df, "g", "y", "m").collect()} == {(2001, 2), (2003, 3)}


def test_tenure(spark):
    df = spark.createDataFrame([("a", y) for y in (2000, 2001, 2003, 2003)], "k string, y long")
    assert sorted(tuple(r) for r in sequence.tenure(df, ["k"], "y").collect()) == [("a", 2000, 2000, 0), ("a", 2001, 2000, 1), ("a", 2003, 2003, 0)]


def test_blocks(spark):
    years = [2006, 2005, None, 2006, 2006, 2005]
    df = spark.createDataFrame([("a", i, y) for i, y in enumerate(years)], "k string, i int, y int")
    assert [r.block for r in sequence.with_blocks(df, ["k"], "i", "y").orderBy("i").collect()] == [0, 0, 0, 1, 2, 2]


def test_status_precedence(spark):
    df = spark.createDataFrame([("a", "no_sct_found", 0), ("a", "extracted", 1), ("b", "skipped_existing", 0), ("b", "no_bo_found", 1)], "k string, s string, p int")
    assert {tuple(r) for r in state.merged_status(df, ["k"], "s", "p").collect()} == {("a", "extracted"), ("b", "skipped_existing")}


def test_json_query_fixture(spark):
    rows = [(1, "AAA", 101, "001690", "0000000011", "Alpha Corp", "NYSE", None), (2, "BBB", 102, "null", "12", "Beta Alpha Inc", "", None), (3, "CCC", None, "7", None, None, "NASDAQ", None)]
    m = spark.createDataFrame(rows, "id int, ticker string, permno int, gvkey string, cik_str string, title string, exchange string, cusip string")
    ids = lambda q: [r.id for r in jsonquery.json_query(m, q).collect()]
    assert ids('{"$or":[{"ticker":"aaa"},{"permno":102}]}') == [1, 2]
    assert ids('{"permno":{"$gt":-1}}') == [1, 2, 3]
    assert ids('{"permno":{"$gt":100,"$lt":102}}') == [1, 2]
    assert ids('{"exchange":null}') == [2]
    assert ids('{"$and":[{"exchange":"NYSE"}],"ticker":"BBB"}') == [1]
    assert ids('{"gvkey":"1690"}') == [1]
    assert ids('{"ticker":{}}') == []
    assert ids("[]") == ids("{}") == [1, 2, 3]
    find = lambda *a: [r.id for r in jsonquery.search(m, *a).collect()]
    assert find("alpha") == [1, 2]
    assert find("0000000012") == [2]
    assert find("null", "permno") == [3]


def test_text_helpers(spark):
    df = spark.createDataFrame([(" a  b (x) $1,000 / y",), (None,)], "s string")
    assert [r[0] for r in df.select(T.clean_text(F.col("s"))).collect()] == ["a b 1000 y", ""]
    v = spark.createDataFrame([("12345678901",), ("7",)], "s string")
    assert [r[0] for r in v.select(T.zfill(F.col("s"), 10)).collect()] == ["12345678901", "0000000007"]


def test_cells_of_broken_markup():
    assert cells_of("<table><tr><td rowspan=2>a<td colspan=2>b<tr><td>c&amp;d") == [(0, 0, 0, "a", False), (0, 0, 1, "b", False), (0, 0, 2, "b", False), (0, 1, 0, "a", False), (0, 1, 1, "c&d", False)]
    assert cells_of(None) == []


def _table(*rows):
    return "<table>" + "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in rows) + "</table>"


def _bot(spark, *rows):
    from cornice.functions.htmlkit import parse_tables
    from cornice.plans.catalog import share_path

    cells = parse_tables(share_path(spark).createDataFrame([("a", _table(*rows))], "doc string, html string"))
    return sorted((tuple(r) for r in C.clean_bot(cells).select("name", "address", "shares", "percent").collect()), key=repr)


def test_bot_blank_headers_are_named_by_their_values(spark):
    rows = [("Acme Fund", "1,250,000", "12.5%"), ("Bolt Fund", "300,000", "*")]
    assert _bot(spark, ("Name of Holder", "Number of Shares", ""), *rows) == rows_of(rows)
    assert _bot(spark, ("Name of Holder", "Number of Shares"), *rows) == rows_of(rows)
    plain = [("Acme Fund", "1250000", "12.5%"), ("Bolt Fund", "3000000", "3%")]
    assert _bot(spark, ("Name of Holder", "", "Percent of Class"), *plain) == rows_of(plain)


def rows_of(rows):
    return [(n, None, s, p) for n, s, p in rows]


def test_bot_second_name_column_becomes_numbers(spark):
    head = ("Name of Beneficial Owner", "Amount and Nature of Beneficial Ownership", "Percent of Class")
    plain = [("Acme Fund", "1250000", "12.5%"), ("Bolt Fund", "3000000", "3%")]
    assert _bot(spark, head, *plain) == rows_of(plain)
    # The reference tries percent first, and its float rule takes grouped numbers.
    assert _bot(spark, head[:2], ("Acme Fund", "1,250,000"), ("Bolt Fund", "300,000")) == [("Acme Fund", None, None, "1,250,000"), ("Bolt Fund", None, None, "300,000")]
    mixed = [("Acme Fund", "Chair", "1%"), ("Bolt Fund", "1,250 000", "2%"), ("Cole Fund", "Clerk", "3%")]
    assert _bot(spark, head, *mixed) == [("Acme Fund", "Chair", None, "1%"), ("Bolt Fund", None, "1,250 000", "2%"), ("Cole Fund", "Clerk", None, "3%")]


def test_title_cues_choose_the_compensation_table(spark):
    from cornice.functions.htmlkit import parse_tables, title_cues
    from cornice.plans.catalog import share_path

    other = _table(("Name and Principal Position", "Year", "Salary", "Bonus", "Total"), ("A B", "2020", "100", "5", "105"))
    right = _table(("Name", "Year", "Salary"), ("A B", "2021", "100"))
    titled = right.replace("<table>", "<table><caption>Summary  COMPENSATION\nTable</caption>")
    assert title_cues(other + "<p>SUMMARY <b>Compensation</b> Table" + right + other) == {1: 1}
    assert title_cues(other + titled)[1] == 2 and title_cues(other + right) == title_cues(None) == {}
    assert title_cues(_table(("Summary Compensation Table",)) + right) == {0: 1, 1: 1}
    cells = parse_tables(share_path(spark).createDataFrame([("a", other + titled)], "doc string, html string"))
    plain = parse_tables(share_path(spark).createDataFrame([("a", other + right)], "doc string, html string"))
    score = lambda c: {r.table_idx: r.score for r in C.score_tables(c).collect()}
    assert score(cells)[1] == score(plain)[1] + 8 and score(cells)[0] == score(plain)[0]
    assert {r.table_idx for r in C.best_table(cells).collect()} == {1} and {r.table_idx for r in C.best_table(plain).collect()} == {0}


def test_paragraph_scores_and_windows(spark):
    from cornice.operators import narrative as N

    df = spark.createDataFrame(
        [(1, "Paid $500,000 and $20,000."), (2, "The meeting is on May 1."), (3, "a chief executive officer"), (4, None), (5, "vested 100 shares and 5 options")], "id int, p string"
    )
    assert {r.id: r.s for r in df.select("id", N.paragraph_score(F.col("p")).alias("s")).collect()} == {1: 4, 2: 0, 3: 1, 4: 0, 5: 6}
    text = "Paid $1 and $2 before.\n\n" + "Executive Compensation\n\n" + "x\n" * 900 + "\nPaid $3 and $4 too late."
    rows = spark.createDataFrame([(1, text), (2, "Paid $1\r\nand $2.\r\n\r\n\r\nnone"), (3, None), (4, "")], "id int, text string")
    got = N.top_paragraphs(rows, "id", "text").collect()
    assert [(r.id, r.pos, r.paragraph, r.score, r["rank"]) for r in got] == [(2, 0, "Paid $1 and $2.", 4, 1)]


def _candidates(spark, *texts):
    from cornice.operators import narrative as N

    got = N.summary_tables(spark.createDataFrame(list(enumerate(texts)), "id int, text string"), "id", "text").collect()
    return [tuple(r)[1:] for r in sorted(got, key=lambda r: r.id)]


def test_table_candidates(spark):
    weak = "Summary Compensation Table\nPosition    Year    Salary\n"
    gap = "Name and principal position   Year\n" + "A   1\n" * 6 + "\n\nafter"
    full = "Summary Compensation Table\n<TABLE>\nName and Principal Position  Year  Salary\n$5\n</TABLE>"
    got = _candidates(spark, "", None, full, weak + "Ann    2001    5", weak + "Ann    2001    5\nBob    2001    6", gap, "Summary\nCompensation\nTable", full.replace("Name", "\uff2e\uff41\uff4d\uff45"))
    assert got[0] == got[1] == (None, None, 0, False, None)
    assert got[2][:4] == ("sgml", "npp", 3 + 2 + 2, True) and got[2][4].startswith("<TABLE>")
    # A weak header near an anchor needs two lines that look like rows.
    assert got[3][0] is None and got[4][:2] == ("ascii", "pos")
    assert "after" not in got[5][4] and got[6][3] is False
    # Wide letters count as plain ones.
    assert got[7] == got[2]


def test_candidates_near_and_far(spark):
    anchor, head, row = "Summary Compensation Table", "Name and Principal Position   Year", "Ann Roe   2001"
    far = lambda n: "\n".join([anchor, *["x"] * n, head, row])
    got = _candidates(spark, far(60), far(61), "\n".join(["x"] * 200 + [head, row]), "\n".join(["x"] * 88 + ["Name, Principal", "Position   Year"]))
    assert [g[1] for g in got] == ["npp", None, "npp", "npp"]
    # The first of equal candidates stays; a heading or a section ends a table once it has ten lines.
    two = "\n".join([head, row, *["x"] * 20, head, row])
    table = "\n".join([head, *[row] * 9, "PENSION BENEFITS", "end"])
    short = "\n".join([head, *[row] * 6, "DIRECTORS", "end"])
    got = _candidates(spark, two, table.replace("end", "end\nend"), short)
    assert got[0][4].startswith(head) and got[1][4].endswith("PENSION BENEFITS") and got[2][4].endswith("end")
    long = _candidates(spark, "\n".join([anchor, head, *[row] * 400]))[0][4]
    assert len(long.split("\n")) == 220
    # A table that isn't closed within 300 lines from an anchor is none, nor is one that begins more than ten lines before.
    sgml = lambda before, inside: "\n".join(["<table>", *["x"] * before, anchor, *["x"] * inside, "</table>"])
    assert [g[0] for g in _candidates(spark, sgml(9, 298), sgml(9, 299), sgml(10, 5))] == ["sgml", None, None]


def test_file_classes(spark):
    from cornice.operators import narrative as N

    texts = ["", None, "nothing", "Summary Compensation Table", "Paid $5 and $6.", "filing", "principal position   year salary total bonus\n1  2\n3  4", "pages without a table"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    table = "<p>Summary Compensation Table\n<table><tr><td>Name and Principal Position<td>Year</table>"
    pages = [(5, "b", table + "b"), (5, "a", table), (4, "a", "<table>no"), (7, "a", table.replace("<table>", "x\n" * 300 + "<table>")), (2, "a", None), (6, "a", table)]
    pages = spark.createDataFrame(pages, "id int, page string, html string")
    got = {r.id: r["class"] for r in N.file_classes(df, "id", "text", pages).collect()}
    assert got == {0: "error", 1: "error", 2: "no_anchor", 3: "anchor_but_missing", 4: "narrative", 5: "html_fallback", 6: "ascii_pp", 7: "no_anchor"}
    assert N.file_classes(df, "id", "text").where("class = 'html_fallback'").count() == 0
    found = N.page_tables(pages, "id", "html", "page").collect()
    assert {(r.id, r.header, r.score) for r in found} == {(5, "npp", 5), (6, "npp", 5)}


def test_junk_above_the_first_year_row(spark):
    from cornice.functions.htmlkit import parse_tables
    from cornice.plans.catalog import share_path

    head = ("Name and Principal Position", "Year", "Salary")
    rows = [head, ("salary in 1000", "", "5"), ("no digits here", "", "-"), ("note 7", "", "9"), ("Ann Roe", "2020", "100")]
    cells = parse_tables(share_path(spark).createDataFrame([("a", _table(*rows))], "doc string, html string"))
    assert [(r.row_idx, r.year) for r in C.clean_sct(cells).orderBy("row_idx").collect()] == [(3, None), (4, 2020)]


def test_header_with_only_beneficially_owned_counts(spark):
    rows = [("Beneficially Owned",), ("Acme Fund",)]
    from cornice.functions.headers import BOT_TOKENS, hits

    df = spark.createDataFrame(rows, "s string")
    assert [r[0] for r in df.select(hits(F.lower("s"), BOT_TOKENS)).collect()] == [2, 0]


def test_compare_counts_and_samples(spark):
    from cornice.operators import verify as V

    a = spark.createDataFrame([(i, float(i), "x") for i in range(20)], "k int, v double, s string")
    b = spark.createDataFrame([(i, float(i) + (i < 7), "x") for i in range(20)], "k int, v double, s string")
    got = {r.column: (r.mismatches, r.samples) for r in V.compare(a, b, ["k"], ["v", "s"]).collect()}
    assert got == {"v": (7, ["0", "1", "2", "3", "4"]), "s": (0, [])}


def test_uncovered_edges(spark):
    have = spark.createDataFrame([("a", 1, 5), ("a", 2, 9), ("b", 0, 3), (None, 0, 9)], "k string, lo int, hi int")
    want = spark.createDataFrame([("a", 1, 5), ("a", 3, 9), ("a", 0, 2), ("b", 1, 4), ("c", 1, 1), (None, 1, 2)], "k string, lo int, hi int")
    assert sorted((tuple(r) for r in state.uncovered(want, have, "k").collect()), key=repr) == sorted([("a", 0, 2), ("b", 1, 4), ("c", 1, 1), (None, 1, 2)], key=repr)


def test_enrichment_leaves_what_is_known(spark):
    s = "string"
    rec = spark.createDataFrame([("1", "aa", None, None, "Q", "false", "CAD", "", "Old", "kept", "SEC"), ("2", "bb", "7", "000001", None, None, None, None, None, None, None), ("3", "", None, None, None, None, None, None, None, None, None)], "id string, ticker string, permno string, gvkey string, cusip string, isDelisted string, currency string, sector_alt string, industry_alt string, location string, source string")
    names = spark.createDataFrame([("AA", 5, "N5")], "ticker string, permno int, ncusip string")
    link = spark.createDataFrame([(5, "12")], "lpermno int, gvkey string")
    company = spark.createDataFrame([], "ticker string, gvkey string, cusip string")
    exchange = spark.createDataFrame([(5, 1)], "permno int, hexcd int")
    delist = spark.createDataFrame([(5, 200)], "permno int, dlstcd int")
    currency = spark.createDataFrame([("12", "USD")], "gvkey string, curcd string")
    described = spark.createDataFrame([("aa", "Mining", "Coal", "1 St", "Town", "TX", None)], "ticker string, naicsdesc string, sicdesc string, address string, city string, state string, zip string")
    out, log = enrich.enrich(rec, names, link, company, exchange, delist, currency, described)
    got = {r.id: r for r in out.collect()}
    one = got["1"]
    assert (one.permno, one.gvkey, one.cusip, one.isDelisted, one.currency, one.sector_alt, one.industry_alt, one.location, one.source) == ("5", "000012", "Q", "false", "CAD", "Mining", "Old", "kept", "SEC, WRDS")
    assert got["2"].source is None and got["3"].permno is None and out.columns == rec.columns
    assert sorted((r.field, r.source) for r in log.collect()) == sorted([("permno", "WRDS.CRSP"), ("gvkey", "WRDS.LINK/COMP"), ("exchange", "WRDS.CRSP.MSF"), ("sector_alt", "WRDS.EXECUCOMP"), ("source", "WRDS")])


def test_refused_pages(spark):
    from cornice.functions.text import html_status

    pages = ["request has been blocked", "Automated access, service unavailable", "x" * 4090 + "forbidden", "x" * 4087 + "FORBIDDEN", "é" * 2044 + "Access Denied", None, ""]
    df = spark.createDataFrame([(i, p and p.ljust(5000)) for i, p in enumerate(pages)], "i int, p string")
    got = [r.s for r in df.orderBy("i").select(html_status(F.col("p")).alias("s")).collect()]
    assert got == ["blocked", "ok", "ok", "blocked", "ok", "empty", "empty"]
    assert df.where("i = 0").select(html_status(F.col("p").cast("binary"), 6000).alias("s")).first().s == "too_small:<6000"


def test_bytes_that_are_no_text_are_dropped(spark):
    from cornice.sources.files import valid_text

    raw = "aé�b".encode() + b"\xff\xe2\x82" + "€c".encode() + b"\xc3"
    assert spark.createDataFrame([(bytearray(raw),)], "b binary").select(valid_text(F.col("b")).alias("t")).first().t == raw.decode("utf-8", "ignore") == "aé�b€c"


def test_spans_up_to_the_limits_of_the_standard(spark):
    from cornice.functions.htmlkit import cells_of, parse_tables

    assert len(cells_of("<table><tr><td colspan=3000>x<td rowspan=2500>y")) == 1000 + 2500
    df = spark.createDataFrame([(1, "<table>" + "<tr><td>a" * 40000 + "</table>"), (2, None), (3, "<table><tr><td>z")], "doc int, html string")
    assert {r.doc: r["count"] for r in parse_tables(df).groupBy("doc").count().collect()} == {1: 40000, 3: 1}


def test_footnote_free_headers(spark):
    from cornice.functions.headers import footnote_free_header

    raw = ["Name and Principal Position(1)", "Year (2)", "Yearly pay", "Incentive Plan Compen-\n sation ($)", "Incentive", "Deferred Compensation", "Stock/Award", None, " ", "All Other (3)"]
    want = ["name_position", "fiscal_year", "yearly_pay", "non_equity_incentive", "incentive", "pension_value", "stock_awards", "", "", "all_other_comp"]
    df = spark.createDataFrame(list(enumerate(raw)), "i int, h string")
    assert [r.x for r in df.orderBy("i").select(footnote_free_header(F.col("h")).alias("x")).collect()] == want
