"""Odd rows of identifiers and of older scores."""

from pyspark.sql import functions as F

from cornice.operators import enrich, scorers, state


def test_names_links_and_securities(spark):
    names = spark.createDataFrame([("a", 2, "2001-01-01"), ("A", 1, None), ("A", 3, None), ("", 4, None), (None, 5, None)], "ticker string, permno int, e string").select("ticker", "permno", F.to_date("e").alias("nameenddt"))
    assert [(r.ticker, r.permno) for r in enrich.crsp_names(names).collect()] == [("A", 1)]
    links = spark.createDataFrame([(1, "9", "LC", "P", "2001-01-01"), (1, "8", "LU", "C", None), (1, "7", "NR", "P", None), (2, "6", "LS", "J", None)], "lpermno int, gvkey string, linktype string, linkprim string, e string")
    assert [(r.lpermno, r.gvkey) for r in enrich.links(links.withColumn("linkenddt", F.to_date("e"))).collect()] == [(1, "8")]
    security = spark.createDataFrame([("2", "x", 1), ("1", "X", 2), ("1", "x", 1), ("3", None, 1)], "gvkey string, tic string, iid int")
    company = spark.createDataFrame([("2", "two")], "gvkey string, conm string")
    assert [tuple(r) for r in enrich.first_securities(security, company).collect()] == [("X", "1", None)]


def test_fill_cik_falls_through_blanks(spark):
    records = spark.createDataFrame([(1, "a", "5", None), (2, "b", "5", ""), (3, None, "6", "null"), (4, "a", None, "7")], "id int, ticker string, permno string, cik_str string")
    by_ticker = spark.createDataFrame([("A", "12"), ("B", "")], "ticker string, cik string")
    by_permno = spark.createDataFrame([(5, "345")], "permno int, cik string")
    got = {r.id: r.cik_str for r in enrich.fill_cik(records, by_ticker, by_permno).collect()}
    assert got == {1: "0000000012", 2: "0000000345", 3: "null", 4: "7"}


def test_append_and_last_known(spark):
    rows = lambda *r: spark.createDataFrame(list(r), "k string, i int, v string")
    got = state.append_unseen(rows(("a", 1, "x"), ("a", 2, "y")), rows(("a", 0, "z"), ("b", 2, "q"), ("b", 1, "p")), ["k"], "i")
    assert sorted(r.v for r in got.collect()) == ["p", "x", "y"]
    got = state.upsert_fields(rows(("a", 1, "x"), ("a", 2, None), ("b", 1, None)), ["k"], "i", ["v"])
    assert {r.k: r.v for r in got.collect()} == {"a": "x", "b": None}
    fields = state.record_fields(spark.createDataFrame([(1, None, " q ")], "id int, b int, `a.c` string"), "id").orderBy("pos").collect()
    assert [(r.field, r.value) for r in fields] == [("a.c", "q"), ("b", "")]


def test_older_scores_of_small_tables(spark):
    rows = [("a", 0, 0, 0, "Name & Principal Occupation"), ("a", 0, 0, 1, "Salary"), ("a", 1, 0, 0, None)]
    cells = spark.createDataFrame([(*r, 0) for r in rows], "doc string, table_idx int, row_idx int, col_idx int, text string, title_cues int")
    score = lambda df: {r.table_idx: r.score for r in df.collect()}
    assert score(scorers.ranked_score(cells)) == {0: 8, 1: 0} and score(scorers.fallback_score(cells)) == {0: 7, 1: 0}
    assert score(scorers.first_score(cells)) == {0: 7, 1: 0} and score(scorers.legacy_score(cells, ["salary"])) == {0: 4, 1: 0}
    texts = spark.createDataFrame([("beneficial owner 5%",), ("beneficial owner",), ("5%",), (None,)], "t string")
    assert [r.s for r in texts.select(scorers.simple_ownership_score(F.col("t")).alias("s")).collect()] == [2, -1, -1, -1]


def test_first_split(spark):
    from cornice.functions.text import first_split

    # In any case of letters the first pattern takes two letters or more that stand together.
    want = {
        "J. P. Roe, CEO": ("J. P. Roe", ", CEO"), "Ann Poe": ("Ann", "Poe"), "": ("", ""), None: ("", ""), "#5": ("#5", ""), "ceo": ("ceo", ""), "1 treasurer 2": ("treasurer", "1  2"),
        "vp": ("", "vp"), "vp 5": ("", "vp 5"), "é vp ü 7": ("é  ü 7", "vp"), "J. Roe of 1 2": ("J. Roe", "of 1 2"), "J. Roe Ann Poe X": ("J. Roe", ""),
    }
    df = spark.createDataFrame([(k,) for k in want], "t string").select("t", first_split(F.col("t")).alias("x"))
    assert {r.t: tuple(r.x) for r in df.collect()} == want


def test_repaired_texts(spark):
    from cornice.functions.text import repaired

    right = ["café", "the firm’s", "naïve €", "中文", "plain", "", None, "Ã", "“x”"]
    wrong = [None if x is None else "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in x.encode()) for x in right]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(zip(right, wrong))], "i int, a string, b string").orderBy("i")
    rows = df.select("a", repaired(F.col("a")).alias("same"), repaired(F.col("b")).alias("mended")).collect()
    assert [r.same for r in rows] == right and [r.mended for r in rows] == right


def test_ticker_metadata_of_unknown_and_delisted(spark):
    names = spark.createDataFrame([(7, 1, "A", "x", None, 1), (3, 2, "B", "y", "", 9)], "ord long, permno int, ticker string, name string, cusip string, exchcd int")
    security = spark.createDataFrame([("A", "g2"), ("A", "g1")], "ticker string, gvkey string")
    company = spark.createDataFrame([("g1", 7372, "S", None)], "gvkey string, sic int, state string, country string")
    gone = spark.createDataFrame([(2,), (2,), (None,)], "permno int")
    got = enrich.ticker_metadata(names, security, company, gone, "ord").orderBy("id").collect()
    assert [(r.id, r.ticker, r.gvkey, r.isDelisted, r.exchange, r.source, r.location) for r in got] == [(1, "B-DELISTED", None, True, "Other", "WRDS", None), (2, "A", "g1", False, "NYSE", "WRDS", None), (3, "A", "g2", False, "NYSE", "WRDS", None)]


def test_salary_tables(spark):
    from cornice.functions.nodes import parse_nodes
    from cornice.operators import pages

    cue, paid = "<td>Principal position", "<td>Salary"
    html = [f"<table><tr>{cue}</table><table><tr>{paid}</table>", f"<table><tr><td>x<table><tr>{cue}{paid}</table></table>", f"<p>Name & position<table><tr>{paid}</table>", None]
    df = spark.createDataFrame(list(enumerate(html)), "doc int, html string")
    assert [tuple(r) for r in pages.salary_tables(parse_nodes(df), "doc").collect()] == [(1, 1)]


def test_spans_of_one_key_over_many_partitions(spark):
    import random

    r = random.Random(3)
    spans = lambda n, w: [(r.choice(["hot"] * 9 + ["a", None]), lo, lo + r.randrange(w)) for lo in (r.randrange(2000) for _ in range(n))]
    wanted, have = spans(1500, 30), spans(400, 60) + [("hot", 5, 900)]
    df = lambda rows: spark.createDataFrame(rows, "k string, lo int, hi int")
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = sorted(map(tuple, state.uncovered(df(wanted), df(have), "k").collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    covered = lambda s: any(s[0] is not None and h[0] == s[0] and h[1] <= s[1] and h[2] >= s[2] for h in have)
    assert got == sorted((s for s in wanted if not covered(s)), key=repr)
    assert state.uncovered(df(wanted), df(have).limit(0), "k").count() == len(wanted) and state.uncovered(df(have).limit(0), df(have), "k").count() == 0
