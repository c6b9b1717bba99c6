"""Odd input of the choices among tables and columns, of merges, of sources and of streams."""

import json

from pyspark.sql import functions as F

from cornice.functions import records
from cornice.operators import tables
from cornice.sources import files
from cornice.streaming import increments

CELLS = "doc string, table_idx int, row_idx int, col_idx int, name string, text string"


def kept(df):
    return sorted({r.col_idx for r in df.collect()})


def test_columns_tie_goes_left_and_nameless_tables_stay(spark):
    rows = [("a", 0, r, c, n, x) for r, cells in enumerate((["1", "2", "x"], ["3", "(4)", None])) for c, (n, x) in enumerate(zip(["pay", "pay", None], cells))]
    rows += [("b", 0, 0, 0, None, "1"), ("b", 0, 0, 1, None, "2")]
    df = spark.createDataFrame(rows, CELLS)
    for choose in (tables.best_columns, tables.consolidated_columns):
        out = choose(df)
        assert kept(out.where("doc = 'a'")) == [0] and kept(out.where("doc = 'b'")) == [0, 1]
        assert choose(df.limit(0)).count() == 0


def test_consolidated_prefers_fuller_column_of_equal_numbers(spark):
    a, b = ["1", None, "1"], ["1", "—", "(1"]
    rows = [("a", 0, r, c, "pay", x) for c, col in enumerate((a, b)) for r, x in enumerate(col)]
    assert kept(tables.consolidated_columns(spark.createDataFrame(rows, CELLS))) == [1]


def test_ranked_tables_without_any_score(spark):
    df = spark.createDataFrame([("a", 0, 3, True), ("a", 1, 5, None), ("b", 0, 6, None), ("b", 1, 4, True)], "doc string, i int, score int, titled boolean")
    got = tables.ranked_tables(df, "doc", "score", "i", "titled").collect()
    assert [(r.doc, r.i) for r in got] == [("b", 1)]


def test_merge_into_empty_master_and_null_tickers(spark):
    schema = "id long, ticker string, title string, cik_str string, source string"
    found = spark.createDataFrame([(5, None, "x", "1", "WRDS"), (900000, None, None, "2", None), (70000, "B", None, None, None)], "pos long, ticker string, title string, cik_str string, source string")
    got = {r.ticker: r for r in tables.merge_into_master(spark.createDataFrame([], schema), found, "pos").collect()}
    assert (got[None].id, got[None].title, got[None].cik_str, got[None].source) == (0, "x", "1", "WRDS")
    assert (got["B"].id, got["B"].source) == (1, None)
    master = spark.createDataFrame([(3, None, "old", "9", "SEC, Wrds"), (4, None, "other", None, None)], schema)
    got = {r.id: r for r in tables.merge_into_master(master, found, "pos").collect()}
    assert (got[3].title, got[3].cik_str, got[3].source, got[4].title) == ("x", "9", "WRDS", "other")
    assert got[5].ticker == "B" and len(got) == 3


def test_payload_writes_whole_numbers_whole(spark):
    rows = [("t", "2001-02-03", " Ann ", None, 2000, 1, 5.0, 2.5), ("t", "2001-02-03", "Ann", "CEO", 2000, 2, None, 7.0), ("t", "2001-02-03", None, "x", 2000, 3, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "t string, d string, n string, p string, y int, i int, salary double, total double")
    out = json.loads(tables.report_payloads(df, ("t", "d"), "n", "p", "y", "i", ["salary", "total"]).first()["json"])
    assert out["company"]["report_year"] == "2001"
    year = out["company"]["reports"][0]["executives"]["Ann"]["2000"]
    assert year["position"] == "CEO" and year["total"] == 7 and isinstance(year["total"], int)


def test_unicode_of_nulls(spark):
    df = spark.createDataFrame([(None,), ("ﬃ é ½",)], "x string").select(records.nfkc(F.col("x")).alias("n"), records.ascii_only(F.col("x")).alias("a"))
    assert {tuple(r) for r in df.collect()} == {(None, None), ("ffi é 1\u20442", "     ")}


def test_sinks_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("b", 1), ("a", 2), (None, 3)], "k string, n int")
    files.export_parquet(df, str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 3
    files.export_lines(df, "k", str(tmp_path / "l"))
    assert [r.value for r in spark.read.text(str(tmp_path / "l")).orderBy("value").collect()] == ["a", "b"]
    files.export_tsv(df, str(tmp_path / "t"))
    assert spark.read.csv(str(tmp_path / "t"), sep="\t", header=True).columns == ["k", "n"]
    assert files.export_csv(df, str(tmp_path / "c")) and not files.export_csv(df.limit(0), str(tmp_path / "none"))
    assert files.read_csv(spark, str(tmp_path / "c")).agg(F.sum("n")).first()[0] == 6
    files.export_version(df, str(tmp_path / "v"), "1")
    files.export_version(df.limit(1), str(tmp_path / "v"), "2")
    assert {r.version: r["count"] for r in spark.read.json(str(tmp_path / "v")).groupBy("version").count().collect()} == {1: 3, 2: 1}


def test_filings_and_their_places(spark, tmp_path):
    for ticker, form, name, body in [("aa", "DEF_14A", "2001-02-03_DEF_14A.html", b"<p>caf\xc3\xa9"), ("bb", "DEF_14A", "2002-02-03_DEF_14A.html", b"<p>caf\xe9"), ("bb", "extracted", "x.html", b"no")]:
        (tmp_path / ticker / form).mkdir(parents=True, exist_ok=True)
        (tmp_path / ticker / form / name).write_bytes(body)
    got = files.filings(spark, str(tmp_path))
    assert sorted((r.ticker, r.text) for r in got.collect()) == [("aa", "<p>café"), ("bb", "<p>caf")]
    assert [r.ticker for r in files.tickers_with(got).collect()] == ["AA", "BB"]
    assert files.with_sidecar(got).where("size = length and length(sha256) = 64").count() == 2


def test_master_records_of_both_shapes(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"0": {"ticker": "A"}, "7": {"ticker": "B", "x": 1}}')
    (tmp_path / "b.json").write_text('[{"ticker": "A"}, {"x": "2"}]')
    read = lambda n: sorted(map(tuple, files.master_records(spark, str(tmp_path / n), ["ticker", "x"]).collect()))
    assert read("a.json") == [("0", "A", None), ("7", "B", "1")]
    assert read("b.json") == [("0", "A", None), ("1", None, "2")]


def test_lists_and_column_catalog(spark, tmp_path):
    (tmp_path / "l.csv").write_text("name,ticker\nx,a\ny,b\nz,a\n")
    assert files.read_list(str(tmp_path / "l.csv"), ("ticker",)) == ["A", "B"]
    (tmp_path / "m.txt").write_text("a;b;c")
    assert files.read_list(str(tmp_path / "m.txt"), ("ticker",)) == ["A", "B", "C"]
    (tmp_path / "e.txt").write_text("")
    assert files.read_list(str(tmp_path / "e.txt"), ("ticker",)) == []
    (tmp_path / "c.json").write_text('[{"column": "tic", "name": "Ticker", "description": null}, {"column": "y", "name": "Year", "description": "fiscal"}]')
    got = files.search_columns(files.column_catalog(spark, str(tmp_path / "c.json")), "FISC")
    assert [r.column for r in got.collect()] == ["y"]


def test_upsert_stream_keeps_the_latest(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "index")
    batches = [[("a", 1, "x"), ("b", 1, "x")], [("a", 2, "y"), ("c", 1, "x")]]
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, "k string, at int, v string").coalesce(1).write.mode("append").parquet(str(src))
        stream = spark.readStream.schema("k string, at int, v string").parquet(str(src))
        increments.upsert_stream(stream, out, str(tmp_path / "cp"), ["k"], "at").awaitTermination(120)
        got = sorted((r.k, r.v) for r in increments.BucketedIndex(spark, out, ["k"]).read().collect())
        assert got == ([("a", "x"), ("b", "x")], [("a", "y"), ("b", "x"), ("c", "x")])[n]


def test_bucketed_index_rewrites_what_it_touches(spark, tmp_path):
    from cornice.operators.state import upsert
    from cornice.sources.files import children

    path = str(tmp_path / "index")
    index = increments.BucketedIndex(spark, path, ["k"], 8)
    assert index.read() is None
    merge = lambda old, new: upsert(old, new, ["k"], "at")
    batch = lambda *rows: spark.createDataFrame(list(rows), "k int, at int, v string")
    now = lambda: sorted(tuple(r) for r in index.read().collect())
    index.apply(batch(*[(k, 0, "a") for k in range(40)]), 0, merge)
    files = children(spark, f"{path}/data/v0")
    assert len([f for f in files if f.startswith("bucket=")]) == 8
    index.apply(batch((3, 1, "b"), (None, 1, "x")), 1, merge)
    assert len([f for f in children(spark, f"{path}/data/v1") if f.startswith("bucket=")]) == 1
    want = sorted([(k, 0, "a") for k in range(40) if k != 3] + [(3, 1, "b")])
    assert now() == want
    # Run again, a batch does no harm; a half-written one isn't seen.
    index.apply(batch((3, 1, "b")), 1, merge)
    assert now() == want
    (tmp_path / "index" / "manifest" / "v9").mkdir()
    assert now() == want
    index.apply(batch((3, 2, "c")), 2, merge)
    index.apply(spark.createDataFrame([], "k int, at int, v string"), 3, merge)
    assert now() == sorted([(k, 0, "a") for k in range(40) if k != 3] + [(3, 2, "c")])
    # What no kept manifest names is gone, the rest of the first batch stays.
    assert [f for f in children(spark, f"{path}/data/v1") if f.startswith("bucket=")] == []
    assert len([f for f in children(spark, f"{path}/data/v0") if f.startswith("bucket=")]) == 7
    assert "v0" not in children(spark, f"{path}/manifest")


def test_warehouse_conditions_and_outcomes(spark, tmp_path):
    from cornice.sources import warehouse as W

    assert W.in_lists("tic", ["A", "O'N", "A", "B"], 2) == ["tic IN ('A', 'O''N')", "tic IN ('B')"] and W.in_lists("t", []) == []
    assert len(W.ANNUAL_COMPENSATION) == len(set(W.ANNUAL_COMPENSATION)) and len(W.DIRECTOR_COMPENSATION) == len(set(W.DIRECTOR_COMPENSATION))
    wanted = spark.createDataFrame([("a",), ("A ",), (None,), (" ",), ("b",), ("c",)], "x string")
    one, two = (spark.createDataFrame(r, "ticker string, v int") for r in ([("A", 1), ("A", 2), ("B", 1)], [("A", 1)]))
    got = {r.ticker: (r.n_one, r.n_two, r.status) for r in W.batch_outcomes(wanted, {"one": one, "two": two}).collect()}
    assert got == {"A": (2, 1, "downloaded"), "B": (1, 0, "partial"), "C": (0, 0, "no_data"), "": (0, 0, "invalid")}
    W.write_batch({"one": one}, str(tmp_path / "out"))
    assert sorted((r.ticker, r.v) for r in files.read_csv(spark, str(tmp_path / "out" / "one")).collect()) == [("A", 1), ("A", 2), ("B", 1)]


def test_routed_rows_and_stage_dumps(spark, tmp_path):
    df = spark.createDataFrame([("table", "a"), ("narrative", "b"), ("narrative", "c"), (None, "d"), ("x", "e")], "kind string, body string")
    to = lambda n: str(tmp_path / n)
    done = files.routed(df, "kind", {"table": lambda x: files.export_parquet(x, to("t")), "narrative": lambda x: files.export_lines(x, "body", to("n"))})
    assert {(r.kind, r.n, r.written) for r in done.collect()} == {("table", 1, True), ("narrative", 2, True), (None, 1, False), ("x", 1, False)}
    assert sorted(r.value for r in spark.read.text(to("n")).collect()) == ["b", "c"] and spark.read.parquet(to("t")).count() == 1
    rows = spark.createDataFrame([(1, {"a": "b"}, None)], "i int, m map<string,string>, s string")
    dumps = files.StageDumps(str(tmp_path / "d"), ("cleaned",))
    assert dumps("combined", rows) is rows and not (tmp_path / "d").exists()
    assert dumps("cleaned", rows).collect() == rows.collect()
    got = spark.read.csv(str(tmp_path / "d" / "cleaned"), header=True).first()
    assert (got.i, got.m, got.s) == ("1", '{"a":"b"}', None)
    assert files.StageDumps()("cleaned", rows) is rows


def test_cleaning_dumps_its_stages(spark, tmp_path):
    from cornice.operators import cells as C

    table = [["Name and Principal Position", "Year", "Salary"], ["Ann Roe", "2001", "5"]]
    df = spark.createDataFrame([("d", 0, r, c, x) for r, row in enumerate(table) for c, x in enumerate(row)], "doc string, table_idx int, row_idx int, col_idx int, text string")
    out = C.clean_sct(df, files.StageDumps(str(tmp_path), ("combined", "cleaned"))).collect()
    assert len(out) == 1 and len(spark.read.csv(str(tmp_path / "combined"), header=True).collect()) == 6
    assert spark.read.csv(str(tmp_path / "cleaned"), header=True).first().executive == "ann roe"


def test_modes_of_extraction(spark):
    import pytest

    from cornice.functions.htmlkit import parse_tables
    from cornice.operators import cells as C

    guard = "<table><tr><td>Name<td>Principal Position</table>"
    df = parse_tables(spark.createDataFrame([("a", "<table><tr><td>Name, principal position, salary, bonus, total, year $</table>" + guard), ("b", "<table><tr><td>x</table>"), ("c", None)], "doc string, html string"))
    tables = lambda mode: {(r.doc, r.table_idx) for r in C.extracted_tables(df, mode).collect()}
    assert tables("xpath") == {("a", 0)} and tables("score") == tables("both") == {("a", 0), ("b", 0)}
    with pytest.raises(ValueError):
        C.extracted_tables(df, "none")


def test_master_lines(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"id": 5, "ticker": "A"}\nno\n{"ticker": "B"}\n{"id": "7", "x": 1.5}\n')
    got = files.master_lines(spark, str(tmp_path / "m.json"), ["ticker", "x"])
    assert sorted(map(tuple, got.collect()), key=repr) == [("5", "A", None), ("7", None, "1.5")]
    files.write_master(got.withColumnRenamed("id", "n"), str(tmp_path / "out"), "n")
    assert files.master_lines(spark, str(tmp_path / "out"), ["x"]).count() == 2


def test_csv_in_sql(spark, tmp_path):
    (tmp_path / "it's.csv").write_text("tic,year,pay\nA,2001,1.5\nB,2002,\n")
    files.csv_views(spark, {"pay": str(tmp_path / "it's.csv")})
    assert [tuple(r) for r in spark.sql("SELECT tic, pay FROM pay WHERE year = 2001").collect()] == [("A", 1.5)]
    assert dict(spark.table("pay").dtypes) == {"tic": "string", "year": "int", "pay": "double"}


def test_warehouse_over_jdbc(spark, tmp_path):
    from cornice.sources import warehouse as W

    url, driver = f"jdbc:derby:{tmp_path}/db;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    rows = spark.createDataFrame([("A", 2001), ("B", 2001), ("O'N", 1990), ("O'N", 2002)], "TIC string, FYEAR int")
    rows.write.option("createTableColumnTypes", "TIC VARCHAR(9)").jdbc(url, "funda", properties=driver)
    got = W.partitioned_read(spark, url, "funda", "tic", ["A", "O'N", "C"], driver, "fyear > 2000")
    assert sorted(map(tuple, got.collect())) == [("A", 2001), ("O'N", 2002)]
    assert W.partitioned_read(spark, url, "funda", "tic", [str(i) for i in range(1200)], driver).rdd.getNumPartitions() == 3
    assert W.read_query(spark, url, "SELECT count(*) AS n FROM funda", driver).first()[0] == 4


def test_json_by_report(spark, tmp_path):
    files.export_json(spark.createDataFrame([("A", 1, None), ("A", 2, "x"), ("B", 3, "y")], "ticker string, n int, v string"), str(tmp_path / "out"), "ticker")
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if p.is_dir()) == ["ticker=A", "ticker=B"]
    assert sorted((r.ticker, r.n, r.v) for r in spark.read.json(str(tmp_path / "out")).collect()) == [("A", 1, None), ("A", 2, "x"), ("B", 3, "y")]
