"""Odd input of the governance operators and record helpers."""

from pyspark.sql import functions as F

from cornice.functions import headers, records
from cornice.operators import governance


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first()["x"]


def test_report_reason_on_nulls(spark):
    none = F.lit(None).cast("string")
    assert one(spark, records.report_reason(none, none, none)) == "json_parse_error"
    assert one(spark, records.report_reason(F.lit('{"company": 3}'), none, none)) == "missing_company"


def test_one_bad_person_leaves_the_others_be(spark):
    report = '{"company": {"ticker": "A", "reports": [{"report_date": "d", "executives": {"X": 5, "Y": {"2001": 7, "2002": {"salary": [1]}}, "Z": null}}]}}'
    assert one(spark, records.report_reason(F.lit(report), F.lit("a"), F.lit("d"))) == "ok"
    assert one(spark, records.report_reason(F.lit(report.replace("salary", "pay")), F.lit("a"), F.lit("d"))) == "no_numeric_fields"
    assert one(spark, records.report_reason(F.lit(report.replace('[{"rep', '["x", {"rep')), F.lit("a"), F.lit("d"))) == "empty_executives"


def test_report_dates_at_any_depth(spark):
    text = '{"a": [{"Report_Date": " 2001-01-01 "}, {"report_date": ""}], "b": "say \\"report_date\\": \\"2002-02-02\\""}'
    assert one(spark, records.report_dates(F.lit(text))) == ["2001-01-01"]
    assert not one(spark, records.has_report_date(F.lit("{}"), F.lit("")))
    text = r'[{"report_\u0064ate": "\u0032001"}, {"x": "\",\"report_date\":\"no"}, [{"REPORT_DATE": "a\"b\\"}], {"report_date": 5}]'
    assert one(spark, records.report_dates(F.lit(text))) == ["2001", 'a"b\\']
    assert one(spark, records.report_dates(F.lit('{"report_date": "2001"'))) == []


def test_master_counts_of_lists_and_scalars(spark):
    text = '{"summary_compensation_table": [1, 2], "beneficial_ownership": {"a": {"report_date": "2001-01-01"}, "b": 4}}'
    got = spark.range(1).select(*[c.alias(n) for n, c in records.master_counts(F.lit(text)).items()]).first()
    assert tuple(got) == (2, 2, 1)
    got = spark.range(1).select(*[c.alias(n) for n, c in records.master_counts(F.lit("[")).items()]).first()
    assert tuple(got) == (0, 0, 0)


def test_strict_blocks_named_row_without_year(spark):
    rows = [(0, 2006, "A"), (1, 2005, ""), (2, None, "B"), (3, 2005, ""), (4, 2005, ""), (5, 2006, "")]
    df = spark.createDataFrame([("k", *r) for r in rows], "k string, i int, y int, n string")
    assert [r.block for r in governance.strict_blocks(df, ["k"], "i", "y", "n").orderBy("i").collect()] == [0, 0, 1, 1, 1, 2]


def test_combined_years_first_match_and_turnover_alone(spark):
    side = lambda rows, c: spark.createDataFrame(rows, f"k string, y int, pos int, {c} int")
    out = governance.combined_years(side([("a", 1, 0, 5), ("a", 1, 1, 6)], "m"), side([("a", 1, 0, 7), ("a", 3, 0, 8)], "n"), side([("a", 2, 0, 9)], "c"), ["k", "y"], "pos")
    assert {(r.y, r.m, r.n, r.c) for r in out.collect()} == {(1, 5, 7, None), (2, None, None, 9)}


def test_mapped_universe_last_row_wins(spark):
    listed = spark.createDataFrame([("1", "aa", "A"), ("2", "AA", "A2")], "cik string, ticker string, company_name string")
    rows = [(0, "AA", "x", 1, "g1", "c"), (1, "aA", "x", 2, None, "d"), (2, "ZZ", "z", 3, None, None)]
    wh = spark.createDataFrame(rows, "pos int, ticker string, company_name string, permno int, gvkey string, cusip string")
    got = {r.cik: (r.permno, r.gvkey, r.cusip) for r in governance.mapped_universe(listed, wh, "pos").collect()}
    assert got == {"1": ("2", None, "d"), "2": ("2", None, "d"), "WRDS_3": ("3", None, None)}


def test_symbol_columns_and_blank_ones(spark):
    rows = [(0, "$"), (0, " — "), (1, ""), (1, None), (2, "$"), (2, "5")]
    cells = spark.createDataFrame([("d", 0, c, x) for c, x in rows], "doc string, table_idx int, col_idx int, text string")
    assert {r.col_idx for r in governance.without_symbol_columns(cells).collect()} == {1, 2}
    assert {r.col_idx for r in governance.without_symbol_columns(cells, empty_too=True).collect()} == {2}


def test_urls(spark):
    assert one(spark, records.joined_url(F.lit(""), F.lit("a"))) is None
    assert one(spark, records.joined_url(F.lit("https://h/a/"), F.lit("//other/b"))) == "https://other/b"


def test_headers_of_nulls(spark):
    none = F.lit(None).cast("string")
    assert one(spark, headers.descriptive_header(none)) == "unknown"
    assert one(spark, headers.squashed_header(none)) is None
    assert headers.plain_names(spark.createDataFrame([(1,)], "` Fiscal Year ` int")).columns == ["fiscal_year"]


def test_totals_of_no_runs(spark):
    empty = spark.createDataFrame([], "t string, at int, n int")
    assert tuple(governance.run_totals(empty, "t", ["at"], ["n"]).first()) == (0, 0)
