"""Queries for governance tables, record helpers and JSON reports, over rows made of the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import headers as H
from ..functions import records as R
from ..operators import governance as G
from .catalog import query, t


def _day(c="o_orderdate"):
    return F.date_format(c, "yyyy-MM-dd")


@query("SELECT DISTINCT c_nationkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING'")
def chief_rows(spark, d):
    return G.chief_rows(t(spark, d, "customer"), "c_mktsegment", "BUILDING", ["c_nationkey", "c_name"])


@query("""SELECT o_orderkey, s AS filing_date FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'n/a' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS s FROM orders)
  WHERE try_cast(s[1:4] AS INTEGER) BETWEEN 1994 AND 1996""")
def filing_year_range(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 7 == 0, "n/a").otherwise(_day()).alias("filing_date"))
    return o.where(R.year_between(F.col("filing_date"), 1994, 1996))


@query("""SELECT o_custkey, o_orderstatus AS form, strftime(o_orderdate, '%Y-%m-%d') AS filed,
  'https://www.sec.gov/Archives/edgar/data/' || o_custkey || '/' || lpad(o_orderkey::VARCHAR, 10, '0') || '97000001/doc.htm' AS url FROM orders WHERE o_orderstatus = 'F'""")
def filings_of_form(spark, d):
    accession = F.concat(F.lpad(F.col("o_orderkey").cast("string"), 10, "0"), F.lit("-97-000001"))
    row = F.struct("o_orderstatus", _day().alias("filed"), accession.alias("accession"))
    lists = t(spark, d, "orders").groupBy("o_custkey").agg(F.collect_list(row).alias("r"))
    lists = lists.select("o_custkey", F.col("r.o_orderstatus").alias("form"), F.col("r.filed").alias("filed"), F.col("r.accession").alias("accession"))
    found = R.filings_of_form(lists, ["o_custkey"], ["form", "filed", "accession"], "f")
    return found.select("o_custkey", "form", "filed", R.archive_url(F.col("o_custkey"), F.col("accession"), F.lit("doc.htm")).alias("url"))


@query("""SELECT c_custkey, 'https://data.sec.gov/submissions/CIK' || lpad(c_custkey::VARCHAR, 10, '0') || '.json' AS listing,
  CASE c_custkey % 4 WHEN 0 THEN 'https://h.org/a/b/x.htm' WHEN 1 THEN 'https://h.org/x.htm' WHEN 2 THEN 'https://h.org/a/x.htm' ELSE 'https://h.org/a/b/index.htm' END AS page FROM customer""")
def filing_urls(spark, d):
    k = F.col("c_custkey")
    name = F.when(k % 4 == 0, "x.htm").when(k % 4 == 1, "/x.htm").when(k % 4 == 2, "../x.htm")
    return t(spark, d, "customer").select("c_custkey", R.submissions_url(k.cast("string")).alias("listing"), R.joined_url(F.lit("https://h.org/a/b/index.htm"), name).alias("page"))


@query("""SELECT c_nationkey, arg_min_null(c_name, c_custkey) AS c_name, arg_min_null(nullif(c_mktsegment, 'BUILDING'), c_custkey) AS segment FROM customer GROUP BY 1""")
def first_row_values(spark, d):
    c = t(spark, d, "customer").withColumn("segment", F.nullif("c_mktsegment", F.lit("BUILDING")))
    return G.first_values(c, ["c_nationkey"], "c_custkey", ["c_name", "segment"])


@query("""WITH o AS (SELECT o_orderkey, o_orderstatus, o_custkey, o_totalprice, year(o_orderdate)::BIGINT AS y FROM orders),
  a AS (SELECT o_custkey, y, arg_min(o_totalprice, o_orderkey) AS max_directors FROM o WHERE o_orderstatus = 'O' GROUP BY 1, 2),
  b AS (SELECT o_custkey, y, arg_min(o_orderkey, o_orderkey) AS new_directors FROM o WHERE o_orderstatus = 'P' GROUP BY 1, 2),
  c AS (SELECT o_custkey, y, arg_min(o_totalprice, o_orderkey) AS ceo_tenure FROM o WHERE o_orderstatus = 'F' GROUP BY 1, 2)
  SELECT o_custkey, y, max_directors, new_directors, ceo_tenure FROM a FULL JOIN c USING (o_custkey, y) LEFT JOIN b USING (o_custkey, y)""")
def combined_years(spark, d):
    o = t(spark, d, "orders").withColumn("y", F.year("o_orderdate").cast("long"))

    def side(status, value, name):
        return o.where(F.col("o_orderstatus") == status).select("o_custkey", "y", F.col("o_orderkey").alias("pos"), F.col(value).alias(name))

    sides = side("O", "o_totalprice", "max_directors"), side("P", "o_orderkey", "new_directors"), side("F", "o_totalprice", "ceo_tenure")
    return G.combined_years(*sides, ["o_custkey", "y"], "pos").select("o_custkey", "y", "max_directors", "new_directors", "ceo_tenure")


@query("""WITH s AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE year(o_orderdate)::BIGINT END AS y,
    CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE o_orderpriority END AS name FROM orders),
  w AS (SELECT *, max(CASE WHEN y IS NOT NULL THEN o_orderkey END) OVER b AS at, lag(y) OVER o AS py, lag(name) OVER o AS pn, lag(o_orderkey) OVER o AS pk FROM s
    WINDOW o AS (PARTITION BY o_custkey ORDER BY o_orderkey), b AS (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
  m AS (SELECT w.*, CASE WHEN w.y > q.y THEN 1 WHEN w.y IS NULL AND w.name <> '' AND w.py IS NOT NULL AND w.pn = '' THEN 1 ELSE 0 END AS new FROM w LEFT JOIN s q ON q.o_orderkey = w.at)
  SELECT o_orderkey, (sum(new) OVER (PARTITION BY o_custkey ORDER BY o_orderkey))::INTEGER AS block FROM m""")
def strict_blocks(spark, d):
    y = F.when(F.col("o_orderkey") % 3 != 0, F.year("o_orderdate"))
    name = F.when(F.col("o_orderkey") % 2 == 0, "").otherwise(F.col("o_orderpriority"))
    o = t(spark, d, "orders").withColumns({"y": y, "name": name})
    return G.strict_blocks(o, ["o_custkey"], "o_orderkey", "y", "name").select("o_orderkey", "block")


@query("""WITH l AS (SELECT c_custkey::VARCHAR AS cik, 'T' || c_custkey AS ticker, c_name AS company_name FROM customer WHERE c_custkey % 3 <> 0),
  w AS (SELECT o_orderkey AS pos, 't' || o_custkey AS ticker, o_orderpriority AS company_name, o_orderkey::VARCHAR AS permno,
    CASE WHEN o_custkey % 2 = 0 THEN 'G' || o_custkey END AS gvkey, o_orderstatus AS cusip FROM orders),
  last AS (SELECT * FROM w QUALIFY row_number() OVER (PARTITION BY upper(ticker) ORDER BY pos DESC) = 1),
  rest AS (SELECT *, 'WRDS_' || coalesce(gvkey, permno) AS cik FROM w WHERE upper(ticker) NOT IN (SELECT upper(ticker) FROM l)
    QUALIFY row_number() OVER (PARTITION BY coalesce(gvkey, permno) ORDER BY pos DESC) = 1)
  SELECT l.cik, l.ticker, l.company_name, permno, gvkey, cusip FROM l LEFT JOIN last ON upper(last.ticker) = upper(l.ticker)
  UNION ALL SELECT cik, ticker, company_name, permno, gvkey, cusip FROM rest""")
def mapped_universe(spark, d):
    listed = t(spark, d, "customer").where("c_custkey % 3 <> 0").select(F.col("c_custkey").cast("string").alias("cik"), F.concat(F.lit("T"), "c_custkey").alias("ticker"), F.col("c_name").alias("company_name"))
    gvkey = F.when(F.col("o_custkey") % 2 == 0, F.concat(F.lit("G"), "o_custkey"))
    rows = t(spark, d, "orders").select(
        F.col("o_orderkey").alias("pos"), F.concat(F.lit("t"), "o_custkey").alias("ticker"), F.col("o_orderpriority").alias("company_name"),
        F.col("o_orderkey").alias("permno"), gvkey.alias("gvkey"), F.col("o_orderstatus").alias("cusip"),
    )
    return G.mapped_universe(listed, rows, "pos")


@query("SELECT c_custkey, (c_custkey % 14)::INTEGER AS shrcd FROM customer WHERE c_custkey % 14 IN (10, 11)")
def share_universe(spark, d):
    return G.share_universe(t(spark, d, "customer").select("c_custkey", (F.col("c_custkey") % 14).cast("int").alias("shrcd")), "shrcd")


@query("""WITH r AS (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
  SELECT count(*) AS keys, sum(o_orderkey % 10)::BIGINT AS extracted, sum(o_orderkey % 3)::BIGINT AS failed FROM r""")
def run_totals(spark, d):
    o = t(spark, d, "orders").withColumns({"extracted": F.col("o_orderkey") % 10, "failed": F.col("o_orderkey") % 3})
    return G.run_totals(o, "o_custkey", ["o_orderdate", "o_orderkey"], ["extracted", "failed"])


@query("""SELECT c_mktsegment, count(*) AS files, array_to_string(list_sort(list(c_name) FILTER (rn <= 5)), ';') AS sample
  FROM (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_name) AS rn FROM customer) GROUP BY 1""")
def category_audit(spark, d):
    out = G.audit(t(spark, d, "customer"), "c_mktsegment", "c_name", 5)
    return out.withColumn("sample", F.array_join("sample", ";"))


@query("""SELECT c_custkey, o_orderkey, o_totalprice FROM (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) = 1)
  JOIN customer ON c_custkey = o_custkey AND o_orderstatus = CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'O' END""")
def best_sibling(spark, d):
    texts = t(spark, d, "customer").select("c_custkey", F.col("c_custkey").alias("folder"), F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("O").alias("date"))
    pages = t(spark, d, "orders").select(F.col("o_custkey").alias("folder"), F.col("o_orderstatus").alias("date"), "o_totalprice", "o_orderkey")
    return G.best_sibling(texts, pages, ["folder", "date"], "o_totalprice", "o_orderkey").select("c_custkey", "o_orderkey", "o_totalprice")


@query("""WITH c AS (SELECT o_custkey AS doc, (o_orderkey % 4)::INTEGER AS col_idx, o_orderkey AS row_idx,
    CASE o_orderkey % 4 WHEN 0 THEN '$' WHEN 1 THEN '' WHEN 2 THEN CASE WHEN o_orderkey % 3 = 0 THEN '-' ELSE ' $ ' END ELSE CASE WHEN o_orderkey % 3 = 0 THEN '—' ELSE '12' END END AS text FROM orders),
  k AS (SELECT doc, col_idx, bool_and(trim(text) IN ('', '$', '-', '—')) AS symbols, bool_and(trim(text) = '') AS blank FROM c GROUP BY 1, 2)
  SELECT c.doc, c.row_idx, c.text FROM c JOIN k USING (doc, col_idx) WHERE NOT (symbols AND NOT blank)""")
def symbol_columns(spark, d):
    k = F.col("o_orderkey")
    third = k % 3 == 0
    text = F.when(k % 4 == 0, "$").when(k % 4 == 1, "").when(k % 4 == 2, F.when(third, "-").otherwise(" $ ")).otherwise(F.when(third, "—").otherwise("12"))
    cells = t(spark, d, "orders").select(F.col("o_custkey").alias("doc"), F.lit(0).alias("table_idx"), k.alias("row_idx"), (k % 4).cast("int").alias("col_idx"), text.alias("text"))
    return G.without_symbol_columns(cells).select("doc", "row_idx", "text")


@query("SELECT o_orderkey, o_orderkey % 5 IN (0, 1, 3) AS proxy FROM orders")
def proxy_phrases(spark, d):
    k = F.col("o_orderkey") % 5
    text = F.when(k == 0, "<b>SUMMARY\n Compensation  Table</b>").when(k == 1, "Name and Principal Position").when(k == 2, "nonexecutive compensations").when(k == 3, "Executive Compensation.")
    return t(spark, d, "orders").select("o_orderkey", R.looks_like_proxy(text).alias("proxy"))


@query("""SELECT c_custkey, trim(c_name) || '|' || c_mktsegment AS items, 'T' || c_custkey AS ticker, c_name AS listed, 'salary' AS base, 'Stock ' || c_custkey AS header, c_name AS name, 'CEO, Director' AS position FROM customer""")
def label_helpers(spark, d):
    k = F.col("c_custkey").cast("string")
    page = F.concat(F.lit("top\nT"), k, F.lit(" ("), F.col("c_name"), F.lit(") Start Date:2001-02-03 -x\nU (V) Start Date:2001"))
    pair = F.get(R.listed_tickers(page), F.lit(0))
    split = R.name_before_comma(F.concat("c_name", F.lit(" , CEO, Director ")))
    levels = F.array(F.lit("Unnamed: 3_level_0"), F.lit(" Stock"), F.lit(None).cast("string"), k)
    return t(spark, d, "customer").select(
        "c_custkey", F.array_join(R.item_list(F.concat("c_name", F.lit(" ;, ,"), "c_mktsegment", F.lit(";"))), "|").alias("items"),
        pair["ticker"].alias("ticker"), pair["name"].alias("listed"), R.base_name(F.concat(F.lit("salary_"), k)).alias("base"),
        R.flat_header(levels).alias("header"), split["name"].alias("name"), split["position"].alias("position"),
    )


@query("""SELECT o_custkey, count(*) FILTER (o_orderkey % 4 <> 3) AS numbers, sum(CASE o_orderkey % 4 WHEN 0 THEN o_orderkey WHEN 1 THEN -o_orderkey WHEN 2 THEN 1250 END)::DOUBLE AS total FROM orders GROUP BY 1""")
def numeric_score(spark, d):
    k = F.col("o_orderkey")
    text = F.when(k % 4 == 0, F.concat(F.lit("$ "), k)).when(k % 4 == 1, F.concat(F.lit("("), k, F.lit(")"))).when(k % 4 == 2, " 1,250").otherwise("n/a")
    n = R.plain_number(text)
    return t(spark, d, "orders").groupBy("o_custkey").agg(F.count(n).alias("numbers"), F.sum(n).alias("total"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS amount, CASE WHEN o_orderkey % 4 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS day,
  CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS label FROM orders""")
def typed_columns(spark, d):
    k = F.col("o_orderkey")
    rows = t(spark, d, "orders").select(
        "o_orderkey", F.when(k % 3 == 0, "x1").otherwise(F.col("o_totalprice").cast("string")).alias("amount"),
        F.when(k % 4 == 0, "soon").otherwise(_day()).alias("day"), F.when(k % 5 == 0, "nan").otherwise(F.col("o_orderpriority")).alias("label"),
    )
    return R.typed(rows, ["amount"], ["day"], ["label"]).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query("SELECT c_custkey, NULL::VARCHAR AS gvkey, NULL::VARCHAR AS cusip, c_custkey % 3 <> 0 OR c_custkey % 5 <> 0 AS cleared FROM customer")
def without_ids(spark, d):
    k = F.col("c_custkey")
    rows = t(spark, d, "customer").select("c_custkey", F.when(k % 3 != 0, "g").alias("gvkey"), F.when(k % 5 != 0, "c").alias("cusip"))
    return R.without_ids(rows, ["gvkey", "cusip"])


@query("""WITH x AS (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '0.0' WHEN 2 THEN '12' WHEN 3 THEN 'a' ELSE ' ' END AS old,
    CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '12.0' WHEN 2 THEN 'a' WHEN 3 THEN '7' WHEN 4 THEN '' WHEN 5 THEN '0' ELSE 'b' END AS new FROM orders),
  m AS (SELECT *, old IS NULL OR old IN ('0.0', ' ') AS mo, new IS NULL OR new IN ('', '0') AS mn FROM x)
  SELECT o_orderkey, CASE WHEN mo THEN new ELSE old END AS value, CASE WHEN NOT mo AND NOT mn AND NOT (old = new OR old = '12' AND new = '12.0') THEN new END AS other FROM m""")
def merged_values(spark, d):
    def choice(c, n, values):
        out = F.lit(None).cast("string")
        for i, v in enumerate(values):
            out = F.when(c % n == i, F.lit(v)).otherwise(out)
        return out

    k = F.col("o_orderkey")
    got = R.merged_value(choice(k, 5, [None, "0.0", "12", "a", " "]), choice(k, 7, [None, "12.0", "a", "7", "", "0", "b"]))
    return t(spark, d, "orders").select("o_orderkey", got["value"].alias("value"), got["other"].alias("other"))


# JSON reports made of orders


def _report(k):
    """A report of order k, spoilt in another way for each k modulo 9."""
    pay = F.when(k % 9 == 8, "age").otherwise("salary")
    people = F.concat(F.lit('{"P'), k, F.lit('": {"2001": {"'), pay, F.lit('": 5}}}'))
    people = F.when(k % 9 == 5, F.lit("{}")).otherwise(people)
    report = F.concat(F.lit('[{"report_date": "'), F.when(k % 9 == 7, "1901-01-01").when(k % 2 == 0, F.replace(_day(), F.lit("-"), F.lit("\\u002d"))).otherwise(_day()), F.lit('", "executives": '), people, F.lit("}]"))
    reports = F.when(k % 9 == 4, F.lit("[]")).otherwise(report)
    company = F.concat(F.lit('{"company": {"ticker": "'), F.when(k % 9 == 6, "zz").otherwise("abc"), F.lit('", "reports": '), reports, F.lit("}}"))
    return F.when(k % 9 == 1, F.lit('{"company": ')).when(k % 9 == 2, F.lit('{"raw_response": "x"}')).when(k % 9 == 3, F.lit('{"other": 1}')).otherwise(company)


@query("""SELECT o_orderkey, ['ok', 'json_parse_error', 'raw_or_parse_error_present', 'missing_company', 'missing_reports', 'empty_executives', 'ticker_mismatch', 'date_mismatch', 'no_numeric_fields'][o_orderkey % 9 + 1] AS reason,
  o_orderkey % 9 IN (0, 5, 6, 8) AS dated FROM orders""")
def report_reason(spark, d):
    json = _report(F.col("o_orderkey"))
    return t(spark, d, "orders").select("o_orderkey", R.report_reason(json, F.lit("ABC"), _day()).alias("reason"), R.has_report_date(json, _day()).alias("dated"))


@query("""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'no_object' WHEN 1 THEN 'parse_error' ELSE 'ok' END AS status,
  CASE WHEN o_orderkey % 4 >= 2 THEN '{"k": ' || o_orderkey || '}' END AS json FROM orders""")
def salvaged_json(spark, d):
    k = F.col("o_orderkey")
    obj = F.concat(F.lit('{"k": '), k, F.lit("}"))
    text = F.when(k % 4 == 0, F.lit("sorry")).when(k % 4 == 1, F.lit("so {k: } done")).when(k % 4 == 2, F.concat(F.lit("```json\n"), obj, F.lit("\n```"))).otherwise(F.concat(F.lit("Here: "), obj, F.lit(" ok")))
    got = R.salvaged(text)
    return t(spark, d, "orders").select("o_orderkey", got["status"].alias("status"), got["json"].alias("json"))


@query("""SELECT o_custkey, count(*) AS pay_entries, count(*) AS holder_entries, count(DISTINCT CASE WHEN o_orderkey % 6 <> 0 THEN year(o_orderdate) END) AS holder_years FROM orders GROUP BY 1""")
def master_counts(spark, d):
    k = F.col("o_orderkey").cast("string")
    holder = F.struct(F.when(F.col("o_orderkey") % 6 == 0, "soon").otherwise(_day()).alias("report_date"))
    record = F.to_json(F.struct(F.map_from_entries(F.collect_list(F.struct(k, "o_totalprice"))).alias("summary_compensation_table"), F.collect_list(holder).alias("beneficial_ownership")))
    rows = t(spark, d, "orders").groupBy("o_custkey").agg(record.alias("json"))
    return rows.select("o_custkey", *[c.alias(n) for n, c in R.master_counts(F.col("json")).items()])


# Older header rules

#: A header for each order key modulo 12, and its names by the four rule sets.
HEADERS = [
    ("Name and Principal Position", "name_and_position", "name_position", "name_position", "name_position"),
    ("Fiscal Year Ended", "year", "fiscal_year", "year", "year"),
    ("Base Salary ($)(1)", "salary", "salary", "salary", "salary"),
    ("AIP Payout", "bonus", "aip_payout", None, "AIP Payout"),
    ("Other Annual Compen- sation", "other_annual_comp", "other_annual_comp", None, "Other Annual Compen- sation"),
    ("Options Granted", "option_awards", "option_awards", None, "Options Granted"),
    ("Restricted Stock", "stock_awards", "restricted_stock", None, "Restricted Stock"),
    ("Stock Awards ($)", "stock_awards", "stock_awards", None, "stock_awards"),
    ("Non-Equity Incentive", "non_equity_incentive", "non_equity_incentive", None, "non_equity_incentive_plan"),
    ("All Other Comp", "all_other_comp", "all_other_comp", None, "all_other_compensation"),
    ("Grand Total", "total", "total", "total", "total"),
    ("($)", "unknown", "", None, "($)"),
]


def _listed(i):
    return "[" + ", ".join("NULL" if h[i] is None else f"'{h[i]}'" for h in HEADERS) + "][o_orderkey % 12 + 1]"


@query(f"SELECT o_orderkey, {_listed(1)} AS descriptive, {_listed(2)} AS fiscal, {_listed(3)} AS token, {_listed(4)} AS squashed FROM orders")
def older_headers(spark, d):
    raw = F.element_at(F.array(*[F.lit(h[0]) for h in HEADERS]), (F.col("o_orderkey") % 12 + 1).cast("int"))
    o = t(spark, d, "orders")
    return o.select("o_orderkey", H.descriptive_header(raw).alias("descriptive"), H.fiscal_header(raw).alias("fiscal"), H.token_header(raw).alias("token"), H.squashed_header(raw).alias("squashed"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'name_position' ELSE ['salary', 'all_other_compensation', 'Perks'][c_custkey % 3 + 1] END AS header FROM customer""")
def synonym_headers(spark, d):
    raw = F.element_at(F.array(F.lit(" SALARY ($) "), F.lit("All other  compensation(2)"), F.lit("Perks")), (F.col("c_custkey") % 3 + 1).cast("int"))
    return t(spark, d, "customer").select("c_custkey", H.synonym_header(raw, F.col("c_custkey") % 4).alias("header"))
