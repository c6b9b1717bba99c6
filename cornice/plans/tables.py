"""Queries for choices among tables and columns, two-row headers, payloads, master merges and event windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import records as R
from ..operators import cells as C
from ..operators import tables as T
from ..session import cut, spread
from ..sources import warehouse as W
from ..streaming.increments import windowed_counts
from .catalog import _filings, query, t


@query("""WITH s AS (SELECT o_custkey, o_orderkey, (o_orderkey % 10)::INTEGER AS score, o_orderkey % 3 = 0 AS titled FROM orders),
  f AS (SELECT *, bool_or(titled AND score >= 4) OVER (PARTITION BY o_custkey) AS a FROM s)
  SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY score DESC, o_orderkey)::INTEGER AS rank
  FROM f WHERE CASE WHEN a THEN titled AND score >= 4 ELSE score >= 6 END QUALIFY rank <= 2""")
def ranked_tables(spark, d):
    k = F.col("o_orderkey")
    s = t(spark, d, "orders").select("o_custkey", "o_orderkey", (k % 10).alias("score"), (k % 3 == 0).alias("titled"))
    return T.ranked_tables(s, "o_custkey", "score", "o_orderkey", "titled").select("o_custkey", "o_orderkey", "rank")


@query("""WITH s AS (SELECT o_custkey, o_orderkey, (o_orderkey % 7 - 2)::INTEGER AS score, o_orderstatus AS kind FROM orders),
  k AS (SELECT * FROM s WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY score DESC, kind, o_orderkey) <= 3)
  SELECT o_custkey, kind, o_orderkey FROM k WHERE kind IN ('O', 'F') QUALIFY row_number() OVER (PARTITION BY o_custkey, kind ORDER BY score DESC, o_orderkey) = 1""")
def best_of_kinds(spark, d):
    s = t(spark, d, "orders").select("o_custkey", "o_orderkey", (F.col("o_orderkey") % 7 - 2).alias("score"), F.col("o_orderstatus").alias("kind"))
    return T.best_of_kinds(s, "o_custkey", "score", "kind", "o_orderkey", ["O", "F"]).select("o_custkey", "kind", "o_orderkey")


def _cells(spark, d):
    """A row for each order of a customer's table; the columns are two salaries, two names and one without a name."""
    k = F.col("o_orderkey")
    texts = [
        F.when(k % 2 == 0, "$").otherwise(k.cast("string")),
        F.when(k % 3 == 0, "n/a").otherwise(F.concat(F.lit("$"), (k % 4).cast("string"))),
        F.when(k % 5 == 0, "CEO"),
        F.concat(F.lit("Chief "), k),
        k.cast("string"),
    ]
    names = ["salary", "salary", "name_position", "name_position", None]
    cells = F.array(*[F.struct(F.lit(i).alias("col_idx"), F.lit(n).cast("string").alias("name"), x.alias("text")) for i, (n, x) in enumerate(zip(names, texts))])
    return t(spark, d, "orders").select(F.col("o_custkey").alias("doc"), F.lit(0).alias("table_idx"), k.alias("row_idx"), F.inline(cells))


_CELLS = """WITH c AS (SELECT o_custkey AS doc, o_orderkey AS k, CASE WHEN k % 2 = 1 THEN k::VARCHAR ELSE '$' END AS a,
    CASE WHEN k % 3 = 0 THEN 'n/a' ELSE '$' || k % 4 END AS b, CASE WHEN k % 5 = 0 THEN 'CEO' END AS e, 'Chief ' || k AS f FROM orders),"""


@query(_CELLS + """ n AS (SELECT doc, count(*) FILTER (k % 2 = 1) AS na, count(*) FILTER (k % 3 <> 0) AS nb FROM c GROUP BY 1)
  SELECT doc, k AS row_idx, 'salary' AS name, CASE WHEN nb > na THEN b ELSE a END AS text FROM c JOIN n USING (doc)
  UNION ALL SELECT doc, k, 'name_position', e FROM c""")
def best_columns(spark, d):
    return T.best_columns(_cells(spark, d)).select("doc", "row_idx", "name", "text")


@query(_CELLS + """ n AS (SELECT doc, count(DISTINCT CASE WHEN k % 2 = 1 THEN k END) AS na, count(DISTINCT CASE WHEN k % 3 <> 0 THEN k % 4 END) AS nb, count(e) AS ne FROM c GROUP BY 1)
  SELECT doc, k AS row_idx, 'salary' AS name, CASE WHEN nb > na THEN b ELSE a END AS text FROM c JOIN n USING (doc)
  UNION ALL SELECT doc, k, 'name_position', CASE WHEN ne > 0 THEN e ELSE f END FROM c JOIN n USING (doc)""")
def consolidated_columns(spark, d):
    return T.consolidated_columns(_cells(spark, d)).select("doc", "row_idx", "name", "text")


@query("""WITH v AS (SELECT c_custkey AS doc, c_custkey % 3 AS m, c_name, c_mktsegment FROM customer),
  n AS (SELECT doc, CASE WHEN m = 0 THEN ['name', 'salary ($)', 'stock_awards', 'total'] ELSE ['Name', 'Salary', 'Stock', ''] END AS names, m, c_name, c_mktsegment FROM v),
  r AS (SELECT doc, names, 2 AS row_idx, [c_name, '1', '2', c_mktsegment] AS cells FROM n
    UNION ALL SELECT doc, names, 1, CASE WHEN m = 1 THEN ['Name', '', 'awards', 'Total'] ELSE [c_name, 'x', 'awards', 'Total'] END FROM n WHERE m <> 0)
  SELECT doc, row_idx, names[i] AS name, cells[i] AS text FROM r, (VALUES (1), (2), (3), (4)) p(i)""")
def two_row_header(spark, d):
    m = F.col("c_custkey") % 3
    # Two cells of row 1 equal headers where m is 0, one where it is 1, none where it is 2.
    heads = [F.lit("Name"), F.lit("Salary"), F.lit("Stock"), F.when(m == 0, "total").otherwise("")]
    below = [F.when(m == 2, F.col("c_name")).otherwise("Name"), F.when(m == 0, "Salary ($)").when(m == 2, "x"), F.lit("awards"), F.lit("Total")]
    body = [F.col("c_name"), F.lit("1"), F.lit("2"), F.col("c_mktsegment")]
    cells = [F.struct(F.lit(r).alias("row_idx"), F.lit(i).alias("col_idx"), c.alias("text")) for r, row in enumerate((heads, below, body)) for i, c in enumerate(row)]
    dealt = spread(t(spark, d, "customer").withColumn("doc", F.col("c_custkey")), "doc")
    rows = dealt.select("doc", F.lit(0).alias("table_idx"), F.inline(F.array(*cells)))
    out = T.with_two_row_header(rows)
    return out.select("doc", "row_idx", "name", F.coalesce("text", F.lit("")).alias("text"))


@query("""SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'Stock Awards' WHEN 1 THEN 'Stock' ELSE 'Stock Awards' END AS header FROM customer""")
def stacked_header(spark, d):
    k = F.col("c_custkey") % 3
    lower = F.when(k == 0, "Awards").when(k == 2, "Stock")
    return t(spark, d, "customer").select("c_custkey", T.stacked_header(F.when(k == 2, "Stock Awards").otherwise("Stock"), lower).alias("header"))


@query("""WITH r AS (SELECT 't' || o_custkey AS ticker, strftime(o_orderdate, '%Y-%m-%d') AS date, o_orderkey AS k, CASE WHEN o_orderkey % 5 = 0 THEN ' ' ELSE o_orderpriority END AS name,
    CASE WHEN o_orderkey % 7 <> 0 THEN year(o_orderdate) - o_orderkey % 2 END AS y, CASE WHEN o_orderkey % 3 = 0 THEN round(o_totalprice) ELSE o_totalprice END AS total FROM orders),
  l AS (SELECT * FROM r WHERE y IS NOT NULL AND trim(name) <> '' QUALIFY row_number() OVER (PARTITION BY ticker, date, name, y ORDER BY k DESC) = 1)
  SELECT upper(ticker) AS ticker, date, name, y::VARCHAR AS year, CASE WHEN total = floor(total) THEN 'whole' ELSE 'part' END AS form, total, CASE WHEN k % 2 = 0 THEN 'CEO' END AS position FROM l""")
def report_payloads(spark, d):
    k = F.col("o_orderkey")
    rows = t(spark, d, "orders").select(
        F.concat(F.lit("t"), "o_custkey").alias("ticker"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), "o_orderkey",
        F.when(k % 5 == 0, " ").otherwise(F.col("o_orderpriority")).alias("name"), F.when(k % 2 == 0, "CEO").otherwise(" ").alias("position"),
        F.when(k % 7 != 0, F.year("o_orderdate") - k % 2).alias("year"), F.when(k % 3 == 0, F.round("o_totalprice")).otherwise(F.col("o_totalprice")).alias("total"),
    )
    out = T.report_payloads(rows, ("ticker", "date"), "name", "position", "year", "o_orderkey", ["total"])
    shape = "company struct<ticker:string,reports:array<struct<report_date:string,executives:map<string,map<string,struct<position:string,total:string>>>>>>"
    company = F.from_json("json", shape)["company"]
    people = out.select(company["ticker"].alias("ticker"), F.inline(company["reports"])).select("ticker", F.col("report_date").alias("date"), F.explode("executives").alias("name", "years"))
    years = people.select("ticker", "date", "name", F.explode("years").alias("year", "f"))
    total = F.col("f.total")
    form = F.when(total.rlike(r"^\d+$"), "whole").otherwise("part")
    return years.select("ticker", "date", "name", "year", form.alias("form"), total.cast("double").alias("total"), F.col("f.position").alias("position"))


@query("""WITH m AS (SELECT c_custkey AS id, 'T' || c_custkey // 2 AS ticker, c_name AS title, 'c' || c_custkey AS cik_str, NULL::BIGINT AS permno, CASE WHEN c_custkey % 3 = 0 THEN 'SEC' END AS source FROM customer),
  f AS (SELECT o_orderkey AS pos, 'T' || o_custkey AS ticker, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END AS title, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderkey END AS permno,
    CASE WHEN o_custkey % 2 = 0 THEN 'WRDS' END AS source FROM orders),
  n AS (SELECT ticker, min(pos) AS first_pos, count(*) AS n, arg_max(title, pos) AS title, arg_max(permno, pos) AS permno, max(source) AS source FROM f GROUP BY 1),
  h AS (SELECT ticker, min(id) AS id FROM m GROUP BY 1)
  SELECT m.id, m.ticker, coalesce(n.title, m.title) AS title, m.cik_str, coalesce(n.permno, m.permno) AS permno,
    CASE WHEN n.n IS NULL THEN m.source ELSE coalesce(n.source, coalesce(m.source, 'SEC') || ', wrds') END AS source
  FROM m LEFT JOIN h ON h.id = m.id LEFT JOIN n ON n.ticker = h.ticker
  UNION ALL SELECT (SELECT max(id) FROM m) + row_number() OVER (ORDER BY first_pos), ticker, title, NULL, permno, CASE WHEN n > 1 THEN coalesce(source, 'SEC, wrds') ELSE source END
  FROM n WHERE ticker NOT IN (SELECT ticker FROM m)""")
def merge_into_master(spark, d):
    k = F.col("c_custkey")
    master = t(spark, d, "customer").select(
        k.alias("id"), F.concat(F.lit("T"), F.floor(k / 2)).alias("ticker"), F.col("c_name").alias("title"), F.concat(F.lit("c"), k).alias("cik_str"),
        F.lit(None).cast("long").alias("permno"), F.when(k % 3 == 0, "SEC").alias("source"),
    )
    o = F.col("o_orderkey")
    found = t(spark, d, "orders").select(
        o.alias("pos"), F.concat(F.lit("T"), "o_custkey").alias("ticker"), F.when(o % 3 == 0, F.col("o_orderpriority")).alias("title"),
        F.lit(None).cast("string").alias("cik_str"), F.when(o % 4 != 0, o).alias("permno"), F.when(F.col("o_custkey") % 2 == 0, "WRDS").alias("source"),
    )
    return T.merge_into_master(master, found, "pos")


@query("""SELECT c_custkey, ['fi' || c_custkey, 'A1', 'e', 'x y'][c_custkey % 4 + 1] AS composed, ['  ' || c_custkey, ' ', 'e', 'x y'][c_custkey % 4 + 1] AS ascii,
  '<!doctype html>\n<html><head><meta charset="utf-8"></head><body>\n<table>' || c_custkey || '</table>\n</body></html>\n' AS page,
  CASE c_custkey % 5 WHEN 1 THEN 'NYSE' WHEN 2 THEN 'AMEX' WHEN 3 THEN 'NASDAQ' ELSE 'Other' END AS exchange,
  CASE WHEN c_custkey % 4 IN (0, 1) THEN 'Services' ELSE 'Other' END AS sector, CASE WHEN c_custkey % 4 = 0 THEN 'Services-Prepackaged Software' ELSE 'Other' END AS industry,
  CASE WHEN c_custkey % 4 IN (0, 2) THEN 'Domestic Common Stock' END AS category FROM customer""".replace("\n<", "' || chr(10) || '<").replace("</html>\n'", "</html>' || chr(10)").replace("['  '", "[' '"))
def unicode_and_codes(spark, d):
    k = F.col("c_custkey")
    raw = F.when(k % 4 == 0, F.concat(F.lit("ﬁ"), k)).when(k % 4 == 1, "Ａ１").when(k % 4 == 2, "e").otherwise("x y")
    sic = F.when(k % 4 == 0, 7372).when(k % 4 == 1, 73).when(k % 4 == 2, 1000).otherwise(9999)
    labels = [c.alias(n) for n, c in R.sic_labels(sic).items()]
    page = R.html_document(F.concat(F.lit("<table>"), k, F.lit("</table>")))
    return t(spark, d, "customer").select(
        "c_custkey", R.nfkc(raw).alias("composed"), R.ascii_only(raw).alias("ascii"), page.alias("page"), R.exchange_or_other(k % 5).alias("exchange"), *labels
    )


@query("SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS n, max(strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%SZ')) AS last FROM events GROUP BY 1, 2")
def event_windows(spark, d):
    events = t(spark, d, "events")
    last = events.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type").agg(R.utc_seconds(F.max("ts")).alias("last"))
    counted = windowed_counts(events, "ts", "event_type").select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "event_type", "n")
    return counted.join(last, ["day", "event_type"])


# Warehouse tables made of orders: a column's value is its name and the order.


def _wide(spark, d, columns, year):
    k = F.col("o_orderkey")
    made = [F.concat(F.lit(f"{c} "), k).alias(c) for c in columns if c not in ("ticker", "year", "tic", "fyear")]
    return t(spark, d, "orders").select(k.alias("k"), *made, F.concat(F.lit("T"), F.col("o_custkey") % 100).alias("ticker"), F.year("o_orderdate").alias(year), F.lit("extra").alias("other_column"))


def _tickers(spark, d):
    return t(spark, d, "customer").where("c_custkey % 4 <> 1 and c_custkey < 90").select(F.concat(F.lit("t"), "c_custkey").alias("x"))


def _wide_sql(columns):
    """The same columns joined, but for ticker and year, which are themselves."""
    parts = [c if c in ("ticker", "year") else f"'{c} ' || k" for c in columns]
    return f"""WITH o AS (SELECT o_orderkey AS k, 'T' || o_custkey % 100 AS ticker, year(o_orderdate) AS year FROM orders)
  SELECT md5({" || '|' || ".join(parts)}) AS digest, ticker, year::INT AS year FROM o
  WHERE year BETWEEN 1995 AND 1997 AND ticker IN (SELECT 'T' || c_custkey FROM customer WHERE c_custkey % 4 <> 1 AND c_custkey < 90)"""


def _digest(df, columns):
    return df.select(F.md5(F.concat_ws("|", *columns)).alias("digest"), "ticker", "year")


@query(_wide_sql(W.ANNUAL_COMPENSATION))
def annual_compensation(spark, d):
    return _digest(W.annual_compensation(_wide(spark, d, W.ANNUAL_COMPENSATION, "year"), _tickers(spark, d), 1995, 1997), W.ANNUAL_COMPENSATION)


@query(_wide_sql(W.DIRECTOR_COMPENSATION))
def director_compensation(spark, d):
    return _digest(W.director_compensation(_wide(spark, d, W.DIRECTOR_COMPENSATION, "year"), _tickers(spark, d), 1995, 1997), W.DIRECTOR_COMPENSATION)


@query("""SELECT o_orderkey, 'T' || o_custkey % 100 AS tic, year(o_orderdate)::INT AS fyear, CASE WHEN o_orderkey % 2 = 0 THEN 'INDL' ELSE 'FS' END AS indfmt FROM orders
  WHERE o_orderkey % 2 = 0 AND o_orderkey % 3 > 0 AND o_orderkey % 5 > 0 AND o_orderkey % 7 > 0 AND year(o_orderdate) BETWEEN 1992 AND 1996""")
def annual_fundamentals(spark, d):
    k = F.col("o_orderkey")
    funda = t(spark, d, "orders").select(
        k, F.concat(F.lit("T"), F.col("o_custkey") % 100).alias("tic"), F.year("o_orderdate").alias("fyear"), F.when(k % 2 == 0, "INDL").otherwise("FS").alias("indfmt"),
        F.when(k % 3 > 0, "STD").alias("datafmt"), F.when(k % 5 > 0, "D").otherwise("I").alias("popsrc"), F.when(k % 7 > 0, "C").otherwise("N").alias("consol"),
    )
    return W.annual_fundamentals(funda, None, last=1996).select("o_orderkey", "tic", "fyear", "indfmt")


@query("""WITH o AS (SELECT 'T' || o_custkey % 100 AS ticker, year(o_orderdate) AS y FROM orders), w AS (SELECT DISTINCT CASE WHEN c_custkey % 5 = 0 THEN '' ELSE 'T' || c_custkey END AS ticker FROM customer),
  a AS (SELECT ticker, count(*) AS n FROM o WHERE y = 1995 GROUP BY 1), b AS (SELECT ticker, count(*) AS n FROM o WHERE y BETWEEN 1996 AND 1997 AND ticker < 'T5' GROUP BY 1)
  SELECT w.ticker, coalesce(a.n, 0) AS n_annual, coalesce(b.n, 0) AS n_director,
    CASE WHEN w.ticker = '' THEN 'invalid' WHEN a.n > 0 AND b.n > 0 THEN 'downloaded' WHEN a.n > 0 OR b.n > 0 THEN 'partial' ELSE 'no_data' END AS status FROM w LEFT JOIN a USING (ticker) LEFT JOIN b USING (ticker)""")
def batch_outcomes(spark, d):
    listed = t(spark, d, "customer").select(F.when(F.col("c_custkey") % 5 > 0, F.concat(F.lit(" t"), "c_custkey", F.lit(" "))).alias("x"))
    annual = W.annual_compensation(_wide(spark, d, W.ANNUAL_COMPENSATION, "year"), listed.select(F.trim("x").alias("x")), 1995, 1995)
    director = W.director_compensation(_wide(spark, d, W.DIRECTOR_COMPENSATION, "year").where("ticker < 'T5'"), listed.select(F.trim("x").alias("x")), 1996, 1997)
    return W.batch_outcomes(listed, {"annual": annual, "director": director})


@query("""SELECT m.mode, c_custkey::VARCHAR AS doc, (c_custkey % 3 = 0)::INT AS table_idx, (CASE WHEN c_custkey % 5 = 0 THEN 25 ELSE 20 END)::BIGINT AS n_cells
  FROM customer, (VALUES ('xpath'), ('score'), ('both')) m(mode)""")
def extractor_modes(spark, d):
    cells = cut(_filings(spark, d))
    parts = [C.extracted_tables(cells, mode).select(F.lit(mode).alias("mode"), "doc", "table_idx") for mode in ("xpath", "score", "both")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("mode", "doc", "table_idx").agg(F.count("*").alias("n_cells"))
