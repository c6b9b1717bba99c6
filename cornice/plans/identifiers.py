"""Queries on identifiers, records and indexes that the other modules lack, and on older table scores."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import headers as H
from ..functions import text as T
from ..functions.htmlkit import parse_tables
from ..operators import enrich as E
from ..operators import scorers as SC
from ..operators import state as ST
from ..operators import verify as V
from ..session import cut
from ..sources.files import stored_path
from .catalog import query, t
from .pages import _html, _lists, _words


# Each order names its customer's stock for a while; some names have no end.
_NAMES = """WITH n AS (SELECT CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN '' WHEN o_orderkey % 2 = 0 THEN 'T' || o_custkey ELSE 't' || o_custkey END AS ticker, o_orderkey AS permno,
    CASE WHEN o_orderkey % 5 > 0 THEN o_orderdate::DATE END AS nameenddt FROM orders)"""


@query(_NAMES + """ SELECT upper(ticker) AS ticker, permno, nameenddt FROM n WHERE coalesce(ticker, '') <> ''
  QUALIFY row_number() OVER (PARTITION BY upper(ticker) ORDER BY coalesce(nameenddt, DATE '5999-12-31') DESC, permno) = 1""")
def latest_crsp_names(spark, d):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    ticker = F.when(k % 11 == 0, None).when(k % 13 == 0, "").when(k % 2 == 0, F.concat(F.lit("T"), c)).otherwise(F.concat(F.lit("t"), c))
    names = t(spark, d, "orders").select(ticker.alias("ticker"), k.alias("permno"), F.when(k % 5 > 0, F.col("o_orderdate").cast("date")).alias("nameenddt"))
    return E.crsp_names(names).select("ticker", "permno", "nameenddt")


@query("""WITH l AS (SELECT o_custkey AS lpermno, o_orderkey AS gvkey, ['LC', 'LU', 'LS', 'NR'][o_orderkey % 4 + 1] AS linktype, ['P', 'C', 'J'][o_orderkey % 3 + 1] AS linkprim, CASE WHEN o_orderkey % 5 > 0 THEN o_orderdate::DATE END AS linkenddt FROM orders)
  SELECT lpermno, gvkey, linkenddt FROM l WHERE linktype IN ('LC', 'LU', 'LS') AND linkprim IN ('P', 'C')
  QUALIFY row_number() OVER (PARTITION BY lpermno ORDER BY (linkenddt IS NULL) DESC, linkenddt DESC, gvkey) = 1""")
def primary_links(spark, d):
    k = F.col("o_orderkey")
    kind = F.element_at(F.array(*map(F.lit, ("LC", "LU", "LS", "NR"))), (k % 4 + 1).cast("int"))
    prim = F.element_at(F.array(*map(F.lit, ("P", "C", "J"))), (k % 3 + 1).cast("int"))
    table = t(spark, d, "orders").select(F.col("o_custkey").alias("lpermno"), k.alias("gvkey"), kind.alias("linktype"), prim.alias("linkprim"), F.when(k % 5 > 0, F.col("o_orderdate").cast("date")).alias("linkenddt"))
    return E.links(table).select("lpermno", "gvkey", "linkenddt")


@query("""SELECT o_custkey, o_orderpriority FROM (SELECT *, CASE WHEN o_orderkey % 50 > 0 THEN o_orderdate END AS d FROM orders)
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY d DESC NULLS FIRST, o_orderpriority) = 1""")
def latest_codes(spark, d):
    rows = t(spark, d, "orders").withColumn("at", F.when(F.col("o_orderkey") % 50 > 0, F.col("o_orderdate")))
    return E.latest_code(rows, "o_custkey", "at", "o_orderpriority")


# Companies' comp.company and comp.security rows meet by gvkey; a security may lack its company.
@query("""WITH s AS (SELECT o_custkey AS gvkey, 'q' || o_orderkey % 700 AS tic, o_orderkey % 3 AS iid FROM orders), c AS (SELECT c_custkey AS gvkey, c_name AS conm FROM customer WHERE c_custkey % 4 > 0)
  SELECT upper(tic) AS tic, gvkey, conm FROM s LEFT JOIN c USING (gvkey) QUALIFY row_number() OVER (PARTITION BY upper(tic) ORDER BY gvkey, iid) = 1""")
def securities_with_companies(spark, d):
    o = t(spark, d, "orders")
    security = o.select(F.col("o_custkey").alias("gvkey"), F.concat(F.lit("q"), F.col("o_orderkey") % 700).alias("tic"), (F.col("o_orderkey") % 3).alias("iid"))
    company = t(spark, d, "customer").where("c_custkey % 4 > 0").select(F.col("c_custkey").alias("gvkey"), F.col("c_name").alias("conm"))
    return E.first_securities(security, company)


@query("""WITH r AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 7 > 0 THEN 't' || c_custkey END AS ticker, c_custkey % 300 AS permno, CASE c_custkey % 5 WHEN 0 THEN '0000000009' WHEN 1 THEN '' END AS cik_str FROM customer),
  t AS (SELECT 'T' || c_custkey AS ticker, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_custkey::VARCHAR END AS cik FROM customer WHERE c_custkey % 2 = 0), p AS (SELECT n AS permno, (n * 1000)::VARCHAR AS cik FROM range(0, 150) x(n))
  SELECT id, coalesce(nullif(cik_str, ''), lpad(coalesce(nullif(t.cik, ''), p.cik), 10, '0'), cik_str) AS cik_str FROM r LEFT JOIN t ON t.ticker = upper(r.ticker) LEFT JOIN p ON p.permno = r.permno""")
def filled_ciks(spark, d):
    k = F.col("c_custkey")
    c = t(spark, d, "customer")
    records = c.select(k.alias("id"), F.when(k % 7 > 0, F.concat(F.lit("t"), k)).alias("ticker"), (k % 300).alias("permno"), F.when(k % 5 == 0, "0000000009").when(k % 5 == 1, "").alias("cik_str"))
    by_ticker = c.where(k % 2 == 0).select(F.concat(F.lit("T"), k).alias("ticker"), F.when(k % 3 == 0, "").otherwise(k.cast("string")).alias("cik"))
    by_permno = c.where(k < 150).select(k.alias("permno"), (k * 1000).cast("string").alias("cik"))
    return E.fill_cik(records, by_ticker, by_permno).select("id", "cik_str")


@query("""WITH o AS (SELECT o_custkey, year(o_orderdate)::INT AS y, o_orderkey AS k FROM orders), old AS (SELECT * FROM o WHERE k % 3 = 0), new AS (SELECT * FROM o WHERE k % 3 > 0)
  SELECT o_custkey, y, k FROM old UNION ALL (SELECT o_custkey, y, k FROM new WHERE NOT EXISTS (SELECT 1 FROM old WHERE old.o_custkey = new.o_custkey AND old.y = new.y)
  QUALIFY row_number() OVER (PARTITION BY o_custkey, y ORDER BY k) = 1)""")
def appended_reports(spark, d):
    o = t(spark, d, "orders").select("o_custkey", F.year("o_orderdate").alias("y"), F.col("o_orderkey").alias("k"))
    return ST.append_unseen(o.where("k % 3 = 0"), o.where("k % 3 > 0"), ["o_custkey", "y"], "k")


@query("""SELECT o_custkey, arg_max(o_orderpriority, o_orderkey) FILTER (o_orderkey % 4 > 0) AS priority, arg_max(o_orderstatus, o_orderkey) FILTER (o_orderkey % 3 > 0) AS status FROM orders GROUP BY 1""")
def last_known_fields(spark, d):
    k = F.col("o_orderkey")
    o = t(spark, d, "orders").select("o_custkey", k, F.when(k % 4 > 0, F.col("o_orderpriority")).alias("priority"), F.when(k % 3 > 0, F.col("o_orderstatus")).alias("status"))
    return ST.upsert_fields(o, ["o_custkey"], "o_orderkey", ["priority", "status"])


_YEARS = """CASE k % 6 WHEN 0 THEN CAST(1990 + k % 30 AS STRING) WHEN 1 THEN 'FY ' || CAST(1990 + k % 30 AS STRING) || ' and 2001' WHEN 2 THEN CAST(1990 + k % 30 AS STRING) || '.0' WHEN 3 THEN 'x' || CAST(1990 + k % 30 AS STRING) WHEN 4 THEN ' ' ELSE c_mktsegment END"""


@query(f"""WITH c AS (SELECT c_custkey AS k, * FROM customer), s AS (SELECT k, {_YEARS} AS s FROM c)
  SELECT k, coalesce(trunc(TRY_CAST(s AS DOUBLE))::INT, TRY_CAST(regexp_extract(s, '\\b((?:19|20)\\d{{2}})\\b', 1) AS INT)) AS year FROM s""")
def years_of_texts(spark, d):
    c = t(spark, d, "customer").withColumn("k", F.col("c_custkey")).select("k", F.expr(_YEARS).alias("s"))
    return c.select("k", T.year_of(F.col("s")).alias("year"))


_HEADS = """CASE k % 5 WHEN 0 THEN 'Options of ' || p_name WHEN 1 THEN 'Option ' || p_brand || ' Award' WHEN 2 THEN 'Incentive option' WHEN 3 THEN p_type || ' Total' ELSE p_name || ' (a)' END"""


@query(f"""WITH p AS (SELECT p_partkey AS k, * FROM part), h AS (SELECT k, lower({_HEADS}) AS h FROM p)
  SELECT k, CASE WHEN contains(h, 'option') AND contains(h, 'award') THEN 'option_awards' WHEN contains(h, 'option') THEN 'option' WHEN contains(h, 'incentive') THEN 'non_equity_incentive' WHEN contains(h, 'total') THEN 'total' ELSE trim(regexp_replace(h, '[^a-z0-9]+', '_', 'g'), '_') END AS notebook,
    CASE WHEN contains(h, 'option') THEN 'option_awards' WHEN contains(h, 'total') THEN 'total' ELSE trim(regexp_replace(regexp_replace(h, '\\([^)]*\\)', '', 'g'), '[^a-z0-9]+', '_', 'g'), '_') END AS footnote_free FROM h""")
def notebook_headers(spark, d):
    p = t(spark, d, "part").withColumn("k", F.col("p_partkey")).select("k", F.expr(_HEADS).alias("h"))
    return p.select("k", H.sct_header(F.col("h"), lone_option=True).alias("notebook"), H.footnote_free_header(F.col("h")).alias("footnote_free"))


@query("""SELECT * FROM (VALUES ('c_mktsegment', 'missing'), ('extra', 'extra'), ('c_custkey', 'types'), ('c_name', 'common'), ('c_nationkey', 'common'), ('c_acctbal', 'common'), ('c_custkey', 'common')) v("column", kind) WHERE (SELECT count(*) FROM customer) > 0""")
def column_differences(spark, d):
    a = t(spark, d, "customer")
    b = a.drop("c_mktsegment").withColumns({"extra": F.lit(1), "c_custkey": F.col("c_custkey").cast("string")})
    kinds = V.schema_diff(a, b) | {"common": [c for c in a.columns if c in b.columns]}
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(kind).alias("kind")) for kind, columns in kinds.items() for c in columns])
    return a.limit(1).select(F.inline(rows))


@query("""SELECT o_orderkey, 'T' || o_custkey || '/' || f || '/' || strftime(o_orderdate, '%Y-%m-%d') || '_' || f || '.html' AS path
  FROM (SELECT *, CASE o_orderkey % 3 WHEN 0 THEN 'DEF_14A' WHEN 1 THEN '10-K' ELSE 'A_B_C' END AS f FROM orders)""")
def stored_paths(spark, d):
    k = F.col("o_orderkey")
    form = F.when(k % 3 == 0, " DEF 14A").when(k % 3 == 1, "10-K").otherwise("A  B\tC ")
    o = t(spark, d, "orders").select(k, F.concat(F.lit("T"), "o_custkey").alias("ticker"), form.alias("form"), F.col("o_orderdate").cast("date").alias("date"))
    return o.select("o_orderkey", stored_path("ticker", "form", "date", "html").alias("path"))


@query("""SELECT c_custkey AS id, unnest(['c_acctbal', 'c_custkey', 'c_mktsegment', 'c_name', 'c_nationkey']) AS field, unnest([printf('%.2f', c_acctbal), c_custkey::VARCHAR, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE trim(c_mktsegment) END, c_name, c_nationkey::VARCHAR]) AS value, unnest(range(5))::INT AS pos FROM customer""")
def record_fields(spark, d):
    c = t(spark, d, "customer").withColumns({"c_acctbal": F.format_string("%.2f", "c_acctbal"), "c_mktsegment": F.when(F.col("c_custkey") % 3 > 0, F.concat(F.lit(" "), "c_mktsegment"))})
    return ST.record_fields(c.withColumn("id", F.col("c_custkey")), "id")


# A customer's table of two to four rows, in several spellings.
_PAY = [
    ["CASE WHEN k % 3 = 0 THEN 'Name and Principal Position' WHEN k % 3 = 1 THEN 'Name' ELSE 'Named executive' END", "'Salary ($)'", "CASE WHEN k % 2 = 0 THEN 'All Other Compensation' ELSE 'x' END"],
    ["c_name", "k", "CASE WHEN k % 5 = 0 THEN 'Grant date 2001' ELSE 'occupation' END"],
    ["'Total'", "CASE WHEN k % 4 = 0 THEN 'FY 1999' ELSE '12' END", "CASE WHEN k % 7 = 0 THEN 'Security Ownership: 5% owned, % of class' ELSE 'beneficial owner' END"],
]
_ONE_LINE = "array_to_string(list_transform(rows, lambda r: array_to_string(r, ' ')), ' ')"


@query(f"""WITH c AS (SELECT c_custkey AS k, lower({_ONE_LINE}) AS x, lower(array_to_string(rows[1], ' ')) AS h FROM (SELECT c_custkey, {_lists(_PAY).replace('k %', 'c_custkey %').replace('(k)', '(c_custkey)')} AS rows FROM customer)),
  m AS (SELECT *, contains(x, 'name') AS n, contains(x, 'principal') OR contains(x, 'named executive') AS p, contains(x, 'position') OR contains(x, 'occupation') AS o, CASE WHEN regexp_matches(x, '\\$|\\b\\d{{3,}}\\b') THEN 2 ELSE 0 END AS money FROM c)
  SELECT k::VARCHAR AS doc, (CASE WHEN n AND p AND o THEN 6 WHEN n AND (p OR o) THEN 4 WHEN n THEN 2 ELSE 0 END + least({_words('x', SC.COMP_WORDS)}, 8) + money - CASE WHEN contains(x, 'grant') THEN 3 ELSE 0 END)::INT AS first,
    (CASE WHEN n AND p AND o THEN 7 WHEN n AND (p OR o) THEN 5 WHEN n THEN 2 ELSE 0 END + least({_words('x', SC.COMP_WORDS)}, 7) + money + CASE WHEN regexp_matches(x, '\\b20\\d{{2}}\\b|\\b19\\d{{2}}\\b') THEN 1 ELSE 0 END + 1)::INT AS ranked,
    (CASE WHEN regexp_matches(x, 'name\\s*(and|&|/)\\s*principal\\s*(position|occupation)') THEN 6 WHEN n AND contains(x, 'principal') AND o THEN 5 WHEN n AND (contains(x, 'principal') OR o) THEN 3 WHEN n THEN 2 ELSE 0 END
      + least({_words('x', SC.FALLBACK_WORDS)}, 6) + money + CASE WHEN regexp_matches(x, '\\b20\\d{{2}}\\b') THEN 1 ELSE 0 END + 1)::INT AS fallback,
    (3 + CASE WHEN regexp_matches(x, '[0-9]{{3,}}') THEN 2 ELSE 0 END + contains(x, 'salary')::INT + contains(x, 'grant')::INT)::INT AS legacy,
    CASE WHEN k % 7 = 0 THEN 5 ELSE -1 END AS simple FROM m""")
def older_scores(spark, d):
    pages = t(spark, d, "customer").withColumn("k", F.col("c_custkey")).select(F.col("k").cast("string").alias("doc"), F.expr(_html(_PAY)).alias("html"))
    cells = cut(parse_tables(pages))
    parts = []
    for name, scored in {"first": SC.first_score(cells), "ranked": SC.ranked_score(cells), "fallback": SC.fallback_score(cells), "legacy": SC.legacy_score(cells, ["salary", "grant", "pension"])}.items():
        parts.append(scored.select("doc", F.lit(name).alias("name"), F.col("score").cast("int").alias("score")))
    line = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("row_idx", "col_idx", F.lower("text").alias("t")))), lambda x: x["t"]), " ")
    parts.append(cells.groupBy("doc").agg(SC.simple_ownership_score(line).alias("score")).select("doc", F.lit("simple").alias("name"), "score"))
    # A document has one table, so its scores meet in a group: joins would send whole sides to the driver.
    return reduce(DataFrame.unionByName, parts).groupBy("doc").agg(*[F.max(F.when(F.col("name") == n, F.col("score"))).alias(n) for n in ("first", "ranked", "fallback", "legacy", "simple")])


# Officers in one text: with initials, with full names, a title first, a title alone, or neither.
_OFFICER = """CASE k % 6 WHEN 0 THEN 'J. P. Roe, President and CEO' WHEN 1 THEN 'Ann Beth Poe Jr. Vice President of ' || c_mktsegment WHEN 2 THEN 'Roe, T' WHEN 3 THEN 'ceo' WHEN 4 THEN '1 treasurer 2' ELSE '#' || CAST(k AS STRING) END"""


@query("""SELECT c_custkey AS k, CASE c_custkey % 6 WHEN 0 THEN 'J. P. Roe' WHEN 1 THEN regexp_extract('Ann Beth Poe Jr. Vice President of ' || c_mktsegment, '(?i)((?:[A-Z]\\.?\\s*){1,2}\\s*[A-Z][a-z]+(?:\\s+(?:Jr\\.?|Sr\\.?|III|IV))?)') WHEN 2 THEN 'Roe' WHEN 3 THEN 'ceo' WHEN 4 THEN 'treasurer' ELSE '#' || c_custkey END AS name,
  CASE c_custkey % 6 WHEN 0 THEN ', President and CEO' WHEN 1 THEN trim(replace('Ann Beth Poe Jr. Vice President of ' || c_mktsegment, regexp_extract('Ann Beth Poe Jr. Vice President of ' || c_mktsegment, '(?i)((?:[A-Z]\\.?\\s*){1,2}\\s*[A-Z][a-z]+(?:\\s+(?:Jr\\.?|Sr\\.?|III|IV))?)'), ''))
    WHEN 2 THEN ', T' WHEN 4 THEN '1  2' ELSE '' END AS position FROM customer""")
def first_name_split(spark, d):
    c = t(spark, d, "customer").withColumn("k", F.col("c_custkey")).select("k", T.first_split(F.expr(_OFFICER)).alias("x"))
    return c.select("k", "x.name", "x.position")


@query("""WITH n AS (SELECT o_orderkey AS ord, o_orderkey % 400 AS permno, 'T' || o_custkey % 60 AS ticker, 'N' || o_orderkey AS name, CASE WHEN o_orderkey % 3 > 0 THEN 'c' || o_orderkey ELSE '' END AS cusip, o_orderkey % 5 AS exchcd FROM orders),
  s AS (SELECT 'T' || c_custkey % 45 AS ticker, lpad((c_custkey % 90)::VARCHAR, 6, '0') AS gvkey FROM customer GROUP BY ALL),
  c AS (SELECT lpad(n::VARCHAR, 6, '0') AS gvkey, CASE n % 3 WHEN 0 THEN 7372 WHEN 1 THEN 9999 ELSE 1000 + n END AS sic, CASE WHEN n % 4 > 0 THEN 'S' || n END AS state, CASE WHEN n % 5 > 0 THEN 'US' ELSE '' END AS country FROM range(0, 80) x(n)),
  e AS (SELECT 'T' || n AS ticker, n::VARCHAR AS cik_str, CASE n % 3 WHEN 0 THEN 'SEC' WHEN 1 THEN 'SEC, WRDS' END AS source FROM range(0, 30) x(n)),
  j AS (SELECT n.*, gvkey, sic, state, country, cik_str, coalesce(source, 'SEC') AS source, permno % 10 = 3 AND permno < 200 AS gone FROM n LEFT JOIN s USING (ticker) LEFT JOIN c USING (gvkey) LEFT JOIN e USING (ticker))
  SELECT 100 + row_number() OVER (ORDER BY ord, gvkey) AS id, cik_str, CASE WHEN gone THEN ticker || '-DELISTED' ELSE ticker END AS ticker, name AS title, permno, gvkey, nullif(cusip, '') AS cusip,
    CASE exchcd WHEN 1 THEN 'NYSE' WHEN 2 THEN 'AMEX' WHEN 3 THEN 'NASDAQ' ELSE 'Other' END AS exchange, gone AS "isDelisted", CASE WHEN sic >= 1000 AND sic < 9999 THEN 'Domestic Common Stock' END AS category,
    CASE WHEN sic::VARCHAR LIKE '73%' THEN 'Services' ELSE 'Other' END AS "sicSector", CASE WHEN sic = 7372 THEN 'Services-Prepackaged Software' ELSE 'Other' END AS "sicIndustry",
    CASE WHEN state <> '' AND country <> '' THEN state || '; ' || country END AS location, CASE WHEN contains(lower(source), 'wrds') THEN source ELSE source || ', wrds' END AS source FROM j""")
def ticker_metadata(spark, d):
    k, o, c = F.col("o_orderkey"), t(spark, d, "orders"), t(spark, d, "customer")
    names = o.select(k.alias("ord"), (k % 400).alias("permno"), F.concat(F.lit("T"), F.col("o_custkey") % 60).alias("ticker"), F.concat(F.lit("N"), k).alias("name"), F.when(k % 3 > 0, F.concat(F.lit("c"), k)).otherwise("").alias("cusip"), (k % 5).alias("exchcd"))
    code = lambda n: F.lpad(n.cast("string"), 6, "0")
    security = c.select(F.concat(F.lit("T"), F.col("c_custkey") % 45).alias("ticker"), code(F.col("c_custkey") % 90).alias("gvkey")).distinct()
    n = F.col("id")
    company = spark.range(80).select(code(n).alias("gvkey"), F.when(n % 3 == 0, 7372).when(n % 3 == 1, 9999).otherwise(1000 + n).alias("sic"), F.when(n % 4 > 0, F.concat(F.lit("S"), n)).alias("state"), F.when(n % 5 > 0, "US").otherwise("").alias("country"))
    existing = spark.range(30).select(F.concat(F.lit("T"), n).alias("ticker"), n.cast("string").alias("cik_str"), F.when(n % 3 == 0, "SEC").when(n % 3 == 1, "SEC, WRDS").alias("source"))
    delisted = o.where((k % 10 == 3) & (k < 200)).select(k.alias("permno"))
    return E.ticker_metadata(names, security, company, delisted, "ord", existing, 101)


_READ = "'id ' || CAST(c_custkey AS STRING) || CASE c_custkey % 5 WHEN 0 THEN ' caf\u00c3\u00a9' WHEN 1 THEN ' the firm\u00e2\u20ac\u2122s' WHEN 2 THEN ' caf\u00e9' WHEN 3 THEN ' \u4e2d \u00c3\u00a9' ELSE '' END"


@query(f"SELECT c_custkey, replace(replace({_READ}, CASE WHEN c_custkey % 5 = 3 THEN '@' ELSE '\u00c3\u00a9' END, '\u00e9'), '\u00e2\u20ac\u2122', '\u2019') AS text FROM customer")
def repaired_texts(spark, d):
    return t(spark, d, "customer").select("c_custkey", T.repaired(F.expr(_READ)).alias("text"))
