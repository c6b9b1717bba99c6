"""Queries on nodes of pages, ownership tables, header runs, sections of texts and nested records.

Texts and cells that both engines need are SQL expressions, which both evaluate.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.htmlkit import parse_tables
from ..functions.nodes import HEADINGS, parse_nodes
from ..operators import ascii_tables as A
from ..operators import cells as C
from ..operators import extract_index as X
from ..operators import header_runs as H
from ..operators import members as M
from ..operators import narrative as N
from ..operators import ownership as O
from ..operators import pages as P
from ..operators import sections as S
from ..session import spread
from .catalog import _table, query, t


@query(r"""SELECT page_id, len(regexp_extract_all(html, '<a[ >]'))::BIGINT AS n_links, len(regexp_extract_all(html, '<h[1-6][ >]'))::BIGINT AS n_headings,
  len(regexp_extract_all(html, '<(?:tr|td|th|table)[ >]'))::BIGINT AS n_table_nodes FROM pages WHERE regexp_matches(html, '<[a-zA-Z]')""")
def page_nodes(spark, d):
    n = parse_nodes(t(spark, d, "pages"), "page_id", once=False)
    count = lambda *tags: F.count_if(F.col("tag").isin(*tags))
    return n.groupBy("page_id").agg(count("a").alias("n_links"), count(*HEADINGS).alias("n_headings"), count("tr", "td", "th", "table").alias("n_table_nodes"))


# The target of a page's links is before, around or inside a table, or there is none.
_ANCHORED = """'<p><a href="#t' || k % 7 || '">A <b>Summary</b> Compensation Table of ' || c_name || '</a> <a href="#gone">SUMMARY COMPENSATION TABLE</a> <a href="#t' || k % 7 || '">Other</a></p>'
  || repeat('<table><tr><td>x</table>', CAST(k % 3 AS INT))
  || CASE k % 4 WHEN 0 THEN '<p id="t' || k % 7 || '">Here<p name="t' || k % 7 || '">again' WHEN 1 THEN '<div name="t' || k % 7 || '"><table><tr><td>in</td></tr></table></div>'
     WHEN 2 THEN '<table><tr><td><b id=t' || k % 7 || '>in</b></td></tr></table>' ELSE '<p id="T">none</p>' END
  || CASE WHEN k % 5 < 3 THEN '<h4>After</h4><table><tr><td>y</td></tr></table>' ELSE '' END"""


@query("""WITH c AS (SELECT c_custkey AS k, c_name FROM customer),
  p AS (SELECT k, c_name, k % 4 < 3 AS found, CASE WHEN k % 4 < 3 AND k % 5 < 3 THEN (k % 3 + CASE WHEN k % 4 = 0 THEN 0 ELSE 1 END)::INT END AS table_idx FROM c)
  SELECT k, '#t' || k % 7 AS href, 'A Summary Compensation Table of ' || c_name AS text, found, table_idx FROM p
  UNION ALL SELECT k, '#gone', 'SUMMARY COMPENSATION TABLE', false, NULL FROM c""")
def anchored_tables(spark, d):
    pages = t(spark, d, "customer").select(F.col("c_custkey").alias("k"), "c_name").select("k", F.expr(_ANCHORED).alias("html"))
    out = P.tables_after_anchors(parse_nodes(pages, "k"), "k")
    return out.select("k", "href", "text", F.col("target").isNotNull().alias("found"), "table_idx")


_TITLED = """CASE WHEN k % 5 = 0 THEN '' ELSE '<h2>The <i>' || p_name || '</i> report</h2>' END
  || '<table>' || CASE WHEN k % 3 = 0 THEN '<caption> Of ' || p_brand || ' </caption>' ELSE '' END || '<tr><td>a<table><tr><td>b</table></table>'
  || CASE k % 4 WHEN 0 THEN '<h3> </h3>' WHEN 1 THEN '<h6>' || p_type || '</h6>' ELSE '' END || '<div><table><caption></caption><tr><td>c</table></div><table><tr><td>d</table>'"""


@query("""WITH c AS (SELECT p_partkey AS k, * FROM part), h AS (SELECT *, CASE WHEN k % 5 > 0 THEN 'The' || p_name || 'report' END AS head FROM c)
  SELECT k, i AS table_idx, coalesce(CASE i WHEN 0 THEN CASE WHEN k % 3 = 0 THEN 'Of ' || p_brand ELSE head END WHEN 1 THEN head
    WHEN 3 THEN CASE k % 4 WHEN 0 THEN NULL WHEN 1 THEN p_type ELSE head END END, 'Table_' || (i + 1)) AS title
  FROM h, (VALUES (0), (1), (2), (3)) v(i)""")
def titled_tables(spark, d):
    pages = t(spark, d, "part").withColumn("k", F.col("p_partkey")).select("k", F.expr(_TITLED).alias("html"))
    return P.titled_tables(parse_nodes(pages, "k"), "k").select("k", "table_idx", "title")


_INDEX = """CASE WHEN k % 6 = 0 THEN '<p>Nothing <a>here</a></p>' ELSE '<a href="/cgi/browse.html?q=1">top</a><a href="/home.HTM">home</a>' END
  || '<table class="x tableFile"><tr><th>Type</th><td>DEF 14A</td><td><a href="head.htm">h</a></td></tr>'
  || '<tr><td>1</td><td>8-K</td><td><a href="k' || k || '.htm">k</a></td></tr>'
  || CASE WHEN k % 3 = 0 THEN '' ELSE '<tr><td>2</td><td>def <b>14</b>a</td><td><a href="/Archives/d&amp;' || k || '.HTML">d</a><a href="e.htm">e</a></td></tr>' END
  || CASE WHEN k % 2 = 0 THEN '<tr><td>3</td><td>DEF 14A</td><td><a href="late.htm">l</a></td></tr>' ELSE '' END || '</table>'
  || CASE WHEN k % 4 = 0 THEN '' ELSE '<a href="../' || k || '/all.txt">t</a><a href="no.txt">n</a>' END"""


@query("""WITH c AS (SELECT c_custkey AS k, 'https://host.example/edgar/data/' AS base FROM customer)
  SELECT k, CASE WHEN k % 3 > 0 THEN 'https://host.example/Archives/d&' || k || '.HTML' WHEN k % 2 = 0 THEN base || k || '/late.htm'
    WHEN k % 6 = 0 THEN base || k || '/head.htm' ELSE 'https://host.example/home.HTM' END AS html_url,
  CASE WHEN k % 4 > 0 THEN base || k || '/all.txt' END AS txt_url FROM c""")
def index_documents(spark, d):
    k = F.col("c_custkey")
    pages = t(spark, d, "customer").select(k.alias("k"), F.concat(F.lit("https://host.example/edgar/data/"), k, F.lit("/index.htm")).alias("url"))
    pages = pages.withColumn("html", F.expr(_INDEX))
    return P.index_documents(parse_nodes(pages, "k"), pages, "k", "url", "DEF 14A")


# Rows of two tables of each supplier: holders, and with more officers for some.
_HOLDERS = [
    ["'Name and  Address of Beneficial Owner'", "'Shares&nbsp;Owned'", "'Percent of Class'"],
    ["s_name || ', ' || k || ' Main St'", "k % 900 + 1 || ',' || lpad(CAST(k * 7 % 1000 AS STRING), 3, '0')", "k % 90 || '.5 %'"],
    ["s_name || ' Trust'", "100000 + k", "CASE WHEN k % 3 = 0 THEN '*' ELSE '1.25' END", "CASE WHEN k % 3 = 1 THEN '%' ELSE '' END"],
    ["CASE WHEN k % 2 = 0 THEN 'All directors as a group' ELSE '' END", "k", "''"],
]
_OFFICERS = [
    ["'Stock Ownership of Directors'", "'Number'", "'Note'"],
    ["s_name", "k * 1000", "CASE WHEN k % 4 = 0 THEN '*' ELSE 'see below' END"],
    ["'Named executive officers'", "''", "CASE WHEN k % 5 = 0 THEN 'outstanding equity awards vesting' ELSE 'total' END"],
]


def _html(rows: list[list[str]]) -> str:
    """An expression for a table's HTML."""
    return " || ".join(["'<table>'", *["'<tr>' || " + " || ".join(f"'<td><b>' || ({c}) || '</b></td>'" for c in r) + " || '</tr>'" for r in rows], "'</table>'"])


def _lists(rows: list[list[str]]) -> str:
    return "[" + ", ".join("[" + ", ".join(f"({c})::VARCHAR" for c in r) + "]" for r in rows) + "]"


def _words(column: str, words: list[str]) -> str:
    return "(" + " + ".join(f"contains({column}, '{w}')::INT" for w in words) + ")"


_SCORED = f"""WITH s AS (SELECT s_suppkey AS k, s_name FROM supplier),
  r AS (SELECT k, 0 AS table_idx, unnest({_lists(_HOLDERS)}) AS c FROM s UNION ALL SELECT k, 1, unnest({_lists(_OFFICERS)}) FROM s),
  n AS (SELECT k, table_idx, list_filter(list_transform(c, lambda x: trim(lower(regexp_replace(replace(x, '&nbsp;', ' '), '\\s+', ' ', 'g')))), lambda x: x <> '') AS c FROM r),
  f AS (SELECT *, array_to_string(c, ' ') AS line, array_to_string(c[2:], ' ') AS rest FROM n),
  w AS (SELECT k, table_idx, count(*)::INT AS row_count, string_agg(line, ' ') AS text,
    coalesce(list_sort(list(len(c)) FILTER (len(c) > 0))[(count(*) FILTER (len(c) > 0)) // 2 + 1], 0)::INT AS col_count_med,
    (count(*) FILTER (list_bool_or(list_transform(c, lambda x: regexp_matches(x, '\\b\\d{{0,3}}(?:\\.\\d+)?\\s*%'))) OR list_contains(c[2:], '*')
      OR list_bool_or(list_transform(range(1, len(c)), lambda i: regexp_matches(c[i], '^\\d{{0,3}}(?:\\.\\d+)?$') AND c[i + 1] = '%'))))::INT AS pct_rows,
    (count(*) FILTER (list_bool_or(list_transform(c, lambda x: regexp_matches(x, '\\b\\d{{1,3}}(?:,\\d{{3}})+\\b|\\b\\d{{6,}}\\b')))))::INT AS share_rows,
    (count(*) FILTER (list_contains(c[2:], '*')))::INT AS star_rows, (count(*) FILTER ({_words('line', O.TOTAL_WORDS)} > 0))::INT AS total_rows,
    (count(*) FILTER (contains(c[1], ',') OR contains(c[1], 'address')))::INT AS addr_like_rows,
    coalesce(avg(length(c[1])), 0)::DOUBLE AS first_col_avg_len, coalesce(avg(length(rest)) FILTER (len(c) > 1), 0)::DOUBLE AS other_cols_avg_len
    FROM f GROUP BY k, table_idx),
  h AS (SELECT *, {_words('text', O.OWNERSHIP_WORDS)} AS ownership_hits, {_words('text', O.MANAGEMENT_WORDS)} AS management_hits, {_words('text', O.NEGATIVE_WORDS)} AS negative_hits FROM w),
  x AS (SELECT k, table_idx, {', '.join(O.FEATURES)}, CASE WHEN col_count_med < 3 THEN -10.0::DOUBLE ELSE 12.0::DOUBLE * least(pct_rows / row_count, 0.4::DOUBLE) + 10.0::DOUBLE * least(share_rows / row_count, 0.4::DOUBLE)
      + CASE WHEN first_col_avg_len > 0 THEN 6.0::DOUBLE * least(greatest((first_col_avg_len + 1) / (other_cols_avg_len + 1) - 1, 0), 3) ELSE 0 END
      + 2 * least(addr_like_rows, 6) + 2 * least(ownership_hits, 8) + 4 * least(total_rows, 2) + 1.5::DOUBLE * least(star_rows, 4) - 8 * least(negative_hits, 2) END AS score,
    CASE {' '.join(f"WHEN contains(text, '{p}') THEN '{kind}'" for p, kind in O.KIND_PHRASES)} WHEN management_hits >= 2 AND management_hits >= ownership_hits THEN 'management' ELSE 'beneficial_owner' END AS kind FROM h)"""


def _scored(spark, d):
    pages = t(spark, d, "supplier").withColumn("k", F.col("s_suppkey")).select("k", F.expr(_html(_HOLDERS) + " || '<p>and</p>' || " + _html(_OFFICERS)).alias("html"))
    return O.scored_ownership(parse_nodes(pages, "k"), "k")


def _rounded(df):
    return df.withColumns({c: F.round(c, 6) for c in ("first_col_avg_len", "other_cols_avg_len", "score") if c in df.columns})


@query(_SCORED + """ SELECT * REPLACE (round(first_col_avg_len, 6) AS first_col_avg_len, round(other_cols_avg_len, 6) AS other_cols_avg_len, round(score, 6) AS score) FROM x""")
def ownership_scores(spark, d):
    return _rounded(_scored(spark, d))


@query(_SCORED + """, o AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, kind, table_idx) AS r FROM x WHERE score > 0),
  b AS (SELECT k, coalesce(min(r) FILTER (kind = 'beneficial_owner'), min(r) FILTER (r = 1)) AS bo, coalesce(min(r) FILTER (kind = 'management'), min(r) FILTER (r = 2)) AS mg FROM o WHERE r <= 6 GROUP BY k)
  SELECT b.k, v.kind, o.table_idx, round(o.score, 6) AS score FROM b, (VALUES ('beneficial_owner'), ('management')) v(kind), o WHERE o.k = b.k AND o.r = CASE v.kind WHEN 'management' THEN mg ELSE bo END""")
def ownership_pair(spark, d):
    return _rounded(O.ownership_pair(_scored(spark, d), "k"))


# Rows of a customer's table: digits alone, two or three rows of header, data.
_HEADS = [
    ["CASE WHEN k % 2 = 0 THEN '1' ELSE '' END", "CASE WHEN k % 2 = 0 THEN '2' ELSE '' END", "''"],
    ["CASE WHEN k % 3 = 0 THEN 'Report' ELSE 'Name and' END", "'All'", "c_mktsegment"],
    ["'Principal (a) Position'", "'other'", "'Total ($)'"],
    ["c_name", "k", "CASE WHEN k % 5 = 0 THEN 'bonus' ELSE '7' END"],
]


def _grid(spark, d):
    cells = [F.struct(F.lit(r).alias("row_idx"), F.lit(c).alias("col_idx"), F.expr(f"CAST({x} AS STRING)").alias("text")) for r, row in enumerate(_HEADS) for c, x in enumerate(row)]
    return t(spark, d, "customer").withColumn("k", F.col("c_custkey")).select(F.col("k").alias("doc"), F.lit(0).alias("table_idx"), F.inline(F.array(*cells)))


_GRID = f"""WITH g AS (SELECT c_custkey AS k, {_lists(_HEADS)} AS rows FROM customer),
  d AS (SELECT k, CASE WHEN k % 2 = 0 THEN rows[2:] ELSE rows END AS rows FROM g),
  h AS (SELECT k, n, rows, list_transform(range(1, 4), lambda c: array_to_string(list_transform(range(1, n + 1), lambda r: rows[r][c]), ' ')) AS heads FROM d, (VALUES (1), (2), (3)) v(n)),
  s AS (SELECT *, len(list_filter(heads, lambda x: {_words('lower(x)', H.RUN_WORDS)} > 0)) AS score FROM h),
  b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY k ORDER BY score DESC, n) = 1)"""


@query(_GRID + r""" SELECT k AS doc, (r - 1 + CASE WHEN k % 2 = 0 THEN 1 ELSE 0 END)::INT AS row_idx, trim(regexp_replace(regexp_replace(heads[c], '\([^)]*\)', '', 'g'), '\s+', ' ', 'g')) AS name, rows[r][c] AS text
  FROM b, (VALUES (1), (2), (3)) v(c), (VALUES (2), (3), (4)) w(r) WHERE r > n AND r <= len(rows)""")
def header_run(spark, d):
    return H.with_header_run(H.without_number_rows(_grid(spark, d), 3), 3).select("doc", "row_idx", "name", "text")


@query(f"""WITH g AS (SELECT c_custkey AS k, unnest({_lists(_HEADS)}) AS c, unnest(range(4)) AS i FROM customer),
  n AS (SELECT *, {_words("lower(array_to_string(c, ' '))", H.ROW_WORDS)} AS score, len(list_filter(c, lambda x: {_words('lower(x)', H.RUN_WORDS)} > 0)) AS hits FROM g),
  b AS (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY k ORDER BY score DESC, i) = 1),
  v AS (SELECT k, i, sum(hits) OVER (PARTITION BY k ORDER BY i) AS so_far FROM n WHERE i < 3),
  u AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY k ORDER BY so_far DESC, i) = 1)
  SELECT b.k AS doc, b.i::INT AS row_idx, b.score::INT AS score, (u.i + 1)::INT AS header_rows, (u.so_far * 10)::BIGINT AS header_score FROM b JOIN u USING (k)""")
def header_rows(spark, d):
    cells = _grid(spark, d)
    scored = H.scored_header_rows(cells, 3).select("doc", F.col("k").alias("header_rows"), F.col("score").alias("header_score"))
    return H.best_header_row(cells).join(scored, "doc").select("doc", "row_idx", F.col("score").cast("int").alias("score"), "header_rows", "header_score")


_PROXY = """'Item 1   10   2.00%' || chr(10) || CASE WHEN k % 4 = 0 THEN 'Nothing' ELSE 'Security Ownership of holders' END || chr(10) || '  ' || o_orderpriority || '   ' || k || ',000   ' || k % 90 || '.' || k % 10 || '% of all'
  || chr(13) || chr(10) || 'Holder of , 1.5' || chr(10) || CASE WHEN k % 3 = 0 THEN 'Report of the audit committee 5 1.0' ELSE 'B. Owner ' || k || ' 9.75' END || chr(10) || chr(10) || 'C. Owner 1,2 0.50 beneficial ownership 7 1.1' || CASE WHEN k % 2 = 0 THEN chr(10) ELSE '' END"""


@query(rf"""WITH o AS (SELECT o_orderkey AS k, unnest(regexp_split_to_array({_PROXY.replace('k %', 'o_orderkey %').replace('|| k ', '|| o_orderkey ')}, '\r\n|\n')) AS line,
    unnest(range(20)) AS i, o_orderkey FROM orders),
  l AS (SELECT * FROM o WHERE line IS NOT NULL),
  b AS (SELECT *, bool_or(regexp_matches(line, '(?i)security ownership|beneficial ownership')) OVER w AS began FROM l WINDOW w AS (PARTITION BY k ORDER BY i)),
  e AS (SELECT *, coalesce(bool_or(began AND regexp_matches(line, '(?i)executive compensation|director compensation|audit committee')) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS ended FROM b),
  r AS (SELECT k, i, regexp_extract(trim(line), '^(.*?)\s+([\d,]+)\s+(\d{{1,2}}\.\d{{1,2}}%?)', ['a', 'b', 'c']) AS x FROM e WHERE began AND NOT ended)
  SELECT k, i::INT AS i, x.a AS name, replace(x.b, ',', '')::BIGINT AS shares, replace(x.c, '%', '')::DOUBLE AS percent FROM r WHERE replace(x.b, ',', '') <> ''""")
def ownership_lines(spark, d):
    texts = t(spark, d, "orders").withColumn("k", F.col("o_orderkey")).select("k", F.expr(_PROXY).alias("text"))
    return S.ownership_lines(texts, "k", "text")


_RESPONSE = """'{"data":[{"id":"f' || k || '","cik":"' || k || '"' || CASE WHEN k % 2 = 0 THEN ',"ticker":"T' || k % 9 || '"' ELSE '' END || ',"entityName":"' || c_name || '"'
  || CASE k % 3 WHEN 0 THEN '' WHEN 1 THEN ',"directors":[]' ELSE ',"directors":[{"name":"' || c_mktsegment || '","age":"' || k % 50 || '"},{"name":"B","isIndependent":"yes","extra":1}]' END
  || '},{"id":"g","directors":[{"position":"chair"}]}]}'"""


@query(f"""WITH c AS (SELECT c_custkey AS k, * FROM customer), f AS (SELECT k, unnest(json_extract({_RESPONSE}, '$.data[*]')) AS f FROM c),
  m AS (SELECT k, f, unnest(json_extract(f, '$.directors[*]')) AS m FROM f)
  SELECT k, f->>'id' AS id, f->>'accessionNo' AS "accessionNo", f->>'cik' AS cik, f->>'ticker' AS ticker, f->>'entityName' AS company_name, f->>'filedAt' AS filed_at, m->>'name' AS name,
    m->>'directorClass' AS "dirClass", m->>'dateFirstElected' AS "electedIn", m->>'position' AS position, m->>'age' AS age, m->>'isIndependent' AS is_independent,
    m->>'committeeMemberships' AS committee_memberships, m->>'qualificationsAndExperience' AS qualifications FROM m""")
def exploded_directors(spark, d):
    responses = t(spark, d, "customer").withColumn("k", F.col("c_custkey")).select("k", F.expr(_RESPONSE).alias("json"))
    data = M.filings_of_response(responses, "json", ["k"])
    return M.explode_members(data, "directors", {"k": "k", **M.FILING_FIELDS}, M.DIRECTOR_FIELDS)


@query("""WITH o AS (SELECT *, o_orderkey AS k, (2000 + o_orderkey % 4)::INT AS y, CASE o_orderkey % 3 WHEN 0 THEN 'A. Roe' ELSE 'B "Bo" Poe' END AS who FROM orders WHERE o_orderkey % 7 > 0),
  f AS (SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY o_custkey, who, y ORDER BY k) = 1),
  y AS (SELECT o_custkey, who, string_agg('{"year":' || y || ',"position":"' || o_orderpriority || '","salary":' || (k % 1000) || '.0,"salary_2":' || CASE WHEN k % 2 = 0 THEN '0.0' ELSE '1.5' END
    || ',"other_fields":{' || CASE WHEN k % 5 = 0 THEN '' ELSE '"note":"n' || k || '",' END || '"stock_awards":"' || CASE WHEN k % 4 = 0 THEN 'nan' ELSE '5' END || '"}}', ',' ORDER BY y) AS j FROM f GROUP BY 1, 2)
  SELECT o_custkey, '[' || string_agg('{"executive_name":' || to_json(who) || ',"compensation_data":[' || j || ']}', ',' ORDER BY who) || ']' AS executives FROM y GROUP BY 1""")
def year_records(spark, d):
    k = F.col("o_orderkey")
    year = F.when(k % 7 == 0, "n/a").when(k % 2 == 0, F.concat((k % 4 + 2000).cast("string"), F.lit(".0"))).otherwise(F.concat(F.lit("FY "), k % 4 + 2000))
    values = {
        "salary": (k % 1000).cast("string"), "position": F.col("o_orderpriority"), "salary_2": F.when(k % 2 == 0, "x").otherwise(" 1.5 "),
        "note": F.when(k % 5 == 0, " ").otherwise(F.concat(F.lit(" n"), k)), "stock_awards": F.when(k % 4 != 0, "5"),
    }
    rows = t(spark, d, "orders").select("o_custkey", k, F.when(k % 3 == 0, "A. Roe").otherwise('B "Bo" Poe').alias("who"), year.alias("year"), F.create_map(*[x for n, v in values.items() for x in (F.lit(n), v)]).alias("values"))
    return M.year_records(rows, "o_custkey", "who", "year", "values", "o_orderkey")


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, '[{"at":"' || strftime(o_orderdate + INTERVAL 1 SECOND * (o_orderkey % 90), '%Y-%m-%dT%H:%M:%S')
  || CASE WHEN o_orderkey % 3 = 0 THEN '.' || lpad((o_orderkey % 1000)::VARCHAR, 6, '0') ELSE '' END || '","n":' || o_orderkey || '}]' AS nested FROM orders WHERE o_orderkey % 1000 > 0""")
def iso_dates(spark, d):
    k = F.col("o_orderkey")
    micros = F.when(k % 3 == 0, k % 1000).otherwise(0)
    at = F.col("o_orderdate") + F.make_dt_interval(secs=(k % 90 + micros / 1000000).cast("decimal(18,6)"))
    rows = t(spark, d, "orders").where(k % 1000 > 0).select(k, F.col("o_orderdate").cast("date").alias("day"), F.array(F.struct(at.alias("at"), k.alias("n"))).alias("nested"))
    return M.iso_dates(rows).select("o_orderkey", "day", F.to_json("nested").alias("nested"))


# Filings of each order: a text that seldom has the table, and up to two pages; the second one's table is better.
_FILING = """CASE k % 5 WHEN 0 THEN 'Name and Principal Position   Year' || chr(10) || 'Ann   ' || k WHEN 1 THEN 'The president received a salary of $' || k || ' and $5.'
  WHEN 2 THEN 'Summary compensation table of ' || k WHEN 3 THEN 'Nothing on ' || o_orderpriority ELSE '' END"""
_PAGE = """CASE WHEN k % 3 = 0 THEN 'Summary COMPENSATION Table' || chr(10) ELSE '' END || repeat('x' || chr(10), CAST(k % 2 * 310 AS INT))
  || '<table>' || CASE n WHEN 0 THEN 'Position' ELSE 'Name, Principal Position' END || ' Salary ' || o_orderkey || '</ TABLE>' || chr(10) || '<table>Total</table>'"""


def _pages(spark, d):
    o = t(spark, d, "orders").withColumn("k", F.col("o_orderkey"))
    return o.where(o.k % 4 > 0).withColumn("n", F.explode(F.sequence(F.lit(0), (o.k % 4 - 1).cast("int") % 2))).withColumn("html", F.expr(_PAGE))


# Without an anchor the whole page is looked at; with one, lines below the 300th aren't.
_PAGE_SQL = """WITH o AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 4 > 0), p AS (SELECT *, unnest(range((k % 4 - 1) % 2 + 1)) AS n FROM o),
  c AS (SELECT k, n, CASE n WHEN 0 THEN 'pos' ELSE 'npp' END AS header, (CASE n WHEN 0 THEN 1 ELSE 3 END + 1 + 2)::INT AS score,
    '<table>' || CASE n WHEN 0 THEN 'Position' ELSE 'Name, Principal Position' END || ' Salary ' || k || '</ TABLE>' AS snippet FROM p WHERE NOT (k % 3 = 0 AND k % 2 = 1)),
  f AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY k ORDER BY score DESC, n) = 1)"""


@query(_PAGE_SQL + " SELECT k, header, score, snippet FROM f")
def page_tables(spark, d):
    return N.page_tables(_pages(spark, d), "k", "html", "n").select("k", "header", "score", "snippet")


@query(_PAGE_SQL + """ SELECT o_orderkey AS k, CASE o_orderkey % 5 WHEN 4 THEN 'error' WHEN 0 THEN 'ascii_npp' ELSE coalesce(CASE WHEN f.k IS NOT NULL THEN 'html_fallback' END,
    CASE o_orderkey % 5 WHEN 1 THEN 'narrative' WHEN 2 THEN 'anchor_but_missing' ELSE 'no_anchor' END) END AS class FROM orders LEFT JOIN f ON f.k = o_orderkey""")
def class_cascade(spark, d):
    texts = t(spark, d, "orders").withColumn("k", F.col("o_orderkey")).select("k", F.expr(_FILING).alias("text"))
    return N.file_classes(texts, "k", "text", _pages(spark, d), "html", "n")


# A supplier's page: a table of holders, after one of meetings for every second.
@query("""WITH s AS (SELECT s_suppkey AS k, s_name, CASE WHEN s_suppkey % 2 = 0 THEN 1 ELSE 0 END AS i FROM supplier)
  SELECT k::VARCHAR AS doc, i::INT AS table_idx, s_name AS name, k || ' Main St, Erie' AS address, (k + 1) || ',000' AS shares, (k % 90) || '.5%' AS percent FROM s
  UNION ALL SELECT k::VARCHAR, i::INT, 'All directors as a group', NULL, (k + 2) || ',000', '3.0%' FROM s""")
def bot_scored(spark, d):
    k = F.col("s_suppkey")
    holders = _table(
        ["Name of Beneficial Owner", "Number of Shares", "Percent of Class"], [F.col("s_name"), F.concat(k + 1, F.lit(",000")), F.concat((k % 90).cast("string"), F.lit(".5%"))],
        [F.concat(k, F.lit(" Main St, Erie")), "", ""], ["All directors as a group", F.concat(k + 2, F.lit(",000")), "3.0%"],
    )
    html = F.concat(F.when(k % 2 == 0, _table(["Meeting", "Place", "Owner"], ["vesting", "exercise price", "rsu vest"])).otherwise(""), holders)
    pages = t(spark, d, "supplier").select(k.cast("string").alias("doc"), html.alias("html"))
    chosen = O.ownership_pair(O.scored_ownership(parse_nodes(pages), "doc"), "doc", k=1)
    return C.clean_bot(C.scored_tables(parse_tables(pages), chosen)).select("doc", "table_idx", "name", "address", "shares", "percent")


# Five columns of which three are salaries.
_MERGED = ["CASE k % 3 WHEN 0 THEN NULL WHEN 1 THEN '0.0' ELSE '12' END", "o_orderpriority", "CASE k % 4 WHEN 0 THEN '12.0' WHEN 1 THEN ' ' WHEN 2 THEN 'x' ELSE '7' END", "'5'", "CASE k % 5 WHEN 0 THEN '7' WHEN 1 THEN '' WHEN 2 THEN 'x' WHEN 3 THEN '12' END"]


def _missing(c):
    return f"({c} IS NULL OR trim({c}) = '' OR coalesce(TRY_CAST({c} AS DOUBLE) = 0, false))"


def _merge_sql(a, b):
    same = f"({a} = {b} OR coalesce(TRY_CAST({a} AS DOUBLE) = TRY_CAST({b} AS DOUBLE), false))"
    return f"CASE WHEN {_missing(a)} THEN {b} ELSE {a} END", f"CASE WHEN NOT {_missing(a)} AND NOT {_missing(b)} AND NOT {same} THEN {b} END"


@query(f"""WITH o AS (SELECT o_orderkey AS k, {', '.join(f'{x} AS c{i}' for i, x in enumerate(_MERGED)).replace('k %', 'o_orderkey %')} FROM orders),
  a AS (SELECT *, {_merge_sql('c0', 'c2')[0]} AS v1, {_merge_sql('c0', 'c2')[1]} AS o1 FROM o),
  b AS (SELECT *, {_merge_sql('v1', 'c4')[0]} AS v2, {_merge_sql('v1', 'c4')[1]} AS o2 FROM a)
  SELECT k, v2 AS salary, coalesce(o1, o2) AS salary_2, CASE WHEN o1 IS NOT NULL THEN o2 END AS salary_3, c1 AS bonus, c3 AS units_7 FROM b""")
def merged_fields(spark, d):
    names = ["salary", "bonus", "salary", "units_7", "salary"]
    cells = F.array(*[F.struct(F.lit(i).alias("col_idx"), F.lit(n).alias("name"), F.expr(x).alias("text")) for i, (n, x) in enumerate(zip(names, _MERGED, strict=True))])
    dealt = spread(t(spark, d, "orders").withColumns({"k": F.col("o_orderkey"), "doc": F.col("o_custkey")}), "doc")
    rows = dealt.select("doc", F.lit(0).alias("table_idx"), F.col("k").alias("row_idx"), F.inline(cells))
    f = F.col("fields")
    return C.merged_fields(rows).select(F.col("row_idx").alias("k"), *[f[n].alias(n) for n in ("salary", "salary_2", "salary_3", "bonus", "units_7")])


@query("""WITH o AS (SELECT *, o_orderkey AS k, CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'A. Roe' ELSE 'B "Bo" Poe' END AS who FROM orders WHERE o_orderkey % 8 > 0),
  l AS (SELECT *, CASE who WHEN '' THEN 'unknown' ELSE who END AS executive FROM o QUALIFY row_number() OVER (PARTITION BY o_custkey, who, year(o_orderdate) ORDER BY k DESC) = 1),
  y AS (SELECT o_custkey, executive, string_agg('"' || year(o_orderdate) || '":{"bonus":' || CASE WHEN k % 2 = 0 THEN 'null' ELSE '"' || k || '"' END || ',"position":"' || o_orderpriority || '"}', ',' ORDER BY year(o_orderdate)) AS j FROM l GROUP BY 1, 2),
  e AS (SELECT o_custkey, string_agg(to_json(executive) || ':{' || j || '}', ',' ORDER BY executive) AS j FROM y GROUP BY 1)
  SELECT o_custkey AS doc, '{"company":{"ticker":"T' || o_custkey || '","report_year":"2001","summary_compensation_table":[{"report_date":"2001-02-03","executives":{' || j || '}}]}}' AS json FROM e""")
def sct_json(spark, d):
    k = F.col("o_orderkey")
    who = F.when(k % 3 == 0, " ").when(k % 3 == 1, "A. Roe").otherwise('B "Bo" Poe')
    fields = F.create_map(F.lit("position"), F.col("o_orderpriority"), F.lit("bonus"), F.when(k % 2 == 1, k.cast("string")))
    rows = t(spark, d, "orders").select(F.col("o_custkey").alias("doc"), F.lit(0).alias("table_idx"), k.alias("row_idx"), F.lit(0).alias("slot"), who.alias("executive"), F.when(k % 8 > 0, F.year("o_orderdate")).alias("year"), fields.alias("fields"))
    reports = t(spark, d, "customer").select(F.col("c_custkey").alias("doc"), F.concat(F.lit("t"), "c_custkey").alias("ticker"), F.lit("2001-02-03").alias("report_date"))
    return C.sct_json(rows, reports)


# Each order is a record on a filing of its customer, of one of four kinds.
_RECORDS = """WITH r AS (SELECT 'T' || o_custkey AS ticker, CASE o_orderkey % 2 WHEN 0 THEN 'DEF 14A' ELSE '10-K' END AS form, year(o_orderdate)::VARCHAR AS report_date, o_orderkey AS k,
    CASE o_orderkey % 4 WHEN 0 THEN 'csv' WHEN 1 THEN 'bo' WHEN 2 THEN 'txt' ELSE 'status' END AS kind FROM orders),
  e AS (SELECT ticker, form, report_date, max(k) AS "at", arg_max('s' || k % 5, k) AS status, arg_max('c' || k, k) FILTER (kind = 'csv') AS csv_relpath,
    arg_max({'v': CASE WHEN k % 3 > 0 THEN k END}, k) FILTER (kind = 'csv') AS csv_r, arg_max(CASE k % 5 WHEN 0 THEN '' ELSE 't' || k END, k) FILTER (kind = 'txt') AS txt_relpath,
    arg_max(k % 3 + 1, k) FILTER (kind = 'bo') AS n_bo, arg_max('p' || k, k) FILTER (kind = 'csv' AND k % 8 = 0) AS parquet_relpath FROM r GROUP BY 1, 2, 3)"""


def _records(spark, d):
    k = F.col("o_orderkey")
    kind = F.element_at(F.array(*map(F.lit, ("csv", "bo", "txt", "status"))), (k % 4 + 1).cast("int"))
    of = lambda name, c: F.when(kind == name, c)
    return t(spark, d, "orders").select(
        F.concat(F.lit("T"), "o_custkey").alias("ticker"), F.when(k % 2 == 0, "DEF 14A").otherwise("10-K").alias("form"), F.year("o_orderdate").cast("string").alias("report_date"), k.alias("at"), kind.alias("kind"),
        F.concat(F.lit("s"), k % 5).alias("status"), of("csv", F.concat(F.lit("c"), k)).alias("csv_relpath"), of("csv", F.when(k % 3 > 0, k)).alias("csv_rows"), of("txt", F.when(k % 5 == 0, "").otherwise(F.concat(F.lit("t"), k))).alias("txt_relpath"),
        of("bo", F.array_repeat(F.lit("b"), (k % 3 + 1).cast("int"))).alias("bo_html_relpaths"), of("csv", F.when(k % 8 == 0, F.concat(F.lit("p"), k))).alias("parquet_relpath"),
    )


@query(_RECORDS + """ SELECT ticker, form, report_date, "at", status, csv_relpath, csv_r.v AS csv_rows, txt_relpath, n_bo::INT AS n_bo, parquet_relpath FROM e""")
def extraction_entries(spark, d):
    rows, k = _records(spark, d), F.col("at")
    entries = X.fold_into(X.folded_entries(rows.where(k < 7000)), rows.where(k >= 7000))
    return entries.select("ticker", "form", "report_date", "at", "status", "csv_relpath", "csv_rows", "txt_relpath", F.size("bo_html_relpaths").alias("n_bo"), "parquet_relpath")


@query(_RECORDS + """ SELECT ticker, form, count(*) AS n_entries, count(csv_relpath) AS count_csv, count(nullif(txt_relpath, '')) AS count_txt, count(parquet_relpath) AS count_parquet, coalesce(sum(n_bo), 0)::BIGINT AS count_bo
  FROM e GROUP BY ROLLUP (ticker, form)""")
def extraction_counts(spark, d):
    return X.entry_counts(X.folded_entries(_records(spark, d)))


# A table in text of each order, with a rule, a short line and rows of more and fewer cells; some have a second header, some none.
_DRAWN = """CASE WHEN k % 4 = 0 THEN '  Report of ' || o_orderpriority || chr(10) ELSE '' END
  || CASE WHEN k % 5 = 0 THEN 'one' ELSE 'Name and   Principal Position' || '    Year  Pay' END || chr(10) || '----  ____' || chr(10) || chr(10)
  || CASE WHEN k % 3 = 0 THEN 'Name  Salary  Total  Salary' || chr(10) ELSE '' END || 'Ann Roe   CEO  2001  ' || k || '  more' || chr(10) || 'single' || chr(10) || '  ' || o_orderstatus || '    x' || chr(13) || chr(10)"""


@query(f"""WITH o AS (SELECT o_orderkey AS k, * FROM orders), t AS (SELECT k, unnest(string_split(replace({_DRAWN}, chr(13), ''), chr(10))) AS line, unnest(range(20)) AS i FROM o),
  l AS (SELECT k, i, trim(line) AS line, row_number() OVER (PARTITION BY k ORDER BY i) AS n FROM t WHERE trim(line) <> ''),
  h AS (SELECT k, coalesce(min(n) FILTER (contains(lower(line), 'position') AND contains(lower(line), 'year')), 1) AS h FROM l GROUP BY k),
  c AS (SELECT l.k, n, h, regexp_split_to_array(line, '\\s{{2,}}') AS c FROM l JOIN h USING (k)), m AS (SELECT k, c AS names FROM c WHERE n = h),
  r AS (SELECT k, row_number() OVER (PARTITION BY k ORDER BY n) AS r, names, list_transform(range(1, len(names) + 1), lambda i: coalesce(c[i], '')) AS c FROM c JOIN m USING (k) WHERE n > h AND len(names) > 1 AND len(c) > 1 AND NOT regexp_matches(array_to_string(c, ' '), '^[-\\s_]+$')),
  f AS (SELECT k, min(r) FILTER (len(list_filter(c, lambda x: {_words('lower(x)', ['name', 'position', 'year', 'salary', 'bonus', 'total', 'stock', 'option', 'compensation'])} > 0)) >= 2 AND r <= 6) AS f FROM r GROUP BY k),
  g AS (SELECT r.k, r.r, coalesce(x.c, r.names) AS names, r.c FROM r JOIN f USING (k) LEFT JOIN r x ON x.k = r.k AND x.r = f.f WHERE f.f IS NULL OR r.r > f.f)
  SELECT k AS doc, (r - 1)::INT AS row_idx, (i - 1)::INT AS col_idx, names[i] AS name, c[i] AS text FROM g, (VALUES (1), (2), (3), (4)) v(i) WHERE i <= len(names) AND list_position(names, names[i]) = i""")
def drawn_tables(spark, d):
    texts = t(spark, d, "orders").withColumn("k", F.col("o_orderkey")).select("k", F.expr(_DRAWN).alias("text"))
    return A.with_found_header(A.ascii_cells(texts, "k", "text")).select("doc", "row_idx", "col_idx", "name", "text")


# A page's first table has a cue in one piece or in two, and salary or none; the second has both, within a table.
_CUED = """'<table><tr><td>' || CASE k % 3 WHEN 0 THEN 'Name and position' WHEN 1 THEN 'Name <b>and</b> position' ELSE 'Named  Executive Officers' END || '<td>' || CASE k % 2 WHEN 0 THEN 'Base SALARY' ELSE 'Pay' END || '</table>'
  || CASE WHEN k % 5 > 0 THEN '<table><tr><td><table><tr><td>Principal Position of ' || c_name || '<td>salary</table></table>' ELSE '' END"""


@query("""SELECT c_custkey AS k, CASE WHEN c_custkey % 3 <> 1 AND c_custkey % 2 = 0 THEN 0 ELSE 2 END::INT AS table_idx FROM customer WHERE (c_custkey % 3 <> 1 AND c_custkey % 2 = 0) OR c_custkey % 5 > 0""")
def salary_tables(spark, d):
    pages = t(spark, d, "customer").withColumn("k", F.col("c_custkey")).select("k", F.expr(_CUED).alias("html"))
    return P.salary_tables(parse_nodes(pages, "k"), "k")
