"""The engine's operators as queries over the driver tables, each with its DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import headers as H
from ..functions import records as R
from ..functions import text as T
from ..functions.htmlkit import parse_tables
from ..operators import cells as C
from ..operators import enrich as E
from ..operators import jsonquery as J
from ..operators import narrative as N
from ..operators import sequence as S
from ..operators import state as ST
from ..operators import tables as TB
from ..operators import verify as V
from ..session import share_path
from ..sources.files import with_sidecar

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return share_path(spark).read.parquet(f"{d}/{name}.parquet")


# Latest rows, filters, joins


@query("""SELECT c_custkey, c_name, n_name, o_orderkey, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM orders) o
  JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey WHERE rn = 1""")
def latest_order_per_customer(spark, d):
    last = S.latest_per_key(t(spark, d, "orders"), ["o_custkey"], [F.col("o_orderdate").desc_nulls_first(), F.col("o_orderkey")])
    j = last.join(t(spark, d, "customer"), F.col("c_custkey") == F.col("o_custkey")).join(t(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return j.select("c_custkey", "c_name", "n_name", "o_orderkey", "o_totalprice")


@query("""SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
  ORDER BY nullif(o_orderpriority, '1-URGENT') DESC NULLS FIRST, o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def latest_with_null_order_key(spark, d):
    o = t(spark, d, "orders").withColumn("p", F.nullif("o_orderpriority", F.lit("1-URGENT")))
    return S.latest_per_key(o, ["o_custkey"], [F.col("p").desc_nulls_first(), F.col("o_orderkey")]).select("o_custkey", "o_orderkey")


@query("""SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem
  WHERE l_quantity BETWEEN 10 AND 20 AND l_returnflag = 'R' AND l_shipdate >= DATE '1995-01-01'""")
def range_projection(spark, d):
    x = t(spark, d, "lineitem").where((F.col("l_quantity").between(10, 20)) & (F.col("l_returnflag") == "R") & (F.col("l_shipdate") >= F.lit("1995-01-01").cast("timestamp_ntz")))
    return x.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")


@query("SELECT p_partkey, p_name, p_brand FROM part WHERE p_brand IN ('Brand#11', 'Brand#12', 'O''Neil') OR p_size = 7")
def in_list_lookup(spark, d):
    return t(spark, d, "part").where(F.col("p_brand").isin("Brand#11", "Brand#12", "O'Neil") | (F.col("p_size") == 7)).select("p_partkey", "p_name", "p_brand")


@query("""SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate <= TIMESTAMP '1996-06-30'
  AND (o_orderdate + INTERVAL 365 DAY >= TIMESTAMP '1996-06-30' OR o_orderstatus = 'O')""")
def active_interval_filter(spark, d):
    day = F.lit("1996-06-30").cast("timestamp_ntz")
    open_end = (F.col("o_orderdate") + F.expr("INTERVAL 365 DAY") >= day) | (F.col("o_orderstatus") == "O")
    return t(spark, d, "orders").where((F.col("o_orderdate") <= day) & open_end).select("o_orderkey", "o_custkey")


@query("""SELECT c_nationkey AS nationkey, c_name, s_name FROM customer c LEFT JOIN (SELECT nullif(s_nationkey, 3) AS k, min(s_name) AS s_name FROM supplier GROUP BY 1) s
  ON nullif(c_nationkey, 3) IS NOT DISTINCT FROM k""")
def null_safe_left_join(spark, d):
    c, s = t(spark, d, "customer"), t(spark, d, "supplier")
    s = s.groupBy(F.nullif("s_nationkey", F.lit(3)).alias("k")).agg(F.min("s_name").alias("s_name"))
    on = F.nullif("c_nationkey", F.lit(3)).eqNullSafe(F.col("k"))
    return c.join(s, on, "left").select(F.col("c_nationkey").alias("nationkey"), "c_name", "s_name")


@query("""SELECT DISTINCT coalesce(a.k, b.k) AS k, a.n_customers, b.n_suppliers FROM
  (SELECT c_nationkey AS k, count(*) AS n_customers FROM customer WHERE c_nationkey < 20 GROUP BY 1) a FULL JOIN
  (SELECT s_nationkey AS k, count(*) AS n_suppliers FROM supplier WHERE s_nationkey > 4 GROUP BY 1) b ON a.k = b.k""")
def identifier_full_outer(spark, d):
    a = t(spark, d, "customer").where("c_nationkey < 20").groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("n_customers"))
    b = t(spark, d, "supplier").where("s_nationkey > 4").groupBy(F.col("s_nationkey").alias("k")).agg(F.count("*").alias("n_suppliers"))
    return E.full_identifiers(a, b, "k")


@query("""WITH a AS (SELECT c_nationkey AS k, max(c_name) AS c_name FROM customer WHERE c_nationkey < 15 GROUP BY 1),
  b AS (SELECT s_nationkey AS k, max(s_name) AS s_name FROM supplier WHERE s_nationkey > 8 GROUP BY 1)
  SELECT u.k, c_name, s_name FROM (SELECT k FROM a UNION SELECT k FROM b) u LEFT JOIN a ON a.k = u.k LEFT JOIN b ON b.k = u.k""")
def universe_union(spark, d):
    a = t(spark, d, "customer").where("c_nationkey < 15").groupBy(F.col("c_nationkey").alias("k")).agg(F.max("c_name").alias("c_name"))
    b = t(spark, d, "supplier").where("s_nationkey > 8").groupBy(F.col("s_nationkey").alias("k")).agg(F.max("s_name").alias("s_name"))
    return E.universe(a, b, "k")


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def missing_anti(spark, d):
    return ST.pending(t(spark, d, "customer").withColumnRenamed("c_custkey", "o_custkey"), t(spark, d, "orders"), ["o_custkey"]).select(F.col("o_custkey").alias("c_custkey"), "c_name")


@query("""SELECT o_orderkey, (o_custkey % 40)::INTEGER AS permno, first_key FROM orders LEFT JOIN
  (SELECT c_nationkey, min(c_custkey) AS first_key FROM customer GROUP BY 1) ON c_nationkey = o_custkey % 40""")
def first_match_resolve(spark, d):
    asked = t(spark, d, "orders").select("o_orderkey", (F.col("o_custkey") % 40).cast("int").alias("permno"))
    known = t(spark, d, "customer").select(F.col("c_nationkey").alias("permno"), F.col("c_custkey").alias("first_key"))
    return E.first_match(asked, known, "permno", "first_key", ["first_key"])


# Aggregates, windows, sequences


@query("""SELECT c_nationkey, year(o_orderdate)::BIGINT AS y, count(DISTINCT o_custkey) AS members FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2""")
def members_per_group_year(spark, d):
    return S.members_per_year(_nation_years(spark, d), "c_nationkey", "y", "o_custkey")


def _nation_years(spark, d):
    j = t(spark, d, "orders").join(t(spark, d, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    return j.select("c_nationkey", F.year("o_orderdate").cast("long").alias("y"), "o_custkey")


@query("""WITH m AS (SELECT DISTINCT c_nationkey AS g, year(o_orderdate)::BIGINT AS y, coalesce(nullif(o_custkey, 7)::VARCHAR, 'nan') AS name FROM orders JOIN customer ON c_custkey = o_custkey),
  p AS (SELECT g, y, lag(y) OVER (PARTITION BY g ORDER BY y) AS prev FROM (SELECT DISTINCT g, y FROM m))
  SELECT g AS c_nationkey, y,
   (SELECT count(*) FROM m a WHERE a.g = p.g AND a.y = p.y AND NOT EXISTS (SELECT 1 FROM m b WHERE b.g = p.g AND b.y = p.prev AND b.name = a.name)) AS n_new,
   (SELECT count(*) FROM m a WHERE a.g = p.g AND a.y = p.prev AND NOT EXISTS (SELECT 1 FROM m b WHERE b.g = p.g AND b.y = p.y AND b.name = a.name)) AS n_departed
  FROM p WHERE prev IS NOT NULL""")
def turnover_prev_available_year(spark, d):
    x = _nation_years(spark, d).withColumn("o_custkey", F.nullif("o_custkey", F.lit(7)))
    return S.turnover(x, "c_nationkey", "y", "o_custkey").select("c_nationkey", "y", F.col("n_new").cast("long").alias("n_new"), F.col("n_departed").cast("long").alias("n_departed"))


@query("""WITH y AS (SELECT DISTINCT o_custkey, year(o_orderdate)::BIGINT AS y FROM orders),
  i AS (SELECT *, y - row_number() OVER (PARTITION BY o_custkey ORDER BY y) AS k FROM y)
  SELECT o_custkey, y, min(y) OVER (PARTITION BY o_custkey, k) AS became, y - min(y) OVER (PARTITION BY o_custkey, k) AS tenure FROM i""")
def tenure_runs(spark, d):
    return S.tenure(t(spark, d, "orders").select("o_custkey", F.year("o_orderdate").cast("long").alias("y")), ["o_custkey"], "y")


@query("""WITH o AS (SELECT o_custkey, o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN year(o_orderdate)::BIGINT END AS y FROM orders),
  p AS (SELECT *, last_value(y IGNORE NULLS) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM o)
  SELECT o_custkey, o_orderkey, coalesce(sum(CASE WHEN y >= b THEN 1 WHEN y < b THEN 0 END) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING), 0)::INT AS block FROM p""")
def exec_blocks(spark, d):
    o = t(spark, d, "orders").select("o_custkey", "o_orderkey", F.when(F.col("o_orderkey") % 5 != 0, F.year("o_orderdate").cast("long")).alias("y"))
    return S.with_blocks(o, ["o_custkey"], "o_orderkey", "y").drop("y")


@query("""WITH e AS (SELECT user_id, event_id, CASE WHEN event_id % 3 = 0 THEN event_type END AS k FROM events)
  SELECT user_id, event_id, coalesce(last_value(k IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(k IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS k FROM e""")
def ffill_bfill(spark, d):
    e = t(spark, d, "events").select("user_id", "event_id", F.when(F.col("event_id") % 3 == 0, F.col("event_type")).alias("k"))
    return S.fill_both(e, ["user_id"], "event_id", ["k"])


@query("""WITH f AS (SELECT o_custkey, o_orderpriority AS p, min(o_orderkey) AS k FROM orders GROUP BY 1, 2)
  SELECT o_custkey, string_agg(p, ' | ' ORDER BY k) AS joined FROM f GROUP BY 1""")
def group_concat_distinct(spark, d):
    return S.concat_distinct(t(spark, d, "orders"), ["o_custkey"], "o_orderkey", "o_orderpriority")


@query("SELECT lang, source, count(*) AS n, count(*) FILTER (n_chars > 1000) AS n_long FROM documents GROUP BY ROLLUP (lang, source)")
def rollup_counts(spark, d):
    return ST.rolled_up(t(spark, d, "documents"), ["lang", "source"], {"n_long": F.col("n_chars") > 1000})


@query("""SELECT event_type, round(avg(CASE WHEN value > 10 THEN 1.0 ELSE 0.0 END), 6) AS share, avg(CASE WHEN value > 10 THEN 1.0 ELSE 0.0 END) >= 0.6 AS mostly
  FROM events GROUP BY 1""")
def ratio_mostly(spark, d):
    r = V.share(F.col("value") > 10)
    return t(spark, d, "events").groupBy("event_type").agg(F.round(r, 6).alias("share"), (r >= 0.6).alias("mostly"))


@query("""SELECT round(100.0 * count(*) FILTER (nullif(c_mktsegment, 'BUILDING') IS NOT NULL) / count(*), 4) AS with_segment,
  round(100.0 * count(*) FILTER (c_acctbal > 0) / count(*), 4) AS with_balance FROM customer""")
def coverage_pct(spark, d):
    tests = {"with_segment": ~T.is_missing(F.nullif("c_mktsegment", F.lit("BUILDING"))), "with_balance": F.col("c_acctbal") > 0}
    return V.coverage(t(spark, d, "customer"), tests)


@query("""SELECT user_id, event_id, rank FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id)::INT AS rank FROM events) WHERE rank <= 3""")
def top_k_per_key(spark, d):
    return S.top_k(t(spark, d, "events"), ["user_id"], F.col("value"), ["event_id"], 3).select("user_id", "event_id", "rank")


@query("SELECT c_custkey FROM customer ORDER BY try_cast(c_custkey::VARCHAR AS BIGINT), c_custkey LIMIT 500")
def numeric_aware_worklist(spark, d):
    return t(spark, d, "customer").orderBy(F.col("c_custkey").cast("string").try_cast("long"), "c_custkey").limit(500).select("c_custkey")


# State


@query("""SELECT user_id, arg_max(event_type, CASE event_type WHEN 'purchase' THEN 2 WHEN 'click' THEN 1 ELSE 0 END * 1000000000 - event_id) AS status FROM events GROUP BY 1""")
def status_by_rank(spark, d):
    events = t(spark, d, "events").withColumnRenamed("event_type", "status")
    return ST.best_status(events, ["user_id"], "status", {"purchase": 2, "click": 1}, "event_id")


@query("""WITH e AS (SELECT user_id, event_id % 4 AS src, event_id, CASE event_id % 3 WHEN 0 THEN 'no_sct_found' WHEN 1 THEN 'skipped_existing' ELSE 'no_bo_found' END AS s FROM events)
  SELECT user_id, first(s ORDER BY CASE s WHEN 'extracted' THEN 3 WHEN 'skipped_existing' THEN 2 WHEN 'no_sct_found' THEN 1 ELSE 0 END DESC, event_id) AS s FROM e GROUP BY 1""")
def status_precedence(spark, d):
    s = F.when(F.col("event_id") % 3 == 0, "no_sct_found").when(F.col("event_id") % 3 == 1, "skipped_existing").otherwise("no_bo_found")
    return ST.merged_status(t(spark, d, "events").withColumn("s", s), ["user_id"], "s", "event_id")


@query("""SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1""")
def index_upsert(spark, d):
    e = t(spark, d, "events").select("user_id", "event_id", "event_type")
    return ST.upsert(e.where("event_id % 2 = 0"), e.where("event_id % 2 = 1"), ["user_id", "event_type"], "event_id")


@query("""SELECT o_custkey, o_orderkey FROM (SELECT *, coalesce(sum(1) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM orders) WHERE b < 3""")
def stop_after_n(spark, d):
    return S.until_total(t(spark, d, "orders").withColumn("one", F.lit(1)), ["o_custkey"], ["o_orderkey"], "one", 3).select("o_custkey", "o_orderkey")


@query("""WITH w AS (SELECT c_nationkey AS k, c_custkey AS lo, c_custkey + 5 AS hi FROM customer), h AS (SELECT c_nationkey AS k, c_custkey - 1 AS lo, c_custkey + 9 AS hi FROM customer WHERE c_custkey % 3 = 0)
  SELECT k, lo, hi FROM w WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.k = w.k AND h.lo <= w.lo AND h.hi >= w.hi)""")
def uncovered_spans(spark, d):
    c = t(spark, d, "customer")
    w = c.select(F.col("c_nationkey").alias("k"), F.col("c_custkey").alias("lo"), (F.col("c_custkey") + 5).alias("hi"))
    h = c.where("c_custkey % 3 = 0").select(F.col("c_nationkey").alias("k"), (F.col("c_custkey") - 1).alias("lo"), (F.col("c_custkey") + 9).alias("hi"))
    return ST.uncovered(w, h, "k")


# Scalars


@query(r"""SELECT page_id, lower(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(url, '/', ' ', 'g'), '\s+', ' ', 'g'), '[$,]', '', 'g'), '\s+', ' ', 'g'))) AS cleaned FROM pages""")
def clean_text(spark, d):
    return t(spark, d, "pages").select("page_id", T.clean_text(F.col("url")).alias("cleaned"))


@query("""SELECT p_partkey, regexp_replace(regexp_replace(lower(p_type), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS snake FROM part""")
def snake_case(spark, d):
    return t(spark, d, "part").select("p_partkey", T.snake(F.col("p_type")).alias("snake"))


@query("SELECT c_custkey, lpad(c_custkey::VARCHAR, greatest(6, length(c_custkey::VARCHAR))::INT, '0') AS gvkey, lpad((c_custkey * 100000007)::VARCHAR, greatest(10, length((c_custkey * 100000007)::VARCHAR))::INT, '0') AS cik FROM customer")
def zfill_ids(spark, d):
    return t(spark, d, "customer").select("c_custkey", T.gvkey(F.col("c_custkey")).alias("gvkey"), T.zfill(F.col("c_custkey") * 100000007, 10).alias("cik"))


@query("""SELECT c_custkey, concat_ws(', ', nullif(c_name, ''), n_name, concat_ws(' ', CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END, c_custkey::VARCHAR)) AS location FROM customer JOIN nation ON n_nationkey = c_nationkey""")
def location_concat(spark, d):
    j = t(spark, d, "customer").join(t(spark, d, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    state = F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).otherwise(F.lit(" "))
    return j.select("c_custkey", T.location(F.col("c_name"), F.col("n_name"), state, F.col("c_custkey").cast("string")).alias("location"))


@query(r"""SELECT o_orderkey, 'T' || o_custkey AS ticker, 'DEF_14A' AS form, strftime(o_orderdate, '%Y-%m-%d') AS date FROM orders""")
def filename_parse(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", F.concat(F.lit("/data/T"), F.col("o_custkey"), F.lit("/DEF_14A/"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("_DEF_14A.html")).alias("path"))
    parts = T.file_parts(F.col("path"))
    return o.select("o_orderkey", *[parts[n].alias(n) for n in ("ticker", "form", "date")])


@query("""SELECT s_suppkey, CASE s_suppkey % 5 WHEN 1 THEN 'NYSE' WHEN 2 THEN 'AMEX' WHEN 3 THEN 'NASDAQ' END AS exchange, coalesce(CASE WHEN s_suppkey % 4 = 0 THEN NULL WHEN s_suppkey % 4 = 1 THEN 100 ELSE 200 END <> 100, false) AS delisted FROM supplier""")
def delist_exchange_codes(spark, d):
    code = F.when(F.col("s_suppkey") % 4 == 1, 100).when(F.col("s_suppkey") % 4 != 0, 200)
    return t(spark, d, "supplier").select("s_suppkey", T.exchange_name(F.col("s_suppkey") % 5).alias("exchange"), T.is_delisted(code).alias("delisted"))


@query("""SELECT l_orderkey, l_linenumber, round(l_quantity + l_extendedprice, 4) AS total_calc, coalesce(abs(l_quantity + l_extendedprice - CASE WHEN l_linenumber = 1 THEN NULL WHEN l_linenumber = 2 THEN l_extendedprice ELSE l_extendedprice + l_quantity END) <= 5, false) AS total_ok FROM lineitem""")
def quality_flags(spark, d):
    total = F.when(F.col("l_linenumber") == 2, F.col("l_extendedprice")).when(F.col("l_linenumber") > 2, F.col("l_extendedprice") + F.col("l_quantity"))
    x = V.sum_flags(t(spark, d, "lineitem").withColumn("tot", total), ["l_quantity", "l_extendedprice"], "tot")
    return x.select("l_orderkey", "l_linenumber", F.round("total_calc", 4).alias("total_calc"), "total_ok")


@query("""SELECT event_id, json_extract_string(props, '$.k') AS k, length(props)::BIGINT AS n FROM events""")
def json_extract(spark, d):
    return t(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"), F.length("props").cast("long").alias("n"))


@query("""SELECT o_custkey, o_orderkey, o_orderpriority FROM orders""")
def zip_parallel_arrays(spark, d):
    lists = t(spark, d, "orders").groupBy("o_custkey").agg(F.sort_array(F.collect_list(F.struct("o_orderkey", "o_orderpriority"))).alias("x"))
    arrays = lists.select("o_custkey", F.col("x.o_orderkey").alias("o_orderkey"), F.col("x.o_orderpriority").alias("o_orderpriority"))
    return R.zipped(arrays, ["o_custkey"], ["o_orderkey", "o_orderpriority"])


# Enrichment, comparison, search


@query("""SELECT c_custkey::VARCHAR AS id, CASE WHEN c_custkey % 3 = 0 THEN coalesce(s_name, CASE WHEN c_custkey % 6 = 0 THEN 'null' END) ELSE c_name END AS name FROM customer
  LEFT JOIN (SELECT s_nationkey, min(s_name) AS s_name FROM supplier GROUP BY 1) ON s_nationkey = c_nationkey""")
def enrich_fill_missing(spark, d):
    c = t(spark, d, "customer").withColumn("name", F.when(F.col("c_custkey") % 6 == 0, F.lit("null")).when(F.col("c_custkey") % 3 != 0, F.col("c_name")))
    s = t(spark, d, "supplier").groupBy("s_nationkey").agg(F.min("s_name").alias("s_name"))
    return c.join(s, F.col("s_nationkey") == F.col("c_nationkey"), "left").select(F.col("c_custkey").cast("string").alias("id"), E.fill("name", F.col("s_name")).alias("name"))


def _master(spark, d):
    c = t(spark, d, "customer")
    records = c.select(F.col("c_custkey").cast("string").alias("id"), F.concat(F.lit("t"), "c_custkey").alias("ticker"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_custkey").cast("string")).alias("permno"), F.lit("null").alias("gvkey"), F.lit("").alias("cusip"), F.lit(None).cast("string").alias("exchange"), F.lit(None).cast("string").alias("isDelisted"), F.lit("SEC").alias("source"))
    names = c.select(F.concat(F.lit("T"), "c_custkey").alias("ticker"), F.col("c_custkey").alias("permno"), F.concat(F.lit("N"), "c_custkey").alias("ncusip"))
    link = c.where("c_custkey % 5 <> 0").select(F.col("c_custkey").alias("lpermno"), F.col("c_nationkey").cast("string").alias("gvkey"))
    company = c.where("c_custkey % 10 = 1").select(F.concat(F.lit("T"), "c_custkey").alias("ticker"), F.lit("9").alias("gvkey"), F.concat(F.lit("C"), "c_custkey").alias("cusip"))
    exchange = c.select(F.col("c_custkey").alias("permno"), (F.col("c_custkey") % 4).alias("hexcd"))
    delist = c.where("c_custkey % 7 = 0").select(F.col("c_custkey").alias("permno"), F.lit(200).alias("dlstcd"))
    currency = c.where("c_nationkey % 2 = 0").select(F.col("c_nationkey").cast("string").alias("gvkey"), F.lit("USD").alias("curcd")).distinct()
    even = F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment"))
    described = c.select("*", F.concat(F.lit("t"), "c_custkey").alias("ticker"), F.lit(2020).alias("year"), even.alias("naicsdesc"), F.col("c_mktsegment").alias("sicdesc"))
    described = E.descriptors(described.select("*", F.lit(None).cast("string").alias("address"), F.col("c_name").alias("city"), even.alias("state"), F.lit("").alias("zip")))
    return E.enrich(records.withColumn("location", F.when(F.col("id").cast("int") % 3 == 0, "kept")), names, link, company, exchange, delist, currency, described)


@query("""SELECT c_custkey::VARCHAR AS id, c_custkey::VARCHAR AS permno, CASE WHEN c_custkey % 5 <> 0 THEN lpad(c_nationkey::VARCHAR, 6, '0') ELSE 'null' END AS gvkey,
  CASE WHEN c_custkey % 10 = 1 THEN 'C' || c_custkey ELSE 'N' || c_custkey END AS cusip, CASE c_custkey % 4 WHEN 1 THEN 'NYSE' WHEN 2 THEN 'AMEX' WHEN 3 THEN 'NASDAQ' END AS exchange,
  CASE WHEN c_custkey % 7 = 0 THEN 'true' ELSE 'false' END AS isDelisted, 'SEC, WRDS' AS source,
  CASE WHEN c_custkey % 3 = 0 THEN 'kept' WHEN c_custkey % 2 = 0 THEN c_name || ', ' || c_mktsegment ELSE c_name END AS location FROM customer""")
def enrich_records(spark, d):
    return _master(spark, d)[0].drop("ticker")


@query("""WITH c AS (SELECT *, c_custkey::VARCHAR AS id FROM customer)
  SELECT id, 'permno' AS field, NULL AS before, id AS after FROM c WHERE c_custkey % 2 = 1
  UNION ALL SELECT id, 'gvkey', 'null', lpad(c_nationkey::VARCHAR, 6, '0') FROM c WHERE c_custkey % 5 <> 0
  UNION ALL SELECT id, 'cusip', '', CASE WHEN c_custkey % 10 = 1 THEN 'C' || id ELSE 'N' || id END FROM c
  UNION ALL SELECT id, 'exchange', NULL, CASE c_custkey % 4 WHEN 1 THEN 'NYSE' WHEN 2 THEN 'AMEX' ELSE 'NASDAQ' END FROM c WHERE c_custkey % 4 <> 0
  UNION ALL SELECT id, 'isDelisted', NULL, CASE WHEN c_custkey % 7 = 0 THEN 'true' ELSE 'false' END FROM c
  UNION ALL SELECT id, 'currency', NULL, 'USD' FROM c WHERE c_custkey % 5 <> 0 AND c_nationkey % 2 = 0
  UNION ALL SELECT id, 'sector_alt', NULL, c_mktsegment FROM c WHERE c_custkey % 2 = 0
  UNION ALL SELECT id, 'industry_alt', NULL, c_mktsegment FROM c
  UNION ALL SELECT id, 'location', NULL, CASE WHEN c_custkey % 2 = 0 THEN c_name || ', ' || c_mktsegment ELSE c_name END FROM c WHERE c_custkey % 3 <> 0
  UNION ALL SELECT id, 'source', 'SEC', 'SEC, WRDS' FROM c""")
def enrich_change_log(spark, d):
    return _master(spark, d)[1].select("id", "field", "before", "after")


@query("""SELECT 'l_discount' AS "column", count(*) FILTER (l_orderkey % 100 = 0) AS mismatches FROM lineitem
  UNION ALL SELECT 'l_returnflag', count(*) FILTER (l_linenumber = 3) FROM lineitem UNION ALL SELECT 'l_tax', 0 FROM lineitem LIMIT 3""".replace("FROM lineitem LIMIT 3", ""))
def frame_compare(spark, d):
    # Repeated keys are told apart by their place, as a comparison by position does.
    place = Window.partitionBy("l_orderkey", "l_linenumber").orderBy("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")
    a = t(spark, d, "lineitem").withColumn("place", F.row_number().over(place))
    b = a.withColumn("l_discount", F.when(F.col("l_orderkey") % 100 == 0, F.col("l_discount") + 1).otherwise(F.col("l_discount") + 1e-12))
    b = b.withColumn("l_returnflag", F.when(F.col("l_linenumber") != 3, F.col("l_returnflag")))
    return V.compare(a, b, ["l_orderkey", "l_linenumber", "place"], ["l_discount", "l_returnflag", "l_tax"]).select("column", "mismatches")


def _records(spark, d):
    c = t(spark, d, "customer")
    return c.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("ticker"), F.col("c_custkey").alias("permno"), F.col("c_nationkey").cast("string").alias("gvkey"), F.lit(None).cast("string").alias("cusip"), F.col("c_name").alias("title"), F.col("c_custkey").cast("string").alias("cik_str"))


@query("SELECT c_custkey AS id FROM customer WHERE upper(c_mktsegment) = 'BUILDING' OR c_custkey = 5")
def json_query_or(spark, d):
    return J.json_query(_records(spark, d), '{"$or": [{"ticker": "building"}, {"permno": 5}], "ticker": "ignored"}', None).select("id")


@query("SELECT c_custkey AS id FROM customer WHERE c_custkey > 100 AND c_nationkey IN (3, 4)")
def json_query_and(spark, d):
    return J.json_query(_records(spark, d), '{"permno": {"$gt": 100, "$lt": 5}, "gvkey": {"$in": ["003", 4]}, "cusip": null}', None).select("id")


@query("SELECT c_custkey AS id FROM customer WHERE c_name LIKE '%7%' AND c_mktsegment <> 'MACHINERY' ORDER BY c_custkey LIMIT 500")
def json_query_contains(spark, d):
    return J.json_query(_records(spark, d), '[{"title": {"$contains": "7"}}, {"ticker": {"$neq": "machinery"}}]').select("id")


@query("SELECT c_custkey AS id FROM customer WHERE c_custkey = 12 OR c_nationkey = 12 ORDER BY 1 LIMIT 200")
def search_auto(spark, d):
    return J.search(_records(spark, d), "12").select("id")


# Documents and nested records


# Some pages are refused, in the first 4096 bytes or just beyond.
_FETCHED = """CASE page_id % 7 WHEN 0 THEN '<p>Your Request Has Been BLOCKED' WHEN 1 THEN '403 Forbidden' WHEN 2 THEN repeat('é', 2048) || 'access denied' WHEN 3 THEN repeat('é', 2040) || 'Access Denied'
  WHEN 4 THEN 'Automated access' ELSE '' END || html"""


@query(f"""WITH p AS (SELECT page_id, {_FETCHED} AS html FROM pages) SELECT page_id, CASE WHEN strlen(html) = 0 THEN 'empty' WHEN strlen(html) < 2048 THEN 'too_small:<2048'
  WHEN page_id % 7 <> 2 AND regexp_matches(html[1:2100], '(?i)access denied|request has been blocked|forbidden') THEN 'blocked' ELSE 'ok' END AS status,
  contains(lower(html), '<html') AS has_html FROM p""")
def html_check(spark, d):
    p = t(spark, d, "pages").select("page_id", F.expr(_FETCHED).alias("html"))
    return p.select("page_id", T.html_status(F.col("html")).alias("status"), F.lower("html").contains("<html").alias("has_html"))


@query("""SELECT page_id, len(regexp_extract_all(html, '<a href="([^"]*)"', 1))::BIGINT AS n_links, regexp_extract(html, '<a href="([^"]*)"', 1) AS first_link FROM pages""")
def html_links(spark, d):
    links = R.links(F.col("html"))
    return t(spark, d, "pages").select("page_id", F.size(links).cast("long").alias("n_links"), F.coalesce(F.get(links, F.lit(0)), F.lit("")).alias("first_link"))


@query(r"""WITH p AS (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos, unnest(string_split(text, chr(10))) AS l FROM documents),
  s AS (SELECT doc_id, pos, (CASE WHEN contains(l, 'the') OR contains(l, 'und') THEN 2 ELSE 0 END + CASE WHEN length(l) > 200 THEN 1 ELSE 0 END)::INT AS score FROM p)
  SELECT doc_id, pos::INT AS pos, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, pos)::INT AS rank FROM s WHERE score >= 1) WHERE rank <= 3""")
def keyword_score_topk(spark, d):
    p = t(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "l"))
    score = F.when(F.col("l").contains("the") | F.col("l").contains("und"), 2).otherwise(0) + F.when(F.length("l") > 200, 1).otherwise(0)
    return S.top_k(p.withColumn("score", score), ["doc_id"], F.col("score"), ["pos"], 3, F.lit(1)).select("doc_id", "pos", "score", "rank")


@query("SELECT min(doc_id) AS doc_id, count(*) AS n FROM documents GROUP BY source, substr(text, 1, 200)")
def prefix_dedup(spark, d):
    return ST.distinct_by_prefix(t(spark, d, "documents"), ["source"], "text", "doc_id").select("doc_id", "n")


@query("SELECT doc_id, strlen(text)::BIGINT AS size, sha256(text) AS sha256 FROM documents")
def content_sha256(spark, d):
    return with_sidecar(t(spark, d, "documents").select("doc_id", F.encode("text", "UTF-8").alias("content"))).select("doc_id", "size", "sha256")


@query("""SELECT o_custkey, string_agg(y || ':' || k, ',' ORDER BY y) AS years FROM (SELECT o_custkey, year(o_orderdate) AS y, max(o_orderkey) AS k FROM orders GROUP BY 1, 2) GROUP BY 1""")
def nested_map_build(spark, d):
    rows = t(spark, d, "orders").select("o_custkey", F.year("o_orderdate").alias("y"), "o_orderkey", F.col("o_orderkey").alias("k"))
    nested = TB.value_map(rows, ["o_custkey"], "y", "k", "o_orderkey")
    return nested.select("o_custkey", F.array_join(F.transform(F.map_entries("values"), lambda e: F.concat_ws(":", e["key"], e["value"])), ",").alias("years"))


@query("""WITH l AS (SELECT upper(c_mktsegment) AS s, max(c_custkey) AS id FROM customer GROUP BY 1)
  SELECT c_custkey AS id, CASE WHEN l.id IS NOT NULL THEN 'x' || l.s END AS part FROM customer LEFT JOIN l ON l.id = c_custkey""")
def master_merge(spark, d):
    m = t(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("ticker"))
    parts = m.select(F.upper("ticker").alias("ticker")).distinct().withColumn("part", F.concat(F.lit("x"), "ticker"))
    return ST.attach_latest(m, parts, "part").select("id", "part")


# Tables and texts of filings, one made of each row of a driver table


def _table(*rows) -> F.Column:
    """An HTML table of rows of cells; a row that is a Column counts as it stands."""
    cell = lambda x: F.concat(F.lit("<td>"), x if isinstance(x, F.Column) else F.lit(x), F.lit("</td>"))
    line = lambda r: r if isinstance(r, F.Column) else F.concat(F.lit("<tr>"), *map(cell, r), F.lit("</tr>"))
    return F.concat(F.lit("<table>"), *map(line, rows), F.lit("</table>"))


def _filings(spark, d):
    """Cells of a page for each customer: a table of pay, after one of grants for every third, with a line of digits above its data for every fifth."""
    k, name = F.col("c_custkey"), F.col("c_name")
    money = lambda n: F.format_number(n, 0)
    note = F.when(k % 5 == 0, F.lit("<tr><td>as of 12 31</td><td></td><td></td><td></td><td></td></tr>")).otherwise("")
    pay = _table(
        ["Name and Principal Position", "Year", "Salary ($)", "Bonus ($)", "Total ($)"],
        note,
        [name, "2023", money(k * 1000 + 500), F.when(k % 2 == 0, "\u2014").otherwise(money(k)), money(k * 1001 + 500)],
        [F.concat(F.lit("Chief of "), "c_mktsegment"), "2022", money(k * 900 + 400), "\u2014", money(k * 900 + 400)],
        ["Second Officer", "2023 2022", "200 100", "7", "207 107"],
    )
    grants = _table(["Grant date", "Units"], ["2023-01-01", "500"])
    html = F.concat(F.lit("<p>SUMMARY</p>"), F.when(k % 3 == 0, grants).otherwise(""), pay)
    return parse_tables(t(spark, d, "customer").select(k.cast("string").alias("doc"), html.alias("html")))


@query("""WITH c AS (SELECT c_custkey AS k, c_custkey::VARCHAR AS doc, lower(c_name) AS n, 'chief of ' || lower(c_mktsegment) AS p, c_custkey % 5 = 0 AS noted FROM customer)
  SELECT doc, 0 AS block, CASE WHEN noted THEN 'as of 12 31' ELSE n END AS executive, CASE WHEN noted THEN n || ' ' || p ELSE p END AS position, y AS year,
  CASE y WHEN 2023 THEN k * 1000 + 500 WHEN 2022 THEN k * 900 + 400 END::VARCHAR AS salary, CASE WHEN y = 2023 AND k % 2 = 1 THEN k::VARCHAR END AS bonus
  FROM c, (VALUES (2023), (2022), (NULL)) v(y) WHERE y IS NOT NULL OR noted
  UNION ALL SELECT doc, 1, 'second officer', NULL, y, CASE y WHEN 2023 THEN '200.0' ELSE '100.0' END, '7.0' FROM c, (VALUES (2023), (2022)) v(y)""")
def sct_pipeline(spark, d):
    rows, f = C.clean_sct(C.best_table(_filings(spark, d))), F.col("fields")
    return rows.select("doc", "block", "executive", "position", "year", f["salary"].alias("salary"), f["bonus"].alias("bonus"))


@query("""SELECT c_custkey::VARCHAR AS doc, CASE WHEN c_custkey % 3 = 0 THEN i ELSE 0 END AS table_idx, CASE WHEN c_custkey % 3 = 0 AND i = 0 THEN -2 ELSE 13 END AS score
  FROM customer, (VALUES (0), (1)) v(i) WHERE i = 0 OR c_custkey % 3 = 0""")
def sct_score(spark, d):
    return C.score_tables(_filings(spark, d)).select("doc", "table_idx", F.col("score").cast("int").alias("score"))


@query("SELECT c_custkey::VARCHAR AS doc, (c_custkey % 3 = 0)::INT AS table_idx FROM customer")
def sct_guard(spark, d):
    return C.guard_tables(_filings(spark, d)).select("doc", "table_idx")


@query("""WITH o AS (SELECT o_orderkey AS k, year(o_orderdate) AS y FROM orders)
  SELECT k, slot, (y - slot)::VARCHAR AS y, CASE slot WHEN 0 THEN k * 10 ELSE k END::DOUBLE::VARCHAR AS salary, CASE slot WHEN 0 THEN '0.0' ELSE '5000.0' END AS bonus, '3.0' AS total
  FROM o, (VALUES (0), (1)) v(slot) WHERE k % 2 = 0 UNION ALL SELECT k, 0, y::VARCHAR, (k * 10) || ' ' || k, '\u2014 5000', '3' FROM o WHERE k % 2 = 1""")
def expand_stacked(spark, d):
    k, y = F.col("o_orderkey"), F.year("o_orderdate")
    values = {
        "year": F.when(k % 2 == 0, F.concat_ws(" ", y, y - 1)).otherwise(y.cast("string")),
        "salary": F.concat_ws(" ", k * 10, k), "bonus": F.lit("\u2014 5000"), "total": F.lit("3"),
    }
    rows = t(spark, d, "orders").select(F.lit("a").alias("doc"), F.lit(0).alias("table_idx"), k.alias("row_idx"), F.create_map(*[x for n, v in values.items() for x in (F.lit(n), v)]).alias("values"))
    v = F.col("values")
    # A double's text differs between engines from 10 million on.
    number = lambda c: F.when(c.contains("E"), F.concat(c.cast("double").cast("decimal(20,1)"))).otherwise(c)
    return C.expand_stacked(rows).select(F.col("row_idx").alias("k"), "slot", v["year"].alias("y"), number(v["salary"]).alias("salary"), v["bonus"].alias("bonus"), v["total"].alias("total"))


def _holders(spark, d):
    """Cells of a page for each supplier: a table of holders, after one that is none for every second."""
    k, name = F.col("s_suppkey"), F.col("s_name")
    table = _table(
        ["Name of Beneficial Owner", "Number of Shares", F.when(k % 3 == 0, "").otherwise("Percent of Class")],
        [name, F.format_number(k * 1000 + 1000, 0), F.concat((k % 90).cast("string"), F.lit(".5%"))],
        [F.concat(k, F.lit(" Main St")), "", ""],
        ["All directors as a group", F.format_number(k + 1000, 0), "3.0%"],
    )
    other = _table(["Meeting", "Place"], ["May 1", "Hall"])
    return parse_tables(t(spark, d, "supplier").select(k.cast("string").alias("doc"), F.concat(F.when(k % 2 == 0, other).otherwise(""), table).alias("html")))


@query("""SELECT s_suppkey::VARCHAR AS doc, (s_suppkey % 2 = 0)::INT AS table_idx FROM supplier""")
def bo_guard(spark, d):
    return C.ownership_tables(_holders(spark, d)).select("doc", "table_idx")


@query("""SELECT s_suppkey::VARCHAR AS doc, 'management' AS table_kind, s_name AS name, s_suppkey || ' Main St' AS address, format('{:,}', s_suppkey * 1000 + 1000) AS shares, (s_suppkey % 90) || '.5%' AS percent FROM supplier
  UNION ALL SELECT s_suppkey::VARCHAR, 'management', 'All directors as a group', NULL, format('{:,}', s_suppkey + 1000), '3.0%' FROM supplier""")
def bot_pipeline(spark, d):
    cells = _holders(spark, d)
    picked = cells.join(C.ownership_tables(cells), ["doc", "table_idx"], "left_semi")
    return C.clean_bot(picked).select("doc", "table_kind", "name", "address", "shares", "percent")


@query("""WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity::BIGINT AS q, l_partkey % 7 AS f FROM lineitem)
  SELECT l_orderkey, l_linenumber, l_partkey, CASE f WHEN 0 THEN q * 1000 WHEN 1 THEN -q WHEN 5 THEN -q WHEN 6 THEN q END::DOUBLE AS n,
  CASE f WHEN 0 THEN q * 1000 WHEN 1 THEN -q WHEN 2 THEN 0 WHEN 3 THEN 0 WHEN 4 THEN q WHEN 5 THEN -q WHEN 6 THEN q END::DOUBLE AS z FROM l""")
def to_number_variants(spark, d):
    q, f = F.col("l_quantity").cast("long").cast("string"), F.col("l_partkey") % 7
    s = F.when(f == 0, F.concat(q, F.lit(",000"))).when(f == 1, F.concat(F.lit("("), q, F.lit(")"))).when(f == 2, "\u2014").when(f == 3, " ").when(f == 4, F.concat(q, F.lit("d")))
    s = s.when(f == 5, F.concat(F.lit("-"), q)).otherwise(F.concat(F.lit("$ "), q))
    # The lenient reading takes the bracket's minus, the strict one a bracket around the whole.
    return t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", T.to_number(s).alias("n"), T.to_number_or_zero(s).alias("z"))


def _texts(spark, d):
    """A filing's text for each order: table, ASCII table, narrative or nothing, with or without a heading."""
    k = F.col("o_orderkey")
    head = F.when(k % 2 == 0, "SUMMARY COMPENSATION TABLE\n").otherwise("")
    kinds = [
        F.concat(head, F.lit("<TABLE> NAME x Salary 5 "), k, F.lit("</TABLE> z</TABLE>")),
        F.concat(head, F.lit("Name and Principal Position   Year   Salary\nAnn Roe   2001   $"), k, F.lit("\nBob Poe   2001   7")),
        F.concat(head, F.lit("The board met.\nIt was short.\n\nPaid $"), k, F.lit(" and $20,000.\n \nThe chief executive officer\nreceived a salary of $5 and 10% of $7.\n\nThe end")),
        F.concat(head, F.lit("Nothing here, order "), k),
    ]
    text = F.element_at(F.array(*kinds), (k % 8 / 2).cast("int") + 1)
    return t(spark, d, "orders").select("o_orderkey", F.when(k % 16 != 15, text).alias("text"))


@query("""WITH o AS (SELECT o_orderkey AS k, (o_orderkey % 8) // 2 AS f, o_orderkey % 2 = 0 AS h FROM orders)
  SELECT k AS o_orderkey, CASE WHEN f = 0 AND h THEN 'SUMMARY COMPENSATION TABLE' || chr(10) || '<TABLE> NAME x Salary 5 ' || k || '</TABLE>' END AS snippet,
  CASE WHEN k % 16 = 15 THEN 'error' WHEN f = 0 AND h THEN 'anchor_but_missing' WHEN f = 0 THEN 'no_anchor' WHEN f = 1 THEN 'ascii_npp' WHEN f = 2 THEN 'narrative' WHEN h THEN 'anchor_but_missing' ELSE 'no_anchor' END AS class FROM o""")
def sct_text(spark, d):
    x = _texts(spark, d)
    return x.select("o_orderkey", N.sct_snippet(F.col("text")).alias("snippet")).join(N.file_classes(x, "o_orderkey", "text"), "o_orderkey")


@query("""WITH o AS (SELECT o_orderkey AS k, (o_orderkey % 8) // 2 AS f, o_orderkey % 2 = 0 AS h FROM orders)
  SELECT k AS o_orderkey, CASE WHEN r = 1 THEN 2 ELSE 1 END AS pos, CASE WHEN r = 1 THEN 'The chief executive officer received a salary of $5 and 10% of $7.' ELSE 'Paid $' || k || ' and $20,000.' END AS paragraph,
  CASE r WHEN 1 THEN 7 ELSE 4 END AS score, r AS rank FROM o, (VALUES (1), (2)) v(r) WHERE f = 2
  UNION ALL SELECT k, 0, CASE WHEN h THEN 'SUMMARY COMPENSATION TABLE ' ELSE '' END || 'Name and Principal Position   Year   Salary Ann Roe   2001   $' || k || ' Bob Poe   2001   7', 4, 1 FROM o WHERE f = 1""")
def paragraph_topk(spark, d):
    return N.top_paragraphs(_texts(spark, d), "o_orderkey", "text")


@query("""WITH o AS (SELECT o_orderkey AS k, (o_orderkey % 8) // 2 AS f, o_orderkey % 2 = 0 AS h FROM orders),
  c AS (SELECT k, CASE WHEN k % 16 = 15 THEN 'error' WHEN f = 0 AND h THEN 'anchor_but_missing' WHEN f = 0 THEN 'no_anchor' WHEN f = 1 THEN 'ascii_npp' WHEN f = 2 THEN 'narrative' WHEN h THEN 'anchor_but_missing' ELSE 'no_anchor' END AS class FROM o)
  SELECT class, count(*) AS n, array_to_string(list_slice(list_sort(list(k)), 1, 5), ',') AS samples FROM c GROUP BY class""")
def class_audit(spark, d):
    out = N.audit(N.file_classes(_texts(spark, d), "o_orderkey", "text"), "o_orderkey")
    return out.select("class", "n", F.concat_ws(",", F.transform("samples", lambda x: x.cast("string"))).alias("samples"))


@query("""WITH c AS (SELECT c_custkey AS k, c_custkey % 5 AS f, lower(c_mktsegment) AS m FROM customer)
  SELECT k AS c_custkey, CASE f WHEN 0 THEN 'a. roe' WHEN 1 THEN m || ' head' WHEN 2 THEN '' WHEN 3 THEN 'ann roe' ELSE 'ceo' END AS name,
  CASE f WHEN 0 THEN 'chief executive officer ' || m WHEN 1 THEN k || ' ceo' WHEN 2 THEN k || ' | -' WHEN 3 THEN '' ELSE m END AS position FROM c""")
def name_split(spark, d):
    k, m = F.col("c_custkey"), F.lower("c_mktsegment")
    s = F.col("c_custkey") % 5
    none = F.array().cast("array<string>")
    parts = F.when(s == 0, F.array(F.lit("a. roe"), F.lit("chief executive officer"), m)).when(s == 1, F.array(k.cast("string"), F.concat(m, F.lit(" head")), F.lit("ceo")))
    parts = parts.when(s == 2, F.array(k.cast("string"), F.lit(" "), F.lit("-"))).when(s == 3, F.array(F.lit(""), F.lit(" ann roe "))).when(s == 4, F.array(F.lit("ceo"), m)).otherwise(none)
    return t(spark, d, "customer").select("c_custkey", T.name_and_position(parts).alias("x")).select("c_custkey", "x.name", "x.position")


# Headers of two phrases each, so that rules meet in most; the SQL applies them from the same token lists.
_HEADS = ["Name", "Principal Position", "Fiscal Year", "Option", "Stock Award", "Change in Pension Value", "Percent of Class", "Number of Shares", "Beneficially Owned", "Incentive", "All Other", "Total", "Salary", "Bonus ($)", "Holder", "Footnote (a)", "Deferred Compensation", "Other Annual", ""]
_HEAD_SQL = f"""[{', '.join(f"'{h}'" for h in _HEADS)}][p_partkey % {len(_HEADS)} + 1] || ' ' || CASE WHEN p_partkey % 3 = 0 THEN p_name ELSE [{', '.join(f"'{h}'" for h in _HEADS)}][p_partkey // 7 % {len(_HEADS)} + 1] END"""


def _any_sql(tokens):
    return "(" + " OR ".join(f"contains(h, '{w}')" for w in tokens) + ")"


_SCT_SQL = [
    ("contains(h, 'name') AND contains(h, 'position')", "name_position"), (_any_sql(["fiscal", "year"]), "year"), (_any_sql(["salary"]), "salary"), (_any_sql(["bonus"]), "bonus"), (_any_sql(["other annual"]), "other_annual_comp"),
    ("contains(h, 'stock') AND contains(h, 'award')", "stock_awards"), ("contains(h, 'option') AND contains(h, 'award')", "option_awards"), (_any_sql(["incentive"]), "non_equity_incentive"),
    (_any_sql(["pension", "deferred compensation"]), "pension_value"), (_any_sql(["all other"]), "all_other_comp"), (_any_sql(["total"]), "total"),
]


def _case_sql(rules):
    return "CASE " + " ".join(f"WHEN {test} THEN '{name}'" for test, name in rules) + " ELSE trim(regexp_replace(h, '[^a-z0-9]+', '_', 'g'), '_') END"


@query(f"""WITH p AS (SELECT p_partkey, lower(trim({_HEAD_SQL})) AS h FROM part)
  SELECT p_partkey, {_case_sql(_SCT_SQL)} AS sct, CASE WHEN h = '' THEN '' ELSE {_case_sql([(_any_sql(tokens), name) for name, tokens in H.BOT_TOKENS.items()])} END AS bot,
  ({' + '.join(_any_sql(tokens) + '::INT' for tokens in H.BOT_TOKENS.values())})::INT AS cues FROM p""")
def header_rules(spark, d):
    k, heads = F.col("p_partkey"), F.array(*map(F.lit, _HEADS))
    pick = lambda n: F.element_at(heads, (n % len(_HEADS) + 1).cast("int"))
    raw = F.concat_ws(" ", pick(k), F.when(k % 3 == 0, F.col("p_name")).otherwise(pick(F.floor(k / 7))))
    low = F.lower(T.strip(raw))
    return t(spark, d, "part").select("p_partkey", H.sct_header(raw).alias("sct"), H.bot_header(raw).alias("bot"), H.hits(low, H.BOT_TOKENS).alias("cues"))
