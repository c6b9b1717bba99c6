"""Identifier enrichment: lookups, fill-if-missing rules, change log, universes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.records import exchange_or_other, sic_labels
from ..functions.text import exchange_name, gvkey, is_delisted, is_missing, location, present, tagged, zfill
from .sequence import latest_per_key

#: Names that are numbered together.
NUMBERED = 1 << 16
LOGGED = ("permno", "gvkey", "cusip", "isDelisted", "exchange", "currency", "sector_alt", "industry_alt", "location", "source")


def crsp_names(stocknames: DataFrame) -> DataFrame:
    """Latest name per upper-case ticker; an open end date is the latest."""
    rows = stocknames.withColumn("ticker", F.upper("ticker")).where(F.col("ticker").isNotNull() & (F.col("ticker") != ""))
    return latest_per_key(rows, ["ticker"], [F.coalesce("nameenddt", F.to_date(F.lit("5999-12-31"))).desc(), F.col("permno")])


def first_securities(security: DataFrame, company: DataFrame) -> DataFrame:
    """tic, gvkey and the company's columns: per upper-case ticker the security of the smallest gvkey and issue; a company may lack."""
    both = security.join(company, "gvkey", "left").withColumn("tic", F.upper("tic"))
    first = latest_per_key(both.where(F.col("tic").isNotNull()), ["tic"], [F.col("gvkey"), F.col("iid")])
    return first.select("tic", "gvkey", *[c for c in company.columns if c != "gvkey"])


def links(linktable: DataFrame) -> DataFrame:
    """gvkey per permno: primary links of type LC, LU or LS, an open one first, else the latest."""
    rows = linktable.where(F.col("linktype").isin("LC", "LU", "LS") & F.col("linkprim").isin("P", "C"))
    return latest_per_key(rows, ["lpermno"], [F.col("linkenddt").isNull().desc(), F.col("linkenddt").desc(), F.col("gvkey")])


def latest_code(rows: DataFrame, key: str, date: str, code: str) -> DataFrame:
    """Code of the latest row per key, null dates first."""
    return latest_per_key(rows, [key], [F.col(date).desc_nulls_first(), F.col(code)]).select(key, code)


def fill(record: str, found: Column) -> Column:
    return F.when(is_missing(F.col(record)), F.coalesce(found, F.col(record))).otherwise(F.col(record))


def currencies(funda: DataFrame) -> DataFrame:
    """gvkey, curcd of the latest fiscal year; null years first."""
    return latest_code(funda.withColumn("gvkey", gvkey(F.col("gvkey"))), "gvkey", "fyear", "curcd")


def descriptors(compensation: DataFrame) -> DataFrame:
    """naicsdesc, sicdesc, address, city, state, zip of the latest year per upper-case ticker."""
    rows = compensation.withColumn("ticker", F.upper("ticker")).where(F.col("ticker").isNotNull())
    rows = latest_per_key(rows, ["ticker"], [F.col("year").desc_nulls_first(), F.col("naicsdesc")])
    return rows.select("ticker", "naicsdesc", "sicdesc", "address", "city", "state", "zip")


def enrich(
    records: DataFrame, names: DataFrame, link: DataFrame, company: DataFrame, exchange: DataFrame, delist: DataFrame, currency: DataFrame | None = None, described: DataFrame | None = None, now: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(records filled, change log id, ticker, field, before, after, source) for records with a ticker and without permno or gvkey.

    company: ticker, gvkey, cusip; currency: gvkey, curcd; described: as of descriptors().  Lookups hold one row per
    key; Spark broadcasts those that are small.  Identifiers, exchange, state and currency are filled if they are
    missing, descriptions if they are blank; last_enriched is set to now if records has such a column.
    """
    spark = records.sparkSession
    currency = spark.createDataFrame([], "gvkey string, curcd string") if currency is None else currency
    described = spark.createDataFrame([], "ticker string, naicsdesc string, sicdesc string, address string, city string, state string, zip string") if described is None else described
    absent = [f for f in LOGGED if f not in records.columns]
    r = records.withColumns({f: F.lit(None).cast("string") for f in absent}) if absent else records
    ticker = F.upper("ticker")
    work = (F.coalesce(ticker, F.lit("")) != "") & (is_missing(F.col("permno")) | is_missing(F.col("gvkey")))
    r = r.withColumn("_t", ticker).withColumn("_work", work)
    n = names.select(F.col("ticker").alias("_t"), F.col("permno").cast("string").alias("_permno"), F.col("ncusip").alias("_ncusip"))
    c = company.select(F.upper("ticker").alias("_t"), F.col("gvkey").alias("_cgvkey"), F.col("cusip").alias("_ccusip"))
    x = described.select(ticker.alias("_t"), present(F.col("naicsdesc")).alias("_sector"), present(F.col("sicdesc")).alias("_industry"), F.nullif(location(*map(F.col, ("address", "city", "state", "zip"))), F.lit("")).alias("_place"))
    j = r.join(n, "_t", "left").join(c, "_t", "left").join(x, "_t", "left").withColumn("_p", fill("permno", F.col("_permno")))
    j = j.join(link.select(F.col("lpermno").cast("string").alias("_p"), F.col("gvkey").alias("_lgvkey")), "_p", "left")
    j = j.join(exchange.select(F.col("permno").cast("string").alias("_p"), F.col("hexcd").alias("_hexcd")), "_p", "left")
    j = j.join(delist.select(F.col("permno").cast("string").alias("_p"), F.col("dlstcd").alias("_dlstcd")), "_p", "left")
    j = j.withColumn("_g", fill("gvkey", gvkey(F.coalesce("_lgvkey", "_cgvkey"))))
    j = j.withColumn("_g6", gvkey(F.col("_g"))).join(currency.select(gvkey(F.col("gvkey")).alias("_g6"), F.col("curcd").alias("_curcd")), "_g6", "left")
    blank = lambda field, found: F.when(F.coalesce(F.col(field), F.lit("")) == "", F.coalesce(found, F.col(field))).otherwise(F.col(field))
    new = {
        "permno": (F.col("_p"), F.lit("WRDS.CRSP")),
        "gvkey": (F.col("_g"), F.lit("WRDS.LINK/COMP")),
        "cusip": (fill("cusip", F.coalesce(present(F.col("_ccusip")), F.col("_ncusip"))), F.when(present(F.col("_ccusip")).isNotNull(), "WRDS.COMPSEC").otherwise("WRDS.CRSP.NCUSIP")),
        "exchange": (fill("exchange", exchange_name(F.col("_hexcd"))), F.lit("WRDS.CRSP.MSF")),
        "isDelisted": (fill("isDelisted", is_delisted(F.col("_dlstcd")).cast("string")), F.lit("WRDS.CRSP.MSEDELIST")),
        "currency": (fill("currency", present(F.col("_curcd"))), F.lit("WRDS.COMP.FUNDA")),
        "sector_alt": (blank("sector_alt", F.col("_sector")), F.lit("WRDS.EXECUCOMP")),
        "industry_alt": (blank("industry_alt", F.col("_industry")), F.lit("WRDS.EXECUCOMP")),
        "location": (blank("location", F.col("_place")), F.lit("WRDS.EXECUCOMP")),
        "source": (tagged(F.col("source"), "WRDS"), F.lit("WRDS")),
    }
    for name, (value, _) in new.items():
        j = j.withColumn(f"_new_{name}", F.when(F.col("_work"), value).otherwise(F.col(name)))
    change = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(f).alias("field"), F.col(f).cast("string").alias("before"), F.col(f"_new_{f}").cast("string").alias("after"), new[f][1].alias("source")) for i, f in enumerate(LOGGED)])
    log = j.select("id", "ticker", F.explode(change).alias("c")).where(~F.col("c.before").eqNullSafe(F.col("c.after")))
    stamp = F.lit(now) if now else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    put = {f: F.col(f"_new_{f}") for f in LOGGED} | {"last_enriched": F.when(F.col("_work"), stamp).otherwise(F.col("last_enriched")) if "last_enriched" in records.columns else F.lit(None)}
    filled = j.select(*[put[c].alias(c) if c in put else F.col(c) for c in records.columns])
    return filled, log.select("id", "ticker", "c.i", "c.field", "c.before", "c.after", "c.source")


def fill_cik(records: DataFrame, by_ticker: DataFrame, by_permno: DataFrame) -> DataFrame:
    """cik_str from the ticker, else from the permno, zero-padded to ten digits."""
    t = by_ticker.select(F.upper("ticker").alias("_t"), F.col("cik").alias("_c1"))
    p = by_permno.select(F.col("permno").cast("string").alias("_p"), F.col("cik").alias("_c2"))
    j = records.withColumn("_t", F.upper("ticker")).withColumn("_p", F.col("permno").cast("string")).join(t, "_t", "left").join(p, "_p", "left")
    found = zfill(F.coalesce(present(F.col("_c1")), present(F.col("_c2"))), 10)
    return j.withColumn("cik_str", fill("cik_str", found)).select(*records.columns)


def universe(crsp: DataFrame, compustat: DataFrame, key: str = "ticker") -> DataFrame:
    """Distinct keys of either side with both sides' columns."""
    keys = crsp.select(key).union(compustat.select(key)).where(F.col(key).isNotNull()).distinct()
    return keys.join(crsp, key, "left").join(compustat, key, "left")


def full_identifiers(crsp: DataFrame, compustat: DataFrame, key: str = "gvkey") -> DataFrame:
    """Full outer join, common columns coalesced, rows distinct."""
    both = [c for c in crsp.columns if c in compustat.columns and c != key]
    a, b = crsp.alias("a"), compustat.alias("b")
    j = a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full")
    cols = [F.coalesce(f"a.{c}", f"b.{c}").alias(c) for c in [key, *both]]
    cols += [F.col(f"a.{c}") for c in crsp.columns if c not in [key, *both]] + [F.col(f"b.{c}") for c in compustat.columns if c not in [key, *both]]
    return j.select(*cols).distinct()


def first_match(asked: DataFrame, records: DataFrame, key: str, order: str, columns: list[str]) -> DataFrame:
    """asked with columns of the first record of the key; nulls where there is none, or the key is null."""
    first = records.groupBy(key).agg(F.min_by(F.struct(*columns), order).alias("_first")).select(key, "_first.*")
    return asked.join(first, key, "left")


def ticker_metadata(names: DataFrame, security: DataFrame, company: DataFrame, delisted: DataFrame, order: str, existing: DataFrame | None = None, first: int = 1) -> DataFrame:
    """Numbered records of a warehouse's names, with their security of each gvkey.

    A delisted permno marks its ticker with -DELISTED.  existing (ticker, cik_str,
    source) gives known records' CIK and source, to which wrds is added once; a ticker
    that it lacks counts as from the SEC, and without it the source is WRDS.  `order` is a
    whole number of its own for each name; numbers begin at `first` and follow it and gvkey.
    """
    both = names.join(security.join(company, "gvkey", "left"), "ticker", "left")
    gone = delisted.select("permno", F.lit(True).alias("_gone")).distinct()
    both = both.join(gone, "permno", "left").withColumn("isDelisted", F.coalesce("_gone", F.lit(False))).drop("_gone")
    if existing is not None:
        both = both.join(existing.select("ticker", "cik_str", F.col("source").alias("_source")), "ticker", "left")
        known = F.coalesce("_source", F.lit("SEC"))
        both = both.withColumn("source", F.when(F.lower(known).contains("wrds"), known).otherwise(F.concat(known, F.lit(", wrds"))))
    else:
        both = both.withColumns({"cik_str": F.lit(None).cast("string"), "source": F.lit("WRDS")})
    # Numbered by ranges of the order, of which only the totals meet.
    both = both.withColumn("_bucket", F.floor(F.col(order) / NUMBERED))
    totals = both.groupBy("_bucket").agg(F.count("*").alias("_n"))
    totals = totals.select("_bucket", (F.sum("_n").over(Window.orderBy("_bucket")) - F.col("_n")).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_bucket").orderBy(order, "gvkey"))
    both = both.join(totals, "_bucket").withColumn("id", F.col("_before") + within + (first - 1))
    ticker = F.when(F.col("isDelisted"), F.concat("ticker", F.lit("-DELISTED"))).otherwise(F.col("ticker"))
    labels = sic_labels(F.col("sic"))
    return both.select(
        "id", "cik_str", ticker.alias("ticker"), F.col("name").alias("title"), "permno", F.nullif("gvkey", F.lit("")).alias("gvkey"), F.nullif("cusip", F.lit("")).alias("cusip"),
        exchange_or_other(F.col("exchcd")).alias("exchange"), "isDelisted", labels["category"].alias("category"), labels["sector"].alias("sicSector"), labels["industry"].alias("sicIndustry"),
        F.when((F.col("state") != "") & (F.col("country") != ""), F.concat_ws("; ", "state", "country")).alias("location"), "source",
    )
