"""Column helpers for filing lists, identifiers in urls, and JSON records of any shape."""

from __future__ import annotations

from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .text import strip, zfill

#: Fixed phrases of which an annual proxy filing holds one at least.
PROXY_PHRASES = r"(?i)summary\s+compensation\s+table|name\s+and\s+principal\s+position|principal\s+position|\bexecutive\s+compensation\b"
#: Fixed names of pay fields in a report.
PAY_KEYS = ("salary", "bonus", "stock_awards", "option_awards", "non_equity_incentive", "pension_value", "all_other_comp", "total")
#: Fixed layout of a list of tickers.
LISTED = r"\b([A-Z0-9.\-]+) \(([^)]+)\) Start Date:\d{4}-\d{2}-\d{2}"
ARCHIVE = "https://www.sec.gov/Archives/edgar/data/"
SUBMISSIONS = "https://data.sec.gov/submissions/CIK"


def year_between(date: Column, first: int, last: int) -> Column:
    """Whether the first four characters are a year in the range; other prefixes are not."""
    return F.coalesce(F.substring(date, 1, 4).try_cast("int").between(first, last), F.lit(False))


def zipped(df: DataFrame, keys: list[str], arrays: list[str]) -> DataFrame:
    """A row for each place of parallel arrays; a shorter one gives nulls."""
    return df.select(*keys, F.inline(F.arrays_zip(*arrays)))


def filings_of_form(df: DataFrame, keys: list[str], arrays: list[str], form: str) -> DataFrame:
    """A row for each filing of the form, whatever its case; the first array holds the forms, shorter ones give ''."""
    return zipped(df, keys, arrays).where(F.upper(arrays[0]) == form.upper()).fillna("", subset=arrays)


def submissions_url(cik: Column) -> Column:
    return F.concat(F.lit(SUBMISSIONS), zfill(cik.cast("long"), 10), F.lit(".json"))


def archive_url(cik: Column, accession: Column, document: Column) -> Column:
    return F.concat(F.lit(ARCHIVE), cik.cast("long").cast("string"), F.lit("/"), F.replace(accession, F.lit("-"), F.lit("")), F.lit("/"), document)


@F.pandas_udf(StringType())
def _joined(base: pd.Series, name: pd.Series) -> pd.Series:
    return pd.Series([urljoin(b, n) for b, n in zip(base, name, strict=True)])


def joined_url(base: Column, name: Column) -> Column:
    """name resolved against base; base without a name, null without a base."""
    return F.when(F.coalesce(base, F.lit("")) == "", None).otherwise(_joined(base, F.coalesce(name, F.lit(""))))


def item_list(c: Column) -> Column:
    """Parts between commas and semicolons, blank ones left out."""
    return F.filter(F.transform(F.split(c, "[,;]"), strip), lambda x: x != "")


def listed_tickers(text: Column) -> Column:
    """(ticker, name) pairs of a list page's text."""
    found = [F.regexp_extract_all(text, F.lit(LISTED), F.lit(i)) for i in (1, 2)]
    return F.transform(F.arrays_zip(*[x.alias(n) for x, n in zip(found, ("ticker", "name"), strict=True)]), lambda x: F.struct(x["ticker"].alias("ticker"), x["name"].alias("name")))


def base_name(c: Column) -> Column:
    """A column's name without the number that made it unique (or any number after its last _)."""
    return F.regexp_replace(c, "_[0-9]+$", "")


def flat_header(levels: Column) -> Column:
    """The named levels of a header, joined."""
    return F.array_join(F.filter(F.transform(levels, strip), lambda x: (x != "") & ~x.startswith("Unnamed")), " ")


def name_before_comma(c: Column) -> Column:
    """struct(name, position): what stands before and after the first comma."""
    parts = F.split(c, ",", 2)
    return F.struct(strip(parts[0]).alias("name"), F.coalesce(strip(F.get(parts, F.lit(1))), F.lit("")).alias("position"))


def plain_number(c: Column) -> Column:
    """The number in a cell once $, commas and white space are gone; (x) is -x; null if it is none."""
    s = F.regexp_replace(c, r"(?U)[$,\s]", "")
    return F.regexp_replace(s, r"^\((.*)\)$", "-$1").try_cast("double")


def looks_like_proxy(text: Column) -> Column:
    return F.coalesce(text.rlike(PROXY_PHRASES), F.lit(False))


def typed(df: DataFrame, numbers: list[str], dates: list[str], strings: list[str]) -> DataFrame:
    """Columns cast to double, timestamp and string; what can't be cast, and the string nan, is null."""
    cast = {c: F.col(c).try_cast("double") for c in numbers} | {c: F.try_to_timestamp(c) for c in dates}
    return df.withColumns(cast | {c: F.nullif(F.col(c).cast("string"), F.lit("nan")) for c in strings})


def without_ids(df: DataFrame, fields: list[str]) -> DataFrame:
    """The fields null in all rows, and `cleared`: whether a row had any of them."""
    had = F.coalesce(*fields).isNotNull()
    return df.withColumn("cleared", had).withColumns({c: F.lit(None).cast(df.schema[c].dataType) for c in fields})


def merged_value(old: Column, new: Column) -> Column:
    """struct(value, other) of two strings: null, blank and zero count as missing, equal numbers and strings merge, others stay apart."""

    def missing(c: Column) -> Column:
        return c.isNull() | (strip(c) == "") | F.coalesce(strip(c).try_cast("double") == 0, F.lit(False))

    same = (old == new) | F.coalesce(old.try_cast("double") == new.try_cast("double"), F.lit(False))
    apart = ~missing(old) & ~missing(new) & ~same
    return F.struct(F.when(missing(old), new).otherwise(old).alias("value"), F.when(apart, new).alias("other"))


# JSON


def report_dates(json: Column) -> Column:
    """Distinct non-blank strings under a key report_date, at any depth and in any case; none of what isn't JSON.

    Parsed and written again, a text has no needless escapes, and a key follows { or a comma.
    """
    plain = F.coalesce(F.try_parse_json(json).cast("string"), F.lit(""))
    found = F.regexp_extract_all(plain, F.lit(r'(?i)(?<=[{,])"report_date":("(?:[^"\\]|\\.)*")'), F.lit(1))
    texts = F.from_json(F.concat(F.lit("["), F.array_join(found, ","), F.lit("]")), "array<string>")
    return F.array_distinct(F.filter(F.transform(texts, strip), lambda x: x != ""))


def has_report_date(json: Column, expected: Column) -> Column:
    """Whether the expected date is among them; any one will do if none is expected."""
    found = report_dates(json)
    return F.coalesce((F.size(found) > 0) & ((F.coalesce(expected, F.lit("")) == "") | F.array_contains(found, expected)), F.lit(False))


def salvaged(response: Column) -> Column:
    """struct(json, status) of a model's answer: the text from its first { to its last }; status ok, parse_error or no_object."""
    body = F.regexp_replace(response, r"(?im)^```json\s*|^```\s*|```$", "")
    body = F.regexp_extract(body, r"(?s)\{.*\}", 0)
    good = F.try_parse_json(body).isNotNull()
    status = F.when(F.coalesce(body, F.lit("")) == "", "no_object").when(good, "ok").otherwise("parse_error")
    return F.struct(F.when(status == "ok", body).alias("json"), status.alias("status"))


def report_reason(json: Column, ticker: Column, date: Column) -> Column:
    """ok, or the first thing wrong with a report: its shape, its ticker or date against the file's, or no pay field."""
    parsed, keys = F.try_parse_json(json), F.json_object_keys(json)
    at = lambda v, path, kind: F.try_variant_get(v, path, kind)
    members = lambda v: F.map_values(F.coalesce(at(v, "$", "map<string,variant>"), F.create_map().cast("map<string,variant>")))
    company, reports = at(parsed, "$.company", "map<string,variant>"), at(parsed, "$.company.reports", "array<variant>")
    people = F.map_values(at(parsed, "$.company.reports[0].executives", "map<string,variant>"))
    # A person or a year that isn't an object has no fields, and leaves the others' be.
    fields = lambda v: F.map_keys(F.coalesce(at(v, "$", "map<string,variant>"), F.create_map().cast("map<string,variant>")))
    pay = F.exists(people, lambda years: F.exists(members(years), lambda rec: F.arrays_overlap(fields(rec), F.array(*map(F.lit, PAY_KEYS)))))
    given_ticker, given_date = at(parsed, "$.company.ticker", "string"), at(parsed, "$.company.reports[0].report_date", "string")

    def differ(a: Column, b: Column) -> Column:
        return F.coalesce((a != "") & (b != "") & (a != b), F.lit(False))

    return (
        F.when(F.try_parse_json(json).isNull(), "json_parse_error")
        .when(F.arrays_overlap(keys, F.array(F.lit("raw_response"), F.lit("parse_error"))), "raw_or_parse_error_present")
        .when(company.isNull(), "missing_company")
        .when(F.coalesce(F.size(reports), F.lit(0)) <= 0, "missing_reports")
        .when(F.coalesce(F.size(people), F.lit(0)) <= 0, "empty_executives")
        .when(differ(F.upper(ticker), F.upper(given_ticker)), "ticker_mismatch")
        .when(differ(date, given_date), "date_mismatch")
        .when(F.coalesce(pay, F.lit(False)), "ok")
        .otherwise("no_numeric_fields")
    )


def master_counts(json: Column) -> dict[str, Column]:
    """pay_entries, holder_entries and holder_years of a master record; each table may be a map or a list."""
    record = F.try_parse_json(json)

    def entries(name: str) -> Column:
        as_map, as_list = (F.try_variant_get(record, f"$.{name}", kind) for kind in ("map<string,variant>", "array<variant>"))
        return F.coalesce(F.map_values(as_map), as_list, F.array().cast("array<variant>"))

    holders = entries("beneficial_ownership")
    years = F.transform(holders, lambda x: F.regexp_extract(strip(F.coalesce(F.try_variant_get(x, "$.report_date", "string"), F.lit(""))), "^[0-9]{4}", 0))
    return {
        "pay_entries": F.size(entries("summary_compensation_table")).cast("long"),
        "holder_entries": F.size(holders).cast("long"),
        "holder_years": F.size(F.array_distinct(F.filter(years, lambda x: x != ""))).cast("long"),
    }


@F.pandas_udf(StringType())
def nfkc(texts: pd.Series) -> pd.Series:
    """Compatibility-composed text."""
    return texts.str.normalize("NFKC")


def ascii_only(c: Column) -> Column:
    """Runs of characters beyond ASCII become one space."""
    return F.regexp_replace(c, r"[^\x00-\x7F]+", " ")


def html_document(body: Column, head: str = "", base: str | None = None) -> Column:
    """A page of its own around a table; `head` holds the style sheets to keep, `base` what its links are relative to."""
    more = (f'<base href="{base}">' if base else "") + head
    return F.concat(F.lit(f'<!doctype html>\n<html><head><meta charset="utf-8">{more}</head><body>\n'), body, F.lit("\n</body></html>\n"))


def utc_seconds(c: Column) -> Column:
    """A time in UTC to the second, as indexes write it."""
    return F.date_format(F.to_utc_timestamp(c, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def exchange_or_other(code: Column) -> Column:
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for x in (1, "NYSE", 2, "AMEX", 3, "NASDAQ")]), code.cast("int")), F.lit("Other"))


def sic_labels(sic: Column) -> dict[str, Column]:
    """Sector, industry and category of an industry code."""
    return {
        "sector": F.when(sic.cast("string").startswith("73"), "Services").otherwise("Other"),
        "industry": F.when(sic == 7372, "Services-Prepackaged Software").otherwise("Other"),
        "category": F.when((sic >= 1000) & (sic < 9999), "Domestic Common Stock"),
    }


def links(html: Column) -> Column:
    """Targets of the anchors in a page, in order."""
    return F.regexp_extract_all(html, F.lit(r'<a href="([^"]*)"'), F.lit(1))
