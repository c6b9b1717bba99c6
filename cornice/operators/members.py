"""Nested records taken apart and put together: members of arrays, known fields with the rest beside them, dates as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DateType, MapType, StructType, TimestampNTZType, TimestampType

from ..functions.text import strip

#: Fixed columns of a director's row: from the filing, and from its member.
FILING_FIELDS = {"id": "id", "accessionNo": "accessionNo", "cik": "cik", "ticker": "ticker", "company_name": "entityName", "filed_at": "filedAt"}
DIRECTOR_FIELDS = {
    "name": "name", "dirClass": "directorClass", "electedIn": "dateFirstElected", "position": "position", "age": "age",
    "is_independent": "isIndependent", "committee_memberships": "committeeMemberships", "qualifications": "qualificationsAndExperience",
}
#: Fixed pay fields and names of columns that are neither pay nor other fields.
PAY_FIELDS = ["salary", "bonus", "stock_awards", "option_awards", "non_equity_incentive", "pension_value", "all_other_comp", "total"]
META_FIELDS = ["executive_name", "year", "position", "exec_block_id", "name_position", "name_position_consolidated"]


def explode_members(df: DataFrame, array: str, outer: dict[str, str], inner: dict[str, str], keep_empty: bool = False) -> DataFrame:
    """A row for each member of an array of structs: outer fields of the record, inner ones of the member.

    outer and inner give the source of each column; a source that the schema lacks is
    null.  Records without members give no row, or with keep_empty one of nulls.
    """
    kind = df.schema[array].dataType
    had = set(kind.elementType.names)
    of_record = [(F.col(s) if s in df.columns else F.lit(None).cast("string")).alias(c) for c, s in outer.items()]
    apart = F.explode_outer if keep_empty else F.explode
    rows = df.select(F.struct(*of_record).alias("_record"), apart(array).alias("_member"))
    # A null member gives a row of nulls, too.
    of_member = [(F.col("_member")[s] if s in had else F.lit(None).cast("string")).alias(c) for c, s in inner.items()]
    return rows.select("_record.*", *of_member)


def filings_of_response(responses: DataFrame, json: str, keys: list[str]) -> DataFrame:
    """A row for each filing in a response's `data`, its directors an array; values that aren't texts are given as JSON."""
    member = ", ".join(f"`{s}`:string" for s in DIRECTOR_FIELDS.values())
    filing = ", ".join(f"`{s}`:string" for s in FILING_FIELDS.values())
    data = F.from_json(json, f"data array<struct<{filing}, directors:array<struct<{member}>>>>")["data"]
    return responses.select(*keys, F.inline(data))


def directors(responses: DataFrame, json: str) -> DataFrame:
    """A row for each director of each filing in the responses."""
    return explode_members(filings_of_response(responses, json, []), "directors", FILING_FIELDS, DIRECTOR_FIELDS)


def year_of_text(c: Column) -> Column:
    """The whole part of a number, else the first year from 1900 to 2099 that stands alone."""
    s = strip(c)
    number = F.when(s.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), s.try_cast("double").cast("int"))
    return F.coalesce(number, F.regexp_extract(s, r"\b((?:19|20)\d{2})\b", 1).try_cast("int"))


def year_records(rows: DataFrame, key: str, executive: str, year: str, values: str, order: str, missing: str | None = "nan") -> DataFrame:
    """key, executives: for each executive by name the years with their fields, as JSON.

    `values` maps the columns of a row, unknown beforehand, to texts.  A column whose name
    up to its first _ is a pay field is a number, 0 where it is none; other columns but
    those that describe the row are gathered as other_fields, blank ones left out, and
    null ones as `missing`.  Rows without a name or a year are left out; of rows of one
    name and year the first counts.
    """
    base = lambda k: F.substring_index(k, "_", 1)
    pays = lambda k: base(k).isin(*PAY_FIELDS)
    m = F.col(values)
    number = lambda k, v: F.coalesce(strip(v).try_cast("double"), F.lit(0.0)).cast("variant")
    pay = F.transform_values(F.map_filter(m, lambda k, v: pays(k)), number)
    text = F.transform_values(m, lambda k, v: strip(F.coalesce(v, F.lit(missing).cast("string"))))
    other = F.map_filter(text, lambda k, v: ~pays(k) & ~base(k).isin(*META_FIELDS) & ~k.isin("year", "position") & F.coalesce(v != "", F.lit(False)))
    one = lambda n, v: F.create_map(F.lit(n), v.cast("variant"))
    rest = F.when(F.size(other) > 0, F.create_map(F.lit("other_fields"), F.to_variant_object(other))).otherwise(F.create_map().cast("map<string,variant>"))
    record = F.to_json(F.map_concat(one("year", F.col("_year")), one("position", F.coalesce(m["position"], F.lit(""))), pay, rest))
    named = rows.withColumn("_year", year_of_text(F.col(year))).where(F.col("_year").isNotNull() & F.col(executive).isNotNull())
    first = named.groupBy(key, F.col(executive).alias("_who"), "_year").agg(F.min_by(record, order).alias("_r"))
    people = first.groupBy(key, "_who").agg(_json_list("_year", F.col("_r")).alias("_years"))
    who = F.to_json(F.array("_who"))
    person = F.concat(F.lit('{"executive_name":'), F.substring(who, F.lit(2), F.length(who) - 2), F.lit(',"compensation_data":'), "_years", F.lit("}"))
    return people.groupBy(key).agg(_json_list("_who", person).alias("executives"))


def _json_list(order: str, json: Column) -> Column:
    """JSON values of a group as one list."""
    ordered = F.transform(F.sort_array(F.collect_list(F.struct(order, json.alias("_j")))), lambda x: x["_j"])
    return F.concat(F.lit("["), F.array_join(ordered, ","), F.lit("]"))


def _iso(c: Column, kind: DataType) -> Column | None:
    """The value with its dates as text, null where nothing in it changes."""
    if isinstance(kind, DateType):
        return F.date_format(c, "yyyy-MM-dd")
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.concat(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"), F.when(F.date_format(c, "SSSSSS") != "000000", F.date_format(c, ".SSSSSS")).otherwise(""))
    if isinstance(kind, StructType):
        parts = [(f.name, _iso(c[f.name], f.dataType)) for f in kind.fields]
        if any(p is not None for _, p in parts):
            return F.when(c.isNotNull(), F.struct(*[(c[n] if p is None else p).alias(n) for n, p in parts]))
    if isinstance(kind, ArrayType) and _iso(F.lit(None), kind.elementType) is not None:
        return F.transform(c, lambda x: _iso(x, kind.elementType))
    if isinstance(kind, MapType) and _iso(F.lit(None), kind.valueType) is not None:
        return F.transform_values(c, lambda k, v: _iso(v, kind.valueType))
    return None


def iso_dates(df: DataFrame) -> DataFrame:
    """The table with dates and times as ISO 8601 text at any depth; keys of maps stay, as do all other values."""
    made = {f.name: _iso(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields}
    return df.select(*[(F.col(f"`{n}`") if c is None else c).alias(n) for n, c in made.items()])
