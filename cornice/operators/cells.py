"""Table cleaning on long cells (doc, table_idx, row_idx, col_idx, text).

Columns of filing tables may repeat or lack names, so nothing is pivoted before
names are canonical and unique.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.headers import BOT_TOKENS, SCT_TOKENS, bot_header, hits, sct_header, table_kind
from ..functions.records import base_name, merged_value
from ..functions.text import DASHES, clean_text, name_and_position, strip, to_number_or_zero
from ..session import cut
from .sequence import with_blocks

KEY = ["doc", "table_idx"]
YEAR = r"(?:19|20)\d{2}"
#: Fixed words of header rows left above the first row of data.
HEADER_WORDS = "(?i)name|principal|position|year|fiscal|salary|bonus|stock|option|incentive|pension|all other|total"
PAY = ("salary", "bonus", "stock_awards", "option_awards", "non_equity_incentive", "pension_value", "all_other_comp", "total")


def _text_of(cells: Column) -> Column:
    parts = F.sort_array(F.transform(cells, lambda x: F.struct(x["col_idx"].alias("col_idx"), F.lower(x["text"]).alias("t"))))
    return F.array_join(F.transform(parts, lambda x: x["t"]), " ")


def row_texts(cells: DataFrame, *more: Column) -> DataFrame:
    """doc, table_idx, row_idx, joined lower-case text, and what more is taken of a row."""
    return cells.groupBy(*KEY, "row_idx").agg(_text_of(F.collect_list(F.struct("col_idx", "text"))).alias("row_text"), *more)


def _gathered(cells: DataFrame, *by: str) -> DataFrame:
    """The cells of each row or column as one array, `_cells`.

    What a row, column or table is, is told by grouping and windows and its cells come apart again:
    they are dealt out by document once, and nothing is joined with itself.
    """
    rest = [c for c in cells.columns if c not in (*KEY, *by)]
    return cells.dropna(subset=[*KEY, *by]).groupBy(*KEY, *by).agg(F.collect_list(F.struct(*rest)).alias("_cells"))


def _apart(gathered: DataFrame, columns: list[str]) -> DataFrame:
    return gathered.select(*[c for c in gathered.columns if c != "_cells"], F.inline("_cells")).select(*columns)


def _distinct(cells: DataFrame, along: str, across: str) -> DataFrame:
    content = F.sort_array(F.transform("_cells", lambda x: F.struct(x[across].alias(across), F.coalesce(x["text"], F.lit("\0")).alias("t"))))
    found = _gathered(cells, along).withColumn("_c", content)
    first = Window.partitionBy(*KEY, "_c").orderBy(along)
    return _apart(found.withColumn("_k", F.row_number().over(first)).where("_k = 1"), cells.columns)


def distinct_rows(cells: DataFrame) -> DataFrame:
    """Rows of a table with equal cells: the first stays."""
    return _distinct(cells, "row_idx", "col_idx")


def distinct_columns(cells: DataFrame) -> DataFrame:
    """Columns of a table with equal cells: the first stays."""
    return _distinct(cells, "col_idx", "row_idx")


def blanks_to_null(cells: DataFrame) -> DataFrame:
    return cells.withColumn("text", F.when(~strip(F.col("text")).isin(*DASHES), F.col("text")))


def drop_empty(cells: DataFrame) -> DataFrame:
    """Rows, then columns, without any value go."""
    row, col = Window.partitionBy(*KEY, "row_idx"), Window.partitionBy(*KEY, "col_idx")
    cells = cells.withColumn("_n", F.count("text").over(row)).where("_n > 0")
    return cells.withColumn("_n", F.count("text").over(col)).where("_n > 0").drop("_n")


def with_header(cells: DataFrame, tokens: dict[str, list[str]], max_rows: int, blank: bool = False) -> DataFrame:
    """The first of max_rows rows with two token groups becomes the header column `head`; rows up to it go.

    A column that the header row lacks is named by its place, or with blank has an empty header.
    """
    table = Window.partitionBy(*KEY)
    rows = _gathered(cells, "row_idx").withColumn("row_text", _text_of(F.col("_cells"))).withColumn("_i", F.row_number().over(table.orderBy("row_idx")))
    fits = (F.col("_i") <= max_rows) & (hits(F.col("row_text"), tokens) >= 2)
    rows = rows.withColumn("_head", F.min(F.when(fits, F.col("row_idx"))).over(table)).where(F.col("_head").isNull() | (F.col("row_idx") >= F.col("_head")))
    body = _apart(rows, [*cells.columns, "_head"])
    place = F.col("col_idx").cast("string")
    lacking = F.when(F.col("_head").isNotNull(), F.lit("")).otherwise(place) if blank else place
    head = F.max(F.when(F.col("row_idx") == F.col("_head"), F.col("text"))).over(Window.partitionBy(*KEY, "col_idx"))
    body = body.withColumn("head", F.coalesce(head, lacking))
    return body.where(F.col("_head").isNull() | (F.col("row_idx") > F.col("_head"))).drop("_head")


def unique_names(cells: DataFrame) -> DataFrame:
    """Second and later columns of a name get _2, _3 ..."""
    k = F.dense_rank().over(Window.partitionBy(*KEY, "name").orderBy("col_idx"))
    cells = cells.dropna(subset=[*KEY, "col_idx"]).withColumn("_k", k)
    return cells.withColumn("name", F.when(F.col("_k") > 1, F.concat("name", F.lit("_"), F.col("_k"))).otherwise(F.col("name"))).drop("_k")


def to_rows(cells: DataFrame) -> DataFrame:
    """doc, table_idx, row_idx, values map: the first non-null cell of each name."""
    first = cells.where("text is not null").groupBy(*KEY, "row_idx", "name").agg(F.min_by("text", "col_idx").alias("v"))
    return first.groupBy(*KEY, "row_idx").agg(F.map_from_entries(F.collect_list(F.struct("name", "v"))).alias("values"))


def expand_stacked(rows: DataFrame, numeric: tuple[str, ...] = PAY) -> DataFrame:
    """Rows whose year cell holds several years become one row each; numbers align by place, one number serves all."""
    years = F.regexp_extract_all(F.coalesce(F.col("values")["year"], F.lit("")), F.lit(f"({YEAR})"), F.lit(1))
    rows = rows.withColumn("_years", years).withColumn("_n", F.size("_years"))
    rows = rows.select("*", F.posexplode(F.when(F.col("_n") >= 2, F.col("_years")).otherwise(F.array(F.col("values")["year"]))).alias("_slot", "_year"))
    is_number = lambda k: k.isin(*numeric)

    def cell(k, v):
        tokens = F.split(strip(v), r"\s+")
        at = F.when(F.size(tokens) == 1, tokens[0]).otherwise(F.get(tokens, F.col("_slot")))
        value = F.coalesce(to_number_or_zero(at), F.lit(0.0)).cast("string")
        return F.when(k == "year", F.col("_year")).when(is_number(k), value).otherwise(v)

    put = F.when(F.col("_n") >= 2, F.transform_values("values", cell)).otherwise(F.col("values"))
    return rows.select(*KEY, "row_idx", F.col("_slot").alias("slot"), put.alias("values"))


def clean_sct(cells: DataFrame, dump: Callable[[str, DataFrame], DataFrame] = lambda stage, df: df) -> DataFrame:
    """Compensation rows: doc, table_idx, row_idx, slot, block, executive, year, extras map of texts.

    dump is given the stages `combined` and `cleaned` and gives them back (sources.files.StageDumps writes them).

    Order of steps: clean, distinct rows and columns, header, names, empty ones
    out, year rows, stacked rows apart, blanks to null, blocks, names joined and
    filled within blocks.
    """
    c = dump("combined", cells).withColumn("text", clean_text(F.col("text")))
    c = with_header(distinct_columns(distinct_rows(c)), SCT_TOKENS, 15)
    c = drop_empty(blanks_to_null(c.withColumn("name", sct_header(F.col("head")))))
    rows = to_rows(c)
    year = F.col("values")["year"]
    rows = rows.where(year.isNull() | year.rlike(YEAR))
    first = F.min(F.when(year.rlike(YEAR), F.col("row_idx"))).over(Window.partitionBy(*KEY))
    shown = F.array_join(F.map_values("values"), " ")
    data = shown.rlike(r"\d") & ~shown.rlike(HEADER_WORDS)
    rows = rows.withColumn("_first", first).where(F.col("_first").isNull() | (F.col("row_idx") >= F.col("_first")) | data).drop("_first")
    rows = expand_stacked(rows).withColumn("year", F.regexp_extract(F.col("values")["year"], f"({YEAR})", 1).try_cast("int"))
    rows = rows.withColumn("_order", F.struct("row_idx", "slot"))
    rows = with_blocks(rows, KEY, "_order", "year")
    name = F.col("values")["name_position"]
    joined = F.array_distinct(F.transform(F.sort_array(F.collect_list(F.when(name.isNotNull(), F.struct("_order", name.alias("_name"))))), lambda x: x["_name"]))
    fields = F.map_filter("values", lambda k, v: ~k.isin("name_position", "year")).alias("fields")
    blocks = rows.groupBy(*KEY, "block").agg(joined.alias("_all"), F.collect_list(F.struct("row_idx", "slot", "year", fields)).alias("_rows"))
    blocks = blocks.withColumn("_split", name_and_position(F.col("_all"))).select(*KEY, "block", F.col("_split.name").alias("executive"), F.nullif(F.col("_split.position"), F.lit("")).alias("position"), F.inline("_rows"))
    out = blocks.select(*KEY, "row_idx", "slot", "block", "executive", "position", "year", "fields")
    return dump("cleaned", out)


def merged_fields(cells: DataFrame) -> DataFrame:
    """doc, table_idx, row_idx, fields map of named cells; columns of one name are merged from left to right.

    A missing value (null, blank or zero) gives way to a later one, and equal numbers are
    one.  A value that differs from the first of its name goes under the name with the
    next free number from 2.  Names that differ only in such a number are one name.
    """
    named = unique_names(cells.where("name is not null")).withColumn("_base", base_name(F.col("name")))
    parts = F.sort_array(F.collect_list(F.struct("col_idx", "name", "text")))
    rows = named.groupBy(*KEY, "row_idx", "_base").agg(parts.alias("_p"))
    first = F.struct(F.col("_p")[0]["text"].alias("value"), F.array().cast("array<string>").alias("others"))

    def merge(acc, x):
        got = merged_value(acc["value"], x["text"])
        others = F.when(got["other"].isNotNull(), F.concat(acc["others"], F.array(got["other"]))).otherwise(acc["others"])
        return F.struct(got["value"].alias("value"), others.alias("others"))

    rows = rows.withColumn("_m", F.aggregate(F.slice("_p", F.lit(2), F.size("_p")), first, merge))
    name = F.col("_p")[0]["name"]
    # The first column may have a number itself, which is then taken.
    taken = F.when(name != F.col("_base"), F.regexp_extract(name, r"_(\d+)$", 1).try_cast("int"))
    number = lambda i: i + 2 + F.coalesce((i + 2 >= taken).cast("int"), F.lit(0))
    others = F.transform(F.col("_m")["others"], lambda x, i: F.struct(F.concat("_base", F.lit("_"), number(i)).alias("name"), x.alias("value")))
    entries = F.concat(F.array(F.struct(name.alias("name"), F.col("_m")["value"].alias("value"))), others)
    fields = F.map_from_entries(F.sort_array(F.flatten(F.collect_list(entries))))
    return rows.groupBy(*KEY, "row_idx").agg(fields.alias("fields"))


def sct_json(rows: DataFrame, reports: DataFrame) -> DataFrame:
    """doc, json of each report (doc, ticker, report_date): executive to year to fields, names and years in order.

    Rows without a year are left out, those without an executive are of `unknown`; of
    rows of one executive and year the last counts.
    """
    who = F.coalesce(F.nullif(strip(F.col("executive")), F.lit("")), F.lit("unknown"))
    last = rows.where("year is not null").groupBy("doc", who.alias("executive"), F.col("year").cast("string").alias("year"))
    last = last.agg(F.max_by("fields", F.struct("table_idx", "row_idx", "slot")).alias("fields"))
    last = last.withColumn("fields", F.map_from_entries(F.array_sort(F.map_entries("fields"), lambda a, b: F.when(a["key"] < b["key"], -1).otherwise(1))))
    text = lambda name, value: F.concat(F.substring(F.to_json(F.create_map(name, F.lit(1))), F.lit(2), F.length(F.to_json(F.create_map(name, F.lit(1)))) - 4), F.lit(":"), value)
    group = lambda name: F.concat(F.lit("{"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(name, "_j"))), lambda x: text(x[name], x["_j"])), ","), F.lit("}"))
    years = last.withColumn("_j", F.to_json("fields", {"ignoreNullFields": "false"})).groupBy("doc", "executive").agg(group("year").alias("_j"))
    people = years.groupBy("doc").agg(group("executive").alias("_people"))
    head = F.to_json(F.struct(F.upper("ticker").alias("ticker"), F.substring("report_date", 1, 4).alias("report_year")))
    date = F.to_json(F.struct("report_date"))
    inside = F.concat(F.lit('"summary_compensation_table":['), F.regexp_replace(date, r"\}$", ""), F.lit(',"executives":'), "_people", F.lit("}]"))
    return reports.join(people, "doc").select("doc", F.concat(F.lit('{"company":'), F.regexp_replace(head, r"\}$", ","), inside, F.lit("}}")).alias("json"))


#: Patterns of ownership columns' values, as the fallback rules use them.
PERCENT_SIGN, CLASS_NOTE = r"[%*]", r"^\([a-z]\)$"
FLOAT, WHOLE, SHORT_NUMBER = r"^\d{1,3}(?:,\d{3})*(?:\.\d+)?$", r"^[\d,]+$", r"^\d{0,3}(?:\.\d+)?$"


def fallback_names(cells: DataFrame) -> DataFrame:
    """Columns with a blank name are named by their values: class notes, percents, numbers (percent, too), whole numbers, else notes."""
    t = F.col("text")
    seen = lambda pattern: F.bool_or(t.rlike(pattern))
    guess = F.when(seen(CLASS_NOTE), "class").when(seen(PERCENT_SIGN) | seen(FLOAT), "percent").when(seen(WHOLE), "shares").otherwise("notes")
    blank = cells.where("name = '' and text != ''").groupBy(*KEY, "col_idx").agg(guess.alias("_guess"))
    return cells.join(blank, [*KEY, "col_idx"], "left").withColumn("name", F.coalesce("_guess", "name")).drop("_guess")


def distinct_holder_names(cells: DataFrame) -> DataFrame:
    """The second and later filled `name` columns of a table become percent or shares if 60% of their values look so, else name_extra."""
    t = F.col("text")
    share = lambda *patterns: F.count_if(F.greatest(*[t.rlike(p) for p in patterns], F.lit(False))) / F.count("*") >= 0.6
    kind = F.when(share(PERCENT_SIGN, SHORT_NUMBER, FLOAT), "percent").when(share(WHOLE, FLOAT), "shares").otherwise("name_extra")
    cols = cells.where("name = 'name' and text != ''").groupBy(*KEY, "col_idx").agg(kind.alias("_kind"))
    cols = cols.withColumn("_k", F.row_number().over(Window.partitionBy(*KEY).orderBy("col_idx"))).where("_k > 1").drop("_k")
    return cells.join(cols, [*KEY, "col_idx"], "left").withColumn("name", F.coalesce("_kind", "name")).drop("_kind")


def promoted_extra(rows: DataFrame) -> DataFrame:
    """Add shares and percent, and extra: a name_extra that looks like a number or a percent fills the one that lacks."""
    v = F.col("values")
    extra, bare = v["name_extra"], F.regexp_replace(v["name_extra"], "[, ]", "")
    as_shares = F.coalesce(v["shares"].isNull() & bare.rlike(r"^-?\d+(\.\d+)?$"), F.lit(False))
    as_percent = F.coalesce(~as_shares & v["percent"].isNull() & (extra.contains("%") | extra.rlike(SHORT_NUMBER)), F.lit(False))
    rows = rows.withColumn("shares", F.when(as_shares, extra).otherwise(v["shares"])).withColumn("percent", F.when(as_percent, extra).otherwise(v["percent"]))
    return rows.withColumn("extra", F.when(~as_shares & ~as_percent, extra))


def clean_bot(cells: DataFrame) -> DataFrame:
    """Ownership holders: doc, table_idx, table_kind, row_idx, name, address, shares, percent.

    A row with a name and a share or percent begins a holder; rows after it that
    have only a name are lines of its address.  Columns with a blank header and
    repeated name columns are named by their values.
    """
    cells = cut(cells)
    kinds = row_texts(cells).groupBy(*KEY).agg(table_kind(F.array_join(F.collect_list("row_text"), " ")).alias("table_kind"))
    c = with_header(distinct_rows(cells.withColumn("text", strip(F.col("text")))), BOT_TOKENS, 10, blank=True)
    c = distinct_holder_names(fallback_names(c.withColumn("name", bot_header(F.col("head")))))
    rows = promoted_extra(to_rows(drop_empty(blanks_to_null(c))))
    v = F.col("values")
    rows = rows.where(v["name"].isNotNull() | v["address"].isNotNull())
    rows = rows.withColumn("_new", (F.col("shares").isNotNull() | F.col("percent").isNotNull()).cast("int"))
    run = Window.partitionBy(*KEY).orderBy("row_idx").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("holder", F.sum("_new").over(run))
    line = F.when(F.col("_new") == 0, F.concat_ws(" ", F.coalesce(v["address"], v["name"]), "extra")).otherwise(F.col("extra"))
    lines = F.sort_array(F.collect_list(F.when(line.isNotNull(), F.struct("row_idx", line.alias("t")))))
    out = rows.groupBy(*KEY, "holder").agg(
        F.min_by(F.struct(v["name"].alias("name"), v["address"].alias("address"), "shares", "percent"), "row_idx").alias("v"), F.min("row_idx").alias("row_idx"), F.transform(lines, lambda x: x["t"]).alias("address_lines"), F.max("_new").alias("_any")
    )
    out = out.where("_any = 1").join(kinds, KEY)
    address = F.coalesce(F.col("v")["address"], F.when(F.size("address_lines") > 0, F.array_join("address_lines", ", ")))
    return out.select(*KEY, "table_kind", "row_idx", F.col("v")["name"].alias("name"), address.alias("address"), F.col("v")["shares"].alias("shares"), F.col("v")["percent"].alias("percent"), "address_lines")


#: Fixed words and weights of the compensation table scorer.
COMP_WORDS = ("salary", "bonus", "stock", "option", "non-equity", "non equity", "incentive", "pension", "all other", "total", "compensation", "awards", "cash", "year")
GRANT_WORDS = ("grant", "grant date", "estimated future payouts")


def score_tables(cells: DataFrame, header_rows: int = 12, cues: tuple[int, int, int] = (7, 5, 2), grants: int = -4, titles_count: int = 4) -> DataFrame:
    """doc, table_idx, score: name and position cues 7, 5 or 2, up to 8 words, money 2, grants -4, 4 for each title cue.

    The earlier scorer has cues of 6, 4 and 2, -3 for grants and no titles.
    """
    rows = row_texts(cells.dropna(subset=KEY), F.max("title_cues").alias("title_cues"))
    text = rows.groupBy(*KEY).agg(F.collect_list(F.struct("row_idx", "row_text")).alias("_rows"), F.max("title_cues").alias("title_cues"))
    return _with_score(text, header_rows, cues, grants, titles_count).select(*KEY, "score")


def _with_score(tables: DataFrame, header_rows: int = 12, cues: tuple[int, int, int] = (7, 5, 2), grants: int = -4, titles_count: int = 4) -> DataFrame:
    """tables (_rows with row_idx and row_text, title_cues) with their score."""
    text = tables.withColumn("_r", F.transform(F.sort_array(F.transform("_rows", lambda x: F.struct(x["row_idx"].alias("i"), x["row_text"].alias("t")))), lambda x: x["t"]))
    text = text.withColumn("head", F.array_join(F.slice("_r", 1, header_rows), " ")).withColumn("full", F.array_join("_r", " "))
    has = lambda *w: F.greatest(*[F.col("head").contains(x) for x in w], F.lit(False))
    name, principal, position = has("name"), has("principal", "named executive"), has("position", "occupation")
    cue = F.when(name & principal & position, cues[0]).when(name & (principal | position), cues[1]).when(name, cues[2]).otherwise(0)
    words = F.least(sum((F.col("head").contains(w).cast("int") for w in COMP_WORDS), F.lit(0)), F.lit(8))
    money = F.when(F.col("full").rlike(r"\$|\b\d{3,}\b"), 2).otherwise(0)
    grant = F.when(has(*GRANT_WORDS), grants).otherwise(0)
    return text.withColumn("score", cue + words + money + grant + titles_count * F.col("title_cues")).drop("_r", "head", "full")


def best_table(cells: DataFrame) -> DataFrame:
    """Cells of each document's best scored table, ties to the first; any table wins if it is the only one."""
    return extracted_tables(cells, "score")


def _guarded(row: Column, after: Column) -> Column:
    """A row on name that also names principal and position, or whose next row does."""
    both = lambda c: c.contains("principal") & c.contains("position")
    return row.contains("name") & (both(row) | both(after))


def extracted_tables(cells: DataFrame, mode: str = "xpath") -> DataFrame:
    """Cells of each document's pay table: by its header rows (xpath), by its points (score), or by points and else by its header rows (both)."""
    if mode not in ("xpath", "score", "both"):
        raise ValueError(f"no such mode: {mode}")
    rows = _gathered(cells, "row_idx").withColumn("row_text", _text_of(F.col("_cells")))
    after = F.coalesce(F.lead("row_text").over(Window.partitionBy(*KEY).orderBy("row_idx")), F.lit(""))
    rows = rows.withColumn("_guarded", _guarded(F.col("row_text"), after))
    cues = F.array_max(F.transform("_cells", lambda x: x["title_cues"])) if mode != "xpath" else F.lit(0)
    tables = rows.withColumn("_cues", cues).groupBy(*KEY).agg(F.collect_list(F.struct("row_idx", "row_text", "_cells")).alias("_rows"), F.max("_guarded").alias("_guarded"), F.max("_cues").alias("title_cues"))
    w = Window.partitionBy("doc")
    by_rows = F.min(F.when(F.col("_guarded"), F.col("table_idx"))).over(w)
    if mode == "xpath":
        chosen = tables.withColumn("_pick", by_rows)
    else:
        # Points are null where title cues are, and then come last.
        by_points = F.first("table_idx").over(w.orderBy(F.desc("score"), "table_idx"))
        chosen = _with_score(tables).withColumn("_pick", by_points if mode == "score" else F.coalesce(by_points, by_rows))
    chosen = chosen.where("table_idx = _pick").select(*KEY, F.inline("_rows"))
    return _apart(chosen.drop("row_text"), cells.columns)


def guard_tables(cells: DataFrame) -> DataFrame:
    """doc, table_idx of the first table with a row on name that also names principal and position, or whose next row does."""
    w = Window.partitionBy(*KEY).orderBy("row_idx")
    after = F.coalesce(F.lead("row_text").over(w), F.lit(""))
    good = row_texts(cells).withColumn("_good", _guarded(F.col("row_text"), after)).where("_good")
    return good.groupBy("doc").agg(F.min("table_idx").alias("table_idx"))


def scored_tables(cells: DataFrame, chosen: DataFrame) -> DataFrame:
    """Cells of the chosen tables (doc, table_idx), as `ownership.ownership_pair` gives them."""
    return cells.join(chosen.select(*KEY), KEY, "left_semi")


def ownership_tables(cells: DataFrame, cap: int | None = None) -> DataFrame:
    """doc, table_idx of tables with an ownership row and two rows of two filled cells."""
    t = F.col("row_text")
    cue = t.contains("name") & t.contains("beneficial") & (t.contains("owner") | t.contains("address"))
    named = row_texts(cells).groupBy(*KEY).agg(F.bool_or(cue).alias("cue"))
    filled = cells.groupBy(*KEY, "row_idx").agg(F.count_if(F.trim("text") != "").alias("n")).groupBy(*KEY).agg(F.count_if(F.col("n") >= 2).alias("rows"))
    out = named.join(filled, KEY).where("cue and rows >= 2").select(*KEY)
    if cap is None:
        return out
    return out.withColumn("_rn", F.row_number().over(Window.partitionBy("doc").orderBy("table_idx"))).where(F.col("_rn") <= cap).drop("_rn")
