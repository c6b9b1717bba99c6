"""Choosing among tables and among columns of one name, two-row headers, payloads, and merging into a master."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.records import plain_number
from .cells import KEY
from .sequence import top_k

#: Rows of a master that are numbered together.
BUCKET = 1 << 16


def ranked_tables(scored: DataFrame, key: str, score: str, place: str, titled: str, limit: int = 2) -> DataFrame:
    """The best titled tables of a document that reach 4 points, or, where none does, the best of all that reach 6."""
    fit = F.coalesce(F.col(titled), F.lit(False)) & (F.col(score) >= 4)
    rows = scored.withColumns({"_fit": fit, "_any": F.max(fit).over(Window.partitionBy(key))})
    rows = rows.where(F.when(F.col("_any"), F.col("_fit")).otherwise(F.col(score) >= 6)).drop("_fit", "_any")
    return top_k(rows, [key], F.col(score), [place], limit)


def best_of_kinds(scored: DataFrame, key: str, score: str, kind: str, place: str, kinds: list[str], k: int = 3) -> DataFrame:
    """Of the k best tables of a document with points, by kind where these are equal, the first of each kind."""
    top = top_k(scored.where(F.col(score) > 0), [key], F.col(score), [kind, place], k)
    return top_k(top.where(F.col(kind).isin(kinds)).drop("rank"), [key, kind], F.col(score), [place], 1).drop("rank")


def _chosen(cells: DataFrame, worth: list[Column], first: str | None) -> DataFrame:
    """Of columns with one name that of the greatest worth stays, the leftmost of equals; columns without a name go.

    A table without any name keeps all its columns; of the name `first` the leftmost column stays.
    """
    found = cells.where("name IS NOT NULL").groupBy(*KEY, "name", "col_idx").agg(*[w.alias(f"_{i}") for i, w in enumerate(worth)])
    ranks = [F.when(F.col("name") == first, 0).otherwise(-F.col(f"_{i}")) if first else -F.col(f"_{i}") for i in range(len(worth))]
    best = found.groupBy(*KEY, "name").agg(F.min_by("col_idx", F.struct(*ranks, "col_idx")).alias("col_idx"))
    named = cells.join(best.drop("name"), [*KEY, "col_idx"], "left_semi")
    return named.unionByName(cells.join(best, KEY, "left_anti"))


def best_columns(cells: DataFrame) -> DataFrame:
    """Of columns with one name that with most numbers stays; of name_position the first."""
    return _chosen(cells, [F.count(plain_number(F.col("text")))], "name_position")


def consolidated_columns(cells: DataFrame) -> DataFrame:
    """Of columns with one name that with most different numbers stays, then that with more cells; without numbers, the first not empty."""
    plain = F.regexp_replace(F.regexp_replace("text", "[$,—)]", ""), r"\(", "-")
    kinds = F.count_distinct(F.trim(plain).try_cast("double"))
    full = F.count("text")
    return _chosen(cells, [kinds, F.when(kinds > 0, full).otherwise(F.least(full, F.lit(1)))], None)


def stacked_header(upper: Column, lower: Column) -> Column:
    """Two header cells as one: the lower is added unless it is blank or part of the upper."""
    a, b = F.coalesce(upper, F.lit("")), F.coalesce(lower, F.lit(""))
    return F.when((b == "") | a.contains(b), a).otherwise(F.trim(F.concat(a, F.lit(" "), b)))


def _two_row_name(old: Column, new: Column) -> Column:
    def plain(c):
        return F.lower(F.trim(F.coalesce(c, F.lit(""))))

    def blank(c):
        return c.isin("", "nan")

    a, b = plain(old), plain(new)
    return F.when((a == b) | blank(b), a).when(blank(a), b).when(a.contains(b), a).when(b.contains(a), b).otherwise(F.concat(a, F.lit("_"), b))


def with_two_row_header(cells: DataFrame) -> DataFrame:
    """Cells below row 0 with `name`, the header of their column.

    Row 1 is taken for a second header row, merged into the first and left out, if two or
    more of its cells equal a header of any column.
    """
    column, table = Window.partitionBy(*KEY, "col_idx"), Window.partitionBy(*KEY)
    at = {n: F.max(F.when(F.col("row_idx") == i, F.col("text"))).over(column) for i, n in enumerate(("_old", "_new"))}
    cells = cells.dropna(subset=[*KEY, "col_idx"]).withColumns(at | {"_head": F.min("row_idx").over(column) <= 1})
    # Each column counts once: in its first row.
    cells = cells.withColumn("_k", F.row_number().over(column.orderBy("row_idx")))
    olds = F.collect_set(F.lower("_old")).over(table)
    same = (F.col("_k") == 1) & F.col("_head") & F.array_contains("_olds", F.lower("_new"))
    cells = cells.withColumn("_olds", olds).withColumn("_merged", F.count_if(same).over(table) >= 2)
    name = F.when(F.col("_merged"), _two_row_name(F.col("_old"), F.col("_new"))).otherwise(F.col("_old"))
    rows = cells.where((F.col("row_idx") > 0) & F.col("_head") & (~F.col("_merged") | (F.col("row_idx") > 1)))
    return rows.withColumn("name", name).drop("_old", "_new", "_head", "_k", "_olds", "_merged")


def report_payloads(rows: DataFrame, keys: tuple[str, str], name: str, position: str, year: str, order: str, amounts: list[str]) -> DataFrame:
    """JSON of each report (ticker, date): executives by name and year.

    Rows without name or year are left out; of rows of one name and year the last counts;
    whole amounts are written as whole numbers.
    """
    ticker, date = keys
    who = F.trim(F.coalesce(name, F.lit("")))

    def number(c):
        return F.when(F.col(c) == F.floor(c), F.col(c).cast("long").cast("variant")).otherwise(F.col(c).cast("variant"))

    fields = F.struct(F.nullif(F.trim(position), F.lit("")).alias("position"), *[number(c).alias(c) for c in amounts])
    kept = rows.select(ticker, date, who.alias("_who"), F.col(year).cast("int").cast("string").alias("_year"), fields.alias("_f"), order)
    kept = kept.where("_who <> '' AND _year IS NOT NULL")
    years = kept.groupBy(ticker, date, "_who", "_year").agg(F.max_by("_f", order).alias("_f"))
    people = years.groupBy(ticker, date, "_who").agg(F.map_from_entries(F.collect_list(F.struct("_year", "_f"))).alias("_y"))
    reports = people.groupBy(ticker, date).agg(F.map_from_entries(F.collect_list(F.struct("_who", "_y"))).alias("executives"))
    report = F.struct(F.col(date).alias("report_date"), "executives")
    company = F.struct(F.upper(ticker).alias("ticker"), F.substring(date, 1, 4).alias("report_year"), F.array(report).alias("reports"))
    return reports.select(ticker, date, F.to_json(F.struct(company.alias("company"))).alias("json"))


def merge_into_master(master: DataFrame, found: DataFrame, order: str, key: str = "id", match: str = "ticker", source: str = "source", kept: tuple[str, ...] = ("cik_str",)) -> DataFrame:
    """Warehouse entries merged into numbered master records by ticker, in their order.

    The first record of a ticker takes the last known value of each field but the kept
    ones, and its source names the warehouse; a ticker the master lacks is appended under
    the next number, and takes later entries' values in the same way.  A null ticker
    equals a null ticker.  `order` is a whole number of its own for each entry.
    """
    fields = [c for c in found.columns if c != order]
    known = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(f"_last_{c}") for c in fields if c != match]
    new = found.groupBy(match).agg(F.min(order).alias("_at"), F.count("*").alias("_n"), F.min_by(F.struct(*fields), order).alias("_first"), *known)
    heads = master.groupBy(F.col(match).alias("_m")).agg(F.min(key).alias("_key"))
    new = new.join(heads, F.col(match).eqNullSafe(F.col("_m")), "left").drop("_m")

    def tagged(c, default):
        s = F.coalesce(F.col(f"_last_{source}"), c, F.lit(default))
        return F.when(F.lower(s).contains("wrds"), s).otherwise(F.concat(s, F.lit(", wrds")))

    hits = new.where("_key IS NOT NULL").drop(match)
    out = {}
    for c in fields:
        if c == source:
            out[c] = F.when(F.col("_n").isNull(), F.col(c)).otherwise(tagged(F.col(c), "SEC"))
        elif c not in (match, *kept):
            out[c] = F.coalesce(F.col(f"_last_{c}"), F.col(c))
    updated = master.join(hits, F.col(key) == F.col("_key"), "left").withColumns(out).select(*master.columns)

    # Numbers by buckets: only their totals meet in one task.
    extra = new.where("_key IS NULL").withColumn("_bucket", F.floor(F.col("_at") / BUCKET))
    taken = master.agg(F.lit(-(1 << 62)).cast("long").alias("_bucket"), F.coalesce(F.max(key) + 1, F.lit(0)).cast("long").alias("_size"))
    totals = taken.unionByName(extra.groupBy("_bucket").agg(F.count("*").alias("_size")))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("_bucket", F.sum("_size").over(before).alias("_before"))
    number = F.col("_before") + F.row_number().over(Window.partitionBy("_bucket").orderBy("_at")) - 1
    first = F.col("_first")
    values = {c: first[c] if c in (match, *kept) else F.col(f"_last_{c}") for c in fields}
    values[source] = F.when(F.col("_n") > 1, tagged(first[source], "SEC")).otherwise(first[source])
    extra = extra.join(totals, "_bucket").select(number.alias(key), *[values[c].alias(c) for c in fields])
    return updated.unionByName(extra, allowMissingColumns=True)


def value_map(rows: DataFrame, keys: list[str], name: str, value: str, order: str) -> DataFrame:
    """A map per key of name to the last value of that name, in order of names."""
    last = rows.groupBy(*keys, name).agg(F.max_by(value, order).alias(value))
    return last.groupBy(*keys).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(name, value)))).alias("values"))
