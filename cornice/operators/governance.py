"""Combining governance tables by year, mapping universes, and totals of runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .sequence import latest_per_key, top_k


def chief_rows(df: DataFrame, flag: str, value: str, columns: list[str]) -> DataFrame:
    """Distinct columns of the rows whose flag is exactly the value."""
    return df.where(F.col(flag) == value).select(*columns).distinct()


def first_values(df: DataFrame, keys: list[str], order: str, columns: list[str]) -> DataFrame:
    """Per key the columns of its first row, null or not."""
    return df.groupBy(*keys).agg(F.min_by(F.struct(*columns), order).alias("_first")).select(*keys, "_first.*")


def combined_years(directors: DataFrame, turnover: DataFrame, chiefs: DataFrame, keys: list[str], order: str) -> DataFrame:
    """A row for each key that directors or chiefs have, with the first match of each table.

    keys name the company and the year; `order` is the place of a row in its table.
    """
    sides = []
    for side in (directors, turnover, chiefs):
        sides.append(first_values(side, keys, order, [c for c in side.columns if c not in (*keys, order)]))
    return sides[0].join(sides[2], keys, "full").join(sides[1], keys, "left")


def strict_blocks(df: DataFrame, keys: list[str], order: str, year: str, name: str, out: str = "block") -> DataFrame:
    """Number blocks by the older rule: one begins where the year exceeds the last known one, or where a
    name without a year follows a year without a name."""
    w = Window.partitionBy(*keys).orderBy(order)
    before = F.last(year, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    unnamed = F.coalesce(F.lag(name).over(w), F.lit("")) == ""
    named = F.coalesce(F.col(name), F.lit("")) != ""
    new = F.coalesce(F.col(year) > before, F.lit(False)) | (F.col(year).isNull() & named & F.lag(year).over(w).isNotNull() & unnamed)
    marked = df.withColumn("_new", new.cast("int"))
    return marked.withColumn(out, F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int")).drop("_new")


def mapped_universe(listed: DataFrame, warehouse: DataFrame, order: str) -> DataFrame:
    """cik, ticker, company_name, permno, gvkey, cusip of all listed companies and of warehouse rows without one.

    The last warehouse row of a ticker gives a listed company its identifiers;
    others have the key WRDS_<gvkey>, or WRDS_<permno> without one, of which the last row stays.
    """
    ids = ["permno", "gvkey", "cusip"]
    upper = warehouse.withColumn("_t", F.upper("ticker"))
    last = upper.groupBy("_t").agg(F.max_by(F.struct(*ids), order).alias("_ids"))
    known = listed.withColumn("_t", F.upper("ticker")).join(last, "_t", "left").select("cik", "ticker", "company_name", *[F.col("_ids")[c].cast("string").alias(c) for c in ids])
    rest = upper.join(listed.select(F.upper("ticker").alias("_t")).distinct(), "_t", "left_anti")
    rest = rest.withColumn("cik", F.concat(F.lit("WRDS_"), F.coalesce(F.col("gvkey").cast("string"), F.col("permno").cast("string"))))
    kept = rest.groupBy("cik").agg(F.max_by(F.struct("ticker", "company_name", *[F.col(c).cast("string").alias(c) for c in ids]), order).alias("_r"))
    return known.unionByName(kept.select("cik", "_r.*"))


def share_universe(stocks: DataFrame, code: str, equity_only: bool = True) -> DataFrame:
    """Common shares (codes 10 and 11), or all."""
    return stocks.where(F.col(code).isin(10, 11)) if equity_only else stocks


def run_totals(stats: DataFrame, key: str, order: list[str], amounts: list[str]) -> DataFrame:
    """One row: how many keys there are, and the sums over the latest row of each, so that a rerun doesn't count twice."""
    last = latest_per_key(stats, [key], [F.col(c).desc_nulls_last() for c in order])
    return last.agg(F.count("*").alias("keys"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in amounts])


def audit(df: DataFrame, category: str, path: str, n: int) -> DataFrame:
    """category, files, sample: how many there are, and the first n paths."""
    counts = df.groupBy(category).agg(F.count("*").alias("files"))
    w = Window.partitionBy(category).orderBy(path)
    first = df.select(category, path).withColumn("_i", F.row_number().over(w)).where(F.col("_i") <= n)
    sample = first.groupBy(category).agg(F.sort_array(F.collect_list(path)).alias("sample"))
    return counts.join(sample, category, "left")


def best_sibling(texts: DataFrame, pages: DataFrame, keys: list[str], score: str, name: str) -> DataFrame:
    """Every text with the page of its folder and date that scores best, ties to the first name; texts without one are left out."""
    best = top_k(pages, keys, F.col(score), [name], 1).drop("rank")
    return texts.join(best, keys)


def without_symbol_columns(cells: DataFrame, empty_too: bool = False) -> DataFrame:
    """Cells (doc, table_idx, col_idx, text) of columns that hold more than $ and dashes.

    empty_too: columns without any text go as well; else they stay.
    """
    text = F.regexp_replace(F.coalesce("text", F.lit("")), r"(?U)\s", "")
    w = Window.partitionBy("doc", "table_idx", "col_idx")
    symbols = F.min((text == "") | text.rlike("^[$—–-]+$")).over(w)
    blank = F.min(text == "").over(w)
    gone = symbols if empty_too else symbols & ~blank
    return cells.withColumn("_gone", gone).where(~F.col("_gone")).drop("_gone")
