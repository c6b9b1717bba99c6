"""Headers that take several rows of a table, on long cells (doc, table_idx, row_idx, col_idx, text)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.headers import any_of
from ..functions.text import squeeze, strip
from .cells import KEY

#: Fixed words of headers: those that a column of a run of rows shows, and those of one row.
RUN_WORDS = ["name", "principal", "position", "year", "salary", "bonus", "stock", "option", "non-equity", "non equity", "pension", "deferred", "all other", "total"]
ROW_WORDS = [
    "name", "principal", "position", "salary", "bonus", "total", "stock", "option", "non-equity", "non equity", "incentive", "pension",
    "all other", "compensation", "awards", "cash", "year",
]


def _shown(c: Column) -> Column:
    return F.lower(F.coalesce(c, F.lit("")))


def numbered_rows(cells: DataFrame) -> DataFrame:
    """cells with `_r`, the place of their row in its table from 1; rows without any cell don't count."""
    return cells.withColumn("_r", F.dense_rank().over(Window.partitionBy(*KEY).orderBy("row_idx")))


def without_number_rows(cells: DataFrame, max_rows: int) -> DataFrame:
    """Cells below the leading rows, max_rows at most, of which every filled cell is digits alone."""
    t = strip(F.col("text"))
    rows = numbered_rows(cells).groupBy(*KEY, "_r").agg((F.bool_and(F.when(t != "", t.rlike(r"(?U)^\d+$")))).alias("_digits"))
    other = rows.where(~F.coalesce("_digits", F.lit(False))).groupBy(*KEY).agg(F.min("_r").alias("_first"))
    numbered = numbered_rows(cells).join(other, KEY, "left")
    # A table of such rows alone has no other one.
    return numbered.where((F.col("_r") > max_rows) | (F.col("_r") >= F.col("_first"))).drop("_r", "_first")


def best_header_row(cells: DataFrame, max_rows: int = 6) -> DataFrame:
    """doc, table_idx, row_idx, score: of the first rows the one with most words, ties to the first."""
    top = numbered_rows(cells).where(F.col("_r") <= max_rows)
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("col_idx", _shown(F.col("text")).alias("t")))), lambda x: x["t"])
    rows = top.groupBy(*KEY, "row_idx").agg(F.array_join(ordered, " ").alias("_text"))
    score = sum((F.col("_text").contains(w).cast("int") for w in ROW_WORDS), F.lit(0))
    return rows.groupBy(*KEY).agg(F.max_by(F.struct("row_idx", score.alias("score")), F.struct(score, -F.col("row_idx"))).alias("_b")).select(*KEY, "_b.row_idx", "_b.score")


def header_runs(cells: DataFrame, max_rows: int) -> DataFrame:
    """doc, table_idx, k, col_idx, head, score of every run of the first 1 to max_rows rows.

    head is a column's cells of the run, joined; score the number of columns whose head
    has a word.  Each run adds a row to the one before, so heads are running lists.
    """
    top = numbered_rows(cells).where(F.col("_r") <= max_rows)
    columns = cells.select(*KEY, "col_idx").distinct()
    grid = top.select(*KEY, "_r").distinct().join(columns, KEY)
    grid = grid.join(top.select(*KEY, "_r", "col_idx", "text"), [*KEY, "_r", "col_idx"], "left")
    so_far = Window.partitionBy(*KEY, "col_idx").orderBy("_r").rowsBetween(Window.unboundedPreceding, 0)
    runs = grid.withColumn("head", F.array_join(F.collect_list(F.coalesce("text", F.lit(""))).over(so_far), " "))
    hit = any_of(F.lower("head"), RUN_WORDS).cast("int")
    scores = runs.groupBy(*KEY, "_r").agg(F.sum(hit).alias("score"))
    return runs.join(scores, [*KEY, "_r"]).select(*KEY, F.col("_r").alias("k"), "col_idx", "head", "score")


def with_header_run(cells: DataFrame, max_rows: int) -> DataFrame:
    """Cells below a table's best run of header rows, with `name`, its column's head; ties to the shortest run.

    Bracketed notes leave the name, and white space is squeezed.
    """
    runs = header_runs(cells, max_rows)
    best = runs.groupBy(*KEY).agg(F.max_by("k", F.struct("score", -F.col("k"))).alias("_k"))
    plain = strip(squeeze(F.replace("head", F.lit("\u00a0"), F.lit(" "))))
    names = runs.join(best, KEY).where("k = _k").select(*KEY, "col_idx", "_k", strip(squeeze(F.regexp_replace(plain, r"\([^)]*\)", ""))).alias("name"))
    body = numbered_rows(cells).join(names, [*KEY, "col_idx"])
    return body.where(F.col("_r") > F.col("_k")).drop("_r", "_k")


def scored_header_rows(cells: DataFrame, max_rows: int) -> DataFrame:
    """doc, table_idx, k, score: how many rows are the header, at 10 points a cell with a word and 5 for four columns."""
    numbered = numbered_rows(cells)
    wide = cells.groupBy(*KEY).agg((F.count_distinct("col_idx") >= 4).alias("_wide"))
    rows = numbered.where(F.col("_r") <= max_rows).groupBy(*KEY, "_r").agg(F.count_if(any_of(_shown(F.col("text")), RUN_WORDS)).alias("_n"))
    so_far = Window.partitionBy(*KEY).orderBy("_r").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_n", F.sum("_n").over(so_far)).join(wide, KEY)
    score = (F.col("_n") * 10 + F.when(F.col("_wide"), 5).otherwise(0)).alias("score")
    return rows.groupBy(*KEY).agg(F.max_by(F.struct(F.col("_r").alias("k"), score), F.struct("_n", -F.col("_r"))).alias("_b")).select(*KEY, "_b.k", "_b.score")
