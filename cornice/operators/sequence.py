"""Latest rows, fills, runs and year-over-year changes by window functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order (DISTINCT ON).  Orders on descending
    dates should say desc_nulls_first(), as PostgreSQL ranks nulls above all values."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def with_blocks(df: DataFrame, keys: list[str], order: str, year: str, name: str = "block") -> DataFrame:
    """Number blocks: one begins where the year is not below the last known one; null years go on."""
    w = Window.partitionBy(*keys).orderBy(order)
    before = F.last(year, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = (F.col(year) >= before).cast("int")
    return df.withColumn(name, F.coalesce(F.sum(new).over(w.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)).cast("int"))


def fill_both(df: DataFrame, keys: list[str], order: str, columns: list[str]) -> DataFrame:
    """Forward, then backward fill of nulls within a group."""
    w = Window.partitionBy(*keys).orderBy(order)
    down = w.rowsBetween(Window.unboundedPreceding, 0)
    up = w.rowsBetween(0, Window.unboundedFollowing)
    return df.withColumns({c: F.coalesce(F.last(c, ignorenulls=True).over(down), F.first(c, ignorenulls=True).over(up)) for c in columns})


def tenure(df: DataFrame, keys: list[str], year: str) -> DataFrame:
    """keys, year, became, tenure: runs of consecutive years, counted from 0 at the start of each."""
    rows = df.select(*keys, year).distinct()
    w = Window.partitionBy(*keys).orderBy(year)
    rows = rows.withColumn("_island", F.col(year) - F.row_number().over(w))
    start = F.min(year).over(Window.partitionBy(*keys, "_island"))
    return rows.withColumn("became", start).withColumn("tenure", F.col(year) - F.col("became")).drop("_island")


def members_per_year(df: DataFrame, group: str, year: str, member: str) -> DataFrame:
    return df.groupBy(group, year).agg(F.countDistinct(member).alias("members"))


def turnover(df: DataFrame, group: str, year: str, member: str) -> DataFrame:
    """group, year, n_new, n_departed against the previous year on record; null names count as one name, nan."""
    named = df.where(F.col(group).isNotNull() & F.col(year).isNotNull())
    rows = named.select(group, year, F.coalesce(F.col(member).cast("string"), F.lit("nan")).alias("_m")).distinct()
    order = Window.partitionBy(group).orderBy(year)
    years = rows.select(group, year).distinct().withColumn("_prev", F.lag(year).over(order)).withColumn("_next", F.lead(year).over(order))
    own = Window.partitionBy(group, "_m").orderBy(year)
    rows = rows.withColumn("_was", F.lag(year).over(own)).withColumn("_is", F.lead(year).over(own)).join(years, [group, year])
    new = F.col("_prev").isNotNull() & ~F.col("_was").eqNullSafe(F.col("_prev"))
    gone = F.col("_next").isNotNull() & ~F.col("_is").eqNullSafe(F.col("_next"))
    # A member that leaves after a year counts in the next year on record.
    marks = rows.select(group, F.explode(F.array(F.struct(F.col(year).alias("y"), new.cast("int").alias("n"), F.lit(0).alias("d")), F.struct(F.col("_next").alias("y"), F.lit(0).alias("n"), gone.cast("int").alias("d")))).alias("x"))
    found = marks.where("x.y is not null").groupBy(group, F.col("x.y").alias(year)).agg(F.sum("x.n").cast("int").alias("n_new"), F.sum("x.d").cast("int").alias("n_departed"))
    return found.join(years.where("_prev is not null").select(group, year), [group, year], "left_semi")


def concat_distinct(df: DataFrame, keys: list[str], order: str, value: str, sep: str = " | ") -> DataFrame:
    """keys, joined: distinct non-blank values in row order."""
    # Repeats go before anything is gathered.
    once = df.groupBy(*keys, F.when(F.trim(value) != "", F.trim(value)).alias("_v")).agg(F.min(order).alias("_o"))
    pairs = F.sort_array(F.collect_list(F.when(F.col("_v").isNotNull(), F.struct("_o", "_v"))))
    return once.groupBy(*keys).agg(F.array_join(F.transform(pairs, lambda x: x["_v"]), sep).alias("joined"))


def top_k(df: DataFrame, keys: list[str], score: Column, tie: list[str], k: int, least: Column | None = None) -> DataFrame:
    """The k best rows of each key, ties by the tie columns, below `least` none."""
    w = Window.partitionBy(*keys).orderBy(score.desc(), *tie)
    out = df if least is None else df.where(score >= least)
    return out.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def until_total(df: DataFrame, keys: list[str], order: list[str], amount: str, limit: int) -> DataFrame:
    """Rows taken one by one until the total reached before a row is at least limit."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("_before", F.coalesce(F.sum(amount).over(w), F.lit(0))).where(F.col("_before") < limit).drop("_before")
