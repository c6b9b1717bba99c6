"""Comparing tables and checking sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import close_to


def compare(a: DataFrame, b: DataFrame, key: list[str], columns: list[str], samples: int = 5) -> DataFrame:
    """column, mismatches, samples: rows joined on key; numbers within tolerance, two nulls of other types differ."""
    j = a.select(*key, *[F.col(c).alias(f"a_{c}") for c in columns]).join(b.select(*key, *[F.col(c).alias(f"b_{c}") for c in columns]), key, "full")
    kinds = dict(a.dtypes)

    def same(c: str):
        x, y = F.col(f"a_{c}"), F.col(f"b_{c}")
        if kinds[c] in ("double", "float"):
            return close_to(x, y)
        return F.coalesce(x == y, F.lit(False))

    # One row of counts, and the first keys of differing cells only.
    counts = j.agg(*[F.count_if(~same(c)).alias(f"n{i}") for i, c in enumerate(columns)])
    counts = counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("mismatches")) for i, c in enumerate(columns)])).alias("x")).select("x.*")
    wrong = F.array(*[F.when(~same(c), F.lit(c)) for c in columns])
    rows = j.select(F.concat_ws("|", *[F.col(k).cast("string") for k in key]).alias("k"), F.explode(F.filter(wrong, lambda c: c.isNotNull())).alias("column"))
    first = rows.withColumn("_i", F.row_number().over(Window.partitionBy("column").orderBy("k"))).where(F.col("_i") <= samples)
    first = first.groupBy("column").agg(F.sort_array(F.collect_set("k")).alias("samples"))
    return counts.join(first, "column", "left").withColumn("samples", F.coalesce("samples", F.array().cast("array<string>")))


def schema_diff(a: DataFrame, b: DataFrame) -> dict[str, list[str]]:
    """Columns that one side lacks, and those of different types."""
    x, y = dict(a.dtypes), dict(b.dtypes)
    return {"missing": [c for c in x if c not in y], "extra": [c for c in y if c not in x], "types": [c for c in x if c in y and x[c] != y[c]]}


def sum_flags(df: DataFrame, parts: list[str], total: str, tolerance: float = 5.0) -> DataFrame:
    """total_calc, total_diff, total_ok: parts, missing ones 0, against the total; an unknown difference isn't ok."""
    calc = sum((F.coalesce(F.col(c), F.lit(0.0)) for c in parts), F.lit(0.0))
    diff = calc - F.col(total)
    return df.withColumn("total_calc", calc).withColumn("total_diff", diff).withColumn("total_ok", F.coalesce(F.abs(diff) <= tolerance, F.lit(False)))


def share(test: Column) -> Column:
    """Share of a group's rows that pass; null counts as not."""
    return F.avg(F.when(test, 1.0).otherwise(0.0))


def coverage(df: DataFrame, tests: dict[str, Column]) -> DataFrame:
    """Percentage of rows that pass each test, to four places."""
    return df.agg(*[F.round(share(c) * 100, 4).alias(name) for name, c in tests.items()])
