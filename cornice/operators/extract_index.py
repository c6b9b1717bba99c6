"""The index of extracted filings: what each record says of a filing, folded into one entry, and counts over the entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEYS = ["ticker", "form", "report_date"]
#: Fixed fields that each kind of record sets, null or not.
ALWAYS = {
    "csv": ["status", "csv_relpath", "csv_rows", "csv_cols"],
    "bo": ["status", "bo_html_relpaths"],
    "txt": ["status", "txt_relpath", "snippet_chars"],
    "status": ["status"],
}
#: Fixed fields that a record sets if it has them.
IF_GIVEN = ["csv_columns", "normalized", "deduped_cols", "parquet_relpath", "source_html_relpath", "source_txt_relpath", "source_relpath"]
#: The kind of what the index holds already: it sets the fields that it has.
HELD = "held"


def _sets(field: str) -> Column:
    kinds = [k for k, fields in ALWAYS.items() if field in fields]
    return F.col("kind").isin(*kinds) | F.col(field).isNotNull()


def folded_entries(records: DataFrame, order: str = "at") -> DataFrame:
    """One entry per filing: of each field the value of the last record that sets it, and when the last record came.

    Records without a ticker, form or date are left out; fields that no record has may
    lack.  A partial aggregate of one value a field, so a filing with very many records
    costs no more memory than one with few.
    """
    fields = [c for c in records.columns if c in IF_GIVEN or any(c in f for f in ALWAYS.values())]
    last = [F.max_by(F.struct(f), F.when(_sets(f), F.col(order)))[f].alias(f) for f in fields]
    return records.dropna(subset=KEYS).groupBy(*KEYS).agg(*last, F.max(order).alias(order))


def fold_into(entries: DataFrame, records: DataFrame, order: str = "at") -> DataFrame:
    """Entries brought up to date by later records; what is held counts as older than any of them."""
    held = entries.select("*", F.lit(HELD).alias("kind"), F.struct(F.lit(0).alias("_new"), order).alias("_at")).drop(order)
    new = records.select("*", F.struct(F.lit(1).alias("_new"), order).alias("_at")).drop(order)
    both = folded_entries(held.unionByName(new, allowMissingColumns=True), "_at")
    return both.withColumn(order, F.col("_at")[order]).drop("_at")


def entry_counts(entries: DataFrame) -> DataFrame:
    """ticker, form, n_entries and numbers of files by kind: for each form of a ticker, each ticker (form null), and all (both null).

    A blank path counts as none.
    """
    has = lambda c: (F.coalesce(F.col(c), F.lit("")) != "") if c in entries.columns else F.lit(False)
    holders = F.sum(F.coalesce(F.size("bo_html_relpaths"), F.lit(0))) if "bo_html_relpaths" in entries.columns else F.sum(F.lit(0))
    counts = [F.count_if(has(f"{k}_relpath")).alias(f"count_{k}") for k in ("csv", "txt", "parquet")]
    return entries.rollup("ticker", "form").agg(F.count("*").alias("n_entries"), *counts, F.coalesce(holders, F.lit(0)).cast("long").alias("count_bo"))
