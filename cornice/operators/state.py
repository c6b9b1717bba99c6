"""Indexes of what is done: upserts, status precedence, worklists, merges into the master."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip
from ..session import cut

#: Fixed ranks of extraction statuses; others rank 0.
STATUS_RANK = {"extracted": 3, "skipped_existing": 2, "no_sct_found": 1}


def upsert(index: DataFrame, events: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The latest event per key over what the index has; rows without a key are left out."""
    both = index.unionByName(events, allowMissingColumns=True).dropna(subset=keys)
    w = Window.partitionBy(*keys).orderBy(F.desc_nulls_last(order))
    return both.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def upsert_fields(events: DataFrame, keys: list[str], order: str, fields: list[str]) -> DataFrame:
    """The last known value of every field per key."""
    known = [F.max_by(F.col(f), F.when(F.col(f).isNotNull(), F.col(order))).alias(f) for f in fields]
    return events.groupBy(*keys).agg(*known)


def merged_status(events: DataFrame, keys: list[str], status: str, priority: str) -> DataFrame:
    """keys, status: the highest rank, ties to the smaller priority."""
    return best_status(events, keys, status, STATUS_RANK, priority)


def pending(candidates: DataFrame, index: DataFrame, keys: list[str]) -> DataFrame:
    return candidates.join(index, keys, "left_anti")


def attach_latest(master: DataFrame, parts: DataFrame, value: str) -> DataFrame:
    """master (id, ticker ...) with parts' value by upper-case ticker; of a repeated ticker the last id has it."""
    last = master.groupBy(F.upper("ticker").alias("_t")).agg(F.max("id").alias("id"))
    put = last.join(parts.select(F.upper("ticker").alias("_t"), value), "_t").drop("_t")
    return master.drop(value).join(put, "id", "left")


def append_unseen(old: DataFrame, new: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Old rows, and new rows whose key neither old ones nor earlier new ones have."""
    both = old.withColumn("_src", F.lit(0)).unionByName(new.withColumn("_src", F.lit(1)))
    w = Window.partitionBy(*keys).orderBy("_src", order)
    return both.withColumn("_rn", F.row_number().over(w)).where("_src = 0 or _rn = 1").drop("_rn", "_src")


def uncovered(wanted: DataFrame, have: DataFrame, key: str) -> DataFrame:
    """Wanted spans (key, lo, hi) that no span in hand (key, lo, hi) contains.

    Spans are dealt by ranges of key and beginning, so a key with very many lies in
    several partitions; the farthest end so far is worked out in each, and that of the
    partitions before is carried in.  A null key is never covered.
    """
    both = wanted.select(F.struct("*").alias("_row"), key, "lo", "hi").unionByName(have.select(F.lit(None).cast(wanted.schema).alias("_row"), key, "lo", "hi"))
    # Spans in hand come before wanted ones that begin with them.
    both = both.withColumn("_wanted", F.col("_row").isNotNull())
    parted = cut(both.repartitionByRange(key, "lo", "_wanted").withColumn("_part", F.spark_partition_id()))
    end = F.when(~F.col("_wanted"), F.col("hi"))
    ends = parted.groupBy(key, "_part").agg(F.max(end).alias("_end"))
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(F.col(key).alias("_key"), "_part", F.max("_end").over(before).alias("_carried")).where("_carried is not null")
    so_far = Window.partitionBy(key, "_part").orderBy("lo", "_wanted").rowsBetween(Window.unboundedPreceding, 0)
    out = parted.withColumn("_reach", F.max(end).over(so_far)).where("_wanted")
    out = out.join(carried, (F.col(key) == F.col("_key")) & (out["_part"] == carried["_part"]), "left")
    reach = F.greatest("_reach", "_carried")
    return out.where(F.col(key).isNull() | ~F.coalesce(reach >= F.col("hi"), F.lit(False))).select("_row.*")


def best_status(events: DataFrame, keys: list[str], status: str, ranks: dict[str, int], order: str) -> DataFrame:
    """Per key the status of the highest rank, the earliest of equals; a status without a rank is 0."""
    rank = F.coalesce(F.create_map(*[F.lit(x) for kv in ranks.items() for x in kv])[F.col(status)], F.lit(0))
    return events.groupBy(*keys).agg(F.max_by(status, F.struct(rank, -F.col(order))).alias(status))


def distinct_by_prefix(df: DataFrame, keys: list[str], text: str, order: str, n: int = 200) -> DataFrame:
    """Per key and first n characters of the text the first row, and how many share them."""
    groups = df.groupBy(*keys, F.substring(text, 1, n).alias("_prefix"))
    return groups.agg(F.min(order).alias(order), F.count("*").alias("n")).drop("_prefix")


def rolled_up(df: DataFrame, levels: list[str], flags: dict[str, Column]) -> DataFrame:
    """Counts of rows, and of rows with each flag, at each level and over all."""
    return df.rollup(*levels).agg(F.count("*").alias("n"), *[F.count_if(c).alias(name) for name, c in flags.items()])


def record_fields(records: DataFrame, key: str) -> DataFrame:
    """key, pos, field, value: a row for each field of a record in order of names, its value as trimmed text, blank for null."""
    names = sorted(c for c in records.columns if c != key)
    rows = F.array(*[F.struct(F.lit(c).alias("field"), F.coalesce(strip(F.col(f"`{c}`").cast("string")), F.lit("")).alias("value")) for c in names])
    return records.select(F.col(key), F.posexplode(rows).alias("pos", "_f")).select(key, "pos", "_f.*")
