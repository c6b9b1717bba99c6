"""Mixing sources to target weights, in DataFrame functions only.

Every document gets a hash-random key.  Within a source, documents are thought
of as sorted by that key; a source with a budget takes whole epochs of all its
documents and then the documents before the point where the running total of
words meets the rest of the budget.  That point is found by a prefix sum in two
levels: totals of key ranges first, then the documents of the one range that
holds the cut.  A hot source has many ranges, so no task holds a whole source.
What is known of the sources meets the documents by broadcast up to PLAN_ROWS
sources, counted first; of more, each source's row is repeated for SALTS salts
and documents draw one, so that a hot source's rows go to many tasks.  Ranks and
running totals over more than PLAN_ROWS sources come from range partitions.

Definitions
-----------
size      number of words, runs of characters other than space and U+0009-U+000D;
          a null text has size 0
sources   in code point order, null last, weigh 1, 2, 3, 1, 2, 3, ...
target    the source's share by weight of all sizes, at most MAX_EPOCHS times the
          source's size; what that cuts off is shared among the others by weight
ties      rows of a source with one key (a repeated doc_id) at the cut share what
          is left of the budget by size, rounded down
null ids  count as an empty id
others    an empty table gives no rows; repeated rows are documents each; columns
          of any name pass through mix() untouched
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import materialize, tasks_for

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
#: Documents of a source that one key range holds on average.
RANGE_ROWS = 4096
#: Sources whose plan is broadcast and ranked in one task; beyond, salts and range partitions.
PLAN_ROWS = 100_000
SALTS = 64


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def key_of(doc_id: Column, seed: str) -> Column:
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(seed)))


def _running(df: DataFrame, order: list[Column], sums: dict[str, Column], few: bool) -> DataFrame:
    """df with, for each name of sums, the sum of its column over all rows before a row, and `_i`, the row's place from 1."""
    spark = df.sparkSession
    if few:
        rows = df.repartition(1).withColumn("_part", F.lit(0))
    else:
        rows = df.repartitionByRange(tasks_for(spark, 1, 1), *order).withColumn("_part", F.spark_partition_id())
        rows = materialize(rows, "mix-ranks")
    inside = Window.partitionBy("_part").orderBy(*order)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    out = rows.withColumns({n: F.coalesce(F.sum(c).over(before), zero) for n, c in sums.items()}).withColumn("_i", F.row_number().over(inside).cast("long"))
    if not few:
        # A row for each partition.
        totals = rows.groupBy("_part").agg(F.count("*").alias("_rows"), *[F.sum(c).alias(f"_in{n}") for n, c in sums.items()])
        earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        starts = totals.select("_part", F.coalesce(F.sum("_rows").over(earlier), zero).alias("_rows0"), *[F.coalesce(F.sum(f"_in{n}").over(earlier), zero).alias(f"_0{n}") for n in sums])
        out = out.join(F.broadcast(starts), "_part").withColumns({n: F.col(n) + F.col(f"_0{n}") for n in sums}).withColumn("_i", F.col("_i") + F.col("_rows0"))
        out = out.drop("_rows0", *[f"_0{n}" for n in sums])
    return out.drop("_part")


def source_targets(sized: DataFrame) -> DataFrame:
    """One row per source: _source, n_docs, source_size, target.

    sized has _source and _size.
    """
    per = materialize(sized.groupBy("_source").agg(F.count("*").alias("n_docs"), F.sum("_size").alias("source_size")), "mix-sources")
    few = per.count() <= PLAN_ROWS
    by_name = F.col("_source").asc_nulls_last()
    per = _running(per, [by_name], {}, few)
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.pmod(F.col("_i") - 1, F.lit(len(WEIGHTS))) + 1).cast("int"))
    per = per.withColumn("_w", weight.cast("long")).withColumn("_cap", F.col("source_size") * MAX_EPOCHS)
    # Sources meet their caps in the order of cap by weight; those before the k-th are full when it is looked at.
    per = _running(per, [(F.col("_cap").cast("double") / F.col("_w")).asc(), by_name], {"_capped": F.col("_cap"), "_wcapped": F.col("_w")}, few)
    size, weights = per.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("_w"), F.lit(0))).first()
    per = per.withColumn("_left", F.lit(size) - F.col("_capped")).withColumn("_wleft", F.lit(weights) - F.col("_wcapped"))
    full = F.col("_left").cast("double") * F.col("_w") >= F.col("_cap").cast("double") * F.col("_wleft")
    per = materialize(per.withColumn("_full", full), "mix-levels")
    # The first source that isn't full fixes the level for itself and all after it.
    level = per.agg(F.min(F.when(~F.col("_full"), F.struct("_i", "_left", "_wleft")))).first()[0]
    target = F.col("_cap").cast("double")
    if level:
        shared = F.lit(float(level["_left"])) * F.col("_w") / F.lit(level["_wleft"])
        target = F.when(F.col("_i") < level["_i"], target).otherwise(shared)
    return per.select("_source", "n_docs", "source_size", target.alias("target"))


def _with_source(rows: DataFrame, per_source: DataFrame, few: bool, cols: list[str]) -> DataFrame:
    """rows (with _source and _key) joined with the one row of per_source that each source has: r.* and s.* in cols."""
    same = F.col("r._source").eqNullSafe(F.col("s._source"))
    if few:
        return rows.alias("r").join(F.broadcast(per_source).alias("s"), same).select(*cols)
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("_key"), F.lit(SALTS)))
    spread = per_source.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return salted.alias("r").join(spread.alias("s"), same & (F.col("r._salt") == F.col("s._salt"))).select(*cols)


def plan_mix(sized: DataFrame) -> DataFrame:
    """One row per source: where its budget cuts.

    sized has _source, _key and _size.  Fields of the result besides those of
    source_targets: epochs (whole passes), cut_key, cut_size and cut_rest: rows
    with a smaller key are taken once more, rows with cut_key share cut_rest.
    """
    targets = materialize(source_targets(sized), "mix-targets")
    few = targets.count() <= PLAN_ROWS
    budget = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    targets = targets.withColumn("epochs", epochs).withColumn("_rest", budget - F.col("epochs") * F.col("source_size"))
    # A range is the first 32 bits of the key, scaled to the number of ranges of the source.
    share = F.conv(F.substring("_key", 1, 8), 16, 10).cast("long") / F.lit(float(2**32))
    ranges = F.ceil(F.col("n_docs") / F.lit(RANGE_ROWS))
    cols = ["r._key", "r._size", "s._source", "s.n_docs", "s._rest"]
    ranged = _with_source(sized, targets, few, cols).withColumn("_range", F.floor(share * ranges).cast("long"))
    totals = ranged.groupBy("_source", "_range").agg(F.sum("_size").alias("_total"), F.first("_rest").alias("_rest"))
    run = Window.partitionBy("_source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("_before", F.coalesce(F.sum("_total").over(run), F.lit(0)))
    cut = totals.where((F.col("_before") <= F.col("_rest")) & (F.col("_rest") < F.col("_before") + F.col("_total"))).select("_source", "_range", "_before")
    # One range of each source at most.
    cut = F.broadcast(cut) if few else cut
    inside = ranged.alias("r").join(cut.alias("c"), F.col("r._source").eqNullSafe(F.col("c._source")) & (F.col("r._range") == F.col("c._range")))
    inside = inside.groupBy("r._source", "r._key").agg(F.sum("r._size").alias("_total"), F.first("r._rest").alias("_rest"), F.first("c._before").alias("_before"))
    run = Window.partitionBy("_source").orderBy("_key").rowsBetween(Window.unboundedPreceding, -1)
    inside = inside.withColumn("_start", F.col("_before") + F.coalesce(F.sum("_total").over(run), F.lit(0)))
    found = inside.where((F.col("_start") <= F.col("_rest")) & (F.col("_rest") < F.col("_start") + F.col("_total")))
    found = found.select(F.col("_source"), F.col("_key").alias("cut_key"), F.col("_total").alias("cut_size"), (F.col("_rest") - F.col("_start")).alias("cut_rest"))
    out = targets.alias("t").join(found.alias("f"), F.col("t._source").eqNullSafe(F.col("f._source")), "left")
    names = ("source_size", "target", "epochs")
    return out.select("t._source", *[f"t.{n}" for n in names], "f.cut_key", "f.cut_size", "f.cut_rest")


def apply_mix(keyed: DataFrame, plan: DataFrame) -> DataFrame:
    """keyed (_row, _source, _key and _size) with source_size, target and taken instead of _source and _key."""
    plan = materialize(plan, "mix-plan")
    cols = ["r._row", "r._size", "r._key", "s.source_size", "s.target", "s.epochs", "s.cut_key", "s.cut_size", "s.cut_rest"]
    joined = _with_source(keyed, plan, plan.count() <= PLAN_ROWS, cols)
    more = (
        F.when(F.col("cut_key").isNull(), F.lit(0))
        .when(F.col("_key") < F.col("cut_key"), F.col("_size"))
        .when(F.col("_key") == F.col("cut_key"), F.floor(F.col("cut_rest") * F.col("_size") / F.col("cut_size")))
        .otherwise(F.lit(0))
    )
    taken = (F.col("epochs") * F.col("_size") + more).cast("long")
    return joined.select("_row", "_size", "source_size", "target", taken.alias("taken"))


def _keyed(docs: DataFrame, keep: list[str], seed: str, doc_id: str, source: str, text: str) -> DataFrame:
    """The columns keep as one struct, so that no name of theirs clashes, and what the mix works on."""
    name = lambda c: F.col(f"`{c}`")
    return docs.select(F.struct(*map(name, keep)).alias("_row"), name(source).alias("_source"), key_of(name(doc_id), seed).alias("_key"), size_of(name(text)).alias("_size"))


def mix_report(docs: DataFrame, seed: str = ":mix", doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken."""
    sized = materialize(_keyed(docs, [doc_id], seed, doc_id, source, text), "mix-sizes")
    out = apply_mix(sized, plan_mix(sized))
    return out.select(F.col("_row")[doc_id].alias(doc_id), F.col("_size").alias("size"), "source_size", "target", "taken")


def mix(docs: DataFrame, seed: str = ":mix", doc_id: str = "doc_id", source: str = "source", text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """The mixed corpus in the columns of docs: a row per copy that the mix takes.

    A document taken more than once is repeated; the one that a budget cuts
    gives a last copy that holds the words before the cut.  A document without
    words isn't taken.
    """
    names = docs.columns
    keyed = _keyed(docs, names, seed, doc_id, source, text)
    plan = plan_mix(materialize(keyed.select("_source", "_key", "_size"), "mix-sizes"))
    out = apply_mix(keyed, plan)
    copies = F.ceil(F.col("taken") / F.col("_size")).cast("int")
    out = out.where(F.col("taken") > 0).withColumn("_copy", F.explode(F.sequence(F.lit(1), copies)))
    part = F.least(F.col("_size"), F.col("taken") - (F.col("_copy") - 1) * F.col("_size")).cast("int")
    old = lambda c: F.col("_row")[c]
    # The words before the cut with the white space among them.
    head = F.rtrim(F.array_join(F.slice(F.regexp_extract_all(old(text), F.lit(r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+)"), F.lit(1)), F.lit(1), part), ""))
    put = {text: F.when(part < F.col("_size"), head).otherwise(old(text))}
    if n_chars and n_chars in names:
        put[n_chars] = F.when(part < F.col("_size"), F.length(head).cast(docs.schema[n_chars].dataType)).otherwise(old(n_chars))
    return out.select(*[put.get(c, old(c)).alias(c) for c in names])


#: DuckDB SQL for mix_report() over documents.
MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '') || ':mix') AS k
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
  FROM d GROUP BY source
), r AS (
  SELECT *, source_size * 3 AS cap, sum(source_size) OVER () AS total, sum(w) OVER () AS wsum,
         row_number() OVER o AS i,
         coalesce(sum(source_size * 3) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
         coalesce(sum(w) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS wcapped
  FROM s WINDOW o AS (ORDER BY (source_size * 3)::DOUBLE / w, source NULLS LAST)
), f AS (
  SELECT *, (total - capped)::DOUBLE AS rest, (wsum - wcapped)::DOUBLE AS wrest FROM r
), l AS (
  SELECT i AS li, rest AS lrest, wrest AS lw FROM f WHERE rest * w < cap::DOUBLE * wrest ORDER BY i LIMIT 1
), t AS (
  SELECT source, source_size,
         CASE WHEN li IS NULL OR i < li THEN cap::DOUBLE ELSE lrest * w / lw END AS target
  FROM f LEFT JOIN l ON true
), b AS (
  SELECT *, round(target)::BIGINT AS budget,
         CASE WHEN source_size > 0 THEN round(target)::BIGINT // source_size ELSE 0 END AS epochs
  FROM t
), g AS (
  SELECT d.source, k, sum(size) AS ksize FROM d GROUP BY d.source, k
), p AS (
  SELECT *, sum(ksize) OVER (PARTITION BY source ORDER BY k) - ksize AS start FROM g
)
SELECT d.doc_id, d.size, b.source_size, b.target,
       (b.epochs * d.size + CASE WHEN p.ksize = 0 THEN 0 ELSE
          greatest(0, least(p.ksize, b.budget - b.epochs * b.source_size - p.start)) * d.size // p.ksize END)::BIGINT AS taken
FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source
       JOIN p ON d.source IS NOT DISTINCT FROM p.source AND d.k = p.k
"""
