"""Which tables of a page list beneficial owners: thirteen features a table, a score, and one of two kinds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.headers import any_of
from ..functions.nodes import contents, elements, folded, tables_of

#: Fixed words of ownership, of management, and of tables on equity plans.
OWNERSHIP_WORDS = [
    "beneficial", "beneficially", "ownership", "owned", "shares", "common stock", "percent", "class", "outstanding", "undiluted",
    "fully diluted", "principal", "stockholder", "stockholders", "security ownership",
]
MANAGEMENT_WORDS = ["management", "director", "directors", "executive officer", "executive officers", "named executive", "officers", "as a group"]
NEGATIVE_WORDS = [
    "option awards", "exercise price", "vesting", "plan-based awards", "outstanding equity", "equity compensation plan",
    "securities authorized for issuance", "rsu vest",
]
TOTAL_WORDS = ["total", "as a group", "officers and directors", "directors and executive officers"]
#: Fixed phrases that settle the kind, in this order.
KIND_PHRASES = [
    ("security ownership of management", "management"),
    ("stock ownership of directors", "management"),
    ("directors and executive officers", "management"),
    ("security ownership of beneficial owner", "beneficial_owner"),
    ("certain beneficial owners", "beneficial_owner"),
]
#: Fixed patterns of shares, percents and addresses.
SHARES = r"(?U)\b\d{1,3}(?:,\d{3})+\b|\b\d{6,}\b"
PERCENT = r"(?U)\b\d{0,3}(?:\.\d+)?\s*%"
NUMBER = r"(?U)^\d{0,3}(?:\.\d+)?$"
ADDRESS = r"(?U),|\b[a-z]{2}\s+\d{5}\b|\b(po box|suite|street|st\.|avenue|ave\.|road|rd\.|boulevard|blvd)\b|address"

FEATURES = (
    "col_count_med", "row_count", "pct_rows", "share_rows", "star_rows", "total_rows", "addr_like_rows",
    "ownership_hits", "management_hits", "negative_hits", "first_col_avg_len", "other_cols_avg_len",
)


def _hits(text: Column, words: list[str]) -> Column:
    return sum((text.contains(w).cast("int") for w in words), F.lit(0))


def row_signals(nodes: DataFrame, key: str) -> DataFrame:
    """key, row, and what its filled cells show: width, percent, shares, star, total, address, lengths of the first and the others."""
    text = contents(nodes, key, "td", "th", between=" ").withColumn("content", folded(F.col("content"))).where("content <> ''")
    cells = elements(nodes, "td", "th").select(key, F.col("parent").alias("row"), "pos").join(text, [key, "pos"])
    filled = cells.groupBy(key, "row").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "content"))), lambda x: x["content"]).alias("c"))
    whole = contents(nodes, key, "tr", between=" ").select(key, F.col("pos").alias("row"), folded(F.col("content")).alias("text"))
    rows = elements(nodes, "tr").select(key, F.col("pos").alias("row"), "inside").join(filled, [key, "row"], "left").join(whole, [key, "row"], "left")
    c = F.col("c")
    rest = F.slice(c, F.lit(2), F.greatest(F.size(c) - 1, F.lit(0)))
    star = F.exists(rest, lambda x: x == "*")
    split = F.exists(F.arrays_zip(c.alias("a"), rest.alias("b")), lambda x: F.coalesce(x["a"].rlike(NUMBER) & (x["b"] == "%"), F.lit(False)))
    first, others = F.get(c, F.lit(0)), F.array_join(rest, " ")
    return rows.select(
        key,
        "row",
        "inside",
        F.size(c).alias("width"),
        (F.exists(c, lambda x: x.rlike(PERCENT)) | split | star).alias("percent"),
        F.exists(c, lambda x: x.rlike(SHARES)).alias("shares"),
        star.alias("star"),
        (c.isNotNull() & any_of(F.col("text"), TOTAL_WORDS)).alias("total"),
        first.rlike(ADDRESS).alias("address"),
        F.length(first).alias("first_len"),
        F.when(F.size(c) > 1, F.length(others)).alias("other_len"),
    )


def ownership_features(nodes: DataFrame, key: str) -> DataFrame:
    """key, pos, table_idx, FEATURES and text of each table; rows of tables inside a table count for both.

    The median of the widths is the upper one; Spark keeps a histogram of widths for it, which it merges.
    """
    tables = tables_of(nodes, key).select(key, "pos", "table_idx")
    rows = row_signals(nodes, key).withColumn("pos", F.explode("inside")).join(tables, [key, "pos"])
    true = lambda c: F.count_if(F.coalesce(F.col(c), F.lit(False)))
    stats = rows.groupBy(key, "pos").agg(
        F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY CASE WHEN width > 0 THEN width END DESC)").alias("col_count_med"),
        F.count("*").alias("row_count"),
        true("percent").alias("pct_rows"),
        true("shares").alias("share_rows"),
        true("star").alias("star_rows"),
        true("total").alias("total_rows"),
        true("address").alias("addr_like_rows"),
        F.avg("first_len").alias("first_col_avg_len"),
        F.avg("other_len").alias("other_cols_avg_len"),
    )
    text = contents(nodes, key, "table", between=" ").select(key, "pos", folded(F.col("content")).alias("text"))
    out = tables.join(stats, [key, "pos"], "left").join(text, [key, "pos"], "left").withColumn("text", F.coalesce("text", F.lit("")))
    words = {"ownership_hits": OWNERSHIP_WORDS, "management_hits": MANAGEMENT_WORDS, "negative_hits": NEGATIVE_WORDS}
    out = out.withColumns({n: _hits(F.col("text"), w) for n, w in words.items()})
    whole = [c for c in FEATURES if not c.endswith("len")]
    zero = {c: F.coalesce(F.col(c), F.lit(0)).cast("int") for c in whole} | {c: F.coalesce(F.col(c), F.lit(0.0)) for c in FEATURES if c.endswith("len")}
    return out.withColumns(zero).select(key, "pos", "table_idx", *FEATURES, "text")


def ownership_score() -> Column:
    """Points of a table by its features: -10 below three columns."""
    c = F.col
    rate = lambda n: F.least(c(n) / F.greatest(c("row_count"), F.lit(1)), F.lit(0.4))
    most = lambda n, top: F.least(c(n), F.lit(top))
    ratio = (c("first_col_avg_len") + 1.0) / (c("other_cols_avg_len") + 1.0) - 1.0
    dense = F.when(c("first_col_avg_len") > 0, 6.0 * F.least(F.greatest(ratio, F.lit(0.0)), F.lit(3.0))).otherwise(0.0)
    points = [12.0 * rate("pct_rows"), 10.0 * rate("share_rows"), dense, 2.0 * most("addr_like_rows", 6), 2.0 * most("ownership_hits", 8)]
    points += [4.0 * most("total_rows", 2), 1.5 * most("star_rows", 4), -8.0 * most("negative_hits", 2)]
    return F.when(c("col_count_med") < 3, -10.0).otherwise(sum(points, F.lit(0.0)))


def ownership_kind(text: Column, ownership: Column, management: Column) -> Column:
    """management or beneficial_owner: by the first phrase that occurs, else by the number of words."""
    out = F.when((management >= 2) & (management >= ownership), "management").otherwise("beneficial_owner")
    for phrase, kind in reversed(KIND_PHRASES):
        out = F.when(text.contains(phrase), kind).otherwise(out)
    return out


def scored_ownership(nodes: DataFrame, key: str) -> DataFrame:
    """key, table_idx, FEATURES, score, kind of each table."""
    kind = ownership_kind(F.col("text"), F.col("ownership_hits"), F.col("management_hits"))
    return ownership_features(nodes, key).select(key, "table_idx", *FEATURES, ownership_score().alias("score"), kind.alias("kind"))


def ownership_pair(scored: DataFrame, key: str, k: int = 6) -> DataFrame:
    """key, kind, table_idx, score: of the k best tables with points the best of each kind.

    Without a table of owners the best of all stands in, without one of management the second best.
    """
    w = Window.partitionBy(key).orderBy(F.desc("score"), "kind", "table_idx")
    top = scored.where("score > 0").withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k)
    pick = F.struct("table_idx", "score")
    first = lambda test: F.min_by(pick, F.when(test, F.col("_rank")))
    of = lambda kind, place: F.coalesce(first(F.col("kind") == kind), first(F.col("_rank") == place))
    best = top.groupBy(key).agg(of("beneficial_owner", 1).alias("beneficial_owner"), of("management", 2).alias("management"))
    kinds = F.array(*[F.struct(F.lit(n).alias("kind"), F.col(n)["table_idx"].alias("table_idx"), F.col(n)["score"].alias("score")) for n in ("beneficial_owner", "management")])
    return best.select(key, F.inline(kinds)).where("table_idx is not null")
