"""Older scores of pay and ownership tables, on long cells (doc, table_idx, row_idx, col_idx, text)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .cells import COMP_WORDS, KEY, row_texts, score_tables

#: Fixed words, patterns and sizes of the ranked, the fallback and the legacy scorer.
FALLBACK_WORDS = ["salary", "bonus", "stock", "option", "non-equity", "non equity", "incentive", "pension", "all other compensation", "other compensation", "total", "compensation", "awards", "cash", "year"]
LEGACY_WORDS = ["salary", "bonus", "stock", "total", "compensation"]
MONEY = r"\$|\b\d{3,}\b"
ANY_YEAR, RECENT_YEAR = r"\b20\d{2}\b|\b19\d{2}\b", r"\b20\d{2}\b"
NAME_AND_PRINCIPAL = r"name\s*(and|&|/)\s*principal\s*(position|occupation)"
#: Fixed phrases of the simple ownership score.
OWNER_PHRASES = ["beneficial ownership", "security ownership", "beneficial owner"]
PERCENT_PHRASES = ["percentage of common stock", "percent of common stock", "percent of class", "% of class", "percent owned", "% owned"]


def _tables(cells: DataFrame, head: int, most: int | None = None) -> DataFrame:
    """doc, table_idx, head, full, rows, cols, title_cues: texts of the first rows and of all, at most `most` of them, and the table's size and title cues in these."""
    titles = F.max("title_cues") if "title_cues" in cells.columns else F.lit(None).cast("int")
    rows = row_texts(cells.dropna(subset=[*KEY, "row_idx"]), F.count("*").alias("_c"), titles.alias("title_cues"))
    rows = rows.withColumn("_r", F.row_number().over(Window.partitionBy(*KEY).orderBy("row_idx")))
    rows = rows if most is None else rows.where(F.col("_r") <= most)
    parts = F.transform(F.sort_array(F.collect_list(F.struct("_r", "row_text"))), lambda x: x["row_text"])
    joined = rows.groupBy(*KEY).agg(parts.alias("_p"), F.count("*").alias("rows"), F.max("_c").alias("cols"), F.max("title_cues").alias("title_cues"))
    return joined.select(*KEY, F.array_join(F.slice("_p", 1, head), " ").alias("head"), F.array_join("_p", " ").alias("full"), "rows", "cols", "title_cues")


def _has(c: str, *words: str) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | F.col(c).contains(w)
    return out


def _words(c: str, words: list[str] | tuple[str, ...]) -> Column:
    return sum((F.col(c).contains(w).cast("int") for w in words), F.lit(0))


def _if(test: Column, n: int) -> Column:
    return F.when(test, n).otherwise(0)


def first_score(cells: DataFrame) -> DataFrame:
    """doc, table_idx, score of the first scorer: cues 6, 4 and 2, grants -3, no titles."""
    return score_tables(cells, cues=(6, 4, 2), grants=-3, titles_count=0)


def ranked_score(cells: DataFrame) -> DataFrame:
    """doc, table_idx, score: cues 7, 5 or 2, up to 7 words, money 2, a year, three rows and four columns 1 each, 4 a title cue."""
    name, principal, position = _has("head", "name"), _has("head", "principal", "named executive"), _has("head", "position", "occupation")
    cue = F.when(name & principal & position, 7).when(name & (principal | position), 5).when(name, 2).otherwise(0)
    size = _if(F.col("rows") >= 3, 1) + _if(F.col("cols") >= 4, 1)
    score = cue + F.least(_words("head", COMP_WORDS), F.lit(7)) + _if(F.col("full").rlike(MONEY), 2) + _if(F.col("head").rlike(ANY_YEAR), 1) + size
    return _tables(cells, 12).select(*KEY, (score + 4 * F.col("title_cues")).alias("score"))


def fallback_score(cells: DataFrame) -> DataFrame:
    """doc, table_idx, score of the first 25 rows: 6 for the joined phrase, else 5, 3 or 2, up to 6 words, money 2, a year of this century, rows and columns 1 each."""
    name, principal, position = _has("head", "name"), _has("head", "principal"), _has("head", "position", "occupation")
    cue = F.when(F.col("head").rlike(NAME_AND_PRINCIPAL), 6).when(name & principal & position, 5).when(name & (principal | position), 3).when(name, 2).otherwise(0)
    size = _if(F.col("rows") >= 3, 1) + _if(F.col("cols") >= 4, 1)
    score = cue + F.least(_words("head", FALLBACK_WORDS), F.lit(6)) + _if(F.col("full").rlike(MONEY), 2) + _if(F.col("head").rlike(RECENT_YEAR), 1) + size
    return _tables(cells, 10, 25).select(*KEY, score.alias("score"))


def legacy_score(cells: DataFrame, words: list[str]) -> DataFrame:
    """doc, table_idx, score: 3 for a word of pay, 2 for a number of three digits in three rows or more, 1 for each given word in the first three.

    The two points for a person's name never come, as they ask for capitals in lower-case text.
    """
    number = (F.col("rows") >= 3) & F.col("full").rlike(r"[0-9]{3,}")
    return _tables(cells, 3).select(*KEY, (_if(_has("full", *LEGACY_WORDS), 3) + _if(number, 2) + _words("head", words)).alias("score"))


def _count(text: Column, part: str) -> Column:
    return ((F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))) / len(part)).cast("int")


def simple_ownership_score(text: Column) -> Column:
    """How often phrases of owners and percents and % occur in a table's lower-case text; -1 without one of each."""
    owner = sum((_count(text, p) for p in OWNER_PHRASES), F.lit(0))
    percent = sum((_count(text, p) for p in PERCENT_PHRASES), F.lit(0)) + _count(text, "%")
    return F.when((owner > 0) & (percent > 0), owner + percent).otherwise(-1)
