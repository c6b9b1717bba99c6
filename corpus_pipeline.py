"""Quality rules, language ID, near-duplicates, mixing, packing: documents to training sequences."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cornice.llm import langid, mixing, ngram_join, packing, quality
from cornice.llm.queries import table, vocabulary
from cornice.llm.store import drop, materialize, scope

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Near copies: five-word shingles and a similarity of at least 0.8.
SHINGLE, PERCENT = 5, 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; failing lines of the others go.

    A null or empty text is rejected; rows that repeat stay or go alike; a null in
    another column stays one; an empty table stays empty; columns beside those of
    documents, whatever their names, are left out.
    """
    return quality.clean(docs.select(*COLUMNS))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language, or below the calibrated level, go.

    The model learns from the labelled rows that reach this stage.  Without any,
    all documents go, as they do if the table is empty; a text without letters
    has no language; rows that repeat stay or go alike; other columns are left out.
    """
    model = langid.train(docs)
    return langid.identify(docs, model, keep=list(COLUMNS)).where("accepted").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked rows one stays, of the smallest doc_id.

    Rows are told apart by a number of their own, as a doc_id may be null or on
    several rows: each row is judged by its text, and different texts of one
    doc_id stay or go apart.  A null doc_id comes after all others.  Documents
    without words all stay.  An empty table stays empty; other columns are left out.
    """
    rows = docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id())
    rows = materialize(rows.withColumn("tie", F.xxhash64(*COLUMNS)), "rows")
    found = ngram_join.link_classes(rows, n=SHINGLE, percent=PERCENT, doc_id="row").withColumnRenamed("doc_id", "row")
    found = materialize(found.where("n_shingles > 0").select("row", "component_id"), "linked")
    linked = found.join(rows.select("row", "doc_id", "tie"), "row")
    stays = linked.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "tie", "row"))["row"].alias("row"))
    goes = materialize(found.select("row").join(stays, "row", "left_anti"), "copies")
    return rows.join(goes, "row", "left_anti").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated, left out or cut as the sources' budgets ask.

    A null source is a source; a document without words goes; rows that repeat are
    documents each; an empty table stays empty; other columns are left out.
    """
    return mixing.mix(docs.select(*COLUMNS))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 4096 tokens.

    A null text is its end token alone; rows that repeat are packed each; an empty
    table gives no pieces; other columns are left out.
    """
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("language id", language_id),
    ("near duplicates", near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Language ID, near copies' links and packing have no SQL form; the tests hold them against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows.  What a stage wrote is deleted once the next one's output is written."""
    docs, path = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with scope(spark) as made:
            docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
            mine = made.pop()
        if path:
            drop(spark, path)
        path = mine
    out = STAGES[-1][1](spark, docs, sf_dir)  # packed and written by now
    drop(spark, path)
    return out
