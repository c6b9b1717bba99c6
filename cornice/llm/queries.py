"""The operators with production parameters, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import share_path
from . import ann, chat, html_text, importance, langid, line_dedup, mixing, ngram_join, packing, quality, token_count, warc, whitening


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return share_path(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of each whose id is divisible by 20."""
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix takes of every document."""
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place and length of every document in flat token files written of all texts."""
    out = token_count.token_counts(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))
    # Names of files hold a random part; their numbers don't.
    part = F.regexp_extract("file", r"^part-(\d+)", 1).cast("long")
    chunk = F.regexp_extract("file", r"-c(\d+)\.", 1).cast("long")
    return out.select(part.alias("part"), chunk.alias("chunk"), "ordinal", "start", "n_tokens", "closed")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the archives written of all pages say of each, read back."""
    captures = warc.archive_and_assemble(table(spark, sf_dir, "pages"))
    return captures.select(
        F.element_at("metadata.fields", "page_id").cast("long").alias("page_id"),
        F.col("main.payload_bytes").alias("payload_bytes"),
        F.col("main.payload_sha1").alias("payload_digest"),
        F.col("main.kind").alias("record_type"),
        F.element_at("metadata.fields", "refers_to_page").cast("long").alias("refers_to"),
    )


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 4096 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    report = quality.quality_report(table(spark, sf_dir, "documents"))
    return report.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages"))


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation, read back from its formatted text."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", hard), (-1, 1, "assistant", hard)], "conv_id long, turn long, role string, text string")
    out = chat.read_back(chat.format_conversations(rows.unionByName(more)), ordered=True)
    return out.select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document at four-word shingles and 0.85."""
    out = ngram_join.link_classes(table(spark, sf_dir, "documents"), n=4, percent=85)
    return out.select("doc_id", "n_shingles", "component_id")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language predicted for every document by a model trained on those not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs)
    out = langid.identify(docs.withColumn("held_out", langid.held_out(F.col("doc_id"))), model, keep=["doc_id", "held_out"])
    return out.select("doc_id", "held_out", "lang_pred", "score")


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight and score of every document by how it looks like the benchmark, and the ranks of the drawn tenth."""
    return importance.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document, those that go, and the digest of the rest."""
    return line_dedup.dedup_report(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 16 whitened components of every vector."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_nearest, op2_mixing, op3_token_counts, op4_warc, op5_packing, op6_quality, op7_html, op8_chat, op9_ngram_join, op10_language)
    return {f.__name__: f for f in (*found, op11_importance, op12_line_dedup, op13_whitening)}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_mixing": mixing.MIX_SQL,
        "op4_warc": warc.WARC_SQL,
        "op6_quality": quality.QUALITY_SQL,
        "op8_chat": chat.CHAT_SQL,
        "op9_ngram_join": ngram_join.NGRAM_SQL,
        "op11_importance": importance.REPORT_SQL,
        "op12_line_dedup": line_dedup.LINE_SQL,
    }
