"""Token counts by separator scan over flat, unindexed token files.

A token file is nothing but 16-bit little-endian ids, one end-of-document id
after each document.  Spark's text sink writes it: a document's ids are the
value, the end id is the line separator, so files are committed like any other
output.  The scan reads files without an index, cuts them into blocks, finds the
end ids of a block with one vectorised search and gives one row per block.
Lengths of documents that cross blocks come from a prefix scan over the blocks
of a file: running totals of ids and the running maximum of the place after the
last end id.

Defined cases: a null or empty text is a document of no ids; ids behind the last
end id of a file are a last document with closed false; a file without ids has
no documents.  Repeated rows are documents each, other columns are ignored, and
an empty table gives no rows.

Files are written gzipped, of about FILE_BYTES of text each, as a task reads a
file at once; blocks bound what leaves that task, not what it reads.
"""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .store import materialize, new_path

END_ID = 2
BLOCK_IDS = 1 << 16
FILE_BYTES = 32 << 20

_LOADED: dict = {}


def _tokenizer(path: str):
    if path not in _LOADED:
        import sentencepiece

        _LOADED[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return _LOADED[path]


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _tokenizer(path)
        for batch in batches:
            for at in range(0, len(batch), 256):
                texts = [x or "" for x in batch.column(0).slice(at, 256).to_pylist()]
                ids = model.encode(texts, num_threads=1)
                yield pa.RecordBatch.from_arrays([pa.array([np.array(x, "<u2").tobytes() for x in ids], pa.binary())], ["value"])

    return run


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID, text: str = "text") -> None:
    """Write the ids of every text, each followed by end_id, as gzipped flat files.

    end_id must be below 128, so that it can be a line separator, and one that
    the vocabulary never gives for text.
    """
    if not 0 <= end_id < 128:
        raise ValueError("end_id must be below 128")
    ids = docs.select(F.col(f"`{text}`")).mapInArrow(_encode(tokenizer_path), "value binary")
    mean = docs.agg(F.avg(F.octet_length(F.col(f"`{text}`")))).first()[0] or 1
    records = int(max(1, min(1_000_000, FILE_BYTES // max(1, mean))))
    out = ids.select(F.col("value").cast("string")).write.option("lineSep", chr(end_id) + "\0")
    out.option("compression", "gzip").option("maxRecordsPerFile", records).text(path)


BLOCKS = "file string, block long, n_ids long, n_ends long, head long, tail long, inner array<long>"
_BLOCK_TYPES = [pa.string()] + [pa.int64()] * 5 + [pa.list_(pa.int64())]
_BLOCK_NAMES = ["file", "block", "n_ids", "n_ends", "head", "tail", "inner"]


def scan_block(ids: np.ndarray, end_id: int) -> tuple[int, int, int, np.ndarray]:
    """Number of end ids, ids before the first one, ids after the last one, lengths in between."""
    ends = np.flatnonzero(ids == end_id)
    if not len(ends):
        return 0, len(ids), len(ids), np.zeros(0, np.int64)
    return len(ends), int(ends[0]), len(ids) - int(ends[-1]) - 1, np.diff(ends) - 1


def _scan(end_id: int, block_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                data = batch.column(1)[i].as_py()
                data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
                ids = np.frombuffer(data, "<u2")
                rows = []
                for at in range(0, len(ids), block_ids):
                    part = ids[at : at + block_ids]
                    n, head, tail, inner = scan_block(part, end_id)
                    rows.append((batch.column(0)[i].as_py(), at // block_ids, len(part), n, head, tail, inner.tolist()))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _BLOCK_TYPES, strict=True)], _BLOCK_NAMES)

    return run


def count_documents(spark: SparkSession, path: str, end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> DataFrame:
    """One row per document in token files: file, ordinal, start, n_tokens, closed."""
    files = spark.read.format("binaryFile").load(path)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    blocks = materialize(files.select(name.alias("file"), "content").mapInArrow(_scan(end_id, block_ids), BLOCKS), "token-blocks")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    scan = blocks.withColumn("at", F.coalesce(F.sum("n_ids").over(before), zero)).withColumn("first", F.coalesce(F.sum("n_ends").over(before), zero))
    after = F.when(F.col("n_ends") > 0, F.col("at") + F.col("n_ids") - F.col("tail"))
    scan = scan.withColumn("after", after).withColumn("open", F.coalesce(F.max("after").over(before), zero))
    # A block's first document began at `open`; the rest lie within it.
    lengths = F.concat(F.array(F.col("at") + F.col("head") - F.col("open")), F.col("inner"))
    docs = scan.where("n_ends > 0").select("file", "first", "open", F.posexplode(lengths).alias("i", "n_tokens"))
    order = Window.partitionBy("file", "first").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("open") + F.coalesce(F.sum(F.col("n_tokens") + 1).over(order), zero)
    docs = docs.select("file", (F.col("first") + F.col("i")).alias("ordinal"), start.alias("start"), "n_tokens", F.lit(True).alias("closed"))
    ends = blocks.groupBy("file").agg(F.sum("n_ids").alias("n"), F.sum("n_ends").alias("ordinal"))
    last = scan.groupBy("file").agg(F.coalesce(F.max("after"), zero).alias("start"))
    rest = ends.join(last, "file").where("n > start").select("file", "ordinal", "start", (F.col("n") - F.col("start")).alias("n_tokens"), F.lit(False).alias("closed"))
    return docs.unionByName(rest)


def token_counts(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, text: str = "text") -> DataFrame:
    """Write docs as token files in the shared folder and count their documents."""
    spark = docs.sparkSession
    path = new_path(spark, "tokens")
    write_token_files(docs, path, tokenizer_path, end_id, text)
    return count_documents(spark, path, end_id)
