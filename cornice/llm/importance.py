"""Importance resampling: documents drawn by how much their n-grams look like a target's.

Features are runs of n words, hashed to buckets.  A bucket's gain is the log of
its share in the target over its share in the documents, a document's weight is
the sum of its features' gains, and the documents of highest weight plus Gumbel
noise are drawn, which is sampling without replacement by weight.

A text above CHUNK_BYTES is cut into chunks at word boundaries that own the words
beginning in their range and carry the next n - 1 words, so each feature is
counted in the one chunk that owns its start.  Chunks are dealt over all tasks, so
one very long text isn't one task's work; counts and weights are summed by
document.  Ranks come from a range sort of scores and a prefix sum over its
partitions; no task sees all scores.

Words are runs of 0-9, a-z and code points from U+0080, after A-Z were lower-cased.
Defined cases: a null text has no words; a null doc_id hashes as an empty one and
comes last among ties; rows that repeat a doc_id are documents each, further ties
between them by their place; an empty table gives no rows, and an empty target
counts as one without features.  Only the two named columns are read, so others
of any name do no harm.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import materialize, scope, tasks_for
from .text_hash import padded, parts, raw_bytes

N = 1
BUCKETS = 10000
MIN_WORDS = 20
PERCENT = 10
SEED = 2024
CHUNK_BYTES = 1 << 16
#: Documents in a task of the range sort.
SORTED = 1 << 20
#: Place of the text in rows of (doc, tag, row, body).
TEXT = 3
#: Words of more bytes are hashed one by one.
LONG_WORD = 64

WORD = np.zeros(256, dtype=bool)
WORD[0x30:0x3A] = WORD[0x41:0x5B] = WORD[0x61:0x7B] = WORD[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def _crc_table() -> np.ndarray:
    """Remainders of all bytes by the reflected CRC-32 polynomial."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


CRC = _crc_table()


def crc32_spans(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of each span of data: all spans take a step for their first byte, then for their second, and so on."""
    length = end - begin
    out = np.zeros(len(begin), dtype=np.uint32)
    order = np.argsort(-np.minimum(length, LONG_WORD + 1).astype(np.int8), kind="stable")
    n_long = int((length > LONG_WORD).sum())
    for i in order[:n_long]:
        out[i] = zlib.crc32(data[begin[i] : end[i]].tobytes())
    order = order[n_long:]
    at, size = begin[order], length[order]
    crc = np.full(len(order), 0xFFFFFFFF, dtype=np.uint32)
    # Longest first, so those with a k-th byte are a prefix.
    reach = len(size) - np.cumsum(np.bincount(size, minlength=1)) if len(size) else []
    for k, m in enumerate(reach):
        if m == 0:
            break
        c = crc[:m]
        crc[:m] = CRC[(c ^ data[at[:m] + k]) & 0xFF] ^ (c >> np.uint32(8))
    out[order] = crc ^ np.uint32(0xFFFFFFFF)
    return out


def words_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each word of data begins and ends."""
    edge = np.diff(np.concatenate(([False], WORD[data], [False])).view(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def features(data: np.ndarray, starts: np.ndarray, n: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and row of each run of n words, and the words of each row, of rows that begin at starts with a blank between."""
    data = LOWER[data]
    begin, end = words_of(data)
    row = np.searchsorted(starts, begin, side="right") - 1
    words = np.bincount(row, minlength=len(starts))
    if n > 1 and len(begin):
        # Each word with one space after it, wherever it stood.
        keep = WORD[data]
        keep[end[end < len(data)]] = True
        place = np.cumsum(keep) - keep
        data = np.where(WORD[data], data, np.uint8(0x20))[keep]
        begin, end = place[begin], place[begin] + (end - begin)
        first, last = begin[: len(begin) - n + 1], end[n - 1 :]
        whole = row[: len(first)] == row[n - 1 :]
        begin, end, row = first[whole], last[whole], row[: len(first)][whole]
    return crc32_spans(data, begin, end) % np.uint32(buckets), row, words


def _cuts(data: np.ndarray, n: int, size: int) -> Iterator[tuple[int, int, int]]:
    """(begin, end, words owned) of each chunk: the words that begin in a range of size bytes, and n - 1 more."""
    for low in range(0, len(data), size):
        before = low > 0 and WORD[data[low - 1]]
        inside = WORD[data[low : low + size]]
        begin = np.flatnonzero(np.diff(np.concatenate(([before], inside)).view(np.int8)) == 1) + low
        if not len(begin):
            continue
        reach = size
        while True:
            tail = WORD[data[begin[-1] : begin[-1] + reach]]
            ends = np.flatnonzero(np.diff(np.concatenate((tail, [False])).view(np.int8)) == -1) + 1
            if begin[-1] + reach >= len(data) or len(ends) > n:
                break
            reach *= 2
        yield int(begin[0]), int(begin[-1] + ends[min(n, len(ends)) - 1]), len(begin)


def _cutter(n: int, size: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, TEXT):
            data, ends = raw_bytes(batch.column(TEXT))
            for i in range(len(batch)):
                text = data[ends[i] : ends[i + 1]]
                # A text without words still is a document.
                for k, (a, b, own) in enumerate(list(_cuts(text, n, size)) or [(0, 0, 0)]):
                    body = text[a:b].tobytes().decode("utf-8")
                    fixed = [pa.concat_arrays([batch.column(c).slice(i, 1)]) for c in range(TEXT)]
                    yield pa.RecordBatch.from_arrays(
                        [*fixed, pa.array([body]), pa.array([k], pa.int32()), pa.array([own], pa.int64())],
                        [*batch.schema.names[:TEXT], "body", "chunk", "own"],
                    )

    return cut


def chunked(docs: DataFrame, n: int = N, text: str = "text", doc_id: str = "doc_id", size: int = CHUNK_BYTES) -> tuple[DataFrame, DataFrame]:
    """Short texts as they are, and the chunks of long ones, both as (doc, tag, row, body, chunk, own).

    The chunks are written, as both passes over the words read them.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc"), F.xxhash64(body).alias("tag"), body.alias("body"))
    is_long = F.octet_length("body") > size
    none = lambda t: F.lit(None).cast(t)
    short = rows.where(~is_long).select("doc", "tag", none("long").alias("row"), "body", none("int").alias("chunk"), none("long").alias("own"))
    long = rows.where(is_long).select("doc", "tag", F.monotonically_increasing_id().alias("row"), "body")
    pieces = long.mapInArrow(_cutter(n, size), short.schema)
    return short, materialize(pieces.repartition("row", "chunk"), "chunks")


def bucket_counts(texts: DataFrame, n: int = N, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket over all rows of texts (chunked()'s columns); the driver gets a number a bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in parts(batches, 0):
            data, ends = raw_bytes(batch.column(0))
            data, starts = padded(data, ends, 0, len(batch))
            total += np.bincount(features(data, starts, n, buckets)[0], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    found = texts.select("body").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, dtype=np.int64)
    for bucket, k in found.collect():
        out[bucket] = k
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log of each bucket's share in the target over its share in the source, both smoothed by one."""
    whole_s, whole_t, b = float(source.sum()), float(target.sum()), len(source)
    ratio = lambda s, t: (t + 1.0) * (whole_s + b) / ((s + 1.0) * (whole_t + b))
    return np.array([math.floor(1000 * math.log(ratio(float(s), float(t)))) for s, t in zip(source, target)], dtype=np.int64)


def _weigher(gain: np.ndarray, n: int):
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, TEXT):
            data, ends = raw_bytes(batch.column(TEXT))
            data, starts = padded(data, ends, 0, len(batch))
            bucket, row, words = features(data, starts, n, len(gain))
            sums = np.concatenate(([0], np.cumsum(gain[bucket])))
            at = np.searchsorted(row, np.arange(len(batch) + 1))
            own = batch.column(TEXT + 1).to_numpy(zero_copy_only=False)
            own = np.where(np.isnan(own), words, own).astype(np.int64) if batch.column(TEXT + 1).null_count else own
            out = [*batch.columns[:TEXT], pa.array(own), pa.array(np.diff(at)), pa.array(np.diff(sums[at]))]
            yield pa.RecordBatch.from_arrays(out, ["doc", "tag", "row", "n_words", "n_features", "weight"])

    return weigh


def weights(docs: DataFrame, target: DataFrame, n: int = N, buckets: int = BUCKETS, text: str = "text", doc_id: str = "doc_id", target_text: str = "text") -> DataFrame:
    """(doc, tag, n_words, n_features, weight, place) of each row, written to the shared folder; tag is a hash of the text."""
    with scope(docs.sparkSession) as made:
        short, pieces = chunked(docs, n, text, doc_id)
        source = bucket_counts(short, n, buckets) + bucket_counts(pieces, n, buckets)
        like = chunked(target.select(F.lit(0).alias("id"), F.col(f"`{target_text}`").alias("text")), n, "text", "id")
        gain = gains(source, sum(bucket_counts(x, n, buckets) for x in like))
        kind = dict(short.dtypes)["doc"]
        schema = f"doc {kind}, tag long, row long, n_words long, n_features long, weight long"
        weighed = lambda x: x.select("doc", "tag", "row", "body", "own").mapInArrow(_weigher(gain, n), schema)
        whole = weighed(pieces).groupBy("row").agg(F.first("doc").alias("doc"), F.first("tag").alias("tag"), *[F.sum(c).alias(c) for c in ("n_words", "n_features", "weight")])
        rows = weighed(short).drop("row").unionByName(whole.drop("row"))
        out = materialize(rows.withColumn("place", F.monotonically_increasing_id()), "weights")
        made.pop()
    return out


def ranked(rows: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """The rows of weights() with score, and rank for those that are drawn."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc").cast("string"), F.lit(""))), 256), 1, 8)
    uniform = (F.conv(digits, 16, 10).cast("double") + 0.5) / 4294967296.0
    rows = rows.withColumn("score", F.col("weight") + F.floor(F.lit(-1000) * F.log(-F.log(uniform))).cast("long"))
    able = rows.where(F.col("n_words") >= min_words)
    n = able.count()
    order = [F.desc("score"), F.asc_nulls_last("doc"), F.asc("place")]
    parted = able.repartitionByRange(tasks_for(rows.sparkSession, n, SORTED), *order).sortWithinPartitions(*order)
    # The id counts from 2**33 times the partition's number.
    parted = materialize(parted.withColumn("at", F.monotonically_increasing_id()), "by-score")
    part, inside = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    sizes = parted.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    # One row a partition.
    sizes = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    parted = parted.withColumn("part", part).join(F.broadcast(sizes), "part")
    rank = F.col("before") + inside + 1
    parted = parted.withColumn("rank", F.when(rank <= n * percent // 100, rank)).drop("part", "at", "before")
    return parted.unionByName(rows.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long")))


def report(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null if not drawn) of each row."""
    rows = ranked(weights(docs, target, doc_id=doc_id, **options))
    return rows.select(F.col("doc").alias(doc_id), "n_features", "weight", "score", "rank")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """The drawn rows of docs in their own columns.  Rows that repeat both doc_id and text are drawn together."""
    rows = ranked(weights(docs, target, text=text, doc_id=doc_id, **options), percent)
    drawn = rows.where("rank is not null").select("doc", "tag").distinct().toDF("_doc", "_tag")
    me = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("_t"))
    same = me["_row"][doc_id].eqNullSafe(drawn["_doc"]) & (me["_t"] == drawn["_tag"])
    out = me.join(drawn, same, "left_semi")
    return out.select(*[F.col("_row")[c].alias(c) for c in docs.columns])


#: DuckDB SQL for the query.  CRC-32 goes byte by byte over each distinct word, by a table of 256 remainders.
REPORT_SQL = r"""
WITH RECURSIVE z AS (
  SELECT list(r ORDER BY b) AS t
  FROM (SELECT b, list_reduce(list_prepend(b, [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                              lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS r FROM range(256) g(b))
), w AS (
  SELECT 0 AS side, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '@word@') AS ws
  FROM documents
  UNION ALL
  SELECT 1, NULL, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '@word@') FROM benchmark
), g AS (SELECT side, doc_id, w, count(*) AS n FROM (SELECT side, doc_id, unnest(ws) AS w FROM w) GROUP BY ALL),
u AS (SELECT w, hex(encode(w)) AS x FROM (SELECT DISTINCT w FROM g)),
k AS (
  SELECT w, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(len(x) // 2), lambda i: ('0x' || x[2 * i + 1:2 * i + 2])::BIGINT)),
            lambda c, y: xor(t[(xor(c, y) & 255) + 1], c >> 8)), 4294967295) % 10000 AS bucket
  FROM u, z
), c AS (SELECT bucket, sum(n) FILTER (side = 0) AS s, sum(n) FILTER (side = 1) AS t FROM g JOIN k USING (w) GROUP BY bucket),
h AS (SELECT coalesce(sum(s), 0)::DOUBLE AS al, coalesce(sum(t), 0)::DOUBLE AS bl FROM c),
a AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (al + 10000) / ((coalesce(s, 0) + 1)::DOUBLE * (bl + 10000))))::BIGINT AS gain FROM c, h
), d AS (SELECT doc_id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight FROM g JOIN k USING (w) JOIN a USING (bucket) WHERE side = 0 GROUP BY doc_id),
e AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || doc_id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM documents LEFT JOIN d USING (doc_id)
), r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () * 10 // 100 AS top FROM e WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= top THEN rank END::BIGINT AS rank FROM e LEFT JOIN r USING (doc_id)
""".replace("@word@", r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
