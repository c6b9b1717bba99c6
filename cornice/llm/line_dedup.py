"""Lines that several documents share stay in one of them; DataFrame functions only.

Every line becomes a 128-bit hash of its key (blanks at both ends off, A-Z in
lower case) beside its document and position.  Hashes are range-partitioned
together with the document, so that a key of very many documents is cut over
several partitions, and sorted by document and position.  A window over that
order streams the first occurrence of each key in each document without another
shuffle; first occurrences are counted by key, with a row for each partition that
a key reaches.  What goes back to a document is no text but a keep bitmap: 64
lines a word, and words of which every line stays are left out.

Defined cases: a null or empty text is one empty line; documents are told apart
by doc_id, so rows that repeat one are one document whose rows keep or lose a key
together; a null doc_id is a document too, smaller than all others.  A text whose
lines all go becomes empty; an empty table gives no rows; columns of any name pass
through dedup() untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import materialize, scope, tasks_for

BLANK = " \t\n\x0b\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MIN_DOCS = 3
MIN_CHARS = 20
#: Lines in a task of the sorted ranges.
LINES = 1 << 20
#: A key with more than this part of all lines is joined by broadcast; there are fewer than HOT such keys.
HOT = 1000


def _cut(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANK))


def line_key(line: Column) -> Column:
    """The line without blanks at both ends, A-Z in lower case and all else as it is."""
    cut = _cut(line)
    plain = F.octet_length(cut) == F.length(cut)
    return F.when(plain, F.lower(cut)).otherwise(F.translate(cut, UPPER, UPPER.lower()))


def _body(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def line_hashes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_chars: int = MIN_CHARS) -> DataFrame:
    """(h1, h2, doc, tag, pos) of every line whose key has min_chars code points; tag is a hash of the whole text."""
    body = _body(F.col(f"`{text}`"))
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc"), F.xxhash64(body).alias("tag"), F.posexplode(F.split(body, "\n")).alias("pos", "line"))
    # Neither step changes the length once the blanks are off.
    rows = rows.where((F.octet_length("line") >= min_chars) & (F.length(_cut(F.col("line"))) >= min_chars))
    key = line_key(F.col("line"))
    return rows.select(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(7), key).alias("h2"), "doc", "tag", "pos")


def shared_keys(lines: DataFrame, n_lines: int, min_docs: int = MIN_DOCS) -> DataFrame:
    """(h1, h2, winner, n_lines) of the keys in at least min_docs documents; the largest doc is the winner."""
    ranged = lines.repartitionByRange(tasks_for(lines.sparkSession, n_lines, LINES), "h1", "h2", "doc")
    order = Window.partitionBy("h1", "h2", "doc").orderBy("tag", "pos")
    first = F.row_number().over(order) == 1
    keys = ranged.select("h1", "h2", "doc", first.alias("first")).groupBy("h1", "h2")
    keys = keys.agg(F.max("doc").alias("winner"), F.count_if("first").alias("n_docs"), F.count("*").alias("n_lines"))
    return keys.where(F.col("n_docs") >= min_docs).drop("n_docs")


def keep_bitmaps(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS
) -> DataFrame:
    """(doc, tag, keep) of each text that loses a line, written to the shared folder.

    keep is a sorted array of (word, bits): bit b of word w is 1 if line 64 w + b
    stays.  Words that aren't there, and texts that aren't there, stay whole.
    """
    spark = docs.sparkSession
    with scope(spark) as made:
        lines = materialize(line_hashes(docs, text, doc_id, min_chars), "lines")
        total = lines.count()
        keys = materialize(shared_keys(lines, total, min_docs), "line-keys")
        is_hot = F.col("n_lines") * HOT > total
        hot = F.broadcast(keys.where(is_hot).select("h1", "h2", "winner"))
        cool = keys.where(~is_hot).select("h1", "h2", "winner")
        of_hot = lines.join(hot, ["h1", "h2"])
        of_cool = lines.join(hot.drop("winner"), ["h1", "h2"], "left_anti").join(cool, ["h1", "h2"])
        gone = of_hot.unionByName(of_cool).where(~F.col("doc").eqNullSafe(F.col("winner")))
        word = F.floor(F.col("pos") / 64).cast("int").alias("word")
        bit = F.expr("shiftleft(1L, pos % 64)")
        words = gone.groupBy("doc", "tag", word).agg(F.bitwise_not(F.bit_or(bit)).alias("bits"))
        keep = F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("keep")
        out = materialize(words.groupBy("doc", "tag").agg(keep), "keep-bitmaps")
        made.pop()
    return out


def unpack(keep: Column) -> Column:
    """The words of a keep bitmap up to its last one, those left out put in as all ones.

    Any word is then found at once, so that applying the bitmap takes time in
    proportion to the lines.
    """
    before = F.concat(F.array(F.struct(F.lit(-1).alias("word"), F.lit(-1).cast("long").alias("bits"))), keep)
    gaps = F.zip_with(before, keep, lambda a, b: F.concat(F.array_repeat(F.lit(-1).cast("long"), b["word"] - a["word"] - 1), F.array(b["bits"])))
    return F.flatten(F.filter(gaps, lambda x: x.isNotNull()))


def kept_lines(docs: DataFrame, bitmaps: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(_row, _lines, _kept): the columns of docs, the lines of its text, and those that stay.

    Spark knows the bitmaps' size from their files: it broadcasts few of them, so
    that no text is shuffled, and joins by (doc, hash of the text) beyond.
    """
    body = _body(F.col(f"`{text}`"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{doc_id}`").alias("_doc"), F.xxhash64(body).alias("_tag"), body.alias("_body"))
    maps = bitmaps.toDF("_bdoc", "_btag", "_keep")
    rows = rows.join(maps, F.col("_doc").eqNullSafe(F.col("_bdoc")) & (F.col("_tag") == F.col("_btag")), "left")
    rows = rows.select("_row", F.split("_body", "\n").alias("_lines"), unpack(F.col("_keep")).alias("_words"))
    stays = lambda i: F.coalesce(F.get("_words", F.floor(i / 64).cast("int")), F.lit(-1).cast("long"))
    some = F.filter("_lines", lambda x, i: F.call_function("getbit", stays(i), (i % 64).cast("int")) == 1)
    return rows.select("_row", "_lines", F.when(F.col("_words").isNull(), F.col("_lines")).otherwise(some).alias("_kept"))


def dedup_report(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, n_lines, n_dropped and the SHA-256 of what stays, one row per row of docs."""
    docs = docs.select(F.col(f"`{doc_id}`"), F.col(f"`{text}`"))
    rows = kept_lines(docs, keep_bitmaps(docs, text, doc_id, min_docs, min_chars), text, doc_id)
    n, left = F.size("_lines"), F.size("_kept")
    return rows.select(
        F.col("_row")[doc_id].alias(doc_id),
        n.cast("long").alias("n_lines"),
        (n - left).cast("long").alias("n_dropped"),
        F.sha2(F.array_join("_kept", "\n").cast("binary"), 256).alias("kept_sha256"),
    )


def dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """docs with the dropped lines taken out of the text; all other columns as they are."""
    rows = kept_lines(docs, keep_bitmaps(docs, text, doc_id, min_docs, min_chars), text, doc_id)
    changed = F.size("_kept") < F.size("_lines")
    old = F.col("_row")[text]
    put = F.when(changed, F.array_join("_kept", "\n")).otherwise(old)
    return rows.select(*[(put if c == text else F.col("_row")[c]).alias(c) for c in docs.columns])


LINE_SQL = r"""
WITH t AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(range(len(ls))) AS i, unnest(ls) AS line FROM t),
k AS (
  SELECT doc_id, i, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l
), c AS (SELECT key, max(doc_id) AS winner FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
d AS (SELECT k.doc_id, i, line, coalesce(k.doc_id <> winner, false) AS gone FROM k LEFT JOIN c USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (gone))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM d GROUP BY doc_id
"""
