"""Line-first quality rules in DataFrame functions only.

Each line is judged by itself: punctuation, navigation, symbol noise and
boilerplate.  Failing lines are removed; a document that loses too much of its
text, or that fails the base rules on length and repetition, is rejected.

A word is a run of characters other than space and U+0009 to U+000D.  A null
text counts as an empty one: no words, base rules failed, not kept.  Rows are
judged each by itself, so repeated ones alike; columns of any name pass through
clean() untouched; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"

#: Fixed phrases of page furniture; a line fails if it has one for every BOILERPLATE_WORDS words or more.
BOILERPLATE = (
    r"(?i)(enable javascript|javascript is disabled|accept (all )?cookies|uses cookies|cookie policy|privacy policy|"
    r"terms of (use|service)|all rights reserved|click here to|sign up for our newsletter|subscribe to our|"
    r"follow us on|share this (page|article|post)|skip to (main )?content|back to top)"
)
BOILERPLATE_WORDS = 40
SEPARATORS = "|»›•·"
#: A word that the next one repeats.
STUTTER = r"(?:^|[\x20\x09-\x0D])([^\x20\x09-\x0D]++)\x20\1(?![^\x20\x09-\x0D])"
#: A line of so many words needs some punctuation.
PUNCTUATED_WORDS = 10
#: Tenths of the words of a line that its symbols, separators or exclamation marks may amount to.
NOISE_TENTHS = 3
#: Tenths of the characters in words that removed lines may hold.
LOST_TENTHS = 3
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5


def _count(text: Column, characters: str) -> Column:
    """Occurrences of the characters; texts without any are told by one cheap search."""
    found = F.length(text) - F.length(F.translate(text, characters, ""))
    return F.when(text.rlike(f"[{characters}]"), found).otherwise(F.lit(0))


def line_fails(line: Column) -> Column:
    """Whether one line fails: noise, shouting, navigation, stutter, boilerplate or no punctuation.

    Each rule begins with its cheapest test, as AND stops at the first false one.
    """
    words = F.regexp_count(line, F.lit(WORD))
    much = lambda n, least: (n >= least) & (n * 10 > words * NOISE_TENTHS)
    marked = much(_count(line, SYMBOLS), 3) | much(_count(line, "!"), 3) | much(_count(line, SEPARATORS), 2)
    stutter = F.regexp_count(line, F.lit(STUTTER))
    return (
        (line.rlike(f"[{SYMBOLS}!{SEPARATORS}]") & marked)
        | (~line.rlike(r"[.!?;:…。！？،]") & (words >= PUNCTUATED_WORDS) & ~line.rlike(","))
        | (line.rlike(STUTTER) & much(stutter, 3))
        | (line.rlike(BOILERPLATE) & (F.regexp_count(line, F.lit(BOILERPLATE)) * BOILERPLATE_WORDS >= words))
    )


def judged(docs: DataFrame, text: str = "text") -> DataFrame:
    """Two struct columns: `_row`, the columns of docs, and `_quality`.

    Fields of the latter: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    removed_chars (all long), clean_text, base_failed, kept.  Everything is
    worked out row by row inside the scan's stage: no shuffle, no Python.
    """
    original = docs.columns
    me = F.struct(*[F.col(f"`{c}`") for c in original]).alias("_row")
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))

    # Each select below names its input twice or more, so that the optimizer keeps the steps apart.
    step = docs.select(me, body.alias("_t"), F.array_remove(F.split(body, BLANKS), "").alias("_w"), F.split(body, "\n").alias("_l"))
    lines = F.filter("_l", lambda x: x.rlike(WORD))
    step = step.select(
        "_row",
        "_t",
        F.size("_w").alias("_n"),
        F.length(F.array_join("_w", "")).alias("_chars"),
        F.transform("_w", lambda x: F.xxhash64(x)).alias("_h"),
        "_l",
        lines.alias("_full"),
        F.transform("_l", lambda x: line_fails(x)).alias("_fails"),
    )
    tail = lambda c, k: F.slice(F.col(c), F.lit(k + 1), F.greatest(F.size(c), F.lit(1)))
    # Hashes of windows of 2, 4 and 5 words, each made from two shorter ones.
    fails = lambda i: F.coalesce(F.get("_fails", i), F.lit(False))
    bad = F.when(F.exists("_fails", lambda x: x), F.filter("_l", lambda x, i: fails(i))).otherwise(F.array().cast("array<string>"))
    step = step.select("*", bad.alias("_bad"), F.zip_with("_h", tail("_h", 1), lambda a, b: F.xxhash64(a, b)).alias("_two"))
    step = step.select("*", F.zip_with("_two", tail("_two", 2), lambda a, b: F.xxhash64(a, b)).alias("_four"))
    windows = F.slice(F.zip_with("_four", tail("_h", 4), lambda a, b: F.xxhash64(a, b)), F.lit(1), F.greatest(F.col("_n") - (WINDOW - 1), F.lit(0)))
    step = step.select("_row", "_t", "_n", "_chars", "_l", "_full", "_bad", "_fails", windows.alias("_g"))
    repeats = F.size(F.array_distinct("_g")) < F.size("_g")
    ordered = F.sort_array(F.transform("_g", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    step = step.withColumn("_s", F.when(repeats, ordered))
    pairs = F.zip_with(
        F.slice("_s", F.lit(1), F.size("_s") - 1),
        F.slice("_s", F.lit(2), F.size("_s") - 1),
        lambda a, b: F.when(a["g"] == b["g"], F.array(a["i"], b["i"])),
    )
    found = F.sort_array(F.array_distinct(F.flatten(F.filter(pairs, lambda x: x.isNotNull()))))
    step = step.withColumn("_p", F.when(F.col("_s").isNotNull(), found))
    gaps = F.zip_with(
        F.slice("_p", F.lit(1), F.size("_p") - 1),
        F.slice("_p", F.lit(2), F.size("_p") - 1),
        lambda a, b: F.least(b - a, F.lit(WINDOW)),
    )
    covered = F.when(F.col("_p").isNotNull(), F.aggregate(gaps, F.lit(WINDOW), lambda s, x: s + x)).otherwise(F.lit(0))
    long = lambda c: c.cast("long")
    step = step.select(
        "_row",
        "_n",
        "_chars",
        _count(F.col("_t"), SYMBOLS).alias("_sym"),
        (F.size("_full") - F.size(F.array_distinct("_full"))).alias("_dup"),
        covered.alias("_rep"),
        F.length(F.regexp_replace(F.array_join("_bad", ""), BLANKS, "")).alias("_lost"),
        F.when(F.size("_bad") == 0, F.col("_t")).otherwise(F.array_join(F.filter("_l", lambda x, i: ~fails(i)), "\n")).alias("_clean"),
    )
    failed = (F.col("_n") < MIN_WORDS) | (F.col("_rep") * 100 > F.col("_n") * MAX_REPEAT_PERCENT)
    kept = ~failed & (F.col("_lost") * 10 <= F.col("_chars") * LOST_TENTHS)
    # Spark would copy all steps into a filter on kept, and run them for every use of one.  It moves
    # no filter below a value that depends on the row's place.
    kept = kept & (F.monotonically_increasing_id() >= 0)
    result = F.struct(
        long(F.col("_n")).alias("n_words"),
        long(F.col("_chars")).alias("word_chars"),
        long(F.col("_sym")).alias("n_symbols"),
        long(F.col("_dup")).alias("n_dup_lines"),
        long(F.col("_rep")).alias("n_repeat_words"),
        long(F.col("_lost")).alias("removed_chars"),
        F.col("_clean").alias("clean_text"),
        failed.alias("base_failed"),
        kept.alias("kept"),
    )
    return step.select("_row", result.alias("_quality"))


def quality_report(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: key, the counts, base_failed and kept."""
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "removed_chars", "base_failed", "kept")
    out = judged(docs.select(F.col(f"`{key}`"), F.col(f"`{text}`")), text)
    return out.select(F.col("_row")[key].alias(key), *[F.col("_quality")[n].alias(n) for n in names])


def clean(docs: DataFrame, text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """The kept documents in their own columns, failing lines removed from the text."""
    out = judged(docs, text).where(F.col("_quality")["kept"])
    old = lambda c: F.col("_row")[c]
    put = {text: F.col("_quality")["clean_text"]}
    if n_chars and n_chars in docs.columns:
        changed = F.col("_quality")["removed_chars"] > 0
        put[n_chars] = F.when(changed, F.length(F.col("_quality")["clean_text"]).cast(docs.schema[n_chars].dataType)).otherwise(old(n_chars))
    return out.select(*[put.get(c, old(c)).alias(c) for c in docs.columns])


#: DuckDB SQL for the query's columns over documents.  RE2 knows no backward references,
#: so repeated words are counted from the list of words with single spaces between.
QUALITY_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         string_split(coalesce(text, ''), chr(10)) AS lines
  FROM documents
), g AS (SELECT doc_id, len(w) AS n, unnest(range(1, len(w) - 3)) AS i, w FROM d WHERE len(w) >= 5),
h AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS x FROM g),
r AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x) AS n FROM h),
p AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM r, (VALUES (0), (1), (2), (3), (4)) v(k) WHERE n > 1 GROUP BY doc_id),
l AS (SELECT doc_id, unnest(lines) AS l FROM d),
c AS (
  SELECT doc_id, l, len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS n, length(regexp_replace(l, '[\x20\x09-\x0D]+', '', 'g')) AS chars,
         length(l) - length(translate(l, '#*$%&|<>', '')) AS sym, length(l) - length(translate(l, '!', '')) AS shout,
         length(l) - length(translate(l, '|»›•·', '')) AS sep,
         list_reduce(list_prepend({'last': chr(32), 'run': 0, 'pairs': 0},
           list_transform(regexp_split_to_array(l, '[\x09-\x0D\x20]'), lambda x: {'last': x, 'run': 0, 'pairs': 0})),
           lambda a, b: CASE WHEN a.run = 0 AND b.last = a.last AND b.last <> '' THEN {'last': b.last, 'run': 1, 'pairs': a.pairs + 1}
                             ELSE {'last': b.last, 'run': 0, 'pairs': a.pairs} END).pairs AS stutter
  FROM l
), f AS (
  SELECT doc_id, l, n, chars,
    (sym >= 3 AND sym * 10 > n * 3) OR (shout >= 3 AND shout * 10 > n * 3) OR (sep >= 2 AND sep * 10 > n * 3)
    OR (n >= 10 AND NOT regexp_matches(l, '[.!?,;:…。！？،]')) OR (stutter >= 3 AND stutter * 10 > n * 3)
    OR (regexp_matches(l, '@boilerplate@') AND len(regexp_extract_all(l, '@boilerplate@')) * 40 >= n) AS bad
  FROM c
), q AS (
  SELECT doc_id, count(*) FILTER (n > 0) - count(DISTINCT l) FILTER (n > 0) AS n_dup_lines, coalesce(sum(chars) FILTER (bad), 0) AS lost
  FROM f GROUP BY doc_id
), o AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, lost
  FROM d LEFT JOIN p USING (doc_id) LEFT JOIN q USING (doc_id)
), b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM o)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND lost * 10 <= word_chars * 3 AS kept
FROM b
""".replace("@boilerplate@", BOILERPLATE)
