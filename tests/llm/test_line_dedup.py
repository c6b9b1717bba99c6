"""Shared lines against a plain count, on awkward rows."""

import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from cornice.llm import line_dedup as L

SHARED = "This line of text is in several documents."
ROWS = [
    (1, f"{SHARED}\nfirst of its own, long enough"),
    (2, f"\t{SHARED.upper()} \x0b\r\n\nsecond"),
    (3, f"third\n{SHARED}\n{SHARED}"),
    (4, f"{SHARED}\nshort\nshort"),
    (4, f"{SHARED}\nshort\nshort"),
    (4, f"again {SHARED}\n{SHARED}"),
    (5, "short\nonly in two of the documents"),
    (6, "short\nonly in two of the documents"),
    (7, "É line with one letter beyond ASCII"),
    (8, "é line with one letter beyond ascii"),
    (9, "é line with one letter beyond ascii "),
    (None, f"{SHARED}\nnull id"),
    (None, None),
    (10, None),
    (11, ""),
    (12, "\n"),
    (13, "\n".join(f"line {i} of a long text, number {i % 7}" if i % 3 else SHARED for i in range(20000))),
    (14, SHARED[:-1] + "\n" + "x" * 19 + "\n" + "y" * 20),
    (15, "x" * 19 + "\n" + "y" * 20),
    (16, " " + "x" * 19 + " \n" + "y" * 20 + "\t"),
]


def plain(rows, min_docs=3, min_chars=20):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    where = defaultdict(set)
    for doc, text in rows:
        for x in (text or "").split("\n"):
            where[key(x)].add(doc)
    low = lambda d: -1 if d is None else d
    for doc, text in rows:
        lines = (text or "").split("\n")
        left = [x for x in lines if len(key(x)) < min_chars or len(where[key(x)]) < min_docs or doc == max(where[key(x)], key=low)]
        yield doc, len(lines), len(lines) - len(left), hashlib.sha256("\n".join(left).encode()).hexdigest(), "\n".join(left)


def test_report_against_plain_count(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    got = sorted((tuple(r) for r in L.dedup_report(docs).collect()), key=repr)
    assert got == sorted((x[:4] for x in plain(ROWS)), key=repr)
    got = sorted((tuple(r) for r in L.dedup_report(docs, min_docs=2, min_chars=5).collect()), key=repr)
    assert got == sorted((x[:4] for x in plain(ROWS, 2, 5)), key=repr)


def test_texts_and_clashing_columns(spark):
    clash = {c: F.lit(c) for c in ("tag", "doc", "keep", "_row", "_doc", "_keep", "h1", "word", "a.b")}
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").withColumns({k: v for k, v in clash.items() if k != "a.b"}).withColumn("a.b", F.lit(1))
    out = L.dedup(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert sorted(((r.doc_id, r.text or "") for r in rows), key=repr) == sorted(((x[0], x[4]) for x in plain(ROWS)), key=repr)
    assert {r["_keep"] for r in rows} == {"_keep"} and {r.text for r in rows if r.doc_id == 10} == {None}
    assert L.dedup_report(docs.limit(0)).count() == 0 and L.dedup(docs.limit(0)).count() == 0


def test_hot_key_and_bitmaps(spark):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.concat(F.lit(f"{SHARED}\nown line of document "), "id", F.lit("\n" * 70), F.lit(SHARED)).alias("text"))
    maps = L.keep_bitmaps(docs)
    assert maps.count() == 5999 and maps.where("doc = 5999").count() == 0
    kept = {tuple(x["word"] for x in r.keep) for r in maps.limit(50).collect()}
    assert kept == {(0, 1)}
    sizes = L.shared_keys(L.line_hashes(docs), 12000).collect()
    assert [(r.winner, r.n_lines) for r in sizes] == [(5999, 12000)]
    assert L.dedup(docs).where("doc_id < 5999 and text like '%several%'").count() == 0
    again = L.unpack(F.expr("array(named_struct('word', 2, 'bits', 5L), named_struct('word', 4, 'bits', 6L))"))
    assert spark.range(1).select(again).first()[0] == [-1, -1, 5, -1, 6]
