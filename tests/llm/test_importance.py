"""Importance resampling against plain Python, on awkward rows and with small chunks."""

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from cornice.llm import importance as L
from cornice.llm import queries as Q

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ROWS = [
    (1, "The quick-brown fox; jumps OVER 12 dogs " * 3),
    (2, "The quick-brown fox; jumps OVER 12 dogs " * 3),
    (2, "The quick-brown fox; jumps OVER 12 dogs " * 3),
    (3, None),
    (4, ""),
    (5, " \n.,!"),
    (6, "É Àß ÎİK word's naïve"),
    (7, "one"),
    (None, "null id has twenty words or more " * 5),
    (8, " ".join(f"w{i % 37}" for i in range(30000))),
    (9, "." * 70000 + "last words here"),
    (10, "x" * 200000 + " b " + "y" * 70 + " c"),
    (11, "-".join(["é" * 40] * 3000)),
    *[(100 + i, f"plain text number {i} with some words of its own " * 3) for i in range(60)],
]
TARGET = [(1, "quick fox jumps over dogs w1 w2 w3"), (2, None), (3, "W1 w2 w3 plain text " * 4)]


def plain(rows, target, n=1, buckets=10000, percent=10):
    def grams(text):
        w = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
        return [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for i in range(len(w) - n + 1)], len(w)

    found = [grams(t) for _, t in rows]
    s, t = Counter(b for g, _ in found for b in g), Counter(b for _, x in target for b in grams(x)[0])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
    out = []
    for (doc, _), (g, words) in zip(rows, found):
        h = int(hashlib.sha256(f"2024:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, g))
        out.append((doc, len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), words))
    able = sorted((x for x in out if x[4] >= 20), key=lambda x: (-x[3], x[0] is None, x[0] or 0))
    return out, [x[0] for x in able[: len(able) * percent // 100]]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string")


@pytest.mark.parametrize("n,buckets", [(1, 10000), (2, 10000), (3, 50)])
def test_report_against_plain(spark, docs, n, buckets):
    target = spark.createDataFrame(TARGET, "item_id long, text string")
    got = L.report(docs, target, n=n, buckets=buckets).collect()
    want, drawn = plain(ROWS, TARGET, n, buckets)
    assert sorted(((r.doc_id, r.n_features, r.weight, r.score) for r in got), key=repr) == sorted((x[:4] for x in want), key=repr)
    assert [r.doc_id for r in sorted((r for r in got if r.rank), key=lambda r: r.rank)] == drawn
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, len(drawn) + 1))


@pytest.mark.parametrize("n", [1, 2, 5])
def test_chunks_own_each_start_once(spark, docs, n):
    whole, chunks = L.chunked(docs, n, size=1 << 30), L.chunked(docs, n, size=64)
    assert whole[1].count() == 0 and chunks[1].count() > 1000
    assert chunks[1].agg(F.max(F.octet_length("body"))).first()[0] > 64
    counts = [sum(L.bucket_counts(x, n, 997) for x in y) for y in (whole, chunks)]
    assert (counts[0] == counts[1]).all() and counts[0].sum() > 0
    assert {r[0] for r in chunks[1].where("doc = 9").groupBy("row").agg(F.sum("own")).select("sum(own)").collect()} == {3}


def test_crc_of_spans():
    data = np.frombuffer(bytes(range(256)) * 20, dtype=np.uint8)
    begin = np.arange(0, 3000, 7)
    end = begin + (np.arange(len(begin)) * 13) % 150
    assert L.crc32_spans(data, begin, end).tolist() == [zlib.crc32(data[a:b].tobytes()) for a, b in zip(begin, end)]


def test_drawn_rows_and_clashing_columns(spark, docs):
    target = spark.createDataFrame(TARGET, "item_id long, text string")
    odd = docs.withColumns({c: F.lit(c) for c in ("tag", "row", "_row", "_t", "score", "doc", "weight", "rank", "body")})
    out = L.resample(odd, target, percent=50)
    assert out.columns == odd.columns and {r["_row"] for r in out.collect()} == {"_row"}
    drawn = plain(ROWS, TARGET, percent=50)[1]
    assert {r.doc_id for r in out.collect()} == set(drawn)
    assert L.report(docs.limit(0), target).count() == 0 and L.resample(docs.limit(0), target).count() == 0
    assert L.report(docs, target.limit(0)).count() == len(ROWS)


def test_query_against_sql(spark):
    folder = "/root/testdata/sf0.001"
    c = duckdb.connect()
    for t in ("documents", "benchmark"):
        c.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    want = c.sql(L.REPORT_SQL)
    got = Q.op11_importance(spark, folder).select(*want.columns).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want.fetchall(), key=repr)
