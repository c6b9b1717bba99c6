"""The corpus operators on small awkward tables: nulls, empty and long texts, ties, repeated rows, empty tables, extra columns."""

import zlib

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cornice.llm import ann, chat, html_text, langid, mixing, packing, quality, token_count, warc
from cornice.llm import queries as Q

DOCS = "doc_id long, text string, lang string, source string, n_chars long, `_t` string, kept int"
BASE = " ".join(f"word{i}" for i in range(60)) + "."
ROWS = [
    (1, BASE, "en", "a", 1, "x", 1),
    (2, BASE, "en", "a", 1, "x", 1),
    (2, BASE, "en", "a", 1, "x", 1),
    (3, BASE.replace("word59", "other"), "en", "b", 1, "x", 1),
    (4, None, None, None, None, None, None),
    (5, "", "de", "b", 0, "x", 1),
    (6, " \n\t", "de", "", 3, "x", 1),
    (7, "und die der von", "de", "a", 1, "x", 1),
    (None, "the of and to in it", "en", "b", 1, "x", 1),
    (8, "a b c d e a b c d e a b c d e\na b\na b", "en", "a", 1, "x", 1),
    (9, "Menu | Home | About | Contact\n" + "Plain words stand in this clean line of text, as they should.\n" * 1 + BASE, "en", "c", 1, "x", 1),
    (10, " ".join(f"long{i % 9000}" for i in range(30000)), "fr", "c", 1, "x", 1),
    (11, "<|endoftext|> \x1c it's 12 É ΣΑΣ ### x", "fr", "c", 1, "x", 1),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS)


@pytest.fixture(scope="module")
def duck(spark, docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("d") / "documents.parquet")
    pq.write_table(docs.select("doc_id", "text", "lang", "source", "n_chars").toArrow(), path)
    c = duckdb.connect()
    c.execute(f"create view documents as select * from '{path}'")
    return c


def rows(df, cols):
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=repr)


def check(df, duck, sql):
    rel = duck.sql(sql)
    cols = rel.columns
    assert rows(df, cols) == sorted(rel.fetchall(), key=repr)


def test_quality(docs, duck):
    # The SQL tells documents by doc_id, so repeated and null ids are left to the counts below.
    once = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    duck.execute("create or replace table once as select distinct on (doc_id) * from documents where doc_id is not null")
    check(quality.quality_report(once).drop("removed_chars"), duck, quality.QUALITY_SQL.replace("FROM documents", "FROM once"))
    assert quality.quality_report(docs).count() == len(ROWS)
    kept = quality.clean(docs)
    assert kept.columns == docs.columns
    clash = quality.clean(docs.withColumns({"_quality": F.lit(3), "_row": F.lit("r"), "_t": F.lit("t"), "_l": F.lit(1)}))
    assert {(r["_quality"], r["_row"]) for r in clash.collect()} == {(3, "r")} and clash.count() == kept.count()
    assert "Menu" not in {r.doc_id: r.text for r in kept.collect()}[9]
    assert quality.quality_report(docs.limit(0)).count() == 0


def test_mixing(docs, duck):
    check(mixing.mix_report(docs), duck, mixing.MIX_SQL)
    got = mixing.mix_report(docs).collect()
    assert all(r.taken <= 3 * r.size for r in got)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.agg(F.sum(mixing.size_of(F.col("text")))).first()[0] == sum(r.taken for r in got)
    assert mixing.mix_report(docs.limit(0)).count() == 0


def test_packing(docs):
    path = Q.vocabulary("word_bpe_49k.json")
    got = packing.pack(docs, path, keep_ids=True).toPandas()
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    want = sorted(tuple(tok.encode(r[1] or "", add_special_tokens=False).ids) + (2,) for r in ROWS)
    assert got["length"].sum() == sum(map(len, want))
    assert (got.groupby("sequence_id")["length"].sum() <= 4096).all()
    assert all(zlib.crc32(x) == c for x, c in zip(got["ids"], got["ids_crc32"]))
    for doc in (1, 10, 11):
        x = got[got["doc_id"] == doc].sort_values("start")
        text = next(r[1] for r in ROWS if r[0] == doc)
        assert np.frombuffer(b"".join(x["ids"]), "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids + [2]
    for _, x in got.sort_values("offset").groupby("sequence_id"):
        assert x["offset"].tolist() == (x["length"].cumsum() - x["length"]).tolist()
    assert packing.pack(docs.limit(0), path).count() == 0


def test_packer_bounds():
    done = []
    p = packing.Packer(done.append, 10, 3)
    for i in range(100):
        p.add(i, 0, b"abcd" * (1 + i % 13), 1)
    left = p.finish()
    assert all(sum(len(x[2]) for x in w) == 40 for w in done)
    assert sum(len(x[2]) for x in left) < 40
    assert sum(len(x[2]) for w in [*done, left] for x in w) == sum(4 * (1 + i % 13) for i in range(100))


def test_language(spark, docs):
    model = langid.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where(langid.held_out(F.col("doc_id")))
    got = langid.identify(d, model).toPandas()
    assert (got["lang"] == got["lang_pred"]).mean() > 0.97
    odd = {r.doc_id: r for r in langid.identify(docs, model).collect()}
    assert odd[4].lang_pred == odd[5].lang_pred == odd[6].lang_pred == "und" and odd[4].score == 0
    assert odd[7].lang_pred == "de" and odd[1]["_t"] == "x"
    clash = docs.withColumns({"_text": F.lit("q"), "score": F.lit(1), "lang_pred": F.lit("zz"), "accepted": F.lit(1)})
    got = {r.doc_id: r for r in langid.identify(clash, model).collect()}
    assert got[7].lang_pred == "de" and got[7]["_text"] == "q" and got[7].score == odd[7].score
    empty = langid.train(docs.limit(0))
    assert {r.lang_pred for r in langid.identify(docs, empty).collect()} == {"und"}


def test_token_counts(docs):
    path = Q.vocabulary("piece_bpe_32k.model")
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    got = sorted(r.n_tokens for r in token_count.token_counts(docs, path).collect())
    assert got == sorted(len(model.encode(r[1] or "")) for r in ROWS)
    assert token_count.token_counts(docs.limit(0), path).count() == 0
    more = docs.withColumns({"value": F.lit(1), "file": F.lit("f"), "n_tokens": F.lit(0)})
    assert sorted(r.n_tokens for r in token_count.token_counts(more, path).collect()) == got


def test_token_blocks(spark, tmp_path):
    ids = np.array([5, 2, 2, 7, 7, 7, 7, 7, 2, 9], "<u2")
    (tmp_path / "a.bin").write_bytes(ids.tobytes())
    (tmp_path / "b.bin").write_bytes(b"")
    for block in (1, 2, 3, 100):
        got = token_count.count_documents(spark, f"file://{tmp_path}", block_ids=block).orderBy("ordinal").collect()
        assert [(r.ordinal, r.start, r.n_tokens, r.closed) for r in got] == [(0, 0, 1, True), (1, 2, 0, True), (2, 3, 5, True), (3, 9, 1, False)]


def test_warc(spark):
    big = "é<p>\r\n\r\n" * 300
    odd = "http://x/a b\r\n\r\nWARC/1.1\r\nContent-Length: 0\t\x00"
    pages = [(1, odd, big), (2, None, big), (3, "http://y", "small"), (4, "u", "small"), (5, "u", None), (2, None, big), (None, "u", big), (6, "u", big + "x"), (7, "", "")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumns({"kind": F.lit("z"), "_sha1": F.lit("s"), "_place": F.lit(1)}).repartition(3)
    got = warc.archive_and_assemble(df, with_payload=True).collect()
    found = sorted((r.metadata.fields.get("page_id") or "", r.main.kind, r.metadata.fields.get("refers_to_page") or "") for r in got)
    assert found == sorted([("1", "revisit", "2"), ("2", "response", ""), ("2", "response", ""), ("3", "response", ""), ("4", "response", ""), ("5", "response", ""), ("6", "response", ""), ("7", "response", ""), ("", "revisit", "2")])
    by = {r.metadata.fields.get("page_id"): r for r in got}
    responses = {r.capture_id for r in got if r.metadata.fields.get("page_id") == "2"}
    assert {r.main.refers_to for r in got} - {None} <= responses and len(responses) == 2
    assert by["2"].main.payload == big.encode() and by["1"].main.payload_bytes == len(big.encode()) and by["5"].main.payload_bytes == 0
    assert all(r.request.record_id and r.request.target_uri == r.url for r in got) and len({r.capture_id for r in got}) == len(got)
    assert by["1"].url == "http://x/a%20b%0D%0A%0D%0AWARC/1.1%0D%0AContent-Length:%200%09%00" and by["2"].url is None
    assert warc.archive_and_assemble(df.limit(0)).count() == 0


def test_html():
    page = "<body><nav><a href=x>m</a></nav><div class=sidebar><p>Side, bar.</p></div><article><h1>A &amp; b</h1><p>One,  two<br>three<p>Four</article><div id=comments><p>No, no, no, no</p></div><footer>f</footer><scr"
    assert html_text.main_text(page) == "A & b\nOne, two three\nFour"
    assert html_text.main_text(None) == html_text.main_text("") == ""
    assert html_text.main_text("<div>" * 5000 + "deep") == "deep"
    two = "<main><article><h2>A</h2><p>One long text, of some words, and more of it.</article><article><p>Another text, with commas, of the same page, and, again, longer.</article></main>"
    assert html_text.main_text(two) == "A\nOne long text, of some words, and more of it.\nAnother text, with commas, of the same page, and, again, longer."


@pytest.mark.parametrize("seed", range(40))
def test_html_of_known_articles(seed):
    """Pages put together from known blocks and furniture: the blocks come out, nothing else does."""
    rng = np.random.default_rng(seed)
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    say = lambda tag, n: ", ".join(f"{tag} words {i} and so on" for i in range(n)) + "."
    furniture = [
        "<nav><ul><li><a href=/>Home</a><li><a href=/a>About</a></ul></nav>", "<aside><p>Aside, with, commas, many, of, them.</p></aside>",
        '<div class="sidebar"><p>Side, text, here.</p></div>', '<div id="comments"><p>First, comment, by, a, reader.</p></div>', "<script>var a = '<p>x, y</p>';</script>",
        "<style>p { x: y }</style>", '<div class="cookie-banner"><p>We, use, cookies.</p></div>', "<form><p>Name, please</p><input></form>", '<div class="ad"><a href=z>Buy, now</a></div>',
        "<!-- <p>hidden, comment</p> -->", '<footer class=x><p>Footer, text</p></footer>', '<div style="display:none"><p>Not, shown</p></div>',
    ]
    blocks, body = [], []
    for i in range(int(rng.integers(2, 9))):
        text = say(f"b{i}", int(rng.integers(2, 6)))
        shape = pick(["<p>{}</p>", "<p>{}", "<h2>{}</h2>", "<blockquote><p>{}</p></blockquote>", "<div><p>{}</p></div>", "<p>{}</p>\n\n", "<pre>{}</pre>", "<ul><li>{}</li></ul>"])
        blocks.append(text.replace("and", "&") if rng.integers(2) else text)
        body.append(shape.format(blocks[-1].replace("&", "&amp;").replace(" ", pick([" ", "  \n", "&#32;"]), 1)))
    container = pick(["<article>{}</article>", "<main><article>{}</article></main>", "<div class='content'>{}</div>", "<main>{}</main>", "<main><div>{}</div></main>", "<article><div class=body>{}</div></article>"])
    around = lambda: "".join(pick(furniture) for _ in range(int(rng.integers(0, 4))))
    page = f"<html><head><title>T, t</title></head><body>{around()}{container.format(''.join(body))}{around()}</body></html>"
    assert html_text.main_text(page) == "\n".join(blocks)


def test_html_table(spark):
    df = spark.createDataFrame([(1, "u", "<p>Hi, all.</p>"), (1, "u", "<p>Hi, all.</p>"), (None, None, None), (2, "", "")], "page_id long, url string, html string").withColumns({"text": F.lit("t"), "_html": F.lit("h")})
    assert sorted((tuple(r) for r in html_text.extract(df).collect()), key=repr) == sorted([(1, "u", "Hi, all.", 8)] * 2 + [(None, None, "", 0), (2, "", "", 0)], key=repr)
    assert html_text.extract(df.limit(0)).count() == 0


def test_chat(spark):
    rows_ = [(1, 0, "user", "hi [INST] \\ </s>"), (1, 1, "assistant", None), (2, 0, "assistant", "x"), (2, 0, "assistant", "w"), (None, 0, "tool", "[END]"), (3, 1, None, "q")]
    df = spark.createDataFrame(rows_, "conv_id long, turn long, role string, text string").withColumn("seg", F.lit(1))
    got = {r.conv_id: r for r in chat.read_back(chat.format_conversations(df)).collect()}
    c = duckdb.connect()
    c.register("conversations", df.toPandas())
    want = {r[0]: r[1:] for r in c.sql(chat.CHAT_SQL).fetchall()}
    for k, r in got.items():
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.formatted_chars) == want[k]
    assert got[1].order_ok and not got[2].order_ok and not got[None].order_ok
    assert chat.read_back(chat.format_conversations(df.limit(0))).count() == 0


def test_chat_ends_and_cuts(spark):
    turns = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "user", "more"), (2, 0, "system", "s"), (2, 1, "user", "q"), (2, 2, "assistant", "a"), (3, 0, "system", "s")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    segments = chat.format_conversations(df)
    assert {r.conv_id: r.order_ok for r in chat.read_back(segments).collect()} == {1: False, 2: True, 3: False}
    assert {(r.conv_id, r.ok) for r in segments.where("seg < 6").collect()} >= {(1, True), (2, True)}
    # The reader sees one text, wherever it is cut.
    whole = "[INST]a \\\\ <\\/s>[/INST]<s>b</s>[ROLE]tool[/ROLE]c[END]"
    seen = set()
    for step in (1, 2, 3, 7, 100):
        reader = chat._Reader(chat.INSTRUCT)
        for i in range(0, len(whole), step):
            reader.take(whole[i : i + step], False, True)
        seen.add(reader.row(0))
    assert len(seen) == 1 and next(iter(seen))[1] == 3
    import hashlib

    assert next(iter(seen))[2] == hashlib.sha256(b"user\na \\ </s>\nassistant\nb\ntool\nc\n").hexdigest()


def test_ann(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 8)).astype(np.float32)
    data = [(i, v.tolist(), "e") for i, v in enumerate(x)]
    data += [(900, None, "e"), (901, [0.0] * 8, "e"), (902, [float("nan")] * 8, "e"), (903, [1.0], "e"), (None, [1.0] * 8, "e"), (5, x[5].tolist(), "e")]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, tile string")
    got = ann.search(df, F.col("vec_id") % 20 == 0, k=7, tile=32).toPandas()
    s = x.astype(np.float64) @ x.astype(np.float64).T
    np.fill_diagonal(s, -np.inf)
    hit = [len(set(g["vec_id"]) & set(np.argsort(-s[q])[:7])) for q, g in got.groupby("query_id")]
    assert got["query_id"].nunique() == 15 and np.mean(hit) / 7 >= 0.9
    plan = ann.search_plan(df, F.col("vec_id") % 20 == 0, k=7)
    assert plan["rows"] == 300 and plan["curves"] >= 2 and 0 < plan["share"] <= plan["curves"]
    few = ann.search(df.where("vec_id < 3"), F.col("vec_id") == 0, k=7)
    assert few.count() == 2
    assert ann.search(df.limit(0), F.lit(True)).count() == 0


def test_ann_repeated_rows_and_ids(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(200, 8)).astype(np.float32)
    data = [(i, v.tolist()) for i, v in enumerate(x)] * 3
    hot = x[0] * 3
    data += [(500, hot.tolist())] * 60 + [(501, (hot * (1 + j / 100)).tolist()) for j in range(60)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>").repartition(5)
    got = ann.search(df, F.col("vec_id") % 20 == 0, k=7, tile=64).toPandas()
    ids, vec = np.array([d[0] for d in data]), np.array([d[1] for d in data], np.float32).astype(np.float64)
    names = np.unique(ids)
    hits, seen = [], set()
    for q, g in got.groupby("query_id"):
        s = (vec[ids == q] @ vec.T).max(axis=0)
        best = {n: s[ids == n].max() for n in names if n != q}
        want = sorted(best, key=lambda n: (-best[n], n))[:7]
        assert g["vec_id"].nunique() == len(g) == 7 and sorted(g["rank"]) == list(range(1, 8))
        hits.append(len(set(want) & set(g["vec_id"])))
        seen.add(q)
    assert seen == {*range(0, 200, 20), 500} and np.mean(hits) / 7 >= 0.9
    found, scores = ann._search(vec[:3], ids[:3], vec, ids, 7)
    for i in range(3):
        best = {n: (vec[ids == n] @ vec[i]).max() for n in names if n != i}
        assert found[i] == sorted(best, key=lambda n: (-best[n], n))[:7]
        assert np.allclose(scores[i], [best[n] for n in found[i]])


def test_near_duplicates_of_repeated_ids(spark):
    import corpus_pipeline as P

    def say(tag, n=60, new=()):
        return " ".join(f"{tag}{'new' if k in new else ''}{k}" for k in range(n))

    texts = [(1, say("a")), (1, say("a")), (2, say("a")), (2, say("a")), (3, say("a", new=[59])), (3, say("b"))]
    texts += [(4, say("c", new=[0])), (4, say("c")), (4, say("c", new=[59])), (5, say("d")), (5, say("e")), (5, say("e"))]
    texts += [(6, ""), (6, ""), (7, None), (None, " "), (None, say("a")), (None, say("f")), (None, say("f")), (None, say("f", new=[59])), (8, say("b"))]
    docs = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in texts], "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in ((t or "").split() for _, t in texts)]
    group = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and 100 * len(a & b) >= 80 * len(a | b):
                    group[i] = group[j] = min(group[i], group[j])
    got = [(r.doc_id, r.text) for r in P.near_duplicates(spark, docs, "").collect()]
    wordless = [x for x, s in zip(texts, sets) if not s]
    assert sorted((x for x in got if not (x[1] or "").strip()), key=repr) == sorted(wordless, key=repr)
    left = [x for x in got if (x[1] or "").strip()]
    want = {}
    for i, (d, _) in enumerate(texts):
        if sets[i]:
            want.setdefault(group[i], []).append(d)
    of = {t: group[i] for i, (_, t) in enumerate(texts)}
    assert all(x in texts for x in left)
    assert sorted((of[t], d) for d, t in left if d is not None) == sorted((g, min(x for x in ds if x is not None)) for g, ds in want.items() if any(x is not None for x in ds))
    assert sum(d is None for d, _ in left) == sum(all(x is None for x in ds) for ds in want.values())


def test_mixing_over_many_sources_and_clashing_names(spark, docs, duck, monkeypatch):
    more = docs.withColumns({"_size": F.lit(7), "_key": F.lit("k"), "_copy": F.lit(9), "_source": F.lit("s"), "taken": F.lit(-1), "target": F.lit("t"), "_row": F.lit("r")})
    few = rows(mixing.mix_report(more), ["doc_id", "size", "source_size", "target", "taken"])
    mixed = mixing.mix(more)
    assert mixed.columns == more.columns
    extra = {tuple(r) for r in mixed.select("_size", "_key", "_copy", "_source", "taken", "target", "_row").collect()}
    assert extra == {(7, "k", 9, "s", -1, "t", "r")}
    monkeypatch.setattr(mixing, "PLAN_ROWS", 1)
    check(mixing.mix_report(docs), duck, mixing.MIX_SQL)
    assert rows(mixing.mix_report(more), ["doc_id", "size", "source_size", "target", "taken"]) == few
    many = spark.range(300).selectExpr("id doc_id", "repeat('w ', cast(1 + id % 37 as int)) text", "concat('s', id % 150) source")
    got = rows(mixing.mix_report(many), ["doc_id", "target", "taken"])
    monkeypatch.setattr(mixing, "PLAN_ROWS", 100_000)
    assert got == rows(mixing.mix_report(many), ["doc_id", "target", "taken"])


def test_ann_on_the_driver_table(spark, monkeypatch):
    monkeypatch.setattr(ann, "TILE_QUERIES", 20)  # several groups a tile
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = ann.search(df, F.col("vec_id") % 20 == 0, k=20).toPandas().sort_values(["query_id", "rank"])
    data = df.where("vec_id is not null and embedding is not null").toPandas()
    data = data[[v is not None and len(v) == 64 and bool(np.isfinite(np.asarray(v, float)).all() and np.any(v)) for v in data["embedding"]]].drop_duplicates("vec_id").set_index("vec_id")
    x = np.stack(data["embedding"].to_list()).astype(np.float64)
    names = data.index.to_numpy()
    hit = total = 0
    for q in names[names % 20 == 0]:
        s = x @ x[np.flatnonzero(names == q)[0]]
        s[names == q] = -np.inf
        want = names[np.lexsort((names, -s))[:20]]
        mine = got[got["query_id"] == q]
        assert mine["rank"].tolist() == list(range(1, 21))
        assert np.allclose(mine["score"], [s[names == v][0] for v in mine["vec_id"]])
        hit, total = hit + len(set(want) & set(mine["vec_id"])), total + 20
    assert hit / total >= 0.9
    plan = ann.search_plan(df, F.col("vec_id") % 20 == 0)
    assert plan["curves"] >= 2 and plan["share"] <= 1.8


def test_ann_of_structured_vectors_looks_at_few(spark):
    rng = np.random.default_rng(8)
    centers = rng.normal(size=(40, 16)) * 5
    x = (centers[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 16)) * 0.05).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    assert ann.search_plan(df, F.col("vec_id") % 20 == 0, k=20)["share"] < 0.5


ODD_PAGES = {
    "no end": "<a " * 350000, "unmatched": "<div>" * 60000 + "</section>" * 60000, "quotes": '<a ">"' * 150000 + '"', "inline": "<i><div>" + "<b>" * 60000 + "</i>" * 60000,
    "cells": "<td><table>" + "<div>" * 60000 + "<td></td>" * 60000, "headers": "<div>" * 60000 + "<header></header>" * 60000, "comments": "<!--" * 250000, "scripts": "<script>" * 100000,
    "deep": "<article>" + "<div><p>a, b</p>" * 20000, "signs": "<" * 1000000,
}


@pytest.mark.parametrize("name", sorted(ODD_PAGES))
def test_html_of_odd_pages_takes_time_in_proportion(name):
    import time

    began = time.time()
    text = html_text.main_text(ODD_PAGES[name])
    assert time.time() - began < 20
    assert text == {"deep": "\n".join(["a, b"] * 20000), "signs": "<" * 1000000}.get(name, text)


def test_html_keeps_links_of_an_article():
    links = "<ul><li><a href=1>One source</a><li><a href=2>Another source</a><li><a href=3>Third source</a></ul>"
    body = "<p>One long text, of some words, and more of it, and so on.</p>"
    assert html_text.main_text(f"<article>{body}<h2>Sources</h2>{links}</article>").endswith("Sources\nOne source\nAnother source\nThird source")
    assert html_text.main_text(f"<body>{links}{body}</body>") == "One long text, of some words, and more of it, and so on."
    # A > within quotes ends no tag; a tag that the page breaks off in goes.
    assert html_text.main_text(f"<article>{body}<p title='a > b' class=\"x>y\">two, three</p><p>four <a href='") == "One long text, of some words, and more of it, and so on.\ntwo, three\nfour"
    # Of containers with equal points the first counts.
    same = "<div><p>Words of one of two equal parts, of a page.</p></div>"
    assert html_text.main_text(same + same.replace("one", "two")).startswith("Words of one")


def test_language_memory_and_long_texts():
    import tracemalloc

    labels = [f"l{i:04d}" for i in range(1000)]
    rng = np.random.default_rng(1)
    model = langid.Model(labels, rng.normal(size=(langid.BUCKETS, 1000)).astype(np.float32), np.zeros(1000))
    import pyarrow as pa

    text = " ".join(f"word{i % 5000}" for i in range(200000))
    tracemalloc.start()
    one = model.logits(pa.array([text, None, "a b", ""]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 500 << 20
    # Pieces give the same sums as a whole, and a row's neighbours don't matter.
    old, langid.SCORES = langid.SCORES, 1 << 12
    try:
        small = langid.Model(labels[:5], model.table[:, :5], np.zeros(5))
        cut = small.logits(pa.array([text[:3000], None, "a b", ""]))
    finally:
        langid.SCORES = old
    assert np.allclose(cut, small.logits(pa.array([text[:3000], None, "a b", ""])), atol=1e-9)
    assert np.allclose(one[2], model.logits(pa.array(["a b"]))[0])


def test_language_sample_of_null_and_repeated_ids(spark):
    rows = [(None, f"text {i} of many words", "en") for i in range(300)] + [(None, f"wort {i} von vielen", "de") for i in range(300)]
    rows += [(1, "the same text", "en")] * 500
    texts, langs = langid.sample(spark.createDataFrame(rows, "doc_id long, text string, lang string"), rows=50)
    assert 20 <= langs.count("de") <= 100 and 1 <= langs.count("en") <= 100
    again = langid.sample(spark.createDataFrame(rows[::-1], "doc_id long, text string, lang string"), rows=50)
    assert sorted(again[0]) == sorted(texts)
