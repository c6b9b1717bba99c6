"""The pipeline's stages on awkward rows, each against a plain Python version."""

import collections
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from cornice.llm import langid, quality, store

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = {"_row": 1, "_quality": 2, "score": 3, "lang_pred": 4, "accepted": 5, "_size": 6, "_copy": 7, "ck": 8, "n": 9, "sequence_id": 10, "row": 11, "_text": 12}
SENTENCES = ["The cat sat on the mat, and it was content.", "A dog ran over the hill; nobody saw it.", "Rain fell for days on the quiet town.", "She wrote a letter to her friend in the north."]


def prose(i, n=4):
    return "\n".join(f"{SENTENCES[(i + k) % 4]} Line {i} of page {k} has its own words {i * 31 + k}." for k in range(n))


ROWS = [(i, prose(i), "en", "abc"[i % 3], 1) for i in range(12)]
ROWS += [
    (3, prose(3), "en", "a", 1),
    (20, prose(3) + "\nMenu | Home | About | Contact", "en", None, 1),
    (21, None, "en", "a", 1),
    (22, "", None, "b", 0),
    (None, prose(40), None, None, None),
    (23, "Menu | Home | About | Contact\n" * 9 + SENTENCES[0], "en", "c", 1),
    (24, "Please read our privacy policy before you go on.\n" + prose(50), "en", "c", 1),
    (25, " ".join(f"word{k}" for k in range(400)) + ". Our privacy policy is kept, and long.", "en", "c", 1),
    (26, "one two three four five " * 30, "en", "c", 1),
    (27, "$$$ ### %%% wow !!!\n" + prose(60), "en", "c", 1),
    (28, "a a b b c c d d e e stutters.\n" + prose(70), "en", "a", 1),
    (29, "x " * 3000 + "end.", "en", "a", 1),
    (30, " ".join(f"longer{k % 5000}, and" for k in range(20000)) + ".", "en", "a", 1),
]


@pytest.fixture(scope="module")
def docs(spark):
    return store.materialize(spark.createDataFrame(ROWS, SCHEMA).withColumns({k: F.lit(v) for k, v in CLASHES.items()}), "test-docs")


def plain(df):
    return sorted((tuple(r) for r in df.select(*P.COLUMNS).collect()), key=repr)


def line_fails(line):
    n = len(WORD.findall(line))
    count = lambda chars: sum(line.count(c) for c in chars)
    much = lambda k, least: k >= least and k * 10 > n * 3
    pairs, last = 0, None
    for w in re.split(r"[\x20\x09-\x0D]", line):
        if w and w == last:
            pairs, last = pairs + 1, None
        else:
            last = w
    bare = n >= 10 and not re.search(r"[.!?,;:…。！？،]", line)
    phrases = len(re.findall(quality.BOILERPLATE, line))
    return much(count("#*$%&|<>"), 3) or much(count("!"), 3) or much(count("|»›•·"), 2) or bare or much(pairs, 3) or (phrases > 0 and phrases * 40 >= n)


def cleaned(row):
    text = row[1] or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = collections.Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(5)}
    lines = text.split("\n")
    lost = sum(len(w) for x in lines if line_fails(x) for w in WORD.findall(x))
    if len(words) < 10 or 100 * len(covered) > 20 * len(words) or lost * 10 > 3 * sum(map(len, words)):
        return None
    if not any(map(line_fails, lines)):
        return row
    new = "\n".join(x for x in lines if not line_fails(x))
    return (row[0], new, *row[2:4], len(new) if lost else row[4])


def test_quality_rules(spark, docs):
    want = [x for x in map(cleaned, ROWS) if x]
    assert plain(P.quality_rules(spark, docs, "")) == sorted(want, key=repr)
    ids = {x[0] for x in want}
    assert ids >= {0, 5, 11, 20, 25, 27, 28, None} and not ids & {21, 22, 23, 26, 29} and "privacy" not in next(x[1] for x in want if x[0] == 24)
    assert plain(P.quality_rules(spark, docs.limit(0), "")) == []


def scores(model, text):
    """Softmax of the mean of the n-grams' rows, one at a time."""
    buf = b" " + bytes(c if c >= 128 or 97 <= c <= 122 else 32 for c in text.lower().encode()) + b" "
    total, count = np.zeros(len(model.languages)), 0
    for n in (2, 3, 4):
        for i in range(len(buf) - n + 1):
            gram = buf[i : i + n]
            if (gram == b"  ") if n == 2 else b" " in gram[1:-1]:
                continue
            code = int.from_bytes(gram, "big") * {2: 0x9E3779B1, 3: 0x85EBCA77, 4: 0xC2B2AE3D}[n] % (1 << 32)
            row = code >> (32 - 14)
            if row:
                total += model.table[row]
                count += 1
    logits = (total / max(1, count) + model.bias) / model.temperature
    e = [math.exp(x - max(logits)) for x in logits]
    return np.array(e) / sum(e)


def test_language_scores_against_plain_python(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = langid.train(table)
    texts = [r.text for r in table.select("text").limit(60).collect() if r.text] + ["Ünïcode straße", "a", "日本語 テキスト", "x1y", "  "]
    names, got = model.predict(pa.array(texts))
    for text, name, score in zip(texts, names, got):
        if not re.search(r"[^\W\d_]", text):
            assert name == langid.UNKNOWN and score == 0
            continue
        want = scores(model, text)
        assert abs(want.max() - score) < 1e-4 and want[model.languages.index(name)] > want.max() - 1e-4
    assert 0.25 <= model.temperature <= 10 and 0 <= model.level <= 0.5


def test_calibration_lowers_the_loss_and_rejects_noise():
    rng = np.random.default_rng(0)
    texts, labels = [], []
    for lang, letters in (("aa", "abcdefg"), ("bb", "hijklmn"), ("cc", "opqrstu")):
        for _ in range(120):
            texts.append(" ".join("".join(rng.choice(list(letters), 5)) for _ in range(40)))
            labels.append(lang)
    model = langid.fit(texts, labels)
    names, score = model.predict(pa.array(texts))
    assert (np.array(names) == np.array(labels)).mean() > 0.98
    code = [model.languages.index(x) for x in labels]
    raw = model.logits(pa.array(texts, pa.large_string()))
    loss = lambda t: -np.log(langid.softmax(raw / t)[np.arange(len(code)), code]).mean()
    assert loss(model.temperature) <= loss(1.0) + 0.02
    assert (score >= model.level).mean() > 0.98


def test_language_stage(spark, docs):
    labelled = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(*P.COLUMNS)
    both = store.materialize(docs.select(*P.COLUMNS).unionByName(labelled).withColumns({k: F.lit(v) for k, v in CLASHES.items()}), "test-language")
    model = langid.train(both)
    want = []
    for row in both.select(*P.COLUMNS).collect():
        if re.search(r"[^\W\d_]", row.text or ""):
            p = float(model.predict(pa.array([row.text]))[1][0])
            want += [tuple(row)] if p >= model.level else []
    assert plain(P.language_id(spark, both, "")) == sorted(want, key=repr)
    assert plain(P.language_id(spark, docs.limit(0), "")) == []


def test_mixing_stage(spark, docs):
    size = [len(WORD.findall(r[1] or "")) for r in ROWS]
    total = collections.Counter()
    for r, n in zip(ROWS, size):
        total[r[3]] += n
    names = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    target, free, left = {}, set(names), sum(total.values())
    while free:
        level = left / sum(weight[s] for s in free)
        full = [s for s in free if level * weight[s] >= 3 * total[s]]
        if not full:
            target |= {s: level * weight[s] for s in free}
            break
        for s in full:
            target[s] = 3 * total[s]
            left -= 3 * total[s]
            free.remove(s)
    got = P.mix_sources(spark, docs, "").collect()
    taken = collections.Counter()
    copies = collections.Counter()
    texts = {(r[0], r[1]) for r in ROWS}
    for r in got:
        n = len(WORD.findall(r.text))
        taken[r.source] += n
        copies[(r.doc_id, r.source)] += n
        assert n and ((r.doc_id, r.text) in texts or any(d == r.doc_id and t and t.startswith(r.text) for d, t in texts))
    repeats = collections.Counter()
    for r, n in zip(ROWS, size):
        repeats[(r[0], r[3])] += n
    assert all(copies[k] <= 3 * repeats[k] for k in copies)
    assert all(abs(taken[s] - target[s]) <= 2 for s in names)
    assert plain(P.mix_sources(spark, docs.limit(0), "")) == []


def test_packing_stage(spark, docs):
    from tokenizers import Tokenizer

    from cornice.llm.queries import vocabulary

    tok = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    want = collections.Counter()
    for r in ROWS:
        want[(r[0], len(tok.encode(r[1] or "", add_special_tokens=False).ids) + 1)] += 1
    got = P.pack_sequences(spark, docs, "").collect()
    have = collections.Counter()
    for r in got:
        have[(r.doc_id, r.doc_tokens)] += r.length
    assert have == {k: k[1] * n for k, n in want.items()}
    whole = [r for r in got if r.doc_id == 0 and r.length == r.doc_tokens]
    ids = tok.encode(ROWS[0][1], add_special_tokens=False).ids + [2]
    assert not whole or whole[0].ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
    assert P.pack_sequences(spark, docs.limit(0), "").count() == 0


def test_near_duplicates_of_clashing_columns(spark, docs):
    kept = plain(P.near_duplicates(spark, docs, ""))
    assert sorted(x[0] for x in kept if x[0] == 3) == [3] and 20 not in [x[0] for x in kept]
    assert {21, 22} <= {x[0] for x in kept} and plain(P.near_duplicates(spark, docs.limit(0), "")) == []


def test_run_leaves_only_what_its_result_reads(spark, tmp_path):
    folder = store.shared_dir(spark) + "/cornice"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    before = {str(x.getPath()) for x in system.listStatus(path)}
    out = P.run(spark, "/root/testdata/sf0.001").toPandas()
    after = {str(x.getPath()) for x in system.listStatus(path)} - before
    assert len(after) == 1 and "packed-" in after.pop()
    assert len(out) and (out.groupby("sequence_id")["length"].sum() <= 4096).all()
