"""The n-gram join against brute force, and its steps against plain Python."""

import re
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cornice.llm import ngram_join
from cornice.llm.components import _stars

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def groups(sets, percent):
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if n and 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                root[find(i)] = find(j)
    return [find(i) for i in range(len(sets))]


def expected(rows, n, percent):
    sets = [shingles(t, n) for _, t in rows]
    of = groups(sets, percent)
    least = {}
    for (d, _), g in zip(rows, of):
        if d is not None:
            least[g] = min(d, least.get(g, d))
    return sorted(((d, len(s), d if not s else least.get(g)) for (d, _), s, g in zip(rows, sets, of)), key=repr)


def found(df, n, percent, **options):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.link_classes(df, n, percent, **options).collect()), key=repr)


def corpus(seed):
    """Copies, near copies, chains, shared passages, short and long texts, odd rows."""
    rng = np.random.default_rng(seed)
    say = lambda tag, k: [f"{tag}{i}" for i in range(k)]
    passage = say("passage", 55)
    texts = [None, "", " \n\t", "one", "one", "ONE", "two words", "x y z", "x y z"]
    for size in (6, 12, 30, 45, 60, 120, 700):
        base = say(f"b{seed}s{size}w", size)
        for i in range(7):
            w = list(base)
            for k in rng.integers(0, size, i % 4):
                w[k] = f"new{i}-{k}"
            texts.append(" ".join(w))
        texts += [" ".join(base[i:] + say(f"tail{size}x{i}w", i)) for i in range(0, size, max(1, size // 9))]
    texts += [" ".join(say(f"own{i}w", int(rng.integers(1, 40))) + passage) for i in range(25)]
    texts += [" ".join(passage[: 40 + i]) for i in range(10)]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(None, texts[9]), (None, texts[9]), (None, " ".join(say("null", 50))), (None, " ".join(say("null", 50) + ["end"])), (3, texts[20]), (3, texts[20])]
    return [rows[i] for i in rng.permutation(len(rows))]


@pytest.mark.parametrize(
    ("n", "percent", "options"),
    [(4, 85, {}), (4, 85, {"block_tokens": 50, "frequent_least": 1}), (5, 80, {"frequent_least": 3}), (4, 90, {"frequent_least": 1}), (1, 96, {"frequent_least": 1}), (1, 50, {"frequent_least": 2})],
)
def test_matches_brute_force(spark, n, percent, options, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", 8 if "block_tokens" in options else 512)
    rows = corpus(percent)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"ck": F.lit(1), "key": F.lit("k"), "n": F.lit(2)}).repartition(5)
    assert found(df, n, percent, **options) == expected(rows, n, percent)


def test_one_frequent_token_links_sets(spark):
    a = [f"t{i}" for i in range(100)]
    rows = [(1, " ".join(a)), (2, " ".join(a[:99]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df, 1, 99, frequent_least=1) == [(1, 100, 1), (2, 99, 1)]


def test_empty_table(spark):
    assert found(spark.createDataFrame([], "doc_id long, text string"), 4, 85) == []


@pytest.mark.parametrize("seed", range(12))
def test_block_labels(seed):
    rng = np.random.default_rng(seed)
    percent = int(rng.choice([50, 80, 85, 95]))
    bases = [rng.choice(3000, int(rng.integers(5, 60)), replace=False) for _ in range(6)]
    sets = []
    for _ in range(150):
        s = set(bases[rng.integers(6)].tolist())
        for _ in range(int(rng.integers(0, 9))):
            s.discard(int(rng.choice(sorted(s)))) if len(s) > 2 and rng.integers(2) else s.add(int(rng.integers(0, 9000)))
        sets.append(s)
    tokens = [np.array(sorted(s), np.uint64) for s in sets]
    label, _ = ngram_join.link_block(tokens, np.arange(len(sets)), percent)
    want = groups(sets, percent)
    assert len(set(zip(label.tolist(), want))) == len(set(label.tolist())) == len(set(want))
    probe = rng.integers(0, 4, len(sets)) == 0
    label, _ = ngram_join.link_block(tokens, np.arange(len(sets)), percent, probe)
    for i in np.flatnonzero(probe):
        for j in range(len(sets)):
            n = len(sets[i] & sets[j])
            if 100 * n >= percent * len(sets[i] | sets[j]):
                assert label[i] == label[j]
            assert label[i] != label[j] or want[i] == want[j]


def test_large_groups_of_near_copies_take_seconds():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 60, 40).astype(np.uint64)
    other = np.concatenate((base[:30], rng.integers(0, 1 << 60, 12).astype(np.uint64)))
    tokens = [np.sort(np.append((base if i % 2 else other)[1:], np.uint64(i))) for i in range(16_000)]
    began = time.time()
    label, _ = ngram_join.link_block(tokens, np.arange(len(tokens)), 85)
    assert np.unique(label).tolist() == [0, 1] and time.time() - began < 20


def test_classes_that_fill_several_batches_are_indexed_whole():
    n = 400
    rows = ngram_join._rows(1, np.full(n, 5), np.arange(n), np.full(n, n), np.full(n, 2))
    other = ngram_join._rows(1, np.full(n, 6), np.arange(n), np.full(n, n), np.full(n, 2))
    whole = pa.Table.from_batches([rows, other]).combine_chunks().to_batches()[0]
    seen = []
    for cut in (len(whole), 150, 7):
        out = ngram_join._index(85)(iter([whole.slice(i, cut) for i in range(0, len(whole), cut)] + [whole.slice(0, 0)]))
        got = {(k, a, b) for batch in out for k, a, b in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)}
        assert got and all(k == 0 or (a, b) == (6, 5) for k, a, b in got)
        # What every key ties: its least class, directly or by an edge.
        seen.append(({a for k, a, _ in got if k == 0}, any(k == 1 for k, *_ in got) or {b for k, _, b in got if k == 0} == {5, 6}))
    assert seen[0] == seen[1] == seen[2] and seen[0][1]


def test_shared_tokens_whatever_is_held(monkeypatch):
    rng = np.random.default_rng(2)
    tok, ck = rng.integers(0, 40, 3000) ** 2 // 40, rng.integers(0, 300, 3000)
    order = np.lexsort((ck, tok))
    rows = ngram_join._rows(0, tok[order], ck[order], ck[order] + 7)
    more = ngram_join._rows(3, np.arange(5), np.arange(5), np.arange(5))
    results = []
    for most in (1 << 20, 64):
        monkeypatch.setattr(ngram_join, "HELD_ROWS", most)
        for cut in (3000, 70, 1):
            out = list(ngram_join._shared(iter([rows.slice(i, cut) for i in range(0, 3000, cut)] + [more])))
            got = [r for batch in out for r in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True)]
            results.append({r[:4] for r in got})
            assert len({r[:4] for r in got}) == len(got)
            per = {}
            for k, _, b, _, d in got:
                if k == 1:
                    per.setdefault(b, set()).add(d)
            assert all(len(x) == 1 for x in per.values())  # one order for all
    df = {t: len(set(ck[tok == t])) for t in np.unique(tok)}
    want = {(1, int(c), int(t), int(c) + 7) for t, c in zip(tok, ck) if df[t] > 1} | {(3, i, i, i) for i in range(5)}
    assert all(r == want for r in results)


def test_meeting_keys_ties_the_same_classes_whatever_is_held(monkeypatch):
    rng = np.random.default_rng(5)
    kind = np.sort(rng.integers(0, 2, 3000))
    a, b = rng.integers(0, 900, 3000), rng.integers(0, 400, 3000)
    order = np.lexsort((b, a, kind))
    rows = ngram_join._rows(0, a[order], b[order])
    rows = pa.RecordBatch.from_arrays([pa.array(kind[order].astype(np.int32)), *rows.columns[1:]], rows.schema.names)
    found = []
    for most in (1 << 21, 64):
        monkeypatch.setattr(ngram_join, "MEET_EDGES", most)
        out = ngram_join._meet(iter([rows.slice(i, 70) for i in range(0, 3000, 70)]))
        found.append({(x, y) for batch in out for x, y in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)})
    def pieces(edges):
        ends = np.array(sorted(edges)).T
        batch = _stars(ends)
        return set(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))

    least = {}
    for k, x, y in zip(kind[order].tolist(), a[order].tolist(), b[order].tolist(), strict=True):
        if k == 0:
            least[x] = min(least.get(x, y), y)
    want = {(y, least[x]) if k == 0 else (x, y) for k, x, y in zip(kind[order].tolist(), a[order].tolist(), b[order].tolist(), strict=True) if k or y != least[x]}
    assert pieces(found[0]) == pieces(found[1]) == pieces(want)
    assert found[0] == pieces(want)  # held at once, a row for each class but one of a piece
