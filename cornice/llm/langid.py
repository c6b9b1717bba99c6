"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text's subwords are the byte n-grams of its lower-cased words, with a space
for either end of a word.  Each is hashed to a row of an embedding table; the
mean of a whole text's rows goes through a linear layer.  Both are trained by
stochastic gradient descent in numpy on a bounded sample of labelled rows.  As
everything up to the softmax is linear, prediction needs one small table of
scores per hash row, which is all that is sent to the executors.

A temperature fitted on rows held back from the sample calibrates the scores;
the rejection level is the score that all but `reject` of those rows reach.

Defined cases: a null text, or one without letters, is `und` with score 0; rows
with a null label don't train; without any labelled row everything is `und`; ties
go to the first label by code point.  A null doc_id is an id like any other; rows that
repeat ids or texts are predicted each, and drawn by their text, too.  A kept column named as a result is left out
for it.  More than MOST_LABELS labels raise ValueError, as table and sample grow
with their number.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .text_hash import padded, raw_bytes, slices

UNKNOWN = "und"
BUCKETS = 1 << 14
DIMENSIONS = 8
NGRAMS = (2, 3, 4)
#: Bound of the training sample: expected rows per language, and characters of a row that may be drawn.
SAMPLE_ROWS = 500
SAMPLE_CHARS = 20_000
MOST_LABELS = 1000
#: Scores looked up at a time: bytes of text times labels.
SCORES = 1 << 23
EPOCHS = 6
BATCH = 16
RATE = 0.5

#: Fixed odd multipliers, one for each n.
_ODD = {2: 0x9E3779B1, 3: 0x85EBCA77, 4: 0xC2B2AE3D}

_LETTERS = np.full(256, 0x20, np.uint8)
_LETTERS[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LETTERS[0x80:] = np.arange(0x80, 0x100)


def subwords(buf: np.ndarray) -> Iterator[np.ndarray]:
    """For each n, the hash row of the n-gram that begins at each byte of buf; row 0 if it isn't within a word."""
    blank = buf == 0x20
    code = buf.astype(np.uint32)
    for n in range(2, NGRAMS[-1] + 1):
        m = len(buf) - n + 1
        if m < 1:
            return
        code = (code[:m] << np.uint32(8)) | buf[n - 1 :]
        if n == 2:
            bad = blank[:-1] & blank[1:]
            inner = np.zeros(len(buf), bool)
        else:
            # No blank but at the ends.
            inner = inner[:m] | blank[n - 2 : n - 2 + m]
            bad = inner
        rows = (code * np.uint32(_ODD[n])) >> np.uint32(32 - BUCKETS.bit_length() + 1)
        rows[bad[:m]] = 0
        yield rows


def _prepared(column: pa.Array):
    """Slices of a text column: number of rows, bytes with all but letters blank, row starts."""
    data, ends = raw_bytes(pc.utf8_lower(column))
    for i, j in slices(ends, 1 << 20):
        buf, starts = padded(data, ends, i, j)
        yield j - i, np.concatenate((np.full(1, 0x20, np.uint8), _LETTERS[buf])), starts + 1


@dataclass
class Model:
    """Scores per hash row, and what turns sums of them into probabilities."""

    languages: list[str]
    table: np.ndarray  # buckets x languages
    bias: np.ndarray
    temperature: float = 1.0
    level: float = 0.0

    def logits(self, column: pa.Array) -> np.ndarray:
        out = []
        table = np.concatenate((self.table, np.ones((BUCKETS, 1), np.float32)), axis=1)
        table[0] = 0
        step = max(1, SCORES // table.shape[1])
        for rows, buf, starts in _prepared(column):
            total = np.zeros((rows, table.shape[1]))
            begin = starts - 1  # the blank before a row belongs to it
            for low in range(0, len(buf), step):
                # The last subword that begins in a piece may end beyond it.
                for found in subwords(buf[low : low + step + NGRAMS[-1] - 1]):
                    found = found[:step]
                    first, last = np.searchsorted(begin, [low, low + len(found) - 1], side="right") - 1
                    cuts = np.maximum(begin[first : last + 1] - low, 0)
                    total[first : last + 1] += np.add.reduceat(table[found], cuts, axis=0, dtype=np.float64)
            out.append(total[:, :-1] / np.maximum(total[:, -1:], 1) + self.bias)
        return np.concatenate(out) if out else np.zeros((0, len(self.languages)))

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        p = softmax(self.logits(column) / self.temperature)
        letters = pc.fill_null(pc.match_substring_regex(column, r"\p{L}"), False).to_numpy(zero_copy_only=False)
        best = p.argmax(axis=1) if len(p) else np.zeros(0, np.int64)
        names = [self.languages[b] if ok else UNKNOWN for b, ok in zip(best, letters, strict=True)]
        return names, np.where(letters, p.max(axis=1) if len(p) else 0.0, 0.0)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True)) if len(x) else x
    return e / e.sum(axis=1, keepdims=True) if len(x) else x


def _bags(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Hash rows of each text with their shares."""
    out = []
    for text in texts:
        found = [r for _, buf, _ in _prepared(pa.array([text], pa.large_string())) for r in subwords(buf)]
        rows, count = np.unique(np.concatenate(found), return_counts=True)
        rows, count = rows[rows > 0], count[rows > 0]
        out.append((rows, (count / max(1, count.sum())).astype(np.float32)))
    return out


def fit(texts: list[str], labels: list[str], reject: float = 0.002, seed: int = 7) -> Model:
    """Train by stochastic gradient descent; a fifth of the rows is held back for calibration."""
    languages = sorted(set(labels))
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0))
    rng = np.random.default_rng(seed)
    code = np.searchsorted(languages, labels)
    bags = _bags(texts)
    order = rng.permutation(len(bags))
    held = order[: len(order) // 5]
    train = order[len(order) // 5 :]
    emb = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    out, bias = np.zeros((DIMENSIONS, len(languages)), np.float32), np.zeros(len(languages), np.float32)
    steps, step = EPOCHS * -(-len(train) // BATCH), 0
    for _ in range(EPOCHS):
        rng.shuffle(train)
        for at in range(0, len(train), BATCH):
            some = train[at : at + BATCH]
            rate = RATE * (1 - step / steps)
            step += 1
            rows = np.concatenate([bags[i][0] for i in some])
            share = np.concatenate([bags[i][1] for i in some])
            who = np.repeat(np.arange(len(some)), [len(bags[i][0]) for i in some])
            mean = np.zeros((len(some), DIMENSIONS), np.float32)
            np.add.at(mean, who, emb[rows] * share[:, None])
            miss = softmax(mean @ out + bias)
            miss[np.arange(len(some)), code[some]] -= 1
            back = miss @ out.T
            out -= rate * (mean.T @ miss)
            bias -= rate * miss.sum(axis=0) * 0.1
            # The step of an embedding row is scaled up, as each holds a small share of the mean.
            np.add.at(emb, rows, -(rate * 20) * share[:, None] * back[who])
    model = Model(languages, (emb @ out).astype(np.float32), bias.astype(np.float64))
    held = held if len(held) else order
    raw = model.logits(pa.array([texts[i] for i in held], pa.large_string()))
    loss = {t: -np.log(softmax(raw / t)[np.arange(len(held)), code[held]] + 1e-12).mean() for t in np.geomspace(0.25, 10, 38)}
    model.temperature = float(min(loss, key=loss.get))
    best = softmax(raw / model.temperature).max(axis=1)
    model.level = float(min(0.5, np.quantile(best, reject)))
    return model


def sample(labelled: DataFrame, rows: int = SAMPLE_ROWS, key: str = "doc_id", text: str = "text", label: str = "lang") -> tuple[list[str], list[str]]:
    """About rows texts of each label, by hash of key and text, twice as many at most: the same ones each time.

    Texts of more than SAMPLE_CHARS are not drawn, so a label that only they carry isn't learned.
    """
    usable = labelled.where(F.col(label).isNotNull() & (F.length(text) <= SAMPLE_CHARS) & (F.length(text) > 0)).select(key, text, label)
    counts = {r[label]: r["count"] for r in usable.groupBy(label).count().collect()}
    if not counts:
        return [], []
    if len(counts) > MOST_LABELS:
        raise ValueError(f"{len(counts)} labels, {MOST_LABELS} at most")
    draw = F.pmod(F.xxhash64(F.lit("langid"), F.col(key), F.col(text)), F.lit(1 << 30)) / float(1 << 30)
    share = F.coalesce(*[F.when(F.col(label) == k, F.lit(min(1.0, rows / n))) for k, n in sorted(counts.items())])
    drawn = usable.withColumn("_draw", draw).where(F.col("_draw") < share)
    # Rows that repeat key and text are drawn together, however many.
    place = F.row_number().over(Window.partitionBy(label).orderBy("_draw"))
    got = drawn.withColumn("_n", place).where(F.col("_n") <= 2 * rows).select(key, text, label).toPandas().sort_values([key, text])
    return got[text].tolist(), got[label].tolist()


def _predict(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        for batch in batches:
            text = batch.column(len(batch.schema) - 1)
            names, score = model.predict(text) if model.languages else ([UNKNOWN] * len(batch), np.zeros(len(batch)))
            keep = batch.schema.names[:-1]
            arrays = [batch.column(i) for i in range(len(keep))]
            arrays += [pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array([n != UNKNOWN and s >= model.level for n, s in zip(names, score, strict=True)], pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, [*keep, "lang_pred", "score", "accepted"])

    return run


RESULT = ("lang_pred", "score", "accepted")


def identify(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns keep of docs (all if None), and lang_pred, score, accepted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in RESULT]
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("_text" + "_".join(keep)))
    kept = docs.select(*[F.col(f"`{c}`") for c in keep]).schema
    schema = kept.add("lang_pred", "string").add("score", "double").add("accepted", "boolean")
    return rows.mapInArrow(_predict(shared), schema)


def held_out(key: Column) -> Column:
    """Whether a row serves to measure only: crc32 of the key as text leaves 2 by 4."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit(""))), F.lit(4)) == 2


def train(docs: DataFrame, rows: int = SAMPLE_ROWS, key: str = "doc_id", text: str = "text", label: str = "lang") -> Model:
    """A model from the labelled rows of docs that aren't held out."""
    return fit(*sample(docs.where(~held_out(F.col(key))), rows, key, text, label))
