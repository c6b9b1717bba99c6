"""Approximate nearest neighbours on shifted space-filling curves.

Each of several curves projects the vectors to a few random directions, shifts
and quantises them and takes the Hilbert index of the cell as key.  Vectors are
range-partitioned by (curve, key); a prefix sum over partitions turns places
into ranks, and ranks are cut into tiles of equal size, so that a dense spot of
the space never makes a large group.  A query looks at the tiles that its window
of ranks touches on every curve, takes the best of each, and the results are
merged and ranked by the exact measure.

The window's width and the number of curves, two at least, are fitted: for a
bounded sample of queries the true neighbours among all rows are found, and for
each number of curves the width is the one that holds `recall` of them on at least
one curve.  The number that makes a query look at the fewest rows is taken
(search_plan tells the share; above 1 rows are met on more than one curve).
Vectors without structure need wide windows, as their neighbours are hardly nearer
in any projection than other rows; the work then grows with the square of the rows,
as brute force does.  The queries of a tile are dealt over groups of about
TILE_QUERIES, so a task's memory is bounded, and a task merges what its tiles found
for a query before that is shuffled.

Defined cases: rows with a null id or a vector that is null, empty, all zero, or
has null or non-finite components take no part, nor do vectors whose length
isn't the commonest one; rows that repeat an id with the same vector count once.
An id with several vectors is one neighbour, by the best score of its vectors, and
one query, of all its vectors.  Ties go to the smaller vec_id.  An empty table, or
one without usable vectors or queries, gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import materialize, tasks_for

#: Curves that are tried, and the fewest that are used.
CURVES, FEWEST = 3, 2
DIRECTIONS = 3
BITS = 10
TILE = 2048
TILE_QUERIES = 4096
#: Rows that the quantiser is fitted on, and queries that the window is fitted on.
SAMPLE_VECTORS = 2000
SAMPLE_QUERIES = 48


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of integer cells (rows x dimensions), by Skilling's transposed form."""
    x = [cells[:, i].astype(np.int64) for i in range(cells.shape[1])]
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(len(x)):
            on = (x[i] & q) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(on, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap
        q >>= 1
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip = np.where((x[-1] & q) != 0, flip ^ (q - 1), flip)
        q >>= 1
    x = [v ^ flip for v in x]
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for v in x:
            key = (key << 1) | ((v >> b) & 1)
    return key


class Curves:
    """Random directions and, for each, the quantiles of a sample as cell bounds, shifted for every curve."""

    def __init__(self, sample: np.ndarray, curves: int, directions: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        dim = sample.shape[1]
        directions = min(directions, dim)
        self.planes = []
        for _ in range(curves):
            basis = np.linalg.qr(rng.normal(size=(dim, dim)))[0][:, :directions]
            places = np.linspace(0, 1, 257)
            self.planes.append((basis, [np.quantile(p, places) for p in (sample @ basis).T], rng.uniform(0, 1, directions)))

    def keys(self, x: np.ndarray, curve: int) -> np.ndarray:
        basis, bounds, shift = self.planes[curve]
        at = np.stack([np.interp(p, b, np.linspace(0, 1, len(b))) for p, b in zip((x @ basis).T, bounds, strict=True)], axis=1)
        # The shift moves the grid: the unit cube sits somewhere in a cube twice as wide.
        return hilbert(((at + shift) / 2 * ((1 << BITS) - 1)).astype(np.int64), BITS)


_KEYED = "curve int, key long, vec_id long, is_query boolean, vec binary"


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _key(curves, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted: Curves = curves.value
        for batch in batches:
            x = _vectors(batch.column(2), dim)
            raw = pa.array([v.tobytes() for v in x], pa.binary())
            for c in range(len(fitted.planes)):
                keys = fitted.keys(x.astype(np.float64), c)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), c, np.int32)), pa.array(keys), batch.column(0), batch.column(1), raw], ["curve", "key", "vec_id", "is_query", "vec"])

    return run


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add the partition and, per curve, the place within it."""
    part, seen = TaskContext.get().partitionId(), {}
    for batch in batches:
        curve = batch.column(0).to_numpy()
        place = np.zeros(len(curve), np.int64)
        for c in np.unique(curve):
            at = np.flatnonzero(curve == c)
            place[at] = seen.get(c, 0) + np.arange(len(at))
            seen[c] = seen.get(c, 0) + len(at)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(curve), part, np.int64)), pa.array(place)], [*batch.schema.names, "part", "place"])


def _top(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Indexes of the k largest scores, ties to the smaller id."""
    if len(score) > k:
        pick = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    else:
        pick = np.arange(len(score))
    return pick[np.lexsort((ids[pick], -score[pick]))][:k]


def _search(q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, x_ids: np.ndarray, k: int) -> tuple[list, list]:
    """For each query the best ids of x and their scores, without its own id.

    An id's score is the best of its rows, so that no id takes two of the k places.
    """
    order = np.argsort(x_ids, kind="stable")
    x, x_ids = x[order], x_ids[order]
    names, start, rows = np.unique(x_ids, return_index=True, return_counts=True)
    found, scores = [], []
    for at in range(0, len(q), 256):
        near = q[at : at + 256] @ x.T
        near[q_ids[at : at + 256, None] == x_ids[None, :]] = -np.inf
        if len(names) < len(x_ids):
            near = np.maximum.reduceat(near, start, axis=1)
        for i, row in enumerate(near):
            pick = _top(row, names, k)
            pick = pick[row[pick] > -np.inf]
            # Summed in one order wherever the pair meets, so that a pair has one score.
            run = np.cumsum(rows[pick]) - rows[pick]
            all_rows = np.repeat(start[pick] - run, rows[pick]) + np.arange(rows[pick].sum())
            exact = (x[all_rows] * q[at + i]).sum(axis=1)
            exact = np.maximum.reduceat(exact, run) if len(pick) else exact
            order = np.lexsort((names[pick], -exact))
            found.append(names[pick][order].tolist())
            scores.append(exact[order].tolist())
    return found, scores


_FOUND = "query_id long, ids array<long>, scores array<double>"


def _scan(sample, dtype: str, k: int):
    """Best rows of each batch for the sample queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, q = sample.value
        for batch in batches:
            if len(batch):
                x = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype).reshape(len(batch), -1).astype(np.float64)
                found, scores = _search(q, ids, x, batch.column(0).to_numpy(), k)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(found, pa.list_(pa.int64())), pa.array(scores, pa.list_(pa.float64()))], ["query_id", "ids", "scores"])

    return run


def _tile(dtype: str, k: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.frombuffer(b"".join(pdf["vec"]), dtype).reshape(len(pdf), -1).astype(np.float64)
        ids, ask = pdf["vec_id"].to_numpy(), pdf["ask"].to_numpy()
        if not ask.any() or ask.all():
            return pd.DataFrame({"query_id": [], "ids": [], "scores": []}, dtype=object)
        found, scores = _search(x[ask], ids[ask], x[~ask], ids[~ask], k)
        return pd.DataFrame({"query_id": ids[ask], "ids": found, "scores": scores})

    return run


#: Lists that a task holds before it merges them.
HELD = 1 << 14


def _partly(k: int):
    """Lists of one query that a task has, merged into one of k."""

    def flush(held: list[pd.DataFrame]) -> pd.DataFrame:
        pdf = pd.concat(held)
        query = np.repeat(pdf["query_id"].to_numpy(np.int64), [len(x) for x in pdf["ids"]])
        ids = np.concatenate([np.asarray(x, np.int64) for x in pdf["ids"]])
        scores = np.concatenate([np.asarray(x, np.float64) for x in pdf["scores"]])
        # Of an id the best score, then of a query the k best ids.
        at = np.lexsort((-scores, ids, query))
        at = at[np.concatenate(([True], (np.diff(query[at]) != 0) | (np.diff(ids[at]) != 0)))[: len(at)]]
        at = at[np.lexsort((ids[at], -scores[at], query[at]))]
        names, start, size = np.unique(query[at], return_index=True, return_counts=True)
        at = at[np.arange(len(at)) - np.repeat(start, size) < k]
        cuts = np.cumsum(np.minimum(size, k))[:-1]
        return pd.DataFrame({"query_id": names, "ids": [x.tolist() for x in np.split(ids[at], cuts)] if len(names) else [], "scores": [x.tolist() for x in np.split(scores[at], cuts)] if len(names) else []})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for pdf in batches:
            if len(pdf):
                held.append(pdf)
                size += len(pdf)
            if size >= HELD:
                yield flush(held)
                held, size = [], 0
        if held:
            yield flush(held)

    return run


def _merge(k: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        ids = np.concatenate([np.asarray(x, np.int64) for x in pdf["ids"]])
        scores = np.concatenate([np.asarray(x, np.float64) for x in pdf["scores"]])
        best = np.lexsort((-scores, ids))
        ids, scores = ids[best], scores[best]
        ids, first = np.unique(ids, return_index=True)
        pick = _top(scores[first], ids, k)
        return pd.DataFrame({"query_id": pdf["query_id"].iloc[0], "rank": np.arange(1, len(pick) + 1, dtype=np.int32), "vec_id": ids[pick], "score": scores[first][pick]})

    return run


_RESULT = "query_id long, rank int, vec_id long, score double"


def reach(r: np.ndarray, s: np.ndarray, n: int) -> np.ndarray:
    """Half-widths of windows around rank r, moved inside 0..n-1, that just hold rank s."""
    return np.where(s > r, np.minimum(s - r, (s + 1) // 2), np.minimum(r - s, (n - s) // 2))


def search(vectors: DataFrame, queries: Column, k: int = 20, recall: float = 0.95, curves: int = CURVES, directions: int = DIRECTIONS, tile: int = TILE, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """The k rows found with the largest inner product for each row where queries holds.

    Result: query_id, rank (from 1), vec_id, score, nearest first, ties to the smaller vec_id.
    """
    found = _ranked(vectors, queries, curves, directions, vec_id, embedding)
    if found is None:
        return vectors.sparkSession.createDataFrame([], _RESULT)
    ranked, n, dtype = found
    used, half, asked = _fit_window(ranked, n, dtype, k, recall, curves)
    if not asked:
        return vectors.sparkSession.createDataFrame([], _RESULT)
    tile = min(tile, max(64, n // 16))
    low = F.greatest(F.lit(0), F.least(F.col("rank") - half, F.lit(n - 1 - 2 * half)))
    high = F.least(F.lit(n - 1), low + 2 * half)
    # Ranks are even, so a tile is asked by about this many queries; each group has some of them.
    groups = max(1, -(-asked * min(n, 2 * half + 2 * tile) // n // TILE_QUERIES))
    ranked = ranked.where(F.col("curve") < used)
    every = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    base = ranked.select("curve", F.floor(F.col("rank") / tile).alias("tile"), every.alias("group"), "vec_id", "vec", F.lit(False).alias("ask"))
    tiles = F.explode(F.sequence(F.floor(low / tile), F.floor(high / tile)))
    one = F.pmod(F.xxhash64(F.lit(3), "vec_id"), F.lit(groups)).cast("int")
    ask = ranked.where("is_query").select("curve", tiles.alias("tile"), one.alias("group"), "vec_id", "vec", F.lit(True).alias("ask"))
    tasks = tasks_for(vectors.sparkSession, n * used * groups, 4 * tile)
    dealt = base.unionByName(ask).repartition(tasks, "curve", "tile", "group")
    found = dealt.groupBy("curve", "tile", "group").applyInPandas(_tile(dtype, k), _FOUND)
    return found.mapInPandas(_partly(k), _FOUND).groupBy("query_id").applyInPandas(_merge(k), _RESULT)


def search_plan(vectors: DataFrame, queries: Column, k: int = 20, recall: float = 0.95, curves: int = CURVES, directions: int = DIRECTIONS, vec_id: str = "vec_id", embedding: str = "embedding") -> dict[str, float]:
    """What search() would do: rows, curves, half of the window, and the share of all rows that a query looks at."""
    found = _ranked(vectors, queries, curves, directions, vec_id, embedding)
    if found is None:
        return {"rows": 0, "curves": 0, "half": 0, "share": 0.0}
    used, half, _ = _fit_window(*found, k, recall, curves)
    return {"rows": found[1], "curves": used, "half": half, "share": used * min(1.0, (2 * half + 1) / found[1])}


def _ranked(vectors: DataFrame, queries: Column, curves: int, directions: int, vec_id: str, embedding: str) -> tuple[DataFrame, int, str] | None:
    """curve, rank, vec_id, is_query and vec of all usable vectors, their number and the type of vec's numbers."""
    spark = vectors.sparkSession
    v = F.col("v")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.coalesce(queries, F.lit(False)).alias("is_query"), F.col(f"`{embedding}`").alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & F.forall(v, finite) & F.exists(v, lambda x: x != 0))
    rows = materialize(rows.groupBy("vec_id", "v").agg(F.max("is_query").alias("is_query")).select("vec_id", "is_query", "v"), "ann-rows")
    commonest = rows.groupBy(F.size(v).alias("d")).count().orderBy(F.desc("count"), "d").first()
    if commonest is None:
        return None
    dim, n = commonest["d"], commonest["count"]
    rows = rows.where(F.size(v) == dim)
    dtype = "<f4" if vectors.schema[embedding].dataType.elementType.typeName() == "float" else "<f8"
    rows = rows if dtype == "<f4" else rows.withColumn("v", v.cast("array<double>"))
    draw = F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, SAMPLE_VECTORS / n))
    drawn = rows.where(draw).select("v").toPandas()["v"]
    drawn = drawn if len(drawn) else rows.limit(1).toPandas()["v"]
    fitted = spark.sparkContext.broadcast(Curves(np.stack(drawn.to_list()).astype(np.float64), curves, directions))

    keyed = rows.mapInArrow(_key(fitted, dim), _KEYED)
    keyed = keyed.repartitionByRange(tasks_for(spark, n * curves, 100_000), "curve", "key", "vec_id").sortWithinPartitions("curve", "key", "vec_id")
    placed = materialize(keyed.mapInArrow(_number, _KEYED + ", part long, place long"), "ann-keys")
    # Ranks: places in partitions plus what lies before; the totals are one row per partition and curve,
    # a few for each 100,000 vectors.
    sizes = sorted((r["curve"], r["part"], r["count"]) for r in placed.groupBy("curve", "part").count().collect())
    starts, at = [], {}
    for c, p, size in sizes:
        starts.append((c, p, at.get(c, 0)))
        at[c] = at.get(c, 0) + size
    starts = F.broadcast(spark.createDataFrame(starts, "curve int, part long, start long"))
    return placed.join(starts, ["curve", "part"]).withColumn("rank", F.col("start") + F.col("place")), n, dtype


def _fit_window(ranked: DataFrame, n: int, dtype: str, k: int, recall: float, curves: int) -> tuple[int, int, int]:
    """Curves to use, half of the window in ranks, from the true neighbours of a sample of queries; and the number of queries."""
    spark = ranked.sparkSession
    one = ranked.where("curve = 0")
    total = one.where("is_query").count()
    if not total:
        return min(FEWEST, curves), 0, 0
    drawn = F.pmod(F.xxhash64(F.lit(2), "vec_id"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, 2 * SAMPLE_QUERIES / total))
    some = one.where(F.col("is_query") & drawn).select("vec_id", "vec").orderBy("vec_id").limit(SAMPLE_QUERIES).toPandas()
    if not len(some):
        return min(FEWEST, curves), n // 2, total
    q = np.frombuffer(b"".join(some["vec"]), dtype).reshape(len(some), -1).astype(np.float64)
    sample = spark.sparkContext.broadcast((some["vec_id"].to_numpy(np.int64), q))
    near = one.select("vec_id", "vec").mapInArrow(_scan(sample, dtype, k), _FOUND).groupBy("query_id").applyInPandas(_merge(k), _RESULT).toPandas()
    if not len(near):
        return min(FEWEST, curves), 0, total
    wanted = sorted({*near["vec_id"].tolist(), *near["query_id"].tolist()})
    # Of an id with several vectors the outermost ranks count, so that the window holds whichever scores best.
    ranks = ranked.where(F.col("vec_id").isin(wanted)).groupBy("curve", "vec_id").agg(F.min("rank").alias("low"), F.max("rank").alias("high")).toPandas()
    need, best = None, None
    for c in range(curves):
        ends = ranks[ranks["curve"] == c].set_index("vec_id")[["low", "high"]]
        r, s = ends.loc[near["query_id"]].to_numpy().T, ends.loc[near["vec_id"]].to_numpy().T
        w = np.max([reach(x, y, n) for x in r for y in s], axis=0)
        need = w if need is None else np.minimum(need, w)
        half = int(np.quantile(need, recall, method="higher"))
        cost = (c + 1) * min(n, 2 * half + 1)
        if c + 1 >= min(FEWEST, curves) and (best is None or cost < best[0]):
            best = (cost, c + 1, half)
    return best[1], best[2], total
