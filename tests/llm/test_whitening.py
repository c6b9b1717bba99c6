"""Whitening against an eigendecomposition in numpy, and odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cornice.llm import whitening as L


def table(spark, rows, extra=""):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<float>{extra}")


def against_numpy(df, out):
    p = df.toPandas()
    x = np.array([[int(np.floor(64 * float(c))) + 1000000 for c in v] for v in p["embedding"]])
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    c = (n * fit - s) / n
    e, v = np.linalg.eigh(c.T @ c / n)
    e, v = e[::-1], v[:, ::-1]
    k = min(16, x.shape[1])
    g = out.toPandas()
    assert len(g) == len(p) * k and set(g["n"]) == {n} and g["identity_error"].nunique() == 1 and g["identity_error"].max() < 1e-9
    share = g.groupby("component")["explained"].agg(["min", "max"])
    assert (share["min"] == share["max"]).all() and np.allclose(share["min"], e[:k] / e.sum(), rtol=1e-9)
    w = g.drop_duplicates(["vec_id", "component"]).set_index(["vec_id", "component"])["whitened"].unstack().loc[p["vec_id"]].values
    want = ((n * x - s) / n) @ v[:, :k] / np.sqrt(e[:k])
    sign = np.sign((w * want).sum(0))
    assert np.abs(w * sign - want).max() < 1e-8
    d = g.drop_duplicates("vec_id").set_index("vec_id")["deviation"].loc[p["vec_id"]].values
    assert (d == ((n * x - s) ** 2).sum(1)).all()


@pytest.mark.parametrize("d", [3, 20])
def test_against_numpy(spark, d):
    r = np.random.default_rng(d)
    base = r.normal(size=(400, d)) * np.linspace(3, 0.5, d)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(base)] + [(1000 + i, [float(c) for c in base[0]]) for i in range(300)]
    df = table(spark, rows).repartition(7)
    against_numpy(df, L.whiten(df))


def test_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    against_numpy(df, L.whiten(df))


def test_odd_rows(spark):
    r = np.random.default_rng(1)
    good = [(i, [float(c) for c in r.normal(size=4)]) for i in range(50)]
    bad = [(100, None), (101, []), (102, [1.0, None, 1.0, 1.0]), (103, [1.0, float("nan"), 1.0, 1.0]), (104, [float("inf")] * 4), (105, [1.0] * 3)]
    again = [(None, good[0][1]), (1, good[1][1]), (1, good[2][1])]
    df = table(spark, good + bad + again).withColumns({c: F.lit("z") for c in ("x", "id", "n", "component", "whitened")})
    out = L.whiten(df).collect()
    assert len(out) == 4 * (len(good) + len(again)) and {r.n for r in out} == {50}
    assert sum(r.vec_id is None for r in out) == 4 and sum(r.vec_id == 1 for r in out) == 12
    assert not {r.vec_id for r in out} & {x[0] for x in bad}
    assert L.whiten(table(spark, bad[:2])).count() == 0 and L.whiten(df.limit(0)).count() == 0
    assert L.whiten(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    flat = L.whiten(table(spark, [(i, [float(i), 5.0, 2.0 * i]) for i in range(20)])).collect()
    assert {r.component for r in flat} == {1} and abs(flat[0].explained - 1) < 1e-9


def test_merge_tree_and_bounds(spark):
    parts = spark.range(0, 1000, 1, 9).select(F.col("id").alias("part"), F.col("id").cast("string").cast("binary").alias("value"))
    joined = L.tree_merge(parts, lambda v: b",".join(v), 8, 1000)
    assert joined == b",".join(str(i).encode() for i in range(1000))
    model = L.Whitening(3, np.array([0, 0]), np.eye(2))
    far, _ = model.apply(np.array([[2**31, 2**30], [2, 1]]))
    assert far.mask.tolist() == [True, False] and far[1] == 45
    with pytest.raises(OverflowError):
        L.scaled(np.array([[1 << 62]]), 4, np.array([0]))
