"""Whitening against a plain numpy form."""

from __future__ import annotations

import math

import numpy as np
import pytest

from salesflow.llm import whitening
from salesflow.llm.queries import op11_whitening


def plain(vectors, k=8):
    """Integer grid, exact deviation, covariance, eigenvectors."""
    x = np.array([[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors], dtype=object)
    n, s = len(x), x.sum(axis=0)
    deviation = [sum((n * a - b) ** 2 for a, b in zip(r, s)) for r in x]
    c = (x - s / n).astype(float)
    v = c.T @ c / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    return deviation, c @ u / np.sqrt(e), e / np.trace(v)


def usable(v):
    return v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v)


def compare(got, ids, vectors, k=8):
    deviation, white, share = plain(vectors, k)
    place = {i: n for n, i in enumerate(ids)}
    table = {(r.vec_id, r.component): r for r in got}
    assert len(got) == len(table) == len(ids) * min(k, len(vectors[0]))
    for j in range(white.shape[1]):
        mine = np.array([table[i, j + 1].whitened for i in ids])
        sign = 1 if abs(mine - white[:, j]).max() < abs(mine + white[:, j]).max() else -1
        assert np.allclose(mine, sign * white[:, j], atol=1e-6)
    for (i, j), r in table.items():
        assert int(r.deviation) == deviation[place[i]] and r.n == len(ids)
        assert abs(r.explained / share[j - 1] - 1) < 1e-9 and r.identity_error < 1e-9


def test_query_equals_plain(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()
    held = [(r.vec_id, r.embedding) for r in rows if usable(r.embedding)]
    compare(op11_whitening(spark, "/root/testdata/sf0.001").collect(), *zip(*held))


@pytest.mark.parametrize("block_rows, task_blocks, parts", [(7, 2, 5), (64, 1, 3), (1024, 16, 1)])
def test_any_blocks_give_the_same(spark, block_rows, task_blocks, parts):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(300, 6)) @ rng.normal(size=(6, 6)) * 0.2
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(v)], "vec_id bigint, embedding array<double>").repartition(parts)
    got = whitening.component_rows(df, block_rows=block_rows, task_blocks=task_blocks, components=4).collect()
    compare(got, range(300), v.tolist(), 4)


def test_unusable_rows_and_clashing_columns(spark):
    rng = np.random.default_rng(4)
    good = [(i, r.tolist(), 1, "x") for i, r in enumerate(rng.normal(size=(40, 3)))]
    nan, inf = float("nan"), float("inf")
    bad = [(90, None, 1, "x"), (91, [1.0, None, 2.0], 1, "x"), (92, [nan, 1.0, 1.0], 1, "x"), (93, [1.0, -inf, 1.0], 1, "x"),
           (94, [], None, None), (95, [1.0, 2.0], 1, "x")]
    schema = "vec_id bigint, embedding array<float>, component int, whitened string"
    df = spark.createDataFrame(good + bad, schema)
    held = [(r.vec_id, r.embedding) for r in df.collect() if r.vec_id < 90]
    compare(whitening.component_rows(df).collect(), *zip(*held))


def test_no_rows_and_no_variance(spark):
    schema = "vec_id bigint, embedding array<float>"
    none = whitening.component_rows(spark.createDataFrame([(1, None)], schema))
    assert none.isEmpty() and none.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    same = whitening.component_rows(spark.createDataFrame([(1, [0.5, 0.5]), (1, [0.5, 0.5]), (None, [0.5, 0.5])], schema)).collect()
    assert len(same) == 6 and all(r.whitened == 0 and r.explained == 0 and r.deviation == 0 and r.n == 3 for r in same)


def test_scatter_goes_to_many_tasks(spark):
    """The inner dimension is split: no task holds all blocks."""
    rng = np.random.default_rng(6)
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rng.normal(size=(200, 3)))], "vec_id bigint, embedding array<double>")
    seen = []
    times = whitening._times
    try:
        whitening._times = lambda a, b, splits: seen.append(splits) or times(a, b, splits)
        whitening.whiten(df, block_rows=10, task_blocks=2)
    finally:
        whitening._times = times
    assert len(seen) == 2 and min(seen) >= 10
