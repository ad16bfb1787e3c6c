"""Embedding whitening with MLlib's distributed block matrices.

Rows are put on an integer grid, centred, numbered, and gathered into blocks of
a fixed number of rows.  Transpose times itself gives the scatter matrix, whose
eigenvectors are found locally (it is as wide as a vector is long); the blocks
times the whitening matrix are the projected rows.

Both products say how many ways the inner dimension is split.  Without that
MLlib brings all blocks of a tall matrix to one task for the scatter, and to
the square root of the tasks for the projection.  For the latter the blocks
stand on M block columns in turn, against M copies of the whitening matrix one
below the other: the same products, in M times as many tasks.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.llm._shared import shared_table

#: Rows of a block, and blocks of one inner product (its task holds both sides).
BLOCK_ROWS, TASK_BLOCKS = 1024, 16
#: The grid: x = floor(SCALE * entry) + SHIFT.
SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: An eigenvalue below this share of the first is no variance.
LEAST = 1e-12


class Whitening(NamedTuple):
    """``rows``: ``row``, ``vec_id``, ``deviation``, ``whitened`` (array).  The
    rest is as wide as the vectors are long or as there are components."""
    rows: DataFrame
    n: int
    eigenvalues: np.ndarray
    components: np.ndarray  # one unit eigenvector a column
    trace: float
    identity_error: float


def grid_rows(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``_id``, ``x`` (array of bigint): the rows whose vector and entries are
    neither null nor NaN nor infinite."""
    v = F.col(vector_col)
    finite = F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    return df.where(F.coalesce(finite & (F.size(v) > 0), F.lit(False))).select(
        F.col(id_col).alias("_id"),
        F.transform(v, lambda e: F.floor(e.cast("double") * SCALE).cast("bigint") + SHIFT).alias("x"))


def _times(a: BlockMatrix, b: BlockMatrix, splits: int) -> BlockMatrix:
    """``a`` times ``b`` with the inner dimension dealt out ``splits`` ways."""
    made = a._java_matrix_wrapper.call("multiply", b._java_matrix_wrapper._java_model, int(splits))
    return BlockMatrix(made, a.rowsPerBlock, b.colsPerBlock)


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS,
           block_rows: int = BLOCK_ROWS, task_blocks: int = TASK_BLOCKS) -> Whitening | None:
    """Whiten the vectors of ``df``; None if no row remains.

    Rows with a null vector or a null or non-finite entry are left out.  Vectors
    should be of one length; if not, the length that most rows have counts (of
    equals the greater) and other rows are left out.  Repeated ids and null ids
    are rows of their own.  The covariance is over all rows, divided by their
    number.  Components without variance (equal rows, fewer rows than entries)
    project to 0.  ``deviation`` is exact, the sum over the dimensions of
    (n * x - S)^2.  Signs of components are those of the local eigensolver.
    """
    spark = df.sparkSession
    # the number of a row is fixed by the write: its task, and its place in it
    number = F.monotonically_increasing_id()
    rows = shared_table(grid_rows(df, id_col, vector_col).withColumn("row", number), "grid")
    lengths = rows.groupBy(F.size("x").alias("d")).count().collect()  # a row for each length
    if not lengths:
        return None
    d = max(lengths, key=lambda r: (r["count"], r["d"]))["d"]
    rows = rows.where(F.size("x") == d)
    sums = rows.agg(F.count(F.lit(1)).alias("n"), *(F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(d))).first()
    n, total = sums["n"], [sums[f"s{i}"] for i in range(d)]
    k = min(components, d)

    # consecutive blocks: those of a task follow those of the tasks before it
    task, place = F.shiftright("row", 33), F.col("row").bitwiseAND((1 << 33) - 1)
    tasks = rows.groupBy(task.alias("task")).agg(F.max(place).alias("last")).orderBy("task").collect()  # a row for each task
    first = np.cumsum([0, *(t["last"] // block_rows + 1 for t in tasks)])
    offsets = spark.createDataFrame([(t["task"], int(b)) for t, b in zip(tasks, first)], "task bigint, first bigint")
    blocks_all = int(first[-1])
    if blocks_all >= 1 << 31:
        raise ValueError("more blocks than MLlib numbers: raise block_rows")
    mean = np.array([s / n for s in total])

    def gather(p: pd.DataFrame) -> pd.DataFrame:
        x = np.zeros((block_rows, d))  # missing rows are zero, which adds nothing to the scatter
        x[p["place"].to_numpy()] = np.stack(p["x"].to_numpy()) - mean
        return pd.DataFrame({"block": p["block"].iloc[:1], "a": [x.ravel(order="F")]})

    placed = (rows.join(F.broadcast(offsets), task == F.col("task"))
              .select(((F.col("first") + F.floor(place / block_rows)).cast("int")).alias("block"),
                      (place % block_rows).cast("int").alias("place"), "x"))
    blocks = shared_table(placed.groupBy("block").applyInPandas(gather, "block int, a array<double>"), "blocks")

    def matrix(columns: int) -> BlockMatrix:
        """The centred rows, their blocks on so many block columns in turn."""
        held = blocks.rdd.map(lambda b: ((b.block, b.block % columns), DenseMatrix(block_rows, d, b.a)))
        return BlockMatrix(held, block_rows, d, blocks_all * block_rows, columns * d)

    splits = -(-blocks_all // task_blocks)
    tall = matrix(1)
    v = _times(tall.transpose(), tall, splits).toLocalMatrix().toArray() / n  # d x d
    values, vectors = np.linalg.eigh((v + v.T) / 2)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    trace = float(np.trace(v))
    real = values > LEAST * max(values[0], 0.0)
    white = np.where(real, vectors / np.sqrt(np.where(real, values, 1.0)), 0.0)

    copies = spark.sparkContext.parallelize(range(splits), min(splits, 64)).map(
        lambda j: ((j, 0), DenseMatrix(d, k, white.ravel(order="F").tolist())))
    projected = _times(matrix(splits), BlockMatrix(copies, d, k, splits * d, k), splits)
    flat = projected.blocks.map(lambda b: (b[0][0], b[1].toArray().ravel().tolist()))
    held = spark.createDataFrame(flat, "block int, y array<double>").select("block", F.posexplode(F.expr(
        f"transform(sequence(0, {block_rows - 1}), r -> slice(y, r * {k} + 1, {k}))")).alias("place", "whitened"))
    first_block = F.broadcast(offsets)
    deviation = F.expr(
        f"aggregate(zip_with(x, array({', '.join(f'{s}L' for s in total)}), (a, s) -> {n}L * a - s), cast(0 as decimal(38, 0)), "
        "(t, e) -> cast(t + cast(e as decimal(19, 0)) * cast(e as decimal(19, 0)) as decimal(38, 0)))")
    out = (rows.join(first_block, task == F.col("task"))
           .select("row", "_id", deviation.alias("deviation"),
                   ((F.col("first") + F.floor(place / block_rows)).cast("int")).alias("block"),
                   (place % block_rows).cast("int").alias("place"))
           .join(held, ["block", "place"]).select("row", "_id", "deviation", "whitened"))
    out = shared_table(out, "whitened")
    y = F.col("whitened")
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    cov = out.agg(*(F.covar_pop(y[i], y[j]).alias(f"c{i}_{j}") for i, j in pairs)).first()  # centred sums
    error = max(abs(cov[f"c{i}_{j}"] - (i == j)) for i, j in pairs)
    return Whitening(out.withColumnRenamed("_id", id_col), n, values, vectors, trace, float(error))


def component_rows(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", **settings) -> DataFrame:
    """One row per remaining row and component: ``id_col``, ``component`` (from
    1 by falling eigenvalue), ``n``, ``deviation`` (decimal), ``whitened``,
    ``explained`` (share of the trace; 0 without any variance) and
    ``identity_error``.  An empty table, or one without a usable vector, gives
    no rows."""
    kind = df.schema[id_col].dataType.simpleString()
    made = whiten(df, id_col, vector_col, **settings)
    if made is None:
        return df.sparkSession.createDataFrame([], f"`{id_col}` {kind}, component int, n bigint, deviation decimal(38,0), "
                                               "whitened double, explained double, identity_error double")
    shares = [float(max(e, 0.0) / made.trace) if made.trace > 0 else 0.0 for e in made.eigenvalues]
    return (made.rows.select(id_col, "deviation", F.posexplode("whitened").alias("_at", "whitened"))
            .select(id_col, (F.col("_at") + 1).alias("component"), F.lit(made.n).cast("bigint").alias("n"), "deviation",
                    "whitened", F.array(*map(F.lit, shares))[F.col("_at")].alias("explained"),
                    F.lit(made.identity_error).alias("identity_error")))
