"""Sharding by weighted rendezvous hashing of a stable record key.

Each shard draws a hash of (key, shard); the shard with the least
``-ln(u) / weight`` gets the record.  A shard that is added draws for every
record and takes those it wins; no record moves between old shards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Rows that share a slot counter, about: a counter is one sort in one task.
SLOT_ROWS = 100_000


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard (int, from 0) of ``key``; shard ``i`` gets a share of the
    keys proportional to ``weights[i]`` (0: none).  A null key has a place
    like any other key.  Ties go to the lower shard."""
    if not weights or min(weights) < 0 or max(weights) <= 0:
        raise ValueError("weights must be >= 0, one of them above 0")
    draws = []
    for shard, w in enumerate(weights):
        if w > 0:
            # 53 bits, shifted by half a step: 0 < u < 1
            u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11) + F.lit(0.5)) * F.lit(2.0 ** -53)
            draws.append(F.struct((-F.ln(u) / F.lit(float(w))).alias("cost"), F.lit(shard).alias("shard")))
    return (F.least(*draws) if len(draws) > 1 else draws[0])["shard"]


def with_slots(rows: DataFrame, shard: str, order: Sequence[str], slot: str = "slot") -> DataFrame:
    """Number the rows of each shard from 0 without gaps.

    A shard is cut into sub-buckets by a hash of ``order``; rows are numbered
    inside each sub-bucket, and the sub-buckets' sizes, summed in order, give
    the offsets.  So no task holds a whole shard.  Rows equal in ``order`` get
    their numbers in any order among themselves.
    """
    n = rows.count()
    cuts = max(1, -(-n // SLOT_ROWS))
    cut = rows.withColumn("_cut", F.pmod(F.xxhash64(*order), F.lit(cuts)).cast("int"))
    sizes = cut.groupBy(shard, "_cut").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(shard).orderBy("_cut").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(F.col(shard).alias("_shard"), F.col("_cut").alias("_of"),
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    inside = W.partitionBy(shard, "_cut").orderBy(*order)
    numbered = cut.withColumn("_rank", F.row_number().over(inside) - 1)
    return (numbered.join(offsets, (F.col(shard) == F.col("_shard")) & (F.col("_cut") == F.col("_of")))
            .withColumn(slot, (F.col("_first") + F.col("_rank")).cast("bigint"))
            .drop("_cut", "_shard", "_of", "_first", "_rank", "_n"))


def assign_shards(rows: DataFrame, key: str, weights: Sequence[float], shard: str = "shard") -> DataFrame:
    """``rows`` with their shard; every column stays, rows are not shuffled.
    Rows that repeat a key share its shard."""
    return rows.withColumn(shard, rendezvous(F.col(key), weights))
