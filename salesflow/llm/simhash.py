"""SimHash near-dedup by meet-in-the-middle ball hashing.

Two fingerprints at ``radius`` or fewer differing bits share a variant that
lies within half the radius of both.  Every distinct fingerprint emits all
variants within half the radius; fingerprints that share a variant are linked.

The variants are shuffled in bundles: a bundle is keyed by the leading bits of
its variants and is written as (fingerprint, flips left); the task that gets
the key expands the trailing bits.  With 8 leading bits and two flips a
fingerprint is 37 shuffled rows instead of 2,081, and what meets is the same.
A key that many fingerprints share, as those of a large group of near copies
do, is split by more leading bits until no key is large.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.llm._shared import shared_table
from salesflow.llm.components import connected_components

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
#: Variants that a task expands and sorts at once (8 bytes each, and their order).
VARIANTS_AT_ONCE = 2_000_000
#: Bundles per value of the leading bits, about.  A key with more than HOT_ROWS
#: is split by SPLIT_BITS more bits (a key of 56 bits or more never is).
ROWS_A_KEY, HOT_ROWS, SPLIT_BITS = 500_000, 2_000_000, 8


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of a whole text: A-Z lower-cased, words between ASCII
    white space, ``words``-word shingles with repeats (fewer words: all of
    them), XXH64.  A bit is 1 if set in over half the hashes; no words: 0."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return 0
    whole = b" ".join(w)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w))) + np.arange(len(w))
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(w) - words + 1)
    starts, ends = starts[:n].tolist(), ends[min(words, len(w)) - 1:].tolist()
    hashed = xxhash.xxh64_intdigest
    view, ones = memoryview(whole), np.zeros(64, np.int64)
    for at in range(0, n, 65536):
        h = np.array([hashed(view[a:b], SEED) for a, b in zip(starts[at:at + 65536], ends[at:at + 65536])], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * ones > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 words: int = SHINGLE_WORDS) -> DataFrame:
    """``id_col`` and ``fp``, the fingerprint as a signed long."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fp = np.array([fingerprint(t, words) for t in b["_text"]], np.uint64).view(np.int64)
            yield pd.DataFrame({"_id": b["_id"], "fp": fp})

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
            .mapInPandas(run, f"_id {kind}, fp bigint").withColumnRenamed("_id", id_col))


@lru_cache(maxsize=256)
def masks(bits: int, flips: int) -> np.ndarray:
    """All numbers of ``bits`` bits with ``flips`` or fewer ones."""
    return np.array([sum(1 << i for i in c) for k in range(flips + 1) for c in combinations(range(bits), k)],
                    np.uint64)


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least row that each of ``n`` rows is linked with."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _meet(fp: np.ndarray, left: np.ndarray, bits: int, links: list) -> None:
    """Expand the last ``bits`` bits of ``fp`` by ``left`` flips or fewer and
    link rows that share a variant.  Large inputs are cut by the next eight
    bits of the variant, so that memory stays bounded."""
    sizes = {int(k): len(masks(bits, int(k))) for k in np.unique(left)}
    if bits > 8 and sum(sizes[int(k)] * int(c) for k, c in zip(*np.unique(left, return_counts=True))) > VARIANTS_AT_ONCE:
        rest = bits - 8
        byte = (fp >> np.uint64(rest)) & np.uint64(255)
        for value in range(256):
            spare = left - np.bitwise_count(byte ^ np.uint64(value)).astype(np.int64)
            if np.count_nonzero(at := spare >= 0) > 1:
                sub: list = []
                _meet((fp[at] & np.uint64((1 << rest) - 1)), spare[at], rest, sub)
                back = np.flatnonzero(at)
                links += [(back[x], back[y]) for x, y in sub]
        return
    low = fp & np.uint64((1 << bits) - 1) if bits < 64 else fp
    made, whose = [], []
    for k in sizes:
        rows = np.flatnonzero(left == k)
        made.append((low[rows][:, None] ^ masks(bits, k)[None, :]).ravel())
        whose.append(np.repeat(rows, sizes[k]))
    made, whose = np.concatenate(made), np.concatenate(whose)
    order = np.argsort(made)
    made, whose = made[order], whose[order]
    same = made[1:] == made[:-1]
    if not same.any():
        return
    # consecutive rows of one variant: a path through those that share it
    x, y = whose[:-1][same], whose[1:][same]
    pairs = np.unique(np.minimum(x, y) * len(fp) + np.maximum(x, y))
    links.append((pairs // len(fp), pairs % len(fp)))


def _leading_bits(n: int, half: int) -> int:
    """As many leading bits as keep a key of ``n`` evenly spread fingerprints
    near ``ROWS_A_KEY`` bundles: 8 or more, in steps of 4, 24 at most."""
    b = 8
    while b < 24 and n * len(masks(b, half)) > ROWS_A_KEY << b:
        b += 4
    return b


def _flips(bits: int, most: int) -> F.Column:
    """All ways to flip ``most`` or fewer of ``bits`` bits: ``m`` (mask), ``k`` (flips)."""
    return F.array(*[F.struct(F.lit(int(m)).cast("bigint").alias("m"), F.lit(int(m).bit_count()).alias("k"))
                     for m in masks(bits, most)])


def _deepen(bundles: DataFrame, depth: int, bits: int, half: int) -> DataFrame:
    """Bundles keyed by ``depth`` leading bits (``fp``, ``lead``, ``left``)
    keyed by ``bits`` more, one for each flip of these that ``left`` allows."""
    part = F.shiftrightunsigned("fp", 64 - depth - bits).bitwiseAND(F.lit((1 << bits) - 1))
    return (bundles.withColumn("f", F.explode(_flips(bits, half))).where(F.col("left") >= F.col("f.k"))
            .select("fp", F.shiftleft("lead", bits).bitwiseOR(part.bitwiseXOR(F.col("f.m"))).alias("lead"),
                    (F.col("left") - F.col("f.k")).alias("left")))


def _links(bundles: DataFrame, tail: int, max_bits: int) -> DataFrame:
    """A spanning forest of the links between the bundles of each key."""

    def meet(bundle: pd.DataFrame) -> pd.DataFrame:
        fp = bundle["fp"].to_numpy().view(np.uint64)
        links: list = []
        if len(fp) > 1:
            _meet(fp, bundle["left"].to_numpy().astype(np.int64), tail, links)
        if not links:
            return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
        x = np.concatenate([p[0] for p in links])
        y = np.concatenate([p[1] for p in links])
        near = np.bitwise_count(fp[x] ^ fp[y]) <= max_bits
        x, y = x[near], y[near]
        root = _roots(len(fp), x, y)
        moved = np.flatnonzero(root != np.arange(len(fp)))  # a spanning forest says as much as all links
        return pd.DataFrame({"a": fp[root[moved]].view(np.int64), "b": fp[moved].view(np.int64)})

    return bundles.groupBy("lead").applyInPandas(meet, "a bigint, b bigint")


def link_fingerprints(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``(a, b)``: a spanning forest of the links between distinct fingerprints
    (column ``fp``) at ``max_bits`` or fewer differing bits, key by key: its
    closure is theirs.

    ``max_bits`` must be even: the half radius is whole, and whatever shares
    a variant is within the radius.  Each pair is verified nevertheless.
    """
    if max_bits % 2 or max_bits < 0:
        raise ValueError("max_bits must be even")
    half = max_bits // 2
    depth = _leading_bits(fps.count(), half)
    bundles = _deepen(fps.select("fp", F.lit(0).cast("bigint").alias("lead"), F.lit(half).alias("left")),
                      0, depth, half)
    # the load of a key, from the fingerprints' own leading bits: no bundle is shuffled to count it
    load = (fps.groupBy(F.shiftrightunsigned("fp", 64 - depth).alias("at")).agg(F.count(F.lit(1)).alias("n"))
            .withColumn("f", F.explode(_flips(depth, half)))
            .groupBy(F.col("at").bitwiseXOR(F.col("f.m")).alias("lead")).agg(F.sum("n").alias("n")))
    found = []
    while True:
        hot = shared_table(load.where(F.col("n") > HOT_ROWS).select("lead"), f"hot-{depth}")
        if hot.isEmpty():
            found.append(_links(bundles, 64 - depth, max_bits))
            return reduce(DataFrame.unionByName, found)
        found.append(_links(bundles.join(hot, "lead", "left_anti"), 64 - depth, max_bits))
        bits = min(SPLIT_BITS, 64 - depth)
        bundles = shared_table(_deepen(bundles.join(hot, "lead", "left_semi"), depth, bits, half), f"split-{depth}")
        depth += bits
        load = bundles.groupBy("lead").agg(F.count(F.lit(1)).alias("n"))
        if depth >= 56:  # at most some hundred thousand distinct fingerprints come near one key
            found.append(_links(bundles, 64 - depth, max_bits))
            return reduce(DataFrame.unionByName, found)


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: ``id_col``, ``fingerprint`` (16 hex digits) and
    ``component_id``, the smallest id reachable by links of fingerprints at
    ``max_bits`` or fewer differing bits.

    Null and empty texts have fingerprint zero and link like any other.
    Repeated rows give repeated rows.  A null id is never the smallest unless
    its group has no other.  An empty table gives no rows.
    """
    mine = shared_table(fingerprints(docs.select(id_col, text_col), id_col, text_col, words), "fingerprints")
    first = shared_table(mine.groupBy("fp").agg(F.min(id_col).alias("first_id")), "distinct-fingerprints")
    links = shared_table(link_fingerprints(first.select("fp"), max_bits), "links")
    parts = connected_components(links)
    rooted = shared_table(
        first.join(parts.select(F.col("node").alias("fp"), F.col("component").alias("root")), "fp", "left")
        .select("fp", "first_id", F.coalesce("root", "fp").alias("root")), "rooted")
    least = shared_table(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "group-ids")
    named = shared_table(rooted.join(least, "root").select("fp", "component_id"), "named")
    return (mine.join(named, "fp")
            .select(id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))
