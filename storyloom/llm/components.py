"""Connected components, and pairs within buckets cut into blocks of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .util import discard, stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that can be reached, for every node that has an edge.

    ``edges``: two columns of longs, in any order, with repeats or loops. Alternates the large-star
    and small-star steps until the edges no longer change; each round is written to shared storage,
    so that a lost executor costs one round at most. Only a checksum of the edges reaches the driver.
    Rows with a null are ignored.
    """
    a, b = edges.columns
    now = stored(
        edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    )
    seen = None
    while True:
        sign = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if sign == seen:
            break
        seen = sign
        now = stored(_small_star(stored_large := stored(_large_star(now))), now, )
        discard(stored_large)
    return now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _with_least(pairs: DataFrame) -> DataFrame:
    """Each pair with the least neighbour of u (u itself included)."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select((-F.col("u")).alias("k"), F.least("m", "u").alias("m"))
    return pairs.withColumn("k", -F.col("u")).join(least, "k")  # by another key: both sides are dealt anew, so a hub can be split


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    got = _with_least(both).filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return got.filter("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    got = _with_least(edges)
    moved = got.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
    return moved.unionByName(got.select("u", F.col("m").alias("v"))).distinct()


def forest(n: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (child, root), at most n - 1, that join the same of n nodes as the pairs i, j do."""
    label = np.arange(n)
    if not len(i):
        return label[:0], label[:0]
    while True:
        low = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, label[i], low)
        np.minimum.at(label, label[j], low)
        while (jumped := label[label] != label).any():
            label = label[label]
        if (label == before).all():
            break
    child = np.flatnonzero(label != np.arange(n))
    return child, label[child]


#: Rows of a block. A bucket of more rows is cut into blocks, and every pair of its blocks is compared in a task of its own.
BLOCK_ROWS = 4096


def in_blocks(rows: DataFrame, key: list[str], spread_by: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """rows with (ci, cj, own): the pairs of blocks that a row takes part in, and which of the two is its own.

    A bucket of up to ``block_rows`` rows is one block (0, 0). A larger one is cut by a hash of
    ``spread_by`` into as many blocks as needed; a row goes to each pair that holds its block.
    """
    heavy = rows.groupBy(*key).agg(F.count("*").alias("n")).filter(F.col("n") > block_rows)
    heavy = stored(heavy.select(*key, F.ceil(F.col("n") / (block_rows * 0.75)).cast("int").alias("parts")))
    many = heavy.count()
    if not many:
        discard(heavy)
        return rows.withColumns({"ci": F.lit(0), "cj": F.lit(0), "own": F.lit(0)})
    joined = rows.join(F.broadcast(heavy) if many <= 10_000 else heavy, key, "left")
    own = F.pmod(F.xxhash64(spread_by, F.lit(7)), F.coalesce("parts", F.lit(1))).cast("int")
    joined = joined.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)))
    return joined.withColumns({"ci": F.least("own", "other"), "cj": F.greatest("own", "other")}).drop("other", "parts")


def runs(batches: Iterator[pa.RecordBatch], n_key: int) -> Iterator[pa.Table]:
    """From batches sorted by their first n_key columns, the rows of one key after another."""
    rest: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        keys = np.stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(n_key)])
        cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
        if last is not None and (keys[:, 0] != last).any():
            yield pa.Table.from_batches(rest)
            rest = []
        begun = 0
        for c in cuts.tolist():
            rest.append(b.slice(begun, c - begun))
            yield pa.Table.from_batches(rest)
            rest, begun = [], c
        rest.append(b.slice(begun))
        last = keys[:, -1]
    if rest:
        yield pa.Table.from_batches(rest)
