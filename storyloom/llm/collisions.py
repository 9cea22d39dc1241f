"""Near-duplicate embeddings by collision counting on one-dimensional projections.

Vectors are scaled to length 1 and projected on many random directions. Two vectors collide in a
projection if one lies in a window of fixed half-width centred on the other. The difference of two
projections is normal with a variance set by the cosine, so the number of collisions of a pair at
the least cosine of interest is binomial; pairs with fewer collisions than its ``MISS`` quantile are
passed over, all others are verified in double precision.

The windows are searched in sorted projections, within buckets: every vector goes to one bucket of
each of several tables, by the signs of some projections of that table. The number of signs follows
from the number of vectors (buckets stay small), and the number of tables from that and ``MISS``. A
pair is counted only in the first table whose bucket it shares, so no pair is counted twice. Buckets
of more than ``components.BLOCK_ROWS`` rows are cut into blocks, and all pairs of blocks compared.

Equal vectors are one class: a class counts as often as it has rows. Vectors that are null, empty,
zero or hold null or non-finite components link with nothing; a vector of another length than the
most common one links only with vectors of its own length.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components, forest, in_blocks, runs
from .util import small_batches, stored

LEAST = 0.9
#: Projections whose collisions are counted, and the window's half-width in deviations at the least cosine.
PROJECTIONS, WINDOW = 16, 2.0
#: Chance to pass over a pair at the least cosine, for the counting and for the tables each.
MISS = 0.002
#: Rows of a bucket that the number of signs aims at.
BUCKET = 256
SEED = 20260


def directions(d: int, n: int, seed: int) -> np.ndarray:
    """d x n normal directions; a difference of unit vectors x - y projects with deviation |x - y| / sqrt(d)."""
    return np.random.default_rng([SEED, seed, d]).standard_normal((d, n)) / math.sqrt(d)


def needed(m: int = PROJECTIONS, window: float = WINDOW, miss: float = MISS) -> int:
    """The largest count that a pair at the least cosine misses with a chance of ``miss`` at most."""
    p = math.erf(window / math.sqrt(2))
    total = 0.0
    for k in range(m + 1):
        total += math.comb(m, k) * p**k * (1 - p) ** (m - k)
        if total > miss:
            return k
    return m


def tables(n: int, least: float = LEAST, miss: float = MISS) -> tuple[int, int]:
    """(signs of a bucket's key, number of tables) for n vectors."""
    signs = max(1, min(30, math.ceil(math.log2(max(2, n) / BUCKET))))
    same = (1 - math.acos(least) / math.pi) ** signs
    return signs, max(1, math.ceil(math.log(miss) / math.log(1 - same)))


def collide(q: np.ndarray, x: np.ndarray, width: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, other) of rows of projections that collide in ``count`` columns or more."""
    n, m = x.shape
    step = max(1, (1 << 21) // max(1, n))
    out_i, out_j = [], []
    orders = np.argsort(x, axis=0, kind="stable")
    ranked = np.take_along_axis(x, orders, 0)
    for at in range(0, len(q), step):
        part = q[at : at + step]
        total = np.zeros((len(part), n), np.uint8)
        for k in range(m):
            # Every query's window is a run of the sorted column: marked at both ends, then summed up along it.
            low = np.searchsorted(ranked[:, k], part[:, k] - width, "left")
            high = np.searchsorted(ranked[:, k], part[:, k] + width, "right")
            marks = np.zeros((len(part), n + 1), np.int8)
            row = np.arange(len(part))
            marks[row, low] += 1
            marks[row, high] -= 1
            total[:, orders[:, k]] += np.cumsum(marks[:, :n], axis=1, dtype=np.int8).view(np.uint8)
        i, j = np.nonzero(total >= count)
        out_i.append(i + at)
        out_j.append(j)
    return np.concatenate(out_i), np.concatenate(out_j)


def _unit(v: np.ndarray) -> np.ndarray:
    return v / np.sqrt((v * v).sum(1))[:, None]


def links(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", least: float = LEAST) -> DataFrame:
    """Per row: its id, n_links, component_id and kept (see the contract in ``queries``)."""
    spark = df.sparkSession
    small_batches(spark)
    v = F.col(vector_col).cast("array<double>")
    fine = F.coalesce(F.size(v) > 0, F.lit(False)) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    fine = F.coalesce(fine, F.lit(False)) & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))
    # -0.0 and 0.0 are the same component
    clean = F.transform(v, lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))
    rows = stored(df.select(F.col(id_col).alias("id"), F.when(fine, clean).alias("v")))
    live = rows.filter("v is not null")
    classes = stored(live.groupBy("v").agg(F.min("id").alias("node"), F.count("*").alias("rows")).filter("node is not null"))
    out, forests = [], []
    sizes = [(r.d, r.n) for r in classes.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).collect()]  # one row for each length
    for d, n in sorted(sizes):
        found = _pairs(classes.filter(F.size("v") == d), d, n, least)
        out.append(found.filter("b is null").select("a", "n"))
        forests.append(found.filter("b is not null").select("a", "b"))
    if not out:
        joined, counted = spark.createDataFrame([], "node long, component long"), spark.createDataFrame([], "a long, n long")
    else:
        counted, edges = out[0], forests[0]
        for x, y in zip(out[1:], forests[1:]):
            counted, edges = counted.unionByName(x), edges.unionByName(y)
        joined = components(edges)
    named = classes.join(counted.groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n")), "node", "left").join(joined, "node", "left")
    named = named.select("v", (F.coalesce("n", F.lit(0)) + F.col("rows") - 1).alias("n"), F.coalesce("component", "node").alias("c"))
    got = rows.join(named, "v", "left").select(F.col("id").alias(id_col), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("c", "id").alias("component_id"))
    return got.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False)))


def _pairs(classes: DataFrame, d: int, n: int, least: float) -> DataFrame:
    """Rows (a, null, rows linked to it by some block) and (a, b, 0), edges of a forest of each block."""
    signs, number = tables(n, least)
    width, count = WINDOW * math.sqrt((2 - 2 * least) / d), needed()
    counted = directions(d, PROJECTIONS, 0)
    planes = directions(d, signs * number, 1)
    powers = 1 << np.arange(signs)

    kind = np.uint8 if signs <= 8 else np.uint16 if signs <= 16 else np.uint32  # a vector's keys go with it, as bytes

    def keys_of(unit: np.ndarray) -> np.ndarray:
        return ((unit @ planes).reshape(len(unit), number, signs) > 0) @ powers

    def matrix(a: pa.Array) -> np.ndarray:
        return a.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                keys = keys_of(_unit(matrix(b.column(0))))
                rows = np.tile(np.arange(b.num_rows), number)
                t = np.repeat(np.arange(number, dtype=np.int32), b.num_rows)
                took = b.take(pa.array(rows))
                packed = pa.array([k.tobytes() for k in keys.astype(kind)], pa.binary()).take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.T.ravel().astype(np.int64)), pa.array(t), *(took.column(i) for i in range(3)), packed], names=["key", "t", "v", "node", "rows", "keys"]
                )

    dealt = classes.select("v", "node", "rows").mapInArrow(deal, "key long, t int, v array<double>, node long, rows long, keys binary")
    dealt = in_blocks(dealt, ["key", "t"], "node", 2048).select("key", "t", "ci", "cj", "own", "node", "rows", "v", "keys")
    dealt = dealt.repartition("key", "t", "ci", "cj").sortWithinPartitions("key", "t", "ci", "cj", "own", "node")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, 4):
            if group.num_rows < 2:
                continue
            own, node, weight = (group.column(c).to_numpy() for c in ("own", "node", "rows"))
            t = group.column("t")[0].as_py()
            unit = _unit(matrix(group.column("v").combine_chunks()))
            p = unit @ counted
            same = group.column("ci")[0].as_py() == group.column("cj")[0].as_py()
            split = 0 if same else int(np.searchsorted(own, group.column("cj")[0].as_py()))
            i, j = collide(p if same else p[:split], p if same else p[split:], width, count)
            j = j + split
            if same:
                i, j = i[i < j], j[i < j]
            cosine = np.concatenate([np.einsum("ij,ij->i", unit[i[k : k + 65536]], unit[j[k : k + 65536]]) for k in range(0, len(i), 65536)] or [np.zeros(0)])
            i, j = i[cosine >= least], j[cosine >= least]
            if not len(i):
                continue
            earlier = np.zeros(len(i), bool)
            if t:
                keys = np.frombuffer(b"".join(group.column("keys").to_pylist()), kind).reshape(len(node), number)[:, :t]
                earlier = np.concatenate([(keys[i[k : k + 65536]] == keys[j[k : k + 65536]]).any(1) for k in range(0, len(i), 65536)])
            child, root = forest(len(node), i, j)
            i, j = i[~earlier], j[~earlier]
            total = np.bincount(i, weight[j], len(node)) + np.bincount(j, weight[i], len(node))
            linked = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([node[linked], node[child]])),
                    pa.array(np.concatenate([np.zeros(len(linked), np.int64), node[root]]), mask=np.arange(len(linked) + len(child)) < len(linked)),
                    pa.array(np.concatenate([total[linked].astype(np.int64), np.zeros(len(child), np.int64)])),
                ],
                names=["a", "b", "n"],
            )

    return stored(dealt.mapInArrow(compare, "a long, b long, n long"))
