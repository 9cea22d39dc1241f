"""Sharding by a k-d tree over metadata.

The documents are split at the weighted median (weights: bytes) of the widest metadata dimension of
each node, again and again, until the leaves have the target size. A node of an odd number of leaves
is split in that proportion. Dimensions are scaled so that each is as wide as the others over all
documents. Medians come from distributed histograms (``cuts``); all nodes of a level share each pass,
and only histograms reach the driver.

Dimensions are functions of the text alone, so equal texts are one point. Where a median falls within
the rows of one point, they stay together on the nearer side, unless they weigh more than WHOLE of a
leaf: balance then needs the point to be split, in the order of a hash of the id. Rows alike in id as
well always stay together.

Null texts have size 1 and the point of the empty text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .cuts import TOP, cuts, seeded
from .util import stored

#: Leaves of the registered query.
SHARDS = 16
#: Equal texts that weigh up to this part of a leaf's target are never parted.
WHOLE = 1 / 16

_HALF = 1 << 31
#: Metadata dimensions: log of the length, bytes a character (script), blanks a character (length of words), line breaks a character (layout).
DIMS = ("length", "script", "blanks", "breaks")


def metadata(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """id_, size, text_crc32, point (a hash of the text), and the dimensions."""
    t = F.coalesce(F.col(text_col), F.lit(""))
    size, characters = F.octet_length(t).cast("long"), F.greatest(F.length(t), F.lit(1))
    without = lambda c: F.length(t) - F.length(F.replace(t, F.lit(c), F.lit("")))
    return df.select(
        F.col(id_col).alias("id_"),
        *(keep or []),
        (size + 1).alias("size"),
        F.crc32(t.cast("binary")).alias("text_crc32"),
        F.xxhash64(t, F.lit(1)).bitwiseAND(F.lit(_HALF - 1)).alias("point"),
        F.log2(size + 1).alias("length"),
        (size / characters).alias("script"),
        (without(" ") / characters).alias("blanks"),
        (without("\n") / characters).alias("breaks"),
    )


def scaled(points: DataFrame, dims: tuple[str, ...] = DIMS) -> DataFrame:
    """The dimensions as whole numbers from 0 to 2**31 - 1, each from its least to its largest value in ``points``."""
    ends = points.agg(*[f(d).alias(f"{n}{i}") for i, d in enumerate(dims) for n, f in (("a", F.min), ("b", F.max))]).first()
    out = {}
    for i, d in enumerate(dims):
        low, wide = ends[f"a{i}"], (ends[f"b{i}"] or 0) - (ends[f"a{i}"] or 0)
        out[d] = F.floor((F.col(d) - low) / wide * (_HALF - 1)).cast("long") if wide else F.lit(0).cast("long")
    return points.withColumns(out)


def shards(points: DataFrame, dims: tuple[str, ...], target: float, weight: str = "size", id_col: str = "id_") -> DataFrame:
    """``points`` (which also has ``point``; dimensions from 0 to 2**31 - 1) with ``shard``, the row's leaf, from 0.

    There are as many leaves as the weight holds targets, rounded; they weigh nearly the same, however
    the rows are spread. Each level's rows are written to shared storage.
    """
    total = points.agg(F.sum(weight)).first()[0] or 0
    node = F.col("shard")
    leaves = {0: max(1, round(total / target)) if total else 1}  # a node is named by its first leaf
    leaf = total / leaves[0]
    named = points.withColumn("shard", F.lit(0))
    while max(leaves.values()) > 1:
        facts = named.groupBy("shard").agg(F.sum(weight).alias("w"), *[F.min(d).alias(f"a{i}") for i, d in enumerate(dims)], *[F.max(d).alias(f"b{i}") for i, d in enumerate(dims)]).collect()
        facts = [r for r in facts if leaves[r.shard] > 1]
        axis = {r.shard: max(range(len(dims)), key=lambda i: (r[f"b{i}"] - r[f"a{i}"], -i)) for r in facts}
        key: Column = F.lit(0).cast("long")
        for n, i in axis.items():
            key = F.when(node == n, F.shiftleft(F.col(dims[i]).cast("long"), 31) + F.col("point")).otherwise(key)
        first = {n: (k + 1) // 2 for n, k in leaves.items() if k > 1}  # leaves of the first half
        goal = {r.shard: (r.w * first[r.shard] + leaves[r.shard] - 1) // leaves[r.shard] for r in facts}
        found = cuts(named, node, key, F.col(weight), goal)
        apart, rest = {}, {}
        right: Column = F.lit(False)
        for n, c in found.items():
            if c.key is None:
                continue
            missing = goal[n] - c.below
            if c.at <= WHOLE * leaf:
                right = F.when(node == n, key > c.key if missing > c.at - missing else key >= c.key).otherwise(right)
            else:
                apart[n], rest[n] = c.key, missing
        if apart:
            at_cut: Column = F.lit(False)
            for n, k in apart.items():
                at_cut = F.when(node == n, key == k).otherwise(at_cut)
            by_id = seeded(F.col(id_col), F.lit("shard"))
            split = cuts(named.filter(at_cut), node, by_id, F.col(weight), rest)
            for n, k in apart.items():
                c = split[n]
                below = F.lit(True) if c.key is None else by_id <= c.key if rest[n] - c.below > c.at / 2 else by_id < c.key
                right = F.when(node == n, ~((key < k) | ((key == k) & below))).otherwise(right)
        moved: Column = F.lit(0)
        for n, k in first.items():
            moved = F.when(node == n, k).otherwise(moved)
        named = stored(named.withColumn("shard", node + F.when(right, moved).otherwise(0)), named)
        leaves = {m: k for n, k in leaves.items() for m, k in (((n, first[n]), (n + first[n], k - first[n])) if k > 1 else ((n, k),))}
    return named


def slots(rows: DataFrame, shard: str, order: list[str]) -> DataFrame:
    """rows with ``slot``, numbered without gaps from 0 within each shard.

    Rows are dealt by ranges of (shard, order) and numbered within a partition; what a partition's
    numbers start from follows from the counts of those before it, one row for each partition and shard.
    """
    spark = rows.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.repartitionByRange(n, shard, *order).sortWithinPartitions(shard, *order)
    numbered = stored(dealt.withColumn("at_", F.monotonically_increasing_id()))
    part = F.shiftright("at_", 33).alias("part_")
    begin = numbered.groupBy(part, shard).agg(F.min("at_").alias("first_"), F.count("*").alias("n_")).collect()
    before: dict[int, int] = {}
    starts = []
    for r in sorted(begin, key=lambda r: (r[shard], r.part_)):
        starts.append((r.part_, r[shard], r.first_ - before.get(r[shard], 0)))
        before[r[shard]] = before.get(r[shard], 0) + r.n_
    frame = F.broadcast(spark.createDataFrame(starts, f"part_ long, {shard} int, base_ long"))  # of the size of the partitions' list
    return numbered.withColumn("part_", part).join(frame, ["part_", shard]).withColumn("slot", F.col("at_") - F.col("base_")).drop("at_", "part_", "base_")


def shard_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_bytes: int | None = None, dims: tuple[str, ...] = DIMS) -> DataFrame:
    """id, size, text_crc32, shard and slot of every row; shards of target_bytes, or SHARDS of one size."""
    points = stored(metadata(df, id_col, text_col))
    target = target_bytes or (points.agg(F.sum("size")).first()[0] or 0) / SHARDS or 1
    placed = shards(stored(scaled(points, dims), points), dims, target)
    out = slots(placed.select("id_", "size", "text_crc32", "point", "shard"), "shard", ["point", "id_", "text_crc32", "size"])
    return out.select(F.col("id_").alias(id_col), "size", "text_crc32", "shard", "slot")


assert TOP >= (_HALF << 31) - 1
