"""Vectors as arrays of doubles: norms, cosines and means in the order of the components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_double(c: Column) -> Column:
    return c.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def normalize(a: Column) -> Column:
    n = norm(a)
    return F.transform(a, lambda x: x / (n + 1e-12))


def cosine(a: Column, b: Column) -> Column:
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def is_live(a: Column, eps: float = 1e-8) -> Column:
    """Finite, and not zero."""
    return F.coalesce(F.forall(a, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & (norm(a) > eps), F.lit(False))


#: Keys whose sums a task holds before it sends them on.
HELD = 20_000


def mean(df: DataFrame, keys: list[str], vector: str, name: str = "centroid") -> DataFrame:
    """One row for each key: the mean of the vectors by component, and how many there are (``n``).

    Tasks send sums by key, not vectors. Null vectors and components count for nothing; of vectors of
    different lengths, each component's mean is over those that have it.
    """
    of = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    width = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple[np.ndarray, np.ndarray]] = {}

        def sent() -> pa.RecordBatch:
            columns = [pa.array([k[i] for k in held], kinds[i]) for i in range(width)]
            sums = [pa.array([x.tolist() for x, _ in held.values()], pa.list_(pa.float64())), pa.array([c.tolist() for _, c in held.values()], pa.list_(pa.int64()))]
            return pa.RecordBatch.from_arrays(columns + sums, names=[*keys, "s", "c"])

        for b in batches:
            kinds = [b.schema.field(i).type for i in range(width)]
            rows = zip(*[b.column(i).to_pylist() for i in range(width)])
            vectors = b.column(width)
            flat = vectors.flatten()
            there = flat.is_valid().to_numpy(zero_copy_only=False)
            x = np.where(there, flat.fill_null(0.0).to_numpy(zero_copy_only=False), 0.0)
            size = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False)
            at = np.concatenate([[0], np.cumsum(size)])
            for i, k in enumerate(rows):
                if not size[i]:
                    continue
                new = x[at[i] : at[i + 1]], there[at[i] : at[i + 1]].astype(np.int64)
                key = (*k, int(size[i]))
                old = held.get(key)
                if old is None:
                    held[key] = tuple(np.array(v) for v in new)
                else:
                    for o, v in zip(old, new):
                        o += v
            if len(held) > HELD:
                yield sent()
                held.clear()
        if held:
            yield sent()

    schema = ", ".join(f"`{k}` {of[k]}" for k in keys) + ", s array<double>, c array<bigint>"
    sums = df.select(*keys, as_double(F.col(vector)).alias("v_")).mapInArrow(run, schema)
    parts = sums.select(*keys, F.posexplode(F.arrays_zip("s", "c")).alias("pos", "x")).groupBy(*keys, "pos").agg(F.sum("x.s").alias("s"), F.sum("x.c").alias("c"))
    whole = parts.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("pos", F.try_divide("s", "c").alias("x")))).alias("p"), F.max("c").alias("n"))
    return whole.select(*keys, F.col("p.x").alias(name), "n")


def stored_vector(c: Column) -> Column:
    """A vector stored as text, "[1.0, 2.5]", as array<double>; null where the text is none, or holds what is no number."""
    v = F.from_json(c, "array<double>")
    return F.when(F.forall(v, lambda x: x.isNotNull()), v)
