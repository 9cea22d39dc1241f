"""What the operators share: table access, shared storage, Arrow batches, byte-level text."""

from __future__ import annotations

import atexit
import contextlib
import re
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of an Arrow batch. Texts can be long, so a batch is kept small.
BATCH_ROWS = 256
#: Bytes of an Arrow batch, where this Spark has that limit.
BATCH_BYTES = 4 << 20

_written: list[tuple[SparkSession, str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where it is unset, a local one on a single machine, and an error elsewhere."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        found = "file:///tmp/checkpoints"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def _delete(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@atexit.register
def _clean() -> None:
    while _written:
        _delete(*_written.pop())


def stored(df: DataFrame, *drop: DataFrame, compression: str = "snappy") -> DataFrame:
    """Writes df to the shared folder and reads it again, which cuts its lineage.

    ``drop``: earlier results of this function that nothing needs any longer.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    _written.append((spark, path))
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_path = path
    discard(*drop)
    return out


def discard(*frames: DataFrame) -> None:
    for x in frames:
        path = getattr(x, "_stored_path", None)
        if path:
            _delete(x.sparkSession, path)
            _written[:] = [w for w in _written if w[1] != path]


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    with contextlib.suppress(Exception):
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z only."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def held_out(id_col: str = "doc_id") -> Column:
    """True where crc32(id as text) mod 4 is 2; a null id counts as held out, so nothing is learned from it."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(True))


def fields(ddl: str) -> list[T.StructField]:
    return T.StructType.fromDDL(ddl).fields


def map_batches(
    df: DataFrame,
    keep: Sequence[str],
    inputs: Sequence[str],
    made: str,
    function: Callable[[Iterator[list[pa.Array]]], Iterator[list[pa.Array]]],
) -> DataFrame:
    """``keep`` columns unchanged plus the columns ``made`` (DDL) that ``function`` makes.

    ``function`` gets an iterator of lists of Arrow arrays (``inputs``) and yields, batch for batch
    and in order, lists of arrays (``made``). It may read several batches before it yields.
    An input column with the name of a made one is replaced.
    """
    small_batches(df.sparkSession)
    new = fields(made)
    names = {f.name.lower() for f in new}
    keep = [k for k in keep if k.lower() not in names]
    types = {f.name: f for f in df.schema.fields}
    schema = T.StructType([types[k] for k in keep] + new)
    src = df.select(
        *[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keep)],
        *[F.col(f"`{k}`").alias(f"x{i}") for i, k in enumerate(inputs) if k not in keep],
    )
    at = [keep.index(k) if k in keep else f"x{i}" for i, k in enumerate(inputs)]
    n_keep = len(keep)
    out_names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[list[pa.Array]] = []

        def feed() -> Iterator[list[pa.Array]]:
            for b in batches:
                if b.num_rows:
                    waiting.append([b.column(i) for i in range(n_keep)])
                    yield [b.column(a) for a in at]

        for got in function(feed()):
            yield pa.RecordBatch.from_arrays([*waiting.pop(0), *got], names=out_names)

    return src.mapInArrow(run, schema)


def in_one_task(rows: DataFrame, made: str, function: Callable[[pa.Table], pa.RecordBatch]) -> pa.Table:
    """What ``function`` makes of all rows together, in one task of an executor: for samples of bounded size.

    Only its result reaches the driver. Without rows the result is empty.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if got:
            yield function(pa.Table.from_batches(got))

    return rows.repartition(1).mapInArrow(run, made).toArrow()


def numbered(df: DataFrame) -> DataFrame:
    """df with its columns named c0, c1 and so on, so that no name of theirs meets one of an operator."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def utf8(a: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets from 0) of a string array; null counts as empty."""
    a = pc.fill_null(a, "") if a.null_count else a
    large = pa.types.is_large_string(a.type)
    off = np.frombuffer(a.buffers()[1], np.int64 if large else np.int32)[a.offset : a.offset + len(a) + 1].astype(np.int64)
    data = a.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    return raw, off - off[0]


def valid(a: pa.Array) -> np.ndarray:
    return np.asarray(a.is_valid().to_numpy(zero_copy_only=False), bool)


def in_pieces(off: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges [i, j) that cover all rows and hold at most ``most`` bytes, or one row."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + most, "right")) - 1)
        yield i, j
        i = j


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenated ranges start .. start + length."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)
