"""The order-dependent parts on streams: articles flagged and clustered as they arrive."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import Params
from ..operators.copypaste import flagged, hashed, linked_classes, named
from ..operators.online import ARTICLE, SCHEMA, Stories, run_rows
from ..operators.stories import Leader

_CORPUS = "id long, content string, media_name string, published_at long, origin string"
_HASHED = "id long, media_name string, published_at long, origin string, canon string, simhash long, sketch binary"


def flag_arrivals(articles: DataFrame, folder: str, p: Params = Params(), available_now: bool = True) -> StreamingQuery:
    """Flags each micro-batch of a stream against all articles before it and its own; writes folder/flags.

    What is kept of an article in folder/corpus is its canonical text with its hashes, so a batch makes
    hashes of its own articles only, and looks only for links of theirs. Both folders are written by
    batch number, so a batch that runs again after a failure replaces what it had written.
    """

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch.select([c.split()[0] for c in _CORPUS.split(", ")])
        hashed(rows, p).select([c.split()[0] for c in _HASHED.split(", ")]).write.mode("overwrite").parquet(f"{folder}/corpus/batch={number}")
        seen = spark.read.schema(_HASHED + ", batch long").option("basePath", f"{folder}/corpus").parquet(f"{folder}/corpus").filter(F.col("batch") <= number)
        own, texts = named(seen)
        links = linked_classes(texts, p, own.filter(F.col("batch") == number))
        flagged(rows.select("id", "published_at", "origin"), own, links, p).write.mode("overwrite").parquet(f"{folder}/flags/batch={number}")

    writer = articles.writeStream.foreachBatch(run).option("checkpointLocation", f"{folder}/checkpoint")
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def cluster_arrivals(articles: DataFrame, shard: str, p: Params = Params()) -> DataFrame:
    """A stream of (shard, id, cluster_id, sim, opened): online clustering whose state outlives the batches.

    ``articles``: a stream of id long, vec array<double>, published_at and the shard, a string. Within
    a batch, articles are taken in the order (published_at, id).
    """
    threshold = p.assign_thresh

    def run(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        leader = pickle.loads(state.get[0]) if state.exists else None
        rows = pd.concat(list(frames)).sort_values(["published_at", "id"])
        out = []
        for i, v in zip(rows["id"], rows["vec"]):
            v = np.asarray(v, float)
            if np.isfinite(v).all() and v.any():
                leader = leader or Leader(threshold, len(v))
                out.append((key[0], i, *leader.add(i, v)))
        if leader is not None:
            state.update((pickle.dumps(leader),))
        yield pd.DataFrame(out, columns=["shard", "id", "cluster_id", "sim", "opened"])

    return articles.select("id", "vec", "published_at", F.col(shard).alias("shard")).groupBy("shard").applyInPandasWithState(
        run, "shard string, id long, cluster_id long, sim double, opened boolean", "leader binary", "append", "NoTimeout"
    )


def attach_arrivals(articles: DataFrame, shard: str, topics: list[tuple[str, list[float]]] = (), p: Params = Params()) -> DataFrame:
    """A stream of (shard, id, cluster_id, ...): ``operators.online`` with stories that outlive the batches.

    ``articles``: a stream of what ``online_attach`` takes, ids long, the shard a string.
    """
    labels, vectors = [t for t, _ in topics], np.array([v for _, v in topics], float)
    unit = vectors / np.sqrt((vectors * vectors).sum(1))[:, None] if len(vectors) else None

    def run(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        stories = pickle.loads(state.get[0]) if state.exists else Stories(p, labels, unit)
        out = run_rows(stories, pd.concat(list(frames)))
        state.update((pickle.dumps(stories),))
        out.insert(0, "shard", key[0])
        yield out

    return articles.select(*ARTICLE, F.col(shard).alias("shard")).groupBy("shard").applyInPandasWithState(
        run, f"shard string, id long, cluster_id long, {SCHEMA}", "stories binary", "append", "NoTimeout"
    )
