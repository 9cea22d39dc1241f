"""Articles against story clusters: top clusters by cosine, combined score, decision; topics of a vector.

Articles without a live vector meet no cluster, open one of their own, and have no topic. Null and
empty sets of entities or places overlap with nothing. Without clusters every article opens one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Params
from ..functions.text import jaccard
from ..functions.vector import is_live, normalize

#: Topics are a fixed list, sent to all workers; more than this many are refused.
TOPICS = 1000
#: Rows of the smaller side that are compared at a time; a side of more rows is dealt out in blocks of this many.
BROADCAST_ROWS = 20_000
#: Articles that meet a block of clusters in one task.
MET_ROWS = 100_000


def _best(ids: np.ndarray, x: np.ndarray, names: np.ndarray, y: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row of x its k nearest of y by cosine, ties to the smaller name: (id, name, cosine)."""
    by_name = np.argsort(names, kind="stable")
    names, y = names[by_name], y[by_name]
    sims = x @ y.T / np.sqrt((x * x).sum(1))[:, None] / np.sqrt((y * y).sum(1))
    at = np.argsort(-sims, axis=1, kind="stable")[:, :k]
    return np.repeat(ids, at.shape[1]), names[at].ravel(), np.take_along_axis(sims, at, 1).ravel()


def _table(t: pa.Table | pa.RecordBatch, name: str, vector: str) -> list[tuple[np.ndarray, np.ndarray]]:
    """(names, vectors) for each length of vector."""
    lists = t.column(vector)
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    names = t.column(name).to_numpy() if isinstance(t, pa.Table) else t.column(name).to_numpy(zero_copy_only=False)
    size = np.diff(lists.offsets.to_numpy())
    flat, at = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    return [(names[rows], flat[at[rows][:, None] + np.arange(d)]) for d in np.unique(size) for rows in [np.flatnonzero(size == d)]]


def top_clusters(articles: DataFrame, clusters: DataFrame, p: Params = Params()) -> DataFrame:
    """(id, cluster_id, sim, rank): the most similar clusters of each article with a live vector.

    ``articles``: id, vec; ``clusters``: cluster_id, centroid; each name once. Ties go to the smaller
    cluster id; vectors are compared with those of their own length. Up to BROADCAST_ROWS clusters are
    sent to all workers, and an article's k best found where it lies. More are dealt into blocks of as
    many, articles meet each block in a task of its own, and what reaches the ranking is k rows for each
    article and block, never all pairs.
    """
    k = p.top_k_attach
    c = clusters.filter(is_live(F.col("centroid"))).select("cluster_id", F.col("centroid").cast("array<double>").alias("c_"))
    a = articles.filter(is_live(F.col("vec"))).select("id", F.col("vec").cast("array<double>").alias("v_"))
    kinds = {"id": a.schema["id"].dataType.simpleString(), "cluster_id": c.schema["cluster_id"].dataType.simpleString()}
    made = f"id {kinds['id']}, cluster_id {kinds['cluster_id']}, sim double"

    def pairs(mine: list, others: list) -> Iterator[pa.RecordBatch]:
        for ids, x in mine:
            for names, y in others:
                for at in range(0, len(ids) if x.shape[1] == y.shape[1] else 0, 1024):
                    yield pa.RecordBatch.from_arrays([pa.array(v) for v in _best(ids[at : at + 1024], x[at : at + 1024], names, y, k)], names=["id", "cluster_id", "sim"])

    few = c.limit(BROADCAST_ROWS + 1).toArrow()
    if few.num_rows <= BROADCAST_ROWS:
        shared = articles.sparkSession.sparkContext.broadcast(_table(few, "cluster_id", "c_"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    yield from pairs(_table(b, "id", "v_"), shared.value)

        got = a.mapInArrow(run, made)
    else:
        blocks = -(-c.count() // BROADCAST_ROWS)

        def meet(mine: pa.Table, others: pa.Table) -> pa.Table:
            batches = list(pairs(_table(mine, "id", "v_"), _table(others, "cluster_id", "c_"))) if mine.num_rows and others.num_rows else []
            return pa.Table.from_batches(batches) if batches else pa.table({"id": mine["id"][:0], "cluster_id": others["cluster_id"][:0], "sim": pa.array([], pa.float64())})

        parts = max(1, -(-a.count() // MET_ROWS))
        mine = a.withColumns({"pa_": F.pmod(F.xxhash64("id"), F.lit(parts)), "pc_": F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))})
        others = c.withColumns({"pc_": F.pmod(F.xxhash64("cluster_id"), F.lit(blocks)).cast("int"), "pa_": F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(parts - 1).cast("bigint")))})
        got = mine.groupBy("pa_", "pc_").cogroup(others.groupBy("pa_", "pc_")).applyInArrow(meet, made)
    by = Window.partitionBy("id").orderBy(F.desc("sim"), "cluster_id")
    return got.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)


def combined(top: DataFrame, articles: DataFrame, clusters: DataFrame, p: Params = Params()) -> DataFrame:
    """top with ent, place, time and score. Both sides carry ``ents`` and ``places`` (arrays); articles
    ``published_at``, clusters ``latest_published``."""
    a = articles.select("id", F.col("ents").alias("ae"), F.col("places").alias("ap"), "published_at")
    c = clusters.select("cluster_id", F.col("ents").alias("ce"), F.col("places").alias("cp"), "latest_published")
    time = F.when(F.abs(F.col("published_at") - F.col("latest_published")) <= p.time_window_days * 86_400, p.time_bonus).otherwise(0.0)
    parts = top.join(a, "id").join(c, "cluster_id").select("id", "cluster_id", "sim", "rank", jaccard(F.col("ae"), F.col("ce")).alias("ent"), jaccard(F.col("ap"), F.col("cp")).alias("place"), time.alias("time"))
    return parts.withColumn("score", F.col("sim") + p.alpha_ent * F.col("ent") + p.alpha_place * F.col("place") + F.col("time"))


def decide(scored: DataFrame, articles: DataFrame, p: Params = Params()) -> DataFrame:
    """(id, cluster_id, score, attached_existing): the best cluster, or a new one named after the article."""
    best = scored.groupBy("id").agg(F.min_by(F.struct("cluster_id", "score"), F.struct(-F.col("score"), -F.col("sim"), "cluster_id")).alias("b"))
    out = articles.select("id").join(best, "id", "left")
    on = F.coalesce(F.col("b.score") >= p.assign_thresh, F.lit(False))
    return out.select("id", F.when(on, F.col("b.cluster_id")).otherwise(F.col("id")).alias("cluster_id"), F.col("b.score").alias("score"), on.alias("attached_existing"))


def topic_candidates(items: DataFrame, topics: DataFrame, p: Params = Params()) -> DataFrame:
    """(id, label, score, rank) of the nearest topics. ``topics``: label, vec of length 1; a list of up to TOPICS."""
    if topics.limit(TOPICS + 1).count() > TOPICS:
        raise ValueError(f"more than {TOPICS} topics")
    t = F.broadcast(topics.select("label", F.col("vec").alias("tv")))
    c = items.filter(is_live(F.col("vec"))).select("id", normalize(F.col("vec")).alias("v")).join(t)
    sim = F.aggregate(F.zip_with("v", "tv", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    by = Window.partitionBy("id").orderBy(F.desc("score"), "label")
    return c.select("id", "label", sim.alias("score")).withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= p.topic_max_candidates)


def topic_decision(items: DataFrame, candidates: DataFrame, p: Params = Params()) -> DataFrame:
    """(id, main_topic, main_topic_score, secondary_topic, secondary_topic_score, ambiguous); an item without a live vector is ambiguous."""

    def of(rank: int, what: str) -> Column:
        return F.max(F.when(F.col("rank") == rank, F.col(what)))

    got = candidates.groupBy("id").agg(of(1, "label").alias("m"), of(1, "score").alias("ms"), of(2, "label").alias("s"), of(2, "score").alias("ss"))
    out = items.select("id").join(got, "id", "left")
    kept = F.coalesce(F.col("ss") >= p.topic_secondary_min, F.lit(False))
    unclear = F.col("m").isNull() | (F.col("ms") < p.topic_min_sim) | (kept & (F.col("ms") - F.col("ss") < p.topic_margin))
    return out.select(
        "id", F.col("m").alias("main_topic"), F.coalesce("ms", F.lit(0.0)).alias("main_topic_score"), F.when(kept, F.col("s")).alias("secondary_topic"),
        F.when(kept, F.col("ss")).otherwise(0.0).alias("secondary_topic_score"), unclear.alias("ambiguous"),
    )
