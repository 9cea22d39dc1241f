"""Order-dependent operators: online clustering and the choice of central articles."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Params


class Leader:
    """Clusters that grow row by row: an article joins the nearest one from the threshold on, else opens its own."""

    def __init__(self, threshold: float, d: int):
        self.threshold, self.n = threshold, 0
        self.sums, self.unit = np.zeros((64, d)), np.zeros((64, d))
        self.size, self.name = np.zeros(64), []

    def add(self, name, v: np.ndarray):
        """(cluster, similarity to it, opened); a vector of another length than the first opens nothing: (None, None, False)."""
        if len(v) != self.sums.shape[1]:
            return None, None, False
        length = np.sqrt(v @ v)
        if self.n:
            sims = self.unit[: self.n] @ v / length
            k = int(sims.argmax())
            if sims[k] >= self.threshold:
                self.size[k] += 1
                self.sums[k] += v
                self.unit[k] = self.sums[k] / np.sqrt(self.sums[k] @ self.sums[k])
                return self.name[k], float(sims[k]), False
        if self.n == len(self.size):  # room for as many again
            self.sums, self.unit = (np.concatenate([x, np.zeros_like(x)]) for x in (self.sums, self.unit))
            self.size = np.concatenate([self.size, np.zeros_like(self.size)])
        self.sums[self.n], self.unit[self.n], self.size[self.n] = v, v / length, 1
        self.name.append(name)
        self.n += 1
        return name, None, True


def online_clusters(articles: DataFrame, shard: str, p: Params = Params()) -> DataFrame:
    """(id, cluster_id, sim, opened) by online clustering of each shard in the order (published_at, id).

    Every decision depends on all before it, so a shard is one task, and clusters do not cross
    shards: choose a shard (region, day, language) whose articles fit one. A cluster is named by the
    article that opened it. Articles without a live vector are left out.
    """
    threshold = p.assign_thresh

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["published_at", "id"])
        state, out = None, []
        for i, v in zip(rows["id"], rows["vec"]):
            v = np.asarray(v, float)
            if not np.isfinite(v).all() or not v.any():
                continue
            state = state or Leader(threshold, len(v))
            out.append((i, *state.add(i, v)))
        return pd.DataFrame(out, columns=["id", "cluster_id", "sim", "opened"])

    kind = articles.schema["id"].dataType.simpleString()
    return articles.select("id", "vec", "published_at", shard).groupBy(shard).applyInPandas(run, f"id {kind}, cluster_id {kind}, sim double, opened boolean")


def central_articles(members: DataFrame, k: int = 3, redundant: float = 0.92) -> DataFrame:
    """(cluster_id, id, rank): up to k members nearest to the centroid, none too like one chosen before.

    ``members``: cluster_id, id, vec, sim (to the centroid). A story has the articles of a few days, so its
    members are one task; without members there is no row.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["sim", "id"], ascending=[False, True])
        chosen, vectors = [], []
        for i, v in zip(rows["id"], rows["vec"]):
            v = np.asarray(v, float)
            v = v / max(np.sqrt(v @ v), 1e-12)
            if not vectors or max(float(v @ u) for u in vectors) < redundant:
                chosen.append(i)
                vectors.append(v)
                if len(chosen) == k:
                    break
        return pd.DataFrame({"cluster_id": rows["cluster_id"].iloc[0], "id": chosen, "rank": range(1, len(chosen) + 1)})

    kinds = {c: members.schema[c].dataType.simpleString() for c in ("cluster_id", "id")}
    return members.select("cluster_id", "id", "vec", "sim").groupBy("cluster_id").applyInPandas(run, f"cluster_id {kinds['cluster_id']}, id {kinds['id']}, rank int")


def pca_2d(items: DataFrame, vector: str = "vec") -> DataFrame:
    """items' id with x and y, the first two principal components (a stand-in for a UMAP plot)."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    data = items.select("id", array_to_vector(F.col(vector).cast("array<double>")).alias("f"))
    got = PCA(k=2, inputCol="f", outputCol="p").fit(data).transform(data).select("id", vector_to_array("p").alias("p"))
    return got.select("id", F.col("p")[0].alias("x"), F.col("p")[1].alias("y"))
