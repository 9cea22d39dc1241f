"""Online attachment: each article joins the story it fits best, and the story changes with it.

An article's score with a story is the cosine with its centroid, plus shares of the overlap of their
entities and of their places, plus a bonus if the story's latest article is near in time. Only the
stories with the highest cosines are scored; the article joins the best from the threshold on, else
it opens a story. Either way the story's centroid, size, latest time, entities, places and topics are
renewed before the next article comes.

Every decision depends on all before it, so what is clustered together is one task; shards (a region,
a day, a language) run side by side. Stories do not cross shards.

An article without a live vector, or with one of another length than its shard's first, is left out.
Null entities or places are none, a null date is 0. Articles are taken in the order (published_at, id),
newest first if asked; repeated articles are articles of their own. A story is named by its first article.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..config import Params

PLACE_LABELS = ("GPE", "LOC")
ENTITY = "struct<text:string,label:string,count:bigint>"
PLACE = "struct<place:string,frequency:bigint,place_source:string>"
#: Fixed value: the place of a story that names none and whose outlets are in no known region.
HOME = "台灣"


class Names:
    """Numbers of names, in the order seen; a name is held once for a shard, whichever stories have it."""

    def __init__(self):
        self.number: dict = {}
        self.names: list = []
        self.place = np.full(1024, -1, np.int32)  # -1 but while Tally.add or overlap runs

    def of(self, names: Iterable) -> np.ndarray:
        out = []
        for x in names:
            k = self.number.get(x)
            if k is None:
                k = self.number[x] = len(self.names)
                self.names.append(x)
            out.append(k)
        if len(self.names) > len(self.place):
            self.place = np.full(2 * len(self.names), -1, np.int32)
        return np.array(out, np.int32)

    def overlap(self, a: np.ndarray, b: np.ndarray) -> float:
        """Of two sets of numbers: what they share of what either has; 0 if one is empty."""
        if not len(a) or not len(b):
            return 0.0
        self.place[a] = 1
        both = int((self.place[b] == 1).sum())
        self.place[a] = -1
        return both / (len(a) + len(b) - both)


class Tally:
    """Counts of numbered names in the order seen: 12 bytes for each."""

    __slots__ = ("ids", "counts")

    def __init__(self, ids: np.ndarray = np.zeros(0, np.int32), counts: Iterable[int] = ()):
        self.ids, self.counts = ids, np.array(list(counts), np.int64)

    def __len__(self) -> int:
        return len(self.ids)

    def add(self, other: Tally, names: Names) -> None:
        names.place[self.ids] = np.arange(len(self.ids), dtype=np.int32)
        at = names.place[other.ids]
        names.place[self.ids] = -1
        known = at >= 0
        self.counts[at[known]] += other.counts[known]
        if not known.all():
            self.ids = np.concatenate([self.ids, other.ids[~known]])
            self.counts = np.concatenate([self.counts, other.counts[~known]])

    def top(self, k: int | None = None) -> list[tuple[int, int]]:
        """(number, count) of the k most frequent, or of all, then the first seen."""
        at = np.arange(len(self.ids))
        if k is not None and len(at) > k:
            at = np.flatnonzero(self.counts >= np.partition(self.counts, len(at) - k)[len(at) - k])
        at = at[np.argsort(-self.counts[at], kind="stable")][:k]
        return list(zip(self.ids[at].tolist(), self.counts[at].tolist()))


@dataclass(slots=True)
class Story:
    """What is known of a story beside its centroid. Names are numbers of its shard's."""

    name: object
    size: int
    latest: int
    entities: Tally  # by (text, label)
    texts: np.ndarray
    places: Tally
    regions: Tally
    loaded: np.ndarray | None = None  # a stored story's places, until an article tells others


@dataclass
class Article:
    name: object
    vector: np.ndarray
    entities: list[tuple[str, str, int]]
    places: list[str]  # one for each mention
    region: str | None
    published: int


def classified(v: np.ndarray, labels: list[str], topics: np.ndarray | None, p: Params) -> tuple:
    """(main topic, score, secondary topic, score, ambiguous) of a centroid; topics: rows of length 1."""
    if topics is None or not len(labels) or not np.isfinite(v).all() or len(v) != topics.shape[1]:
        return None, 0.0, None, 0.0, True
    sims = topics @ (v / (np.sqrt(v @ v) + 1e-12))
    order = np.argsort(-sims, kind="stable")
    main, score = labels[order[0]], float(sims[order[0]])
    second, second_score = None, 0.0
    if len(order) > 1 and sims[order[1]] >= p.topic_secondary_min:
        second, second_score = labels[order[1]], float(sims[order[1]])
    return main, score, second, second_score, score < p.topic_min_sim or (second is not None and score - second_score < p.topic_margin)


class Stories:
    """The stories of a shard, and how articles join them."""

    def __init__(self, p: Params, labels: list[str] = (), topics: np.ndarray | None = None):
        self.p, self.labels, self.topics = p, list(labels), topics
        self.stories: list[Story] = []
        self.centroids, self.norms = np.zeros((0, 0)), np.zeros(0)
        self.entities, self.texts, self.places = Names(), Names(), Names()
        self.home = self.places.of([HOME])

    def _append(self, story: Story, centroid: np.ndarray) -> None:
        n = len(self.stories)
        if n == 0:
            self.centroids, self.norms = np.zeros((64, len(centroid))), np.zeros(64)
        elif n == len(self.centroids):  # room for as many again
            self.centroids, self.norms = (np.concatenate([x, np.zeros_like(x)]) for x in (self.centroids, self.norms))
        self.stories.append(story)
        self._place(n, centroid)

    def _place(self, i: int, centroid: np.ndarray) -> None:
        self.centroids[i] = centroid
        self.norms[i] = np.sqrt((centroid * centroid).sum())

    def _text_ids(self, entities: Iterable[tuple]) -> np.ndarray:
        return self.texts.of(dict.fromkeys(e[0] for e in entities))

    def _source(self, s: Story) -> tuple[Tally | None, str]:
        """Where a story's places come from."""
        return (s.places, "ENTITIES") if len(s.places) else (s.regions, "MEDIA_NAME") if len(s.regions) else (None, "DEFAULT_TAIWAN_IF_LOCAL")

    def _place_ids(self, s: Story) -> np.ndarray:
        counted, _ = self._source(s)
        return counted.ids if counted is not None else self.home if s.loaded is None else s.loaded

    def detail(self, s: Story) -> list[tuple[str, int, str]]:
        """Places with frequency and where they come from, the most frequent first, then the first seen."""
        counted, source = self._source(s)
        return [(HOME, 0, source)] if counted is None else [(self.places.names[q], k, source) for q, k in counted.top()]

    def load(self, name: object, size: int, latest: int, entities: dict, places: Iterable, centroid: np.ndarray) -> None:
        """A stored story, to be joined by articles; one without a live centroid, or of another length, is left out."""
        if len(centroid) and np.isfinite(centroid).all() and centroid.any() and (not self.stories or len(centroid) == self.centroids.shape[1]):
            counted = Tally(self.entities.of(entities), entities.values())
            self._append(Story(name, size, latest, counted, self._text_ids(entities), Tally(), Tally(), self.places.of(dict.fromkeys(places))), centroid)

    def add(self, a: Article) -> tuple | None:
        """A row of what happened (see SCHEMA), or None if the article is left out."""
        p, v, n = self.p, a.vector, len(self.stories)
        if not len(v) or not np.isfinite(v).all() or np.sqrt(v @ v) <= 1e-8 or (n and len(v) != self.centroids.shape[1]):
            return None
        entities, named = {(t, label): k for t, label, k in a.entities}, Counter(a.places)
        counted, texts = Tally(self.entities.of(entities), entities.values()), self._text_ids(entities)
        places = Tally(self.places.of(named), named.values())
        best, found, tried = -1.0, None, 0
        if n:
            sims = self.centroids[:n] @ v / np.maximum(self.norms[:n] * np.sqrt(v @ v), 1e-300)
            order = np.argsort(-sims, kind="stable")[: p.top_k_attach]
            tried = len(order)
            for i in order.tolist():
                s = self.stories[i]
                parts = float(sims[i]), self.texts.overlap(texts, s.texts), self.places.overlap(places.ids, self._place_ids(s)), p.time_bonus if abs(a.published - s.latest) <= p.time_window_days * 86_400 else 0.0
                score = parts[0] + p.alpha_ent * parts[1] + p.alpha_place * parts[2] + parts[3]
                if score > best:
                    best, found = score, (i, parts)
        joined = found is not None and best >= p.assign_thresh
        if joined:
            i = found[0]
            s = self.stories[i]
            self._place(i, (self.centroids[i] * s.size + v) / (s.size + 1))
            s.latest = max(s.latest, a.published)
            s.entities.add(counted, self.entities)
        else:
            s = Story(a.name, 0, a.published, counted, texts, Tally(), Tally())
            self._append(s, v)
            i = n
        top = [(self.entities.names[e], k) for e, k in s.entities.top(10)]
        if joined:
            s.texts = self._text_ids(e for e, _ in top)
        s.size += 1
        s.places.add(places, self.places)
        if a.region:
            s.regions.add(Tally(self.places.of([a.region]), [1]), self.places)
        parts = found[1] if found else (None,) * 4
        shown = [{"text": t, "label": label, "count": k} for (t, label), k in top]
        detail = [{"place": q, "frequency": k, "place_source": source} for q, k, source in self.detail(s)]
        return (a.name, s.name, not joined, tried, *parts, best if found else None, joined, s.size, s.latest, *classified(self.centroids[i], self.labels, self.topics, p), [d["place"] for d in detail], detail, shown)


#: Of an article's row, after its id and cluster_id (which have the type of the id).
SCHEMA = (
    "opened boolean, attach_candidates int, attach_sim double, attach_ent_overlap double, attach_place_overlap double, attach_time_bonus double, attach_combined double, attached_existing boolean, "
    "cluster_size bigint, latest_published bigint, main_topic string, main_topic_score double, secondary_topic string, secondary_topic_score double, ambiguous boolean, "
    f"places_in_concern array<string>, places_in_detail array<{PLACE}>, top_entities array<{ENTITY}>"
)
COLUMNS = ["id", "cluster_id", *[c.split()[0] for c in SCHEMA.split(", ") if " " in c and "<" not in c.split()[0]]]
ARTICLE = ("id", "vec", "ents", "places", "region", "published_at")


def _whole(x, least: int) -> int:
    """A number that may be null, which pandas has as NaN."""
    return least if x is None or x != x else max(least, int(x))


def _list(x) -> list:
    return [] if x is None else list(x)


def article(name, vec, ents, places, region, published) -> Article:
    return Article(name, np.asarray(_list(vec), float), [(e["text"], e["label"], _whole(e["count"], 0)) for e in _list(ents) if e["text"] is not None], [q for q in _list(places) if q is not None], region or None, int(published))


def articles_of(rows: pd.DataFrame, newest_first: bool = False) -> Iterable[Article]:
    rows = rows.assign(published_at=rows["published_at"].fillna(0)).sort_values(["published_at", "id"], ascending=[not newest_first, True], kind="stable")
    return (article(*r) for r in rows[list(ARTICLE)].itertuples(index=False))


def run_rows(state: Stories, rows: pd.DataFrame, newest_first: bool = False) -> pd.DataFrame:
    out = [got for a in articles_of(rows, newest_first) if (got := state.add(a)) is not None]
    return pd.DataFrame(out, columns=COLUMNS).astype({"attach_candidates": "int32", "cluster_size": "int64", "latest_published": "int64"} if out else {})


def online_attach(articles: DataFrame, shard: str, stored: DataFrame | None = None, topics: list[tuple[str, list[float]]] = (), p: Params = Params(), newest_first: bool = False) -> DataFrame:
    """A row for each article that is clustered: its id, cluster_id and what SCHEMA says.

    ``articles``: id, vec, ents (array<struct<text, label, count>>), places (an array, canonical, one
    for each mention), region, published_at and the shard; ``stored``: cluster_id, centroid, size,
    latest_published, top_entities, places_in_concern and the shard, the stories that are there before;
    ``topics``: a short list of names and vectors. The sizes of stored stories weigh in centroids, and
    their entities count on.

    A shard's rows come to its task in order, stored stories first, an Arrow batch at a time; what
    the task holds is the stories.
    """
    labels, vectors = [t for t, _ in topics], np.array([v for _, v in topics], float)
    unit = vectors / np.sqrt((vectors * vectors).sum(1))[:, None] if len(vectors) else None
    kind = articles.schema["id"].dataType.simpleString()
    schema = f"id {kind}, cluster_id {kind}, {SCHEMA}"
    types = {"id": kind, "vec": "array<double>", "ents": f"array<{ENTITY}>", "places": "array<string>", "region": "string", "published_at": "bigint", "size": "bigint"}
    rows = articles.withColumns({"size": F.lit(None), "new_": F.lit(1)})
    if stored is not None:
        old = {"id": "cluster_id", "vec": "centroid", "ents": "top_entities", "places": "places_in_concern", "published_at": "latest_published", "size": "size"}
        before = stored.select(*[(F.col(old[c]) if c in old else F.lit(None)).cast(t).alias(c) for c, t in types.items()], F.lit(0).alias("new_"), F.col(shard).alias("shard_"))
    rows = rows.select(*[F.col(c).cast(t) for c, t in types.items()], "new_", F.col(shard).alias("shard_"))
    rows = rows if stored is None else rows.unionByName(before)
    # a fixed number of tasks: small ones would be put together, and shards run one after another
    at = F.when(F.col("new_") == 1, F.coalesce("published_at", F.lit(0)) * (-1 if newest_first else 1))
    rows = rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "shard_").sortWithinPartitions("shard_", "new_", at, F.asc_nulls_last("id"))

    kinds = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, mine = None, None
        for b in batches:
            out = []
            columns = [b.column(c) for c in (*ARTICLE, "size", "new_", "shard_")]
            for i in range(b.num_rows):  # a row at a time: as Python objects, its entities take many times their room
                *own, size, new, key = (c[i].as_py() for c in columns)
                if state is None or not (key == mine or key != key and mine != mine):
                    state, mine = Stories(p, labels, unit), key
                name, vec, ents, places, region, published = own
                if new:
                    got = state.add(article(name, vec, ents, places, region, published or 0))
                    if got is not None:
                        out.append(dict(zip(COLUMNS, got)))
                else:
                    counted = {(e["text"], e["label"]): _whole(e["count"], 0) for e in _list(ents) if e["text"] is not None}
                    state.load(name, _whole(size, 1), _whole(published, 0), counted, _list(places), np.asarray(_list(vec), float))
            yield pa.RecordBatch.from_pylist(out, schema=kinds)

    return rows.mapInArrow(run, schema)
