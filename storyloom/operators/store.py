"""Persistence: probes, upserts, merges and manifests as joins that give the next version of a table.

Rows with a null key are never matched: they are new in a split, and left out of inserts and upserts.
Of several rows with one key in a patch or batch, one is taken (see each function). Empty sides are
allowed everywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

UUID = r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
#: The places that may be written.
WRITABLE = (
    "台北市 新北市 桃園市 台中市 台南市 高雄市 基隆市 新竹市 嘉義市 宜蘭縣 花蓮縣 台東縣 南投縣 彰化縣 雲林縣 屏東縣 苗栗縣 新竹縣 嘉義縣 "
    "澎湖縣 金門縣 連江縣 香港 中國 美國 加沙 以色列 烏克蘭 歐盟 日本 韓國 國際"
).split()


def split_known(rows: DataFrame, known: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows that exist, new rows)."""
    keys = known.select(key).distinct()
    return rows.join(keys, key, "left_semi"), rows.join(keys, key, "left_anti")


def insert_new(base: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """base and those rows whose key it does not have; of several rows with one key, the first in the order of all columns."""
    fresh = rows.filter(F.col(key).isNotNull()).join(base.select(key), key, "left_anti").select(base.columns)
    others = [c for c in base.columns if c != key]
    one = fresh.groupBy(key).agg(F.min(F.struct(*others)).alias("r")).select(key, "r.*")
    return base.unionByName(one)


def upsert(base: DataFrame, patch: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """base with the non-null ``columns`` of patch, and the rows of patch that it lacks.

    If patch repeats a key, the largest value of each column counts.
    """
    new = patch.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("k_")).agg(*[F.max(c).alias(f"p_{c}") for c in columns])
    merged = base.join(new, base[key] == F.col("k_"), "full_outer")
    pick = lambda c: F.coalesce(f"p_{c}", c) if c in columns else F.col(c)
    return merged.select(*[F.coalesce(key, "k_").alias(key) if c == key else pick(c).alias(c) for c in base.columns])


def batch_by_cluster(rows: DataFrame, order: str) -> DataFrame:
    """(cluster_id, first_id, article_count, latest_published) of the articles of a batch."""
    return rows.groupBy("cluster_id").agg(F.min_by("id", F.struct(order, "id")).alias("first_id"), F.count("*").alias("article_count"), F.max("published_at").alias("latest_published"))


def merge_clusters(base: DataFrame, batch: DataFrame) -> DataFrame:
    """Clusters with the counts of a batch added and the later of both times; clusters of the batch alone appear as they are."""
    b = batch.select("cluster_id", F.col("article_count").alias("n_"), F.col("latest_published").alias("l_"))
    return base.join(b, "cluster_id", "full_outer").select(
        "cluster_id", (F.coalesce("article_count", F.lit(0)) + F.coalesce("n_", F.lit(0))).alias("article_count"),
        F.greatest(F.coalesce("latest_published", F.lit(0)), F.coalesce("l_", F.lit(0))).alias("latest_published"),
    )


#: What a batch says anew about a cluster, if it says anything.
SAID = ("main_topic", "main_topic_score", "secondary_topic", "secondary_topic_score", "ambiguous", "places_in_concern", "places_in_detail")


def merge_cluster_facts(base: DataFrame, batch: DataFrame, k: int = 10) -> DataFrame:
    """The stored clusters after a batch: (cluster_id, article_count, latest_published, centroid, top_entities, *SAID).

    Both sides have these columns and one row for each cluster. Counts are added, the later time and
    the mean of all articles' vectors taken; entities (array<struct<text, label, count>>) are added by
    text and label and cut to the k most frequent (then by text and label). The topics go together:
    they are the batch's if it names a main one. Each other column of SAID is the batch's where it is
    not null. Places outside the writable ones are dropped, and a list without any is null.
    """
    old, new = ({c: F.col(f"{side}.{c}") for c in ("article_count", "latest_published", "centroid", "top_entities", *SAID)} for side in ("o", "n"))
    one = lambda side: F.when(F.col("cluster_id").isNull(), side).otherwise(-1).alias("t_")  # noqa: E731 -- rows without a key stay apart
    base, batch = base.select("*", one(0)), batch.select("*", one(1))
    joined = base.alias("o").join(batch.alias("n"), F.col("o.cluster_id") == F.col("n.cluster_id"), "full_outer")
    zero = F.lit(0).cast("bigint")
    n_old, n_new = F.coalesce(old["article_count"], zero), F.coalesce(new["article_count"], zero)
    topic = {c: F.when(new["main_topic"].isNotNull(), new[c]).otherwise(old[c]) for c in SAID[:4]}
    said = {"ambiguous": F.coalesce(new["ambiguous"], old["ambiguous"]), "places_in_concern": F.coalesce(writable_places(new["places_in_concern"]), old["places_in_concern"]), "places_in_detail": F.coalesce(writable_detail(new["places_in_detail"]), old["places_in_detail"])}
    merged = joined.select(
        F.coalesce("o.t_", "n.t_").alias("t_"), F.coalesce("o.cluster_id", "n.cluster_id").alias("cluster_id"), (n_old + n_new).alias("article_count"),
        F.greatest(F.coalesce(old["latest_published"], zero), F.coalesce(new["latest_published"], zero)).alias("latest_published"),
        weighted_centroid(old["centroid"], n_old, new["centroid"], n_new).alias("centroid"),
        *[x.alias(c) for c, x in (topic | said).items()],
    )
    none = F.array().cast("array<struct<text:string,label:string,count:bigint>>")
    tops = top_of(base.select("cluster_id", "t_", "top_entities").unionByName(batch.select("cluster_id", "t_", "top_entities")).select("cluster_id", "t_", F.explode("top_entities").alias("e")).select("cluster_id", "t_", "e.text", "e.label", F.col("e.count").alias("count")), k).toDF("c_", "u_", "top_entities")
    out = merged.join(tops, F.col("cluster_id").eqNullSafe(F.col("c_")) & (F.col("t_") == F.col("u_")), "left").withColumn("top_entities", F.coalesce("top_entities", none))
    return out.select("cluster_id", "article_count", "latest_published", "centroid", "top_entities", *SAID)


def top_of(counted: DataFrame, k: int) -> DataFrame:
    """(cluster_id, t_, top_entities) of rows cluster_id, t_, text, label, count: counts added, the k most frequent, then by text and label.

    By sums and ranks of rows, so that a cluster's list of names, however long, is never searched for each of them.
    """
    summed = counted.groupBy("cluster_id", "t_", "text", "label").agg(F.sum(F.coalesce(F.col("count"), F.lit(0).cast("bigint"))).alias("count"))
    by = Window.partitionBy("cluster_id", "t_").orderBy(F.desc("count"), F.asc_nulls_last("text"), F.asc_nulls_last("label"))
    best = summed.withColumn("r", F.row_number().over(by)).filter(F.col("r") <= k)
    return best.groupBy("cluster_id", "t_").agg(F.array_sort(F.collect_list(F.struct("r", "text", "label", "count"))).alias("x")).select("cluster_id", "t_", F.transform("x", lambda e: F.struct(e.text.alias("text"), e.label.alias("label"), e["count"].alias("count"))).alias("top_entities"))


def weighted_centroid(old: Column, n: Column, mean: Column, m: Column) -> Column:
    """The mean of n vectors whose mean is old and m more whose mean is ``mean``."""
    return F.when(old.isNull(), mean).when(mean.isNull(), old).otherwise(F.zip_with(old, mean, lambda x, y: (x * n + y * m) / (n + m)))


def writable_detail(c: Column) -> Column:
    """Of array<struct<place, frequency, place_source>>, those whose place may be written, in their order; null if none is left."""
    kept = F.filter(c, lambda x: x.place.isin(*WRITABLE))
    return F.when(F.size(kept) > 0, kept)


def writable_places(c: Column) -> Column:
    """The places that may be written, in their order; null if none is left."""
    kept = F.array_distinct(F.filter(c, lambda x: x.isin(*WRITABLE)))
    return F.when(F.size(kept) > 0, kept)


def valid_uuid(c: Column) -> Column:
    return F.coalesce(c.rlike(UUID), F.lit(False))


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def new_job(spark: SparkSession, jobs: DataFrame, start: int) -> tuple[DataFrame, int]:
    """(jobs with one more row, its id)."""
    job = (jobs.agg(F.max("id")).first()[0] or 0) + 1
    row = spark.createDataFrame([(job, None, start, None)], "id int, visualisation_url string, start_time bigint, end_time bigint")
    return jobs.unionByName(row), job


def finish_job(jobs: DataFrame, job: int, url: str | None, end: int) -> DataFrame:
    mine = F.col("id") == job
    return jobs.withColumns({"visualisation_url": F.when(mine, F.lit(url)).otherwise(F.col("visualisation_url")), "end_time": F.when(mine, F.lit(end).cast("bigint")).otherwise(F.col("end_time"))})


def log_failure(spark: SparkSession, failures: DataFrame, job: int, kind: str, detail: str, at: int) -> DataFrame:
    n = (failures.agg(F.max("id")).first()[0] or 0) + 1
    row = spark.createDataFrame([(n, kind, detail, at, False, job)], "id int, failure_type string, detail string, timestamp bigint, resolved boolean, jobId int")
    return failures.unionByName(row)


def enum_value(c: Column, values: dict[str, str]) -> Column:
    """The value of an enumeration that a text names, by value or by name; null for any other text."""
    names = F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
    return F.when(c.isin(*values.values()), c).otherwise(F.try_element_at(names, c))


def sanitised(df: DataFrame, numbers: list[str] = (), integers: list[str] = (), nested: list[str] = ()) -> DataFrame:
    """df ready to be written: ``numbers`` as doubles and ``integers`` as longs, null where they are none (or NaN), ``nested`` as JSON."""
    as_number = lambda c: F.nanvl(F.col(c).try_cast("double"), F.lit(None).cast("double"))
    made = {c: as_number(c) for c in numbers} | {c: as_number(c).try_cast("bigint") for c in integers} | {c: F.to_json(c) for c in nested}
    return df.withColumns({c: x for c, x in made.items() if c in df.columns})


def headlines_to_articles(articles: DataFrame, clusters: DataFrame) -> DataFrame:
    """articles with headline, summary and question of their cluster, where it has any of the three. ``clusters``: one row for each."""
    fields = ("headline", "summary", "question")
    said = clusters.filter(F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in fields]).isNotNull()).select("cluster_id", *fields)
    return articles.drop(*fields).join(said, "cluster_id", "left")
