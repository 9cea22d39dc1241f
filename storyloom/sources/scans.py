"""Scans: the article model over the driver's tables, recent and unclustered rows, other formats."""

from __future__ import annotations

import contextlib
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Params


def load_pairs(name: str) -> tuple[tuple[str, str], ...]:
    """The lines ``key: values`` of a table in ``data``, in order."""
    lines = (Path(__file__).parent.parent / "data" / name).read_text("utf-8").splitlines()
    return tuple(tuple(line.split(": ", 1)) for line in lines if line and not line.startswith("#"))


#: (outlet, region), and (topic, description).
OUTLETS = tuple((o, region) for region, outlets in load_pairs("media_regions.txt") for o in outlets.split())
TOPICS = load_pairs("topics.txt")


#: Articles of an Arrow batch: texts can be long, and a Python worker holds a batch with all that is made of it.
BATCH_ROWS = 512
#: And its bytes, where this Spark has that limit.
BATCH_BYTES = 8 << 20


def published(doc_id: Column) -> Column:
    """A date for documents that have none: a fixed formula of the id, within 30 days."""
    return (F.lit(1704067200) + (doc_id * 7919) % 2592000).cast("bigint")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, title, content, media_name, published_at, origin, cluster_id (null: not clustered) of the documents."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    with contextlib.suppress(Exception):
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    origin = F.when(F.col("doc_id") % 7 == 0, "native").when(F.col("doc_id") % 7 == 1, " Original ").otherwise(F.col("source"))
    return d.select(
        F.col("doc_id").alias("id"), F.substring_index("text", "\n", 1).alias("title"), F.col("text").alias("content"), F.col("source").alias("media_name"),
        published(F.col("doc_id")).alias("published_at"), origin.alias("origin"), F.when(F.col("doc_id") % 3 != 0, F.col("doc_id") % 10).alias("cluster_id"),
    )


def outlet(c: Column) -> Column:
    """The outlet that a numbered source stands for; null without a number."""
    return F.get(F.array(*[F.lit(o) for o, _ in OUTLETS]), F.regexp_extract(c, r"(\d+)$", 1).try_cast("int") * 7 % len(OUTLETS))


def media(spark: SparkSession) -> DataFrame:
    """The outlets' dimension: outlet, region."""
    return spark.createDataFrame(OUTLETS, "outlet string, region string")


def topics(spark: SparkSession) -> DataFrame:
    """The topics' dimension: pos, topic, description."""
    return spark.createDataFrame([(i, *t) for i, t in enumerate(TOPICS)], "pos int, topic string, description string")


def media_region(c: Column) -> Column:
    """The region of a source's outlet, without a join."""
    return F.get(F.array(*[F.lit(r) for _, r in OUTLETS]), F.regexp_extract(c, r"(\d+)$", 1).try_cast("int") * 7 % len(OUTLETS))


def unclustered(rows: DataFrame, newest_first: bool = True, p: Params = Params()) -> DataFrame:
    """The articles to be clustered next, up to the sample size; those without content, title or date never."""
    order = F.desc_nulls_last("published_at") if newest_first else F.asc_nulls_last("published_at")
    fit = F.col("cluster_id").isNull() & F.col("content").isNotNull() & F.col("title").isNotNull() & F.col("published_at").isNotNull()
    return rows.filter(fit).orderBy(order, "id").limit(p.sample_size)


def recent(rows: DataFrame, newest_first: bool = True, p: Params = Params()) -> DataFrame:
    """The corpus for copy-paste detection, up to the sample size."""
    order = F.desc_nulls_last("published_at") if newest_first else F.asc_nulls_last("published_at")
    return rows.filter("content is not null and published_at is not null").orderBy(order, "id").limit(p.sample_size)


def unclustered_english(rows: DataFrame, p: Params = Params()) -> DataFrame:
    """The same for the bilingual job: oldest first, English content asked for (``content_en``), no title."""
    fit = F.col("cluster_id").isNull() & F.col("content_en").isNotNull() & F.col("published_at").isNotNull()
    return rows.filter(fit).orderBy(F.asc_nulls_last("published_at"), "id").limit(p.sample_size)


def recent_clusters(clusters: DataFrame, p: Params = Params()) -> DataFrame:
    return clusters.filter(F.col("latest_published") >= p.now - p.cluster_history_days * 86_400)


def headlines_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, multiLine=True, escape='"', schema="cluster_id string, headline string, summary string")


def jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A database table; filters, columns and top-n are pushed down. Pass partitionColumn and bounds for parallel reads."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
