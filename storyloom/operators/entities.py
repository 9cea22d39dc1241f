"""Entity counts of articles and clusters; the tagger is an adapter with an offline stand-in.

A null or empty content has no entities. Repeated articles count as often as they occur.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LABELS = ("PERSON", "ORG", "GPE", "LOC")


def tagged(articles: DataFrame, pattern: str = "([A-Z][a-z]{3,})") -> DataFrame:
    """(id, pos, text, label): capitalised words, a stand-in for a named-entity model. The label follows from the length."""
    found = articles.select("id", F.posexplode_outer(F.regexp_extract_all(F.coalesce("content", F.lit("")), F.lit(pattern), F.lit(1))).alias("pos", "surface")).filter("surface is not null")
    label = F.element_at(F.array(*map(F.lit, LABELS)), F.length("surface") % 4 + 1)
    return found.select("id", "pos", F.lower(F.trim("surface")).alias("text"), label.alias("label"))


def clean(entities: DataFrame) -> DataFrame:
    """Without other labels, single characters and plain numbers."""
    return entities.filter(F.col("label").isin(*LABELS) & (F.length("text") > 1) & ~F.col("text").rlike(r"^\p{Nd}+$"))


def counts(entities: DataFrame, keys: list[str]) -> DataFrame:
    return clean(entities).groupBy(*keys, "text", "label").agg(F.count("*").alias("count"), F.min("pos").alias("first"))


def top(counted: DataFrame, keys: list[str], k: int = 10) -> DataFrame:
    """The k most frequent (text, label) of each key, then by text and label."""
    by = Window.partitionBy(*keys).orderBy(F.desc("count"), "text", "label")
    return counted.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)
