"""Corpus pipeline: toxicity, language ID, near-duplicates, mixing, pieces.

Each stage takes (spark, docs, sf_dir). All but the last return the columns of ``documents``; the
mix repeats a row as often as it takes the document. Rows that repeat an id are one document: they
stay or go together. A row with a null id can be rejected for its text but not as a duplicate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.llm import language, mixing, pieces, simhash, toxicity
from storyloom.llm.queries import PIECES_MODEL
from storyloom.llm.util import numbered, stored, table

#: A text is rejected if its language is unknown, or known with less than this probability.
LEAST_LANGUAGE_SCORE = 0.35


def _at(docs: DataFrame, name: str) -> str:
    return f"c{docs.columns.index(name)}"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    own = numbered(docs)
    scored = toxicity.score(own, model, own.columns, _at(docs, "text"))
    return scored.filter(F.col("score") < toxicity.THRESHOLD).select(own.columns).toDF(*docs.columns)


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    own = numbered(docs)
    found = language.predict(own, language.fit(docs), own.columns, _at(docs, "text"))
    sure = (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SCORE)
    return found.filter(sure).select(own.columns).toDF(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    linked = simhash.near_duplicates(docs)
    extra = linked.filter("doc_id != component_id").select("doc_id").distinct()
    return docs.join(extra, "doc_id", "left_anti").select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    own = numbered(docs)
    got = mixing.mix_sources(own, _at(docs, "doc_id"), _at(docs, "text"), _at(docs, "source"), own.columns)
    times = F.ceil(F.col("taken") / F.nullif(F.col("size"), F.lit(0))).cast("int")
    taken = got.withColumn("times", times).filter("times > 0")
    return taken.select(*own.columns, F.explode(F.sequence(F.lit(1), "times"))).select(own.columns).toDF(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode(docs, PIECES_MODEL, ["doc_id", "lang", "source"], decoded=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("language", keep_known_languages),
    ("simhash", drop_near_duplicates),
    ("mixing", mix),
    ("pieces", encode),
]
#: Two stages use trained models and one XXH64, so there is no SQL for the whole.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
