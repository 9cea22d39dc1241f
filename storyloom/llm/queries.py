"""The registered queries of the ten operators: thin, with production parameters."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collisions, language, licences, media, mixing, oracle, pieces, sharding, simhash, toxicity, urls
from .util import held_out, stored, table


#: The tokenizer's file; it is read where it lies and never copied here.
PIECES_MODEL = os.environ.get("PIECES_MODEL", "/opt/tokenizers/piece_bpe_32k.model")


def op1_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"), PIECES_MODEL, ["doc_id"])


def op2_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = stored(media.encode_media(table(spark, sf_dir, "documents"), ["doc_id"]), compression="zstd")
    return media.decode_media(files, ["doc_id", "n_bytes"])


def op3_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"), ["doc_id"])


def op4_kdtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard_documents(table(spark, sf_dir, "documents"))
    return out.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")}).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.predict(docs, language.fit(docs), ["doc_id"])
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collisions.links(table(spark, sf_dir, "embeddings"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, ["doc_id"])
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"), "spans")


QUERIES = {
    "op1_pieces": op1_pieces,
    "op2_media": op2_media,
    "op3_licences": op3_licences,
    "op4_kdtree": op4_kdtree,
    "op5_language": op5_language,
    "op6_mixing": op6_mixing,
    "op7_collisions": op7_collisions,
    "op8_simhash": op8_simhash,
    "op9_urls": op9_urls,
    "op10_toxicity": op10_toxicity,
}
#: The other queries use trained models, XXH64, a tokenizer, a file format or a tree of medians: they are tested by brute force.
ORACLE_SQL = oracle.ORACLE_SQL
