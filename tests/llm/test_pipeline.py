import random
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from storyloom.llm import queries

DATA = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    docs = docs.withColumns({"score": F.lit("own"), "size": F.lit(1)})  # names that operators use
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, DATA).cache()
        ids = {r.doc_id for r in before.select("doc_id").collect()}
        assert {r.doc_id for r in after.select("doc_id").collect()} <= ids
        if name != "pieces":
            assert after.columns == before.columns
        if name == "language":
            assert after.count() == before.count()  # all are in a known language
        if name == "simhash":
            from storyloom.llm.simhash import near_duplicates

            groups = {r.component_id for r in near_duplicates(before).collect()}
            assert {r.doc_id for r in after.collect()} == groups
        if name == "mixing":
            assert max(Counter(r.doc_id for r in after.collect()).values()) <= 2
        if name == "pieces":
            assert after.filter("not restored").count() == 0 and after.count() == before.count()
        before = after


def test_stages_with_nothing(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").filter("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, DATA)
        assert docs.count() == 0


def plain(v):
    return repr(round(v, 6) + 0.0) if isinstance(v, float) else repr(v)


@pytest.mark.parametrize("name", queries.ORACLE_SQL)
def test_sql(spark, name):
    c = duckdb.connect()
    for t in "documents embeddings labels pages".split():
        c.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    df = queries.QUERIES[name](spark, DATA)
    got = c.sql(queries.ORACLE_SQL[name])
    columns = sorted(df.columns)
    assert columns == sorted(got.columns)
    at = [got.columns.index(x) for x in columns]
    assert sorted(tuple(plain(r[x]) for x in columns) for r in df.collect()) == sorted(tuple(plain(r[i]) for i in at) for r in got.fetchall())


def test_run_on_odd_rows_and_a_hot_group(spark, tmp_path):
    """Nulls in every column, repeated rows, ties, a very long text, a group of copies, a toxic text, and columns with operators' names."""
    real = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang", "source").collect()
    english = next(r.text for r in real if r.lang == "en" and len(r.text) > 1500)
    words = english.split()
    long = " ".join(words[::-1] * 40)
    random.Random(1).shuffle(words)
    hot = " ".join(words)
    rows = [tuple(r) for r in real]
    rows += [(10_000 + i, hot, "en", ["hot", None][i % 2]) for i in range(400)]
    rows += [(20_000, None, None, None), (20_001, "", "en", "s"), (None, "a null id and a few plain words", None, "s"), (20_002, long, None, "s"), (20_002, long, None, "s"), (20_003, "12 34 ...", "en", "s")]
    names = ("taken", "fp", "size", "score", "node", "id_", "t_", "g_", "m", "n_chars")
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumns({c: F.lit("own") for c in names})
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{DATA}/labels.parquet").unionByName(spark.createDataFrame([(None, 1, 1), (1, None, None)], "doc_id long, quality int, toxic int"), allowMissingColumns=True).write.parquet(f"{tmp_path}/labels.parquet")
    before, stages = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        before = stages[name] = stage(spark, before, str(tmp_path)).cache()
        if name != "pieces":
            assert before.columns == docs.columns and before.filter("taken != 'own' or n_chars != 'own'").count() == 0
    ids = {n: Counter(r.doc_id for r in s.select("doc_id").collect()) for n, s in stages.items()}
    assert sum(i in ids["toxicity"] for i in range(10_000, 10_400)) == 400  # clean
    assert not {20_000, 20_001, 20_003} & {*ids["language"]}  # no letters, no language
    assert sum(i in ids["language"] for i in range(10_000, 10_400)) == 400
    assert [i for i in ids["simhash"] if i and 10_000 <= i < 10_400] == [10_000] and ids["simhash"][20_002] == 2
    assert max(n for i, n in ids["mixing"].items() if i != 20_002) <= 2
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert Counter(r.doc_id for r in got.collect()) == ids["pieces"] == ids["mixing"]
    assert got.filter("not restored").count() == 0
