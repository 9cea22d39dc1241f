"""Online attachment against a plain loop, models, report, stored values."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from storyloom.sources import scans
from storyloom.config import Params
from storyloom.functions import hover, jsons, places, text, times, vector
from storyloom.operators import attach, models, online, store
from storyloom.report import page
from storyloom.streaming import online as streams

KINDS = "id long, vec array<double>, ents array<struct<text:string,label:string,count:bigint>>, places array<string>, region string, published_at long, shard string"


def articles(n, seed=0):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(6, 5))
    rows = []
    for i in range(n):
        ents = [(f"e{k}", ["ORG", "GPE"][k % 2], int(rng.integers(1, 4))) for k in rng.choice(14, rng.integers(0, 6), replace=False).tolist()]
        named = [["台灣", "日本", "美國"][k] for k in rng.integers(0, 3, rng.integers(0, 4))]
        rows.append((i, (base[rng.integers(0, 6)] + rng.normal(size=5) * 0.4).tolist(), ents, named, [None, "香港", "台灣"][i % 3], int(rng.integers(0, 2_000_000)), "ab"[i % 2]))
    rows += [(n, None, None, None, None, 5, "a"), (n + 1, [0.0] * 5, [], [], "x", None, "a"), (n + 2, [1.0] * 3, None, [None], "x", 1_000_001, "b"), (n + 3, rows[0][1], None, None, None, None, "a"), (n + 3, rows[0][1], None, None, None, None, "a")]
    return rows


def jaccard(a, b):
    return len(a & b) / len(a | b) if a and b else 0.0


def plain_loop(rows, p, stories=None, newest_first=False):
    """The same by dictionaries and sums over members."""
    stories, out = stories or [], []
    width = len(stories[0]["c"]) if stories else None
    for i, v, ents, named, region, at, _ in sorted(rows, key=lambda r: ((r[5] or 0) * (-1 if newest_first else 1), r[0])):
        at, ents, named = at or 0, ents or [], [q for q in named or [] if q]
        if not v or not all(map(math.isfinite, v)) or not any(v) or (width and len(v) != width):
            continue
        width = width or len(v)
        scored = []
        for k, s in enumerate(stories):
            sim = sum(a * b for a, b in zip(v, s["c"])) / math.sqrt(sum(a * a for a in v)) / math.sqrt(sum(a * a for a in s["c"]))
            scored.append((-sim, k))
        best = None
        for sim, k in sorted(scored)[: p.top_k_attach]:
            s = stories[k]
            known = {q for q, _ in s["places"].items()} or set(s["regions"]) or (s["loaded"] if s["loaded"] is not None else {"台灣"})
            score = -sim + p.alpha_ent * jaccard({t for t, _, _ in ents}, s["texts"]) + p.alpha_place * jaccard(set(named), known) + (p.time_bonus if abs(at - s["latest"]) <= p.time_window_days * 86400 else 0)
            if best is None or score > best[0]:
                best = score, k
        counted = Counter({(t, label): n for t, label, n in ents})
        if best and best[0] >= p.assign_thresh:
            s = stories[best[1]]
            s["c"] = [(a * s["n"] + b) / (s["n"] + 1) for a, b in zip(s["c"], v)]
            s["latest"] = max(s["latest"], at)
            s["ents"].update(counted)
            s["texts"] = {t for (t, _), _ in s["ents"].most_common(10)}
        else:
            s = {"name": i, "c": list(v), "n": 0, "latest": at, "ents": counted, "texts": {t for t, _, _ in ents}, "places": Counter(), "regions": Counter(), "loaded": None}
            stories.append(s)
        s["n"] += 1
        s["places"].update(named)
        if region:
            s["regions"][region] += 1
        detail = [q for q, _ in s["places"].most_common()] or [q for q, _ in s["regions"].most_common()] or ["台灣"]
        out.append((i, s["name"], s["n"], round(best[0], 9) if best else None, detail, [t for (t, _), _ in s["ents"].most_common(10)]))
    return out


def told(rows):
    return sorted((r.id, r.cluster_id, r.cluster_size, None if r.attach_combined is None else round(r.attach_combined, 9), list(r.places_in_concern), [e.text for e in r.top_entities]) for r in rows)


@pytest.mark.parametrize("newest_first", [False, True])
def test_online_attach_equals_a_plain_loop(spark, newest_first):
    rows, p = articles(90), Params(assign_thresh=0.95, top_k_attach=4)
    df = spark.createDataFrame(rows, KINDS).withColumn("cluster_id", F.lit("clash"))
    got = online.online_attach(df, "shard", topics=[("t1", [1.0, 0, 0, 0, 0]), ("t2", [0.9, 0.1, 0, 0, 0])], p=p, newest_first=newest_first).collect()
    assert told(got) == sorted(x for s in "ab" for x in plain_loop([r for r in rows if r[6] == s], p, newest_first=newest_first))
    assert {r.opened for r in got} == {True, False} and all(r.attached_existing != r.opened for r in got)
    assert {r.main_topic for r in got} <= {"t1", "t2"} and all(r.ambiguous for r in got if r.secondary_topic and r.main_topic_score - r.secondary_topic_score < 0.04)
    assert online.online_attach(df.filter("false"), "shard").count() == 0


def test_online_attach_to_stored_stories(spark):
    rows, p = articles(40, 3), Params(assign_thresh=0.9)
    stored = [(100, rows[0][1], 3, 1000, [("e1", "ORG", 9)], ["日本"], "a"), (101, rows[3][1], None, None, None, None, "b"), (102, None, 1, 5, [], [], "a")]
    base = spark.createDataFrame(stored, "cluster_id long, centroid array<double>, size long, latest_published long, top_entities array<struct<text:string,label:string,count:bigint>>, places_in_concern array<string>, shard string")
    got = online.online_attach(spark.createDataFrame(rows, KINDS), "shard", base, p=p).collect()
    want = []
    for s in "ab":
        loaded = [{"name": i, "c": list(c), "n": n or 1, "latest": at or 0, "ents": Counter({(t, label): k for t, label, k in e or []}), "texts": {t for t, _, _ in e or []}, "places": Counter(), "regions": Counter(), "loaded": set(q or [])} for i, c, n, at, e, q, x in stored if x == s and c]
        want += plain_loop([r for r in rows if r[6] == s], p, loaded)
    assert told(got) == sorted(want) and {100, 101} <= {r.cluster_id for r in got}


def test_attach_arrivals(spark, tmp_path):
    rows, p = articles(30, 5), Params(assign_thresh=0.9)
    rows = sorted((r for r in rows if r[5]), key=lambda r: r[5])
    for part in (rows[:15], rows[15:]):
        spark.createDataFrame(part, KINDS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = streams.attach_arrivals(spark.readStream.schema(KINDS).parquet(f"{tmp_path}/in"), "shard", p=p)
        stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination(120)
    got = spark.read.parquet(f"{tmp_path}/out").collect()
    assert told(got) == told(online.online_attach(spark.createDataFrame(rows, KINDS), "shard", p=p).collect())


def test_top_clusters_in_blocks(spark, monkeypatch):
    rng = np.random.default_rng(2)
    a = [(i, rng.normal(size=4).tolist()) for i in range(40)] + [(40, None), (41, [0.0] * 4), (42, [1.0, 2.0])]
    c = [(100 - i, rng.normal(size=4).tolist()) for i in range(30)] + [(200, [float("nan")] * 4), (201, [2.0, 4.0])]
    c += [(k + 300, v) for k, v in c[:5]]  # ties
    a, c = spark.createDataFrame(a, "id long, vec array<double>"), spark.createDataFrame(c, "cluster_id long, centroid array<double>")
    p = Params(top_k_attach=6)
    sent = sorted((r.id, r["rank"], r.cluster_id, round(r.sim, 9)) for r in attach.top_clusters(a, c, p).collect())
    monkeypatch.setattr(attach, "BROADCAST_ROWS", 7)
    monkeypatch.setattr(attach, "MET_ROWS", 9)
    assert sorted((r.id, r["rank"], r.cluster_id, round(r.sim, 9)) for r in attach.top_clusters(a, c, p).collect()) == sent
    assert [x for x in sent if x[0] == 42] == [(42, 1, 201, 1.0)] and len(sent) == 241
    monkeypatch.undo()
    assert attach.top_clusters(a, c.filter("false"), p).count() == 0 and attach.top_clusters(a.filter("false"), c, p).count() == 0


def test_means_of_odd_vectors(spark):
    rows = [("a", [1.0, 2.0]), ("a", [3.0, None]), ("a", [5.0]), (None, [1.0]), ("b", None), ("b", [])] * 2
    df = spark.createDataFrame(rows, "k string, v array<double>")
    got = {r.k: (r.centroid, r.n) for r in vector.mean(df, ["k"], "v").collect()}
    assert got == {"a": ([3.0, 2.0], 6), None: ([1.0], 2)}
    assert vector.mean(df.filter("false"), ["k"], "v").count() == 0


def test_models(spark):
    long = "一二三四五六七八九十。" * 60
    df = spark.createDataFrame([(1, long), (2, ""), (3, None), (4, "abc def"), (4, "abc def")], "id long, t string")
    got = {r.id: r.v for r in df.select("id", models.embedding(F.col("t")).alias("v")).collect()}
    parts = models.hashed_ngrams(text.chunk_by_chars(long))
    mean = parts.mean(0)
    assert len(parts) > 1 and np.allclose(got[1], mean / np.linalg.norm(mean)) and got[2] is None and got[3] is None
    out = {r.id: r.x for r in df.select("id", models.translated(F.col("t"), models.upper).alias("x")).collect()}
    assert out[4] == "ABC DEF" and out[2] == "" and out[3] is None
    tags = models.tagged(df.withColumnRenamed("t", "content"), lambda ts: [[("Ａ ", "GPE")] if t else [] for t in ts])
    assert {(r.id, r.pos, r.text, r.label) for r in tags.collect()} == {(1, 0, "a", "GPE"), (4, 0, "a", "GPE")}

    def fails(t):
        if "bad" in t:
            raise RuntimeError("no answer")
        return '```json\n{"headline": h, "summary": "s",}\n```'

    stories = spark.createDataFrame([(1, "good"), (2, "bad"), (3, None)], "cluster_id long, articles string")
    got = {r.cluster_id: tuple(r)[1:] for r in models.headlines(stories, fails).collect()}
    assert got == {1: (True, "h", "s", None, None), 2: (False, None, None, None, "RuntimeError: no answer"), 3: (True, "h", "s", None, None)}
    central = spark.createDataFrame([(1, 4, 2), (1, 1, 1)], "cluster_id long, id long, rank int")
    told_ = models.story_texts(central, df.select("id", F.lit(" T ").alias("title"), F.col("t").alias("content")).distinct()).first().articles
    assert told_ == f"【標題】T\n【內文】{long}"[:2000] + "\n\n【標題】T\n【內文】abc def"


def test_hover_texts(spark):
    kinds = f"p {hover.PLACES}, c array<string>, o struct<id:string,media_name:string,hamming:int,jaccard:double,delta_secs:bigint,published_at:bigint>, m array<struct<id:string,media_name:string,hamming:int,jaccard:double,published_at:bigint>>, j string"
    many = [(f"地{i}", i, "ENTITIES") for i in range(8)]
    o = ("0123456789abcdef", "m", 2, 0.95, 60, 1704067200)
    rows = [(many, ["a"] * 10, o, [o[:4] + (0,)] * 7, '[{"name": " x ", "count": 2}, {"place": "y"}]'), (None,) * 5, ([("z", None, None)], [], (None, "", None, None, None, None), [], "word " * 30)]
    df = spark.createDataFrame(rows, kinds)
    got = df.select(hover.places(F.col("p")), hover.concern(F.col("c")), hover.origin(F.col("o")), hover.matches(F.col("m")), hover.stored_places(F.col("j"))).collect()
    a, b, c = map(tuple, got)
    assert a[0].split("<br>")[0] == "• 地0, frequency: 0, place_source: ENTITIES" and a[0].endswith("<br>+2 more") and a[0].count("<br>") == 6
    assert a[1].count("<br>") == 8 and a[1].endswith("+2 more")
    assert a[2] == "m • id=0123456789ab • H=2 • J=0.950 • Δs=60 • 2024-01-01 00:00:00 UTC"
    assert a[3].split("<br>")[0] == "• m (id=0123456789), H=2, J=0.950" and a[3].endswith("+1 more")
    assert a[4] == "• x, frequency: 2<br>• y"
    assert b == ("",) * 5 and c[:4] == ("• z", "", "", "") and all(len(x) <= 60 for x in c[4].split("<br>"))


def test_report_page(spark, tmp_path):
    df = spark.createDataFrame([(1, 2, 5, "<t>", "m", None, 0.12345, "http://a?b=1&c=2"), (2, 1, 9, None, "m", "x", None, "javascript:1")], "id long, cluster_id long, published_at long, title string, media_name string, main_topic string, attach_sim double, url string")
    made = page.page("R & D", df, most=1)
    assert "&lt;t&gt;" not in made and "only 1 rows are shown" in made and "R &amp; D" in made and "x 1<" in made
    table = page.html_table(page.articles_table(df))
    assert table.index("<td>2</td>") < table.index("&lt;t&gt;") and '<a href="http://a?b=1&amp;c=2"' in table and '"javascript' not in table and "0.123<" in table
    assert page.ordered_columns(["x", "id", "title", "cluster_id"]) == ["cluster_id", "title", "id"]
    assert page.publish(spark, made, f"file://{tmp_path}/r.html") and (tmp_path / "r.html").read_text() == made
    assert page.publish(spark, made, "nosuchstore://x/y") is None
    points = spark.createDataFrame([("a", 1.0, 2.0, "<x>"), ("b", None, 1.0, "y")], "cluster string, x double, y double, title string")
    svg = page.svg_points(points.collect())
    assert svg.count("<circle") == 1 and "&lt;x&gt;" in svg


def test_stored_values(spark):
    df = spark.createDataFrame([("1704067200123",), ("1704067200",), ("2024-01-01 00:00:00",), ("2024-01-01T08:00:00+08:00",), ("x",), (None,)], "t string")
    assert [r[0] for r in df.select(times.moment(F.col("t"))).collect()] == [1704067200] * 4 + [None] * 2
    assert df.limit(1).select(times.wall_clock(F.lit("2024-01-01 08:00:00"))).first()[0] == 1704067200
    raw = spark.createDataFrame([("[{'text': 'A', 'label': 'GPE', 'count': 2}, {'text': 'b'}]",), ("[('X', 'ORG'), ('y', None)]",), ('[["Q", "LOC"]]',), ("broken",), (None,)], "t string")
    assert [[tuple(e) for e in r[0]] for r in raw.select(jsons.labelled(F.col("t"))).collect()] == [[("a", "GPE", 2)], [("x", "ORG", None)], [("q", "LOC", None)], [], []]
    named = spark.createDataFrame([(1, "Ｈ Ｋ"), (2, "台 北"), (3, None), (4, "刚果（金）"), (5, "?")], "id long, raw string")
    assert {r.id: r.place for r in places.canonicalized(named, "raw").collect()} == {1: "香港", 2: "台北市", 3: None, 4: "剛果民主共和國", 5: None}
    vectors = spark.createDataFrame([("[1.0, 2]",), ("[1, x]",), ("no",), (None,), ("[null]",)], "t string")
    assert [r[0] for r in vectors.select(vector.stored_vector(F.col("t"))).collect()] == [[1.0, 2.0], None, None, None, None]
    enum = {"A_B": "a", "C": "c"}
    values = spark.createDataFrame([("a",), ("A_B",), ("zz",), (None,)], "t string")
    assert [r[0] for r in values.select(store.enum_value(F.col("t"), enum)).collect()] == ["a", "a", None, None]


def test_json_scanner():
    want = {"headline": "h, with a comma", "summary": "s", "question": None}
    for raw in ('{"headline": h, with a comma, "summary": "s"}', '{"headline": "h, with a comma" "summary": s', 'Sure! {"headline": "h, with a comma", "summary": s,\n"question": null,}'):
        assert jsons.repair(raw) == want
    assert jsons.repair('{"other": 1, "summary": ["x"]}')["summary"] == "['x']"


def test_merges_with_odd_rows(spark):
    base = spark.createDataFrame([(1, "a", 1)], "id long, x string, y int")
    patch = spark.createDataFrame([(1, "b", None), (1, "c", 2), (None, "z", 9), (2, None, None)], "id long, x string, y int")
    assert sorted(store.upsert(base, patch, "id", ["x", "y"]).collect()) == [(1, "c", 2), (2, None, None)]
    kinds = "cluster_id long, article_count long, latest_published long, centroid array<double>, top_entities array<struct<text:string,label:string,count:bigint>>, main_topic string, main_topic_score double, secondary_topic string, secondary_topic_score double, ambiguous boolean, places_in_concern array<string>, places_in_detail array<struct<place:string,frequency:bigint,place_source:string>>"
    old = spark.createDataFrame([(1, 2, 10, [1.0], [("a", "ORG", 2), ("b", None, 5)], "t", 0.5, "u", 0.4, True, ["日本"], None), (2, None, None, None, None, *[None] * 7)], kinds)
    new = spark.createDataFrame([(1, 2, 5, [3.0], [("a", "ORG", 4), ("a", "GPE", 1)], None, 0.9, None, None, False, ["越南"], [("越南", 1, "x"), ("香港", 2, "y")]), (3, 1, 7, None, None, "n", 0.1, None, 0.0, None, None, None)], kinds)
    got = {r.cluster_id: r for r in store.merge_cluster_facts(old, new, k=2).collect()}
    r = got[1]
    assert (r.article_count, r.latest_published, r.centroid, r.main_topic, r.main_topic_score, r.secondary_topic, r.ambiguous) == (4, 10, [2.0], "t", 0.5, "u", False)
    assert [tuple(e) for e in r.top_entities] == [("a", "ORG", 6), ("b", None, 5)] and r.places_in_concern == ["日本"] and [tuple(x) for x in r.places_in_detail] == [("香港", 2, "y")]
    assert (got[2].article_count, got[2].latest_published) == (0, 0) and (got[3].article_count, got[3].main_topic) == (1, "n")
    assert store.merge_cluster_facts(old.filter("false"), new.filter("false")).count() == 0


def test_merge_of_long_entity_lists(spark):
    """Lists of 20,000 names are summed up by rows: searching the list for each of its names took 400 million steps."""
    n = 20_000
    kind = "article_count long, latest_published long, centroid array<double>, main_topic string, main_topic_score double, secondary_topic string, secondary_topic_score double, ambiguous boolean, places_in_concern array<string>, places_in_detail array<struct<place:string,frequency:bigint,place_source:string>>"
    rest = (1, 1, [1.0], None, None, None, None, None, None, None)
    old, new = (spark.createDataFrame([(1, *rest), (None, *rest)], f"cluster_id long, {kind}").crossJoin(spark.range(n).selectExpr(f"collect_list(struct(concat('e', id) as text, 'ORG' as label, {c} as count)) as top_entities")) for c in ("id", "20000 - id + if(id = 7, 5, 0)"))
    plan = store.merge_cluster_facts(old, new, k=2)
    assert "array_distinct" not in plan.select("top_entities")._jdf.queryExecution().optimizedPlan().toString()
    got = sorted(((r.cluster_id is None, [(e["text"], e["count"]) for e in r.top_entities]) for r in plan.collect()), key=repr)
    assert got == [(False, [("e7", 20005), ("e0", 20000)]), (True, [("e0", 20000), ("e1", 19999)]), (True, [("e19999", 19999), ("e19998", 19998)])]


def test_batches_of_articles_are_small(spark, tmp_path):
    spark.range(3000).selectExpr("id as doc_id", "'t' as text", "'en' as lang", "'s1' as source", "1L as n_chars").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    size = F.pandas_udf(lambda t: t.map(lambda _: len(t)), "long", F.PandasUDFType.SCALAR)
    assert scans.articles(spark, str(tmp_path)).select(size("content").alias("n")).agg(F.max("n")).first()[0] <= scans.BATCH_ROWS


def test_stories_hold_names_once():
    """a story of 200 names, each a long text shared with others, takes some kB, not tens of them."""
    import tracemalloc

    rng = np.random.default_rng(0)
    names = [f"name {k} " * 20 for k in range(400)]
    state = online.Stories(Params(assign_thresh=9.0))
    tracemalloc.start()
    for i in range(600):
        own = rng.choice(400, 200, replace=False).tolist()
        state.add(online.Article(i, rng.normal(size=8), [("".join([names[k], ""]), "ORG", 1) for k in own], [f"p{k}" for k in own[:40]], "r", i))
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert len(state.stories) == 600 and held / 600 < 8_000


def test_online_attach_holds_no_shard_as_rows(spark):
    """a shard of 1,500 articles comes in batches, in order."""
    rows = [(i, [1.0, float(i % 7)], [("e", "ORG", 1)], ["日本"], None, (i * 37) % 1000, "a") for i in range(1500)]
    plan = online.online_attach(spark.createDataFrame(rows, KINDS), "shard")
    assert "InPandas" not in plan._jdf.queryExecution().optimizedPlan().toString()
    assert told(plan.collect()) == sorted(plain_loop(rows, Params()))


def test_embeddings_are_made_once(spark, tmp_path):
    """a filter on the vectors had all texts embedded twice; grams are hashed once in a worker, not at every place."""
    import hashlib

    from storyloom.plans import details

    def plain(t, n=3, d=64):
        out = np.zeros(d)
        for k in range(len(t) - n + 1):
            h = int.from_bytes(hashlib.blake2b(t[k : k + n].encode(), digest_size=8).digest(), "little")
            out[h % d] += 1 if h >> 63 else -1
        return out / max(np.sqrt((out * out).sum()), 1e-12)

    ts = ["The quick\tfox " * 50, "ab", "", "中文 abc 中文 abc", "\x00\x7f~ é", "aaaa"]
    assert all((a == plain(t)).all() for a, t in zip(models.hashed_ngrams(ts), ts)) and (models.hashed_ngrams(ts, 5)[0] == plain(ts[0], 5)).all()
    hashed = []
    real, models.hashlib = models.hashlib, type("Seen", (), {"blake2b": staticmethod(lambda x, **k: hashed.append(x) or hashlib.blake2b(x, **k))})
    try:
        models.hashed_ngrams(["xyzzy plugh " * 1000] * 3)
    finally:
        models.hashlib = real
    assert len(hashed) <= 12
    spark.createDataFrame([(1, "Some text. More of it.", "s1"), (2, None, "s1"), (3, "", "s2"), (4, "a", "s2")], "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = details.article_embeddings(spark, str(tmp_path))
    assert got._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert sorted(r.id for r in got.collect()) == [1] * 64 + [4] * 64  # "a" is title and content: three characters


def test_expanded_places_by_names(spark):
    """rules are tried once for each name, not on every article's text; the places are those of the text."""
    from storyloom.plans.queries import NAMES

    rng = np.random.default_rng(4)
    own = [*NAMES[::9], "花東", "大台北地區", "EU", "PA", "x EU y", "台 北", "北部", "臺中"]
    rows = [(i, p, own[k]) for i in range(60) for p, k in enumerate(rng.integers(0, len(own), int(rng.integers(1, 9))).tolist())]
    df = spark.createDataFrame(rows, "id long, pos int, raw string")
    whole = df.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", "raw"))).alias("m"))
    want = {r.id: r.p for r in whole.select("id", places.expanded_places(F.slice("m.raw", 1, 1), F.array_join("m.raw", "，")).alias("p")).collect()}
    got = places.expanded_mentions(df, spark.createDataFrame([(n,) for n in set(own)], "raw string"))
    assert {r.id: r.places for r in got.collect()} == want and max(map(len, want.values())) > 5
