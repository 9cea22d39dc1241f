import hashlib
from collections import Counter

import numpy as np
import pytest

from storyloom.config import Params
from storyloom.functions import text
from storyloom.operators import attach, copypaste, store, stories
from storyloom.sources import scans

BODY = "abcdefghij klmnop qrstuv wxyz 0123456789 "


def brute_flags(rows, tie=60):
    out = {}
    for i, body, media, at, origin in rows:
        same = [(m, t, j) for j, b, m, t, _ in rows if j != i and b and b == body and m and m != media and t > 0]
        early = [x for x in same if x[1] <= at - tie]
        near = [x for x in same if abs(x[1] - at) <= tie]
        native = (origin or "").strip().lower() == "native"
        out[i] = ("earlier_cross_outlet", min((t, j) for _, t, j in early)[1]) if early else ("tie_origin_not_native", min((t, j) for _, t, j in near)[1]) if near and not native else ("original", None)
    return out


def test_copypaste_rule(spark):
    rows = [
        (1, BODY, "a", 1000, "x"), (2, BODY, "b", 1060, "x"), (3, BODY, "b", 1059, "x"), (4, BODY, "b", 1059, "native"), (5, BODY, "a", 5000, "x"),
        (6, "other text of some length 123", "c", 1000, "x"), (7, None, "c", 1000, None), (8, "", "d", 0, ""), (9, BODY, "e", 0, "x"), (10, BODY, None, 9000, "x"),
    ]
    df = spark.createDataFrame(rows, "id long, content string, media_name string, published_at long, origin string")
    got = {r.id: (r.copypaste_rule, r.origin_id) for r in copypaste.flags(df).collect()}
    assert got == brute_flags(rows)


def test_copypaste_of_many_copies(spark):
    rng = np.random.default_rng(0)
    rows = [(i, BODY if i % 2 else BODY[::-1], f"m{i % 5}", int(rng.integers(1, 400)), ["native", "x"][i % 3 == 0]) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, content string, media_name string, published_at long, origin string")
    got = {r.id: (r.copypaste_rule, r.origin_id) for r in copypaste.flags(df).collect()}
    assert got == brute_flags(rows)
    top = copypaste.top_matches(df).collect()
    by_text = {b: sorted((t, i) for i, x, _, t, _ in rows if x == b) for b in (BODY, BODY[::-1])}
    for i, body, *_ in rows:
        assert [r.match_id for r in sorted((r for r in top if r.id == i), key=lambda r: r.rank)] == [j for _, j in by_text[body] if j != i][:5]


def test_links_across_strata_and_blocks(spark, monkeypatch):
    """Texts of one vocabulary have near hashes whatever their sizes; links are those of all pairs, and only pairs that sketches let pass are verified."""
    monkeypatch.setattr(copypaste, "ROWS", 16)
    monkeypatch.setattr(copypaste, "CHARS", 4000)
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("abcde中"), 4)) for _ in range(12)]
    body = [list(rng.choice(words, int(rng.integers(5, 90)))) for _ in range(30)]
    for k in range(70):
        made = list(body[k % 30])
        made[int(rng.integers(len(made)))] = "xy" * (k % 3)
        body.append(made)
    texts = sorted({"".join(b) for b in body} | {"a" * 10, "a" * 11, "abc"})
    rows = [(i, t, "m", 1, "x") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "id long, content string, media_name string, published_at long, origin string")
    p = Params(zh_dup_min_j=0.8, zh_dup_max_hamming=6)
    own, made = copypaste.classes(df, p)
    got = {(r.a, r.b): (r.hamming, round(r.jaccard, 9)) for r in copypaste.linked_classes(made, p).collect() if r.a < r.b}
    h = [copypaste.simhash(t, 3, {}) for t in texts]
    g = [{t[i : i + 5] for i in range(len(t) - 4)} for t in texts]
    want = {}
    for a in range(len(texts)):
        for b in range(a + 1, len(texts)):
            d, j = ((h[a] ^ h[b]) & (1 << 64) - 1).bit_count(), len(g[a] & g[b]) / max(1, len(g[a] | g[b]))
            if d <= 6 and j >= 0.8 and min(len(texts[a]), len(texts[b])) >= 10:
                want[a, b] = (d, round(j, 9))
    assert got == want and len(want) > 20
    asked = own.filter("id % 10 = 0")
    some = {(r.a, r.b) for r in copypaste.linked_classes(made, p, asked).collect() if r.a < r.b}
    assert some == {x for x in want if x[0] % 10 == 0 or x[1] % 10 == 0}
    rare = "".join(map(chr, range(0x4E00, 0x9F00)))  # more characters than five of them fit one number
    assert [copypaste.shared(*copypaste.gram_sets([rare, rare[:100] + "a"], 5)), len(copypaste.gram_sets([rare], 5)[0])] == [96, len(rare) - 4]


def test_empty_inputs(spark):
    df = spark.createDataFrame([], "id long, content string, media_name string, published_at long, origin string")
    assert copypaste.flags(df).count() == 0
    assert copypaste.top_matches(df).count() == 0


def test_attach_thresholds(spark):
    a = spark.createDataFrame([(1, [1.0, 0.0], ["x"], ["p"], 1000), (2, [0.0, 1.0], None, None, 1000), (3, [0.0, 0.0], [], [], 0)], "id long, vec array<double>, ents array<string>, places array<string>, published_at long")
    c = spark.createDataFrame([(7, [1.0, 0.0], ["x"], ["p"], 1000 + 3 * 86400), (8, [0.6, 0.8], ["y"], [], 0)], "cluster_id long, centroid array<double>, ents array<string>, places array<string>, latest_published long")
    scored = attach.combined(attach.top_clusters(a, c), a, c)
    got = {(r.id, r.cluster_id): round(r.score, 6) for r in scored.collect()}
    assert got == {(1, 7): 1.37, (1, 8): 0.65, (2, 7): 0.05, (2, 8): 0.85}
    assert {(r.id, r.cluster_id, r.attached_existing) for r in attach.decide(scored, a).collect()} == {(1, 7, True), (2, 8, True), (3, 3, False)}
    assert not attach.decide(scored, a, Params(assign_thresh=0.86)).filter("id = 2").first().attached_existing


def test_topics(spark):
    t = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 1.0])], "label string, vec array<double>")
    i = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 1.0]), (3, None)], "id long, vec array<double>")
    got = {r.id: (r.main_topic, r.secondary_topic, r.ambiguous) for r in attach.topic_decision(i, attach.topic_candidates(i, t)).collect()}
    assert got == {1: ("a", None, False), 2: ("a", "b", True), 3: (None, None, True)}


def test_online_clusters_equal_a_plain_loop(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=4)], int(rng.integers(0, 50)), i % 2) for i in range(80)]
    df = spark.createDataFrame(rows, "id long, vec array<double>, published_at long, shard int")
    got = {r.id: r.cluster_id for r in stories.online_clusters(df, "shard", Params(assign_thresh=0.7)).collect()}
    want = {}
    for s in (0, 1):
        groups = []
        for i, v, _, _ in sorted((r for r in rows if r[3] == s), key=lambda r: (r[2], r[0])):
            v = np.array(v)
            sims = [float(np.mean(m, 0) @ v / np.linalg.norm(np.mean(m, 0)) / np.linalg.norm(v)) for _, m in groups]
            if sims and max(sims) >= 0.7:
                k = int(np.argmax(sims))
                groups[k][1].append(v)
                want[i] = groups[k][0]
            else:
                groups.append((i, [v]))
                want[i] = i
    assert got == want


def test_central_articles(spark):
    rows = [(1, 1, [1.0, 0.0], 0.99), (1, 2, [0.999, 0.01], 0.98), (1, 3, [0.0, 1.0], 0.5), (2, 4, [1.0, 1.0], 1.0)]
    df = spark.createDataFrame(rows, "cluster_id long, id long, vec array<double>, sim double")
    assert sorted((r.cluster_id, r.id, r.rank) for r in stories.central_articles(df).collect()) == [(1, 1, 1), (1, 3, 2), (2, 4, 1)]


def test_store(spark):
    base = spark.createDataFrame([(1, "a", 1), (2, "b", None)], "id long, x string, y int")
    patch = spark.createDataFrame([(2, None, 5), (3, "c", None)], "id long, x string, y int")
    assert sorted(store.upsert(base, patch, "id", ["x", "y"]).collect()) == [(1, "a", 1), (2, "b", 5), (3, "c", None)]
    assert sorted(store.insert_new(base, patch, "id").filter("id > 1").collect(), key=lambda r: r.id) == [(2, "b", None), (3, "c", None)]
    with pytest.raises(ValueError):
        store.require(base, ["z"])
    jobs = spark.createDataFrame([], "id int, visualisation_url string, start_time bigint, end_time bigint")
    jobs, job = store.new_job(spark, jobs, 10)
    assert store.finish_job(jobs, job, "u", 20).collect() == [(1, "u", 10, 20)]
    failures = spark.createDataFrame([], "id int, failure_type string, detail string, timestamp bigint, resolved boolean, jobId int")
    assert store.log_failure(spark, failures, job, "store", "d", 5).collect() == [(1, "store", "d", 5, False, 1)]


def test_headlines_csv(spark, tmp_path):
    (tmp_path / "h.csv").write_text('cluster_id,headline,summary\n1,h,"a\nb ""q"""\n')
    assert scans.headlines_csv(spark, str(tmp_path / "h.csv")).collect() == [("1", "h", 'a\nb "q"')]


def test_hashes_need_no_shuffle(spark):
    """articles are hashed where they are read; a text is shuffled for no hash, and is evaluated once."""
    rows = [(1, "Ab c 12 x"), (2, "abc12X"), (3, None), (4, "a"), (5, "中文字 abc"), (6, "abc12x")]
    df = spark.createDataFrame(rows, "id long, content string")
    got = copypaste.hashes(df, text.without_boilerplate(df.content), text.letters)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("MapInArrow") == 1
    found = {r.id: (bytes(r.key), r.simhash) for r in got.collect()}
    assert found[1] == found[2] == found[6] and found[3][1] == found[4][1] == 0 and len({k for k, _ in found.values()}) == 4
    for i, t in ((1, "abc12x"), (5, "中文字abc")):
        votes = [int(hashlib.md5(t[k : k + 3].encode()).hexdigest()[:15], 16) for k in range(len(t) - 2)]
        assert found[i][1] == sum(1 << b for b in range(60) if sum(1 if v >> b & 1 else -1 for v in votes) >= 0)


def test_hashes_of_long_texts_by_table():
    """A text of 200,000 signs: the table's way and that of dictionaries give one hash."""
    t = "".join(np.random.default_rng(0).choice(list("0123456789abcdefghijklmnopqrstuvwxyz"), 200_000))
    by_table = copypaste.simhash(t, 3, {}), copypaste.simhash(t, 3, {}, "blake2b")
    n = np.zeros(64, int)
    for g, k in Counter(t[i : i + 3] for i in range(len(t) - 2)).items():
        v = int(hashlib.md5(g.encode()).hexdigest()[:15], 16)
        n += np.array([k if v >> b & 1 else -k for b in range(64)])
    assert by_table[0] == sum(1 << b for b in range(60) if n[b] >= 0) and by_table[1] != by_table[0]
    assert copypaste.direct_grams("ab!", 3) is None and copypaste.direct_grams("a", 3).tolist() == [] and copypaste.gram_text(copypaste.direct_grams("zq0", 3)[0], 3) == "zq0"
