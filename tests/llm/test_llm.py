"""Each operator against a brute-force version, on small tables that hold every odd case."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from storyloom.llm import collisions, components, cuts, language, licences, media, mixing, pieces, queries, sharding, simhash, toxicity, urls

DATA = "/root/testdata/sf0.001"
ODD = [None, "", " ", "a", "Ünï ｗide 日本語 𠀀", "x" * 5000, "w " * 3000, "\x00\x01", "▁ ▁", "A" * 64, "A" * 64]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and columns with the operators' own names."""
    rows = [(i, t, ["en", None, "de"][i % 3], [None, "s1", "s2"][i % 3], i) for i, t in enumerate(ODD)] + [(3, "a", "en", "s1", 1), (None, "a", None, None, None), (None, None, None, None, None)]
    cols = "doc_id long, text string, lang string, source string, n_chars long"
    df = spark.createDataFrame(rows, cols)
    return df.withColumns({c: F.lit("clash") for c in ("score", "size", "shard", "slot", "taken", "fp", "node", "media", "labels", "ids", "restored", "host", "target")})


@pytest.fixture(scope="module")
def empty(odd):
    return odd.filter("false")


@pytest.fixture(scope="module")
def vocabulary():
    with open(queries.PIECES_MODEL, "rb") as f:
        return pieces.vocabulary(f.read())


# 1


def test_pieces_equal_the_library(vocabulary):
    sp = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES_MODEL)
    rng = random.Random(0)
    parts = ["a", "e", "th", "the", " ", "  ", "\n", "\t", "é", "ñ", "日", "本", "ing", "tion", "0", ".", "\x00", "𠀀", "▁", "Ill", "egal", "Argument", "____", "==", "﷐", "ﬁ"]
    texts = ["", *[t or "" for t in ODD], *["".join(rng.choice(parts) for _ in range(rng.randint(1, 50))) for _ in range(800)]]
    ids, at = pieces.Encoder(vocabulary)(texts)
    assert [ids[at[i] : at[i + 1]].tolist() for i in range(len(texts))] == sp.encode(texts, num_threads=1)
    raw, off = pieces.decode_ids(vocabulary, ids, at)
    assert [raw[off[i] : off[i + 1]].tobytes().decode() for i in range(len(texts))] == [t.replace("▁", " ") for t in texts]
    for n in (1, 2, 15, 16, 17, 31, 33, 100, 300, 1000):
        assert list(vocabulary.run(n)) == (sp.encode(" " * (n - 1)) if n > 1 else [vocabulary.blanks[1]])


def test_pieces_query(spark, odd, empty):
    got = pieces.encode(odd, queries.PIECES_MODEL, ["doc_id"], decoded=True).collect()
    assert len(got) == odd.count()
    assert all(r.restored == ("▁" not in r.decoded and r.doc_id != 8) for r in got)
    assert pieces.encode(empty, queries.PIECES_MODEL, ["doc_id"]).count() == 0
    assert queries.op1_pieces(spark, DATA).filter("not restored").count() == 0


# 2


def test_media_round_trip_fast_and_slow(monkeypatch):
    rng = np.random.default_rng(0)
    payloads = [rng.integers(0, 256, 64 * n).astype(np.uint8) for n in (1, 2, 6, 7, 13, 400)]
    for p in payloads:
        assert (media.payload_of(media.decode_coefficients(media.encode_jpeg(p))) == p).all()
    for f in ("_dc_first", "_ac_first", "_ac_refine"):
        monkeypatch.setattr(media, f, lambda *a: False)
    for p in payloads[:5]:
        assert (media.payload_of(media.decode_coefficients(media.encode_jpeg(p))) == p).all()


def test_media_decodes_runs_and_grey():
    """A grey progressive file written by hand: spectral selection, end-of-block runs and zero runs."""
    bits = "".join(["0" + "101", "10" + "", "10"])  # three blocks of 1 x 3: DC differences of three bits (5), 0, 0
    dc = bytes([1, 1] + [0] * 14) + bytes([3, 0])
    ac = bytes([0, 3] + [0] * 14) + bytes([0x21, 0x10, 0x00])  # run 2 then one bit; end of block for 2 or 3; end of block
    band = "00" + "1" + "01" + "1"  # block 0: place 3 is 1, then the rest of it and the two others end in one run of 3

    def packed(b):
        b += "1" * (-len(b) % 8)
        return bytes(int(b[i : i + 8], 2) for i in range(0, len(b), 8))

    seg = media._segment
    file = b"\xff\xd8" + seg(0xDB, b"\0" + b"\1" * 64) + seg(0xC2, bytes([8, 0, 8, 0, 24, 1, 1, 0x11, 0])) + seg(0xC4, b"\0" + dc + b"\x10" + ac)
    file += seg(0xDA, bytes([1, 1, 0, 0, 0, 1])) + packed(bits) + seg(0xDA, bytes([1, 1, 0, 1, 63, 0])) + packed(band) + b"\xff\xd9"
    frame = media.decode_coefficients(file)
    coef = frame["parts"][1]["coef"]
    assert coef[:, 0].tolist() == [10, 10, 10]
    assert coef[0, 3] == 1 and np.count_nonzero(coef[:, 1:]) == 1
    assert media.to_rgb(frame).shape == (8, 24, 3)
    with pytest.raises(ValueError):
        media.decode_coefficients(b"no")


def test_media_query(odd, empty):
    got = media.decode_media(media.encode_media(odd, ["doc_id", "text"]), ["text", "n_bytes"], tensors=True).collect()
    for r in got:
        t = (r.text or "").encode()
        p = t.ljust(max(64, -(-len(t) // 64) * 64), b"\0")
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(t), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]))
        assert len(r.rgb) == r.width * r.height * 3
    assert media.encode_media(empty, ["doc_id"]).count() == 0


# 3


def brute_licences(texts):
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(table)) for t in texts]
    out = []
    for d in docs:
        places, base, own, score = [], set(), set(), 0.0
        for phrase, label in licences.BASE:
            p = phrase.split()
            at = [i for i in range(len(d)) if d[i : i + len(p)] == p]
            places += at
            base |= {label} if at else set()
        for label, template, phrases in licences.TEMPLATES:
            t = template.split()
            must = {}
            for phrase in phrases:
                p = phrase.split()
                k = next(i for i in range(len(t)) if t[i : i + len(p)] == p)
                must |= {k + i: w for i, w in enumerate(p)}
            get = lambda i: d[i] if 0 <= i < len(d) else None
            for s in range(-len(t), len(d)):
                if all(get(s + k) == w for k, w in must.items()):
                    own.add(label)
                    score = max(score, sum(get(s + k) == w for k, w in enumerate(t)) / len(t))
        out.append((len(d), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(base | own)), max(score, float(bool(places)))))
    return out


def test_licences(spark, odd, empty):
    texts = [*ODD, *[t for _, t, _ in licences.TEMPLATES], "All rights reserved. ALL RIGHTS RESERVED", "cc by cc by nc 4 0", "apache license", "x Licensed under the Apache License, Version 2.0. y",
             "released into the mit license", "rights all reserved", "distributed under the Apache License, Version 2.0", "general public license version 3 gnu general public license version 3"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in licences.scan(df, ["doc_id"]).collect()}
    assert [got[i] for i in range(len(texts))] == brute_licences(texts)
    assert licences.scan(odd, ["doc_id", "labels"]).count() == odd.count()
    assert licences.scan(empty, ["doc_id"]).count() == 0


# 4


def test_cuts(spark):
    rng = random.Random(0)
    rows = [(rng.randint(0, 2), rng.choice([5, rng.randint(0, cuts.TOP)]), rng.randint(0, 9)) for _ in range(500)]
    df = spark.createDataFrame(rows, "g int, k long, w long")
    for share in (0, 3, 10):
        goal = {g: sum(w for x, _, w in rows if x == g) * share // 10 for g in (0, 1, 2)}
        got = cuts.cuts(df, F.col("g"), F.col("k"), F.col("w"), goal | {9: 1})
        for g, target in goal.items():
            total = 0
            for k, part in itertools.groupby(sorted((k, w) for x, k, w in rows if x == g), key=lambda x: x[0]):
                at = sum(w for _, w in part)
                if total + at > target:
                    assert (got[g].key, got[g].below, got[g].at) == (k, total, at)
                    break
                total += at
            else:
                assert got[g].key is None
        assert got[9].key is None


def check_shards(rows, near):
    sizes = Counter()
    for r in rows:
        sizes[r.shard] += r.size
    for s in sizes:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    if near:
        assert max(sizes.values()) <= near * sum(sizes.values()) / 16
        assert len(sizes) == 16


def test_sharding(spark, odd, empty):
    rng = random.Random(1)
    texts = ["hot text"] * 3000 + ["".join(rng.choice("abcdé ") for _ in range(rng.randint(0, 200))) for _ in range(3000)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = sharding.shard_documents(df).collect()
    check_shards(rows, 1.05)
    assert all(r.size == len(texts[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in rows)
    of = {}
    for r in rows:
        of.setdefault(texts[r.doc_id], set()).add(r.shard)
    assert all(len(s) == 1 for t, s in of.items() if t != "hot text")
    check_shards(sharding.shard_documents(odd).collect(), None)
    assert sharding.shard_documents(empty).count() == 0


# 5


def test_language(spark, odd, empty):
    got = queries.op5_language(spark, DATA).join(spark.read.parquet(f"{DATA}/documents.parquet"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out]
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.95
    model = language.fit(odd)
    for r in language.predict(odd, model, ["doc_id", "text"]).collect():
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters) and 0 <= r.score <= 1
    nothing = language.predict(odd, language.fit(empty), ["doc_id"])
    assert nothing.filter("lang_pred != 'und'").count() == 0
    assert language.predict(empty, model, ["doc_id"]).count() == 0


# 6


@given(st.lists(st.integers(0, 1000), min_size=1, max_size=9))
def test_targets(sizes):
    t = mixing.targets(sizes)
    assert math.isclose(sum(t), 1.5 * sum(sizes), abs_tol=1e-6) and all(x <= 2 * s + 1e-6 for x, s in zip(t, sizes))


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.sets(st.integers(0, 2), min_size=1).map(lambda s: tuple(sorted(s))), st.integers(0, 4), min_size=1, max_size=3), st.lists(st.integers(0, 6), min_size=3, max_size=3))
def test_min_cost_flow(supply, quota):
    """Against all ways to route the words."""
    got = mixing.min_cost_flow(supply, dict(enumerate(quota)))
    cost = lambda p, f: sum(2 * r + 1 for r in range(2) for _ in range(min(supply[p], max(0, f - r * supply[p]))))
    sets = list(supply)
    best = None
    for flows in itertools.product(*[range(2 * supply[p] + 1) for p in sets]):
        ok = all(sum(f for p, f in zip(sets, flows) if set(p) <= set(s)) <= sum(quota[x] for x in s) for n in range(1, 4) for s in itertools.combinations(range(3), n))
        if ok:  # Hall's condition
            key = (-sum(flows), sum(cost(p, f) for p, f in zip(sets, flows)))
            best = key if best is None else min(best, key)
    assert (-sum(got.values()), sum(cost(p, f) for p, f in got.items())) == best


def test_mixing(spark, odd, empty):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    a, b = (sorted(queries.op6_mixing(spark, DATA).collect()) for _ in range(2))
    assert a == b
    source = {r.doc_id: r.source for r in docs.select("doc_id", "source").collect()}
    text = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    taken, target = Counter(), {}
    for r in a:
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", text[r.doc_id] or "")) and 0 <= r.taken <= 2 * r.size
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
    assert all(abs(taken[s] - t) <= 1 for s, t in target.items())
    rows = mixing.mix_sources(odd).collect()
    assert len(rows) == odd.count() and all(0 <= r.taken <= 2 * r.size for r in rows)
    assert mixing.mix_sources(empty).count() == 0


def test_mixing_of_overlapping_sources(spark):
    rows = [(i, [["a"], ["a", "b"], ["b", None]][i % 3], 10) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, m array<string>, size long")
    got = mixing.mix(df, "m", "size", cuts.seeded(F.col("id")), {"a": 250, "b": 155, None: 40}).collect()
    assert sum(r.taken for r in got) == 445 and all(0 <= r.taken <= 20 for r in got)


# 7


def brute_links(vectors, least=0.9):
    n = len(vectors)
    fine = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for v in vectors]
    near = {i: set() for i in range(n)}
    for i, j in itertools.combinations(range(n), 2):
        if fine[i] and fine[j] and len(vectors[i]) == len(vectors[j]):
            a, b = np.array(vectors[i], float), np.array(vectors[j], float)
            if a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= least:
                near[i].add(j)
                near[j].add(i)
    return near


def least_reached(near):
    out = {}
    for i in near:
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        out[i] = min(seen)
    return out


def test_collisions(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(150, 16))
    vectors = [*base.tolist(), *(base[:60] + rng.normal(size=(60, 16)) * 0.25).tolist(), *([base[0].tolist()] * 40), None, [0.0] * 16, [float("nan")] * 16, [None, *[1.0] * 15], [], [1.0, 2.0], [2.0, 4.0], [float("inf")] * 16]
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>").withColumn("label", F.lit(None).cast("int"))
    got = {r.vec_id: r for r in collisions.links(df).collect()}
    near = brute_links(vectors)
    reached = least_reached(near)
    found, true = sum(r.n_links for r in got.values()), sum(map(len, near.values()))
    assert 0.98 * true <= found <= true
    same = [got[i].component_id == reached[i] for i in near]
    assert np.mean(same) > 0.97 and all(r.kept == (r.vec_id == r.component_id) for r in got.values())
    assert all(got[i].n_links == 0 for i in range(250, 255))
    assert collisions.links(df.filter("false")).count() == 0


def test_collisions_in_blocks(spark, monkeypatch):
    """A bucket of nearly equal vectors that is larger than a block."""
    monkeypatch.setattr(collisions, "in_blocks", lambda rows, key, by, most: components.in_blocks(rows, key, by, 50))
    rng = np.random.default_rng(4)
    vectors = (rng.normal(size=8) + rng.normal(size=(300, 8)) * 0.01).tolist()
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    got = collisions.links(df).collect()
    assert all(r.n_links == 299 and r.component_id == 0 for r in got)


# 8


def brute_print(t):
    w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=70), st.integers(0, 5))
@settings(deadline=None)
def test_bit_sliced_comparison(f, radius):
    f = np.array(f + [f[0] ^ 1, f[0] ^ 0b11111], np.uint64)
    i, j = simhash.close(f, f, radius)
    assert set(zip(i.tolist(), j.tolist())) == {(a, b) for a in range(len(f)) for b in range(len(f)) if int(f[a] ^ f[b]).bit_count() <= radius}


@given(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=4), st.sampled_from([10, 10**7, 10**10]))
def test_bands_lose_nothing(x, flipped, n):
    y = x
    for b in flipped:
        y ^= 1 << b
    assert any(x & m == y & m for m in simhash.bands(n))


def test_simhash(spark, odd, empty):
    words = "alpha beta gamma delta epsilon zeta eta theta".split()
    rng = random.Random(5)
    long = [rng.choice(words) + str(rng.randint(0, 9)) for _ in range(400)]
    texts = [*ODD, *[" ".join(long[:k] + ["changed"] + long[k + 1 :]) for k in range(0, 40, 4)], " ".join(long), "one two", "one two"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in simhash.near_duplicates(df).collect()}
    prints = [brute_print(t) for t in texts]
    near = {i: {j for j in range(len(texts)) if j != i and (prints[i] ^ prints[j]).bit_count() <= 4} for i in range(len(texts))}
    assert [(got[i].fingerprint, got[i].component_id) for i in near] == [(f"{prints[i]:016x}", c) for i, c in least_reached(near).items()]
    assert simhash.near_duplicates(odd).count() == odd.count()
    assert simhash.near_duplicates(empty).count() == 0


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(100)] + [(200, 300), (300, 200), (400, 400)] + [(500, i) for i in range(501, 560)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(101)} | {200: 200, 300: 200} | {i: 500 for i in range(500, 560)}
    assert got == want


# 9


def brute_rule(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(h + p), h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[1:] if fits else (None, None))


def test_urls(spark):
    cases = [None, "", "no scheme/en/", "http://A.Example.COM/en/7?x#y", "http://example.com/en/8", "https://com/en/", "http://notcom/en/", "x://a.example.net/de/8", "x://a.net/de/7", "ftp://a.org/es/1#z",
             "http://h?q/en/", "http://h#/en/", "http://a.com?/en/", "http://a.com/EN/1", "http://é.com/en/é", "a://b://c/d"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(cases * 2)], "page_id long, url string, host string")
    got = {r.page_id: r for r in urls.judge(pages).collect()}
    for i, u in enumerate(cases * 2):
        host, path, rule, verdict = brute_rule(u)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert got[i].verdict == verdict if verdict else got[i].verdict in ("allow", "block")
        assert got[i].verdict == got[i % len(cases)].verdict
    assert urls.judge(pages.filter("false")).count() == 0


def test_url_models_against_plain_counts(spark):
    texts = ["abab", "abc", "", "a"]
    df = spark.createDataFrame([(t, "allow") for t in texts], "text string, verdict string")
    model = urls.train(df)["allow"]
    counts = Counter()
    for t in texts:
        s = ["^"] * urls.ORDER + [*t.encode(), "$"]
        for i in range(urls.ORDER, len(s)):
            for k in range(urls.ORDER + 1):
                counts[tuple(s[i - k : i]), s[i]] += 1

    def p(context, c):
        base = p(context[1:], c) if context else 1 / 257
        mine = {x: n for (ctx, x), n in counts.items() if ctx == context}
        return (mine.get(c, 0) + len(mine) * base) / (sum(mine.values()) + len(mine)) if mine else base

    raw = np.frombuffer(b"abx", np.uint8)
    contexts, nexts, _ = urls.grams(raw, np.array([0, 3]))
    s = ["^"] * urls.ORDER + [*b"abx", "$"]
    want = [math.log(p(tuple(s[i - urls.ORDER : i]), s[i])) for i in range(urls.ORDER, len(s))]
    assert np.allclose(model.log_likelihood(contexts, nexts), want)


def test_url_models_keep_rare_contexts_of_large_inputs(spark):
    """Over 2^21 characters: what was seen once still counts."""
    common = spark.range(100_000).select(F.lit("abcdefghijklmnopqrst").alias("text"), F.lit("allow").alias("verdict"))
    df = common.union(spark.createDataFrame([("xyz", "allow")], "text string, verdict string"))
    contexts, nexts, _ = urls.grams(np.frombuffer(b"xyz", np.uint8), np.array([0, 3]))
    got = urls.train(df)["allow"].log_likelihood(contexts, nexts)
    assert (got[1:] > math.log(0.96)).all()  # five orders above the lowest have seen each continuation once


# 10


def test_toxic_words_and_sentences():
    t = "One two. Zwei Ü!\nend".encode()
    slots, start, end, sentence = toxicity.words(np.frombuffer(t, np.uint8), np.array([0, 5, len(t)]))
    assert [t[a:b].decode() for a, b in zip(start, end)] == ["One", "t", "wo", "Zwei", "Ü", "end"]
    assert sentence.tolist() == [0, 0, 1, 2, 2, 3] or len(set(sentence.tolist())) == 4
    again, *_ = toxicity.words(np.frombuffer(b"xx ONE", np.uint8), np.array([0, 6]))
    assert (again[1] == slots[0]).all()


def test_toxic_evidence_spread_over_several_words():
    rng = random.Random(3)
    filler = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(200)]
    texts = []
    for i in range(300):
        said = [" ".join(rng.choice(filler) for _ in range(8)) for _ in range(6)]
        if i % 5 == 0:
            said[rng.randrange(6)] += " vilest nastyones wickedest"
        texts.append(". ".join(said).encode())
    found = [toxicity.words(np.frombuffer(t, np.uint8), np.array([0, len(t)])) for t in texts]
    some = [slot != toxicity.NONE for slot, *_ in found]
    y = np.array([i % 5 == 0 for i in range(300)], int)
    model = toxicity.train([slot[k] for (slot, *_), k in zip(found, some)], [np.repeat(sentence, k.sum(1)) for (*_, sentence), k in zip(found, some)], y)
    off = np.cumsum([0, *map(len, texts)])
    got = toxicity.score_texts(model, np.frombuffer(b"".join(texts), np.uint8), off)
    assert ((got >= toxicity.THRESHOLD) == (y > 0)).all()


def test_toxicity(spark, odd, empty):
    rng = random.Random(2)
    filler = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(200)]
    rows = []
    for i in range(600):
        words = [rng.choice(filler) for _ in range(rng.randint(20, 120))]
        bad = i % 5 == 0
        if bad:
            words[rng.randrange(len(words))] = rng.choice(["vilest", "nastyish", "nastyones"])
        rows.append((i, ". ".join(" ".join(words[k : k + 8]) for k in range(0, len(words), 8)), int(bad)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(None, 1), (1, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model, ["doc_id"]).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert np.mean([(got[i] >= toxicity.THRESHOLD) == bool(y) for i, _, y in held]) > 0.97
    for r in toxicity.offending(docs.filter("doc_id in (0, 5, 10)"), model, ["doc_id", "text"]).collect():
        assert any(re.search("vilest|nasty", r.text.encode()[s.start : s.end].decode()) for s in r.spans)
    odd_scores = toxicity.score(odd, model, ["doc_id", "text"]).collect()
    assert all(0 <= r.score <= 1 for r in odd_scores) and all(r.score == 0 for r in odd_scores if not (r.text or "").strip())
    assert toxicity.score(empty, model, ["doc_id"]).count() == 0
    assert toxicity.fit(docs, labels.filter("false")) is None
    assert toxicity.score(docs, None, ["doc_id"]).filter("score != 0").count() == 0
