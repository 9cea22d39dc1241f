from collections import Counter

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from storyloom.functions import jsons, places, text, times, vector
from storyloom.operators import copypaste
from storyloom.operators.copypaste import HASHES, simhash


def one(spark, column, **values):
    kinds = ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'bigint' if isinstance(v, int) else 'array<double>'}" for k, v in values.items()) or "a int"
    return spark.createDataFrame([tuple(values.values()) or (0,)], kinds).select(column).first()[0]


def test_canonical_text(spark):
    c = text.canonical(F.col("t"))
    assert one(spark, c, t="責任編輯：王\nAbc　def 1") == "abcdef1"
    assert one(spark, c, t="責任編輯王 x") == "責任編輯王x"
    assert one(spark, c, t=None) == ""
    assert text.canonical_text("Ａｂ１") == "ab1"


@given(st.text(max_size=60))
def test_canonical_text_is_idempotent(s):
    assert text.canonical_text(text.canonical_text(s)) == text.canonical_text(s)


def test_char_ngrams(spark):
    df = spark.createDataFrame([("abcd",), ("ab",), ("",), (None,)], "t string")
    assert [r.grams for r in text.char_ngrams(df, "t", 3).collect()] == [["abc", "bcd"], [], [], []]


def test_jaccard_and_clip(spark):
    df = spark.createDataFrame([(["a", "b"], ["b", "c"]), ([], ["a"]), (None, ["a"])], "x array<string>, y array<string>")
    assert [round(r[0], 4) for r in df.select(text.jaccard(F.col("x"), F.col("y"))).collect()] == [0.3333, 0.0, 0.0]
    assert one(spark, text.clip(F.col("t"), 3), t="abcd") == "ab…"
    assert one(spark, text.snippet(F.col("t"), 3), t="a\nbcd") == "a b..."
    assert one(spark, text.is_native(F.col("t")), t=" Original ") is True


def brute_simhash(s, n, h):
    f, width = HASHES[h]
    grams = [s[i : i + n] for i in range(len(s) - n + 1)]
    return sum(1 << b for b in range(width) if sum(1 if f(g) >> b & 1 else -1 for g in grams) >= 0) if grams else 0


@given(st.text(alphabet="abc中文1", max_size=30), st.sampled_from(["md5", "blake2b"]))
def test_simhash(s, h):
    assert simhash(s, 3, {}, h) % (1 << 64) == brute_simhash(s, 3, h)


@given(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=3))
def test_bands_lose_no_pair_within_three_bits(x, flipped):
    y = x
    for b in flipped:
        y ^= 1 << b
    assert any(x >> 16 * k & 65535 == y >> 16 * k & 65535 for k in range(4))


@given(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=3), st.sampled_from([1, 10**5, 10**8, 10**12]))
def test_keys_lose_no_pair_within_three_bits(x, flipped, n):
    y = x
    for b in flipped:
        y ^= 1 << b
    masks = copypaste.keys(n, 3)
    assert any(x & m == y & m for m in masks)
    assert n == 10**12 or n / 2 ** min(m.bit_count() for m in masks) <= copypaste.BUCKET


def test_chunks():
    assert text.chunk_by_chars("") == []
    assert text.chunk_by_chars("甲。乙。", 3) == ["甲。", "乙。"]
    assert text.chunk_by_chars("甲。乙。", 5) == ["甲。 乙。"]
    long = "x" * 900
    got = text.chunk_by_chars(long, 380, 40)
    assert [len(c) for c in got] == [380, 380, 220]
    assert text.chunk_by_words("a b. c d. e", 4) == ["a b. c d", "e"]
    assert text.clauses("甲,乙。丙") == ["甲,", "乙。", "丙"]
    assert text.pack(["aa", "bb", "ccccc", "d"], 4) == ["aabb", "ccccc", "d"]


def test_times(spark):
    assert one(spark, times.seconds(F.col("t")), t="1704067200123") == 1704067200
    assert one(spark, times.seconds(F.col("t")), t="x") == 0
    assert one(spark, times.taipei(F.col("t")), t=0) == "1970-01-01 08:00:00+0800"
    assert one(spark, times.clamp_future(F.col("t"), 100), t=100 + 86400) == 100 + 86400
    assert one(spark, times.clamp_future(F.col("t"), 100), t=101 + 86400) == 100


def test_json_repair():
    want = {"headline": "h", "summary": "s", "question": "q"}
    for raw in (
        '{"headline": "h", "summary": "s", "question": "q"}', '```json\n{"headline": "h", "summary": "s", "question": "q"}\n```',
        '{"headline": "h", "summary": "s", "question": "q",}', '{"headline": "h", "summary": "s", "question": "q"', '{"headline": h, "summary": s, "question": q}',
    ):
        assert jsons.repair(raw) == want
    assert jsons.repair(None) == jsons.repair("no") == dict.fromkeys(want)


def test_gazetteer(spark):
    for raw, want in (("台北", "台北市"), ("布魯塞爾", "歐盟"), ("PA", "巴勒斯坦"), ("西班牙港", "西班牙"), ("某地", None), (None, None)):
        assert one(spark, places.canonical_place(F.col("t")), t=raw) == want
    assert one(spark, F.array_join(places.expanded_places(F.array("t"), F.lit("")), ","), t="花東") == "台東縣,花蓮縣"


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],), ([float("nan"), 1.0],), (None,)], "v array<double>")
    assert [r[0] for r in df.select(vector.is_live(F.col("v"))).collect()] == [True, False, False, False]
    assert df.select(vector.cosine(F.col("v"), F.col("v"))).first()[0] == 1.0
    got = vector.mean(spark.createDataFrame([(1, [1.0, 3.0]), (1, [3.0, 5.0])], "k int, v array<double>"), ["k"], "v").first()
    assert (got.centroid, got.n) == ([2.0, 4.0], 2)


def test_ngrams_are_counted_within_tasks(spark, monkeypatch):
    """F16: counts are shuffled, not every gram."""
    rows = ["abcabc", "ab", None, "", "中文字中文字x", "A b!a b!", "zz" * 40_000, "".join(map(chr, range(0x4E00, 0x4E40)))]
    for n in (1, 3, 4):
        got = text.ngram_counts(spark.createDataFrame([(r,) for r in rows], "t string").coalesce(1), "t", n)
        assert "Generate" not in got._jdf.queryExecution().optimizedPlan().toString()
        want = Counter(r[k : k + n] for r in rows if r for k in range(len(r) - n + 1))
        assert {r.gram: r.n for r in got.collect()} == dict(want)
    assert text.ngram_counts(spark.createDataFrame([], "t string"), "t", 3).count() == 0
    from storyloom.plans import queries

    assert "Generate" not in queries.char_ngrams(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
