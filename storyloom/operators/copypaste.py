"""Copy-paste detection: SimHash, band join, Hamming and n-gram Jaccard, then the cross-outlet rule.

All comparisons are between distinct canonical texts, so copies, however many, are compared once.
What an article needs of another text is, for each outlet, its earliest article only: if none of an
outlet's articles is earlier by the tie window, its earliest is also the one that can tie. So an
article meets as many rows as there are outlets in linked texts, never all copies.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Params
from ..functions.text import canonical, canonical_text, direct_grams, gram_text, is_native


def _md5_60(gram: str) -> int:
    return int(hashlib.md5(gram.encode()).hexdigest()[:15], 16)


def _blake2b_64(gram: str) -> int:
    return int.from_bytes(hashlib.blake2b(gram.encode(), digest_size=8).digest(), "little")


#: Cells of a text's sketch.
CELLS = 256
HASHES = {"md5": (_md5_60, 60), "blake2b": (_blake2b_64, 64)}


def simhash(text: str, n: int, bits_of: dict[str, np.ndarray], hash_name: str = "md5") -> int:
    """Of a canonical text: the bit is set if as many grams or more vote for it as against; 0 without grams.

    As a signed 64-bit number. ``bits_of`` keeps the votes of grams already seen: their rows in the table at -1.
    """
    if len(text) < n:
        return 0
    code = direct_grams(text, n)
    if code is not None:
        return _signed(_votes(code, n, hash_name))
    function, width = HASHES[hash_name]
    cp = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
    key = np.zeros(len(cp) - n + 1, np.int64)
    for k in range(n):
        key = key << 21 | cp[k : len(cp) - n + 1 + k]
    grams, counts = np.unique(key, return_counts=True)
    grams = grams.tolist()
    rows = list(map(bits_of.get, grams))
    if None in rows:
        table = bits_of.get(-1, np.zeros((0, width), np.int8))
        new = [g for g, r in zip(grams, rows) if r is None]
        at = max(0, len(bits_of) - 1)
        if at + len(new) > len(table):  # room for as many again
            table = np.concatenate([table, np.zeros((max(len(table), len(new), 1024), width), np.int8)])
        hashes = np.array([function("".join(chr(g >> 21 * (n - 1 - k) & 0x1FFFFF) for k in range(n))) for g in new], np.uint64)
        table[at : at + len(new)] = ((hashes[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)).astype(np.int8) * 2 - 1
        bits_of[-1] = table
        bits_of.update(zip(new, range(at, at + len(new))))
        rows = list(map(bits_of.get, grams))
    return _signed(counts.astype(np.float64) @ bits_of[-1][rows].astype(np.float64))  # whole numbers under 2^53


_TABLES: dict[tuple, tuple[np.ndarray, np.ndarray]] = {}


def _votes(code: np.ndarray, n: int, hash_name: str) -> np.ndarray:
    """Votes for each bit of numbered grams. What a gram votes is worked out once in a Python worker; the table is of fixed size."""
    function, width = HASHES[hash_name]
    if (n, hash_name) not in _TABLES:
        _TABLES[n, hash_name] = np.zeros((36**n, width), np.float32), np.zeros(36**n, bool)
    table, known = _TABLES[n, hash_name]
    if len(code) > 36**n // 8:
        counts = np.bincount(code, minlength=36**n)
        grams = np.flatnonzero(counts)
        counts = counts[grams]
    else:
        grams, counts = np.unique(code, return_counts=True)
    new = grams[~known[grams]]
    if len(new):
        hashes = np.array([function(gram_text(g, n)) for g in new.tolist()], np.uint64)
        table[new] = ((hashes[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)).astype(np.float32) * 2 - 1
        known[new] = True
    exact = np.float32 if len(code) < 1 << 24 else np.float64  # sums stay whole numbers
    return counts.astype(exact) @ table[grams].astype(exact, copy=False)


def _signed(votes: np.ndarray) -> int:
    out = sum(1 << i for i in np.flatnonzero(votes >= 0).tolist())
    return out - (1 << 64) if out >> 63 else out


def sketch(text: str, n: int) -> np.ndarray:
    """How many different n-grams of a canonical text fall into each of CELLS cells of a hash."""
    if len(text) < n:
        return np.zeros(CELLS, np.uint16)
    cp = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    h = np.zeros(len(cp) - n + 1, np.uint64)
    for k in range(n):
        h = h * np.uint64(0x100000001B3) + cp[k : len(cp) - n + 1 + k] + np.uint64(1)
    h = np.unique(h) * np.uint64(0x9E3779B97F4A7C15)
    return np.minimum(np.bincount((h >> np.uint64(56)).astype(np.int64), minlength=CELLS), 65535).astype(np.uint16)


def with_simhash(df: DataFrame, canon: str, n: int = 3, hash_name: str = "md5", refine_n: int = 5) -> DataFrame:
    """df plus simhash and sketch of its canonical text."""

    @F.pandas_udf("simhash long, sketch binary")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known: dict = {}
        for texts in batches:
            if len(known) > 500_000:
                known.clear()
            texts = [t or "" for t in texts]
            yield pd.DataFrame({"simhash": np.array([simhash(t, n, known, hash_name) for t in texts], np.int64), "sketch": [sketch(t, refine_n).tobytes() for t in texts]})

    return df.withColumn("s_", of(canon)).select("*", "s_.simhash", "s_.sketch").drop("s_")


def hashes(articles: DataFrame, content: Column, form: Callable[[str | None], str], n: int = 3, hash_name: str = "md5") -> DataFrame:
    """(id, key, simhash) of every article: the SHA-256 of ``form(content)`` and its SimHash, 0 if it is too short.

    Articles are hashed where they are read, one text at a time; no text is sent on, or kept.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for b in batches:
            keys, got = [], []
            for t in b.column(1):
                t = form(t.as_py())
                if len(known) > 500_000:
                    known.clear()
                keys.append(hashlib.sha256(t.encode()).digest())
                got.append(simhash(t, n, known, hash_name))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(keys, pa.binary()), pa.array(got, pa.int64())], names=["id", "key", "simhash"])

    kind = articles.schema["id"].dataType.simpleString()
    return articles.select("id", content.alias("c")).mapInArrow(run, f"id {kind}, key binary, simhash long")


def canonical_udf(convert=None):
    """The canonical form with compatibility normalisation; ``convert``: simplified to traditional, if there is one."""

    @F.pandas_udf("string")
    def of(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: canonical_text(t, convert))

    return of


def gram_sets(texts: list[str], n: int) -> list[np.ndarray]:
    """The different n-grams of each text as sorted numbers, the same for equal grams; not a hash, so that none fall together."""
    points = [np.frombuffer(t.encode("utf-32-le"), np.uint32) for t in texts]
    alphabet = np.unique(np.concatenate([np.zeros(0, np.uint32), *map(np.unique, points)]))
    base = len(alphabet) + 1
    if base**n >= 1 << 64:  # too many characters for one number: grams are numbered as they come
        number: dict[str, int] = {}
        return [np.unique(np.array([number.setdefault(t[i : i + n], len(number)) for i in range(len(t) - n + 1)], np.uint64)) for t in texts]
    out = []
    for p in points:
        rank = np.searchsorted(alphabet, p).astype(np.uint64)
        key = np.zeros(max(0, len(p) - n + 1), np.uint64)
        for k in range(n):
            key = key * np.uint64(base) + rank[k : k + len(key)]
        out.append(np.unique(key))
    return out


def shared(x: np.ndarray, y: np.ndarray) -> int:
    """How many numbers two sorted arrays without repeats have in common."""
    if len(x) > len(y):
        x, y = y, x
    if not len(x):
        return 0
    at = np.searchsorted(y, x)
    return int((y[np.minimum(at, len(y) - 1)] == x).sum())


def bands(df: DataFrame, simhash: str = "simhash", count: int = 4) -> DataFrame:
    """df with a row for each band: (band, bandkey), 64/count bits each."""
    width = 64 // count
    keys = F.array(*[F.shiftrightunsigned(F.col(simhash), width * b).bitwiseAND(F.lit((1 << width) - 1)) for b in range(count)])
    return df.select("*", F.posexplode(keys).alias("band", "bandkey"))


#: Distinct texts that a bucket of evenly spread hashes may hold.
BUCKET = 256


def keys(n: int, radius: int, bucket: int = BUCKET) -> list[int]:
    """Masks of 64-bit hashes; two hashes at ``radius`` or fewer differing bits agree on one at least.

    The bits are cut into radius + m parts, and every choice of m parts is a mask: whichever bits
    differ, m parts hold none of them. m is the least for which n evenly spread hashes leave ``bucket``
    or fewer in one bucket, up to 6.
    """
    for m in range(1, 7):
        parts = [sum(1 << b for b in range(64) if b * (radius + m) // 64 == k) for k in range(radius + m)]
        if n >> (64 // (radius + m)) * m <= bucket or m == 6:
            return [sum(c) for c in combinations(parts, m)]
    return []


def hashed(articles: DataFrame, p: Params = Params()) -> DataFrame:
    """articles, less their content, with canon, simhash and sketch; each distinct canonical text is hashed once.

    Texts too short for a SimHash, and those whose SimHash is 0, are left out.
    """
    own = articles.withColumn("canon", canonical(F.col("content"))).drop("content").filter(F.length("canon") >= p.zh_dup_ngram)
    texts = with_simhash(own.select("canon").distinct(), "canon", p.zh_dup_ngram, refine_n=p.zh_dup_refine_n).filter("simhash != 0")
    return own.join(texts, "canon")


def named(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of ``hashed`` with ``cls``, distinct canonical texts as (cls, canon, simhash, sketch)); a class is named by its smallest id."""
    texts = rows.groupBy("canon").agg(F.min("id").alias("cls"), F.first("simhash").alias("simhash"), F.first("sketch").alias("sketch"))
    return rows.drop("simhash", "sketch").join(texts.select("canon", "cls"), "canon").drop("canon"), texts


def classes(articles: DataFrame, p: Params = Params()) -> tuple[DataFrame, DataFrame]:
    """The same of articles. The distinct texts with their hashes are kept (in memory, else on disk; lost parts are made
    again), as every later step reads them, and so are later calls over the same articles; ``spark.catalog.clearCache()``
    lets them go."""
    own = articles.withColumn("canon", canonical(F.col("content"))).withColumn("key", F.unhex(F.sha2("canon", 256)))
    texts = own.groupBy("key").agg(F.min("id").alias("cls"), F.first("canon").alias("canon")).filter(F.length("canon") >= p.zh_dup_ngram)  # after: a filter before would make canon twice
    made = with_simhash(texts, "canon", p.zh_dup_ngram, refine_n=p.zh_dup_refine_n).filter("simhash != 0").persist()
    return own.drop("content", "canon").join(made.select("key", "cls"), "key").drop("key"), made.drop("key")


#: Texts of a block that are compared with each other, and characters (or texts, a thousandth of it) of a block whose n-grams are.
ROWS, CHARS = 32_768, 4_000_000
_ROW = ("cls", "simhash", "sketch", "size", "chars", "asked")


def _sizes(sketch: str, long: Column, n: int) -> Column:
    """How many different n-grams a text has, from its sketch; ``long``: the text, where cells may be full."""

    @F.pandas_udf("long")
    def of(cells: pd.Series, texts: pd.Series) -> pd.Series:
        return pd.Series([int(np.frombuffer(c, np.uint16).sum(dtype=np.int64)) if t is None else len(gram_sets([t], n)[0]) for c, t in zip(cells, texts)], dtype="int64")

    return of(sketch, long)


def _near(x: list[np.ndarray], y: list[np.ndarray] | None, radius: int, least: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, hamming) of the pairs of two blocks, or of one, whose hashes are near, and whose Jaccard may reach ``least`` by
    their sketches: what two sets share in a cell is at most the smaller count (a full cell makes the bound 1)."""
    (hx, sx, nx, ax), (hy, sy, ny, ay) = x, x if y is None else y
    for at in range(0, len(hx), 128):
        d = np.bitwise_count(hx[at : at + 128, None] ^ hy[None, :])
        i, j = np.nonzero((d <= radius) & (ax[at : at + 128, None] | ay[None, :]))
        h, i = d[i, j], i + at
        fit = np.minimum(nx[i], ny[j]) >= least * np.maximum(nx[i], ny[j]) - 1e-6
        if y is None:
            fit &= i < j
        i, j, h = i[fit], j[fit], h[fit]
        for k in range(0, len(i), 8192):
            a, b = sx[i[k : k + 8192]], sy[j[k : k + 8192]]
            both = np.minimum(a, b).sum(1, dtype=np.int64)
            bound = both / np.maximum(1, nx[i[k : k + 8192]] + ny[j[k : k + 8192]] - both)
            good = (bound >= least) | (a == 65535).any(1) | (b == 65535).any(1)
            if good.any():
                yield i[k : k + 8192][good], j[k : k + 8192][good], h[k : k + 8192][good]


def _candidates(rows: DataFrame, p: Params) -> DataFrame:
    """(a, b, hamming, wa, wb, na, nb) of rows (_ROW, w): pairs of near hashes in one or two neighbouring strata w that may be
    links, each found once, with the texts' characters."""
    radius, least = p.zh_dup_max_hamming, p.zh_dup_min_j
    parts = {r.w: -(-r.n // ROWS) for r in rows.groupBy("w").agg(F.count("*").alias("n")).collect()}  # strata are few: sizes grow by a factor
    pairs = [(w, v, i, j) for w in parts for v in (w, w + 1) if v in parts for i in range(parts[w]) for j in range(i if v == w else 0, parts[v])]
    if not pairs:
        pairs = [(0, 0, 0, 0)]
    sides = [(w, i, g, 0) for g, (w, _, i, _) in enumerate(pairs)] + [(v, j, g, 1) for g, (w, v, i, j) in enumerate(pairs) if (w, i) != (v, j)]
    spark = rows.sparkSession
    many = spark.createDataFrame(list(parts.items()) or [(0, 1)], "w int, parts int")
    into = spark.createDataFrame(sides, "w int, block int, g int, side int")
    rows = rows.join(F.broadcast(many), "w").withColumn("block", F.pmod(F.xxhash64("cls"), "parts").cast("int")).join(F.broadcast(into), ["w", "block"])
    kind = rows.schema["cls"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(list(batches)).combine_chunks()
        side = t["side"].to_numpy()
        at, names, w, chars = [], [], [], []
        for k in (0, 1):
            m = t.filter(pa.array(side == k))
            if not m.num_rows and k:
                at.append(None)
                break
            sketches = np.frombuffer(b"".join(m["sketch"].to_pylist()), np.uint16).reshape(-1, CELLS)
            at.append([m["simhash"].to_numpy().view(np.uint64), sketches, m["size"].to_numpy(), m["asked"].to_numpy(zero_copy_only=False)])
            names.append(m["cls"]), w.append(m["w"]), chars.append(m["chars"])
        other = -1 if at[1] is not None else 0
        if not len(at[0][0]):
            return
        for i, j, h in _near(*at, radius, least):
            i, j = pa.array(i), pa.array(j)
            yield pa.RecordBatch.from_pandas(pd.DataFrame({"a": names[0].take(i), "b": names[other].take(j), "hamming": h.astype(np.int32), "wa": w[0].take(i), "wb": w[other].take(j), "na": chars[0].take(i), "nb": chars[other].take(j)}), preserve_index=False)

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(tasks, "g").groupBy("g").applyInArrow(run, f"a {kind}, b {kind}, hamming int, wa int, wb int, na int, nb int")


def _verified(near: DataFrame, texts: DataFrame, p: Params) -> DataFrame:
    """(a, b, hamming, jaccard) of the candidates that are links; a text is sent once to each task that has pairs of it, not once for each pair."""
    n, least = p.zh_dup_refine_n, p.zh_dup_min_j
    spark = near.sparkSession
    met = near.select(F.col("wa").alias("w"), F.col("a").alias("cls"), F.col("na").alias("n")).unionByName(near.select(F.col("wb").alias("w"), F.col("b").alias("cls"), F.col("nb").alias("n"))).distinct()
    sums = met.groupBy("w").agg(F.ceil(F.greatest(F.sum("n"), F.count("*") * 1000) / CHARS).cast("int").alias("k")).collect()
    many = spark.createDataFrame([(r.w, r.k) for r in sums] or [(0, 1)], "w int, k int")
    pairs = near
    for side in ("a", "b"):
        pairs = pairs.join(F.broadcast(many.toDF(f"w{side}", f"k{side}")), f"w{side}").withColumn(f"p{side}", F.pmod(F.xxhash64(side, F.lit(1)), f"k{side}").cast("int"))
    pairs = pairs.select(F.concat_ws("-", "wa", "pa", "wb", "pb").alias("g"), "a", "b", "hamming")
    needed = pairs.select("g", F.col("a").alias("cls")).unionByName(pairs.select("g", F.col("b").alias("cls"))).distinct()
    sent = needed.join(texts.select("cls", "canon"), "cls").select(F.col("g").alias("h"), "cls", "canon")
    kind = near.schema["a"].dataType.simpleString()

    def run(pairs: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        sets = dict(zip(own["cls"], gram_sets(own["canon"].tolist(), n)))
        size = dict(zip(own["cls"], map(len, own["canon"])))
        jaccard = []
        for a, b in zip(pairs["a"], pairs["b"]):
            x, y = sets[a], sets[b]
            both = shared(x, y) if min(size[a], size[b]) >= 2 * n else 0
            jaccard.append(both / (len(x) + len(y) - both) if both else 0.0)
        out = pairs.assign(jaccard=np.array(jaccard, float))
        return out[out["jaccard"] >= least][["a", "b", "hamming", "jaccard"]]

    return pairs.groupBy("g").cogroup(sent.groupBy("h")).applyInPandas(run, f"a {kind}, b {kind}, hamming int, jaccard double")


def linked_classes(texts: DataFrame, p: Params = Params(), asked: DataFrame | None = None) -> DataFrame:
    """(a, b, hamming, jaccard) of distinct texts that are near copies, both ways, and each long enough text with itself.

    ``asked``: classes (cls) of which one at least must be in a pair; all if None. Texts whose sets of
    n-grams differ too much in size are never links, so texts meet in strata of sizes that grow by a
    factor, with those of their own and the next stratum. Within these, blocks of bounded size are
    compared as matrices: hashes, then sizes, then sketches. Only what is left is verified by its texts.
    """
    least = p.zh_dup_min_j
    rows = texts.withColumn("size", _sizes("sketch", F.when(F.length("canon") > 65_000, F.col("canon")), p.zh_dup_refine_n))
    step = max(math.log(1 / least) * 1.0001, 1e-4) if least > 0 else None  # a little wider, so that rounding parts no two
    w = F.lit(0) if step is None else F.floor(F.log(F.col("size").cast("double")) / step).cast("int")
    rows = rows.filter("size > 0" if step else "true").withColumns({"w": w, "chars": F.length("canon")})
    mine = texts
    if asked is None:
        rows = rows.withColumn("asked", F.lit(True))
    else:
        wanted = asked.select("cls").distinct()
        mine = texts.join(wanted, "cls", "left_semi")
        rows = rows.join(wanted.withColumn("asked", F.lit(True)), "cls", "left").withColumn("asked", F.coalesce("asked", F.lit(False)))
    near = _candidates(rows.select(*_ROW, "w"), p).persist()
    near = _verified(near, texts, p).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "hamming", "jaccard").persist()
    own = mine.filter(F.length("canon") >= 2 * p.zh_dup_refine_n).select(F.col("cls").alias("a"), F.col("cls").alias("b"), F.lit(0).alias("hamming"), F.lit(1.0).alias("jaccard"))
    return near.unionByName(near.select(F.col("b").alias("a"), F.col("a").alias("b"), "hamming", "jaccard")).unionByName(own)


def flags(articles: DataFrame, p: Params = Params()) -> DataFrame:
    """(id, copypaste_flag, copypaste_rule, origin_id, origin_media, delta_secs, hamming, jaccard) of every article.

    ``articles``: id, content, media_name, published_at, origin. An article of another outlet whose
    text is a near copy is the origin if it is earlier by the tie window or more, or, where none is
    and the article's own origin is not native, if it is within that window.
    """
    own, texts = classes(articles, p)
    return flagged(articles.select("id", "published_at", "origin"), own, linked_classes(texts, p), p)


def flagged(asked: DataFrame, own: DataFrame, links: DataFrame, p: Params = Params()) -> DataFrame:
    """The flags of the articles ``asked`` (id, published_at, origin), from the articles ``own`` with their classes, and the classes' links."""
    outlets = own.filter((F.col("published_at") > 0) & (F.col("media_name") != "")).groupBy("cls", "media_name").agg(F.min(F.struct("published_at", "id")).alias("first"))
    seen = links.join(outlets.withColumnRenamed("cls", "b"), "b").select("a", "hamming", "jaccard", F.col("media_name").alias("om"), F.col("first.published_at").alias("op"), F.col("first.id").alias("oi"))
    mine = own.join(asked.select("id"), "id", "left_semi").select("id", "cls", "media_name", "published_at")
    met = mine.join(seen.withColumnRenamed("a", "cls"), "cls").filter(F.col("om") != F.coalesce("media_name", F.lit("")))
    early = F.col("op") <= F.col("published_at") - p.zh_dup_tie_secs
    tie = ~early & (F.col("op") <= F.col("published_at") + p.zh_dup_tie_secs)
    facts = F.struct(F.col("oi").alias("id"), F.col("om").alias("media"), F.col("op").alias("published"), "hamming", "jaccard")
    best = met.groupBy("id").agg(
        F.min_by(F.when(early, facts), F.when(early, F.struct("op", "hamming", -F.col("jaccard"), "oi"))).alias("e"),
        F.min_by(F.when(tie, facts), F.when(tie, F.struct("hamming", -F.col("jaccard"), "op", "oi"))).alias("t"),
    )
    out = asked.select("id", "published_at", "origin").join(best, "id", "left")
    rule = F.when(F.col("e").isNotNull(), "earlier_cross_outlet").when(F.col("t").isNotNull() & ~is_native(F.col("origin")), "tie_origin_not_native").otherwise("original")
    out = out.withColumn("copypaste_rule", rule)
    chosen = F.when(F.col("copypaste_rule") == "earlier_cross_outlet", F.col("e")).when(F.col("copypaste_rule") == "tie_origin_not_native", F.col("t"))
    out = out.withColumn("o", chosen)
    return out.select(
        "id", (F.col("copypaste_rule") != "original").alias("copypaste_flag"), "copypaste_rule", F.col("o.id").alias("origin_id"), F.col("o.media").alias("origin_media"),
        (F.col("published_at") - F.col("o.published")).alias("delta_secs"), F.col("o.hamming").cast("int").alias("hamming"), F.round("o.jaccard", 3).alias("jaccard"),
    )


def top_matches(articles: DataFrame, k: int = 5, p: Params = Params()) -> DataFrame:
    """The k best matches of each article: (id, rank, match_id, hamming, jaccard), best first, earlier first.

    Of a text, only its k + 1 earliest articles can be among an article's k best.
    """
    own, texts = classes(articles, p)
    first = Window.partitionBy("cls").orderBy("published_at", "id")
    early = own.withColumn("r", F.row_number().over(first)).filter(F.col("r") <= k + 1).select(F.col("cls").alias("b"), F.col("id").alias("match_id"), F.col("published_at").alias("mp"))
    offered = linked_classes(texts, p).join(early, "b")
    kept = Window.partitionBy("a").orderBy("hamming", F.desc("jaccard"), "mp", "match_id")
    offered = offered.withColumn("r", F.row_number().over(kept)).filter(F.col("r") <= k + 1).drop("r", "b")
    met = own.select("id", F.col("cls").alias("a")).join(offered, "a").filter("match_id != id")
    rank = Window.partitionBy("id").orderBy("hamming", F.desc("jaccard"), "mp", "match_id")
    return met.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k).select("id", "rank", "match_id", F.col("hamming").cast("int").alias("hamming"), F.round("jaccard", 3).alias("jaccard"))
