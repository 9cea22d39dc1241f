"""Mixing sources to target weights by min-cost flow.

Documents are aggregated by the set of sources they belong to, their pattern. Each pattern offers its
words once for each allowed repetition, at a cost that rises with the repetition, and may send them to
any of its sources; each source takes words up to its quota. The cheapest flow says how many words of
each pattern the mix takes; within it, documents are taken in a seeded order, whole repetitions first,
and the last one in part, so that the words add up exactly.

A null or empty text has size 0 and gives nothing. A null source is a source of its own, after all
others. Rows of one key (repeated rows) share what falls to that key evenly.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .cuts import Cut, cuts
from .util import stored

#: Weights of the sources in order, repeating; the mix's share of all words; most repetitions.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
REPEATS = 2
SEED = "mix-1"
#: Patterns that are kept apart; beyond that number, which depends on that of the sources alone, patterns of many sources are pooled.
PATTERNS = 1 << 12
#: Texts of several sources up to which their patterns are sent to all workers; beyond that they are joined by a shuffle.
SENT = 100_000


def seeded_order(id_col: Column, seed: str = SEED) -> Column:
    """An even key below 2**60 from seed and id, the same in any SQL engine with MD5; a null id counts as empty."""
    text = F.concat(F.lit(seed), F.coalesce(id_col.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def word_count(c: Column) -> Column:
    """Runs of characters other than ASCII white space; 0 for null."""
    marks = F.regexp_replace(c, r"[^\x20\x09-\x0D]+", "x")
    return F.coalesce(F.length(F.translate(marks, " \t\n\x0b\f\r", "")), F.lit(0)).cast("long")


def targets(sizes: list[int], weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> list[float]:
    """Words for each source: shares by weight, none above ``repeats`` times its size, the excess reshared."""
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    total, capped = share * sum(sizes), [False] * len(sizes)
    while True:
        left = total - sum(repeats * s for s, c in zip(sizes, capped) if c)
        open_weight = sum(x for x, c in zip(w, capped) if not c)
        out = [float(repeats * s) if c else left * x / open_weight for s, x, c in zip(sizes, w, capped)]
        above = [not c and t > repeats * s for s, t, c in zip(sizes, out, capped)]
        if not any(above):
            return out
        capped = [c or a for c, a in zip(capped, above)]


def min_cost_flow(supply: dict[tuple[int, ...], int], quota: dict[int, int], repeats: int = REPEATS) -> dict[tuple[int, ...], int]:
    """Words taken of each set of sources (``supply``: its words) at the least cost of repetition.

    The r-th repetition of a word costs 2r - 1, so that r repetitions cost r * r in all.
    """
    sent = route([supply] * repeats, {(p, s): 1 << 62 for p in supply for s in p}, quota)
    return {p: sum(sent[p, s] for s in p) for p in supply}


def route(levels: list[dict], room: dict[tuple, int], quota: dict) -> dict[tuple, int]:
    """Words sent from each pattern to each of its sources, as many as the quotas take, at the least cost.

    ``levels``: what each pattern offers at one cost more and more, the cheapest first; ``room``: what
    may go from a pattern to a source. Routing itself costs nothing, so the cheapest paths left all
    lie in the lowest level with any: level after level is opened, and the flow raised to the largest
    by blocking flows. What a pattern sends never falls again; where it sends it may change.
    """
    patterns, sources = sorted({p for p, _ in room}), sorted(quota)
    at = {("p", p): 1 + i for i, p in enumerate(patterns)} | {("s", s): 1 + len(patterns) + i for i, s in enumerate(sources)}
    sink = 1 + len(at)
    graph: list[list[int]] = [[] for _ in range(sink + 1)]
    ends: list[int] = []
    left: list[int] = []

    def edge(a: int, b: int, most: int) -> int:
        for x, y, r in ((a, b, most), (b, a, 0)):
            graph[x].append(len(ends))
            ends.append(y)
            left.append(r)
        return len(ends) - 2

    offers = {p: edge(0, at["p", p], 0) for p in patterns}
    ways = {(p, s): edge(at["p", p], at["s", s], room[p, s]) for p, s in sorted(room) if s in quota}
    for s in sources:
        edge(at["s", s], sink, quota[s])
    missing = sum(quota.values())
    for level in levels:
        for p, words in level.items():
            if p in offers:
                left[offers[p]] += words
        while missing:
            depth = _depths(graph, ends, left, sink)
            if depth[sink] < 0:
                break
            begun = [0] * (sink + 1)
            while sent := _augment(graph, ends, left, depth, begun, sink):
                missing -= sent
    return {k: left[e ^ 1] for k, e in ways.items()}


def _depths(graph: list[list[int]], ends: list[int], left: list[int], sink: int) -> list[int]:
    depth = [-1] * (sink + 1)
    depth[0], layer = 0, [0]
    while layer and depth[sink] < 0:
        following = []
        for x in layer:
            for e in graph[x]:
                if left[e] and depth[ends[e]] < 0:
                    depth[ends[e]] = depth[x] + 1
                    following.append(ends[e])
        layer = following
    return depth


def _augment(graph: list[list[int]], ends: list[int], left: list[int], depth: list[int], begun: list[int], sink: int) -> int:
    """Sends what one more path of the layered graph takes; 0 if there is none."""
    path, x = [], 0
    while x != sink:
        while begun[x] < len(graph[x]):
            e = graph[x][begun[x]]
            if left[e] and depth[ends[e]] == depth[x] + 1:
                break
            begun[x] += 1
        else:  # a dead end
            if not path:
                return 0
            x = ends[path.pop() ^ 1]
            begun[x] += 1
            continue
        path.append(e)
        x = ends[e]
    sent = min(left[e] for e in path)
    for e in path:
        left[e] -= sent
        left[e ^ 1] += sent
    return sent


def mix(rows: DataFrame, members: str, size: str, order: Column, quota: dict[str | None, int], repeats: int = REPEATS) -> DataFrame:
    """rows with ``taken`` added: the words the mix takes of each, repetitions counted.

    ``members``: an array column, the sources of a row; ``size``: its words; ``order``: a key from 0
    to cuts.TOP by which documents of one set are taken; ``quota``: the words each source shall get.
    One row for each set of sources reaches the driver.
    """
    names = list(quota)
    index = {s: i for i, s in enumerate(names)}
    canonical = F.array_sort(F.array_distinct(F.col(members)))
    sets = rows.groupBy(canonical.alias("m")).agg(F.sum(size).alias("w")).collect()
    order_of = sorted(sets, key=lambda r: [(x is None, x or "") for x in (r.m or [])])
    supply: dict[tuple[int, ...], int] = {}
    for r in order_of:
        p = tuple(sorted(index[s] for s in (r.m or []) if s in index))
        supply[p] = supply.get(p, 0) + (r.w or 0)
    flow = min_cost_flow(supply, {index[s]: q for s, q in quota.items()}, repeats)
    numbers = {p: i for i, p in enumerate(sorted(supply))}
    spark = rows.sparkSession
    kind = rows.schema[members].dataType.simpleString()
    lookup = spark.createDataFrame(
        [(r.m, numbers[tuple(sorted(index[s] for s in (r.m or []) if s in index))]) for r in order_of], f"m_ {kind}, g_ int"
    )
    named = rows.withColumn("o_", order).join(F.broadcast(lookup), canonical.eqNullSafe(F.col("m_")), "left").drop("m_")
    return _dealt(named, size, {numbers[p]: (w, flow[p]) for p, w in supply.items()})


def _dealt(rows: DataFrame, size: str, cells: dict[int, tuple[int, int]]) -> DataFrame:
    """rows, less g_ and o_, with ``taken``: of each cell g_, which has so many words and sends so many, rows in the order of o_."""
    whole = {g: (sent // w if w else 0) for g, (w, sent) in cells.items()}
    part = {g: sent - whole[g] * w for g, (w, sent) in cells.items() if w and sent % w}
    found = cuts(rows, F.col("g_"), F.col("o_"), F.col(size), part)
    at_key = rows.sparkSession.createDataFrame(
        [(g, whole[g], *_bounds(found.get(g), part.get(g, 0))) for g in whole], "g_ int, whole_ long, cut_ long, rest_ long, at_ long"
    )
    share = F.expr(f"case when o_ < cut_ then {size} when o_ = cut_ and at_ > 0 then cast(floor(cast(rest_ as double) * {size} / at_) as long) else 0 end")
    return rows.join(F.broadcast(at_key), "g_", "left").withColumn("taken", F.col("whole_") * F.col(size) + share).drop("g_", "o_", "whole_", "cut_", "rest_", "at_")


def _bounds(cut: Cut | None, target: int) -> tuple[int, int, int]:
    if cut is None:
        return -1, 0, 0
    if cut.key is None:
        return 1 << 62, 0, 0
    return cut.key, target - cut.below, cut.at


def _exact(sources: int) -> int:
    """Up to how many sources a pattern is kept as it is: as many as leave PATTERNS patterns at most."""
    k = 1
    while k < sources and sum(math.comb(sources, i) for i in range(1, k + 2)) <= PATTERNS:
        k += 1
    return k


def steps(repeats: int) -> list[tuple[int, int]]:
    """(number of repetitions, cost of each word) of the levels: one by one at first, then twice as many each time."""
    out, done = [], 0
    while done < repeats:
        n = 1 if done < 8 else min(done, repeats - done)
        out.append((n, 2 * done + 1))
        done += n
    return out


def mix_sources(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", keep: list[str] | None = None) -> DataFrame:
    """Each row's id (and ``keep``) with size, source_size, target and taken, by the fixed weights above.

    Sources overlap in texts that several of them hold. A text's pattern is the set of its sources; a
    pattern's distinct words are offered once for each repetition, whichever source's copies give them,
    so that the flow takes little from texts that many sources repeat where others can fill the quotas.
    From a pattern to a source may go what its rows of that source hold, each row taken REPEATS times
    at most. Within a pattern and source, rows are taken in the seeded order. Patterns of more sources
    than ``_exact`` keeps are pooled by their number of sources, which costs no feasibility.
    """
    keep = [k for k in keep or [] if k not in (id_col, source_col, "size", "source_size", "target", "taken")]
    text = F.coalesce(F.col(text_col), F.lit(""))
    print_ = F.struct(F.xxhash64(text).alias("a"), F.crc32(text.cast("binary")).alias("b"))
    rows = stored(df.select(F.col(id_col).alias("id_"), F.col(source_col).alias("source_"), *keep, word_count(F.col(text_col)).alias("size_"), print_.alias("t_")))
    spark = rows.sparkSession
    sums = {r.source_: r.w for r in rows.groupBy("source_").agg(F.sum("size_").alias("w")).collect()}
    names = sorted(sums, key=lambda s: (s is None, s or ""))
    goal = targets([sums[s] for s in names]) if names else []
    facts = spark.createDataFrame([(s, i, sums[s], t) for i, (s, t) in enumerate(zip(names, goal))], "s_ string, n_ int, source_size long, target double")
    named = rows.join(F.broadcast(facts), F.col("source_").eqNullSafe(F.col("s_")), "left").drop("s_")

    # Texts of several sources, with their pattern's name; all others have their one source.
    held = named.groupBy("t_", "n_").agg(F.max("size_").alias("w")).groupBy("t_").agg(F.array_sort(F.collect_list("n_")).alias("m"), F.max("w").alias("w"))
    most = _exact(len(names))
    name = F.when(F.size("m") <= most, F.array_join(F.transform("m", lambda x: x.cast("string")), ",")).otherwise(F.concat(F.lit("any "), F.size("m").cast("string")))
    held = stored(held.select("t_", "w", name.alias("p_"), (F.size("m") > 1).alias("several")))
    shared = held.filter("several").select("t_", "p_")
    few = shared.count() <= SENT
    found = named.join(F.broadcast(shared) if few else shared, "t_", "left").withColumn("p_", F.coalesce("p_", F.col("n_").cast("string")))
    cells = {(r.p_, r.n_): r.w for r in found.groupBy("p_", "n_").agg(F.sum("size_").alias("w")).collect()}
    once = {r.p_: r.w for r in held.groupBy("p_").agg(F.sum("w").alias("w")).collect()}
    rows_of = dict.fromkeys(once, 0)
    for (p, _), w in cells.items():
        rows_of[p] += w
    longest = max((-(-REPEATS * rows_of[p] // u) for p, u in once.items() if u), default=0)
    levels = [{p: n * u for p, u in once.items()} for n, _ in steps(longest)]
    sent = route(levels, {k: REPEATS * w for k, w in cells.items()}, {i: int(t + 0.5) for i, t in enumerate(goal)})
    number = {k: g for g, k in enumerate(sorted(cells))}
    lookup = spark.createDataFrame([(*k, g) for k, g in number.items()], "p_ string, n_ int, g_ int")
    dealt = found.join(F.broadcast(lookup), ["p_", "n_"]).withColumn("o_", seeded_order(F.col("id_"))).drop("t_", "p_", "n_")
    if not few:  # else it is no dearer than a scan
        dealt = stored(dealt, rows, held)
    got = _dealt(dealt, "size_", {g: (cells[k], sent[k]) for k, g in number.items()})
    return got.select(F.col("id_").alias(id_col), *keep, F.col("source_").alias(source_col), F.col("size_").alias("size"), "source_size", "target", "taken")
