"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints: 64 bits, each the majority of the XXH64 values of a text's word shingles. Rows with
one fingerprint are one node. Nodes are dealt to buckets by parts of the fingerprint on which any
two within the radius must agree (so no link is lost), and within a bucket, or a pair of blocks of
a large one, all are compared at once: bit planes are stored vertically, 64 fingerprints to a word,
distances are kept in bitwise carry-save counters, and a block of comparisons (one fingerprint with
64 others) is abandoned once every distance in it exceeds the radius.

Null and empty texts have the fingerprint 0 and are linked like any other. Repeated rows are linked
to each other. A row whose id is null takes the component of its fingerprint, but gives it no name.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components, forest, in_blocks, runs
from .util import in_pieces, map_batches, spread, stored, utf8

SHINGLE = 4
RADIUS = 4
SEED = 42


_byte = np.arange(256)
_LOWER = np.where((_byte >= 65) & (_byte <= 90), _byte + 32, _byte).astype(np.uint8)
_WHITE = (_byte == 32) | (_byte >= 9) & (_byte <= 13)
#: Bytes of texts, and shingles, that are worked on together.
_PIECE, _TOGETHER = 1 << 20, 1 << 16
#: XXH64's multipliers.
P1, P2, P3, P4, P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return x << np.uint64(by) | x >> np.uint64(64 - by)


def xxh64(raw: np.ndarray, start: np.ndarray, size: np.ndarray, seed: int = SEED) -> np.ndarray:
    """XXH64 of many ranges of raw (uint8) at once."""
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    eight, four = (np.ndarray(len(padded) - 7, t, padded, strides=(1,)) for t in ("<u8", "<u4"))
    at, stripes = start.copy(), size >> 5
    h = np.full(len(start), (seed + int(P5)) % (1 << 64), np.uint64)
    live = np.flatnonzero(stripes)
    if len(live):
        lanes = [np.full(len(live), v % (1 << 64), np.uint64) for v in (seed + int(P1) + int(P2), seed + int(P2), seed, seed - int(P1))]
        todo, of = stripes[live], np.arange(len(live))
        while len(of):
            for k, v in enumerate(lanes):
                v[of] = _turned(v[of] + eight[at[live[of]] + 8 * k] * P2, 31) * P1
            at[live[of]] += 32
            todo[of] -= 1
            of = of[todo[of] > 0]
        got = sum(_turned(v, r) for v, r in zip(lanes, (1, 7, 12, 18)))
        for v in lanes:
            got = (got ^ _turned(v * P2, 31) * P1) * P1 + P4
        h[live] = got
    h += size.astype(np.uint64)
    rest = size & 31
    for _ in range(3):
        k = np.flatnonzero(rest >= 8)
        h[k] = _turned(h[k] ^ _turned(eight[at[k]] * P2, 31) * P1, 27) * P1 + P4
        at[k] += 8
        rest[k] -= 8
    k = np.flatnonzero(rest >= 4)
    h[k] = _turned(h[k] ^ four[at[k]].astype(np.uint64) * P1, 23) * P2 + P3
    at[k] += 4
    rest[k] -= 4
    for _ in range(3):
        k = np.flatnonzero(rest > 0)
        h[k] = _turned(h[k] ^ padded[at[k]].astype(np.uint64) * P5, 11) * P1
        at[k] += 1
        rest[k] -= 1
    h = (h ^ h >> np.uint64(33)) * P2
    h = (h ^ h >> np.uint64(29)) * P3
    return h ^ h >> np.uint64(32)


def shingles(raw: np.ndarray, off: np.ndarray, words: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts in UTF-8: their words in lower case (A-Z), one blank apart; each shingle's start, size and text."""
    n = len(raw)
    if not n:
        return raw, *(np.zeros(0, np.int64),) * 3
    white = _WHITE[raw]
    first = np.zeros(n + 1, bool)
    first[off] = True  # of a text, or the end
    inside = np.concatenate([[False], ~white, [False]])
    start = np.flatnonzero(inside[1:-1] & (~inside[:-2] | first[:-1]))
    end = np.flatnonzero(inside[1:-1] & (~inside[2:] | first[1:])) + 1
    keep = ~white
    after = end[~first[end]]  # each is white: one blank after a word stays
    keep[after] = True
    size, blank = end - start, ~first[end]
    joined = np.where(white, 32, _LOWER[raw])[keep].astype(np.uint8)
    place = np.cumsum(size + blank) - size - blank
    text = np.searchsorted(off, start, "right") - 1
    held = np.bincount(text, minlength=len(off) - 1)
    begun = np.cumsum(held) - held
    many = np.where(held, np.maximum(1, held - words + 1), 0)
    a = spread(begun, many)
    b = np.minimum(a + words - 1, np.repeat(begun + held - 1, many))
    return joined, place[a], place[b] + size[b] - place[a], np.repeat(np.arange(len(held)), many)


def votes(h: np.ndarray, text: np.ndarray, texts: int) -> np.ndarray:
    """texts x 64: how many of each text's values (``text`` rises) have the bit. Eight bits are summed in the bytes of one word."""
    out = np.zeros((texts, 64), np.int64)
    new = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]])) if len(text) else text
    row = np.arange(len(text)) - np.repeat(new, np.diff(np.append(new, len(text))))
    begun = np.flatnonzero(row % 255 == 0)  # a byte's sum stays below 256
    runs_ = np.searchsorted(begun, new)
    for k in range(8 if len(text) else 0):
        lanes = np.add.reduceat(h >> np.uint64(k) & np.uint64(0x0101010101010101), begun).astype("<u8")
        out[text[new], k::8] += np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), runs_)
    return out


def fingerprints_of(raw: np.ndarray, off: np.ndarray, words: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """The fingerprints of texts in UTF-8 (uint64)."""
    out = np.zeros(len(off) - 1, np.uint64)
    for i, j in in_pieces(off, _PIECE):
        joined, start, size, text = shingles(raw[off[i] : off[j]], off[i : j + 1] - off[i], words)
        total = np.zeros((j - i, 64), np.int64)
        for k in range(0, len(start), _TOGETHER):
            s = slice(k, k + _TOGETHER)
            a, z = text[s][0], text[s][-1] + 1
            low, high = start[s][0], start[s][-1] + size[s][-1]
            total[a:z] += votes(xxh64(joined[low:high], start[s] - low, size[s], seed), text[s] - a, z - a)
        most = np.bincount(text, minlength=j - i)[:, None]
        out[i:j] = np.packbits(total * 2 > most, axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(df: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` plus fp, the fingerprint as a signed long."""

    def run(batches: Iterator[list[pa.Array]]) -> Iterator[list[pa.Array]]:
        for (texts,) in batches:
            yield [pa.array(fingerprints_of(*utf8(texts)).view(np.int64))]

    return map_batches(df, keep, [text_col], "fp long", run)


def bands(n: int, radius: int = RADIUS, most: int = 2048) -> list[int]:
    """Masks of which two fingerprints within the radius agree on one at least.

    64 bits are cut into radius + m parts and each choice of m parts is a mask; m is the least for
    which a bucket holds ``most`` of n evenly spread fingerprints or fewer.
    """
    for m in range(1, 64 - radius):
        parts = [[*x] for x in np.array_split(np.arange(64), radius + m)]
        least = min(sum(map(len, c)) for c in combinations(parts, m))
        if n / 2**least <= most or m == 8:
            return [sum(1 << int(b) for part in c for b in part) for c in combinations(parts, m)]
    raise ValueError("radius too large")


_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def close(query: np.ndarray, base: np.ndarray, radius: int, own: bool = False, tally: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (query, base) of fingerprints at ``radius`` or fewer differing bits, bit-sliced.

    A block is one query against 64 fingerprints, a word of each bit plane. Every eight planes, blocks
    in which all distances exceed the radius are abandoned. With ``own``, query and base are the same,
    and a pair is compared once, the smaller index first. ``tally``: blocks begun and blocks abandoned
    before the last plane are added to it.
    """
    n, words = len(base), -(-len(base) // 64)
    empty = np.zeros(0, np.int64)
    if not n or not len(query):
        return empty, empty
    bits = np.zeros((64, words * 64), np.uint8)
    bits[:, :n] = np.unpackbits(base.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").T
    planes = np.packbits(bits, axis=1, bitorder="little").view("<u8")  # 64 bits by words of 64 fingerprints
    asked = np.unpackbits(query.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").T
    masks = np.where(asked == 1, _ALL, np.uint64(0))  # 64 by queries
    apart = np.bitwise_or.reduce(base ^ base[0]) | np.bitwise_or.reduce(query ^ base[0])
    varied = [k for k in range(64) if int(apart) >> k & 1]  # planes in which not all agree
    levels = max(1, int(radius).bit_length())
    beyond = np.zeros(words, np.uint64)
    if n % 64:
        beyond[-1] = _ALL << np.uint64(n % 64)  # lanes that hold nothing
    out_q, out_b = [], []
    step = max(1, (1 << 15) // words)
    for at in range(0, len(query), step):
        some = np.arange(at, min(at + step, len(query)))
        from_ = some // 64 if own else some * 0
        q, w = np.repeat(some, words - from_), spread(from_, words - from_)
        over = beyond[w]
        if own:
            here = w == q // 64
            over[here] |= _ALL >> (np.uint64(63) - (q[here] % 64).astype(np.uint64))  # itself and those before it
        count = [np.zeros(len(q), np.uint64) for _ in range(levels)]
        begun = len(q)
        for i in range(0, len(varied), 2):
            x = planes[varied[i]][w] ^ masks[varied[i]][q]
            u = count[0] ^ x
            if i + 1 < len(varied):
                y = planes[varied[i + 1]][w] ^ masks[varied[i + 1]][q]
                carry = count[0] & x | u & y  # two planes and the counter's ones: a full adder
                count[0] = u ^ y
            else:
                carry, count[0] = count[0] & x, u
            for level in range(1, levels):
                count[level], carry = count[level] ^ carry, count[level] & carry
            over |= carry
            if i % 8 == 6:
                live = np.flatnonzero(_exceeds(count, over, radius) != _ALL)
                if len(live) < len(q):
                    q, w, over, count = q[live], w[live], over[live], [c[live] for c in count]
                if not len(q):
                    break
        if tally is not None:
            tally[0] += begun
            tally[1] += begun - len(q)
        near = ~_exceeds(count, over, radius)
        found = np.flatnonzero(near)
        if len(found):
            lanes = np.unpackbits(near[found].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            i, lane = np.nonzero(lanes)
            out_q.append(q[found[i]])
            out_b.append(w[found[i]] * 64 + lane)
    return (np.concatenate(out_q), np.concatenate(out_b)) if out_q else (empty, empty)


def _exceeds(count: list[np.ndarray], over: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose counter is above the radius: the bitwise comparison with a constant."""
    above, equal = over.copy(), ~over
    for level in range(len(count) - 1, -1, -1):
        if radius >> level & 1:
            equal &= count[level]
        else:
            above |= equal & count[level]
            equal &= ~count[level]
    return above


def links(nodes: DataFrame, n: int, radius: int = RADIUS) -> DataFrame:
    """Edges (a, b) of node ids that join all nodes linked within the radius, a forest for each block.

    ``nodes``: node long, fp long, each fp once; n: how many there are.
    """
    masks = bands(n, radius)
    keyed = nodes.select(
        "node", "fp",
        F.explode(F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m)).alias("key")) for i, m in enumerate(masks)])).alias("x"),
    ).select("node", "fp", "x.t", "x.key")
    dealt = in_blocks(keyed, ["t", "key"], "fp").select("key", "t", "ci", "cj", "own", "node", "fp")
    dealt = dealt.repartition("key", "t", "ci", "cj").sortWithinPartitions("key", "t", "ci", "cj", "own")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, held = [], [], 0
        for group in runs(batches, 4):
            if group.num_rows < 2:
                continue
            own, node, fp = (group.column(c).to_numpy() for c in ("own", "node", "fp"))
            fp = fp.view(np.uint64)
            if group.column("ci")[0].as_py() == group.column("cj")[0].as_py():
                i, j = close(fp, fp, radius, own=True)
            else:
                split = int(np.searchsorted(own, group.column("cj")[0].as_py()))
                i, j = close(fp[:split], fp[split:], radius)
                j = j + split
            child, root = forest(len(fp), i, j)
            a.append(node[child])
            b.append(node[root])
            held += len(child)
            if held > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])
                a, b, held = [], [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """Per row of df: its id, fp (signed long), fingerprint (16 hex digits) and component_id."""
    prints = stored(fingerprints(df, [id_col], text_col))
    nodes = stored(prints.groupBy("fp").agg(F.min(id_col).alias("node")).filter("node is not null"))
    joined = components(links(nodes, nodes.count(), radius))
    classes = nodes.join(joined, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    out = prints.join(classes, "fp", "left")
    return out.select(id_col, "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
