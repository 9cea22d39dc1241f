"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are the 1- to 3-grams of a text's characters (lower case; every run position that is not a
letter counts as one blank), hashed into a table, weighted (1 + log tf) * idf and scaled to length 1.
Document frequencies are counted over all rows to learn from. The regression is trained with
follow-the-regularised-leader (per-coordinate steps) under an elastic-net penalty, then calibrated
by a temperature on a held-back part of the sample.

A text that is null or has no letter is ``und`` with score 0; so is every text where nothing could
be learned. Rows with a null language, and held-out rows, teach nothing.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .util import held_out, in_one_task, in_pieces, map_batches, small_batches, utf8

#: log2 of the size of the feature table.
TABLE_BITS = 15
SIZE = 1 << TABLE_BITS
#: Characters of the longest n-gram.
LONGEST = 3
#: The regression is fitted on at most about this many rows of all languages together, drawn by a hash of the id.
SAMPLE_ROWS = 6000
#: ... and this many bytes of their text.
SAMPLE_BYTES = 24 << 20
UNKNOWN = "und"

_PIECE = 256 << 10


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """For the characters below 65536: is it a letter; its lower case, or a blank if it is no letter."""
    letter = np.array([unicodedata.category(chr(c))[0] == "L" for c in range(65536)])
    lower = np.arange(65536, dtype=np.uint32)
    for c in np.flatnonzero(letter[:0x600]):
        small = chr(c).lower()
        if len(small) == 1:
            lower[c] = ord(small)
    lower[~letter] = 32
    return letter, lower


_cache: list = []


def characters(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(characters as features see them, offsets in characters, does each text hold a letter)."""
    if not _cache:
        _cache.extend(_tables())
    letter, lower = _cache
    cp = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le", "surrogatepass"), np.uint32)
    at = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])[off]
    low = cp < 65536
    if low.all():
        out, is_letter = lower[cp], letter[cp]
    else:
        far = np.array([chr(c).isalpha() for c in np.unique(cp[~low])])
        out, is_letter = cp.copy(), np.zeros(len(cp), bool)
        out[low], is_letter[low] = lower[cp[low]], letter[cp[low]]
        _, which = np.unique(cp[~low], return_inverse=True)
        is_letter[~low] = far[which]
        out[~is_letter] = 32
    any_letter = np.diff(np.concatenate([[0], np.cumsum(is_letter)])[at]) > 0
    return out, at, any_letter


def counts(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The n-grams that occur: (text, slot, how often), sorted by text and slot; and for each text whether it holds a letter."""
    cp, at, any_letter = characters(raw, off)
    row = np.repeat(np.arange(len(off) - 1, dtype=np.int64) << TABLE_BITS, np.diff(at))
    c, h, found = cp.astype(np.uint64), np.zeros(len(cp), np.uint64), []
    for k in range(min(LONGEST, len(c))):
        h = h[: len(c) - k] * np.uint64(0x100000001B3) + c[k:] + np.uint64(1)
        slot = ((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
        here = row[: len(slot)]
        found.append((here | slot)[here == row[k:]])  # without those that run into the next text
    keys = np.sort(np.concatenate(found)) if found else row
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else keys
    return keys[first] >> TABLE_BITS, keys[first] & SIZE - 1, np.diff(np.append(first, len(keys))), any_letter


def weighted(row: np.ndarray, slot: np.ndarray, n: np.ndarray, idf: np.ndarray, texts: int) -> np.ndarray:
    """The TF-IDF values of n-grams, each text's scaled to length 1."""
    value = (1 + np.log(n)) * idf[slot]
    norm = np.sqrt(np.bincount(row, value * value, texts))
    return value / np.maximum(norm, 1e-12)[row]


@dataclass
class Model:
    languages: list[str] = field(default_factory=list)
    weights: np.ndarray | None = None
    bias: np.ndarray | None = None
    idf: np.ndarray | None = None
    temperature: float = 1.0

    def logits(self, row: np.ndarray, slot: np.ndarray, n: np.ndarray, texts: int) -> np.ndarray:
        value = weighted(row, slot, n, self.idf, texts)
        return np.stack([np.bincount(row, value * self.weights[slot, k], texts) + self.bias[k] for k in range(len(self.languages))], 1)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def ftrl(x: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, k: int, rounds: int = 3, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.05, l2: float = 0.01) -> tuple[np.ndarray, np.ndarray]:
    """Follow-the-regularised-leader over sparse rows; the last coordinate, the bias, bears no L1."""
    z, n = np.zeros((SIZE + 1, k)), np.zeros((SIZE + 1, k))
    order = np.random.default_rng(0)

    def leader(cols: np.ndarray) -> np.ndarray:
        zc = z[cols]
        penalty = np.where(cols == SIZE, 0.0, l1)[:, None]
        return -np.sign(zc) * np.maximum(0, np.abs(zc) - penalty) / ((beta + np.sqrt(n[cols])) / alpha + l2)

    for _ in range(rounds):
        for i in order.permutation(len(x)):
            cols, v = x[i]
            w = leader(cols)
            p = softmax(v @ w)
            p[y[i]] -= 1
            g = v[:, None] * p
            step = (np.sqrt(n[cols] + g * g) - np.sqrt(n[cols])) / alpha
            z[cols] += g - step * w
            n[cols] += g * g
    w = leader(np.arange(SIZE + 1))
    return w[:-1], w[-1]


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learns from rows that are not held out and have a language.

    Document frequencies cover all of them; the regression is trained on the sample in one task of an
    executor, and its weights other than 0 come back.
    """
    small_batches(docs.sparkSession)
    draw = F.pmod(F.xxhash64(F.col(id_col), F.lit("language")), F.lit(1 << 30)) / float(1 << 30)
    rows = docs.filter(~held_out(id_col) & F.col(lang_col).isNotNull()).select(
        F.col(id_col).cast("string").alias("i"), F.col(text_col).alias("t"), F.col(lang_col).cast("string").alias("l"), draw.alias("d")
    )
    sizes = {r.l: (r.n, r.b) for r in rows.groupBy("l").agg(F.count("*").alias("n"), F.sum(F.octet_length(F.coalesce("t", F.lit("")))).alias("b")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model()
    idf = _idf(rows, sum(n for n, _ in sizes.values()))
    each, each_bytes = max(1, SAMPLE_ROWS // len(languages)), SAMPLE_BYTES // len(languages)
    share = {l: min(1.0, each / n, each_bytes / max(1, b)) for l, (n, b) in sizes.items()}
    shares = F.create_map(*[F.lit(x) for l in languages for x in (l, share[l])])
    chosen = rows.filter(F.col("d") < F.element_at(shares, F.col("l"))).select("l", "d", "i", "t")

    def learn(sample: pa.Table) -> pa.RecordBatch:
        sample = sample.sort_by([("d", "ascending"), ("i", "ascending"), ("t", "ascending")])
        number = {l: i for i, l in enumerate(languages)}
        y, x = np.array([number[l] for l in sample.column("l").to_pylist()], int), []
        for part in sample.column("t").chunks:
            raw, off = utf8(part)
            for i, j in in_pieces(off, _PIECE):
                row, slot, n, _ = counts(raw[off[i] : off[j]], off[i : j + 1] - off[i])
                value = weighted(row, slot, n, idf, j - i)
                cut = np.searchsorted(row, np.arange(j - i + 1))
                x += [(np.append(slot[a:b], SIZE), np.append(value[a:b], 1.0)) for a, b in zip(cut[:-1], cut[1:])]
        held = np.arange(len(x)) % 5 == 4 if len(x) >= 20 else np.zeros(len(x), bool)
        w, bias = ftrl([a for a, h in zip(x, held) if not h], y[~held], len(languages))
        slot, k = np.nonzero(w)
        t = calibrate(np.stack([v[:-1] @ w[c[:-1]] + bias for (c, v), h in zip(x, held) if h]), y[held]) if held.any() else 1.0
        many = np.arange(len(languages))
        found = np.concatenate([slot, many * 0 + SIZE, [SIZE + 1]]), np.concatenate([k, many, [0]]), np.concatenate([w[slot, k], bias, [t]])
        return pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1]), pa.array(found[2])], names=["slot", "k", "w"])

    slot, k, w = (c.to_numpy() for c in in_one_task(chosen, "slot long, k long, w double", learn).columns)
    if not len(slot):
        return Model()
    dense = np.zeros((SIZE + 2, len(languages)))
    dense[slot, k] = w
    return Model(languages, dense[:SIZE].astype(np.float32), dense[SIZE], idf, float(dense[SIZE + 1, 0]))


def calibrate(z: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss, from 1/20 to 20."""
    grid = np.exp(np.linspace(-3, 3, 121))
    loss = [-np.log(np.maximum(softmax(z / t)[np.arange(len(y)), y], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def _idf(rows: DataFrame, n: int) -> np.ndarray:
    """Smoothed inverse document frequencies over all rows; partitions send one count for each slot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SIZE, np.int64)
        for b in batches:
            raw, off = utf8(b.column(0))
            for i, j in in_pieces(off, _PIECE):
                _, slot, _, _ = counts(raw[off[i] : off[j]], off[i : j + 1] - off[i])
                total += np.bincount(slot, minlength=SIZE)
        slot = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int32)), pa.array(total[slot])], names=["slot", "n"])

    got = rows.select("t").mapInArrow(run, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    df = np.zeros(SIZE)
    df[got.column("slot").to_numpy()] = got.column("n").to_numpy()
    return (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)


def predict_texts(model: Model, raw: np.ndarray, off: np.ndarray) -> tuple[list[str], np.ndarray]:
    names, scores = [UNKNOWN] * (len(off) - 1), np.zeros(len(off) - 1)
    for i, j in in_pieces(off, _PIECE):
        if not model.languages:
            continue
        *found, letters = counts(raw[off[i] : off[j]], off[i : j + 1] - off[i])
        p = softmax(model.logits(*found, j - i) / model.temperature)
        best = p.argmax(1)
        for k in np.flatnonzero(letters):
            names[i + k], scores[i + k] = model.languages[best[k]], p[k, best[k]]
    return names, scores


def predict(df: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` plus lang_pred and score (the calibrated probability of it)."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # the feature table's size is fixed

    def run(batches: Iterator[list[pa.Array]]) -> Iterator[list[pa.Array]]:
        for (texts,) in batches:
            names, scores = predict_texts(shared.value, *utf8(texts))
            yield [pa.array(names, pa.string()), pa.array(np.clip(scores, 0, 1))]

    return map_batches(df, keep, [text_col], "lang_pred string, score double", run)
