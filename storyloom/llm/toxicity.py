"""Toxicity by multiple-instance learning.

A text is a bag of sentences. Each sentence has the probability sigmoid(bias + sum of its words'
weights); the text's is their noisy-or, 1 - product(1 - p). Only labels of whole texts are known;
the weights are fitted to them by maximum likelihood with an L1 penalty, and then tell which
sentences offend.

Words are runs of ASCII letters, digits and non-ASCII bytes, A-Z lower-cased. A word's weight is
that of the word itself plus those of its stems, its first 3 to 6 bytes; words and stems are
hashed into a table of fixed size. Sentences end at ``. ! ?`` or a line break. A text without words (null, empty) has score 0.
A row without a label, or with a null id, teaches nothing. Without any label of either kind all
scores are 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .util import held_out, in_one_task, in_pieces, map_batches, small_batches, utf8

#: log2 of the size of the table of word weights.
TABLE_BITS = 18
#: The classifier is fitted on at most about this many labelled texts of each label, drawn by a hash of the id.
SAMPLE_PER_LABEL = 2500
#: Bytes of text of the sample of each label; of longer texts fewer are drawn.
SAMPLE_BYTES = 6 << 20
THRESHOLD = 0.3
#: A sentence's log-odds without telling words: ten thousand of them leave a text below the threshold.
QUIET = -11.0
#: Penalty of a weight, in texts.
L1 = 0.2
#: Probability from which on a sentence offends.
LEAST = 0.5

#: Bytes of the stems.
STEMS = (3, 4, 5, 6)
#: The slot that stands for no stem; its weight is 0.
NONE = 1 << TABLE_BITS

_BASE, _MIX = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_PIECE = 1 << 20
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2**64."""
    if not _powers or len(_powers[0]) < n + 1:
        size = max(_PIECE + 1, n + 1)
        _powers[:] = [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)])) for b in (_BASE, pow(_BASE, -1, 1 << 64))]
    return _powers[0], _powers[1]


_byte = np.arange(256)
_WORD = ((_byte >= 48) & (_byte <= 57)) | ((_byte | 32) >= 97) & ((_byte | 32) <= 122) & (_byte < 128) | (_byte >= 128)
_LOWER = np.where((_byte >= 65) & (_byte <= 90), _byte + 32, _byte).astype(np.uint64) + 1
_STOP = np.isin(_byte, [10, 33, 46, 63])


def words(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts in UTF-8: each word's table slots (itself, stems), start and end, and the number of its sentence.

    Sentence numbers rise from 0 over all texts; no two texts share one.
    """
    n = len(raw)
    if not n:
        return np.zeros((0, 1 + len(STEMS)), np.int64), *(np.zeros(0, np.int64),) * 3
    inside = _WORD[raw]
    first = np.zeros(n + 1, bool)
    first[off[:-1]] = True  # of a text
    before = np.concatenate([[False], inside[:-1]]) & ~first[:n]
    after = np.concatenate([inside[1:], [False]])
    after[off[1:-1][(off[1:-1] > 0) & (off[1:-1] < n)] - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    up, down = _power_tables(n)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_LOWER[raw] * up[:n])])
    slots = np.empty((len(starts), 1 + len(STEMS)), np.int64)
    for k, size in enumerate((0, *STEMS)):
        h = (sums[np.minimum(starts + size, ends) if size else ends] - sums[starts]) * down[starts] + np.uint64(k)
        h = (h ^ h >> np.uint64(31)) * np.uint64(_MIX)
        slots[:, k] = h >> np.uint64(64 - TABLE_BITS)
        if size:
            slots[ends - starts <= size, k] = NONE
    stops = _STOP[raw]
    bounds = np.cumsum(stops) - stops + np.cumsum(first[:n])
    return slots, starts, ends, bounds[starts] - 1


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def sentences(self, slot: np.ndarray, sentence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of each sentence's first word, and log(1 - p) of it."""
        at = np.flatnonzero(np.concatenate([[True], sentence[1:] != sentence[:-1]]))
        z = np.add.reduceat(self.weights[slot].sum(1), at, dtype=np.float64) + self.bias
        return at, -np.logaddexp(0, z)


def score_texts(model: Model | None, raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    return read(model, raw, off, 1.0)[0]


def read(model: Model | None, raw: np.ndarray, off: np.ndarray, least: float = LEAST) -> tuple[np.ndarray, ...]:
    """Scores, and of the sentences whose own probability is ``least`` or more: text, start and end (in its bytes), probability."""
    out, found = np.zeros(len(off) - 1), [(np.zeros(0, np.int64),) * 3 + (np.zeros(0),)]
    for i, j in in_pieces(off, _PIECE) if model is not None else ():
        o = off[i : j + 1] - off[i]
        slot, start, end, sentence = words(raw[off[i] : off[j]], o)
        if len(slot):
            at, clean = model.sentences(slot, sentence)
            text = np.searchsorted(o, start[at], "right") - 1
            out[i:j] = -np.expm1(np.bincount(text, clean, j - i))
            k = np.flatnonzero(-np.expm1(clean) >= least)
            last = np.append(at[1:], len(slot))[k] - 1
            found.append((text[k] + i, start[at[k]] - o[text[k]], end[last] - o[text[k]], -np.expm1(clean[k])))
    return out, *(np.concatenate(x) for x in zip(*found))


def train(bags: list[np.ndarray], sentences: list[np.ndarray], y: np.ndarray, rounds: int = 240, l1: float = L1, rate: float = 0.15) -> Model | None:
    """Full-gradient fit of the noisy-or likelihood, texts of both labels weighing as they occur.

    bags: slots of a text's words and stems; sentences: their sentence numbers. Those found in fewer than three
    texts keep the weight 0. Adam steps, each followed by soft thresholding with a penalty that rises to l1 (in
    texts). The bias is QUIET throughout.
    """
    if not len(y) or y.min() == y.max():
        return None
    keep = [i for i, b in enumerate(bags) if len(b)]
    bags, sentences, y = [bags[i] for i in keep], [sentences[i] for i in keep], y[keep].astype(float)
    if not len(y):
        return None
    texts_of = np.zeros(NONE + 1, np.int32)
    for b in bags:
        texts_of[np.unique(b)] += 1
    used = np.flatnonzero(texts_of[:NONE] >= 3)
    dense = np.full(NONE + 1, -1, np.int32)
    dense[used] = np.arange(len(used), dtype=np.int32)
    column, sentence, text_of, n = [], [], [], 0
    for t, (b, s) in enumerate(zip(bags, sentences)):
        number = np.cumsum(np.concatenate([[0], s[1:] != s[:-1]]))
        c = dense[b]
        column.append(c[c >= 0])
        sentence.append((number[c >= 0] + n).astype(np.int32))
        n += int(number[-1]) + 1
        text_of.append(np.full(int(number[-1]) + 1, t, np.int32))
    del bags, sentences, dense
    column, sentence, text_of = np.concatenate(column), np.concatenate(sentence), np.concatenate(text_of)
    w = np.zeros(len(used))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, rounds + 1):
        z = np.clip(np.bincount(sentence, w[column], n) + QUIET, -30, 30)
        clean, g = slope(z, text_of, y)
        g = np.bincount(column, g[sentence], len(w))
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        fix1, fix2 = 1 - 0.9**step, 1 - 0.99**step
        scale = np.sqrt(v / fix2) + 0.01
        w -= rate * (m / fix1) / scale
        w = np.sign(w) * np.maximum(0, np.abs(w) - rate * l1 * min(1.0, 0.05 + step / (0.6 * rounds)) / scale)
    weights = np.zeros(NONE + 1, np.float32)
    weights[used] = w
    return Model(weights, QUIET)


def slope(z: np.ndarray, text_of: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sentences' log-odds: the chance of each text that no sentence offends, and the loss's derivative by each z."""
    p = 1 / (1 + np.exp(-z))
    clean = np.exp(np.bincount(text_of, -np.logaddexp(0, z), len(y)))
    return clean, np.where(y > 0, -clean / np.maximum(1 - clean, 1e-9), 1.0)[text_of] * p


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model | None:
    """Trains on labelled texts that are not held out: all of them, or a sample of bounded size.

    The sample (SAMPLE_PER_LABEL, SAMPLE_BYTES) is drawn by a hash of the id for each label. If an
    id has several labels, the largest counts. The sample is trained on in one task of an executor;
    the weights other than 0 come back.
    """
    small_batches(docs.sparkSession)
    known = labels.filter(F.col(label_col).isin(0, 1)).groupBy(id_col).agg(F.max(label_col).alias("y"))
    draw = (F.pmod(F.xxhash64(F.col(id_col), F.lit("toxicity")), F.lit(1 << 30)) / float(1 << 30)).alias("draw")
    pool = docs.filter(~held_out(id_col)).select(id_col, F.octet_length(F.coalesce(text_col, F.lit(""))).alias("size")).join(known, id_col)
    counts = {r.y: (r.n, r.size) for r in pool.groupBy("y").agg(F.count("*").alias("n"), F.sum("size").alias("size")).collect()}
    if len(counts) < 2:
        return None
    share = {y: min(1.0, SAMPLE_PER_LABEL / n, SAMPLE_BYTES / max(1, size)) for y, (n, size) in counts.items()}
    chosen = known.withColumn("draw", draw).filter(F.col("draw") < F.when(F.col("y") == 1, share[1]).otherwise(share[0]))
    rows = docs.filter(~held_out(id_col)).select(id_col, text_col).join(F.broadcast(chosen), id_col).select("y", "draw", F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("t"))

    def learn(sample: pa.Table) -> pa.RecordBatch:
        sample = sample.sort_by([("draw", "ascending"), ("id", "ascending"), ("t", "ascending")])
        y, bags, sentences = sample.column("y").to_numpy().astype(int), [], []
        for part in sample.column("t").chunks:
            raw, off = utf8(part)
            for i in range(len(off) - 1):
                slot, _, _, sentence = words(raw[off[i] : off[i + 1]], np.array([0, off[i + 1] - off[i]]))
                some = slot != NONE
                bags.append(slot[some].astype(np.int32))
                sentences.append(np.repeat(sentence, some.sum(1)).astype(np.int32))
        model = train(bags, sentences, y)
        at = np.flatnonzero(model.weights) if model else np.zeros(0, np.int64)
        at = np.append(at, NONE) if model else at  # its weight is 0; says that there is a model
        return pa.RecordBatch.from_arrays([pa.array(at), pa.array(model.weights[at] if model else np.zeros(0, np.float32))], names=["slot", "weight"])

    got = in_one_task(rows, "slot long, weight float", learn)
    if not got.num_rows:
        return None
    weights = np.zeros(NONE + 1, np.float32)
    weights[got.column("slot").to_numpy()] = got.column("weight").to_numpy()
    return Model(weights, QUIET)


def score(df: DataFrame, model: Model | None, keep: list[str], text_col: str = "text", least: float = LEAST) -> DataFrame:
    """``keep`` plus score, 0 to 1, and spans, the sentences whose own probability is ``least`` or more.

    Each span has the byte range in the text from its sentence's first word's start to its last word's
    end, and its probability.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)  # the table's size is fixed
    kind = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())])

    def run(batches: Iterator[list[pa.Array]]) -> Iterator[list[pa.Array]]:
        for (texts,) in batches:
            scores, text, start, end, p = read(shared.value, *utf8(texts), least)
            cut = np.searchsorted(text, np.arange(len(texts) + 1))
            found = pa.StructArray.from_arrays([pa.array(start), pa.array(end), pa.array(p)], fields=list(kind))
            yield [pa.array(np.clip(scores, 0, 1)), pa.ListArray.from_arrays(pa.array(cut, pa.int32()), found)]

    return map_batches(df, keep, [text_col], "score double, spans array<struct<start:bigint,end:bigint,p:double>>", run)


def offending(df: DataFrame, model: Model | None, keep: list[str], text_col: str = "text", least: float = LEAST) -> DataFrame:
    """``keep`` plus spans, as ``score`` gives them."""
    return score(df, model, [k for k in keep if k != "score"], text_col, least).drop("score")
