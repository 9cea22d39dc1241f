"""URL filters: host and path rules, and a character language-model ratio for all other pages.

Two variable-order Markov models of the characters of host and path are trained, one on the URLs
that the rules allow, one on those they block. Each order is smoothed by the one below it in
proportion to the number of different characters that followed the context. A URL's score is the
difference of the two log-likelihoods a character; it is allowed from the threshold on that parts a
held-back fifth of the ruled URLs best.

Counts cover all ruled URLs, and all counts are kept, at every size. They stay distributed: pages are
read in batches of about TOGETHER characters, and each batch is joined to the counts of the contexts
that occur in it, so that no worker holds a whole model. A null URL, or one without ``://``, has an empty host and path, which is text to the models
like any other. If a class has no URL, everything without a rule is allowed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .util import ascii_lower, map_batches, small_batches, stored, utf8

#: Fixed values: (verdict, host, path). A rule fits its host and all below it, and paths that begin with its own.
RULES = (
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
)
#: Longest context; characters that are counted or scored at a time.
ORDER = 5
TOGETHER = 1 << 18
_BASE, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path)."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.coalesce(F.when(at > 0, url.substr(at + 3, F.length(url))), F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def ruled(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; nulls where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):  # a longer one replaces a shorter one
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def grams(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(orders + 1) x characters keys of contexts and of contexts with the next character, and each character's text.

    Every text is read with ORDER marks before it and one after it.
    """
    n = len(off) - 1
    size = np.diff(off)
    start = np.arange(n) * (ORDER + 1) + off[:-1] + ORDER
    padded = np.full(len(raw) + n * (ORDER + 1), 256, np.uint64)
    padded[np.repeat(start - off[:-1], size) + np.arange(len(raw))] = raw
    padded[start + size] = 257
    here = np.repeat(start - np.concatenate([[0], np.cumsum(size + 1)[:-1]]), size + 1) + np.arange(len(raw) + n)
    contexts, nexts = np.empty((ORDER + 1, len(here)), np.uint64), np.empty((ORDER + 1, len(here)), np.uint64)
    h, power = np.zeros(len(here), np.uint64), np.uint64(1)
    with np.errstate(over="ignore"):
        for k in range(ORDER + 1):
            if k:
                power = power * _BASE
                h = h + (padded[here - k] + np.uint64(1)) * power
            c = (h ^ h >> np.uint64(29)) * _MIX + np.uint64(k)
            contexts[k] = c ^ c >> np.uint64(32)
            g = (contexts[k] + padded[here] * _BASE) * _MIX
            nexts[k] = g ^ g >> np.uint64(31)
    return contexts, nexts, np.repeat(np.arange(n), size + 1)


@dataclass
class Model:
    """Of some contexts: sorted keys with counts of continuations; of contexts with their counts and numbers of continuations."""

    gram: np.ndarray
    gram_n: np.ndarray
    context: np.ndarray
    context_n: np.ndarray
    kinds: np.ndarray

    def log_likelihood(self, contexts: np.ndarray, nexts: np.ndarray) -> np.ndarray:
        p = np.full(contexts.shape[1], 1 / 257)
        for c, g in zip(contexts, nexts):
            n, kinds = _found(self.context, c, self.context_n), _found(self.context, c, self.kinds)
            seen = _found(self.gram, g, self.gram_n)
            p = np.where(n > 0, (seen + kinds * p) / np.maximum(n + kinds, 1), p)
        return np.log(p)


def _found(keys: np.ndarray, wanted: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(wanted))
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0).astype(float)


@dataclass
class Counts:
    """All counts of a verdict, distributed: each context with its continuations and how often each verdict has them."""

    frame: DataFrame
    verdict: str

    def log_likelihood(self, contexts: np.ndarray, nexts: np.ndarray) -> np.ndarray:
        """Of a few characters; pages are scored by ``score``."""
        wanted = self.frame.sparkSession.createDataFrame([(int(c),) for c in np.unique(contexts).view(np.int64)], "context long")
        return _model(self.frame.join(wanted, "context").select("context", "nexts").toArrow(), self.verdict).log_likelihood(contexts, nexts)


def _model(found: pa.Table, verdict: str) -> Model:
    lists = found.column("nexts").combine_chunks()
    of = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64))
    each = lists.flatten()
    n = each.field(verdict).to_numpy()
    seen = n > 0
    keys = each.field("gram").to_numpy().view(np.uint64)[seen], found.column("context").to_numpy().view(np.uint64)
    by = [np.argsort(k) for k in keys]
    counts = np.bincount(of, n, len(lists)), np.bincount(of[seen], minlength=len(lists))
    return Model(keys[0][by[0]], n[seen][by[0]], keys[1][by[1]], counts[0][by[1]], counts[1][by[1]])


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of some batches with about TOGETHER characters of ``text``."""
    waiting, size = [], 0
    for b in batches:
        waiting.append(b)
        size += (pc.sum(pc.binary_length(b.column("text"))).as_py() or 0) + b.num_rows
        if size >= TOGETHER:
            yield pa.Table.from_batches(waiting).combine_chunks()
            waiting, size = [], 0
    if size:
        yield pa.Table.from_batches(waiting).combine_chunks()


def train(texts: DataFrame) -> dict[str, Counts]:
    """``texts``: text and verdict. The counts of each verdict; none where a verdict has no text."""
    small_batches(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _gathered(batches):
            contexts, nexts, row = grams(*utf8(t.column("text").chunk(0)))
            blocked = pc.equal(t.column("verdict"), "block").to_numpy()[row]
            key, first, of, n = np.unique(nexts.ravel(), return_index=True, return_inverse=True, return_counts=True)
            block = np.bincount(of.ravel(), np.tile(blocked, ORDER + 1), len(key)).astype(np.int64)
            found = [contexts.ravel()[first].view(np.int64), key.view(np.int64), n - block, block]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["context", "gram", "allow", "block"])

    verdicts = [r.verdict for r in texts.select("verdict").distinct().collect()]
    counted = texts.select("text", "verdict").mapInArrow(run, "context long, gram long, allow long, block long")
    counted = counted.groupBy("context", "gram").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"))
    frame = counted.groupBy("context").agg(F.collect_list(F.struct("gram", "allow", "block")).alias("nexts"))
    return {v: Counts(frame, v) for v in verdicts}


def batched(df: DataFrame) -> DataFrame:
    """df and batch: rows with about TOGETHER characters of host and path. It must be stored before it is read twice."""

    def run(batches: Iterator[list[pa.Array]]) -> Iterator[list[pa.Array]]:
        own, end = TaskContext.get().partitionId() << 40, 0
        for texts in batches:
            ends = end + np.cumsum(sum(np.diff(utf8(x)[1]) for x in texts) + 1)
            end = int(ends[-1])
            yield [pa.array(own + ends // TOGETHER)]

    return map_batches(df, df.columns, ["host", "path"], "batch long", run)


def score(pages: DataFrame, models: dict[str, Counts]) -> DataFrame:
    """``pages``, stored with batch, plus ratio: (log-likelihood as allowed - as blocked) / characters. Needs both models."""
    small_batches(pages.sparkSession)

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _gathered(batches):
            contexts, _, row = grams(*utf8(t.column("text").chunk(0)))
            batch = t.column("batch").to_numpy()
            for b in np.unique(batch):
                keys = np.unique(contexts[:, (batch == b)[row]])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), b)), pa.array(keys.view(np.int64))], names=["batch", "context"])

    def run(mine: pa.Table, found: pa.Table) -> pa.Table:
        mine = mine.combine_chunks()
        texts = pc.binary_join_element_wise(mine.column("host"), mine.column("path"), "").combine_chunks()
        contexts, nexts, row = grams(*utf8(texts))
        diff = _model(found, "allow").log_likelihood(contexts, nexts) - _model(found, "block").log_likelihood(contexts, nexts)
        return mine.append_column("ratio", pa.array(np.bincount(row, diff, len(mine)) / np.bincount(row, minlength=len(mine))))

    keys = pages.select("batch", F.concat("host", "path").alias("text")).mapInArrow(wanted, "batch long, context long")
    found = keys.join(models["allow"].frame, "context").select("batch", "context", "nexts")
    schema = T.StructType([*pages.schema.fields, T.StructField("ratio", T.DoubleType())])
    return pages.groupBy("batch").cogroup(found.groupBy("batch")).applyInArrow(run, schema)


def threshold(scored: DataFrame) -> float:
    """The ratio that parts verdicts best, both classes weighing the same; of equal ones the nearest to 0.

    A histogram by hundredths reaches the driver.
    """
    rows = scored.groupBy("verdict", F.round(F.greatest(F.least("ratio", F.lit(50.0)), F.lit(-50.0)), 2).alias("r")).agg(F.count("*").alias("n")).collect()
    allow, block = ({r.r: r.n for r in rows if r.verdict == v} for v in ("allow", "block"))
    a, b = sum(allow.values()), sum(block.values())
    if not a or not b:
        return 0.0
    cells = sorted({*allow, *block, 0.0})
    best, below_allow, below_block = (2.0, 0.0, 0.0), 0, 0
    for c in cells:
        loss = below_allow / a + (b - below_block) / b
        best = min(best, (loss, abs(c - 0.005), c - 0.005))
        below_allow += allow.get(c, 0)
        below_block += block.get(c, 0)
    return best[2]


def judge(df: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Per row: its id, host, path, rule, verdict and ratio."""
    host, path = parts(F.col(url_col))
    pages = df.select(F.col(id_col).alias("id_"), host.alias("host"), path.alias("path"))
    rule, verdict = ruled(F.col("host"), F.col("path"))
    held = F.crc32(F.coalesce(F.col("id_").cast("string"), F.lit("")).cast("binary")) % 5 == 0
    pages = stored(batched(pages.withColumns({"rule": rule, "ruled_": verdict, "held": held})))
    models = train(pages.filter("ruled_ is not null and not held").select(F.concat("host", "path").alias("text"), F.col("ruled_").alias("verdict")))
    if len(models) == 2:
        out = stored(score(pages, models), pages)
        line = threshold(out.filter("ruled_ is not null and held").withColumn("verdict", F.col("ruled_")))
        found = F.when(F.col("ratio") >= line, "allow").otherwise("block")
    else:
        out, found = pages.withColumn("ratio", F.lit(0.0)), F.lit("allow")
    return out.select(F.col("id_").alias(id_col), "host", "path", "rule", F.coalesce("ruled_", found).alias("verdict"), "ratio")
