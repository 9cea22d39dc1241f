"""Operators that call a model: embedding, tagging, translation, headlines.

Each takes the model as a function of plain Python values, called in Arrow batches on the workers; the
defaults are deterministic stand-ins that need no network. A model that must be loaded first is a
function that loads it when it is first called in a worker process.

Null and empty texts get what each function says; repeated rows are worked on each for itself.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Params
from ..functions import jsons, text

Encoder = Callable[[Sequence[str]], np.ndarray]
Summariser = Callable[[str], str]
Translator = Callable[[Sequence[str]], Sequence[str]]
Tagger = Callable[[Sequence[str]], Sequence[Sequence[tuple[str, str]]]]

WIDTH = 64


#: By (n, d), what n-grams of Latin-1 vote (a dimension + 1, negative for a vote against; 0 while it is not known), and others by their text.
_VOTES: dict[tuple[int, int], tuple[np.ndarray, dict[str, int]]] = {}
#: Of the others, so many are kept in a Python worker.
KEPT = 300_000


def _vote(gram: str, d: int) -> int:
    h = int.from_bytes(hashlib.blake2b(gram.encode(), digest_size=8).digest(), "little")
    return h % d + 1 if h >> 63 else -(h % d + 1)


def hashed_ngrams(texts: Sequence[str], n: int = 3, d: int = WIDTH) -> np.ndarray:
    """Stand-in for an encoder: signed counts of hashed character n-grams, of length 1; zeros for a text without any.

    Grams are hashed once in a Python worker, not wherever they occur.
    """
    direct = n <= 3 and d < 1 << 14
    if (n, d) not in _VOTES:
        _VOTES[n, d] = np.zeros(256**n if direct else 0, np.int16), {}
    table, kept = _VOTES[n, d]
    out = np.zeros((len(texts), d))
    for i, t in enumerate(texts):
        if len(t) < n:
            continue
        try:
            raw = t.encode("latin-1") if direct else None
        except UnicodeEncodeError:
            raw = None
        if raw is not None:
            cp = np.frombuffer(raw, np.uint8).astype(np.int32)
            code = np.zeros(len(cp) - n + 1, np.int32)
            for k in range(n):
                code = code << 8 | cp[k : len(cp) - n + 1 + k]
            votes = table[code]
            if not votes.all():
                for c in np.unique(code[votes == 0]).tolist():
                    table[c] = _vote("".join(chr(c >> 8 * (n - 1 - k) & 255) for k in range(n)), d)
                votes = table[code]
            at = np.bincount(np.where(votes > 0, votes - 1, d - 1 - votes), minlength=2 * d)
            out[i] = at[:d] - at[d:]
        else:
            if len(kept) > KEPT:
                kept.clear()
            for g, count in Counter(t[k : k + n] for k in range(len(t) - n + 1)).items():
                v = kept.get(g) or kept.setdefault(g, _vote(g, d))
                out[i, abs(v) - 1] += count if v > 0 else -count
    return out / np.maximum(np.sqrt((out * out).sum(1)), 1e-12)[:, None]


def pooled(vectors: np.ndarray) -> np.ndarray:
    """The mean of a text's chunks, of length 1; zeros stay zeros."""
    mean = vectors.mean(0)
    length = float(np.sqrt(mean @ mean))
    return mean / length if length > 1e-12 else np.zeros_like(mean)


def embedding(c: Column, encoder: Encoder = hashed_ngrams, chunks: Callable[[str | None], list[str]] | None = None, p: Params = Params()) -> Column:
    """array<double>: the text cut into chunks, each encoded, their mean of length 1. Null for a text without a chunk.

    All chunks of a batch of rows are encoded together.
    """
    budget = p.embed_max_chars

    @F.pandas_udf("array<double>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            parts = [chunks(t) if chunks else text.chunk_by_chars(t, budget) for t in texts]
            flat = [x for own in parts for x in own]
            vectors = encoder(flat) if flat else np.zeros((0, 1))
            cut = np.cumsum([0, *map(len, parts)])
            yield pd.Series([pooled(vectors[a:b]) if b > a else None for a, b in zip(cut[:-1], cut[1:])])

    return of(c)


def tagged(articles: DataFrame, tagger: Tagger, column: str = "content") -> DataFrame:
    """(id, pos, text, label) of what a tagger finds, texts in normal form, lower case and trimmed."""
    import unicodedata

    @F.pandas_udf("array<struct<text:string,label:string>>")
    def of(texts: pd.Series) -> pd.Series:
        found = tagger([t or "" for t in texts])
        return pd.Series([[{"text": unicodedata.normalize("NFKC", s).strip().lower(), "label": label} for s, label in own] for own in found])

    return articles.select("id", F.posexplode(of(column)).alias("pos", "e")).select("id", "pos", "e.text", "e.label")


def translated(c: Column, translator: Translator, limit: int = 448, together: int = 8) -> Column:
    """A text cut into clauses, packed into chunks of up to ``limit`` characters, translated ``together`` at a time, and put together again in order. Null stays null."""

    @F.pandas_udf("string")
    def of(texts: pd.Series) -> pd.Series:
        parts = [text.pack(text.clauses(t), limit) for t in texts]
        flat = [x for own in parts for x in own]
        done = [y for i in range(0, len(flat), together) for y in translator(flat[i : i + together])]
        cut = np.cumsum([0, *map(len, parts)])
        return pd.Series([None if t is None else " ".join(done[a:b]) for t, a, b in zip(texts, cut[:-1], cut[1:])])

    return of(c)


def upper(chunks: Sequence[str]) -> list[str]:
    """Stand-in for a translator."""
    return [x.upper() for x in chunks]


def extract(articles: str) -> str:
    """Stand-in for a language model: an answer made of the first title and the first sentences."""
    import json

    lines = [x for x in articles.replace("【標題】", "").replace("【內文】", "\n").splitlines() if x.strip()]
    sentences = [x for line in lines[1:] for x in text.SENTENCE_END.split(line) if x]
    return json.dumps({"headline": lines[0][:60] if lines else "", "summary": " ".join(sentences[:2])[:200], "question": f"{lines[0][:40]}?" if lines else ""}, ensure_ascii=False)


def headlines(stories: DataFrame, summariser: Summariser = extract) -> DataFrame:
    """(cluster_id, ok, headline, summary, question, err) of each story. ``stories``: cluster_id, articles (the text to be summed up).

    An answer is mended if it is no JSON object; a call that fails gives ok = false and its message, and
    costs no other story.
    """
    kind = stories.schema["cluster_id"].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in frames:
            out = []
            for name, articles in zip(rows["cluster_id"], rows["articles"]):
                try:
                    got = jsons.repair(summariser(articles or ""))
                    out.append((name, True, *(got[k] for k in jsons.FIELDS), None))
                except Exception as e:  # whatever a model raises is the story's, not the job's
                    out.append((name, False, None, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["cluster_id", "ok", *jsons.FIELDS, "err"])

    return stories.select("cluster_id", "articles").mapInPandas(run, f"cluster_id {kind}, ok boolean, headline string, summary string, question string, err string")


def story_texts(central: DataFrame, articles: DataFrame) -> DataFrame:
    """(cluster_id, articles): the central articles of each story in order, each cut to its first 2,000 characters, a blank line apart."""
    own = central.join(articles.select("id", "title", "content"), "id").select("cluster_id", "rank", text.article_for_llm(F.col("title"), F.col("content")).alias("t"))
    ordered = F.array_sort(F.collect_list(F.struct("rank", "t")))
    return own.groupBy("cluster_id").agg(F.array_join(F.transform(ordered, lambda x: x.t), "\n\n").alias("articles"))
