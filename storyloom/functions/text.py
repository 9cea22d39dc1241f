"""Text functions as column expressions; the ones with running state or Unicode normalisation as plain Python."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Line beginnings of boilerplate.
BOILERPLATE = (
    "責任編輯", "责任编辑", "延伸閱讀", "延伸阅读", "更多報導", "更多报道", "來源", "来源", "綜合報導", "综合报导",
    "圖／", "圖/", "文／", "文/", "本文經授權", "本文经授权", "看更多", "相關報導", "相关新闻",
)
#: What an own report's origin may be called.
NATIVE = ("native", "original", "self", "自採", "自采", "本報", "本報自採", "本台", "自製", "自制")
_BOILERPLATE = "^(" + "|".join(BOILERPLATE) + r")\b.*"
_BEGINS = "[" + "".join(sorted({b[0] for b in BOILERPLATE})) + "]"  # a text without any of these has no such line
_OTHER_RX = re.compile(r"[^一-鿿0-9a-z]+")
_OTHER = bytes(b for b in range(128) if not chr(b).isalnum())
_LOWER = bytes(range(256)).lower()
_BOILERPLATE_RX = re.compile(_BOILERPLATE, re.MULTILINE)


def canonical(c: Column) -> Column:
    """Lower case, without boilerplate lines; CJK, digits and a-z only. For text in normal form already."""

    @F.pandas_udf("string")
    def of(texts: pd.Series) -> pd.Series:
        return texts.map(letters)

    return of(without_boilerplate(c))


def without_boilerplate(c: Column) -> Column:
    """Null is empty."""
    s = F.coalesce(c, F.lit(""))
    return F.when(s.rlike(_BEGINS), F.regexp_replace(s, "(?mdU)" + _BOILERPLATE, "")).otherwise(s)


def letters(s: str) -> str:
    """In lower case, CJK, digits and a-z only; plain ASCII by its bytes."""
    return s.encode().translate(_LOWER, _OTHER).decode() if s.isascii() else _OTHER_RX.sub("", s.lower())


def canonical_text(s: str | None, convert=None) -> str:
    """The same with compatibility normalisation, and ``convert`` (simplified to traditional) if given."""
    s = unicodedata.normalize("NFKC", s or "")
    s = _BOILERPLATE_RX.sub("", (convert(s) if convert else s).lower())
    return letters(s)


def char_ngrams(df: DataFrame, column: str, n: int, name: str = "grams") -> DataFrame:
    """df with all n-grams of a text column in order, repeats included; none if the text is shorter.

    The characters become a column of their own first: a lambda would evaluate an expression anew for
    every n-gram, and a substring of a long UTF-8 text is sought from its start.
    """
    chars = F.filter(F.split(F.coalesce(column, F.lit("")), ""), lambda x: x != "")
    made = F.transform(F.slice("chars_", 1, F.greatest(F.size("chars_") - (n - 1), F.lit(0))), lambda _, i: F.concat(*[F.get("chars_", i + k) for k in range(n)]))
    return df.withColumn("chars_", chars).withColumn(name, made).drop("chars_")


#: The signs of canonical texts other than CJK, numbered (255: no such sign). Their 1- to 3-grams have a table with a row for each.
_SIGNS = b"0123456789abcdefghijklmnopqrstuvwxyz"
_RANK = np.full(256, 255, np.uint8)
_RANK[np.frombuffer(_SIGNS, np.uint8)] = np.arange(36, dtype=np.uint8)


def direct_grams(text: str, n: int) -> np.ndarray | None:
    """The n-grams of a text in order as numbers to base 36; None if it holds other signs, or n is above 3."""
    if n > 3 or not text.isascii():
        return None
    rank = _RANK[np.frombuffer(text.encode(), np.uint8)]
    if (rank == 255).any():
        return None
    code, m = np.zeros(max(0, len(rank) - n + 1), np.int32), max(0, len(rank) - n + 1)
    for k in range(n):
        code = code * 36 + rank[k : k + m]
    return code


def gram_text(code: int, n: int) -> str:
    return "".join(chr(_SIGNS[code // 36 ** (n - 1 - k) % 36]) for k in range(n))


#: Grams of other signs that a task counts before it sends the counts on.
HELD = 200_000


def ngram_counts(df: DataFrame, column: str, n: int, form: Callable[[str | None], str] = lambda t: t or "") -> DataFrame:
    """(gram, n): how often each n-gram occurs in ``form`` of a text column, repeats included.

    Grams are counted within tasks, so that none but their counts are shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, other = np.zeros(36**n if n <= 3 else 0, np.int64), Counter()
        for b in batches:
            for t in b.column(0):
                t = form(t.as_py())
                code = direct_grams(t, n)
                if code is None:
                    other.update(t[k : k + n] for k in range(len(t) - n + 1))
                elif len(code) > len(table) // 8:
                    table += np.bincount(code, minlength=len(table))
                else:
                    grams, counts = np.unique(code, return_counts=True)
                    table[grams] += counts
                if len(other) > HELD:
                    yield pa.RecordBatch.from_arrays([pa.array(list(other)), pa.array(list(other.values()), pa.int64())], names=["gram", "n"])
                    other.clear()
        seen = np.flatnonzero(table)
        grams = [gram_text(c, n) for c in seen.tolist()] + list(other)
        yield pa.RecordBatch.from_arrays([pa.array(grams, pa.string()), pa.array([*table[seen].tolist(), *other.values()], pa.int64())], names=["gram", "n"])

    return df.select(column).mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


def is_native(c: Column) -> Column:
    return F.coalesce(F.lower(F.trim(c)).isin(*NATIVE), F.lit(False))


def clip(c: Column, n: int) -> Column:
    c = F.coalesce(c, F.lit(""))
    return F.when(F.length(c) <= n, c).otherwise(F.concat(F.substring(c, 1, max(1, n - 1)), F.lit("…")))


def snippet(c: Column, n: int = 100, tail: str = "...") -> Column:
    s = F.replace(F.coalesce(c, F.lit("")), F.lit("\n"), F.lit(" "))
    return F.when(F.length(s) > n, F.concat(F.substring(s, 1, n), F.lit(tail))).otherwise(s)


def entity_text(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(c)), r"(?U)\s+", " ")


def json_text(c: Column) -> Column:
    return F.coalesce(F.to_json(c), F.lit(""))


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays as sets; 0 if either is empty or null."""
    both = F.size(F.array_union(a, b))
    return F.coalesce(F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b)) / both), F.lit(0.0))


def stripped(c: Column) -> Column:
    """Without white space at both ends; null is empty."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)^\s+|\s+$", "")


def embeddable(title: Column, content: Column) -> Column:
    """Whether an article has a title or content at all."""
    return (stripped(title) != "") | (stripped(content) != "")


def embed_input(title: Column, content: Column) -> Column:
    return stripped(F.concat(stripped(title), F.lit("\n"), stripped(content)))


def html(c: Column) -> Column:
    """Safe inside an element or a quoted attribute; null is empty."""
    c = F.replace(F.coalesce(c.cast("string"), F.lit("")), F.lit("&"), F.lit("&amp;"))
    for raw, safe in (("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        c = F.replace(c, F.lit(raw), F.lit(safe))
    return c


def article_for_llm(title: Column, content: Column) -> Column:
    return F.substring(F.concat(F.lit("【標題】"), stripped(title), F.lit("\n【內文】"), stripped(content)), 1, 2000)


#: Where sentences and clauses end.
SENTENCE_END = re.compile(r"(?<=[。！？；.!?])\s*")
CLAUSE_END = re.compile(r"([。！？!?；;：:、,\n])")


def _windows(s: str, size: int, overlap: int) -> list[str]:
    out, at = [], 0
    while True:
        out.append(s[at : at + size])
        if at + size >= len(s):
            return out
        at += size - overlap


def chunk_by_chars(text: str | None, budget: int = 380, overlap: int = 40) -> list[str]:
    """Sentences packed into chunks of up to ``budget`` characters; a longer sentence is cut with an overlap."""
    text = (text or "").strip()
    if not text:
        return []
    chunks: list[str] = []
    open_ = ""
    for s in [x for x in SENTENCE_END.split(text) if x] or [text]:
        if open_ and len(open_) + 1 + len(s) <= budget:
            open_ += " " + s
            continue
        if open_:
            chunks.append(open_)
            open_ = ""
        if len(s) <= budget:
            open_ = s
        else:
            chunks += _windows(s, budget, overlap)
    return chunks + [open_] * bool(open_)


def chunk_by_words(text: str | None, limit: int = 512) -> list[str]:
    """English: sentences split at ". " and packed into chunks of up to ``limit`` words."""
    chunks: list[str] = []
    packed: list[str] = []
    held = 0
    for s in (text or "").replace("\n", " ").split(". "):
        n = len(s.split())
        if held + n > limit:
            chunks.append(". ".join(packed))
            packed, held = [], 0
        packed.append(s)
        held += n
    return chunks + [". ".join(packed)] * bool(packed)


def clauses(text: str | None) -> list[str]:
    """Clauses with the delimiter that ends them."""
    parts = CLAUSE_END.split(text or "")
    joined = [a + b for a, b in zip(parts[::2], [*parts[1::2], ""])]
    return [x.strip() for x in joined if x.strip()]


def pack(parts: list[str], limit: int, size=len) -> list[str]:
    """Parts joined greedily while their sizes sum up to ``limit`` or less; a larger part stands alone."""
    out: list[str] = []
    held = 0
    for p in parts:
        n = size(p)
        if out and held + n <= limit:
            out[-1] += p
            held += n
        else:
            out.append(p)
            held = n
    return out
