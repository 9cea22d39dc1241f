"""Licence scans with a positional rare-token index, in DataFrame functions only.

Texts are lower-cased (A-Z) and cut into words, runs of digits, letters a-z and non-ASCII
characters. Of each licence template two words of its mandatory key phrases are indexed with their
place in it: those with the highest inverse document frequency in the corpus. A file is looked up by
the indexed words it holds: their places, less the word's place in a template, are the template's
possible starts, and the starts that both words give are intersected. A start stands if all words of
the key phrases are found at their places, so the index decides how fast a licence is found, not
whether. Fixed phrases (``BASE``) are found wherever their words stand consecutively. The postings are
literals, looked up by word: the catalogue is a parameter, and its size does not widen the plan.

Null and empty texts have no words, no labels and the score 0. Nothing is dealt between tasks but
the counts of the template words, of which there is a fixed number.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .util import ascii_lower

#: Phrases and their labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
#: Label, template, mandatory key phrases.
TEMPLATES = (
    ("agpl", "under the terms of the gnu affero general public license", ("affero general public license",)),
    ("apache-2.0", "licensed under the apache license version 2 0", ("apache license", "version 2 0")),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ("redistribution and use", "source and binary forms")),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    ("gpl-3.0", "licensed under the gnu general public license version 3", ("gnu general public license", "version 3")),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", ("permission to use copy modify", "distribute this software")),
    ("lgpl", "under the terms of the gnu lesser general public license", ("lesser general public license",)),
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", ("permission is hereby granted", "free of charge")),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software", "public domain")),
)
#: Words of each template that are indexed; key phrases have as many at least.
INDEXED = 2


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def _musts(template: str, phrases: tuple[str, ...]) -> dict[int, str]:
    """Place and word of the key phrases' words in a template."""
    p = template.split()
    return {template_place(p, phrase.split()) + i: w for phrase in phrases for i, w in enumerate(phrase.split())}


def rarest(df: DataFrame, text_col: str, templates: tuple = TEMPLATES) -> list[list[int]]:
    """Of each template, the places of its key words found in the fewest texts (of equal ones, the first in order), all texts counted."""
    keys = [_musts(t, phrases) for _, t, phrases in templates]
    held = F.array_intersect(words(F.col(text_col)), F.array(*map(F.lit, sorted({w for k in keys for w in k.values()}))))
    count = {r.w: r.n for r in df.select(F.explode(held).alias("w")).groupBy("w").agg(F.count("*").alias("n")).collect()}
    return [sorted(k, key=lambda at: (count.get(k[at], 0), k[at], at))[:INDEXED] for k in keys]


def _is(at: Column, word: Column | str) -> Column:
    return F.coalesce(F.get("words_", at) == word, F.lit(False))


def _standing(places: Column, phrase: list[str]) -> Column:
    """The places from which on the words of a phrase stand."""
    return F.filter(places, lambda s: reduce(lambda a, b: a & b, [_is(s + k, w) for k, w in enumerate(phrase)]))


def _map(rows: dict, value: Callable) -> Column:
    return F.create_map(*[x for k, v in rows.items() for x in (F.lit(k), value(v))])


def _pairs(rows: list[tuple], *names: str) -> Column:
    return F.array(*[F.struct(*[F.lit(x).alias(n) for x, n in zip(r, names)]) for r in rows])


def _starts(postings: Column) -> Column:
    """(template, start) of every place of a posted word."""
    held = F.filter("hits_", lambda i: F.map_contains_key(postings, F.get("words_", i)))
    return F.flatten(F.transform(held, lambda i: F.transform(F.element_at(postings, F.get("words_", i)), lambda x: F.struct(x.t.alias("t"), (i - x.at).alias("s")))))


def scan(df: DataFrame, keep: list[str], text_col: str = "text", templates: tuple = TEMPLATES) -> DataFrame:
    """``keep`` plus n_words, n_base, first_word, last_word, base_labels, labels and score.

    score: the largest part of a matched template's words that stand at their places; 1 with a base phrase.
    """
    index = rarest(df, text_col, templates)
    musts = [_musts(t, phrases) for _, t, phrases in templates]
    posted: list[dict[str, list[tuple[int, int]]]] = [{} for _ in range(INDEXED)]
    for t, places in enumerate(index):
        for r, at in enumerate(places):
            posted[r].setdefault(musts[t][at], []).append((t, at))
    heads = {p.split()[0] for p, _ in BASE}
    got = df.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keep)], words(F.col(text_col)).alias("words_"))
    hits = F.array_compact(F.transform("words_", lambda w, i: F.when(w.isin(sorted(heads.union(*posted))), i)))
    got = got.withColumn("hits_", hits)

    # (template, start) by the postings of the words of each rank; what all ranks give, and its key words confirm
    postings = [_map(p, lambda v: _pairs(v, "t", "at")) for p in posted]
    starts = [_starts(p) for p in postings]
    must = _map(dict(enumerate(musts)), lambda v: _pairs(sorted(v.items()), "at", "w"))
    stands = lambda x: F.forall(F.element_at(must, x.t), lambda m: _is(x.s + m.at, m.w))
    got = got.withColumn("found_", F.filter(reduce(F.array_intersect, starts), stands))

    own = _map(dict(enumerate(label for label, _, _ in templates)), F.lit)
    spelled = _map({t: text.split() for t, (_, text, _) in enumerate(templates)}, lambda v: F.array(*map(F.lit, v)))
    share = lambda x: F.aggregate(F.transform(F.element_at(spelled, x.t), lambda w, k: _is(x.s + k, w).cast("int")), F.lit(0), lambda a, b: a + b) / F.size(F.element_at(spelled, x.t))
    for b, (phrase, _) in enumerate(BASE):
        p = phrase.split()
        got = got.withColumn(f"base{b}", _standing(F.col("hits_"), p))
    every = F.concat(*[F.col(f"base{b}") for b in range(len(BASE))])
    base = F.array_compact(F.array(*[F.when(F.size(f"base{b}") > 0, label) for b, (_, label) in enumerate(BASE)]))
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    return got.select(
        *[F.col(f"k{i}").alias(k) for i, k in enumerate(keep)],
        F.size("words_").cast("long").alias("n_words"),
        F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"),
        F.array_max(every).cast("long").alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.concat(base, F.transform("found_", lambda x: F.element_at(own, x.t)))).alias("labels"),
        F.greatest(F.when(F.size(every) > 0, 1.0).otherwise(0.0), F.coalesce(F.array_max(F.transform("found_", share)), F.lit(0.0))).alias("score"),
    )


def template_place(template: list[str], phrase: list[str]) -> int:
    return next(i for i in range(len(template)) if template[i : i + len(phrase)] == phrase)
