"""Short texts of a report's hover boxes, from typed columns: bullets in lines, and how many more there are."""

from __future__ import annotations

import textwrap
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import clip
from .times import utc

PLACES = "array<struct<place:string,frequency:bigint,place_source:string>>"
BREAK = "<br>"


def lines(items: Column, most: int, shown: Callable[[Column], Column]) -> Column:
    """Up to ``most`` items, one in a line, then "+n more"; "" for null or none."""
    rest = F.size(items) - most
    more = F.when(rest > 0, F.array(F.concat(F.lit("+"), rest.cast("string"), F.lit(" more")))).otherwise(F.array().cast("array<string>"))
    return F.coalesce(F.array_join(F.concat(F.transform(F.slice(items, 1, most), shown), more), BREAK), F.lit(""))


def places(items: Column, most: int = 6, width: int = 40) -> Column:
    """Of array<struct<place, frequency, place_source>>; parts that are null are left out."""
    return lines(items, most, lambda x: F.concat_ws(", ", F.concat(F.lit("• "), clip(x.place, width)), F.concat(F.lit("frequency: "), x.frequency.cast("string")), F.concat(F.lit("place_source: "), x.place_source)))


def concern(items: Column, most: int = 8, width: int = 40) -> Column:
    return lines(items, most, lambda x: F.concat(F.lit("• "), clip(x, width)))


def _three(c: Column) -> Column:
    return F.format_string("%.3f", c)


def origin(o: Column) -> Column:
    """Of struct<id, media_name, hamming, jaccard, delta_secs, published_at>, in one line; "" for null."""
    media = F.when(o.media_name != "", o.media_name)
    parts = [
        media, F.concat(F.lit("id="), F.substring(o.id.cast("string"), 1, 12)), F.concat(F.lit("H="), o.hamming.cast("string")), F.when(o.jaccard.isNotNull(), F.concat(F.lit("J="), _three(o.jaccard))),
        F.concat(F.lit("Δs="), o.delta_secs.cast("string")), F.when(o.published_at != 0, utc(o.published_at)),
    ]
    return F.concat_ws(" • ", *parts)


def matches(items: Column, most: int = 6, width: int = 36) -> Column:
    """Of array<struct<id, media_name, hamming, jaccard, published_at>>."""

    def shown(x: Column) -> Column:
        name = F.concat(F.lit("• "), clip(x.media_name, width), F.coalesce(F.concat(F.lit(" (id="), F.substring(x.id.cast("string"), 1, 10), F.lit(")")), F.lit("")))
        rest = [F.concat(F.lit("H="), x.hamming.cast("string")), F.when(x.jaccard.isNotNull(), F.concat(F.lit("J="), _three(x.jaccard))), F.when(x.published_at != 0, utc(x.published_at, "MM-dd HH:mm"))]
        return F.concat_ws(", ", name, *rest)

    return lines(items, most, shown)


def wrapped(c: Column, width: int = 60, most: int = 240) -> Column:
    """Clipped, then broken between words into lines of up to ``width`` characters: for what is no list."""

    @F.pandas_udf("string")
    def of(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: BREAK.join(textwrap.wrap(t, width=width)))

    return of(clip(c, most))


def stored_places(raw: Column, most: int = 6, width: int = 40) -> Column:
    """Of a stored JSON list of objects (place or name; frequency or count); other texts wrapped, null empty."""
    got = F.from_json(raw, "array<struct<place:string,name:string,frequency:bigint,count:bigint,place_source:string>>")
    items = F.transform(got, lambda x: F.struct(F.trim(F.coalesce(x.place, x["name"], F.lit(""))).alias("place"), F.coalesce(x.frequency, x["count"]).alias("frequency"), x.place_source.alias("place_source")))
    is_list = F.coalesce(raw.rlike(r"^\s*\["), F.lit(False)) & got.isNotNull()
    return F.when(raw.isNull(), "").when(is_list, places(items, most, width)).otherwise(wrapped(raw))


def flag(c: Column) -> Column:
    return F.when(F.coalesce(c, F.lit(False)), "1").otherwise("0")
