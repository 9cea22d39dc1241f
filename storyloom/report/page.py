"""The report: tables in their order of columns, an HTML page around them, and its upload.

Tables are DataFrames; only the rows that a page shows reach the driver, and ``page`` takes a bound.
"""

from __future__ import annotations

import html
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import hover, text, times

#: Columns with scores, shown to three digits.
SCORES = ("attach_sim", "attach_ent_overlap", "attach_place_overlap", "attach_time_bonus", "attach_combined", "main_topic_score", "secondary_topic_score")
#: Columns that a table shows first, and those that it leaves out.
FIRST = ("cluster_id", "published_at", "title", "media_name", "main_topic")
HIDDEN = ("content", "vec", "embedding", "centroid_embedding", "centroid", "x", "y")
UNSORTED = "未分類"


def rounded(df: DataFrame, columns: Sequence[str] = SCORES, digits: int = 3) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).try_cast("double"), digits) for c in columns if c in df.columns})


def ordered_columns(columns: Sequence[str], first: Sequence[str] = FIRST, hidden: Sequence[str] = HIDDEN) -> list[str]:
    """Those of ``first`` that there are, then the others in their order, without the hidden ones."""
    rest = [c for c in columns if c not in first and c not in hidden]
    return [c for c in first if c in columns and c not in hidden] + rest


def articles_table(df: DataFrame, first: Sequence[str] = FIRST, hidden: Sequence[str] = HIDDEN) -> DataFrame:
    """All articles by cluster, newest first, scores to three digits, in the table's order of columns."""
    return rounded(df).select(*ordered_columns(df.columns, first, hidden)).orderBy("cluster_id", F.desc("published_at"), "id")


def topic_chart(df: DataFrame, topic: str = "main_topic") -> DataFrame:
    """(topic, n), the most frequent first; articles without a topic stand under one of their own."""
    return df.groupBy(F.coalesce(topic, F.lit(UNSORTED)).alias("topic")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "topic")


def scatter(df: DataFrame) -> DataFrame:
    """A point for each article: id, x, y, its cluster's colour key and the texts of its hover box.

    ``df``: id, cluster_id, x, y, title, content, media_name, published_at, main_topic, places_in_detail,
    places_in_concern, copypaste_flag, copypaste_origin, copypaste_matches (typed as in ``hover``).
    """
    return df.select(
        "id", F.col("cluster_id").cast("string").alias("cluster"), "x", "y", text.clip(F.col("title"), 60).alias("title"), text.snippet(F.col("content"), 60, "…").alias("short_text"),
        "media_name", times.utc(F.col("published_at")).alias("published"), F.coalesce("main_topic", F.lit(UNSORTED)).alias("topic"), hover.places(F.col("places_in_detail")).alias("places"),
        hover.concern(F.col("places_in_concern")).alias("concern"), hover.flag(F.col("copypaste_flag")).alias("copy"), hover.origin(F.col("copypaste_origin")).alias("origin"), hover.matches(F.col("copypaste_matches")).alias("matches"),
    )


def cells(df: DataFrame, links: Sequence[str] = ("url",)) -> DataFrame:
    """df with every column as text that is safe in HTML; a link column as an element, if it begins with http."""

    def cell(c: str) -> Column:
        shown = text.html(F.col(f"`{c}`"))
        link = F.concat(F.lit('<a href="'), shown, F.lit('" rel="noopener">link</a>'))
        return F.when(F.col(f"`{c}`").cast("string").rlike("^https?://"), link).otherwise(shown) if c in links else shown

    return df.select(*[cell(c).alias(c) for c in df.columns])


def html_table(df: DataFrame, most: int = 10_000) -> str:
    """A table of up to ``most`` rows in the order of df; a last line says if there are more."""
    rows = cells(df).limit(most + 1).collect()
    head = "".join(f"<th>{html.escape(c)}</th>" for c in df.columns)
    body = "\n".join("<tr>" + "".join(f"<td>{x}</td>" for x in r) + "</tr>" for r in rows[:most])
    more = f'\n<tr><td colspan="{len(df.columns)}">only {most} rows are shown</td></tr>' if len(rows) > most else ""
    return f"<table>\n<thead><tr>{head}</tr></thead>\n<tbody>\n{body}{more}\n</tbody>\n</table>"


def svg_bars(rows: Sequence[tuple[str, int]], width: int = 640) -> str:
    top = max((n for _, n in rows), default=1) or 1
    bars = [f'<g transform="translate(0,{22 * i})"><rect width="{width * n // top}" height="18"/><text x="4" y="13">{html.escape(name)} {n}</text></g>' for i, (name, n) in enumerate(rows)]
    return f'<svg width="{width}" height="{22 * len(rows)}" role="img">{"".join(bars)}</svg>'


def svg_points(rows: Sequence, size: int = 640) -> str:
    """Points coloured by cluster; each one's texts are its title, shown under the pointer."""
    live = [r for r in rows if r.x is not None and r.y is not None and math.isfinite(r.x) and math.isfinite(r.y)]
    if not live:
        return f'<svg width="{size}" height="{size}" role="img"></svg>'
    ends = [(min(v), max(v)) for v in ([r.x for r in live], [r.y for r in live])]
    place = lambda v, i: (v - ends[i][0]) / ((ends[i][1] - ends[i][0]) or 1) * (size - 20) + 10
    hue = {c: 360 * i // max(1, len({r.cluster for r in live})) for i, c in enumerate(sorted({r.cluster or "" for r in live}))}
    told = lambda r: "\n".join(f"{k}: {v}" for k, v in r.asDict().items() if k not in ("x", "y") and v not in (None, "")).replace(hover.BREAK, "\n")
    dots = [f'<circle cx="{place(r.x, 0):.1f}" cy="{place(r.y, 1):.1f}" r="4" fill="hsl({hue[r.cluster or ""]},70%,45%)"><title>{html.escape(told(r))}</title></circle>' for r in live]
    return f'<svg width="{size}" height="{size}" role="img">{"".join(dots)}</svg>'


def page(title: str, articles: DataFrame, points: DataFrame | None = None, most: int = 10_000) -> str:
    """The report as one HTML document: plot, topics, table; each of up to ``most`` rows."""
    chart = [(r.topic, r.n) for r in topic_chart(articles).limit(most).collect()] if "main_topic" in articles.columns else []
    plot = svg_points(points.limit(most).collect()) if points is not None else ""
    parts = [f"<h1>{html.escape(title)}</h1>", plot, svg_bars(chart) if chart else "", html_table(articles_table(articles), most)]
    return f'<!doctype html>\n<html><head><meta charset="utf-8"><title>{html.escape(title)}</title></head>\n<body>\n' + "\n".join(x for x in parts if x) + "\n</body></html>\n"


def publish(spark: SparkSession, document: str, path: str) -> str | None:
    """Writes a document to ``path`` in any store that Spark reaches, and gives the path; None if it cannot be written."""
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
        try:
            out.write(bytearray(document.encode()))
        finally:
            out.close()
    except Exception:  # no store, no right to write: the report is missing, the job is not
        return None
    return path
