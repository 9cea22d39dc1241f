"""The same in SQL for DuckDB, written apart from the Spark code."""

from __future__ import annotations

from ..operators.store import WRITABLE
from ..sources.scans import OUTLETS, TOPICS
from .details import ENUM
from .oracle import _ART, _CANON, _ENT, _ENT0, _MET, _PLACE, _PLACE0, _REGION, _SCORED, _TOPIC, _VEC, _canonical_place, _expanded, _list, _q
from .queries import NAMES

_TRIM = "regexp_replace({}, '^\\s+|\\s+$', '', 'g')"
_HTML = "replace(replace(replace(replace(replace({}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;')"
_UTC = "strftime(make_timestamp({} * 1000000), '%Y-%m-%d %H:%M:%S') || ' UTC'"
_ORIGIN = "concat_ws(' • ', om, 'id=' || substr(oi::VARCHAR, 1, 12), 'H=' || hamming, 'J=' || printf('%.3f', round(jaccard, 3)), 'Δs=' || (p - op), " + _UTC.format("op") + ")"
_TOP = """, ranked AS (SELECT id, oi, om, op, hamming, jaccard, row_number() OVER (PARTITION BY id ORDER BY hamming, jaccard DESC, op, oi) AS k FROM met QUALIFY k <= 5),
 lines AS (SELECT id, k, '• ' || om || ' (id=' || substr(oi::VARCHAR, 1, 10) || '), H=' || hamming || ', J=' || printf('%.3f', round(jaccard, 3)) || ', ' || strftime(make_timestamp(op * 1000000), '%m-%d %H:%M') AS line, count(*) OVER (PARTITION BY id) AS total FROM ranked)"""
_DETAIL = """, r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY n DESC, at0, place) AS k, count(*) OVER (PARTITION BY id) AS total FROM pc),
 boxes AS (SELECT id, string_agg('• ' || place || ', frequency: ' || n || ', place_source: ENTITIES', '<br>' ORDER BY k) FILTER (k <= 6) || CASE WHEN any_value(total) > 6 THEN '<br>+' || (any_value(total) - 6) || ' more' ELSE '' END AS places,
   string_agg('• ' || place, '<br>' ORDER BY k) FILTER (k <= 8) || CASE WHEN any_value(total) > 8 THEN '<br>+' || (any_value(total) - 8) || ' more' ELSE '' END AS concern FROM r GROUP BY id)"""


def _more(most: int) -> str:
    return f"string_agg(line, '<br>' ORDER BY k) FILTER (k <= {most}) || CASE WHEN any_value(total) > {most} THEN '<br>+' || (any_value(total) - {most}) || ' more' ELSE '' END"


def _packed(parts: str, start: str, joins: str, merged: str, closed: str) -> str:
    """Of articles, a list of chunks: parts (one struct each) are reduced from left to right; ``joins`` says when x goes to what is open."""
    return f"list_reduce(list_prepend({start}, {parts}), lambda a, x: CASE WHEN {joins} THEN {merged} ELSE {closed} END)"


_SENTENCES = "regexp_extract_all(" + _TRIM.format("coalesce(content, '')") + ", '([^。！？；.!?]*[。！？；.!?]|[^。！？；.!?]+)\\s*', 1)"
_WINDOWS = "list_transform(range(0, 1 + CAST(ceil(greatest(length(s) - 380, 0) / 340) AS BIGINT)), lambda i: substr(s, i * 340 + 1, 380))"
_CHUNK_TEXT = _packed(
    f"list_transform({_SENTENCES}, lambda s: {{'c': CASE WHEN length(s) > 380 THEN {_WINDOWS} ELSE []::VARCHAR[] END, 'o': CASE WHEN length(s) <= 380 THEN s END}})",
    "{'c': []::VARCHAR[], 'o': NULL::VARCHAR}",
    "a.o IS NOT NULL AND x.o IS NOT NULL AND length(a.o) + 1 + length(x.o) <= 380",
    "{'c': a.c, 'o': a.o || ' ' || x.o}",
    "{'c': list_concat(CASE WHEN a.o IS NULL THEN a.c ELSE list_append(a.c, a.o) END, x.c), 'o': x.o}",
)
_CHUNK_WORDS = _packed(
    "list_transform(string_split(replace(coalesce(content, ''), chr(10), ' '), '. '), lambda s: {'c': []::VARCHAR[], 'o': s, 'n': len(regexp_extract_all(s, '\\S+'))})",
    "{'c': []::VARCHAR[], 'o': NULL::VARCHAR, 'n': 0::BIGINT}",
    "a.n + x.n <= 512",
    "{'c': a.c, 'o': coalesce(a.o || '. ' || x.o, x.o), 'n': a.n + x.n}",
    "{'c': list_append(a.c, coalesce(a.o, '')), 'o': x.o, 'n': x.n}",
)
_CLAUSES = _packed(
    "list_transform(list_filter(list_transform(regexp_extract_all(coalesce(content, ''), '[^。！？!?；;：:、,\\n]*[。！？!?；;：:、,\\n]|[^。！？!?；;：:、,\\n]+'), lambda s: " + _TRIM.format("s") + "), lambda s: s <> ''), lambda s: {'c': []::VARCHAR[], 'o': s, 'n': length(s)})",
    "{'c': []::VARCHAR[], 'o': NULL::VARCHAR, 'n': 0::BIGINT}",
    "a.o IS NULL OR a.n + x.n <= 448",
    "{'c': a.c, 'o': coalesce(a.o, '') || x.o, 'n': a.n + x.n}",
    "{'c': list_append(a.c, a.o), 'o': x.o, 'n': x.n}",
)
_ALL = "CASE WHEN r.o IS NULL THEN r.c ELSE list_append(r.c, r.o) END"


def _chunked(reduced: str) -> str:
    return _ART + f", packed AS (SELECT id, {_ALL} AS chunks FROM (SELECT id, {reduced} AS r FROM articles)), each AS (SELECT id, unnest(range(0, len(chunks))) AS pos, unnest(chunks) AS chunk FROM packed) SELECT id, CAST(pos AS INTEGER) AS pos, CAST(length(chunk) AS INTEGER) AS n, md5(chunk) AS md5 FROM each"


_RAW = _PLACE + """, labelled AS (SELECT media_name, raw.raw, label, count(*) AS n FROM raw JOIN ent USING (id, pos) JOIN articles USING (id) GROUP BY ALL),
 toplist AS (SELECT * FROM labelled QUALIFY row_number() OVER (PARTITION BY media_name ORDER BY n DESC, raw, label) <= 10)"""

ORACLE_SQL = {
    "cluster_scan_full": _ART + " SELECT cluster_id, count(*) AS article_count, max(published_at) AS latest_published FROM articles WHERE cluster_id IS NOT NULL GROUP BY cluster_id",
    "unclustered_english_scan": _ART + " SELECT id, published_at FROM articles WHERE cluster_id IS NULL AND content IS NOT NULL ORDER BY published_at ASC NULLS LAST, id LIMIT 500",
    "recent_corpus_scan_asc": _ART + " SELECT id, media_name, published_at FROM articles WHERE content IS NOT NULL ORDER BY published_at ASC NULLS LAST, id LIMIT 500",
    "topic_dimension": f"SELECT CAST(pos AS INTEGER) AS pos, topic, CAST(length(description) AS INTEGER) AS n, md5(description) AS md5 FROM (VALUES {','.join(f'({i},{_q(t)},{_q(x)})' for i, (t, x) in enumerate(TOPICS))}) t(pos, topic, description)",
    "gazetteer_names": f"SELECT CAST(pos AS INTEGER) AS pos, raw, {_canonical_place('raw')} AS place FROM (VALUES {','.join(f'({i},{_q(n)})' for i, n in enumerate(NAMES))}) t(pos, raw)",
    "article_places_expanded": _PLACE + ", named AS (SELECT id, list(raw ORDER BY pos) AS m FROM raw GROUP BY id), said AS (SELECT id, m[1] AS token, array_to_string(m, '，') AS body FROM named) " + _expanded("said", "id"),
    "places_of_entities": _RAW + f" SELECT media_name, string_agg(DISTINCT place, ',' ORDER BY place) AS places FROM (SELECT media_name, {_canonical_place('raw')} AS place FROM (SELECT media_name, lower(trim(raw)) AS raw FROM toplist WHERE label IN ('GPE', 'LOC'))) WHERE place IS NOT NULL GROUP BY media_name",
    "embed_inputs": _ART + f", t AS (SELECT id, {_TRIM.format('coalesce(title, ' + _q('') + ')')} AS t, {_TRIM.format('coalesce(content, ' + _q('') + ')')} AS c FROM articles), b AS (SELECT id, {_TRIM.format('t || chr(10) || c')} AS x FROM t WHERE t <> '' OR c <> '') SELECT id, CAST(length(x) AS INTEGER) AS n, md5(x) AS md5 FROM b",
    "headlines_joined": _ART + ", h AS (SELECT cluster_id, min(title) AS headline FROM articles WHERE cluster_id % 2 = 0 GROUP BY cluster_id HAVING min(title) <> '') SELECT id, cluster_id, headline, CASE WHEN headline IS NOT NULL THEN '' END AS question FROM articles LEFT JOIN h USING (cluster_id)",
    "cluster_facts_merge": _ENT + f""", k AS (SELECT id, cluster_id, id % 2 AS part, published_at, region FROM articles WHERE cluster_id IS NOT NULL),
      f AS (SELECT cluster_id, count(*) AS article_count, max(published_at) AS latest_published, max(part) AS part FROM k GROUP BY cluster_id),
      e AS (SELECT cluster_id, text, label, count(*) AS n FROM ent JOIN k USING (id) GROUP BY cluster_id, text, label QUALIFY row_number() OVER (PARTITION BY cluster_id ORDER BY count(*) DESC, text, label) <= 10),
      es AS (SELECT cluster_id, string_agg(text || ':' || label || ':' || n, ',' ORDER BY n DESC, text, label) AS entities FROM e GROUP BY cluster_id),
      p AS (SELECT cluster_id, part, list(DISTINCT region ORDER BY region) FILTER (region IS NOT NULL) AS r FROM k GROUP BY cluster_id, part),
      w AS (SELECT cluster_id, part, list_filter(r, lambda x: x IN ({','.join(map(_q, WRITABLE))})) AS w, r FROM p),
      n AS (SELECT * FROM w WHERE part = 1), o AS (SELECT * FROM w WHERE part = 0),
      d AS (SELECT cluster_id, max(len(embedding)) AS d FROM k JOIN embeddings ON vec_id = k.id GROUP BY cluster_id)
      SELECT f.cluster_id, article_count, latest_published, coalesce(entities, '') AS entities,
        CASE WHEN n.part = 1 AND f.cluster_id % 3 > 0 THEN '1/' || f.cluster_id WHEN o.part = 0 THEN '0/' || f.cluster_id END AS main_topic, CAST(CASE WHEN n.part = 1 AND f.cluster_id % 3 > 0 THEN 1.5 WHEN o.part = 0 THEN 0.5 END AS DOUBLE) AS main_topic_score,
        n.part IS NULL AS ambiguous, array_to_string(CASE WHEN len(n.w) > 0 THEN n.w ELSE o.r END, ',') AS concern, CAST(CASE WHEN len(n.w) > 0 THEN len(n.w) ELSE len(o.r) END AS INTEGER) AS details, CAST(d AS INTEGER) AS d
      FROM f LEFT JOIN es USING (cluster_id) LEFT JOIN n ON n.cluster_id = f.cluster_id LEFT JOIN o ON o.cluster_id = f.cluster_id LEFT JOIN d ON d.cluster_id = f.cluster_id""",
    "enum_values": _ART + f" SELECT id, CASE WHEN id % 3 < 2 AND media_name IN ({','.join(map(_q, ENUM.values()))}) THEN media_name END AS media FROM articles",
    "sanitised_columns": _ART + " SELECT id, CASE WHEN id % 4 = 0 THEN id::DOUBLE WHEN id % 4 = 1 THEN id + 0.5::DOUBLE END AS score, CASE WHEN id % 4 < 2 THEN id END AS at, '[\"' || media_name || '\"]' AS nested FROM articles",
    "moments": _ART + " SELECT id, CASE WHEN id % 4 < 3 THEN published_at END AS secs, published_at - 28800 AS wall FROM articles",
    "stored_vectors": "SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN -1 ELSE CAST(len(embedding) AS INTEGER) END AS n, CASE WHEN vec_id % 7 > 0 THEN round(list_sum(embedding::DOUBLE[]), 6) END AS total FROM embeddings",
    "hover_concern": _PLACE + _DETAIL + " SELECT id, concern AS hover FROM boxes",
    "hover_origin": _MET + f" SELECT id, {_ORIGIN} AS hover FROM origins",
    "hover_matches": _MET + _TOP + f" SELECT id, {_more(3)} AS hover FROM lines GROUP BY id",
    "report_articles": _SCORED + " SELECT a.id, CASE WHEN length(title) > 60 THEN substr(title, 1, 59) || '…' ELSE title END AS title, a.media_name, a.published_at, f.cluster_id, round(sim, 3) AS attach_sim, round(score, 3) AS attach_combined FROM articles a JOIN (SELECT * FROM final QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, sim DESC, cluster_id) = 1) f USING (id)",
    "html_cells": _ART + f""" SELECT id::VARCHAR AS id, {_HTML.format("'<b>\"Q\" & ''A''</b> ' || array_to_string(string_split(title, ' ')[1:3], ' ')")} AS title, CASE WHEN id % 2 = 0 THEN '<a href="https://a/?x=1&amp;y=' || id || '" rel="noopener">link</a>' ELSE 'javascript:x' END AS url FROM articles""",
    "plot_points": _MET + _ENT0 + _PLACE0 + _DETAIL + _TOP + f""", vecs AS (SELECT vec_id AS id, embedding::DOUBLE[] AS vec, label FROM embeddings JOIN articles ON vec_id = articles.id),
      comp AS (SELECT label, i, avg(vec[i]) AS x FROM vecs, (SELECT unnest(range(1, 65)) AS i) GROUP BY label, i), cents AS (SELECT label, list(x ORDER BY i) AS c FROM comp GROUP BY label),
      topics AS (SELECT vecs.id, 'topic' || cents.label AS topic FROM vecs, cents QUALIFY row_number() OVER (PARTITION BY vecs.id ORDER BY list_dot_product(vec, c) / sqrt(list_dot_product(c, c)) DESC, 'topic' || cents.label) = 1),
      m AS (SELECT id, {_more(6)} AS matches FROM lines GROUP BY id), o AS (SELECT id, {_ORIGIN} AS origin FROM origins)
      SELECT a.id, a.cluster_id::VARCHAR AS cluster, round(vec[1], 6) AS x, round(vec[2], 6) AS y, CASE WHEN length(title) > 60 THEN substr(title, 1, 59) || '…' ELSE title END AS title,
        CASE WHEN length(content) > 60 THEN substr(replace(content, chr(10), ' '), 1, 60) || '…' ELSE replace(coalesce(content, ''), chr(10), ' ') END AS short_text, a.media_name, {_UTC.format('a.published_at')} AS published, topic,
        coalesce(boxes.places, '') AS places, coalesce(boxes.concern, '') AS concern, CASE WHEN o.origin IS NULL THEN '0' ELSE '1' END AS copy, coalesce(o.origin, '') AS origin, coalesce(m.matches, '') AS matches
      FROM articles a JOIN vecs ON vecs.id = a.id LEFT JOIN topics ON topics.id = a.id LEFT JOIN boxes ON boxes.id = a.id LEFT JOIN m ON m.id = a.id LEFT JOIN o ON o.id = a.id""",
    "chunk_text": _chunked(_CHUNK_TEXT),
    "chunk_words": _chunked(_CHUNK_WORDS),
    "translate_chunks": _ART + f", packed AS (SELECT id, {_ALL} AS chunks FROM (SELECT id, {_CLAUSES} AS r FROM articles)) SELECT id, CAST(len(chunks) AS INTEGER) AS chunks, md5(upper(replace(array_to_string(chunks, ' '), 'ß', 'SS'))) AS md5 FROM packed WHERE len(chunks) > 0",
    "llm_json_repair": _ART + """ SELECT id, regexp_replace(title, '["\\\\{}\\[\\],\\s]+', ' ', 'g') AS headline, 's' AS summary, 'q' AS question FROM articles""",
    "central_articles": _VEC + """, m AS (SELECT label AS cluster_id, id, list_transform(vec, lambda x: x / sqrt(list_dot_product(vec, vec))) AS u, list_dot_product(vec, centroid) / sqrt(list_dot_product(vec, vec)) / sqrt(list_dot_product(centroid, centroid)) AS sim FROM vecs JOIN cents USING (label)),
      a AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY cluster_id ORDER BY sim DESC, id) = 1),
      b AS (SELECT m.* FROM m JOIN a USING (cluster_id) WHERE list_dot_product(m.u, a.u) < 0.92 QUALIFY row_number() OVER (PARTITION BY m.cluster_id ORDER BY m.sim DESC, m.id) = 1),
      c AS (SELECT m.* FROM m JOIN a USING (cluster_id) JOIN b USING (cluster_id) WHERE list_dot_product(m.u, a.u) < 0.92 AND list_dot_product(m.u, b.u) < 0.92 QUALIFY row_number() OVER (PARTITION BY m.cluster_id ORDER BY m.sim DESC, m.id) = 1)
      SELECT cluster_id, id, 1 AS rank FROM a UNION ALL SELECT cluster_id, id, 2 FROM b UNION ALL SELECT cluster_id, id, 3 FROM c""",
}
