"""The same queries in SQL for DuckDB, written apart from the Spark code."""

from __future__ import annotations

from ..functions.places import ALIASES, ALLOWED, KEYWORDS, REGIONS, SUPPLEMENTAL, TAIWAN
from ..functions.text import BOILERPLATE, NATIVE
from ..operators.store import WRITABLE
from ..sources.scans import OUTLETS
from .queries import ENTITY_CASES, NAMES, PLACE_CASES, REGION_CASES, P


def _q(x: str | None) -> str:
    return "NULL" if x is None else "'" + x.replace("'", "''") + "'"


def _list(xs) -> str:
    return "[" + ",".join(map(_q, xs)) + "]"


_NUMBER = f"TRY_CAST(regexp_extract(media_name, '([0-9]+)$', 1) AS INTEGER) * 7 % {len(OUTLETS)} + 1"
_REGION = f"{_list(r for _, r in OUTLETS)}[{_NUMBER}]"
_ART = f"""WITH articles AS (
  SELECT *, {_REGION} AS region FROM (
  SELECT doc_id AS id, split_part(text, chr(10), 1) AS title, text AS content, source AS media_name,
    CAST(1704067200 + (doc_id * 7919) % 2592000 AS BIGINT) AS published_at,
    CASE WHEN doc_id % 7 = 0 THEN 'native' WHEN doc_id % 7 = 1 THEN ' Original ' ELSE source END AS origin,
    CASE WHEN doc_id % 3 <> 0 THEN doc_id % 10 END AS cluster_id FROM documents))"""
_CANON = _ART + f""", canon AS (
  SELECT *, regexp_replace(regexp_replace(lower(coalesce(content, '')), '(?m)^({"|".join(BOILERPLATE)})\\b.*', '', 'g'), '[^一-鿿0-9a-z]', '', 'g') AS c FROM articles)"""
_SIM = _CANON + """, texts AS (SELECT c, min(id) AS cls FROM canon WHERE length(c) >= 3 GROUP BY c),
 grams AS (SELECT cls, substr(c, i, 3) AS g, count(*) AS n FROM (SELECT cls, c, unnest(range(1, length(c) - 1)) AS i FROM texts) GROUP BY ALL),
 hashes AS (SELECT g, ('0x' || substr(md5(g), 1, 15))::BIGINT AS h FROM (SELECT DISTINCT g FROM grams)),
 votes AS (SELECT cls, b, sum(CASE WHEN (h >> b) & 1 = 1 THEN n ELSE -n END) AS v FROM grams JOIN hashes USING (g), (SELECT unnest(range(0, 60)) AS b) GROUP BY cls, b),
 sims AS (SELECT cls, CAST(sum(CASE WHEN v >= 0 THEN 1::BIGINT << b::INTEGER ELSE 0 END) AS BIGINT) AS simhash FROM votes GROUP BY cls HAVING simhash <> 0)"""
_PAIRS = _SIM + """, nodes AS (SELECT cls, simhash, c FROM sims JOIN texts USING (cls)),
 near0 AS (SELECT x.cls AS a, y.cls AS b, CAST(bit_count(xor(x.simhash, y.simhash)) AS INTEGER) AS hamming
   FROM nodes x JOIN nodes y ON x.cls < y.cls AND bit_count(xor(x.simhash, y.simhash)) <= 3),
 five AS (SELECT cls, list_distinct(list_transform(range(1, length(c) - 3), lambda i: substr(c, i, 5))) AS g FROM nodes
   WHERE length(c) >= 10 AND (cls IN (SELECT a FROM near0) OR cls IN (SELECT b FROM near0))),
 near1 AS (SELECT a, b, hamming, x.g AS ga, y.g AS gb FROM near0 JOIN five x ON x.cls = a JOIN five y ON y.cls = b),
 near AS (SELECT a, b, hamming, j AS jaccard FROM (SELECT *, len(list_intersect(ga, gb)) / len(list_distinct(list_concat(ga, gb))) AS j FROM near1) WHERE j >= 0.9),
 links AS (SELECT a, b, hamming, jaccard FROM near UNION ALL SELECT b, a, hamming, jaccard FROM near UNION ALL SELECT cls, cls, 0, 1.0 FROM nodes WHERE length(c) >= 10)"""
_MET = _PAIRS + f""", own AS (SELECT canon.*, cls FROM canon JOIN texts USING (c)),
 met AS (SELECT x.id, x.published_at AS p, x.media_name AS media, coalesce(lower(trim(x.origin)) IN ({",".join(map(_q, NATIVE))}), false) AS native,
   y.id AS oi, y.media_name AS om, y.published_at AS op, hamming, jaccard FROM own x JOIN links ON a = x.cls JOIN own y ON y.cls = b WHERE y.id <> x.id),
 cross0 AS (SELECT * FROM met WHERE om <> '' AND om <> coalesce(media, '') AND op > 0),
 early AS (SELECT * FROM cross0 WHERE op <= p - 60 QUALIFY row_number() OVER (PARTITION BY id ORDER BY op, hamming, jaccard DESC, oi) = 1),
 tie AS (SELECT * FROM cross0 WHERE NOT native AND abs(op - p) <= 60 AND id NOT IN (SELECT id FROM early) QUALIFY row_number() OVER (PARTITION BY id ORDER BY hamming, jaccard DESC, op, oi) = 1),
 origins AS (SELECT *, 'earlier_cross_outlet' AS rule FROM early UNION ALL SELECT *, 'tie_origin_not_native' FROM tie)"""
_VEC = _ART + """, vecs AS (SELECT vec_id AS id, embedding::DOUBLE[] AS vec, label, published_at, media_name, region FROM embeddings JOIN articles ON vec_id = articles.id),
 comp AS (SELECT label, i, avg(vec[i]) AS x, count(*) AS n FROM vecs, (SELECT unnest(range(1, 65)) AS i) GROUP BY label, i),
 cents AS (SELECT label, list(x ORDER BY i) AS centroid FROM comp GROUP BY label)"""
_ALLVEC = """WITH vecs AS (SELECT vec_id AS id, embedding::DOUBLE[] AS vec, label FROM embeddings),
 comp AS (SELECT label, i, avg(vec[i]) AS x, count(*) AS n FROM vecs, (SELECT unnest(range(1, 65)) AS i) GROUP BY label, i)"""
_SIMS = _VEC + """, sims AS (SELECT id, c.label AS cluster_id, list_dot_product(vec, centroid) / sqrt(list_dot_product(vec, vec)) / sqrt(list_dot_product(centroid, centroid)) AS sim
   FROM vecs, cents c WHERE list_dot_product(vec, vec) > 1e-16),
 ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY id ORDER BY sim DESC, cluster_id) AS INTEGER) AS rank FROM sims)"""
_ENT0 = """, ent0 AS (SELECT id, unnest(s) AS s, unnest(range(0, len(s))) AS pos FROM (SELECT id, regexp_extract_all(coalesce(content, ''), '([A-Z][a-z]{3,})', 1) AS s FROM articles)),
 ent AS (SELECT id, pos, lower(s) AS text, ['PERSON','ORG','GPE','LOC'][length(s) % 4 + 1] AS label FROM ent0)"""
_ENT = _ART + _ENT0
_SCORED = _SIMS + _ENT0 + f""", ae AS (SELECT id, list(DISTINCT text) AS ents FROM ent GROUP BY id),
 ce AS (SELECT cluster_id, list(DISTINCT text) AS ents FROM (SELECT v.label AS cluster_id, e.text, e.label, count(*) AS n FROM ent e JOIN vecs v USING (id) GROUP BY v.label, e.text, e.label
   QUALIFY row_number() OVER (PARTITION BY v.label ORDER BY count(*) DESC, e.text, e.label) <= 10) GROUP BY cluster_id),
 cf AS (SELECT label AS cluster_id, max(published_at) AS latest, list(DISTINCT region) AS places FROM vecs GROUP BY label),
 scored AS (SELECT r.id, r.cluster_id, sim, rank,
   coalesce(len(list_intersect(ae.ents, ce.ents)) / nullif(len(list_distinct(list_concat(ae.ents, ce.ents))), 0), 0) * (ae.ents IS NOT NULL AND ce.ents IS NOT NULL)::INT AS ent,
   CASE WHEN list_contains(cf.places, v.region) THEN 1 / len(cf.places) ELSE 0.0 END AS place,
   CASE WHEN abs(v.published_at - cf.latest) <= 259200 THEN 0.05::DOUBLE ELSE 0.0::DOUBLE END AS time
   FROM ranked r JOIN vecs v USING (id) JOIN cf USING (cluster_id) LEFT JOIN ae USING (id) LEFT JOIN ce USING (cluster_id) WHERE rank <= {P.top_k_attach}),
 final AS (SELECT *, sim + 0.27 * ent + 0.05 * place + time AS score FROM scored)"""
_TOPIC = _VEC + """, topics AS (SELECT 'topic' || label AS label, list_transform(centroid, lambda x: x / (sqrt(list_dot_product(centroid, centroid)) + 1e-12)) AS tv FROM cents),
 tc AS (SELECT id, t.label, list_dot_product(list_transform(vec, lambda x: x / (sqrt(list_dot_product(vec, vec)) + 1e-12)), tv) AS score FROM vecs, topics t),
 cand AS (SELECT *, CAST(row_number() OVER (PARTITION BY id ORDER BY score DESC, label) AS INTEGER) AS rank FROM tc QUALIFY rank <= 3),
 wide AS (SELECT id, max(CASE WHEN rank = 1 THEN label END) AS m, max(CASE WHEN rank = 1 THEN score END) AS ms, max(CASE WHEN rank = 2 THEN label END) AS s, max(CASE WHEN rank = 2 THEN score END) AS ss FROM cand GROUP BY id)"""
def _alias_case() -> str:
    import re

    out = []
    for place, p in TAIWAN:
        out.append((f"(?i){p}", place))
    for place, names in ALIASES:
        for n in names:
            # no look-behind in this dialect: the neighbours are matched instead
            out.append((f"(?i)(^|[^A-Za-z0-9]){re.escape(n)}($|[^A-Za-z0-9])" if re.search("[A-Za-z]", n) else re.escape(n), place))
    for place, p in SUPPLEMENTAL:
        out.append((f"(?i){p}" if place in ("歐盟", "約旦河西岸", "加沙") else p, place))
    return out


def _canonical_place(c: str) -> str:
    s = f"regexp_replace(coalesce({c}, ''), '\\s+', '', 'g')"
    whens = " ".join(f"WHEN regexp_matches({s}, {_q(p)}) THEN {_q(place)}" for p, place in _alias_case())
    return f"CASE WHEN {s} IN ({','.join(map(_q, ALLOWED))}) THEN {s} {whens} END"


_PLACE0 = f""", raw AS (SELECT id, pos, {_list(NAMES)}[('0x' || substr(md5(text), 1, 8))::BIGINT % {len(NAMES)} + 1] AS raw FROM ent WHERE label IN ('GPE', 'LOC')),
 known AS (SELECT raw, {_canonical_place('raw')} AS place FROM (SELECT DISTINCT raw FROM raw)),
 mention AS (SELECT id, pos, place FROM raw JOIN known USING (raw) WHERE place IS NOT NULL),
 pc AS (SELECT id, place, count(*) AS n, min(pos) AS at0 FROM mention GROUP BY id, place)"""
_PLACE = _ENT + _PLACE0


def _expanded(rows: str, key: str) -> str:
    """Of rows with key, token and body."""
    s = "regexp_replace(coalesce(body, ''), '\\s+', '', 'g')"
    names = sorted(((n, counties) for _, names, counties in REGIONS for n in names), key=lambda x: -len(x[0]))
    pattern = "(" + "|".join(n for n, _ in names) + ")"
    region = "map {" + ", ".join(f"{_q(n)}: {_list(c)}" for n, c in names) + "}"
    of = lambda c: f"flatten(list_transform(regexp_extract_all({c}, {_q(pattern)}, 1), lambda a: ({region})[a]))"
    hits = [f"CASE WHEN regexp_matches({s}, {_q(p)}) THEN {_q(c)} END" for p, c in (*KEYWORDS, ("花東", "花蓮縣"), ("花東", "台東縣"))]
    hits += [f"CASE WHEN regexp_matches({s}, {_q(p)}) THEN {_q(c)} END" for p, c in _alias_case()[len(TAIWAN) :]]
    every = f"list_concat([{_canonical_place('token')}], {of('token')}, {of(s)}, [{','.join(hits)}])"
    return f"SELECT {key}, array_to_string(list_sort(list_distinct(list_filter({every}, lambda x: x IS NOT NULL))), ',') AS places FROM {rows}"


_CASES = ",".join(f"({i},{_q(a)},{_q(b)})" for i, (a, b) in enumerate(REGION_CASES))


_BATCH = "SELECT cluster_id, arg_min(id, published_at * 1000000000 + id) AS first_id, count(*) AS article_count, max(published_at) AS latest_published FROM articles"

ORACLE_SQL = {
    "unclustered_scan_desc": _ART + " SELECT id, title, published_at FROM articles WHERE cluster_id IS NULL AND content IS NOT NULL ORDER BY published_at DESC NULLS LAST, id LIMIT 500",
    "unclustered_scan_asc": _ART + " SELECT id, title, published_at FROM articles WHERE cluster_id IS NULL AND content IS NOT NULL ORDER BY published_at ASC NULLS LAST, id LIMIT 500",
    "recent_corpus_scan": _ART + " SELECT id, media_name, published_at FROM articles WHERE content IS NOT NULL ORDER BY published_at DESC NULLS LAST, id LIMIT 500",
    "recent_cluster_scan": _ART + f" SELECT cluster_id, media_name, max(published_at) AS latest_published FROM articles WHERE cluster_id IS NOT NULL GROUP BY ALL HAVING max(published_at) >= {P.now - 864000}",
    "canonical_text": _CANON + " SELECT id, length(c) AS n, md5(c) AS canon_md5 FROM canon",
    "char_ngrams": _CANON + " SELECT substr(c, i, 3) AS gram, count(*) AS n FROM (SELECT c, unnest(range(1, length(c) - 1)) AS i FROM canon WHERE length(c) >= 3) GROUP BY gram",
    "simhash64_md5": _SIM + " SELECT id, simhash FROM canon JOIN texts USING (c) JOIN sims USING (cls)",
    "lsh_bands": _SIM + " SELECT cls AS id, CAST(b AS INTEGER) AS band, (simhash >> (16 * b)) & 65535 AS bandkey FROM sims, (SELECT unnest(range(0, 4))::INTEGER AS b)",
    "near_dup_pairs": _PAIRS + " SELECT a, b, hamming, round(jaccard, 6) AS jaccard FROM near",
    "copypaste_flags": _MET + " SELECT id, rule IS NOT NULL AS copypaste_flag, coalesce(rule, 'original') AS copypaste_rule FROM articles LEFT JOIN (SELECT id, rule FROM origins) USING (id)",
    "copypaste_origin": _MET + " SELECT id, oi AS origin_id, om AS origin_media, p - op AS delta_secs, hamming, round(jaccard, 3) AS jaccard FROM origins",
    "copypaste_matches_top5": _MET + " SELECT id, CAST(row_number() OVER w AS INTEGER) AS rank, oi AS match_id, hamming, round(jaccard, 3) AS jaccard FROM met WINDOW w AS (PARTITION BY id ORDER BY hamming, jaccard DESC, op, oi) QUALIFY row_number() OVER w <= 5",
    "vec_norm": _ALLVEC + " SELECT id, round(sqrt(list_dot_product(vec, vec)), 6) AS norm, sqrt(list_dot_product(vec, vec)) > 1e-8 AS live FROM vecs",
    "centroid_mean": _ALLVEC + " SELECT label, n, CAST(i - 1 AS INTEGER) AS pos, round(x, 6) AS x FROM comp",
    "centroid_update": _ALLVEC + " SELECT label, CAST(i - 1 AS INTEGER) AS pos, round(x, 6) AS x FROM comp",
    "vec_cosine_pairs": _SIMS + " SELECT id, cluster_id, round(sim, 6) AS sim FROM sims",
    "attach_topk": _SIMS + " SELECT id, cluster_id, round(sim, 6) AS sim, rank FROM ranked WHERE rank <= 20",
    "attach_score": _SCORED + " SELECT id, cluster_id, round(sim, 6) AS sim, round(ent, 6) AS ent, round(place, 6) AS place, round(time, 6) AS time, round(score, 6) AS score FROM final",
    "attach_decision": _SCORED + " SELECT id, CASE WHEN score >= 0.74 THEN cluster_id ELSE id END AS cluster_id, round(score, 6) AS score, score >= 0.74 AS attached_existing FROM (SELECT * FROM final QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, sim DESC, cluster_id) = 1)",
    "topic_candidates": _TOPIC + " SELECT id, label, round(score, 6) AS score, rank FROM cand",
    "topic_decision": _TOPIC + " SELECT id, m AS main_topic, round(ms, 6) AS main_topic_score, CASE WHEN ss >= 0.28 THEN s END AS secondary_topic, CASE WHEN ss >= 0.28 THEN round(ss, 6) ELSE 0.0 END AS secondary_topic_score, ms < 0.3 OR (ss >= 0.28 AND ms - ss < 0.04) AS ambiguous FROM wide",
    "topic_counts": _TOPIC + " SELECT m AS topic, count(*) AS n FROM wide GROUP BY m",
    "entity_counts": _ENT + " SELECT id, text, label, count(*) AS count FROM ent GROUP BY ALL",
    "entity_top10": _ENT + " SELECT media_name, text, label, count(*) AS count, CAST(row_number() OVER (PARTITION BY media_name ORDER BY count(*) DESC, text, label) AS INTEGER) AS rank FROM ent JOIN articles USING (id) GROUP BY media_name, text, label QUALIFY row_number() OVER (PARTITION BY media_name ORDER BY count(*) DESC, text, label) <= 10",
    "entity_jaccard": _ENT + """, x AS (SELECT id, list(DISTINCT text) AS x FROM ent GROUP BY id), t AS (SELECT media_name, text, label, count(*) AS n FROM ent JOIN articles USING (id) GROUP BY media_name, text, label
      QUALIFY row_number() OVER (PARTITION BY media_name ORDER BY count(*) DESC, text, label) <= 10), y AS (SELECT media_name, list(DISTINCT text) AS y FROM t GROUP BY media_name)
      SELECT id, round(CASE WHEN len(x) > 0 AND len(y) > 0 THEN len(list_intersect(x, y)) / len(list_distinct(list_concat(x, y))) ELSE 0.0 END, 6) AS jaccard FROM articles LEFT JOIN x USING (id) LEFT JOIN y USING (media_name)""",
    "article_places_detail": _PLACE + """, l AS (SELECT id, string_agg(place || ':' || n || ':ENTITIES', ',' ORDER BY n DESC, at0, place) AS s FROM pc GROUP BY id)
      SELECT id, coalesce(s, region || ':0:MEDIA_NAME', '') AS detail FROM articles LEFT JOIN l USING (id)""",
    "cluster_places_detail": _PLACE + """, k AS (SELECT id, cluster_id, region FROM articles WHERE cluster_id IS NOT NULL),
      a AS (SELECT cluster_id, place, count(*) AS n, min(id * 1000000 + pos) AS at0 FROM mention JOIN k USING (id) GROUP BY ALL),
      x AS (SELECT cluster_id, string_agg(place || ':' || n || ':ENTITIES', ',' ORDER BY n DESC, at0, place) AS s FROM a GROUP BY cluster_id),
      b AS (SELECT cluster_id, region AS place, count(*) AS n, min(id) AS at0 FROM k WHERE region IS NOT NULL GROUP BY ALL),
      y AS (SELECT cluster_id, string_agg(place || ':' || n || ':MEDIA_NAME', ',' ORDER BY n DESC, at0, place) AS t FROM b GROUP BY cluster_id)
      SELECT cluster_id, coalesce(s, t, '台灣:0:DEFAULT_TAIWAN_IF_LOCAL') AS detail FROM (SELECT DISTINCT cluster_id FROM k) LEFT JOIN x USING (cluster_id) LEFT JOIN y USING (cluster_id)""",
    "place_canonicalize": f"SELECT case_id, raw, {_canonical_place('raw')} AS place FROM (VALUES {','.join(f'({i},{_q(x)})' for i, x in enumerate(PLACE_CASES))}) t(case_id, raw)",
    "region_expand": _expanded(f"(VALUES {_CASES}) t(case_id, token, body)", "case_id"),
    "media_region_join": _ART + f" SELECT {_list(o for o, _ in OUTLETS)}[{_NUMBER}] AS outlet, region, count(*) AS n FROM articles GROUP BY ALL",
    "cluster_places_left_join": _ART + ", b AS (SELECT cluster_id, min(region) AS p FROM articles WHERE cluster_id IS NOT NULL GROUP BY cluster_id) SELECT id, coalesce(p, region) AS place FROM articles LEFT JOIN b USING (cluster_id)",
    "cluster_first_max_count": _ART + f" {_BATCH} WHERE cluster_id IS NOT NULL GROUP BY cluster_id",
    "cluster_merge_update": _ART + " SELECT cluster_id, count(*) AS article_count, max(published_at) AS latest_published FROM articles WHERE cluster_id IS NOT NULL GROUP BY cluster_id",
    "news_upsert": _ART + " SELECT id, CASE WHEN id % 5 = 0 OR id % 4 = 1 THEN id % 13 ELSE cluster_id END AS cluster_id, CASE WHEN id % 4 <> 1 THEN media_name END AS media_name FROM articles",
    "id_split_semi_anti": "SELECT count(*) AS n, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'existing' ELSE 'new' END AS part FROM documents GROUP BY part",
    "epoch_normalize": _ART + " SELECT id, CASE WHEN id % 3 = 2 THEN 0 ELSE published_at END AS secs FROM articles",
    "taipei_format": _ART + " SELECT id, strftime(make_timestamp((published_at + 28800) * 1000000), '%Y-%m-%d %H:%M:%S') || '+0800' AS shown, strftime(make_timestamp(published_at * 1000000), '%m-%d %H:%M') AS short FROM articles",
    "clamp_future": _ART + f" SELECT id, CASE WHEN published_at + id * 3600 > {P.now + 86400} THEN {P.now} ELSE published_at + id * 3600 END AS secs FROM articles",
    "snippet_clip": _ART + " SELECT id, CASE WHEN length(content) > 100 THEN substr(replace(content, chr(10), ' '), 1, 100) || '...' ELSE replace(coalesce(content, ''), chr(10), ' ') END AS snippet, CASE WHEN length(content) > 60 THEN substr(replace(content, chr(10), ' '), 1, 60) || '…' ELSE replace(coalesce(content, ''), chr(10), ' ') END AS short60, CASE WHEN length(content) > 120 THEN substr(replace(content, chr(10), ' '), 1, 120) || '…' ELSE replace(coalesce(content, ''), chr(10), ' ') END AS short120, CASE WHEN length(title) > 40 THEN substr(title, 1, 39) || '…' ELSE coalesce(title, '') END AS clipped FROM articles",
    "json_str": _ART + """ SELECT id, '["' || media_name || '","' || origin || '"]' AS j FROM articles""",
    "report_table": _ART + " SELECT coalesce(cluster_id, -1) AS cluster_id, published_at, id, CASE WHEN length(title) > 60 THEN substr(title, 1, 59) || '…' ELSE title END AS title, media_name FROM articles ORDER BY 1, 2 DESC, 3",
    "hover_places": _PLACE + """, r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY n DESC, at0, place) AS k, count(*) OVER (PARTITION BY id) AS total FROM pc)
      SELECT id, string_agg('• ' || place || ', frequency: ' || n || ', place_source: ENTITIES', '<br>' ORDER BY k) || CASE WHEN any_value(total) > 6 THEN '<br>+' || (any_value(total) - 6) || ' more' ELSE '' END AS hover FROM r WHERE k <= 6 GROUP BY id""",
    "parse_entities": "SELECT * FROM (VALUES (0, 'A B', 'ORG', 3::BIGINT), (0, 'C', NULL, NULL), (1, 'D', 'GPE', NULL), (1, 'E', NULL, NULL), (2, 'F', NULL, NULL), (2, 'G', NULL, NULL), "
    + ", ".join(f"({i}, NULL, NULL, NULL)" for i in range(3, len(ENTITY_CASES))) + ") t(case_id, text, label, count)",
    "job_manifest": _ART + " SELECT CAST(row_number() OVER (ORDER BY media_name) AS INTEGER) AS id, 'report/' || media_name AS visualisation_url, min(published_at) AS start_time, max(published_at) AS end_time FROM articles GROUP BY media_name UNION ALL SELECT CAST(count(DISTINCT media_name) + 1 AS INTEGER), 'report/all', min(published_at), max(published_at) FROM articles",
    "writable_places": _PLACE + f" SELECT id, string_agg(place, ',' ORDER BY n DESC, at0, place) FILTER (place <> '台灣' AND place IN ({','.join(map(_q, WRITABLE))})) AS places FROM pc GROUP BY id",
}
