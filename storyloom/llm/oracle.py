"""SQL for DuckDB, written apart from the operators, of those queries that SQL can express."""

from __future__ import annotations

from .licences import BASE, TEMPLATES

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rows(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in r) + ")" for r in rows)


def _place(template: list[str], phrase: list[str]) -> int:
    return next(i for i in range(len(template)) if template[i : i + len(phrase)] == phrase)


def _licences() -> str:
    words = [(t, k, w) for t, (_, text, _) in enumerate(TEMPLATES) for k, w in enumerate(text.split())]
    must = [(t, _place(text.split(), p.split()) + i, w) for t, (_, text, phrases) in enumerate(TEMPLATES) for p in phrases for i, w in enumerate(p.split())]
    base = [(b, label, k, w, len(p.split())) for b, (p, label) in enumerate(BASE) for k, w in enumerate(p.split())]
    return rf"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
 pos AS (SELECT r, unnest(ws) AS w, unnest(range(0, len(ws))) AS i FROM d),
 template(t, k, w) AS (VALUES {_rows(words)}),
 label(t, label, size) AS (VALUES {_rows([(t, label, len(text.split())) for t, (label, text, _) in enumerate(TEMPLATES)])}),
 must(t, k, w) AS (VALUES {_rows(must)}),
 phrase(b, label, k, w, size) AS (VALUES {_rows(base)}),
 starts AS (SELECT r, t, i - k AS s FROM pos JOIN must USING (w) GROUP BY r, t, i - k HAVING count(*) = (SELECT count(*) FROM must n WHERE n.t = must.t)),
 matched AS (SELECT starts.r, starts.t, s, count(*) AS n FROM starts JOIN template USING (t) JOIN pos ON pos.r = starts.r AND pos.i = s + template.k AND pos.w = template.w GROUP BY ALL),
 own AS (SELECT r, label, max(n / size) AS score FROM matched JOIN label USING (t) GROUP BY r, label),
 found AS (SELECT r, b, label, i - k AS s FROM pos JOIN phrase USING (w) GROUP BY r, b, label, i - k, size HAVING count(*) = size),
 base AS (SELECT r, count(*) AS n, min(s) AS a, max(s) AS z, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM found GROUP BY r),
 every AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT r, label FROM own UNION SELECT r, label FROM found) GROUP BY r),
 best AS (SELECT r, max(score) AS score FROM (SELECT r, score FROM own UNION ALL SELECT r, 1.0 FROM found) GROUP BY r)
 SELECT doc_id, len(ws) AS n_words, coalesce(base.n, 0) AS n_base, base.a AS first_word, base.z AS last_word, coalesce(base.labels, '') AS base_labels,
   coalesce(every.labels, '') AS labels, CAST(coalesce(best.score, 0) AS DOUBLE) AS score
 FROM d LEFT JOIN base USING (r) LEFT JOIN every USING (r) LEFT JOIN best USING (r)"""


def _collisions() -> str:
    return """WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
 unit AS (SELECT vec_id, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS u FROM v WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(e, e) > 0),
 near AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM unit a JOIN unit b ON a.vec_id <> b.vec_id AND len(a.u) = len(b.u) AND list_dot_product(a.u, b.u) >= 0.9),
 reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT reach.a, near.b FROM reach JOIN near ON reach.b = near.a),
 least AS (SELECT a, min(b) AS c FROM reach GROUP BY a), n AS (SELECT a, count(*) AS n FROM near GROUP BY a)
 SELECT vec_id, coalesce(n, 0) AS n_links, c AS component_id, vec_id = c AS kept FROM v LEFT JOIN least ON least.a = vec_id LEFT JOIN n ON n.a = vec_id"""


ORACLE_SQL = {"op3_licences": _licences(), "op7_collisions": _collisions()}
