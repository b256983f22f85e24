"""The secret scan in DuckDB SQL: windows are counted afresh, not incrementally."""

from __future__ import annotations

from .secrets import ALLOW, ASSIGN_MIN, BASE, CANDIDATE, CLASSES, WINDOW, entropy_terms, most_terms


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _source(kind: str, rank: int, pattern: str) -> str:
    p = _text(pattern)
    return f"SELECT rid, '{kind}' AS kind, {rank} AS rank, regexp_extract_all(t, {p}, 0) AS ms, string_split_regex(t, {p}) AS ps FROM d"


_SOURCES = [(k, i, p) for i, (k, p) in enumerate([*BASE.items(), ("run", CANDIDATE)], 1)]
_CLASS = (
    f"CASE WHEN regexp_full_match(m, '[0-9a-f]+') THEN {most_terms(WINDOW, CLASSES['hex'][1])} "
    f"WHEN regexp_full_match(m, '[0-9A-Za-z]+') THEN {most_terms(WINDOW, CLASSES['alnum'][1])} ELSE {most_terms(WINDOW, CLASSES['base64'][1])} END"
)

OP1_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
src AS ({' UNION ALL '.join(_source(*x) for x in _SOURCES)}),
one AS (SELECT rid, kind, rank, unnest(range(1, len(ms) + 1)) AS i, unnest(ms) AS m, unnest(ps[1:len(ms)]) AS p FROM src WHERE len(ms) > 0),
pos AS (
  SELECT rid, kind, rank, m, CAST(sum(length(p) + length(m)) OVER (PARTITION BY rid, kind ORDER BY i) AS BIGINT) AS e FROM one
),
base AS (
  SELECT rid, kind, rank, e - length(m) AS s, e FROM pos
  WHERE kind IN ('access', 'hex') OR (kind = 'assign' AND length(regexp_extract(m, {_text(BASE['assign'])}, 2)) >= {ASSIGN_MIN})
),
runs AS (
  SELECT rid, row_number() OVER () AS run, m, e - length(m) AS s, {_CLASS} AS most FROM pos
  WHERE kind = 'run' AND NOT ({' OR '.join(f'regexp_matches(m, {_text(p)})' for p in ALLOW)})
),
win AS (SELECT rid, run, s, most, o, unnest(string_split(substr(m, o + 1, {WINDOW}), '')) AS ch
  FROM (SELECT *, unnest(range(0, length(m) - {WINDOW} + 1)) AS o FROM runs)),
cnt AS (SELECT rid, run, s, most, o, ch, count(*) AS c FROM win GROUP BY ALL),
ent AS (SELECT rid, run, s, most, o, sum(({entropy_terms()})[c + 1]) AS terms FROM cnt GROUP BY ALL),
hot AS (SELECT rid, run, min(s + o) AS s, max(s + o) + {WINDOW} AS e FROM ent WHERE terms <= most GROUP BY 1, 2),
added AS (
  SELECT rid, 'entropy' AS kind, 4 AS rank, s, e FROM hot h
  WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.rid = h.rid AND h.s >= b.s AND h.e <= b.e)
),
spans AS (SELECT * FROM base UNION ALL SELECT * FROM added),
agg AS (
  SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex, count(*) FILTER (kind = 'entropy') AS n_entropy,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (kind <> 'entropy') AS base,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS spans
  FROM spans GROUP BY rid
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_entropy, 0) AS n_entropy
FROM d LEFT JOIN agg ON d.rid = agg.rid
"""
