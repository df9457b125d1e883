"""SQL counterparts of the queries that SQL can express, for DuckDB over the whole table."""

from __future__ import annotations

import math

from . import secrets


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


WORDS = r"""words AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents)"""

OP6 = f"""WITH {WORDS},
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM words WHERE len(w) >= 35),
windows AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS h FROM starts),
often AS (SELECT h FROM windows GROUP BY h HAVING count(*) > 1),
hits AS (SELECT doc_id, i FROM windows WHERE h IN (SELECT h FROM often)),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS k FROM hits),
places AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM words),
kept AS (SELECT p.doc_id, string_agg(p.word, ' ' ORDER BY p.k) AS kept, count(*) AS n FROM places p LEFT JOIN gone g ON g.doc_id = p.doc_id AND g.k = p.k WHERE g.k IS NULL GROUP BY p.doc_id)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(len(w.w) - coalesce(k.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256 FROM words w LEFT JOIN kept k ON k.doc_id = w.doc_id"""

OP7 = r"""WITH RECURSIVE words AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM words WHERE len(w) > 0),
shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 1], ' ') AS s FROM starts),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT c.a, c.b FROM common c JOIN sizes x ON x.doc_id = c.a JOIN sizes y ON y.doc_id = c.b WHERE 100 * c.c >= 80 * (x.n + y.n - c.c)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a AS doc_id, b AS other FROM edges UNION SELECT r.doc_id, e.b FROM reach r JOIN edges e ON e.a = r.other),
smallest AS (SELECT doc_id, min(other) AS m FROM reach GROUP BY doc_id)
SELECT w.doc_id, CAST(coalesce(z.n, 0) AS BIGINT) AS n_shingles, least(w.doc_id, coalesce(l.m, w.doc_id)) AS component_id, least(w.doc_id, coalesce(l.m, w.doc_id)) = w.doc_id AS kept FROM words w LEFT JOIN sizes z ON z.doc_id = w.doc_id LEFT JOIN smallest l ON l.doc_id = w.doc_id"""

OP13 = r"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || CAST(doc_id AS VARCHAR)) AS h FROM documents),
units AS (SELECT *, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u, [CAST('0x' || substr(h, 8 * i + 1, 8) AS UBIGINT) FOR i IN range(0, 4)] AS r FROM d),
cuts AS (SELECT *, len(u) AS n, least(r[1] % (len(u) + 1), r[2] % (len(u) + 1)) AS a, greatest(r[1] % (len(u) + 1), r[2] % (len(u) + 1)) AS b,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR r[3] % 100 >= 50 THEN 'plain' WHEN r[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM units),
parts AS (SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:n], '') AS s FROM cuts)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256 FROM parts"""


def _places(name: str, pattern: str, value: int = 0) -> str:
    """Rows (doc_id, hit, val, start) of all matches: lengths of pieces and matches before one add up to its start."""
    p = _quoted(pattern)
    return f"""{name}0 AS (SELECT doc_id, string_split_regex(text, {p}) AS pieces, regexp_extract_all(text, {p}) AS hits, regexp_extract_all(text, {p}, {value}) AS vals FROM d WHERE regexp_matches(text, {p})),
{name}1 AS (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM {name}0),
{name} AS (SELECT doc_id, hits[i] AS hit, vals[i] AS val, CAST(list_sum(list_transform(pieces[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS start FROM {name}1)"""


def _secrets() -> str:
    limits = [int((math.log2(secrets.WINDOW) - h) * secrets.WINDOW * 1e6 // 1) for _, h in secrets.CLASSES]
    allowed = " OR ".join(f"regexp_matches(hit, {_quoted(p)})" for p in secrets.ALLOWED)
    digit, lower, upper = (f"regexp_matches(hit, '[{c}]')" for c in ("0-9", "a-z", "A-Z"))
    count = lambda kind: f"CAST(coalesce(n.{kind}, 0) AS BIGINT) AS n_{kind}"
    joined = lambda name, rows: f"{name} AS (SELECT doc_id, string_agg(kind || ':' || CAST(start AS VARCHAR) || ':' || CAST(stop AS VARCHAR), ',' ORDER BY start, rank, stop) AS spans FROM {rows} GROUP BY doc_id)"
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
{_places("m0", secrets.ASSIGN, 2)}, {_places("m1", secrets.ACCESS)}, {_places("m2", secrets.HEX)}, {_places("m3", secrets.CANDIDATE)},
base AS (SELECT doc_id, start, 0 AS rank, start + length(hit) AS stop, 'assign' AS kind FROM m0 WHERE length(val) >= {secrets.ASSIGN_CHARS}
  UNION ALL SELECT doc_id, start, 1, start + length(hit), 'access' FROM m1 UNION ALL SELECT doc_id, start, 2, start + length(hit), 'hex' FROM m2),
candidates AS (SELECT doc_id, start, start + length(hit) AS stop, hit, replace(hit, '=', '') AS chars,
    CASE WHEN {digit} AND regexp_matches(hit, '^[0-9a-fA-F]+$') THEN {limits[0]} WHEN {digit} AND {lower} AND {upper} THEN {limits[1]} WHEN {digit} AND ({lower} OR {upper}) THEN {limits[2]} WHEN regexp_matches(hit, '[A-Z][a-z][A-Z].*[A-Z][a-z][A-Z]') THEN {limits[3]} ELSE -1 END AS most FROM m3),
fit AS (SELECT c.* FROM candidates c WHERE most >= 0 AND NOT ({allowed}) AND NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = c.doc_id AND b.start <= c.start AND c.stop <= b.stop)),
windows AS (SELECT doc_id, start, stop, most, chars, unnest(range(1, greatest(length(chars) - {secrets.WINDOW - 1}, 1) + 1)) AS i FROM fit),
letters AS (SELECT doc_id, start, stop, most, i, unnest(string_split(substring(chars, i, {secrets.WINDOW}), '')) AS c FROM windows),
counts AS (SELECT doc_id, start, stop, most, i, c, count(*) AS n FROM letters GROUP BY ALL),
sums AS (SELECT doc_id, start, stop, most, i, sum(CAST(round(n * log2(n) * 1000000) AS BIGINT)) AS s FROM counts GROUP BY ALL),
entropy AS (SELECT doc_id, start, 3 AS rank, stop, 'entropy' AS kind FROM sums GROUP BY doc_id, start, stop, most HAVING min(s) <= most),
every AS (SELECT * FROM base UNION ALL SELECT * FROM entropy),
{joined("base_text", "base")}, {joined("all_text", "every")},
n AS (SELECT doc_id, {", ".join(f"sum(CASE WHEN kind = '{k}' THEN 1 ELSE 0 END) AS {k}" for k in secrets.KINDS)} FROM every GROUP BY doc_id)
SELECT d.doc_id, {", ".join(map(count, secrets.KINDS))}, sha256(coalesce(b.spans, '')) AS base_sha256, coalesce(a.spans, '') AS spans
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN base_text b ON b.doc_id = d.doc_id LEFT JOIN all_text a ON a.doc_id = d.doc_id"""


OP1 = _secrets()
