"""DuckDB SQL for the queries that SQL can express, written from their definitions and not from the operators."""

from __future__ import annotations

# Fixed values of the url query: the walk's damping and steps, and the least distrust in mean seeds.
DAMPING, STEPS, LEAST_DISTRUST = 0.85, 8, 0.05
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = r"'[^\x20\x09-\x0D]+'"

OP3 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), {_WORDS}) AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)]) END AS s FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
met AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) + any_value(b.n) AS n, count(*) AS c
  FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM met WHERE 100 * c >= 85 * (n - c)),
undirected AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, x.b FROM reach r JOIN undirected x ON x.a = r.b)
SELECT s.doc_id, len(s.s) AS n_shingles, r.component_id
FROM s JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) r ON r.a = s.doc_id
"""

_RULES = (
    ("assign", 1, r"""(?i:(password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", 1, r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", 1, r"[0-9a-f]+", 0, 16),
    ("forge", 1, r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    ("jwt", 1, r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40),
    ("key", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
)
_FOUND = " UNION ALL ".join(
    f"SELECT doc_id, {i} AS rank, '{kind}' AS kind, {least} AS least, regexp_extract_all(t, '{rx}') AS m, regexp_extract_all(t, '{rx}', {group}) AS g, "
    f"regexp_split_to_array(t, '{rx}') AS gap FROM d" for i, (kind, _, rx, group, least) in enumerate(_RULES))
OP7 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({_FOUND}),
places AS (
  SELECT doc_id, rank, kind, least, unnest(range(1, len(m) + 1)) AS i, m, g, gap FROM found WHERE len(m) > 0),
spans AS (
  SELECT doc_id, rank, kind, length(g[i]) AS size, least, list_sum([length(x) FOR x IN gap[1:i]]) + coalesce(list_sum([length(x) FOR x IN m[1:i - 1]]), 0) AS start, length(m[i]) AS n FROM places),
kept AS (SELECT doc_id, rank, kind, start, kind || ':' || start::BIGINT || ':' || (start + n)::BIGINT AS s FROM spans WHERE size >= least),
rows AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS c, count(*) FILTER (kind = 'hex') AS h,
    coalesce(string_agg(s, ',' ORDER BY start, rank) FILTER (rank < 3), '') AS base, string_agg(s, ',' ORDER BY start, rank) AS spans FROM kept GROUP BY doc_id)
SELECT d.doc_id, coalesce(a, 0) AS n_assign, coalesce(c, 0) AS n_access, coalesce(h, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN rows USING (doc_id)
"""


def _propagated(name: str, seeds: str, src: str, dst: str) -> str:
    """CTEs of a personalised PageRank, one for each step."""
    parts = [f"{name}_share AS (SELECT {src} AS src, {dst} AS dst, weight / sum(weight) OVER (PARTITION BY {src}) AS share FROM edges)",
             f"{name}_seed AS (SELECT host, part / sum(part) OVER () AS seed FROM (SELECT host, {seeds} / n AS part FROM hosts WHERE {seeds} > 0))",
             f"{name}0 AS (SELECT host, seed AS score FROM {name}_seed)"]
    for i in range(1, STEPS + 1):
        parts.append(f"{name}{i} AS (SELECT host, sum(score) AS score FROM (SELECT dst AS host, {DAMPING} * score * share AS score FROM {name}{i - 1} JOIN {name}_share ON src = host "
                     f"UNION ALL SELECT host, (1 - {DAMPING}) * seed FROM {name}_seed) GROUP BY host)")
    return ",\n".join(parts)


OP8 = rf"""
WITH u AS (SELECT page_id, html, CASE WHEN contains(coalesce(url, ''), '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, html, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM u),
q AS (SELECT page_id, html, translate(raw, '{_UPPER}', '{_LOWER}') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM p),
rules(rule, verdict, rule_host, rule_path) AS (VALUES ('com/', 'allow', 'com', '/'), ('example.com/en/', 'block', 'example.com', '/en/'),
  ('www.example.com/en/', 'allow', 'www.example.com', '/en/'), ('net/es/', 'block', 'net', '/es/'), ('net/fr/', 'block', 'net', '/fr/')),
fit AS (
  SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict FROM q JOIN rules
  ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY page_id),
j AS (SELECT q.page_id, q.html, host, path, rule, verdict FROM q LEFT JOIN fit USING (page_id)),
hosts AS (SELECT host, count(*) AS n, count(*) FILTER (verdict = 'allow') AS allowed, count(*) FILTER (verdict = 'block') AS blocked FROM j WHERE host <> '' GROUP BY host),
links AS (SELECT host AS a, translate(unnest(regexp_extract_all(html, '(?i)<a\s[^>]*?href\s*=\s*["'']?(?:https?:)?//([^/?#"''\s>]+)', 1)), '{_UPPER}', '{_LOWER}') AS b FROM j),
edges AS (SELECT a, b, count(*)::DOUBLE AS weight FROM links WHERE a <> '' AND a <> b GROUP BY a, b),
{_propagated('trust', 'allowed', 'a', 'b')},
{_propagated('distrust', 'blocked', 'b', 'a')},
rated AS (SELECT d.host, (d.score - (1 - {DAMPING}) * coalesce(s.seed, 0)) * (SELECT count(*) FROM distrust_seed) AS distrust, coalesce(t.score, 0) * (SELECT count(*) FROM trust_seed) AS trust
  FROM distrust{STEPS} d LEFT JOIN trust{STEPS} t ON t.host = d.host LEFT JOIN distrust_seed s ON s.host = d.host),
bad AS (SELECT host FROM rated WHERE distrust > trust AND distrust >= {LEAST_DISTRUST})
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN host IN (SELECT host FROM bad) THEN 'block' ELSE 'allow' END) AS verdict FROM j
"""

OP9 = rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS w FROM documents),
windows AS (SELECT doc_id, s, array_to_string(w[s:s + 49], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS s FROM w WHERE len(w) >= 50)),
bad AS (SELECT doc_id, s FROM (SELECT doc_id, s, min(doc_id) OVER (PARTITION BY k) AS low FROM windows) WHERE low < doc_id),
gone AS (SELECT DISTINCT doc_id, s + o AS pos FROM bad, range(0, 50) t(o)),
placed AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS pos, unnest(w) AS word FROM w),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS t FROM placed ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT w.doc_id, len(w.w) AS n_words, len(w.w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)
"""

OP10 = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents),
i AS (SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark),
dw AS (SELECT doc_id, len(w) AS dn, unnest(range(0, len(w))) AS d_at, unnest(w) AS word FROM d),
iw AS (SELECT item_id, len(w) AS n, least(len(w), 15) AS size, CASE WHEN len(w) < 15 THEN len(w) ELSE 12 END AS need, unnest(range(0, len(w))) AS i_at, unnest(w) AS word FROM i WHERE len(w) >= 5),
same AS (SELECT doc_id, item_id, dn, n, size, need, d_at - i_at AS shift, i_at FROM dw JOIN iw USING (word)),
line AS (SELECT doc_id, item_id, dn, n, size, need, shift, list(i_at) AS hits FROM same GROUP BY ALL HAVING count(*) >= need),
win AS (SELECT doc_id, item_id, dn, shift, size, need, hits, unnest(range(0, n - size + 1)) AS s FROM line),
scored AS (
  SELECT doc_id, item_id, shift, need, max(len(list_filter(hits, lambda h: h >= s AND h < s + size))) AS matched FROM win
  WHERE shift + s >= 0 AND shift + s + size <= dn GROUP BY doc_id, item_id, shift, need)
SELECT doc_id, item_id, min(shift)::BIGINT AS start, max(matched)::BIGINT AS matched, count(*) AS n_found FROM scored WHERE matched >= need GROUP BY doc_id, item_id
"""

ORACLE = {"op3_ngram_jaccard": OP3, "op7_secrets": OP7, "op8_urls": OP8, "op9_substring": OP9, "op10_decontaminate": OP10}
