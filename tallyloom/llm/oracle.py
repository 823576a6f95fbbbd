"""DuckDB SQL of the dealt operators, where SQL can express them."""

from __future__ import annotations

from tallyloom.llm.pii import LENGTHS

SQL: dict[str, str] = {}

SQL["op1_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""

SQL["op2_minhash_near_dedup"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [list_aggregate(w, 'string_agg', ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3]) END) AS s FROM words
), classes AS (SELECT hash(list_sort(s)) AS c, any_value(s) AS s, min(doc_id) AS rep FROM sets WHERE len(s) > 0 GROUP BY list_sort(s)
), items AS (SELECT rep, len(s) AS n, unnest(s) AS g FROM classes
), shared AS (
  SELECT a.rep AS x, b.rep AS y, count(*) AS k, any_value(a.n) AS nx, any_value(b.n) AS ny
  FROM items a JOIN items b ON a.g = b.g AND a.rep < b.rep GROUP BY ALL
), links AS (SELECT x, y FROM shared WHERE 100 * k >= 80 * (nx + ny - k)
), edges AS (SELECT x, y FROM links UNION SELECT y, x FROM links
), reach(a, b) AS (SELECT rep, rep FROM classes UNION SELECT r.a, e.y FROM reach r JOIN edges e ON r.b = e.x
), comp AS (SELECT a AS rep, min(b) AS component_id FROM reach GROUP BY a
), placed AS (
  SELECT s.doc_id, len(s.s) AS n_shingles, coalesce(m.component_id, s.doc_id) AS component_id
  FROM sets s LEFT JOIN classes c ON len(s.s) > 0 AND c.c = hash(list_sort(s.s)) LEFT JOIN comp m ON m.rep = c.rep
)
SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM placed
"""

SQL["op9_url_filter"] = """
WITH rules(host, path, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
cut AS (SELECT page_id, row_number() OVER () AS r, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
hosts AS (SELECT *, regexp_extract(rest, '^[^/?#]*') AS h FROM cut),
parts AS (SELECT page_id, r, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(substr(rest, length(h) + 1), '^[^?#]*') AS path FROM hosts),
best AS (
  SELECT p.r, max_by(u.host || u.path, length(u.host || u.path)) AS rule, max_by(u.verdict, length(u.host || u.path)) AS verdict
  FROM parts p JOIN rules u ON (p.host = u.host OR ends_with(p.host, '.' || u.host)) AND starts_with(p.path, u.path) GROUP BY p.r
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN best USING (r)
"""


_COUNTRIES = "|".join(c for v in LENGTHS.values() for c in v.split())
_KNOWN_START = f"({_COUNTRIES})([0-9]{{2}})"
_IBAN = "|".join([f"\\x01(?:{v.replace(' ', '|')})\\x02[0-9]{{2}}(?:\\x20?\\x01?[A-Z0-9]\\x02?){{{n - 4}}}" for n, v in LENGTHS.items()]
                 + ["[A-Z]{2}[0-9]{2}(?:\\x20?[A-Z0-9]){11,30}"])


def _either(words: str) -> str:
    """``words`` with every ASCII letter in either case; (?i) would also take letters that fold to one beyond ASCII."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


def _matches(kinds: dict[str, str]) -> str:
    """CTEs: texts, and m (r, kind, start, fin, hit) of every leftmost match, positions from the gaps between matches.

    Account numbers are matched in a text where chr(1) and chr(2) enclose each known country code that two digits follow:
    DuckDB's patterns can't look ahead.
    """
    def one(kind, p):
        source = "marked" if kind == "iban" else "text"
        bare = "list_transform({}, lambda x: translate(x, chr(1) || chr(2), ''))" if kind == "iban" else "{}"
        both = bare.format(f"regexp_extract_all({source}, '{p}')"), bare.format(f"regexp_split_to_array({source}, '{p}')")
        return f"SELECT r, '{kind}' AS kind, {both[0]} AS hits, {both[1]} AS gaps FROM texts"
    each = " UNION ALL ".join(one(k, p.replace("'", "''")) for k, p in kinds.items())
    return f"""raw AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
texts AS (SELECT *, regexp_replace(translate(text, chr(1) || chr(2), chr(3) || chr(3)), '{_KNOWN_START}', chr(1) || '\\1' || chr(2) || '\\2', 'g') AS marked FROM raw),
lists AS ({each}),
numbered AS (SELECT r, kind, hits, gaps, unnest(range(1, len(hits) + 1)) AS i FROM lists WHERE len(hits) > 0),
m AS (
  SELECT r, kind, hits[i] AS hit, CAST(list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS start,
         start + length(hits[i]) AS fin
  FROM numbered
)"""


_ASSIGN = "(?:" + "|".join(_either(w) for w in ("password", "passwd", "secret", "token", "api_?key")) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_WEAK_ID = "(?:" + "|".join(_either(w) for w in ("client_?id", "username", "login", "account_?id")) + r""")[\x22']?\x20*[:=]\x20*[\x22']?[A-Za-z0-9._@-]+"""
SQL["op5_secret_scan"] = f"""
WITH {_matches({"assign": _ASSIGN, "access": "AKIA[A-Z0-9]+", "hex": "[0-9a-f]{24,}", "weak_id": _WEAK_ID, "weak_key": "[A-Za-z0-9+/_=-]{20,}",
                "endpoint": "https?://[A-Za-z0-9.-]+(?::[0-9]+)?", "url": "https?://[A-Za-z0-9.-]+[^ \\t\\n\\v\\f\\r\\x22'<>]*"})},
good AS (
  SELECT r, kind, start, fin, kind IN ('assign', 'access', 'hex') AS base, list_position(['assign', 'access', 'hex', 'weak_id', 'weak_key', 'endpoint', 'url'], kind) AS o,
         CASE WHEN kind IN ('assign', 'hex', 'weak_key') THEN 'secret' WHEN kind IN ('access', 'weak_id') THEN 'identifier' WHEN kind = 'endpoint' THEN 'endpoint' END AS role
  FROM m WHERE CASE kind WHEN 'assign' THEN length(regexp_extract(hit, '{_ASSIGN.replace("'", "''")}', 1)) >= 6 WHEN 'access' THEN length(hit) >= 20
    WHEN 'weak_key' THEN regexp_matches(hit, '[0-9]') AND regexp_matches(hit, '[a-z]') AND regexp_matches(hit, '[A-Z]') ELSE true END
), parts AS (
  SELECT g.*, CASE WHEN kind = 'endpoint' THEN greatest(fin, (SELECT max(u.fin) FROM good u WHERE u.r = g.r AND u.kind = 'url' AND u.start <= g.start)) ELSE fin END AS reach
  FROM good g WHERE kind <> 'url' AND NOT (kind = 'weak_key' AND EXISTS (
    SELECT 1 FROM good i WHERE i.r = g.r AND i.kind = 'weak_id' AND i.start < g.fin AND i.fin > g.start))
), near AS (
  SELECT p.r, p.kind, p.start, p.fin, {", ".join(f"bool_or(q.role = '{x}' AND ((q.reach <= p.start AND p.start - q.fin <= 200) OR (q.start >= p.reach AND q.start - p.fin <= 200))) AS {x}_near" for x in ("identifier", "secret", "endpoint"))},
         bool_or(q.base AND q.start < p.fin AND q.fin > p.start) AS covered
  FROM parts p JOIN parts q USING (r) GROUP BY ALL
), said AS (
  SELECT r, kind, start, o, fin, base, kind || ':' || start || ':' || fin AS s, base OR (NOT covered AND CASE role WHEN 'identifier' THEN secret_near
    WHEN 'secret' THEN identifier_near OR endpoint_near ELSE identifier_near AND secret_near END) AS reported FROM parts JOIN near USING (r, kind, start, fin)
), sums AS (
  SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(s, ',' ORDER BY start, o, fin) FILTER (base) AS b, string_agg(s, ',' ORDER BY start, o, fin) FILTER (reported) AS spans,
         count(*) FILTER (reported AND NOT base) AS n_linked FROM said GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(b, '')) AS base_sha256,
       coalesce(spans, '') AS spans, coalesce(n_linked, 0) AS n_linked FROM texts LEFT JOIN sums USING (r)
"""

_LUHN = """list_sum(list_transform(range(0, length(d)), lambda i: CASE WHEN i % 2 = 0 THEN CAST(substr(d, length(d) - i, 1) AS INT)
  WHEN CAST(substr(d, length(d) - i, 1) AS INT) > 4 THEN 2 * CAST(substr(d, length(d) - i, 1) AS INT) - 9 ELSE 2 * CAST(substr(d, length(d) - i, 1) AS INT) END)) % 10 = 0"""
_MOD97 = """list_reduce(list_transform(range(1, length(turned) + 1), lambda i: CASE WHEN ascii(substr(turned, i, 1)) < 58 THEN ascii(substr(turned, i, 1)) - 48
  ELSE ascii(substr(turned, i, 1)) - 55 END), lambda a, x: (a * (CASE WHEN x > 9 THEN 100 ELSE 10 END) + x) % 97) = 1"""


def _near(words: str) -> str:
    return f"CASE WHEN regexp_matches(context, '(^|[^a-z])({words})($|[^a-z])') THEN 0.3 ELSE 0 END"


SQL["op10_pii"] = f"""
WITH {_matches({"email": "[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:[.][A-Za-z0-9-]+)+", "ip": "[0-9]+(?:[.][0-9]+)(?:[.][0-9]+)(?:[.][0-9]+)", "card": "[0-9](?:[\\x20-]?[0-9])+",
                "phone": "[+][0-9][\\x20().0-9-]+[0-9]", "iban": _IBAN, "national_id": "[0-9]{3}-[0-9]{2}-[0-9]{4}",
                "local_phone": "[(]?[0-9]{3}[)]?[\\x20.-][0-9]{3}[\\x20.-][0-9]{4}"})},
d AS (SELECT *, regexp_replace(hit, '[^0-9]', '', 'g') AS d, regexp_replace(hit, '[^A-Z0-9]', '', 'g') AS plain, substr(plain, 5) || substr(plain, 1, 4) AS turned,
  lower(right(left(text, start), 40) || ' ' || substr(text, fin + 1, 20)) AS context FROM m JOIN texts USING (r)),
tested AS (
  SELECT r, start, fin, context, hit, length(d) AS n, CASE WHEN kind = 'card' AND length(d) BETWEEN 13 AND 15 THEN 'short_card' ELSE kind END AS kind,
         CASE WHEN kind = 'card' AND length(d) BETWEEN 13 AND 19 THEN {_LUHN} WHEN kind = 'iban' THEN {_MOD97} ELSE false END AS passes FROM d
), scored AS (
  SELECT *, kind IN ('email', 'ip', 'card', 'phone') AS basic, CASE kind
    WHEN 'email' THEN true WHEN 'ip' THEN len(list_filter(string_split(hit, '.'), lambda x: length(ltrim(x, '0')) > 3 OR coalesce(try_cast(right(ltrim(x, '0'), 3) AS INT), 0) > 255)) = 0
    WHEN 'card' THEN n BETWEEN 16 AND 19 AND passes WHEN 'phone' THEN n BETWEEN 8 AND 15
    WHEN 'iban' THEN passes WHEN 'short_card' THEN passes
    WHEN 'national_id' THEN 0.3 + {_near("ssn|social security|national id|passport|tax id")} >= 0.5
    ELSE 0.3 + {_near("phone|tel|call|mobile|fax")} >= 0.5 END AS reported FROM tested
), said AS (
  SELECT r, kind, start, fin, basic AND reported AS base, reported, kind || ':' || start || ':' || fin AS s,
         list_position(['email', 'ip', 'card', 'phone', 'iban', 'short_card', 'national_id', 'local_phone'], kind) AS o FROM scored
), sums AS (
  SELECT r, {", ".join(f"count(*) FILTER (base AND kind = '{k}') AS n_{k}" for k in ("email", "ip", "card", "phone"))},
         string_agg(s, ',' ORDER BY o, start, fin) FILTER (base) AS b, string_agg(s, ',' ORDER BY o, start, fin) FILTER (reported) AS spans,
         count(*) FILTER (reported AND NOT base) AS n_scored FROM said GROUP BY r
)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in ("email", "ip", "card", "phone"))}, sha256(coalesce(b, '')) AS base_sha256,
       coalesce(spans, '') AS spans, coalesce(n_scored, 0) AS n_scored FROM texts LEFT JOIN sums USING (r)
"""

_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
SQL["op12_ranked_search"] = f"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS r, {_TERMS} AS terms FROM documents),
size AS (SELECT count(*) FILTER (len(terms) > 0) AS documents, CAST(sum(len(terms)) AS BIGINT) AS total FROM docs),
held AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM docs) GROUP BY r, term),
asked AS (SELECT i, any_value(item_id) AS item_id, term, count(*) AS times
          FROM (SELECT i, item_id, unnest(terms) AS term FROM (SELECT row_number() OVER () AS i, item_id, {_TERMS} AS terms FROM benchmark)) GROUP BY i, term),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(documents) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM held, size GROUP BY term),
sizes AS (SELECT r, doc_id, 75 + (25 * len(terms) * documents) // total AS m FROM docs, size WHERE len(terms) > 0),
scores AS (
  SELECT i, any_value(item_id) AS item_id, any_value(doc_id) AS doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM asked JOIN held USING (term) JOIN weights USING (term) JOIN sizes USING (r) GROUP BY i, r
), places AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id ASC NULLS LAST) AS place FROM scores WHERE score > 0)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM places WHERE place <= 20
"""
