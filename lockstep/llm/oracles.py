"""SQL counterparts of the operators' queries, for DuckDB."""

_WORDS = "regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2f\\x3a-\\x40\\x5b-\\x60\\x7b-\\x7f]+')"

OP2 = f"""
WITH items AS (
  SELECT item_id, w, least(5, len(w)) AS n FROM (SELECT item_id, {_WORDS.format("text")} AS w FROM benchmark) WHERE len(w) > 0),
grams AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT item_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM items)),
sizes AS (SELECT item_id, n, count(*) AS q FROM grams GROUP BY ALL),
docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format("text")} AS w FROM documents),
held AS (
  SELECT DISTINCT r, doc_id, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT r, doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM items)))
SELECT doc_id, item_id, count(*) / any_value(q)::DOUBLE AS containment
FROM held JOIN grams USING (n, g) JOIN sizes USING (item_id, n)
GROUP BY r, doc_id, item_id HAVING count(*) / any_value(q)::DOUBLE >= 0.8 - 1e-12
"""

_RULES = (
    ("assign", r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
    ("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    ("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1),
)


def _rule_sql(k: int, name: str, pattern: str, group: int, least: int) -> str:
    p = pattern.replace("'", "''")
    sizes = "list_transform({}, lambda x: length(x))"
    return f"""SELECT r, {k} AS kind, '{name}' AS name, {least} AS least, unnest(range(1, len(m) + 1)) AS i, unnest(g[:len(m)]) AS gap, unnest(m) AS len, unnest(t) AS told FROM (
      SELECT r, {sizes.format(f"string_split_regex(text, '{p}')")} AS g, {sizes.format(f"regexp_extract_all(text, '{p}')")} AS m, {sizes.format(f"regexp_extract_all(text, '{p}', {group})")} AS t
      FROM docs WHERE regexp_matches(text, '{p}'))"""


OP7 = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
each AS ({" UNION ALL ".join(_rule_sql(k, *x) for k, x in enumerate(_RULES))}),
placed AS (SELECT *, sum(gap + len) OVER (PARTITION BY r, kind ORDER BY i) AS stop FROM each),
spans AS (SELECT r, kind, stop - len AS start, name || ':' || (stop - len)::BIGINT || ':' || stop::BIGINT AS line FROM placed WHERE told >= least),
told AS (SELECT r, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
  string_agg(line, ',' ORDER BY start, kind) FILTER (kind < 3) AS base, string_agg(line, ',' ORDER BY start, kind) AS spans FROM spans GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN told USING (r)
"""

_ESC = "replace(replace(replace({}, '\\', '\\\\'), '<', '\\l'), '>', '\\g')"
OP3 = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(16 + length(replace({_ESC.format("role")}, chr(10), '\\n')) + length({_ESC.format("text")}))::BIGINT AS formatted_chars
FROM rows GROUP BY conv_id
"""

OP11 = r"""
WITH docs AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
pieces AS (SELECT row_number() OVER () AS piece, lang, p FROM (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS p FROM docs)),
split AS (SELECT piece, lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces),
placed AS (SELECT piece, lang, unnest(w) AS w1, unnest(range(1, len(w) + 1)) AS i FROM split),
tails AS (SELECT lang, w1, lead(w1, 1) OVER p AS w2, lead(w1, 2) OVER p AS w3 FROM placed WINDOW p AS (PARTITION BY piece ORDER BY i)),
grams AS (
  SELECT lang, 1 AS size, w1 AS phrase FROM tails UNION ALL SELECT lang, 2, w1 || ' ' || w2 FROM tails WHERE w2 IS NOT NULL
  UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 FROM tails WHERE w3 IS NOT NULL),
counts AS MATERIALIZED (SELECT lang, phrase, size, count(*) AS f FROM grams GROUP BY ALL),
sizes AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE size = 1 GROUP BY lang),
cand AS MATERIALIZED (SELECT lang, phrase, string_split(phrase, ' ') AS w, size, f AS a FROM counts WHERE size > 1 AND f >= 10),
halves AS MATERIALIZED (SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS lp, array_to_string(w[k + 1:], ' ') AS rp FROM (SELECT *, unnest(range(1, size)) AS k FROM cand)),
cuts AS (
  SELECT c.lang, c.phrase, c.a, k, l.f AS l, r.f AS r, (1000000::HUGEINT * c.a * c.a) // (l.f::HUGEINT * r.f) AS score
  FROM halves c JOIN counts l ON l.lang = c.lang AND l.phrase = c.lp JOIN counts r ON r.lang = c.lang AND r.phrase = c.rp),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (SELECT lang, phrase, max(f) AS f FROM (
  SELECT lang, array_to_string(w[1:2], ' ') AS phrase, a AS f FROM cand WHERE size = 3 UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM cand WHERE size = 3) GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN longer o ON o.lang = b.lang AND o.phrase = b.phrase WHERE o.f IS NULL OR 100 * o.f < 50 * b.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
"""
