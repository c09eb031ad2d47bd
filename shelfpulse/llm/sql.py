"""DuckDB SQL for the queries that SQL can express on whole tables.

Suffix dedup, the trained models, the graph search, the tokenizers and the trie counts have none; tests/llm compares
them with brute force, round trips and held-out accuracy.
"""

# Words and five-word shingles of `documents` and `benchmark`; a shorter text is one shingle of all its words.
_WORDS = r"regexp_extract_all(lower(coalesce({text}, '')), '[0-9A-Za-z_\x{{80}}-\x{{10FFFF}}]+')"


def _shingles(name: str, table: str, key: str) -> str:
    return f"""
{name}_words AS (SELECT {key} AS id, {_WORDS.format(text="text")} AS w FROM {table}),
{name} AS (
  SELECT DISTINCT id, array_to_string(w[i:i + 4], ' ') AS shingle
  FROM (SELECT id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM {name}_words WHERE len(w) > 0))"""


DECONTAMINATION = f"""
WITH {_shingles("docs", "documents", "doc_id")},
{_shingles("items", "benchmark", "item_id")},
sizes AS (SELECT id, count(*) AS n FROM items GROUP BY id)
SELECT d.id AS doc_id, i.id AS item_id, count(*) AS shared, any_value(s.n) AS shingles,
       count(*)::DOUBLE / any_value(s.n) AS containment
FROM docs d JOIN items i USING (shingle) JOIN sizes s ON s.id = i.id
GROUP BY d.id, i.id
HAVING count(*) >= 0.8 * any_value(s.n) - 1e-9
"""

JACCARD = f"""
WITH RECURSIVE {_shingles("docs", "documents", "doc_id")},
sets AS (
  SELECT w.id, coalesce(s.held, []) AS held
  FROM docs_words w LEFT JOIN (SELECT id, list_sort(list(shingle)) AS held FROM docs GROUP BY id) s ON s.id = w.id),
classes AS (SELECT held, min(id) AS text_id, count(*) AS copies, len(held) AS n FROM sets GROUP BY held),
held AS (SELECT text_id, n, unnest(held) AS shingle FROM classes),
shared AS (SELECT shingle FROM held GROUP BY shingle HAVING count(*) > 1),
common AS (SELECT h.* FROM held h JOIN shared USING (shingle)),
links AS (
  SELECT a.text_id AS a, b.text_id AS b
  FROM common a JOIN common b ON a.shingle = b.shingle AND a.text_id <> b.text_id
   AND a.n >= 0.8 * b.n AND b.n >= 0.8 * a.n
  GROUP BY a.text_id, b.text_id, a.n, b.n
  HAVING count(*) >= 0.8 * (a.n + b.n - count(*)) - 1e-9),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT s.id AS doc_id, least(c.text_id, coalesce(g.low, c.text_id)) AS class_id, c.text_id, c.copies,
       coalesce(k.n, 0) AS n_links
FROM sets s JOIN classes c ON c.held = s.held
LEFT JOIN (SELECT a, min(b) AS low FROM reach GROUP BY a) g ON g.a = c.text_id
LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) k ON k.a = c.text_id
"""


def _secret_kind(kind: str, number: int, pattern: str, group: int, least: int) -> str:
    """Spans of one kind: the places follow from the pieces between matches."""
    kept = f"length(regexp_extract(m, '{pattern}', {group})) >= {least}"
    return f"""
  SELECT doc_id, {number} AS number, '{kind}' AS kind, place AS start, place + length(m) AS stop
  FROM (
    SELECT doc_id, m, i, sum(length(gap) + coalesce(length(m), 0)) OVER (PARTITION BY doc_id ORDER BY i) - length(m) AS place
    FROM (SELECT doc_id, unnest(gaps) AS gap, unnest(list_concat(found, [NULL])) AS m, unnest(range(len(gaps))) AS i
          FROM (SELECT doc_id, string_split_regex(text, '{pattern}') AS gaps, regexp_extract_all(text, '{pattern}') AS found
                FROM texts WHERE regexp_matches(text, '{pattern}'))))
  WHERE m IS NOT NULL AND {kept}"""


_ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
SECRETS = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
spans AS ({" UNION ALL".join((
    _secret_kind("assign", 0, _ASSIGN, 1, 12), _secret_kind("access", 1, "AKIA[A-Z0-9]{14,}", 0, 18),
    _secret_kind("hex", 2, "[0-9a-f]{16,}", 0, 16)))}),
joined AS (
  SELECT doc_id, count(*) FILTER (number = 0) AS n_assign, count(*) FILTER (number = 1) AS n_access,
         count(*) FILTER (number = 2) AS n_hex,
         string_agg(kind || ':' || start::BIGINT || ':' || stop::BIGINT, ',' ORDER BY start, number) AS spans
  FROM spans GROUP BY doc_id)
SELECT t.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts t LEFT JOIN joined j ON j.doc_id = t.doc_id
"""

# Five hex digits are four letters of base 32.
_LETTERS = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, {5 * part + 1}, 5))::BIGINT >> {shift}) & 31)::INT, 1)"
    for part in range(8) for shift in (15, 10, 5, 0))
WARC = f"""
WITH payloads AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
firsts AS (SELECT html, max(page_id) AS first FROM payloads GROUP BY html),
told AS (SELECT page_id, p.html, sha1(p.html) AS h, first FROM payloads p JOIN firsts f ON f.html = p.html)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, {_LETTERS} AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM told
"""

SQL = {
    "op4_secret_scan": SECRETS,
    "op6_decontamination": DECONTAMINATION,
    "op8_warc_index": WARC,
    "op9_jaccard_join": JACCARD,
}
