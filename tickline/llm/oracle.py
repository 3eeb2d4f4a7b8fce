"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

from .license_digest import COPYRIGHT_LINE, EQUIVALENT, OTHER
from .license_texts import KNOWN
from .warc import REVISIT_BYTES


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _canonical(expr: str) -> str:
    out = f"regexp_replace(coalesce({expr}, ''), {_quoted(COPYRIGHT_LINE)}, chr(10), 'g')"
    out = f"lower(' ' || regexp_replace({out}, {_quoted(OTHER)}, ' ', 'g') || ' ')"
    out = f"replace({out}, '  ', ' ')"
    for a, b in EQUIVALENT:
        out = f"replace({out}, {_quoted(a)}, {_quoted(b)})"
    return out


_KNOWN_ROWS = ", ".join(f"({_quoted(name)}, {_quoted(text)})" for name, texts in KNOWN.items() for text in texts)

LICENSES = f"""
WITH known AS (
  SELECT sha256({_canonical("t.text")}) AS digest, min(t.license_id) AS license_id
  FROM (VALUES {_KNOWN_ROWS}) AS t(license_id, text) GROUP BY 1
), whole AS (
  SELECT doc_id, text, sha256({_canonical("text")}) AS canonical_sha256 FROM documents
), lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents
), hits AS (
  SELECT l.doc_id, string_agg(DISTINCT k.license_id, ',' ORDER BY k.license_id) AS found
  FROM lines l JOIN known k ON sha256({_canonical("l.line")}) = k.digest GROUP BY 1
)
SELECT w.doc_id, w.canonical_sha256, k.license_id, coalesce(h.found, '') AS line_licenses
FROM whole w LEFT JOIN known k ON w.canonical_sha256 = k.digest LEFT JOIN hits h ON w.doc_id = h.doc_id
"""

WARC = f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS payload_digest, strlen(coalesce(html, '')) AS n FROM pages
), first AS (
  SELECT payload, max(page_id) AS page_id FROM p WHERE n >= {REVISIT_BYTES} GROUP BY payload
)
SELECT p.page_id, p.n AS payload_bytes, p.payload_digest,
       CASE WHEN f.page_id <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.page_id <> p.page_id THEN f.page_id END AS refers_to
FROM p LEFT JOIN first f ON p.payload = f.payload
"""

REPEATS = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS k
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w WHERE len(ws) >= 13)
), firsts AS (
  SELECT k, min(doc_id) AS m FROM windows GROUP BY k
), covered AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS pos FROM windows JOIN firsts USING (k) WHERE m < doc_id
), words AS (
  SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS pos FROM w
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS text, count(*) AS n
  FROM words ANTI JOIN covered USING (doc_id, pos) GROUP BY doc_id
)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(k.n, 0))::BIGINT AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM w LEFT JOIN kept k ON w.doc_id = k.doc_id
"""

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

CONTAMINATION = f"""
WITH items AS (
  SELECT item_id, ws, least(13, len(ws)) AS n FROM (SELECT item_id, {_WORDS} AS ws FROM benchmark) WHERE len(ws) > 0
), grams AS (
  SELECT DISTINCT item_id, n, array_to_string(ws[i:i + n - 1], ' ') AS k
  FROM (SELECT item_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM items)
), w AS (
  SELECT doc_id, {_WORDS} AS ws FROM documents
), windows AS (
  SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS k
  FROM (SELECT doc_id, n, ws, unnest(range(1, len(ws) - n + 2)) AS i FROM w CROSS JOIN (SELECT DISTINCT n FROM grams) WHERE len(ws) >= n)
), hits AS (
  SELECT doc_id, item_id, n, i FROM windows JOIN grams USING (n, k)
), covered AS (
  SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS pos FROM hits) GROUP BY doc_id
), found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM w LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""

# The layout of the given pages: one article, headings and paragraphs, line breaks and bold type inside.
MAIN_TEXT = r"""
WITH a AS (
  SELECT page_id, url, unnest(string_split_regex(regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1), '</?(?:p|h1)>')) AS b,
         generate_subscripts(string_split_regex(regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1), '</?(?:p|h1)>'), 1) AS i
  FROM pages
), plain AS (
  SELECT page_id, url, i, regexp_replace(replace(b, '<br>', ' '), '</?b>', '', 'g') AS b FROM a
), decoded AS (
  SELECT page_id, url, i, regexp_replace(regexp_replace(regexp_replace(regexp_replace(b, '&quot;?', '"', 'g'), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&amp;?', '&', 'g') AS b FROM plain
), blocks AS (
  SELECT page_id, url, i, trim(regexp_replace(b, '\s+', ' ', 'g')) AS b FROM decoded
), texts AS (
  SELECT page_id, url, coalesce(string_agg(b, chr(10) || chr(10) ORDER BY i) FILTER (b <> ''), '') AS text FROM blocks GROUP BY page_id, url
)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM texts
"""

_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

RANKED = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, ts, len(ts)::BIGINT AS n FROM (SELECT doc_id, {_TERMS} AS ts FROM documents) WHERE len(ts) > 0
), totals AS (
  SELECT count(*)::BIGINT AS nd, sum(n)::BIGINT AS l FROM d
), q AS (
  SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark
), postings AS (
  SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(ts) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM postings, totals GROUP BY term, nd
), scores AS (
  SELECT q.item_id, d.doc_id, d.r, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nd) // l))))::BIGINT AS score
  FROM q JOIN weights USING (term) JOIN postings USING (term) JOIN d USING (r), totals GROUP BY ALL
)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INT AS rank, doc_id, score
FROM scores WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
"""

FILTER_AUDIT = r"""
WITH w AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), marks AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), d AS (
  SELECT w.part, coalesce(m.good, 0) AS good, coalesce(m.toxic, 0) AS toxic,
         list_filter(['A', 'B', 'C', 'D', 'E'], lambda f: CASE f
           WHEN 'A' THEN len(ws) < 50
           WHEN 'B' THEN 100 * list_unique(ws) < 65 * len(ws)
           WHEN 'C' THEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t)
           WHEN 'D' THEN regexp_matches(t, '[#$%&*|]')
           ELSE coalesce(w.doc_id > min(w.doc_id) OVER (PARTITION BY t), false) END) AS fails
  FROM w LEFT JOIN marks m ON w.doc_id = m.doc_id
), masks AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM d GROUP BY ALL
), f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x), orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM f a, f b, f c, f d, f e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
  SELECT filter_order, step, filter_order[step] AS letter FROM orders, range(1, 6) r(step)
), applied AS (
  SELECT m.*, s.*, list_contains(fails, letter) AS failing,
         len(list_filter(fails, lambda x: strpos(filter_order, x) < step)) > 0 AS gone
  FROM masks m, steps s
), counted AS (
  SELECT part, filter_order, step::INT AS step, letter,
         sum(CASE WHEN NOT gone AND NOT failing THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN NOT gone AND failing THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN gone AND failing THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN fails = [letter] THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN NOT gone AND failing THEN good ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN NOT gone AND failing THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM applied GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM counted
"""

ORACLE: dict[str, str] = {
    "op3_warc": WARC,
    "op5_license_scan": LICENSES,
    "op9_substring_dedup": REPEATS,
    "op10_benchmark_decontamination": CONTAMINATION,
    "op11_html_wrappers": MAIN_TEXT,
    "op12_ranked_search": RANKED,
    "op13_filter_audit": FILTER_AUDIT,
}
