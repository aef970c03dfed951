"""Expected results as DuckDB SQL, for the queries that SQL can express."""

from __future__ import annotations

from harbor.llm.license_rules import KINDS, SIGNATURES
from harbor.llm.licenses import BASE, WEIGHTS, spread

_QUALITY = r"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)),
      lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT doc_id, pos, array_to_string(words[pos:pos + 7], ' ') AS said
  FROM split, unnest(range(1, len(words) - 6)) AS t(pos)
), repeated AS (
  SELECT doc_id, pos FROM windows
  QUALIFY count(*) OVER (PARTITION BY doc_id, said) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT pos + step) AS n
  FROM repeated, unnest(range(0, 8)) AS t(step) GROUP BY doc_id
), measured AS (
  SELECT doc_id, text, words,
    len(words) AS n_words,
    coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
    len(lines) AS n_lines,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(n, 0) AS n_repeat_words
  FROM split LEFT JOIN covered USING (doc_id)
), judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed
    OR 10 * n_symbols > n_words
    OR 4 * len(regexp_extract_all(text, '!')) > n_words
    OR len(regexp_extract_all(text, '[A-Z]')) > len(regexp_extract_all(text, '[a-z]'))
    OR 5 * len(list_filter(range(2, len(words) + 1), lambda i: words[i] = words[i - 1])) > n_words
    OR word_chars < 2 * n_words OR word_chars > 14 * n_words
    OR 3 * n_dup_lines > n_lines) AS kept
FROM judged
"""

_TURNS = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT conv_id,
  count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), ''))
    AS loss_sha256,
  sum(15 + length(text) + len(regexp_extract_all(text, '### |</turn>'))
    + CASE WHEN regexp_full_match(role, '[a-z]+') THEN length(role)
      ELSE 1 + 2 * octet_length(encode(role)) END)::BIGINT AS formatted_chars
FROM rows GROUP BY conv_id
"""

_URLS = r"""
WITH parts AS (
  SELECT page_id, coalesce(regexp_extract(url, '(?s)^.*?://(.*)$', 1), '') AS rest FROM pages
), split AS (
  SELECT page_id, rest,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts
), named AS (
  SELECT *, regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '/+$', '')
    || coalesce('?' || nullif(array_to_string(list_sort(list_filter(
      string_split(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), '&'),
      lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|ref)='))), '&'), ''), '') AS name
  FROM split
), rules(verdict, h, p) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
    ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), listed AS (
  SELECT DISTINCT name FROM named
  WHERE regexp_matches(host, '(^|\.)(adult-x|ads-track|casino-win|cheap-pills|free-bets|spam-farm)\.') AND name <> ''
), ruled AS (
  SELECT page_id, host, path, name, max_by(h || p, length(h || p)) AS rule,
    max_by(verdict, length(h || p)) AS ruled
  FROM named LEFT JOIN rules
    ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY page_id, host, path, name
)
SELECT page_id, host, path, rule,
  coalesce(ruled, CASE WHEN listed.name IS NULL THEN 'allow' ELSE 'block' END) AS verdict,
  (rule IS NULL AND listed.name IS NOT NULL) AS listed
FROM ruled LEFT JOIN listed USING (name)
"""

_AUDIT = r"""
WITH split AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), failing AS (
  SELECT doc_id, part,
    (CASE WHEN len(words) < 200 THEN 'A' ELSE '' END)
    || (CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END)
    || (CASE WHEN 100 * len(regexp_extract_all(text, '[A-Z]')) > 2 * length(text) THEN 'C' ELSE '' END)
    || (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END)
    || (CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END) AS fails
  FROM split
), known AS (
  SELECT doc_id, max((quality = 1)::INTEGER) AS good, max((toxic = 1)::INTEGER) AS bad
  FROM labels GROUP BY doc_id
), cells AS (
  SELECT part, fails, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(bad), 0) AS bad
  FROM failing LEFT JOIN known USING (doc_id) GROUP BY part, fails
), letters(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')
), orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
  SELECT filter_order, step, filter_order[step] AS letter, filter_order[1:step - 1] AS earlier
  FROM orders, unnest(range(1, 6)) AS t(step)
), flags AS (
  SELECT part, filter_order, step, letter, n, good, bad,
    contains(fails, letter) AS failed,
    fails = letter AS alone,
    earlier <> '' AND regexp_matches(fails, '[' || earlier || '_]') AS gone
  FROM cells, steps
), counted AS (
  SELECT part, filter_order, step, letter,
    coalesce(sum(n) FILTER (NOT gone AND NOT failed), 0) AS kept,
    coalesce(sum(n) FILTER (failed AND NOT gone), 0) AS removed,
    coalesce(sum(n) FILTER (failed AND gone), 0) AS redundant,
    coalesce(sum(n) FILTER (alone), 0) AS unique_fails,
    coalesce(sum(good) FILTER (failed AND NOT gone), 0) AS good_lost,
    coalesce(sum(bad) FILTER (failed AND NOT gone), 0) AS toxic_lost
  FROM flags GROUP BY ALL
)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
  redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
  good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM counted
"""

def _rules(signatures) -> str:
    return ", ".join(
        f"({turn}, '{s.label}', {KINDS.index(s.kind)}, '{s.keyword}', ' ({spread(s.pattern)}) ')"
        for turn, s in enumerate(signatures)
    )


# Suppression compares every two detections of a text here.
_LICENSES = rf"""
WITH small AS (
  SELECT doc_id, row_number() OVER () AS rid, translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), worded AS (
  SELECT doc_id, rid, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM small
), spoken AS (
  SELECT *, ' ' || array_to_string(words, '  ') || ' ' AS said FROM worded
), rules(turn, label, kind, keyword, pattern) AS (
  VALUES {_rules(SIGNATURES)}
), base_rules(turn, label, kind, keyword, pattern) AS (
  VALUES {_rules(BASE)}
), tried AS (
  SELECT rid, said, r.*, false AS base FROM spoken JOIN rules r
    ON contains(said, keyword) AND regexp_matches(said, pattern)
  UNION ALL
  SELECT rid, said, r.*, true AS base FROM spoken JOIN base_rules r
    ON contains(said, keyword) AND regexp_matches(said, pattern)
), marked AS (
  SELECT rid, turn, label, kind, base, string_split(trim(
    regexp_replace(said, pattern, ' ' || chr(1) || '\1' || chr(2) || ' ', 'g')), '  ') AS w
  FROM tried
), found AS (
  SELECT rid, turn, label, kind, base,
    unnest(list_filter(range(0, len(w)), lambda i: starts_with(w[i + 1], chr(1)))) AS s,
    unnest(list_filter(range(1, len(w) + 1), lambda i: ends_with(w[i], chr(2)))) AS e
  FROM marked
), kept AS (
  SELECT * FROM found d WHERE NOT base AND NOT EXISTS (
    FROM found o WHERE o.rid = d.rid AND NOT o.base
      AND ((o.kind < d.kind AND o.s < d.e AND d.s < o.e)
        OR (o.kind = d.kind AND o.s <= d.s AND o.e >= d.e
          AND (o.e - o.s > d.e - d.s OR o.turn < d.turn))))
), told AS (
  SELECT rid, count(*) FILTER (base) AS n_base,
    min(s) FILTER (base) AS first_word, max(s) FILTER (base) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
    min(kind) AS best
  FROM (FROM kept UNION ALL FROM found WHERE base) GROUP BY rid
)
SELECT doc_id, len(words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  coalesce({list(WEIGHTS)}[best + 1], 0)::DOUBLE AS score
FROM spoken LEFT JOIN told USING (rid)
"""

# Bytes as two hexadecimal digits each; a slice is 50 of them.
_REPEATS = r"""
WITH held AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n
  FROM documents
), slices AS (
  SELECT doc_id, pos, substr(h, 2 * pos + 1, 100) AS said
  FROM held, unnest(range(0, greatest(n - 49, 0))) AS t(pos)
), firsts AS (
  SELECT said, min(doc_id) AS least FROM slices GROUP BY said HAVING count(*) > 1
), starts AS (
  SELECT doc_id, pos, pos - lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS gap
  FROM slices JOIN firsts USING (said) WHERE least < doc_id
), numbered AS (
  SELECT doc_id, pos, count(*) FILTER (gap IS NULL OR gap > 50)
    OVER (PARTITION BY doc_id ORDER BY pos) AS run
  FROM starts
), runs AS (
  SELECT doc_id, min(pos) AS a, max(pos) + 50 AS b FROM numbered GROUP BY doc_id, run
), ends AS (
  SELECT doc_id, a, b, true AS removed FROM runs
  UNION ALL SELECT doc_id, n, n, false FROM held
), pieces AS (
  SELECT doc_id, a, b, removed,
    coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a, b), 0) AS since
  FROM ends
)
SELECT doc_id, any_value(n)::BIGINT AS n_bytes,
  coalesce(sum(b - a) FILTER (removed), 0)::BIGINT AS n_removed,
  count(*) FILTER (removed)::BIGINT AS n_spans,
  sha256(unhex(string_agg(substr(h, 2 * since + 1, 2 * (a - since)), '' ORDER BY a, b))) AS kept_sha256
FROM pieces JOIN held USING (doc_id) GROUP BY doc_id
"""

SQL: dict[str, str] = {
    "op3_quality_rules": _QUALITY,
    "op4_repeated_bytes": _REPEATS,
    "op7_chat_format": _TURNS,
    "op9_url_filter": _URLS,
    "op12_filter_audit": _AUDIT,
    "op13_license_scan": _LICENSES,
}
