"""DuckDB SQL for the queries that SQL can express, written independently of them."""

from __future__ import annotations

# space, tab, line feed, vertical tab, form feed, carriage return
_SPACES = r"[\x20\x09-\x0D]"

OP1 = rf"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '{_SPACES}', '', 'g')) AS text_sha256
  FROM documents
), g AS (
  SELECT text_sha256, count(*) AS group_size,
         arg_min(doc_id, (-chars, doc_id)) AS keep_id
  FROM d GROUP BY text_sha256
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM d JOIN g USING (text_sha256)
"""

_BUCKET = (
    "CASE WHEN v < 64 THEN v ELSE (length(bin(v)) - 6) * 32 + (v >> (length(bin(v)) - 6)) END"
)
_TOP = "CASE WHEN {b} < 64 THEN {b} ELSE (({b} - ({b} // 32 - 1) * 32 + 1) << ({b} // 32 - 1)) - 1 END"


def _quartiles(keys: str) -> str:
    at = f"{keys}, rate" if keys else "rate"
    low, high = (f"min(CASE WHEN upto * 4 >= total * {k} THEN bucket END)" for k in (1, 3))
    return f"""
  SELECT {at}, max(total) AS total, {low} AS low_b, {high} AS high_b FROM (
    SELECT {at}, bucket, sum(n) OVER (PARTITION BY {at} ORDER BY bucket) AS upto,
           sum(n) OVER (PARTITION BY {at}) AS total
    FROM (SELECT {at}, bucket, count(*) AS n FROM bucketed GROUP BY {at}, bucket)
  ) GROUP BY {at}"""


def _fences(name: str) -> str:
    low, high = _TOP.format(b="low_b"), _TOP.format(b="high_b")
    return f"""
  SELECT * EXCLUDE (low_b, high_b),
         greatest(({low}) - 3 * greatest(({high}) - ({low}), least_width), 0) AS low,
         ({high}) + 3 * greatest(({high}) - ({low}), least_width) AS high
  FROM {name} JOIN widths USING (rate)"""


def _blended(end: str) -> str:
    """A group's limit by its rows, its language's as ten rows, which blends in the corpus's."""
    of_lang = f"(f1.total::BIGINT * f1.{end} + 10 * f0.{end})::BIGINT // (f1.total::BIGINT + 10)"
    return f"(f2.total::BIGINT * f2.{end} + 10 * ({of_lang}))::BIGINT // (f2.total::BIGINT + 10)"


OP3 = rf"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS row_id, doc_id, lang, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda line: regexp_matches(line, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT row_id, start, array_to_string(words[start:start + 4], ' ') AS shingle
  FROM (SELECT row_id, words, unnest(range(1, len(words) - 3)) AS start FROM d WHERE len(words) > 4)
), often AS (
  SELECT row_id, start FROM (
    SELECT row_id, start, count(*) OVER (PARTITION BY row_id, shingle) AS n FROM windows) WHERE n > 1
), repeated AS (
  SELECT row_id, count(DISTINCT start + k) AS n_repeat_words
  FROM often, (SELECT unnest(range(0, 5)) AS k) GROUP BY row_id
), base AS (
  SELECT row_id, doc_id, lang, source, len(words) AS n_words,
         length(array_to_string(words, '')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines,
         length(regexp_replace(text, '[^!]', '', 'g')) AS marks,
         length(text) - length(regexp_replace(text, '\p{{Lu}}', '', 'g')) AS uppers,
         coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM d LEFT JOIN repeated USING (row_id)
), measured AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         n_symbols * 1000 // greatest(n_words, 1) AS symbol_rate,
         marks * 1000 // greatest(n_words, 1) AS mark_rate,
         uppers * 1000 // greatest(word_chars, 1) AS upper_rate,
         n_dup_lines * 1000 // greatest(n_lines, 1) AS dup_line_rate,
         word_chars * 100 // greatest(n_words, 1) AS word_length
  FROM base
), widths(rate, least_width, low_counts) AS (
  VALUES ('symbol_rate', 20, false), ('mark_rate', 20, false), ('upper_rate', 20, false),
         ('dup_line_rate', 100, false), ('word_length', 100, true)
), long AS (
  UNPIVOT (SELECT row_id, base_failed, coalesce(lang, '<none>') AS lang,
                  coalesce(source, '<none>') AS source, symbol_rate::BIGINT AS symbol_rate,
                  mark_rate::BIGINT AS mark_rate, upper_rate::BIGINT AS upper_rate,
                  dup_line_rate::BIGINT AS dup_line_rate, word_length::BIGINT AS word_length
           FROM measured)
  ON symbol_rate, mark_rate, upper_rate, dup_line_rate, word_length INTO NAME rate VALUE v
), bucketed AS (SELECT lang, source, rate, {_BUCKET} AS bucket FROM long WHERE NOT base_failed
), q2 AS ({_quartiles("lang, source")}
), q1 AS ({_quartiles("lang")}
), q0 AS ({_quartiles("")}
), f2 AS ({_fences("q2")}
), f1 AS ({_fences("q1")}
), f0 AS ({_fences("q0")}
), failed AS (
  SELECT DISTINCT row_id
  FROM long JOIN f2 USING (lang, source, rate) JOIN f1 USING (lang, rate) JOIN f0 USING (rate)
  WHERE v > {_blended("high")} OR f2.low_counts AND v < {_blended("low")}
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND row_id NOT IN (SELECT row_id FROM failed) AS kept
FROM measured
"""

OP4 = r"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h
  FROM pages
), d AS (
  SELECT page_id, payload_bytes, h,
         array_to_string(list_transform(range(0, 8), lambda g: array_to_string(list_transform([15, 10, 5, 0],
           lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
             ((('0x' || substr(h, CAST(5 * g + 1 AS INTEGER), 5))::INTEGER >> s) & 31) + 1, 1)), '')), '')
           AS payload_digest,
         min(page_id) OVER (PARTITION BY h) AS first
  FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM d
"""

OP6 = r"""
WITH u AS (
  SELECT page_id,
         CASE WHEN coalesce(url, '') LIKE '%://%' THEN
           translate(regexp_extract(url[strpos(url, '://') + 3:], '^[^/?#]*'),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
         CASE WHEN coalesce(url, '') LIKE '%://%' THEN
           regexp_extract(url[strpos(url, '://') + 3:], '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages
), r AS (
  SELECT *, CASE
    WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM u
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
    WHEN rule IS NOT NULL THEN 'allow'
    WHEN regexp_matches(regexp_replace(host, '^(www|m|blog)\.', ''),
                        '(^|[.-])(casino|win|pills|poker|loan|bet)([.-]|$)') THEN 'block'
    ELSE 'allow' END AS verdict
FROM r
"""

OP8 = r"""
WITH n AS (SELECT source, count(*) AS rows, sqrt(count(*)) AS weight FROM documents GROUP BY source
), r AS (
  SELECT source, weight * (sum(rows) OVER () / sum(weight) OVER ()) / rows AS rate FROM n
), p AS (
  SELECT source, list_transform(range(0, CAST(ceil(rate + 12 * sqrt(rate) + 20) AS BIGINT) + 1),
    lambda k: exp(k * ln(rate) - rate - lgamma(k + 1.0))) AS terms FROM r
), c AS (
  SELECT source, list_transform(range(1, len(terms) + 1), lambda k: list_sum(terms[1:k])) AS upto FROM p
), d AS (
  SELECT doc_id, source, lang, text,
         ('0x' || substr(md5('mix-1:' || doc_id), 1, 13))::BIGINT / 4503599627370496.0 AS drawn
  FROM documents
), k AS (
  SELECT d.*, len(list_filter(upto, lambda p: p <= drawn)) AS n_copies
  FROM d JOIN c ON d.source IS NOT DISTINCT FROM c.source
), x AS (SELECT *, unnest(range(1, n_copies + 1)) AS copy FROM k)
SELECT doc_id, source, n_copies, copy, md5('mix-1:order:' || doc_id || ':' || copy) AS shuffle_key, lang, text
FROM x
"""

# Classes by equal shingle sets, links by full Jaccard similarity, components by reach.
OP9 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) = 1 THEN words
           ELSE list_sort(list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])))
           END AS shingles FROM w
), c AS MATERIALIZED (
  SELECT shingles, len(shingles) AS n, min(doc_id) AS class_id, count(*) AS members
  FROM s WHERE len(shingles) > 0 GROUP BY shingles
), e AS (SELECT class_id, n, unnest(shingles) AS shingle FROM c
), pairs AS MATERIALIZED (
  SELECT a.class_id AS a, b.class_id AS b
  FROM e a JOIN e b ON a.shingle = b.shingle AND a.class_id < b.class_id
  WHERE 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.class_id, b.class_id, a.n, b.n
  HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), links AS MATERIALIZED (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs
), reach AS (
  SELECT class_id AS node, class_id AS start FROM c
  UNION
  SELECT links.b, reach.start FROM reach JOIN links ON links.a = reach.node
), least_of AS (SELECT node AS class_id, min(start) AS component_id FROM reach GROUP BY node)
SELECT s.doc_id, len(s.shingles) AS n_shingles, coalesce(component_id, s.doc_id) AS component_id,
       s.doc_id = coalesce(component_id, s.doc_id) AS kept
FROM s LEFT JOIN c USING (shingles) LEFT JOIN least_of USING (class_id)
"""

# The same with five-word shingles.
OP11 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
           ELSE list_sort(list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))))
           END AS shingles FROM w
), c AS MATERIALIZED (
  SELECT shingles, len(shingles) AS n, min(doc_id) AS class_id, count(*) AS members
  FROM s WHERE len(shingles) > 0 GROUP BY shingles
), e AS (SELECT class_id, n, unnest(shingles) AS shingle FROM c
), pairs AS MATERIALIZED (
  SELECT a.class_id AS a, b.class_id AS b
  FROM e a JOIN e b ON a.shingle = b.shingle AND a.class_id < b.class_id
  WHERE 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.class_id, b.class_id, a.n, b.n
  HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), links AS MATERIALIZED (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs
), reach AS (
  SELECT class_id AS node, class_id AS start FROM c
  UNION
  SELECT links.b, reach.start FROM reach JOIN links ON links.a = reach.node
), least_of AS (SELECT node AS class_id, min(start) AS component_id FROM reach GROUP BY node)
SELECT s.doc_id, len(s.shingles) AS n_shingles, coalesce(component_id, s.doc_id) AS component_id
FROM s LEFT JOIN c USING (shingles) LEFT JOIN least_of USING (class_id)
"""

# Every anchor against every row.
OP12 = """
WITH v AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
), n AS (
  SELECT p.*, other_id AS negative_id, score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS place
  FROM p JOIN s USING (anchor_id)
  WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
)
SELECT anchor_id, positive_id, place::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE place <= 10
"""

# Every document against every item, term by term.
OP13 = r"""
WITH d AS MATERIALIZED (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
), i AS (
  SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), size AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id
), total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM size
), m AS (SELECT doc_id, 25 + (75 * n * docs) // terms AS m FROM size, total
), tf AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY doc_id, term
), weight AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM tf, total GROUP BY term, docs
), scored AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM i JOIN weight USING (term) JOIN tf USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM scored WHERE score > 0
)
SELECT item_id, place::INTEGER AS rank, doc_id, score FROM ranked WHERE place <= 10
"""

ORACLES = {
    "op1_exact_dedup": OP1,
    "op3_quality_rules": OP3,
    "op4_warc": OP4,
    "op6_url_filter": OP6,
    "op8_source_mix": OP8,
    "op9_minhash_dedup": OP9,
    "op11_ngram_join": OP11,
    "op12_hard_negatives": OP12,
    "op13_lexical_search": OP13,
}
