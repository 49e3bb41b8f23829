"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: str) -> str:
    lowered = f"translate(coalesce({text}, ''), '{UPPER}', '{LOWER}')"
    return rf"regexp_extract_all({lowered}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


DECONTAMINATION = f"""
WITH item AS (SELECT item_id, {words_of("text")} AS w FROM benchmark WHERE item_id IS NOT NULL),
gram AS (SELECT DISTINCT item_id, w[p:p + 12] AS g
         FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS p FROM item WHERE len(w) > 0)),
size AS (SELECT DISTINCT len(g) AS n FROM gram),
doc AS (SELECT doc_id, {words_of("text")} AS w FROM documents),
probe AS (SELECT doc_id, p, n, w[p:p + n - 1] AS g
          FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM doc, size)),
hit AS (SELECT doc_id, p, n, item_id FROM probe JOIN gram USING (g)),
covered AS (SELECT doc_id, count(DISTINCT i) AS n_hit
            FROM (SELECT doc_id, unnest(range(p, p + n)) AS i FROM (SELECT DISTINCT doc_id, p, n FROM hit)) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

URL_FILTERS = f"""
WITH rules(verdict, rule_host, rule_path) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
  ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
part AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), '{UPPER}', '{LOWER}') AS host,
                regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path FROM pages),
fit AS (SELECT page_id, rule_host || rule_path AS rule, verdict,
               row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC, verdict DESC) AS k
        FROM part JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM part LEFT JOIN (SELECT * FROM fit WHERE k = 1) USING (page_id)
"""

# The rules of policy v2, on the same measurements.
RULE_MEASURES = r"""
WITH doc AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
line AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines
         FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM doc)
         WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id),
win AS (SELECT doc_id, p, w[p:p + 7] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS p FROM doc)),
rep AS (SELECT doc_id, g FROM win GROUP BY doc_id, g HAVING count(*) > 1),
covered AS (SELECT doc_id, count(DISTINCT i) AS n_repeat_words
            FROM (SELECT doc_id, unnest(range(p, p + 8)) AS i FROM win JOIN rep USING (doc_id, g)) GROUP BY doc_id),
again AS (SELECT doc_id, count(*) AS n_adjacent
          FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS p FROM doc) WHERE w[p] = w[p + 1] GROUP BY doc_id),
m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
             CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
             coalesce(n_adjacent, 0) AS n_adjacent, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper,
             length(regexp_replace(t, '[^A-Za-z]', '', 'g')) AS n_letters, length(regexp_replace(t, '[^0-9]', '', 'g')) AS n_digits
      FROM doc LEFT JOIN line USING (doc_id) LEFT JOIN covered USING (doc_id) LEFT JOIN again USING (doc_id))
"""

QUALITY_RULES = RULE_MEASURES + r"""
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR n_symbols * 10 > n_words
            OR n_letters >= 20 AND n_upper * 2 > n_letters OR n_adjacent * 5 > n_words
            OR n_lines >= 3 AND n_dup_lines * 2 > n_lines
            OR word_chars < n_words * 2 OR word_chars > n_words * 20 OR n_digits * 2 > word_chars) AS kept
FROM m
"""

# One bit a rule, and what changes without it.
RULE_ABLATIONS = RULE_MEASURES + """
, bit AS (SELECT doc_id, unnest([
    {rule: 'few_words', fails: n_words < 20}, {rule: 'repeated_windows', fails: 100 * n_repeat_words > 30 * n_words},
    {rule: 'symbols', fails: n_symbols * 10 > n_words}, {rule: 'capitals', fails: n_letters >= 20 AND n_upper * 2 > n_letters},
    {rule: 'stutter', fails: n_adjacent * 5 > n_words}, {rule: 'doubled_lines', fails: n_lines >= 3 AND n_dup_lines * 2 > n_lines},
    {rule: 'word_length', fails: word_chars < n_words * 2 OR word_chars > n_words * 20},
    {rule: 'digits', fails: n_digits * 2 > word_chars}], recursive := true) FROM m),
total AS (SELECT *, count(*) FILTER (fails) OVER (PARTITION BY doc_id) AS n_failed FROM bit)
SELECT rule, count(*) FILTER (fails) AS n_fail, count(*) FILTER (fails AND n_failed = 1) AS n_fail_alone,
       count(*) FILTER (n_failed = 0 OR fails AND n_failed = 1) AS n_kept_without FROM total GROUP BY rule
"""

# Texts as hexadecimal digits, two to a byte.
SUFFIX_DEDUP = """
WITH doc AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
win AS (SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS g
        FROM (SELECT doc_id, h, unnest(range(0, greatest(0, length(h) // 2 - 49))) AS p FROM doc)),
least_of AS (SELECT g, min(doc_id) AS least FROM win GROUP BY g HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS i FROM win JOIN least_of USING (g) WHERE least < doc_id),
span AS (SELECT doc_id, count(*) AS n_removed, count(*) FILTER (i > before + 1 OR before IS NULL) AS n_spans
         FROM (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM gone) GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * i + 1, 2), '' ORDER BY i) AS left_over
         FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2)) AS i FROM doc WHERE doc_id IN (SELECT doc_id FROM span))
         ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(CASE WHEN n_removed IS NULL THEN h ELSE coalesce(left_over, '') END)) AS kept_sha256
FROM doc LEFT JOIN span USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

HARD_NEGATIVES = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, e.vec_id AS other_id, a.label = e.label AS same,
             CAST(list_inner_product(a.v, e.v) AS BIGINT) AS score
      FROM e AS a JOIN e ON a.vec_id <> e.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM (
        SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) AS k FROM s WHERE same) WHERE k <= 5),
n AS (SELECT anchor_id, positive_id, positive_score, other_id AS negative_id, score AS negative_score,
             row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS k
      FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(k AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE k <= 10
"""

COLLOCATIONS = rf"""
WITH piece AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                 translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS s FROM documents),
word AS (SELECT lang, regexp_extract_all(s, '[^\x20\x09]+') AS w FROM piece),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM word GROUP BY lang),
gram AS (SELECT lang, w[p:p + k - 1] AS g FROM (
           SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM word, (SELECT unnest(range(1, 6)) AS k))),
often AS (SELECT lang, g, count(*) AS f FROM gram GROUP BY lang, g HAVING count(*) >= 100),
phrase AS (SELECT lang, g, f AS a FROM often WHERE len(g) > 1),
halves AS (SELECT *, unnest(range(1, len(g))) AS k FROM phrase),
cut AS (SELECT h.lang, h.g, h.a, k, l.f AS l, r.f AS r, n, (1000::HUGEINT * h.a * n) // (l.f::HUGEINT * r.f) AS score
        FROM halves h JOIN often l ON l.lang = h.lang AND l.g = h.g[1:k]
        JOIN often r ON r.lang = h.lang AND r.g = h.g[k + 1:] JOIN total ON total.lang = h.lang),
lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, k) AS i FROM cut),
part AS (SELECT lang, a, g[p:p + m - 1] AS s FROM (
           SELECT lang, a, g, m, unnest(range(1, len(g) - m + 2)) AS p FROM (SELECT *, unnest(range(2, len(g))) AS m FROM phrase))),
inside AS (SELECT DISTINCT part.lang, phrase.g FROM part JOIN phrase ON phrase.lang = part.lang AND phrase.g = s
           WHERE 100 * part.a >= 100 * phrase.a),
ranked AS (SELECT *, array_to_string(g, ' ') AS phrase, row_number() OVER (
             PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS k2
           FROM lowest ANTI JOIN inside USING (lang, g) WHERE i = 1)
SELECT lang, k2 AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked WHERE k2 <= 2000
"""

ORACLE: dict[str, str] = {
    "op1_decontamination": DECONTAMINATION,
    "op2_quality_rules": QUALITY_RULES,
    "quality_rule_ablations": RULE_ABLATIONS,
    "op5_url_filters": URL_FILTERS,
    "op7_suffix_dedup": SUFFIX_DEDUP,
    "op11_hard_negatives": HARD_NEGATIVES,
    "op12_collocations": COLLOCATIONS,
}
