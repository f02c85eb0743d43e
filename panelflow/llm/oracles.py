"""DuckDB SQL of the operators that SQL can express, written from their definitions."""

from __future__ import annotations

from panelflow.llm.quality import RULES, STOP_WORDS

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

LINE_DEDUP = rf"""
WITH lines AS (
  SELECT doc_id, i, list_sort(list_distinct(regexp_extract_all(l, '[^\x20\x09-\x0D]+'))) AS words, l
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS l, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents)),
classes AS (SELECT words, len(words) AS n, min(row(doc_id, i)) AS at, row_number() OVER () AS c FROM lines WHERE len(words) > 0 GROUP BY words),
tokens AS (SELECT c, n, unnest(words) AS w FROM classes),
counts AS (SELECT w, count(*) AS df FROM tokens GROUP BY w),
ranked AS (SELECT c, n, w, row_number() OVER (PARTITION BY c ORDER BY df, w) AS r FROM tokens JOIN counts USING (w)),
prefix AS (SELECT * FROM ranked WHERE r <= n - (4 * n + 4) // 5 + 1),
pairs AS (SELECT DISTINCT x.c AS a, y.c AS b FROM prefix x JOIN prefix y ON x.w = y.w AND x.c <> y.c AND 5 * x.n >= 4 * y.n AND 5 * y.n >= 4 * x.n),
links AS (
  SELECT a, b, y.at < x.at AS later FROM pairs JOIN classes x ON x.c = a JOIN classes y ON y.c = b
  WHERE 9 * len(list_intersect(x.words, y.words)) >= 4 * (x.n + y.n)),
linked AS (SELECT a AS c, count(*) AS links, bool_or(later) AS later FROM links GROUP BY a),
judged AS (
  SELECT l.doc_id, l.i, l.l, len(l.words) > 0 AS worded, k.at = row(l.doc_id, l.i) AS first, coalesce(m.later, false) AS later, coalesce(m.links, 0) AS links
  FROM lines l LEFT JOIN classes k ON k.words = l.words LEFT JOIN linked m ON m.c = k.c)
SELECT doc_id, count(*) FILTER (WHERE worded) AS n_lines, count(*) FILTER (WHERE worded AND NOT (first AND NOT later)) AS n_removed,
  CAST(coalesce(sum(links) FILTER (WHERE worded AND first), 0) AS BIGINT) AS n_links,
  sha256(coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (WHERE NOT worded OR (first AND NOT later)), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""

SUBSTRING_DEDUP = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS words FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 19], ' ') AS seq
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM d WHERE len(words) >= 20)),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY seq ORDER BY doc_id, i) AS k FROM windows) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM later),
places AS (SELECT doc_id, unnest(words) AS w, unnest(range(1, len(words) + 1)) AS i FROM d),
kept AS (SELECT doc_id, count(*) AS n, string_agg(w, ' ' ORDER BY i) AS t FROM places ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""

_PLAIN = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

DECONTAMINATE = rf"""
WITH d AS (SELECT doc_id, {_PLAIN} AS words FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_PLAIN} AS words FROM benchmark WHERE item_id IS NOT NULL),
sized AS (SELECT item, words, least(len(words), 10) AS n FROM items WHERE len(words) > 0),
parts AS (SELECT DISTINCT item, n, array_to_string(words[i:i + n - 1], ' ') AS seq FROM (SELECT *, unnest(range(1, len(words) - n + 2)) AS i FROM sized)),
windows AS (
  SELECT doc_id, i, n, array_to_string(words[i:i + n - 1], ' ') AS seq
  FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM parts) WHERE len(words) >= n)),
met AS (SELECT doc_id, i, n, item FROM windows JOIN parts USING (n, seq)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM met) GROUP BY doc_id),
who AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM met) GROUP BY doc_id)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN who USING (doc_id)"""


def quality() -> str:
    tests = []
    for _, measure, least, most in RULES:
        tests += [f"coalesce({measure} >= {least}, true)"] * (least is not None) + [f"coalesce({measure} <= {most}, true)"] * (most is not None)
    forms = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS words FROM documents),
m AS (
  SELECT doc_id, text, words, len(words) AS n_words, list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM d),
places AS (SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS seq FROM (SELECT doc_id, words, unnest(range(1, n_words - 6)) AS i FROM m WHERE n_words >= 8)),
twice AS (SELECT doc_id, i FROM places QUALIFY count(*) OVER (PARTITION BY doc_id, seq) > 1),
repeats AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY doc_id),
stops AS (SELECT unnest([{forms}]) AS s),
forms AS (SELECT DISTINCT v || e AS w FROM (SELECT s AS v FROM stops UNION SELECT upper(s[1]) || s[2:] FROM stops), (SELECT unnest(['', ',', '.']) AS e)),
stopped AS (SELECT doc_id, count(*) AS n FROM (SELECT doc_id, unnest(words) AS w FROM m) JOIN forms USING (w) GROUP BY doc_id),
c AS (
  SELECT m.doc_id, n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(r.n, 0) AS n_repeat_words, len(lines) AS n_lines, len(list_distinct(words)) AS n_different, coalesce(s.n, 0) AS n_stop_words,
    len(list_filter(lines, lambda l: regexp_matches(l, '^\s*[-*•]'))) AS n_bullet_lines,
    len(list_filter(lines, lambda l: regexp_matches(l, '(\.\.\.|…)\s*$'))) AS n_ellipsis_lines
  FROM m LEFT JOIN repeats r USING (doc_id) LEFT JOIN stopped s USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND {' AND '.join(tests)} AS kept
FROM c"""


_TERMS = (r"list_distinct(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))")

SEARCH = rf"""
WITH d AS (SELECT doc_id, {_TERMS.replace("list_distinct(", "(", 1)} AS words FROM documents),
lengths AS (SELECT doc_id, len(words) AS n FROM d WHERE len(words) > 0),
corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths),
items AS (SELECT item_id, unnest({_TERMS}) AS w FROM benchmark),
postings AS (
  SELECT doc_id, w, count(*) AS tf FROM (SELECT doc_id, unnest(words) AS w FROM d) WHERE w IN (SELECT w FROM items) GROUP BY doc_id, w),
weights AS (SELECT w, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM postings, corpus GROUP BY w, docs),
scores AS (
  SELECT item_id, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms)))) AS BIGINT) AS score
  FROM items JOIN postings USING (w) JOIN weights USING (w) JOIN lengths USING (doc_id), corpus GROUP BY item_id, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0) WHERE rank <= 10"""


# distinct n-grams, all pairs that share one, and the smallest id reachable by repeated steps
NGRAM_JOIN = rf"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.replace("coalesce(text, '')", "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS words FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
    ELSE list_distinct([array_to_string(words[i:i + 3], ' ') for i in range(1, len(words) - 2)]) END AS grams FROM d),
classes AS (SELECT list_sort(grams) AS grams, min(doc_id) AS c, len(any_value(grams)) AS n FROM sets WHERE len(grams) > 0 GROUP BY list_sort(grams)),
tokens AS (SELECT c, n, unnest(grams) AS g FROM classes),
counts AS (SELECT g, count(*) AS df FROM tokens GROUP BY g HAVING count(*) > 1),
ranked AS (SELECT c, n, g, row_number() OVER (PARTITION BY c ORDER BY coalesce(df, 1), g) AS r, df FROM tokens LEFT JOIN counts USING (g)),
prefix AS (SELECT * FROM ranked WHERE r <= n - (85 * n + 99) // 100 + 1 AND df > 1),
pairs AS (SELECT DISTINCT x.c AS a, y.c AS b FROM prefix x JOIN prefix y ON x.g = y.g AND x.c < y.c AND 100 * x.n >= 85 * y.n AND 100 * y.n >= 85 * x.n),
links AS (
  SELECT a, b FROM pairs JOIN classes x ON x.c = a JOIN classes y ON y.c = b
  WHERE 185 * len(list_intersect(x.grams, y.grams)) >= 85 * (x.n + y.n)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT DISTINCT a AS c, a AS root FROM both_ways UNION SELECT b.b, r.root FROM reach r JOIN both_ways b ON b.a = r.c),
roots AS (SELECT c, min(root) AS root FROM reach GROUP BY c)
SELECT doc_id, len(s.grams) AS n_shingles, coalesce(root, c, doc_id) AS component_id
FROM sets s LEFT JOIN classes k ON k.grams = list_sort(s.grams) AND len(s.grams) > 0 LEFT JOIN roots USING (c)"""


ORACLE_SQL = {
    "op1_line_dedup": LINE_DEDUP,
    "op2_substring_dedup": SUBSTRING_DEDUP,
    "op4_decontaminate": DECONTAMINATE,
    "op5_quality": quality(),
    "op11_ngram_join": NGRAM_JOIN,
    "op12_search": SEARCH,
}
