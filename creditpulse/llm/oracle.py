"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from creditpulse.llm.url_filters import DAMPING, ITERATIONS, RULES, THRESHOLD

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"


def _rule(column: int) -> str:
    cases = []
    for kind, host, path in sorted(RULES, key=lambda r: -len(r[1] + r[2])):
        fits = f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}')"
        cases.append(f"WHEN {fits} THEN '{(host + path, kind)[column]}'")
    return f"CASE {' '.join(cases)} END"


def url_filters() -> str:
    steps = []
    for i in range(ITERATIONS):
        steps.append(f"""
r{i + 1} AS (SELECT s.kind, e.b AS a, sum(s.part * e.w * {DAMPING}) AS part, sum(s.whole * e.w * {DAMPING}) AS whole
  FROM s{i} s JOIN edges e ON e.kind = s.kind AND e.a = s.a GROUP BY 1, 2),
s{i + 1} AS (SELECT kind, a, own * (start + coalesce(whole, 0)) + open * coalesce(part, 0) AS part, start + coalesce(whole, 0) AS whole
  FROM seeds LEFT JOIN r{i + 1} USING (kind, a)),""")
    return rf"""
WITH split AS (
  SELECT page_id, html, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, html, {LOWER.format("regexp_extract(rest, '^[^/?#]*')")} AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM split),
ruled AS (SELECT *, {_rule(0)} AS rule, {_rule(1)} AS fixed FROM parts),
hosts AS (SELECT host, count(*) FILTER (fixed = 'allow') / count(*) AS allowed,
  count(*) FILTER (fixed = 'block') / count(*) AS blocked FROM ruled GROUP BY 1),
found AS (SELECT host AS src, unnest(regexp_extract_all(html, '(?i)<a\s[^>]*?href\s*=\s*["'']?([^"''\s>]+)', 1)) AS link FROM ruled),
links AS (SELECT src, {LOWER.format("regexp_extract(link, '^(?i:https?:)?//([^/?#]+)', 1)")} AS dst FROM found WHERE src <> ''),
counted AS (SELECT src, dst, count(*) AS n FROM links WHERE dst <> '' AND dst <> src GROUP BY 1, 2),
both_ways AS (SELECT 't' AS kind, src AS a, dst AS b, n FROM counted UNION ALL SELECT 'd', dst, src, n FROM counted),
edges AS (SELECT kind, a, b, n / sum(n) OVER (PARTITION BY kind, a) AS w FROM both_ways),
seeds AS (SELECT kind, a, sum(n)::DOUBLE AS start, coalesce(CASE kind WHEN 't' THEN any_value(allowed) ELSE any_value(blocked) END, 0) AS own,
  coalesce(1 - any_value(allowed) - any_value(blocked), 1) AS open FROM both_ways LEFT JOIN hosts ON host = a GROUP BY 1, 2),
s0 AS (SELECT kind, a, own * start AS part, start AS whole FROM seeds),{"".join(steps)}
got AS (SELECT a, max(part / whole) FILTER (kind = 't') AS t, max(part / whole) FILTER (kind = 'd') AS d FROM r{ITERATIONS} GROUP BY 1),
shares AS (SELECT host, blocked + (1 - allowed - blocked) * coalesce(d, 0) - (allowed + (1 - allowed - blocked) * coalesce(t, 0)) AS bad
  FROM hosts LEFT JOIN got ON a = host)
SELECT page_id, host, path, rule, coalesce(fixed, CASE WHEN bad > {THRESHOLD} THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled LEFT JOIN shares USING (host)"""


EMBEDDINGS = """
WITH RECURSIVE good AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.9),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY 1),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY 1)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least ON least.a = vec_id LEFT JOIN counts ON counts.a = vec_id"""

QUALITY = rf"""
WITH docs AS (SELECT doc_id, source, coalesce(text, '') AS text, {WORDS.format("coalesce(text, '')")} AS words FROM documents),
lines AS (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line FROM docs),
full_lines AS (SELECT *, {WORDS.format("line")} AS lw FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dups AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM full_lines GROUP BY 1),
tok AS (SELECT doc_id, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM docs),
grams AS (SELECT doc_id, i, lead(w, 4) OVER o AS fifth,
  concat_ws(' ', w, lead(w, 1) OVER o, lead(w, 2) OVER o, lead(w, 3) OVER o, lead(w, 4) OVER o) AS gram
  FROM tok WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
windows AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM grams WHERE fifth IS NOT NULL),
repeats AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM windows, range(5) r(k) WHERE n > 1 GROUP BY 1),
normal AS (SELECT doc_id, source, text, len(lw) AS n,
  regexp_replace({LOWER.format("array_to_string(lw, ' ')")}, '[0-9]+', '0', 'g') AS line FROM full_lines),
holders AS (SELECT source, line, count(DISTINCT text) AS docs, min(doc_id) AS first FROM normal GROUP BY 1, 2),
frequent AS (SELECT * FROM holders WHERE docs > 100),
removed AS (SELECT n.doc_id, sum(n.n) AS gone FROM normal n JOIN frequent f
  ON n.line = f.line AND n.source IS NOT DISTINCT FROM f.source WHERE n.doc_id <> f.first GROUP BY 1),
base AS (SELECT doc_id, len(words) AS n_words, coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT AS word_chars,
  length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
  coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(gone, 0) AS gone
  FROM docs LEFT JOIN dups USING (doc_id) LEFT JOIN repeats USING (doc_id) LEFT JOIN removed USING (doc_id)),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, n_words - gone AS remaining FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (gone > 0 AND (remaining < 10 OR 100 * remaining < 20 * n_words)) AS kept FROM judged"""



TERM = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"
LEXICAL = rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, {TERM}) AS terms FROM documents),
t AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM d) GROUP BY 1, 2),
s AS (SELECT count(*)::BIGINT AS docs, sum(len(terms))::BIGINT AS total FROM d WHERE len(terms) > 0),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM t, s GROUP BY term, docs),
m AS (SELECT row, doc_id, 25 + (75 * len(terms) * docs) // total AS m FROM d, s WHERE len(terms) > 0),
i AS (SELECT row_number() OVER () AS item, item_id, unnest(regexp_extract_all({LOWER.format("coalesce(text, '')")}, {TERM})) AS term FROM benchmark),
q AS (SELECT item, item_id, term, count(*) AS times FROM i GROUP BY ALL),
found AS (SELECT item, item_id, row, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM q JOIN w USING (term) JOIN t USING (term) JOIN m USING (row) GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM found WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10"""


PHRASES = rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({LOWER.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p),
s AS (SELECT lang, words, unnest(generate_series(1, len(words))) AS i FROM w),
g AS (SELECT lang, words[i:i + k - 1] AS gram FROM s, (VALUES (1), (2), (3), (4)) t(k) WHERE i + k - 1 <= len(words)),
f AS (SELECT lang, array_to_string(gram, ' ') AS phrase, any_value(gram) AS gram, any_value(len(gram)) AS k, count(*) AS n FROM g GROUP BY 1, 2),
c AS (SELECT * FROM f WHERE k > 1 AND n >= 30),
cuts AS (SELECT lang, phrase, gram, n, unnest(generate_series(1, k - 1)) AS j, k FROM c),
halves AS (SELECT lang, phrase, n, j, array_to_string(gram[1:j], ' ') AS head, array_to_string(gram[j + 1:k], ' ') AS tail FROM cuts),
scored AS (SELECT h.lang, h.phrase, h.n AS a, x.n AS l, y.n AS r, j, (2000000::HUGEINT * h.n) // (x.n + y.n) AS score
  FROM halves h JOIN f x ON x.lang = h.lang AND x.phrase = h.head JOIN f y ON y.lang = h.lang AND y.phrase = h.tail),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
spans AS (SELECT lang, gram, n, k, unnest(generate_series(1, k - 1)) AS i FROM c),
parts AS (SELECT lang, gram, n, k, i, unnest(generate_series(i + 1, least(k, i + k - 2))) AS e FROM spans),
dropped AS (SELECT DISTINCT c.lang, c.phrase FROM parts q JOIN c ON c.lang = q.lang AND c.phrase = array_to_string(q.gram[q.i:q.e], ' ')
  WHERE 100 * q.n >= 80 * c.n),
total AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE k = 1 GROUP BY 1),
ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score
  FROM best ANTI JOIN dropped USING (lang, phrase))
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN total USING (lang) WHERE rank <= 2000"""


ORACLES = {"op5_url_filters": url_filters(), "op7_embedding_dedup": EMBEDDINGS, "op9_quality_rules": QUALITY,
           "op12_collocations": PHRASES, "op13_lexical_search": LEXICAL}
