"""DuckDB SQL for the queries that SQL can express."""

from tidemark.llm.license_scan import BASE, NOTICES

ORACLE: dict[str, str] = {}

ORACLE["op1_substring_dedup"] = r"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), places AS (
    SELECT doc_id, unnest(range(1, len(w) - 18)) AS s, w FROM words WHERE len(w) >= 20
), windows AS (
    SELECT doc_id, s, array_to_string(w[s:s + 19], ' ') AS passage FROM places
), repeated AS (
    SELECT doc_id, s FROM windows
    QUALIFY row_number() OVER (PARTITION BY passage ORDER BY doc_id, s) > 1
), gone AS (
    SELECT DISTINCT doc_id, s + i AS p FROM repeated, (SELECT unnest(range(0, 20)) AS i)
), kept AS (
    SELECT d.doc_id, string_agg(d.word, ' ' ORDER BY d.p) AS kept, count(*) AS n
    FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM words) d
    ANTI JOIN gone g ON d.doc_id = g.doc_id AND d.p = g.p
    GROUP BY d.doc_id
)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(len(w.w) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM words w LEFT JOIN kept k USING (doc_id)
"""

ORACLE["op4_mixing"] = r"""
WITH RECURSIVE docs AS (
    SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
           md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || md5(coalesce(text, ''))) AS bits
    FROM documents
), sizes AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source
), weighed AS (
    SELECT source, source_size, [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3]
        ::DOUBLE AS weight
    FROM sizes
), goal AS (
    SELECT 1.5 * sum(source_size)::DOUBLE AS goal FROM sizes
), levels(n, level) AS (
    SELECT 0, 0.0::DOUBLE
    UNION ALL
    SELECT n + 1, (
        SELECT (goal - coalesce(sum(2.0 * source_size) FILTER (level * weight > 2.0 * source_size), 0))
               / sum(weight) FILTER (NOT level * weight > 2.0 * source_size)
        FROM weighed, goal GROUP BY goal)
    FROM levels WHERE n < 30 AND level IS NOT NULL
), final AS (
    SELECT max(level) AS level, bool_or(level IS NULL) AS none FROM levels
), targets AS (
    SELECT source, source_size,
           CASE WHEN none THEN 2.0 * source_size ELSE least(2.0 * source_size, level * weight) END::DOUBLE AS target
    FROM weighed, final
), rated AS (
    SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
           ('0x' || substr(bits, 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS draw
    FROM docs LEFT JOIN targets ON docs.source IS NOT DISTINCT FROM targets.source
)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM rated
"""

ORACLE["op6_line_dedup"] = r"""
WITH lines AS (
    SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS n
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), keyed AS (
    SELECT doc_id, line, n, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), common AS (
    SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (c.key IS NOT NULL)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (c.key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN common c USING (key)
GROUP BY doc_id
"""

ORACLE["op10_jaccard_join"] = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[s:s + 4], ' ') AS shingle
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS s FROM words WHERE len(w) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, x.n, y.n
    HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))
), reached AS (
    SELECT doc_id AS node, doc_id AS other FROM sizes
    UNION
    SELECT r.node, l.b FROM reached r JOIN links l ON r.other = l.a
), least AS (
    SELECT node, min(other) AS component_id FROM reached GROUP BY node
)
SELECT w.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, coalesce(l.component_id, w.doc_id) AS component_id
FROM words w LEFT JOIN sizes s USING (doc_id) LEFT JOIN least l ON l.node = w.doc_id
"""

ORACLE["op9_metric_search"] = r"""
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)) AS e
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 100 = 0
), ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
           vec_id, score
    FROM scored
)
SELECT * FROM ranked WHERE rank <= 10
"""

_TEMPLATES = ", ".join(
    f"('{kind}', '{phrase}', '{label}')"
    for kind, phrases in (("base", BASE), ("notice", NOTICES))
    for phrase, label in phrases.items()
)

ORACLE["op2_license_scan"] = rf"""
WITH templates(kind, phrase, label) AS (
    VALUES {_TEMPLATES}
), template_words AS (
    SELECT *, string_split(phrase, ' ') AS w FROM templates
), template_grams AS (
    SELECT kind, phrase, label, len(w) AS size, i - 1 AS place, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS gram
    FROM (SELECT *, unnest(range(1, len(w) - 1)) AS i FROM template_words)
), words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), grams AS (
    SELECT doc_id, i - 1 AS pos, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS gram
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM words)
), hits AS (
    SELECT doc_id, kind, phrase, label, size, place, pos, pos - place AS diagonal FROM grams JOIN template_grams USING (gram)
), diagonals AS (
    SELECT DISTINCT doc_id, kind, phrase, diagonal FROM hits
), marked AS (
    SELECT *, kind = 'base' OR coalesce(diagonal - lag(diagonal) OVER (
        PARTITION BY doc_id, kind, phrase ORDER BY diagonal) > 3, TRUE) AS new
    FROM diagonals
), numbered AS (
    SELECT *, sum(new::INTEGER) OVER (PARTITION BY doc_id, kind, phrase ORDER BY diagonal) AS span FROM marked
), covered AS (
    SELECT doc_id, kind, label, count(DISTINCT place + k) / size AS score, min(pos) AS first
    FROM numbered JOIN hits USING (doc_id, kind, phrase, diagonal), (SELECT unnest([0, 1, 2]) AS k)
    GROUP BY doc_id, kind, phrase, label, size, span
), spans AS (
    SELECT * FROM covered WHERE score >= CASE WHEN kind = 'base' THEN 1 ELSE 0.75 END
)
SELECT words.doc_id, CAST(len(w) AS BIGINT) AS n_words, count(*) FILTER (kind = 'base') AS n_base,
       min(first) FILTER (kind = 'base') AS first_word, max(first) FILTER (kind = 'base') AS last_word,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (kind = 'base'), '') AS base_labels,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels,
       CAST(coalesce(max(score), 0) AS DOUBLE) AS score
FROM words LEFT JOIN spans USING (doc_id)
GROUP BY words.doc_id, len(w)
"""

ORACLE["op11_phrase_collocations"] = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(p) AS piece, unnest(range(len(p))) AS at
    FROM (SELECT lang, doc_id, string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS p FROM documents)
), words AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), grams AS (
    SELECT lang, k, array_to_string(w[s:s + k - 1], ' ') AS phrase, count(*)::HUGEINT AS f
    FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM words, (SELECT unnest([1, 2, 3]) AS k))
    GROUP BY ALL
), totals AS (
    SELECT lang, sum(f) AS n FROM grams WHERE k = 1 GROUP BY lang
), candidates AS (
    SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM grams WHERE k > 1 AND f >= 10
), cuts AS (
    SELECT c.lang, c.k, c.phrase, c.a, c.w, cut, l.f AS l, r.f AS r, 1000000 * c.a * c.a // (l.f * r.f) AS score
    FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates) c
    JOIN grams l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:cut], ' ')
    JOIN grams r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[cut + 1:], ' ')
), best AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), within AS (
    SELECT lang, array_to_string(w[i:i + 1], ' ') AS phrase, max(a) AS longer
    FROM (SELECT lang, a, w, unnest([1, 2]) AS i FROM candidates WHERE k = 3) GROUP BY ALL
), ranked AS (
    SELECT lang, phrase, a, l, r, n, score,
           row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank
    FROM best LEFT JOIN within USING (lang, phrase) JOIN totals USING (lang)
    WHERE longer IS NULL OR 100 * longer < 50 * a
)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n,
       score::BIGINT AS score
FROM ranked WHERE rank <= 2000
"""
