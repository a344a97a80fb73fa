"""DuckDB statements of the queries that SQL can express."""

from __future__ import annotations

from evenhand.llm.license_texts import NOTICES, TEXTS
from evenhand.llm.licenses import COPYRIGHT_LINE, NOT_WORD, SPELLINGS

MIXING_SQL = r"""
WITH sized AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
        ('0x' || substr(md5('mix|' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
    FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
        (CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END)::DOUBLE AS weight
    FROM sized GROUP BY source
), filled AS (
    SELECT *, (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE
            - coalesce(sum(2.0::DOUBLE * source_size) OVER before, 0.0) AS rest,
        (sum(weight) OVER ()) - coalesce(sum(weight) OVER before, 0.0) AS free,
        row_number() OVER (ORDER BY source_size * 2.0::DOUBLE / weight, source NULLS LAST) AS place
    FROM sources
    WINDOW before AS (ORDER BY source_size * 2.0::DOUBLE / weight, source NULLS LAST
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), wanted AS (
    SELECT source, source_size, least(source_size * 2.0::DOUBLE, weight * (
        SELECT arg_min(rest / free, place) FROM filled WHERE rest / free * weight <= source_size * 2.0::DOUBLE)) AS target
    FROM filled
), classes AS (
    SELECT z.source, count(*) AS docs, any_value(s.source_size) AS source_size FROM sized z JOIN sources s ON z.source IS NOT DISTINCT FROM s.source
    GROUP BY z.source
), longs AS (
    SELECT c.source, c.docs, coalesce(sum(z.size) FILTER (z.size >= c.source_size / c.docs), 0)::BIGINT AS long_words
    FROM sized z JOIN classes c ON z.source IS NOT DISTINCT FROM c.source GROUP BY c.source, c.docs
), parts AS (
    SELECT w.*, l.docs, l.long_words, w.source_size - l.long_words AS short_words,
        floor(CASE WHEN w.source_size > 0 THEN target / w.source_size ELSE 0 END) AS whole,
        (CASE WHEN w.source_size > 0 THEN target / w.source_size ELSE 0 END)
            - floor(CASE WHEN w.source_size > 0 THEN target / w.source_size ELSE 0 END) AS p
    FROM wanted w JOIN longs l ON w.source IS NOT DISTINCT FROM l.source
), chances AS (
    SELECT *, target - whole * source_size AS quota,
        p + (least(p, 1.0::DOUBLE - p) * 0.5::DOUBLE) * (short_words::DOUBLE / greatest(long_words, short_words, 1)::DOUBLE) AS p_long,
        p - (least(p, 1.0::DOUBLE - p) * 0.5::DOUBLE) * (long_words::DOUBLE / greatest(long_words, short_words, 1)::DOUBLE) AS p_short
    FROM parts
), drawn AS (
    SELECT s.doc_id, s.source, s.size, s.u, c.source_size, c.target, c.whole, c.quota,
        CASE WHEN s.size >= c.source_size / c.docs THEN c.p_long ELSE c.p_short END AS p
    FROM sized s JOIN chances c ON s.source IS NOT DISTINCT FROM c.source
), placed AS (
    SELECT *, CASE WHEN p > 0 AND p < 1 THEN (u * (1.0::DOUBLE - p)) / (u * (1.0::DOUBLE - p) + p * (1.0::DOUBLE - u)) ELSE u END AS place FROM drawn
), ordered AS (
    SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY place, doc_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS so_far
    FROM placed
)
SELECT doc_id, size, source_size, target,
    (size * (whole + CASE WHEN quota > 0 AND so_far + size / 2.0::DOUBLE <= quota THEN 1 ELSE 0 END))::BIGINT AS taken
FROM ordered
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _canonical(column: str) -> str:
    out = f"regexp_replace(lower({column}), {_quoted(COPYRIGHT_LINE)}, '', 'g')"
    out = f"trim(regexp_replace({out}, {_quoted(NOT_WORD)}, ' ', 'g'))"
    for pattern, replacement in SPELLINGS:
        out = f"regexp_replace({out}, {_quoted(pattern)}, {_quoted(replacement.replace('$', chr(92)))}, 'g')"
    return out


def _known(rows) -> str:
    values = ", ".join(f"({_quoted(name)}, {_quoted(text)})" for name, text in rows)
    return f"SELECT sha256({_canonical('text')}) AS digest, min(licence) AS licence FROM (VALUES {values}) AS k(licence, text) GROUP BY 1"


LICENSES_SQL = f"""
WITH texts AS ({_known(TEXTS)}), notices AS ({_known(NOTICES)}),
lines AS (
    SELECT doc_id, unnest(list_filter(string_split(text, chr(10)), lambda x: contains(lower(x), 'licen'))) AS line FROM documents
), found AS (
    SELECT doc_id, count(*)::BIGINT AS n_notices, string_agg(DISTINCT licence, ',' ORDER BY licence) AS notices
    FROM (SELECT doc_id, sha256({_canonical('line')}) AS digest FROM lines) JOIN notices USING (digest) GROUP BY doc_id
)
SELECT d.doc_id, d.digest, t.licence, coalesce(f.n_notices, 0)::BIGINT AS n_notices, f.notices
FROM (SELECT doc_id, sha256({_canonical('text')}) AS digest FROM documents) d
LEFT JOIN texts t ON t.digest = d.digest LEFT JOIN found f ON f.doc_id = d.doc_id
"""

FILTERS_SQL = r"""
WITH texts AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), firsts AS (
    SELECT text, min(doc_id) AS least FROM texts GROUP BY text
), flags AS (
    SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS bad
    FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), failing AS (
    SELECT t.part, coalesce(g.good, false) AS good, coalesce(g.bad, false) AS bad, [
        len(words) < 50,
        100 * len(list_distinct(words)) < 65 * len(words),
        100 * (length(t.text) - length(regexp_replace(t.text, '[A-Z]', '', 'g'))) > 5 * length(t.text),
        regexp_matches(t.text, '[#$%&*|]'),
        coalesce(t.doc_id > f.least, false)] AS fails
    FROM texts t JOIN firsts f ON t.text = f.text LEFT JOIN flags g ON t.doc_id = g.doc_id
), masks AS (
    SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (bad) AS bad FROM failing GROUP BY ALL
), letters AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter
), orders AS (
    SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.letter, b.letter, c.letter, d.letter, e.letter])) = 5
), steps AS (
    SELECT filter_order, unnest(range(1, 6))::INTEGER AS step FROM orders
), placed AS (
    SELECT filter_order, step, ascii(filter_order[step]) - 64 AS own,
        list_transform(range(1, step), lambda i: ascii(filter_order[i]) - 64) AS before
    FROM steps
), counted AS (
    SELECT m.part, p.filter_order, p.step, p.own,
        sum(CASE WHEN NOT came AND NOT fails[own] THEN n ELSE 0 END)::BIGINT AS kept,
        sum(CASE WHEN NOT came AND fails[own] THEN n ELSE 0 END)::BIGINT AS removed,
        sum(CASE WHEN came AND fails[own] THEN n ELSE 0 END)::BIGINT AS redundant,
        sum(CASE WHEN fails[own] AND len(list_filter(fails, lambda f: f)) = 1 THEN n ELSE 0 END)::BIGINT AS unique_fails,
        sum(CASE WHEN NOT came AND fails[own] THEN good ELSE 0 END)::BIGINT AS good_lost,
        sum(CASE WHEN NOT came AND fails[own] THEN bad ELSE 0 END)::BIGINT AS toxic_lost
    FROM masks m, placed p, LATERAL (SELECT coalesce(list_bool_or(list_transform(p.before, lambda i: m.fails[i])), false) AS came)
    GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM counted
"""
