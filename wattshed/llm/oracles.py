"""DuckDB SQL for the rows of queries that SQL can express."""

from __future__ import annotations

from wattshed.llm.chat import CONTROLS, END, START
from wattshed.llm.hamming import OP4_SQL
from wattshed.llm.negatives import OP11_SQL
from wattshed.llm.secrets import ADDED, BASE, EXAMPLE_OWNERS, LEAST_VARIETY, MIXED_LEAST, PLACEHOLDERS

WORDS = r"regexp_extract_all({}, '[^ \t\n\x0B\f\r]+')"

OP1_SQL = f"""
WITH docs AS (
    SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS words FROM documents
), windows AS (
    SELECT doc_id, i, md5(array_to_string(words[i:i + 49], ' ')) AS hash
    FROM docs, unnest(range(1, len(words) - 48)) t(i)
), firsts AS (
    SELECT hash, min(doc_id) AS least FROM windows GROUP BY hash
), gone AS (
    SELECT DISTINCT doc_id, i + k AS place
    FROM windows JOIN firsts USING (hash), unnest(range(50)) t(k) WHERE least < doc_id
), kept AS (
    SELECT d.doc_id, count(g.place) AS n_removed,
        coalesce(string_agg(d.words[i], ' ' ORDER BY i) FILTER (g.place IS NULL), '') AS text
    FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM docs) d
    LEFT JOIN gone g ON g.doc_id = d.doc_id AND g.place = i GROUP BY d.doc_id
)
SELECT doc_id, len(words) AS n_words, coalesce(n_removed, 0) AS n_removed,
    sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""

_CONTROL = "|".join(
    rf"{a.replace('[', chr(92) + '[')}\\*{b.replace('|', chr(92) + '|').replace(']', chr(92) + ']')}" for a, b in CONTROLS
)

OP2_SQL = rf"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
    SELECT *, {len(START) + len(END) + 2} + length(role) + length(text) + len(regexp_extract_all(text, '{_CONTROL}')) AS size
    FROM turns
), summed AS (
    SELECT *, sum(size) OVER w AS upto, row_number() OVER w AS place, count(*) OVER (PARTITION BY conv_id) AS n
    FROM sized WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING)
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(upto) FILTER (role = 'assistant' OR place = n)::BIGINT AS formatted_chars,
    count(*) FILTER (role = 'assistant' OR place = n) AS n_examples
FROM summed GROUP BY conv_id
"""

OP5_SQL = f"""
WITH RECURSIVE docs AS (
    SELECT doc_id, {WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS words
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS shingle
    FROM docs, unnest(range(1, greatest(len(words) - 3, 2))) t(i) WHERE len(words) > 0
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
    GROUP BY ALL HAVING 100 * count(*) >= 75 * (any_value(x.n) + any_value(y.n) - count(*))
), reached AS (
    SELECT doc_id AS a, doc_id AS b FROM docs
    UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM docs d LEFT JOIN sizes s USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a) USING (doc_id)
"""

OP5_LINKS_SQL = f"""
WITH docs AS (
    SELECT doc_id, {WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS words
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS shingle
    FROM docs, unnest(range(1, greatest(len(words) - 3, 2))) t(i) WHERE len(words) > 0
), sizes AS (
    SELECT doc_id, count(*) AS n, md5(string_agg(shingle, chr(10) ORDER BY shingle)) AS print FROM shingles GROUP BY doc_id
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
    GROUP BY ALL HAVING 100 * count(*) >= 75 * (any_value(x.n) + any_value(y.n) - count(*))
)
SELECT g.doc_id, n_shingles, component_id,
    coalesce(min(g.doc_id) FILTER (print IS NOT NULL) OVER (PARTITION BY print), g.doc_id) AS class_id, coalesce(n_links, 0) AS n_links
FROM ({OP5_SQL}) g LEFT JOIN sizes s USING (doc_id)
LEFT JOIN (SELECT a AS doc_id, count(*) AS n_links FROM links GROUP BY a) l USING (doc_id)
"""


def _found(kind: str, number: int, pattern: str, least: int, group: int, more: str = "") -> str:
    """Rows (doc_id, start, kind, stop, value) of one pattern."""
    quoted = pattern.replace("'", "''")
    value = f"regexp_extract(match, '{quoted}', {group})"
    return f"""
    SELECT doc_id, lang, source, start, {number} AS number, '{kind}' AS kind, start + length(match) AS stop, {value} AS value
    FROM (
        SELECT doc_id, lang, source, matches[i] AS match,
            (list_sum(list_transform(gaps[1:i], lambda g: length(g)))
             + coalesce(list_sum(list_transform(matches[1:i - 1], lambda m: length(m))), 0))::INT AS start
        FROM (
            SELECT doc_id, lang, source, regexp_split_to_array(coalesce(text, ''), '{quoted}') AS gaps,
                regexp_extract_all(coalesce(text, ''), '{quoted}') AS matches
            FROM documents
        ), unnest(range(1, len(matches) + 1)) t(i)
    ) WHERE length({value}) >= {least} {more}"""


_MIXED = _found(
    ADDED, len(BASE), f"[A-Za-z0-9+/_=-]{{{MIXED_LEAST},}}", MIXED_LEAST, 0,
    "AND regexp_matches(match, '[0-9]') AND regexp_matches(match, '[A-Z]') AND regexp_matches(match, '[a-z]')",
)

OP10_SQL = f"""
WITH base AS ({" UNION ALL ".join(_found(kind, i, *rest) for i, (kind, *rest) in enumerate(BASE))}
), more AS (
    SELECT * FROM ({_MIXED}) m
    WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = m.doc_id AND b.start < m.stop AND m.start < b.stop)
), spans AS (SELECT * FROM base UNION ALL SELECT * FROM more
), owners AS (SELECT value, count(DISTINCT coalesce(source, '')) AS owners FROM spans GROUP BY value
), judged AS (
    SELECT s.*, owners < {EXAMPLE_OWNERS} AND len(list_distinct(regexp_extract_all(value, '(?s).'))) >= {LEAST_VARIETY}
        AND NOT regexp_matches(value, '{PLACEHOLDERS}') AS live
    FROM spans s JOIN owners USING (value)
), kept AS (SELECT * FROM judged WHERE number < {len(BASE)} OR live
), listed AS (
    SELECT doc_id, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k, *_ in BASE)},
        string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, number) FILTER (number < {len(BASE)}) AS base,
        string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, number) AS spans,
        count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_example
    FROM kept GROUP BY doc_id
)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k, *_ in BASE)}, sha256(coalesce(base, '')) AS base_sha256,
    coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
FROM documents LEFT JOIN listed USING (doc_id)
"""

ORACLES = {
    "op1_substring_dedup": OP1_SQL,
    "op2_prefix_targets": OP2_SQL,
    "op4_multi_index_hashing": OP4_SQL,
    "op5_jaccard_join": OP5_SQL,
    "op5_jaccard_links": OP5_LINKS_SQL,
    "op10_owned_secrets": OP10_SQL,
    "op11_hard_negatives": OP11_SQL,
}
