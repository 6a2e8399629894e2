"""SQL for DuckDB with the same results as some of the queries, by brute force."""

from __future__ import annotations

from topicpulse.llm import conversation_trie as trie, sharded_lloyd as lloyd
from topicpulse.llm.near_duplicates import SIMILARITY_PERCENT
from topicpulse.llm.quality_rules import ERROR, GRID_FACTOR, GRID_STEPS, RISK, RULES

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _words(text: str) -> str:
    split = f"regexp_split_to_array(coalesce({text}, ''), '[\\x20\\x09-\\x0D]+')"
    return f"list_filter({split}, lambda x: x <> '')"


NEAR_DUPLICATES = f"""
WITH RECURSIVE w AS (
    SELECT doc_id, {_words(f"translate(text, '{_UPPER}', '{_UPPER.lower()}')")} AS ws
    FROM documents),
s AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) < 2 THEN ws
        ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END) AS g
    FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
    FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
    SELECT a, b FROM pairs JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
    WHERE 100 * c >= {SIMILARITY_PERCENT} * (na.n + nb.n - c)),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
    SELECT doc_id AS d, doc_id AS r FROM documents
    UNION SELECT reach.d, l.b FROM reach JOIN both_ways l ON l.a = reach.r)
SELECT documents.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id,
    documents.doc_id = c.component_id AS kept
FROM documents LEFT JOIN n ON n.doc_id = documents.doc_id
JOIN (SELECT d, min(r) AS component_id FROM reach GROUP BY 1) c ON c.d = documents.doc_id
"""

_STEPS = " UNION ALL ".join(
    f"""SELECT doc_id, lang, '{rule}' AS rule, least({GRID_STEPS}, CASE WHEN v > {top}::DOUBLE THEN 0
    WHEN v <= 0 THEN {GRID_STEPS}
    ELSE greatest(0, floor(ln(v / {top}::DOUBLE) / ln({GRID_FACTOR}::DOUBLE)) + 1) END)::INT AS step
    FROM (SELECT *, {above}::DOUBLE / greatest({below}, 1) AS v FROM based)"""
    for rule, (above, below, top) in RULES.items()
)

QUALITY_RULES = f"""
WITH w AS (
    SELECT row_number() OVER () AS row, doc_id, lang, coalesce(text, '') AS text,
        {_words("text")} AS ws FROM documents),
g AS (
    SELECT row, unnest(range(1, len(ws) - 1)) AS p,
        unnest(list_transform(range(1, len(ws) - 1),
            lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) AS x
    FROM w WHERE len(ws) >= 3),
twice AS (SELECT row, p FROM g QUALIFY count(*) OVER (PARTITION BY row, x) > 1),
covered AS (
    SELECT row, count(DISTINCT p + k.k) AS n FROM twice, (VALUES (0), (1), (2)) k(k) GROUP BY 1),
l AS (
    SELECT row, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup FROM (
        SELECT row, unnest(string_split(text, chr(10))) AS line FROM w)
    WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY 1),
based AS (
    SELECT w.row, doc_id, lang, len(ws)::BIGINT AS n_words,
        length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
        (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols,
        coalesce(n_lines, 0) AS n_lines, coalesce(n_dup, 0)::BIGINT AS n_dup_lines,
        coalesce(covered.n, 0)::BIGINT AS n_repeat_words
    FROM w LEFT JOIN l ON l.row = w.row LEFT JOIN covered ON covered.row = w.row),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM based),
steps AS ({_STEPS}),
marked AS (
    SELECT doc_id, max(quality) AS quality FROM labels
    WHERE doc_id IS NOT NULL AND quality IN (0, 1) GROUP BY 1),
long AS (
    SELECT s.lang, s.rule, s.step, m.quality FROM steps s
    JOIN marked m ON m.doc_id = s.doc_id
    JOIN judged j ON j.doc_id = s.doc_id AND NOT j.base_failed),
families AS (SELECT DISTINCT lang, rule FROM long),
full_grid AS (
    SELECT f.lang, f.rule, t.step, count(CASE WHEN quality = 1 THEN 1 END) AS good,
        count(CASE WHEN quality = 0 THEN 1 END) AS bad
    FROM families f CROSS JOIN range(0, {GRID_STEPS} + 1) t(step)
    LEFT JOIN long ON long.lang IS NOT DISTINCT FROM f.lang AND long.rule = f.rule
        AND long.step = t.step GROUP BY 1, 2, 3),
summed AS (
    SELECT *, sum(good) OVER one AS n_good, sum(bad) OVER one AS n_bad,
        sum(good) OVER upto AS cut_good, sum(bad) OVER upto AS cut_bad FROM full_grid
    WINDOW one AS (PARTITION BY lang, rule),
        upto AS (PARTITION BY lang, rule ORDER BY step ROWS UNBOUNDED PRECEDING)),
chances AS (
    SELECT *, CASE WHEN cut_good >= n_good * {RISK}::DOUBLE THEN 1.0 ELSE list_sum(list_transform(
        range(0, cut_good::BIGINT + 1), lambda j: exp(lgamma(n_good + 1) - lgamma(j + 1)
            - lgamma(n_good - j + 1) + j * ln({RISK}::DOUBLE)
            + (n_good - j) * ln(1 - {RISK}::DOUBLE)))) END AS chance
    FROM summed WHERE step < {GRID_STEPS}),
tested AS (
    SELECT *, cut_bad / greatest(n_bad, 1) - cut_good / greatest(n_good, 1) AS gain FROM (
        SELECT *, max(chance) OVER (PARTITION BY lang, rule ORDER BY step
            ROWS UNBOUNDED PRECEDING) AS worst FROM chances)
    WHERE worst <= {ERROR}::DOUBLE / (SELECT greatest(count(*), 1) FROM families)),
best AS (
    SELECT lang, rule, step FROM tested WHERE gain > 0
    QUALIFY row_number() OVER (PARTITION BY lang, rule ORDER BY gain DESC, step) = 1),
rejected AS (
    SELECT s.doc_id, string_agg(s.rule, ',' ORDER BY list_position({list(RULES)}, s.rule)) AS rules
    FROM steps s JOIN best b ON b.lang IS NOT DISTINCT FROM s.lang AND b.rule = s.rule
        AND s.step <= b.step GROUP BY 1)
SELECT j.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND r.rules IS NULL AS kept, coalesce(r.rules, '') AS rejected_by
FROM judged j LEFT JOIN rejected r ON r.doc_id = j.doc_id
"""



def _lloyd_round(n: int) -> str:
    """Nearest centroid of every vector, and the means of what each centroid got."""
    return f"""
a{n} AS MATERIALIZED (
    SELECT r, vec_id, xs, j, d FROM (
        SELECT v.*, c.j, list_sum(list_transform(list_zip(v.xs, c.xs),
            lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM v CROSS JOIN c{n} c)
    QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, j) = 1),
m{n} AS (
    SELECT j, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS xs FROM (
        SELECT j, i, sum(x)::BIGINT AS s, count(*)::BIGINT AS n FROM (
            SELECT j, unnest(xs) AS x, unnest(range(1, len(xs) + 1)) AS i FROM a{n})
        GROUP BY 1, 2) GROUP BY 1),
c{n + 1} AS MATERIALIZED (
    SELECT c.j, coalesce(m.xs, c.xs) AS xs FROM c{n} c LEFT JOIN m{n} m ON m.j = c.j)"""


SHARDED_LLOYD = f"""
WITH v AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding,
        lambda x: floor({lloyd.SCALE} * x::DOUBLE)::BIGINT) AS xs
    FROM embeddings WHERE len(embedding) = {lloyd.DIMENSIONS} AND len(list_filter(embedding,
        lambda x: x IS NOT NULL AND isfinite(x::DOUBLE))) = {lloyd.DIMENSIONS}),
c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY mark NULLS LAST, xs) - 1 AS j, xs FROM (
        SELECT sha256('1:' || vec_id) AS mark, xs FROM v
        ORDER BY mark NULLS LAST, xs LIMIT {lloyd.K})),
{",".join(_lloyd_round(n) for n in range(lloyd.ROUNDS + 1))}
SELECT a.vec_id, a.j::INT AS cluster, a.d AS distance,
    (sum(a.d) OVER (PARTITION BY a.j))::BIGINT AS cluster_inertia,
    (sum(a.d) OVER ())::BIGINT AS inertia,
    sha256(list_aggregate(list_transform(c.xs, lambda x: x::VARCHAR), 'string_agg', ','))
        AS centroid_sha256
FROM a{lloyd.ROUNDS} a JOIN c{lloyd.ROUNDS} c ON c.j = a.j
"""

_CRC_STEP = """list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y:
    CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"""

# The conversation with the smallest id in a node has the node's ancestors as its prefixes.
CONVERSATION_TRIE = f"""
WITH turns AS MATERIALIZED (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id
            ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
    FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
    SELECT conv_id, conv_id - conv_id % {trie.FAMILY} AS head, count(*) AS n,
        xor(list_reduce([4294967295] || list_transform(string_split(conv_id::VARCHAR, ''),
            lambda s: ascii(s)::BIGINT), lambda c, b: {_CRC_STEP}), 4294967295) % {trie.HEADS} AS h
    FROM turns GROUP BY 1),
given AS (
    SELECT c.*, least(c.h, coalesce(t.n, 0)) AS g FROM convs c LEFT JOIN convs t ON t.conv_id = c.head),
rebuilt AS (
    SELECT c.conv_id, t.i AS pos, role, text
    FROM given c JOIN turns t ON t.conv_id = c.head AND t.i <= c.g
    UNION ALL SELECT c.conv_id, c.g + t.i - c.h, role, text
    FROM given c JOIN turns t ON t.conv_id = c.conv_id AND t.i > c.h),
path AS MATERIALIZED (
    SELECT conv_id, pos, octet_length(encode(text)) AS bytes, md5(string_agg(
        length(role) || ':' || role || length(text) || ':' || text, '') OVER (
        PARTITION BY conv_id ORDER BY pos)) AS k FROM rebuilt
    UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
ended AS (SELECT *, pos = max(pos) OVER (PARTITION BY conv_id) AS is_end FROM path),
nodes AS MATERIALIZED (
    SELECT k, pos AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (is_end), ''))
            AS ends_sha256
    FROM ended GROUP BY 1, 2),
tied AS MATERIALIZED (
    SELECT n.*, p.k AS parent FROM nodes n
    LEFT JOIN path p ON p.conv_id = n.conv_id AND p.pos = n.depth - 1),
kids AS (SELECT parent, count(*) AS n FROM tied WHERE parent IS NOT NULL GROUP BY 1),
sums AS (
    SELECT a.k, sum((n.n_convs - 1) * n.bytes) AS saved, count(*) FILTER (kids.n IS NULL) AS leaves
    FROM nodes n LEFT JOIN kids ON kids.parent = n.k
    JOIN path a ON a.conv_id = n.conv_id AND a.pos <= n.depth GROUP BY 1)
SELECT t.conv_id, t.depth, p.conv_id AS parent_conv_id, t.n_convs,
    coalesce(kids.n, 0) AS n_children, sums.leaves AS n_leaves,
    sums.saved::BIGINT AS saved_tokens, t.ends_sha256
FROM tied t JOIN sums ON sums.k = t.k
LEFT JOIN kids ON kids.parent = t.k LEFT JOIN nodes p ON p.k = t.parent
"""

ORACLE = {
    "op4_quality_rules": QUALITY_RULES,
    "op5_near_duplicates": NEAR_DUPLICATES,
    "op11_sharded_lloyd": SHARDED_LLOYD,
    "op12_conversation_trie": CONVERSATION_TRIE,
}
