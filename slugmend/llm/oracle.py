"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

# A line's words, lower case; lists of words compare by value.
_LINES = r"""
texts AS (
    SELECT doc_id, generate_subscripts(s, 1) - 1 AS line_no, unnest(s) AS line
    FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents WHERE text IS NOT NULL)
),
lines AS (
    SELECT doc_id, line_no, w, len(w) AS n, {'last': doc_id IS NULL, 'id': doc_id, 'line': line_no} AS place
    FROM (
        SELECT doc_id, line_no,
               list_filter(string_split_regex(lower(line), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
        FROM texts
    )
    WHERE len(w) >= 5
)
"""

LINE_DEDUP = (
    "WITH "
    + _LINES
    + r""",
firsts AS (SELECT w, n, min(place) AS first FROM lines GROUP BY w, n),
deleted AS (
    SELECT w, first, pos, list_concat(w[1:pos - 1], w[pos + 1:]) AS v
    FROM (SELECT w, first, unnest(range(1, n + 1)) AS pos FROM firsts WHERE n >= 8)
),
near AS (
    SELECT w, min(other) AS near FROM (
        SELECT a.w, b.first AS other FROM deleted a JOIN deleted b ON a.v = b.v AND a.pos = b.pos WHERE b.first < a.first
        UNION ALL
        SELECT a.w, b.first FROM deleted a JOIN firsts b ON a.v = b.w AND b.n >= 8 WHERE b.first < a.first
        UNION ALL
        SELECT b.w, a.first FROM deleted a JOIN firsts b ON a.v = b.w AND b.n >= 8 WHERE a.first < b.first
    ) GROUP BY w
)
SELECT l.doc_id, l.line_no::INTEGER AS line_no, l.n::INTEGER AS n_words,
       l.place = f.first AND m.near IS NULL AS kept,
       f.first.id AS equal_doc_id, f.first.line::INTEGER AS equal_line_no,
       m.near.id AS near_doc_id, m.near.line::INTEGER AS near_line_no
FROM lines l JOIN firsts f ON l.w = f.w LEFT JOIN near m ON l.w = m.w
"""
)

TOP_K = """
WITH v AS (
    SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
    FROM v q JOIN v c ON len(q.v) = len(c.v) AND q.vec_id <> c.vec_id
    WHERE q.vec_id % 100 = 0
)
SELECT query_id, rank, vec_id, score
FROM (
    SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank
    FROM (SELECT DISTINCT * FROM scored)
)
WHERE rank <= 10
"""

# Phrases of one to five words; lists of words compare by value.
COLLOCATIONS = r"""
WITH texts AS (
    SELECT coalesce(lang, 'und') AS lang,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
    FROM documents
),
pieces AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS p FROM texts),
words AS (
    SELECT lang, list_filter(string_split_regex(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
phrases AS (
    SELECT lang, w[i:i + m - 1] AS p, m, count(*) AS f
    FROM (
        SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i
        FROM words, (SELECT unnest(range(1, 6)) AS m) WHERE len(w) >= m
    ) GROUP BY ALL HAVING count(*) >= 100
),
inside AS (
    SELECT lang, p[1:m - 1] AS p, f FROM phrases WHERE m > 2
    UNION ALL
    SELECT lang, p[2:], f FROM phrases WHERE m > 2
),
candidates AS (
    SELECT * FROM phrases c
    WHERE m > 1 AND NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = c.lang AND i.p = c.p AND 100 * i.f >= 100 * c.f)
),
cuts AS (SELECT lang, p, m, f, unnest(range(1, m)) AS k FROM candidates),
scored AS (
    SELECT c.lang, c.p, c.f AS a, c.k, x.f AS l, y.f AS r, n,
           ((1000::HUGEINT * c.f * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
    FROM cuts c
    JOIN phrases x ON x.lang = c.lang AND x.p = c.p[1:c.k]
    JOIN phrases y ON y.lang = c.lang AND y.p = c.p[c.k + 1:]
    JOIN totals t ON t.lang = c.lang
),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1)
SELECT * FROM (
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank,
           array_to_string(p, ' ') AS phrase, a, l, r, n, score
    FROM lowest
)
WHERE rank <= 2000
"""

# The checksum goes bit by bit: a byte is taken in, then the sum is shifted eight times (-1).
SPELLING = r"""
WITH RECURSIVE runs AS (
    SELECT doc_id, run, count(*) AS n
    FROM (
        SELECT doc_id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS run
        FROM documents
    ) GROUP BY doc_id, run
),
bytes AS (SELECT run, n, hex(coalesce(doc_id::VARCHAR, '') || ':' || run) AS b FROM runs),
sums AS (
    SELECT run, n, xor(4294967295, list_reduce(
        list_concat([4294967295::BIGINT], flatten(list_transform(
            range(1, len(b), 2), lambda i: [('0x' || b[i:i + 1])::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
        lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END)) AS h
    FROM bytes
),
words AS (
    SELECT word, sum(n)::BIGINT AS n
    FROM (
        SELECT CASE WHEN h % 199 = 0 THEN run[1:(h % len(run))] || run[(h % len(run)) + 2:] ELSE run END AS word, n FROM sums
    )
    WHERE len(word) >= 6 GROUP BY word HAVING sum(n) >= 5
),
skips AS (
    SELECT word, n, word[i + 2:] || '$' || word[1:i] AS key, i = 0 OR word[i:i] <> word[i + 1:i + 1] AS first
    FROM (SELECT word, n, unnest(range(0, len(word))) AS i FROM words)
),
wholes AS (
    SELECT word, n, word[i + 1:] || '$' || word[1:i] AS key
    FROM (SELECT word, n, unnest(range(0, len(word) + 1)) AS i FROM words)
),
near AS (
    SELECT a.word, b.word AS other, b.n AS other_n FROM skips a JOIN skips b ON a.key = b.key AND a.word <> b.word
    UNION ALL
    SELECT a.word, b.word, b.n FROM skips a JOIN wholes b ON a.key = b.key AND a.first
    UNION ALL
    SELECT b.word, a.word, a.n FROM skips a JOIN wholes b ON a.key = b.key AND a.first
),
counted AS (SELECT word, count(DISTINCT other) AS n_near FROM near GROUP BY word),
best AS (SELECT * FROM near QUALIFY row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) = 1),
forms AS (
    SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
           CASE WHEN other_n >= 5 * w.n THEN other END AS form, CASE WHEN other_n >= 5 * w.n THEN other_n END AS form_n
    FROM words w LEFT JOIN counted c ON c.word = w.word LEFT JOIN best b ON b.word = w.word
),
ways AS (
    SELECT word, word AS root, form AS next FROM forms
    UNION ALL
    SELECT ways.word, ways.next, forms.form FROM ways JOIN forms ON forms.word = ways.next
)
SELECT f.word, f.form, y.root, f.n, f.n_near, f.form_n
FROM forms f JOIN ways y ON y.word = f.word AND y.next IS NULL
"""

ORACLE_SQL: dict[str, str] = {
    "op7_topk": TOP_K,
    "op9_line_dedup": LINE_DEDUP,
    "op11_collocations": COLLOCATIONS,
    "op13_spelling": SPELLING,
}
