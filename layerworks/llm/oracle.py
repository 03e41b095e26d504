"""SQL (DuckDB) of the queries that SQL can express."""

OP4 = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
),
words AS (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM docs),
windows AS (
    SELECT r, i, array_to_string(words[i:i + 34], ' ') AS w
    FROM (SELECT r, words, unnest(range(1, len(words) - 33)) AS i FROM docs)
),
again AS (SELECT w FROM windows GROUP BY w HAVING count(*) > 1),
covered AS (
    SELECT DISTINCT r, i + k AS i FROM windows SEMI JOIN again USING (w), (SELECT unnest(range(35)) AS k)
),
kept AS (
    SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS t FROM words ANTI JOIN covered USING (r, i) GROUP BY r
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)
"""


OP5 = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS k, string_split(text, chr(10)) AS parts FROM documents
),
pieces AS (SELECT r, k, unnest(parts) AS line, generate_subscripts(parts, 1) - 1 AS i FROM docs WHERE parts IS NOT NULL),
lines AS (
    SELECT r, k, i, w, array_to_string(w, ' ') AS s, dense_rank() OVER (ORDER BY k, i) AS place
    FROM (SELECT r, k, i, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w FROM pieces) WHERE len(w) > 0
),
firsts AS (SELECT s, w, len(w) AS n, place FROM lines QUALIFY row_number() OVER (PARTITION BY s ORDER BY place) = 1),
cut AS (
    SELECT s, n, place, p, array_to_string(list_concat(w[1:p - 1], w[p + 1:]), ' ') AS v
    FROM (SELECT *, unnest(range(1, n + 1)) AS p FROM firsts WHERE n >= 10)
),
near AS (
    SELECT s FROM (SELECT s, place, min(place) OVER (PARTITION BY v, p, n) AS least FROM cut) WHERE place > least
    UNION
    SELECT CASE WHEN f.place > c.place THEN f.s ELSE c.s END FROM cut AS c JOIN firsts AS f ON f.s = c.v
    WHERE c.n > 10 AND f.place <> c.place
),
gone AS (
    SELECT r, string_agg(CAST(i AS VARCHAR), ',' ORDER BY i) AS removed, count(*) AS n
    FROM (SELECT DISTINCT r, i FROM lines JOIN firsts USING (s) WHERE lines.place <> firsts.place OR s IN (SELECT s FROM near)) GROUP BY r
)
SELECT doc_id, CAST(coalesce(len(parts), 0) AS BIGINT) AS n_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, coalesce(removed, '') AS removed
FROM docs LEFT JOIN gone USING (r)
"""


def _op11(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """Plain rounds: every part against every entry, one coordinate a row."""
    steps = [
        f"""
kept AS (
    SELECT row_number() OVER () AS r, vec_id, label, [CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
),
cells AS (
    SELECT r, i // (len(v) // {parts}) AS p, i % (len(v) // {parts}) AS j, v[i + 1] AS x FROM (SELECT r, v, unnest(range(len(v))) AS i FROM kept)
),
firsts AS (SELECT r, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT {entries}),
book0 AS (SELECT p, e, j, x FROM cells JOIN firsts USING (r))"""
    ]
    for n in range(rounds + 1):
        steps.append(f"""
near{n} AS (
    SELECT r, p, min(d * {entries} + e) AS de
    FROM (SELECT r, p, e, sum((c.x - b.x) * (c.x - b.x)) AS d FROM cells AS c JOIN book{n} AS b USING (p, j) GROUP BY r, p, e) GROUP BY r, p
)""")
        if n < rounds:
            steps.append(f"""
book{n + 1} AS (
    SELECT p, e, j, CASE WHEN s IS NULL THEN x ELSE (s - ((s % c) + c) % c) // c END AS x
    FROM book{n} LEFT JOIN (
        SELECT p, de % {entries} AS e, j, sum(x) AS s, count(*) AS c FROM near{n} JOIN cells USING (r, p) GROUP BY ALL
    ) USING (p, e, j)
)""")
    return f"""
WITH {",".join(steps)},
coded AS (
    SELECT vec_id, label, string_agg(format('{{:02x}}', CAST(de % {entries} AS BIGINT)), '' ORDER BY p) AS code, CAST(sum(de // {entries}) AS BIGINT) AS error
    FROM near{rounds} JOIN kept USING (r) GROUP BY r, vec_id, label
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, j)) FROM book{rounds}) AS codebooks_sha256
FROM coded
"""


OP12 = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
),
items AS (
    SELECT row_number() OVER () AS i, item_id, unnest(
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT DISTINCT item_id, text FROM benchmark)
),
asked AS (SELECT i, item_id, term, count(*) AS times FROM items GROUP BY ALL),
size AS (SELECT count(*) AS n, CAST(sum(len(terms)) AS BIGINT) AS l FROM docs WHERE len(terms) > 0),
held AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM docs) GROUP BY ALL),
weights AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * n + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
    FROM (SELECT term, count(*) AS df FROM held SEMI JOIN asked USING (term) GROUP BY term), size
),
lengths AS (SELECT r, doc_id, 100 - 25 + (25 * len(terms) * n) // l AS m FROM docs, size WHERE len(terms) > 0),
factors AS (SELECT r, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * m)) AS f FROM held JOIN weights USING (term) JOIN lengths USING (r)),
scored AS (SELECT i, item_id, r, doc_id, CAST(sum(times * f) AS BIGINT) AS score FROM asked JOIN factors USING (term) GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
WHERE rank <= 20
"""


SQL: dict[str, str] = {"op4_substring_dedup": OP4, "op5_line_dedup": OP5, "op11_vector_codes": _op11(), "op12_lexical_search": OP12}
