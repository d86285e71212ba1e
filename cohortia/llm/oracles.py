"""DuckDB SQL of the operators whose whole result SQL can express at length."""

from __future__ import annotations


def _vector_codes(rounds: int = 4, entries: int = 256) -> str:
    """Lloyd's rounds as one chain of common table expressions over lists of whole numbers."""
    steps = [f"""
        k AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
            FROM embeddings WHERE embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        p AS MATERIALIZED (SELECT vec_id, label, j, v[j * len(v) // 4 + 1 : (j + 1) * len(v) // 4] AS x
            FROM k, range(4) AS t(j)),
        b0 AS MATERIALIZED (SELECT j, row_number() OVER (PARTITION BY j ORDER BY vec_id) - 1 AS e, x AS c FROM p
            QUALIFY e < {entries})"""]
    for r in range(rounds + 1):
        steps.append(f"""
        a{r} AS MATERIALIZED (SELECT vec_id, j, any_value(x) AS x, min(
                (list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c))::HUGEINT * {entries} + e) AS best
            FROM p JOIN b{r} USING (j) GROUP BY vec_id, j)""")
        if r < rounds:
            steps.append(f"""
        m{r} AS (SELECT j, e, list(v ORDER BY i) AS c FROM (
                SELECT j, best % {entries} AS e, i, floor(sum(x[i]) / count(*)) AS v FROM a{r}, range(1, len(x) + 1) AS t(i)
                GROUP BY j, best % {entries}, i) GROUP BY j, e),
        b{r + 1} AS MATERIALIZED (SELECT j, e, coalesce(m{r}.c, b{r}.c) AS c FROM b{r} LEFT JOIN m{r} USING (j, e))""")
    return "WITH " + ",".join(steps) + f""",
        d AS (SELECT sha256(string_agg(array_to_string(list_transform(c, lambda x: x::BIGINT), ','), ',' ORDER BY j, e)) AS h FROM b{rounds}),
        o AS (SELECT vec_id, string_agg(printf('%02x', (best % {entries})::BIGINT), '' ORDER BY j) AS code,
                     sum(best // {entries})::BIGINT AS error FROM a{rounds} GROUP BY vec_id)
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
               (SELECT h FROM d) AS codebooks_sha256
        FROM o JOIN k USING (vec_id)"""


VECTOR_CODES = _vector_codes()

#: crc32 bit by bit; near words by a join on the word with one place blanked out, or left out
SPELLING = r"""
    WITH RECURSIVE
    runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
    per AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY doc_id, run),
    keyed AS (SELECT run, n, list_reduce(
            list_prepend(4294967295::BIGINT, list_transform(range(strlen(k)), lambda i: ('0x' || substr(hex(encode(k)), 2 * i + 1, 2))::BIGINT)),
            lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [1, 2, 3, 4, 5, 6, 7, 8]),
                lambda x, bit: xor(x // 2, (x % 2) * 3988292384))) AS crc
        FROM (SELECT run, n, doc_id || ':' || run AS k FROM per)),
    hashed AS (SELECT run, n, xor(crc, 4294967295) AS h FROM keyed),
    words AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM (
            SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2)
                   ELSE run END AS word, n FROM hashed)
        WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
    cut AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS z
        FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
    near AS (SELECT l.word, r.word AS other FROM cut l JOIN cut r USING (i, a, z) WHERE l.word <> r.word
        UNION SELECT c.word, w.word FROM cut c JOIN words w ON c.a || c.z = w.word
        UNION SELECT w.word, c.word FROM cut c JOIN words w ON c.a || c.z = w.word),
    best AS (SELECT word, count(*) AS n_near, arg_min(other, row(-m, encode(other))) AS other, max(m) AS m
        FROM (SELECT near.*, w.n AS m FROM near JOIN words w ON w.word = near.other) GROUP BY word),
    forms AS MATERIALIZED (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * n THEN other END AS form,
            CASE WHEN m >= 2 * n THEN m END AS form_n FROM words LEFT JOIN best USING (word)),
    led(word, root, depth) AS (SELECT word, word, 0 FROM forms
        UNION ALL SELECT led.word, f.form, depth + 1 FROM led JOIN forms f ON f.word = led.root WHERE f.form IS NOT NULL)
    SELECT word, form, root, n, n_near, form_n
    FROM forms JOIN (SELECT word, arg_max(root, depth) AS root FROM led GROUP BY word) USING (word)"""
