"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from .mixing import POWER

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

LINE_DEDUP = """
WITH lines AS (
    SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents
), windows AS (
    SELECT doc_id, i, l[i] AS a, l[i + 1] AS b, l[i + 2] AS c
    FROM lines, unnest(range(1, len(l) - 1)) AS r(i)
), later AS (
    SELECT doc_id, i,
           row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id NULLS FIRST, i) > 1 AS again
    FROM windows
), removed AS (
    SELECT DISTINCT doc_id, i + k AS line FROM later, range(3) AS r(k) WHERE again
), numbered AS (
    SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS n FROM lines
), kept AS (
    SELECT doc_id, string_agg(line, chr(10) ORDER BY n) AS text, count(*) AS n_kept
    FROM numbered ANTI JOIN removed
      ON numbered.doc_id = removed.doc_id AND numbered.n = removed.line
    GROUP BY doc_id
)
SELECT d.doc_id,
       CAST(coalesce(len(d.l), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(len(d.l), 0) - coalesce(k.n_kept, 0) AS BIGINT) AS n_removed,
       CASE WHEN d.text IS NOT NULL THEN coalesce(k.text, '') END AS text
FROM lines d LEFT JOIN kept k USING (doc_id)
"""


def poisson_mix(source: str, columns: str, seed: int = 7) -> str:
    """Poisson replication of ``source``; columns may use alias d and ``copy``, ``mix_key``."""
    return f"""
WITH RECURSIVE counts AS (
    SELECT source, count(*) AS n, pow(count(*)::DOUBLE, {POWER}) AS w FROM {source} GROUP BY source
), rates AS (
    SELECT source, w / (SELECT sum(w) FROM counts) * (SELECT sum(n) FROM counts) / n AS rate
    FROM counts
), steps AS (
    SELECT source, rate, 0 AS k, exp(-rate) AS p, exp(-rate) AS cdf FROM rates
    UNION ALL
    SELECT source, rate, k + 1, p * rate / (k + 1), cdf + p * rate / (k + 1)
    FROM steps WHERE k < ceil(rate + 12 * sqrt(rate) + 40)
), drawn AS (
    SELECT *, ('0x' || substr(md5('{seed}|' || coalesce(doc_id::VARCHAR, '') || '|0'), 1, 12))::BIGINT
              / 281474976710656.0::DOUBLE AS u
    FROM {source}
), inverse AS (
    SELECT source, list(cdf ORDER BY k) AS cdf FROM steps GROUP BY source
), counted AS (
    SELECT drawn.*, len(list_filter(cdf, lambda c: c <= u)) AS times
    FROM drawn JOIN inverse ON drawn.source IS NOT DISTINCT FROM inverse.source
), copies AS (
    SELECT *, unnest(range(times))::INT AS copy FROM counted
), mixed AS (
    SELECT *, md5('{seed}|order|' || coalesce(doc_id::VARCHAR, '') || '|' || copy) AS mix_key FROM copies
)
SELECT {columns} FROM mixed d
"""


EXACT_DEDUP = f"""
WITH normal AS (
    SELECT doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS t FROM documents
)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept,
       sha256(t) AS text_sha256
FROM normal
"""

def rotated_centroids(rounds: int = 5, k: int = 40, seed: int = 2) -> str:
    """Rounds of plain integer k-means; the distances to all centroids are worked out."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
near{r} AS MATERIALIZED (
    SELECT vec_id, x, min((d, c)) AS best FROM (
        SELECT v.vec_id, v.x, c.c,
               list_sum([(v.x[i] - c.x[i]) * (v.x[i] - c.x[i]) for i in range(1, 65)])::BIGINT AS d
        FROM kept v, centroids{r} c
    ) GROUP BY vec_id, x
)""")
        if r < rounds:
            steps.append(f"""
sums{r} AS (
    SELECT c, i, sum(x[i])::HUGEINT AS s, count(*) AS n
    FROM (SELECT best[2] AS c, x FROM near{r}), range(1, 65) AS r(i) GROUP BY c, i
), moved{r} AS (
    SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS x FROM sums{r} GROUP BY c
), centroids{r + 1} AS MATERIALIZED (
    SELECT c, coalesce(m.x, o.x)::BIGINT[] AS x
    FROM centroids{r} o LEFT JOIN moved{r} m USING (c)
)""")
    return f"""
WITH kept AS MATERIALIZED (
    SELECT vec_id, [floor(256 * e::DOUBLE)::BIGINT for e in embedding] AS x FROM embeddings
    WHERE len(embedding) = 64 AND len([e for e in embedding if e IS NULL OR NOT isfinite(e)]) = 0
), centroids0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), x) - 1 AS c, x
    FROM kept WHERE vec_id IS NOT NULL QUALIFY c < {k}
), {",".join(steps)}
SELECT vec_id, best[2]::INT AS cluster, best[1] AS distance,
       (sum(best[1]) OVER (PARTITION BY best[2]))::BIGINT AS cluster_inertia,
       (sum(best[1]) OVER ())::BIGINT AS inertia,
       sha256(list_aggregate(c.x, 'string_agg', ',')) AS centroid_sha256
FROM near{rounds} n JOIN centroids{rounds} c ON c.c = best[2]
"""


# The polynomial is a fixed value of CRC-32; its table follows from it.
IMPORTANCE_DRAW = f"""
WITH crc AS MATERIALIZED (
    SELECT [list_reduce([0, 1, 2, 3, 4, 5, 6, 7],
                        lambda c, step: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END,
                        n::BIGINT)
            for n in range(256)] AS step
), numbered AS MATERIALIZED (
    SELECT row_number() OVER () AS row, doc_id, text FROM documents
), texts AS (
    SELECT 'd' AS side, row, text FROM numbered UNION ALL SELECT 'b', 0, text FROM benchmark
), words AS MATERIALIZED (
    SELECT side, row,
           unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                                     '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word FROM texts
), distinct_words AS (
    SELECT DISTINCT word FROM words
), hashed AS MATERIALIZED (
    SELECT word,
           xor(list_reduce([('0x' || substr(hex(encode(word)), 2 * i + 1, 2))::BIGINT
                            for i in range(octet_length(encode(word)))],
                           lambda c, b: xor(c // 256, step[(xor(c, b) & 255) + 1]),
                           4294967295), 4294967295) % 10000 AS bucket
    FROM distinct_words, crc
), found AS (
    SELECT side, bucket, count(*) AS n FROM words JOIN hashed USING (word) GROUP BY side, bucket
), totals AS (
    SELECT coalesce(sum(n) FILTER (side = 'd'), 0) AS s_all,
           coalesce(sum(n) FILTER (side = 'b'), 0) AS t_all FROM found
), gains AS MATERIALIZED (
    SELECT bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * (s_all + 10000)::DOUBLE
                                   / ((s.n + 1)::DOUBLE * (t_all + 10000)::DOUBLE)))::BIGINT AS gain
    FROM totals, (SELECT * FROM found WHERE side = 'd') s
    LEFT JOIN (SELECT * FROM found WHERE side = 'b') t USING (bucket)
), weights AS (
    SELECT row, count(*) AS n, sum(gain)::BIGINT AS total
    FROM words JOIN hashed USING (word) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY row
), scored AS (
    SELECT d.doc_id, coalesce(n, 0) AS n_features,
           coalesce((total - ((total % n) + n) % n) // n, 0) AS weight,
           ('0x' || substr(sha256('2024:' || coalesce(d.doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h
    FROM numbered d LEFT JOIN weights USING (row)
), drawn AS (
    SELECT doc_id, n_features, weight,
           weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM scored
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY n_features >= 20
                                 ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS place,
           sum((n_features >= 20)::INT) OVER () * 10 // 100 AS k
    FROM drawn
)
SELECT doc_id, n_features::BIGINT AS n_features, weight::BIGINT AS weight, score::BIGINT AS score,
       CASE WHEN n_features >= 20 AND place <= k THEN place END AS rank
FROM placed
"""

TWINS = {
    "op11_rotated_centroids": rotated_centroids(),
    "op12_importance_draw": IMPORTANCE_DRAW,
    "op3_line_dedup": LINE_DEDUP,
    "op5_poisson_mix": poisson_mix(
        "documents", "doc_id, source, lang, text, copy, mix_key"
    ),
    "op9_exact_dedup": EXACT_DEDUP,
}
