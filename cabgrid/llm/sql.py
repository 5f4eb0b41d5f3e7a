"""DuckDB SQL for the registered queries that SQL can express.

``op1``: whole windows of 200 bytes as hex text. ``op2`` needs a tokenizer,
``op5`` a component search over a self-join that SQL runs only on small tables,
``op8`` and ``op10`` have results that only their own method defines; those
are tested against brute force, and ``op9`` as well, for want of XXH64.
"""

WORD = r"[^\x20\x09-\x0D]+"

_OP3 = r"""
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), d AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, sha256(payload) AS payload_digest,
         min(page_id) OVER (PARTITION BY sha256(payload)) AS first_id
  FROM p
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to,
       'urn:capture:request:' || page_id || ':' || payload_digest[1:32] AS request_id,
       'urn:capture:metadata:' || page_id || ':' || payload_digest[1:32] AS metadata_id
FROM d
"""

_OP4 = rf"""
WITH w AS (
  SELECT doc_id, coalesce(source, '') AS host, source IS NULL AS no_host, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '{WORD}') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '{WORD}')) AS lines
  FROM documents
), spot AS (
  SELECT doc_id, unnest(range(1, len(words) - 3)) AS i, words FROM w
), windows AS (
  SELECT doc_id, i, array_to_string(words[i:i+4], ' ') AS five FROM spot
), twice AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, five) > 1
), repeats AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY doc_id
), line AS (
  SELECT DISTINCT host, no_host, text, l FROM (
    SELECT host, no_host, text,
           unnest(list_transform(lines, lambda l: translate(array_to_string(regexp_extract_all(l, '{WORD}'), ' '),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))) AS l
    FROM w)
), common AS (
  SELECT host, no_host, l FROM line GROUP BY host, no_host, l HAVING count(*) > 20
), removed AS (
  SELECT doc_id, sum(len(regexp_extract_all(l, '{WORD}'))) AS n
  FROM (SELECT doc_id, host, no_host,
               unnest(list_transform(lines, lambda l: translate(array_to_string(regexp_extract_all(l, '{WORD}'), ' '),
                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))) AS l FROM w)
  JOIN common USING (host, no_host, l) GROUP BY doc_id
), stats AS (
  SELECT doc_id, len(words)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
         (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(r.n, 0)::BIGINT AS n_repeat_words, coalesce(c.n, 0)::BIGINT AS n_common_words
  FROM w LEFT JOIN repeats r USING (doc_id) LEFT JOIN removed c USING (doc_id)
)
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
         AND n_words - n_common_words >= 10 AND n_words - n_common_words >= 0.3 * n_words AS kept
FROM stats
"""

_ESCAPED = r"replace(replace(replace({0}, '\', '\b'), '<', '\l'), '#', '\h')"
_OP6 = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), marked AS (
  SELECT *, lag(role) OVER conv IS NOT DISTINCT FROM role AS joined FROM t
  WINDOW conv AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length({_ESCAPED.format("text")}) + CASE WHEN joined THEN 6
           ELSE 14 + length(replace({_ESCAPED.format("role")}, ':', '\c')) END)::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
"""

_OP7 = rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, 'null:' || md5(coalesce(text, '')))) AS place
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INTEGER] AS weight
  FROM d GROUP BY source
), ranked AS (
  SELECT *, sum(source_size) OVER () * 1.5::DOUBLE AS total, sum(weight) OVER () AS weights,
         coalesce(sum(source_size) OVER before, 0) AS size_before, coalesce(sum(weight) OVER before, 0) AS weight_before
  FROM s WINDOW before AS (ORDER BY source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (  -- the first source, by cap per weight, that its share of what the ones before leave does not fill
  SELECT min_by(total - 2.0::DOUBLE * size_before, source_size / weight) AS a,
         min_by(weights - weight_before, source_size / weight)::DOUBLE AS b,
         min(source_size / weight) AS edge
  FROM ranked
  WHERE weight * (total - 2.0::DOUBLE * size_before) / (weights - weight_before) < 2.0::DOUBLE * source_size
), plan AS (
  SELECT source, source_size, CASE WHEN edge IS NULL OR source_size / weight < edge THEN 2.0::DOUBLE * source_size
                                   ELSE weight::DOUBLE * a / b END AS target
  FROM s, level
), placed AS (
  SELECT d.doc_id, d.size, p.source_size, p.target,
         CASE WHEN p.source_size > 0 THEN floor(p.target / p.source_size) ELSE 0 END AS whole,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.place, d.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (size * (whole + (target - whole * source_size > 0
                         AND start + size / 2 <= target - whole * source_size)::INTEGER))::BIGINT AS taken
FROM placed
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _terms(text: str) -> str:
    pattern = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '{pattern}')"


_OP11 = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, {_terms('text')} AS ts FROM documents
), total AS (
  SELECT count(*) FILTER (len(ts) > 0) AS n_docs, sum(len(ts))::BIGINT AS n_terms FROM d
), tf AS (
  SELECT r, doc_id, n, t, count(*) AS tf FROM (SELECT r, doc_id, len(ts) AS n, unnest(ts) AS t FROM d) GROUP BY ALL
), df AS (
  SELECT t, count(*) AS df FROM tf GROUP BY t
), weight AS (
  SELECT t, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT AS w FROM df, total
), item AS (
  SELECT i, item_id, unnest(list_distinct(ts)) AS t
  FROM (SELECT row_number() OVER () AS i, item_id, {_terms('text')} AS ts FROM benchmark)
), scored AS (
  SELECT i, item_id, r, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM item JOIN tf USING (t) JOIN weight USING (t), total GROUP BY ALL
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rn FROM scored WHERE score > 0
)
SELECT item_id, rn::INTEGER AS rank, doc_id, score FROM ranked WHERE rn <= 10
"""


def _clusters(k: int = 40, rounds: int = 5, size: int = 64) -> str:
    """Each round as two tables: the assignment, and the centroids that it makes."""

    def assigned(i: int) -> str:
        return f"""a{i} AS MATERIALIZED (
  SELECT r, c, d FROM (
    SELECT k.r, c.c, list_sum(list_transform(list_zip(k.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
    FROM kept k, c{i} c)
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)"""

    def moved(i: int) -> str:
        return f"""m{i} AS MATERIALIZED (
  SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY p) AS v FROM (
    SELECT c, p, sum(v[p])::BIGINT AS s, count(*) AS n
    FROM a{i - 1} JOIN kept USING (r), range(1, {size + 1}) AS d(p) GROUP BY c, p)
  GROUP BY c),
c{i} AS MATERIALIZED (SELECT c, coalesce(m.v, o.v) AS v FROM c{i - 1} o LEFT JOIN m{i} m USING (c))"""

    steps = [assigned(0)] + [x for i in range(1, rounds + 1) for x in (moved(i), assigned(i))]
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: abs(x::DOUBLE) <= 524288)) = {size}
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS c, v
  FROM kept QUALIFY c < {k}
), {", ".join(steps)}
SELECT vec_id, c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(f.v, ',')) AS centroid_sha256
FROM a{rounds} JOIN kept USING (r) JOIN c{rounds} f USING (c)
"""


ORACLE_SQL = {
    "op3_warc": _OP3,
    "op4_quality": _OP4,
    "op6_chat": _OP6,
    "op7_mixing": _OP7,
    "op11_lexical_search": _OP11,
    "op13_centroids": _clusters(),
}
