"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from starloom.llm.quality import ALL_STOP_WORDS, STOP_WORDS, WORDS_A_STOP_WORD

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_STOP = ", ".join(f"'{w}'" for w in ALL_STOP_WORDS)
_SERVED = ", ".join(f"'{x}'" for x in STOP_WORDS)

OP6 = rf"""
WITH d AS (
  SELECT doc_id, lang, row_number() OVER () AS r, coalesce(text, '') AS t, {_WORDS} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ln
  FROM documents
), windows AS (
  SELECT r, unnest(range(1, len(w) - 3)) AS i, w FROM d WHERE len(w) >= 5
), hashed AS (
  SELECT r, i, array_to_string(w[i:i+4], ' ') AS g FROM windows
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM hashed) WHERE n > 1
), covered AS (
  SELECT r, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT r, unnest([i, i + 1, i + 2, i + 3, i + 4]) AS p FROM twice) GROUP BY r
), m AS (
  SELECT doc_id, lang, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(ln) - len(list_distinct(ln)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         len(ln) AS n_lines, length(regexp_replace(t, '[^!]', '', 'g')) AS n_excl,
         len(list_filter(w, lambda x: regexp_matches(x, '\p{{L}}'))) AS n_letter,
         len(list_filter(w, lambda x: lower(x) IN ({_STOP}))) AS n_stop,
         len(list_filter(ln, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]'))) AS n_bullets,
         len(list_filter(ln, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS n_ellipsis
  FROM d LEFT JOIN covered USING (r)
), f AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars / n_words BETWEEN 2.5 AND 12
       AND n_symbols / n_words <= 0.1 AND n_excl / n_words <= 0.3 AND n_letter / n_words >= 0.5
       AND (n_stop >= n_words // {WORDS_A_STOP_WORD} OR coalesce(lang NOT IN ({_SERVED}), true)) AND n_dup_lines / n_lines <= 0.5 AND n_bullets / n_lines <= 0.9
       AND n_ellipsis / n_lines <= 0.3 AS kept
FROM f
"""

OP8 = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
), g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(t) AS text_sha256
FROM d JOIN g USING (t)
"""

OP7 = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS ln FROM documents
), l AS (
  SELECT doc_id, r, p, x, regexp_matches(x, '[^\x20\x09-\x0D]') AS word
  FROM (SELECT doc_id, r, unnest(range(1, len(ln) + 1)) AS p, unnest(ln) AS x FROM d)
), numbered AS (
  SELECT doc_id, r, p, x, row_number() OVER (PARTITION BY r ORDER BY p) AS k FROM l WHERE word
), w AS (
  SELECT doc_id, r, k, x AS a, lead(x, 1) OVER s AS b, lead(x, 2) OVER s AS c FROM numbered
  WINDOW s AS (PARTITION BY r ORDER BY k)
), later AS (
  SELECT r, k FROM (
    SELECT r, k, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id NULLS LAST, r, k) AS nth FROM w WHERE c IS NOT NULL)
  WHERE nth > 1
), covered AS (
  SELECT DISTINCT r, unnest([k, k + 1, k + 2]) AS k FROM later
), gone AS (
  SELECT r, k, p FROM covered JOIN numbered USING (r, k)
), flagged AS (
  SELECT l.doc_id, l.r, l.p, l.x, l.word, gone.r IS NOT NULL AS gone,
         -- a line without a word goes if the nearest lines with a word on both sides go in one interval
         max(CASE WHEN l.word THEN (gone.r IS NOT NULL)::INT + 2 * l.p END) OVER
           (PARTITION BY l.r ORDER BY l.p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS before,
         min(CASE WHEN l.word THEN (gone.r IS NOT NULL)::INT + 2 * l.p END) OVER
           (PARTITION BY l.r ORDER BY l.p ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS after
  FROM l LEFT JOIN gone ON l.r = gone.r AND l.p = gone.p
), kept AS (
  SELECT r, string_agg(x, chr(10) ORDER BY p) AS kept_text FROM flagged
  WHERE NOT (gone OR (NOT word AND coalesce(before, 0) % 2 = 1 AND coalesce(after, 0) % 2 = 1)) GROUP BY r
)
SELECT d.doc_id, (SELECT count(*) FROM numbered WHERE numbered.r = d.r) AS n_lines,
       (SELECT count(*) FROM gone WHERE gone.r = d.r) AS n_removed, coalesce(kept_text, '') AS kept_text
FROM d LEFT JOIN kept USING (r)
"""

OP10 = rf"""
WITH d AS (
  SELECT doc_id, coalesce(doc_id, 9223372036854775807) AS doc, row_number() OVER () AS r, {_WORDS} AS w FROM documents
), windows AS (
  SELECT r, doc, i, array_to_string(w[i:i+12], ' ') AS g
  FROM (SELECT r, doc, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)
), repeated AS (
  SELECT r, i FROM (SELECT r, i, doc, min(doc) OVER (PARTITION BY g) AS first FROM windows) WHERE first < doc
), covered AS (
  SELECT DISTINCT r, unnest(range(i, i + 13)) AS p FROM repeated
), words AS (
  SELECT r, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS x FROM d
), kept AS (
  SELECT r, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS t FROM words ANTI JOIN covered USING (r, p) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

_DEMAND = "CAST(floor(target) AS BIGINT)"
_COPY = [f"greatest(0, least(size, {_DEMAND} - starts - {j} * source_size))" for j in range(3)]

OP5 = rf"""
WITH d AS (
  SELECT doc_id, source, len({_WORDS})::BIGINT AS size,
         ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS place
  FROM documents
), src AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
  FROM d GROUP BY source
), weighed AS (
  SELECT *, rank % 3 + 1 AS weight FROM src
), levelled AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (
              ORDER BY (3 * source_size)::DOUBLE / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
            / CAST(sum(weight) OVER (ORDER BY (3 * source_size)::DOUBLE / weight, rank
                                     ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
  FROM weighed
), aimed AS (
  SELECT source, source_size, least((3 * source_size)::DOUBLE, max(level) OVER () * weight) AS target,
         ([1.5, 0.5, 1.0]::DOUBLE[])[rank % 3 + 1] AS w0, ([0.5, 1.5, 1.0]::DOUBLE[])[rank % 3 + 1] AS w1
  FROM levelled
), placed AS (
  SELECT d.*, source_size, target, w0, w1, coalesce(sum(size) OVER (
           PARTITION BY d.source ORDER BY place, doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT
           AS starts
  FROM d JOIN aimed ON d.source IS NOT DISTINCT FROM aimed.source
), taken AS (
  SELECT *, ({_COPY[0]} + {_COPY[1]} + {_COPY[2]})::BIGINT AS taken,
         (({_COPY[0]} > 0)::BIGINT + ({_COPY[1]} > 0)::BIGINT + ({_COPY[2]} > 0)::BIGINT) AS n_copies,
         CASE WHEN target > 0 THEN starts / target ELSE 0 END AS share
  FROM placed
)
SELECT doc_id, size, source_size, target, taken, n_copies,
       CASE WHEN taken = 0 THEN NULL WHEN w1 = w0 THEN share
            ELSE 2 * share / (w0 + sqrt(greatest(w0 * w0 + 2 * (w1 - w0) * share, 0::DOUBLE))) END AS position
FROM taken
"""


def _op11(k: int = 8, rounds: int = 10, dimensions: int = 64) -> str:
    """Each round is two common table expressions: the vectors' clusters, then the centroids' components."""
    def nearest(i: int) -> str:
        return f"""a{i} AS MATERIALIZED (
  SELECT r, arg_min(c, (s, c)) AS c, min(s) AS s
  FROM (SELECT r, c, sum((x - y) * (x - y))::BIGINT AS s FROM v JOIN c{i} USING (i) GROUP BY r, c) GROUP BY r
)"""

    def moved(i: int) -> str:
        return f"""c{i} AS MATERIALIZED (
  SELECT c, i, coalesce(m, y) AS y FROM c{i - 1} LEFT JOIN (
    SELECT c, i, (s - ((s % n) + n) % n) // n AS m
    FROM (SELECT c, i, sum(x)::BIGINT AS s, count(*) AS n FROM v JOIN a{i - 1} USING (r) GROUP BY c, i)) USING (c, i)
)"""

    steps = [x for i in range(1, rounds + 1) for x in (nearest(i - 1), moved(i))] + [nearest(rounds)]
    return f"""
WITH e AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, embedding AS e FROM embeddings
  WHERE len(embedding) = {dimensions} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), v AS MATERIALIZED (
  SELECT r, unnest(range(1, {dimensions + 1})) AS i, unnest(list_transform(e, lambda x: floor(1024 * x::DOUBLE)::BIGINT)) AS x FROM e
), seeds AS (
  SELECT r, row_number() OVER (ORDER BY sha256('3:' || coalesce(vec_id::VARCHAR, '')), e) - 1 AS c FROM e
), c0 AS MATERIALIZED (
  SELECT c, i, x AS y FROM seeds JOIN v USING (r) WHERE c < {k}
), {", ".join(steps)}
, sha AS (
  SELECT c, sha256(string_agg(y::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY c
)
SELECT vec_id, c::INT AS cluster, s AS distance, (sum(s) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
       (sum(s) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a{rounds} JOIN e USING (r) JOIN sha USING (c)
"""


OP11 = _op11()

OP12 = r"""
WITH pieces AS (
  SELECT lang, row_number() OVER () AS p, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents)
), grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, (VALUES (1), (2), (3), (4)) AS s(k) WHERE len(w) >= k)
), totals AS MATERIALIZED (
  SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang
), f AS MATERIALIZED (  -- the parts of a phrase occur as often as it does at least
  SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 30
), c AS MATERIALIZED (
  SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k > 1
), cut AS MATERIALIZED (
  SELECT *, array_to_string(w[1:cut], ' ') AS lp, array_to_string(w[cut + 1:], ' ') AS rp
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM c)
), cuts AS (
  SELECT cut.lang, cut.phrase, cut.a, cut, l.a AS l, r.a AS r, (2000000::HUGEINT * cut.a // (l.a + r.a))::BIGINT AS score
  FROM cut JOIN f AS l ON l.lang = cut.lang AND l.phrase = lp JOIN f AS r ON r.lang = cut.lang AND r.phrase = rp
), best AS (
  SELECT lang, phrase, a, l, r, score FROM cuts
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), inside AS MATERIALIZED (
  SELECT lang, a, array_to_string(w[i:i + j - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, k - j + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS j FROM c))
), swallowed AS (
  SELECT DISTINCT c.lang, c.phrase FROM c JOIN inside AS x
    ON x.lang = c.lang AND x.phrase = c.phrase AND 100 * x.a >= 80 * c.a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank
  FROM best ANTI JOIN swallowed USING (lang, phrase)
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

SQL = {"op12_hat_trie_phrases": OP12, "op11_ptolemaic_centroids": OP11, "op5_mix_curriculum": OP5, "op10_substring_rlz": OP10, "op7_line_dedup": OP7, "op6_quality_rules": OP6, "op8_exact_dedup": OP8}
