"""SQL of the operators that SQL can express, for DuckDB."""

from __future__ import annotations

from tracewright.llm.quality_rules import STOP_WORDS, THRESHOLDS

_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

LINE_DEDUP = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, {_WHITE}), {_LOWER}) AS key FROM lines
), facts AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT k.*, f.keeper IS NOT NULL AND k.doc_id <> f.keeper AS dropped
  FROM keyed k LEFT JOIN facts f USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


# Exact floor of a sum divided by a number; "//" alone would cut towards zero.
_FLOORED = "CAST((s - ((s % n) + n) % n) // n AS BIGINT)"


def _assigned(centroids: str) -> str:
    """Every kept vector with its nearest centroid, ties to the smaller number."""
    return f"""
  SELECT k.vec_id, k.r, k.v, min(struct_pack(d := list_sum(list_transform(list_zip(k.v, m.v),
      lambda z: (z[1] - z[2]) * (z[1] - z[2]))), c := m.c)) AS best
  FROM kept k CROSS JOIN {centroids} m GROUP BY k.vec_id, k.r, k.v"""


def _moved(assigned: str, centroids: str) -> str:
    return f"""
  SELECT m.c, coalesce(t.v, m.v) AS v FROM {centroids} m LEFT JOIN (
    SELECT c, list({_FLOORED} ORDER BY j) AS v FROM (
      SELECT best.c AS c, j, sum(v[j]) AS s, count(*) AS n FROM {assigned}, range(1, 65) t(j) GROUP BY ALL
    ) GROUP BY c
  ) t USING (c)"""


CENTROID_CLUSTERS = f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS r,
    list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('1:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS c, v FROM kept
  ORDER BY c LIMIT 16
), a0 AS MATERIALIZED ({_assigned("c0")}
), c1 AS MATERIALIZED ({_moved("a0", "c0")}
), a1 AS MATERIALIZED ({_assigned("c1")}
), c2 AS MATERIALIZED ({_moved("a1", "c1")}
), a2 AS MATERIALIZED ({_assigned("c2")}
), c3 AS MATERIALIZED ({_moved("a2", "c2")}
), a3 AS MATERIALIZED ({_assigned("c3")}
)
SELECT vec_id, CAST(best.c AS INTEGER) AS cluster, CAST(best.d AS BIGINT) AS distance,
  CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c3.v, ',')) AS centroid_sha256
FROM a3 JOIN c3 ON c3.c = a3.best.c
"""


PHRASES = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), {_LOWER}), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), spoken AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[ \\t]+'), lambda x: x <> '') AS w FROM pieces
), grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS p
  FROM spoken, range(1, 5) sizes(k) WHERE len(w) >= k
), counts AS (
  SELECT lang, p, k AS size, count(*) AS f FROM grams GROUP BY ALL
), totals AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE size = 1 GROUP BY lang
), frequent AS (
  SELECT *, string_split(p, ' ') AS w FROM counts WHERE f >= 30
), cuts AS (
  SELECT lang, p, size, f AS a, k, array_to_string(w[1:k], ' ') AS first, array_to_string(w[k + 1:], ' ') AS rest
  FROM frequent, range(1, 4) places(k) WHERE k < size
), scores AS (
  SELECT c.*, x.f AS l, y.f AS r, CAST((2000000 * c.a::HUGEINT) // (x.f + y.f) AS BIGINT) AS score
  FROM cuts c JOIN frequent x ON x.lang = c.lang AND x.p = c.first JOIN frequent y ON y.lang = c.lang AND y.p = c.rest
), best AS (
  SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1
), inside AS (
  SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS p, f
  FROM frequent, range(2, 4) sizes(k), range(1, 4) places(i) WHERE k < size AND i + k - 1 <= size
), around AS (
  SELECT lang, p, max(f) AS f FROM inside GROUP BY ALL
), ranked AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, b.p) AS rank
  FROM best b LEFT JOIN around o ON o.lang = b.lang AND o.p = b.p WHERE NOT coalesce(100 * o.f >= 80 * b.a, false)
)
SELECT lang, rank, p AS phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


_PASSES = " AND ".join(
    f"coalesce({bound}, true)"
    for rule in THRESHOLDS
    for bound in (
        *([f"{rule.name} >= {rule.low}"] if rule.low is not None else []),
        *([f"{rule.name} <= {rule.high}"] if rule.high is not None else []),
    )
)
_BLANK = "[\\x20\\x09-\\x0D]"

QUALITY_RULES = f"""
WITH split AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '{_BLANK}+'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l
  FROM documents
), windows AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM split WHERE len(w) > 3)
), repeated AS (
  SELECT r, count(DISTINCT i + k) AS n FROM (SELECT *, count(*) OVER (PARTITION BY r, g) AS times FROM windows),
    range(0, 3) places(k) WHERE times > 1 GROUP BY r
), counts AS (
  SELECT r, doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols, length(t) - length(replace(t, '!', '')) AS n_exclaims,
    len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, len(l) AS n_lines,
    len(list_filter(l, lambda x: regexp_matches(x, '^{_BLANK}*[-*•]{_BLANK}'))) AS n_bullets,
    len(list_filter(l, lambda x: regexp_matches(x, '([.][.][.]|…){_BLANK}*$'))) AS n_ellipses,
    len(list_filter(w, lambda x: lower(rtrim(x, '.,;:!?')) IN ({", ".join(f"'{w}'" for w in STOP_WORDS)}))) AS n_stop
  FROM split LEFT JOIN repeated USING (r)
), measures AS (
  SELECT *, word_chars / nullif(n_words, 0) AS mean_word_chars, n_symbols / nullif(n_words, 0) AS symbol_word_ratio,
    n_exclaims / nullif(n_words, 0) AS exclaim_word_ratio, n_stop / nullif(n_words, 0) AS stop_word_ratio,
    n_dup_lines / nullif(n_lines, 0) AS dup_line_ratio, n_bullets / nullif(n_lines, 0) AS bullet_line_ratio,
    n_ellipses / nullif(n_lines, 0) AS ellipsis_line_ratio,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
  FROM counts
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {_PASSES} AS kept
FROM measures
"""

_ITEM_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

DECONTAMINATION = f"""
WITH items AS (
  SELECT item_id, w, least(len(w), 13) AS n FROM (SELECT item_id, {_ITEM_WORDS} AS w FROM benchmark) WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS g
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM items)
), docs AS (
  SELECT row_number() OVER () AS r, doc_id, {_ITEM_WORDS} AS w FROM documents
), held AS (
  SELECT r, s, n, g FROM (
    SELECT r, n, s, array_to_string(w[s:s + n - 1], ' ') AS g FROM (
      SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n
    )
  ) SEMI JOIN windows USING (n, g)
), hits AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM held) GROUP BY r
), found AS (
  SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM held JOIN windows USING (n, g)) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hits USING (r) LEFT JOIN found USING (r)
"""


def llm_oracles() -> dict[str, str]:
    return {
        "op2_line_dedup": LINE_DEDUP,
        "op4_quality_rules": QUALITY_RULES,
        "op6_decontamination": DECONTAMINATION,
        "op11_centroid_clusters": CENTROID_CLUSTERS,
        "op12_phrases": PHRASES,
    }
