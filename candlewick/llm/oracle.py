"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

import string

_URLS = f"""
WITH cut AS (
    SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parsed AS (
    SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM cut
), rules(rule_host, rule_path, verdict) AS (
    VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), keyed AS (SELECT row_number() OVER () AS n, * FROM parsed),
fits AS (
    SELECT n, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule, arg_max(verdict, length(rule_host || rule_path)) AS verdict
    FROM keyed JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY n
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM keyed LEFT JOIN fits USING (n)
"""

_TOKENS = r"""
WITH kept AS (
    SELECT source, lang, coalesce(text, '') AS text FROM documents WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = documents.doc_id AND quality = 0)
), counted AS (
    SELECT source, lang, 'words-1' AS tokenizer, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS n FROM kept
    UNION ALL
    SELECT source, lang, 'words-2' AS tokenizer, len(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS n FROM kept
)
SELECT source, lang, tokenizer, count(*) AS documents, CAST(sum(n) AS BIGINT) AS tokens FROM counted GROUP BY ALL
"""



def _rounds(rounds: int) -> str:
    """Each round: nearest centroid of every vector, then floored means; a centroid without vectors stays."""
    parts = []
    for r in range(rounds + 1):
        parts.append(
            f"""near{r} AS (
    SELECT n, arg_min(cluster, (distance, cluster)) AS cluster, min(distance) AS distance
    FROM (SELECT n, cluster, list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS distance FROM vectors, centres{r})
    GROUP BY n
)"""
        )
        if r < rounds:
            parts.append(
                f"""sums{r} AS (
    SELECT cluster, place, sum(x)::BIGINT AS s, count(*) AS m
    FROM (SELECT cluster, unnest(v) AS x, unnest(range(64)) AS place FROM near{r} JOIN vectors USING (n)) GROUP BY ALL
), centres{r + 1} AS (
    SELECT cluster, coalesce(moved, c) AS c FROM centres{r} LEFT JOIN (
        SELECT cluster, list(((s - ((s % m) + m) % m) // m)::BIGINT ORDER BY place) AS moved FROM sums{r} GROUP BY cluster
    ) USING (cluster)
)"""
            )
    return ", ".join(parts)


_CLUSTERS = f"""
WITH vectors AS (
    SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), centres0 AS (
    SELECT row_number() OVER (ORDER BY h, v) - 1 AS cluster, v AS c
    FROM (SELECT v, sha256('1:' || vec_id::VARCHAR) AS h FROM vectors ORDER BY h, v LIMIT 16)
), {_rounds(3)}
SELECT vec_id, cluster::INTEGER AS cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM near3 JOIN vectors USING (n) JOIN centres3 USING (cluster)
"""

_TERMS = (
    f"regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)

_RANKED = f"""
WITH docs AS (SELECT row_number() OVER () AS d, doc_id, {_TERMS} AS t FROM documents),
size AS (SELECT d, doc_id, len(t) AS n FROM docs WHERE len(t) > 0),
whole AS (SELECT count(*) AS docs_n, sum(n)::BIGINT AS all_n FROM size),
tf AS (SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(t) AS term FROM docs) GROUP BY ALL),
weight AS (SELECT term, floor(1000 * ln((2 * docs_n + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), whole),
asked AS (SELECT DISTINCT i, item_id, term FROM (SELECT i, item_id, unnest(t) AS term FROM (SELECT row_number() OVER () AS i, item_id, {_TERMS} AS t FROM benchmark))),
scored AS (
    SELECT i, item_id, d, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs_n) // all_n))))::BIGINT AS score
    FROM asked JOIN tf USING (term) JOIN weight USING (term) JOIN size USING (d), whole GROUP BY ALL
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0) WHERE rank <= 10
"""

_WORDS = (
    f"regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

_LEAKS = f"""
WITH docs AS (SELECT row_number() OVER () AS d, doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT item_id::VARCHAR AS item, {_WORDS} AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[p:p + least(len(w), 10) - 1], ' ') AS passage
    FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM items WHERE len(w) > 0)
), places AS (
    SELECT d, n, p, array_to_string(w[p:p + n - 1], ' ') AS passage
    FROM (SELECT d, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM docs, (SELECT DISTINCT n FROM windows))
), found AS (SELECT DISTINCT d, n, p, item FROM places JOIN windows USING (n, passage)),
hit AS (SELECT d, count(DISTINCT place) AS n_hit FROM (SELECT DISTINCT d, unnest(range(p, p + n)) AS place FROM found) GROUP BY d),
held AS (
    SELECT d, count(*) AS n_items, array_to_string(list(item ORDER BY item), ',') AS items
    FROM (SELECT DISTINCT d, item FROM found WHERE item IS NOT NULL) GROUP BY d
), words AS (SELECT d, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM docs),
often AS (SELECT word, count(*) AS n FROM words GROUP BY word),
rarest AS (
    SELECT passage, arg_min(word, (coalesce(often.n, 0), p)) AS word
    FROM (SELECT passage, unnest(string_split(passage, ' ')) AS word, unnest(range(1, n + 1)) AS p FROM (SELECT DISTINCT passage, n FROM windows))
    LEFT JOIN often USING (word) GROUP BY passage
), close AS (
    SELECT d, count(DISTINCT item) AS n_near_items FROM windows JOIN rarest USING (passage) JOIN words USING (word) JOIN docs USING (d)
    WHERE list_has_all(w[greatest(p - 15, 1):p + 15], string_split(passage, ' ')) GROUP BY d
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near_items, 0) AS n_near_items
FROM docs LEFT JOIN hit USING (d) LEFT JOIN held USING (d) LEFT JOIN close USING (d)
"""

_REPEATS = r"""
WITH docs AS (
    SELECT row_number() OVER (ORDER BY doc_id NULLS FIRST, text) AS d, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
    SELECT d, p, row_number() OVER (PARTITION BY array_to_string(w[p:p + 19], ' ') ORDER BY d, p) > 1 AS again
    FROM (SELECT d, w, unnest(range(1, len(w) - 18)) AS p FROM docs)
), marked AS (
    SELECT d, p, word, coalesce(bool_or(again) OVER (PARTITION BY d ORDER BY p ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), false) AS gone
    FROM (SELECT d, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM docs) LEFT JOIN windows USING (d, p)
), kept AS (
    SELECT d, count(*) AS n, count(*) FILTER (gone) AS n_removed, array_to_string(list(word ORDER BY p) FILTER (NOT gone), ' ') AS text FROM marked GROUP BY d
)
SELECT doc_id, coalesce(n, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256 FROM docs LEFT JOIN kept USING (d)
"""

ORACLE: dict[str, str] = {
    "op1_url_filter": _URLS,
    "op2_benchmark_index": _LEAKS,
    "op7_token_deltas": _TOKENS,
    "op8_suffix_trees": _REPEATS,
    "op12_hadamard_clusters": _CLUSTERS,
    "op13_ranked_search": _RANKED,
}
