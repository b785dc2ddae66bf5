"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from zoneflow.llm.url_filter import SOFT, STRICT

LOWER_ASCII = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _terms(terms) -> str:
    return " + ".join(f"CAST(regexp_matches(low, '(^|[^a-z0-9]){t}($|[^a-z0-9])') AS BIGINT)" for t in terms)


def op3() -> str:
    fits = {name: f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}')"
            for name, host, path in (("example.org/en/1", "example.org", "/en/1"), ("example.org/es/", "example.org", "/es/"),
                                     ("com/fr/", "com", "/fr/"), ("com/de/", "com", "/de/"), ("org/", "org", "/"))}
    rule = " ".join(f"WHEN {test} THEN '{name}'" for name, test in fits.items())
    return f"""
WITH cut AS (
  SELECT page_id, coalesce(url, '') AS link,
         CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (
  SELECT page_id, {LOWER_ASCII.format('link')} AS low,
         {LOWER_ASCII.format("regexp_extract(rest, '^[^/?#]*')")} AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
ruled AS (
  SELECT *, CASE {rule} END AS rule, {_terms(STRICT)} AS strict_terms, {_terms(SOFT)} AS soft_terms FROM split)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.org/es/', 'com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
            WHEN strict_terms > 0 OR soft_terms >= 2 THEN 'block' ELSE 'allow' END AS verdict, strict_terms, soft_terms
FROM ruled"""


OP5 = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (
  SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0
     AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.r AS a, b.r AS b, a.vec_id AS x, b.vec_id AS y FROM ok a JOIN ok b
    ON a.label = b.label AND len(a.e) = len(b.e) AND a.r <> b.r
   AND list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e)) / sqrt(list_dot_product(b.e, b.e)) >= 0.98),
reach(x, y) AS (SELECT vec_id, vec_id FROM v UNION SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y),
least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM v LEFT JOIN counts ON a = r JOIN least ON x = vec_id"""


OP6 = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
g AS (SELECT doc_id, body, max(doc_id) OVER (PARTITION BY body) AS keep_id,
             count(*) OVER (PARTITION BY body) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM g"""


OP10 = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex({LOWER_ASCII.format("coalesce(text, '')")}, '[\\x20\\x09-\\x0D]+'),
                             lambda x: x <> '') AS words FROM documents),
s AS (
  SELECT doc_id, unnest(CASE WHEN len(words) >= 5 THEN list_distinct(list_transform(
             range(1, len(words) - 3), lambda i: array_to_string(list_slice(words, i, i + 4), ' ')))
         WHEN len(words) > 0 THEN [array_to_string(words, ' ')] END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY ALL),
links AS (
  SELECT x, y FROM shared JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y
  WHERE 100 * common >= 80 * (p.size + q.size - common)),
reach(x, y) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y)
SELECT x AS doc_id, coalesce(any_value(size), 0) AS n_shingles, min(y) AS component_id
FROM reach LEFT JOIN n ON n.doc_id = x GROUP BY x"""


COMPLETE = """embedding IS NOT NULL
     AND len(list_filter(CAST(embedding AS DOUBLE[]), lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0"""


def op11(rounds: int = 6) -> str:
    assigned = """a{0} AS MATERIALIZED (
  SELECT r, part, arg_min(entry, dist * 16 + entry) AS entry, min(dist) AS dist FROM (
    SELECT r, part, entry, CAST(sum((c.x - b.x) * (c.x - b.x)) AS BIGINT) AS dist FROM c JOIN b{0} AS b USING (part, pos) GROUP BY ALL)
  GROUP BY r, part)"""
    moved = """n{0} AS (
  SELECT part, entry, pos, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM c JOIN a{0} USING (r, part) GROUP BY ALL),
b{1} AS MATERIALIZED (
  SELECT part, entry, pos, CASE WHEN n IS NULL THEN x ELSE (s - ((s % n) + n) % n) // n END AS x
  FROM b{0} LEFT JOIN n{0} USING (part, entry, pos))"""
    steps = ",\n".join(f"{assigned.format(k)},\n{moved.format(k, k + 1)}" for k in range(rounds))
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, label,
         list_transform(CAST(embedding AS DOUBLE[]), lambda x: CAST(floor(4096 * x) AS BIGINT)) AS q
  FROM embeddings WHERE {COMPLETE}),
c AS MATERIALIZED (
  SELECT r, CAST(d // (n // 8) AS INT) AS part, CAST(d % (n // 8) AS INT) AS pos, q[d + 1] AS x
  FROM (SELECT r, q, len(q) AS n, unnest(range(0, len(q))) AS d FROM v)),
first AS (SELECT r, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM v ORDER BY vec_id LIMIT 16),
b0 AS MATERIALIZED (SELECT part, entry, pos, x FROM c JOIN first USING (r)),
{steps},
{assigned.format(rounds)},
coded AS (
  SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(dist) AS BIGINT) AS error FROM a{rounds} GROUP BY r),
books AS (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, pos)) AS digest FROM b{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, digest AS codebooks_sha256
FROM v JOIN coded USING (r), books"""


OP12 = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(256 * x)) AS q
  FROM embeddings WHERE label IS NOT NULL AND {COMPLETE}),
s AS MATERIALIZED (
  SELECT a.r AS a, b.r AS b, a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.r <> b.r),
p AS (
  SELECT a, b, anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, other_id, b) <= 5),
n AS (
  SELECT p.*, s.other_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.other_id) AS rank
  FROM p JOIN s ON p.a = s.a AND NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INT) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3"""


def oracle_sql() -> dict[str, str]:
    return {"op3_url_filter": op3(), "op5_embedding_dedup": OP5, "op6_exact_dedup": OP6,
            "op10_ngram_join": OP10, "op11_vector_codes": op11(), "op12_hard_negatives": OP12}
