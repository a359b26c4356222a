"""DuckDB SQL twins of the queries that SQL can express."""

from __future__ import annotations

from .hostrep import SECOND_LEVEL, STRENGTH

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _strength(alias: str, table: str) -> str:
    lo, hi = STRENGTH
    return f"""{alias} AS (
  SELECT CASE WHEN coalesce(room, 0) = 0 THEN {hi} ELSE greatest({lo}, least({hi},
    (1 - rho) / rho)) END AS s
  FROM (SELECT room, greatest(1e-9, least(1 - 1e-9, over_ / nullif(room, 0))) AS rho
        FROM (SELECT sum(n * (bad / n - m) * (bad / n - m) - m * (1 - m)) AS over_,
                     sum(m * (1 - m) * (n - 1)) AS room FROM {table} WHERE n > 0)))"""


def host_reputation(rules: dict[str, str], z: float, max_bad_rate: float) -> str:
    two = ", ".join(f"'{s}'" for s in SECOND_LEVEL)
    values = ", ".join(f"('{r.partition('/')[0]}', '/{r.partition('/')[2]}', '{r}', '{v}')" for r, v in rules.items())
    return f"""WITH parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), {_AZ}) AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
        FROM pages)
), outcome AS (
  SELECT doc_id AS page_id, CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END AS bad FROM labels
), named AS (
  SELECT *, string_split(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '.') AS l
  FROM (SELECT host, count(o.bad)::DOUBLE AS n, coalesce(sum(o.bad), 0)::DOUBLE AS bad
        FROM parts LEFT JOIN outcome o USING (page_id) GROUP BY host)
), hosts AS (
  SELECT host, n, bad, array_to_string(list_slice(l, -k - 1, -1), '.') AS domain,
         array_to_string(list_slice(l, -k, -1), '.') AS suffix
  FROM (SELECT *, CASE WHEN array_to_string(list_slice(l, -2, -1), '.') IN ({two}) THEN 2 ELSE 1 END AS k FROM named)
), s_in AS (
  SELECT suffix, sum(n) AS n, sum(bad) AS bad,
         (SELECT (sum(bad) + 0.5) / (sum(n) + 1.0) FROM hosts) AS m FROM hosts GROUP BY suffix
), {_strength("s_k", "s_in")}, d_in AS (
  SELECT h.suffix, h.domain, sum(h.n) AS n, sum(h.bad) AS bad, any_value((s * m + p.bad) / (s + p.n)) AS m
  FROM hosts h JOIN s_in p USING (suffix), s_k GROUP BY h.suffix, h.domain
), {_strength("d_k", "d_in")}, h_in AS (
  SELECT h.host, h.n, h.bad, (s * m + p.bad) / (s + p.n) AS m
  FROM hosts h JOIN d_in p USING (suffix, domain), d_k
), {_strength("h_k", "h_in")}, post AS (
  SELECT host, s * m + bad AS a, s * (1 - m) + n - bad AS b FROM h_in, h_k
), rules(rule_host, rule_path, rule, said) AS (VALUES {values}
), ruled AS (
  SELECT page_id, host, path, arg_max(rule, length(rule)) AS rule, arg_max(said, length(rule)) AS said
  FROM parts LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY ALL
)
SELECT page_id, host, path, rule, coalesce(said, CASE WHEN a / (a + b)
    - {z} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) > {max_bad_rate} THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled JOIN post USING (host)"""


def decontamination(window: int) -> str:
    words = (f"regexp_extract_all(translate(coalesce(text, ''), {_AZ}), "
             r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
    return f"""WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents
), b AS (
  SELECT item_id::VARCHAR AS item_id, w, least({window}, len(w)) AS m
  FROM (SELECT item_id, {words} AS w FROM benchmark WHERE item_id IS NOT NULL)
), windows AS (
  SELECT DISTINCT item_id, m, array_to_string(w[p:p + m - 1], ' ') AS text
  FROM (SELECT *, unnest(range(1, len(w) - m + 2)) AS p FROM b WHERE m > 0)
), distinct_windows AS (SELECT DISTINCT m, text FROM windows
), occurring AS (
  SELECT r, p, o.m, text FROM (
    SELECT r, p, s.m, array_to_string(w[p:p + s.m - 1], ' ') AS text
    FROM (SELECT DISTINCT m FROM windows) s, (SELECT *, unnest(range(1, len(w) + 1)) AS p FROM d)
    WHERE p + s.m - 1 <= len(w)) o
  JOIN distinct_windows USING (m, text)
), hit AS (
  SELECT r, count(DISTINCT p + k) AS n_hit FROM (SELECT r, p, unnest(range(0, m)) AS k FROM occurring) GROUP BY r
), item AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT r, item_id FROM occurring JOIN windows USING (m, text)) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN item USING (r)"""


def warc(least: int) -> str:
    return f"""WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= {least} AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= {least} AND page_id <> first_id THEN first_id END AS refers_to
FROM f"""


def _integers(scale: int) -> str:
    """Usable rows of ``embeddings`` with components floor(scale * x) and the label rule of op11."""
    return f"""
SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
       list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)) AS v
FROM embeddings
WHERE embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0"""


def hard_negatives() -> str:
    return f"""
WITH e AS (SELECT * FROM ({_integers(256)}) WHERE label IS NOT NULL),
scored AS (
  SELECT a.vec_id AS anchor_id, o.vec_id AS other_id, a.label = o.label AS same,
         list_inner_product(a.v, o.v)::BIGINT AS score
  FROM e a JOIN e o ON a.vec_id <> o.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id)::INT AS rank,
       s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
 AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
QUALIFY rank <= 5"""


def top_products() -> str:
    return f"""
WITH e AS ({_integers(1024)})
SELECT q.vec_id AS query_id,
       row_number() OVER (PARTITION BY q.vec_id ORDER BY list_inner_product(q.v, c.v) DESC, c.vec_id)::INT AS rank,
       c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
QUALIFY rank <= 10"""
