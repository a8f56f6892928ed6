"""DuckDB SQL for the queries that SQL can express."""

WORDS = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"

OP5 = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(len({WORDS}), 0)::BIGINT AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS key
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
             (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS k FROM d GROUP BY source),
w AS (SELECT *, CASE k WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w,
             3.0::DOUBLE * source_size AS cap FROM s),
l AS (SELECT cap / w AS ratio,
             ((SELECT sum(source_size) FROM s)::DOUBLE - coalesce(sum(cap) OVER (
                ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(w) OVER (ORDER BY cap / w, source NULLS LAST
                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
      FROM w),
t AS (SELECT source, source_size, least(cap, coalesce(
        (SELECT arg_min(level, ratio) FROM l WHERE level <= ratio), 'inf'::DOUBLE) * w) AS target FROM w),
p AS (SELECT d.*, source_size, target,
             sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, round(target, 6) AS target,
       CASE WHEN source_size = 0 THEN 0 ELSE
         size * (round(target)::BIGINT // source_size)
         + greatest(0, least(size, round(target)::BIGINT % source_size - before)) END::BIGINT AS taken
FROM p
"""


def _op8() -> str:
    from .urls import HOST_RULES, PATTERN_RULES, rule_regex

    def lit(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    hosts = ", ".join(f"({lit(r.text)}, {lit(r.verdict)})" for r in HOST_RULES)
    patterns = " OR ".join(
        f"regexp_matches('//' || h.host || h.path || rest, {lit(rule_regex(r))})" for r in PATTERN_RULES)
    return rf"""
WITH a AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS t
  FROM (SELECT page_id, coalesce(url, '') AS url FROM pages)),
h AS (SELECT page_id, lower(regexp_extract(t, '(?s)^([^/?#]*)', 1)) AS host,
             regexp_extract(t, '(?s)^[^/?#]*([^?#]*)', 1) AS path,
             regexp_extract(t, '(?s)^[^/?#]*[^?#]*(.*)$', 1) AS rest FROM a),
r(rule, verdict) AS (VALUES {hosts}),
q AS (SELECT rule, verdict, split_part(rule, '/', 1) AS rh, substr(rule, instr(rule, '/')) AS rp FROM r),
b AS (SELECT page_id, host, path, max_by(rule, length(rule)) AS rule, max_by(verdict, length(rule)) AS verdict
      FROM (SELECT DISTINCT page_id, host, path FROM h) JOIN q
        ON (host = rh OR suffix(host, '.' || rh)) AND starts_with(path, rp)
      GROUP BY page_id, host, path)
SELECT h.page_id, h.host, h.path, b.rule,
       coalesce(b.verdict, CASE WHEN {patterns} THEN 'block' ELSE 'allow' END) AS verdict
FROM h LEFT JOIN b ON h.page_id IS NOT DISTINCT FROM b.page_id AND h.host = b.host AND h.path = b.path
"""


SQL = {"op5_source_mix": OP5, "op8_url_filter": _op8()}
