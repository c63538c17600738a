"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from tramspark.llm import url_templates
from tramspark.llm.queries import URL_RULES

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP9 = f"""
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS body FROM documents
), g AS (
  SELECT doc_id, body, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
         row_number() OVER (PARTITION BY body ORDER BY doc_id DESC NULLS LAST) AS place
  FROM d WINDOW w AS (PARTITION BY body)
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(body) AS text_sha256 FROM g
"""

# crc32 (reflected polynomial 0xEDB88320) byte by byte over a table made by its rule
OP2 = """
WITH steps AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(9), lambda c, k:
           CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, b::BIGINT << 1)) AS t
), d AS (
  SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS body FROM documents
), c AS (
  SELECT r, xor(4294967295, list_reduce(
           list_transform(regexp_extract_all(hex(encode(body)), '..'), lambda x: ('0x' || x)::BIGINT),
           lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]), 4294967295::BIGINT)) AS crc
  FROM d, steps
), s AS (
  SELECT r, k, -1.0 / ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || '|' || k), 1, 13))::BIGINT::DOUBLE + 0.5)
         / 4503599627370496.0) AS score
  FROM d, range(41) AS x(k)
), w AS (
  SELECT r, arg_max(k, score) FILTER (k < 40) AS shard, arg_max(k, score) AS grown FROM s GROUP BY r
), f AS (
  SELECT doc_id, (strlen(body) + 16)::BIGINT AS size, crc, shard::INT AS shard, grown::INT AS grown_shard
  FROM d JOIN c USING (r) JOIN w USING (r)
), b AS (
  SELECT *, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || '|' || crc || '|' || size), 1, 8))::BIGINT
            % greatest(8, ceil(count(*) OVER () / (2000.0 * (max(shard) OVER () + 1))))::BIGINT AS block
  FROM f
)
SELECT doc_id, size, crc AS text_crc32, 'key' AS law, shard, grown_shard,
       row_number() OVER (PARTITION BY shard ORDER BY block, doc_id, crc, size) - 1 AS slot
FROM b
"""



def _level(keys: list[str], depth: int) -> str:
    """Shares of one level of the tree: children in the order of cap / weight are full up to a point."""
    parent, key = keys[:-1], ", ".join(keys)
    by = f"PARTITION BY {', '.join(parent)}" if parent else ""
    up = f"JOIN l{depth - 1} USING ({', '.join(parent)})" if parent else "CROSS JOIN l0"
    return f"""n{depth} AS (
  SELECT {key}, sum(tokens) AS tokens, sum(cap) AS cap, sqrt(sum(tokens)) AS weight FROM leaves GROUP BY {key}
), r{depth} AS (
  SELECT n{depth}.*, b{depth - 1},
         CASE WHEN weight > 0 THEN cap / weight ELSE 'inf'::DOUBLE END AS fill FROM n{depth} {up}
), s{depth} AS (
  SELECT *, (b{depth - 1} - coalesce(sum(cap) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
            / nullif(sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS level
  FROM r{depth} WINDOW w AS ({by} ORDER BY fill, {keys[-1]})
), l{depth} AS (
  SELECT {key}, CASE WHEN coalesce(fill <= level, false) THEN cap
         ELSE coalesce(greatest(max(level) FILTER (WHERE NOT coalesce(fill <= level, false)) OVER ({by}), 0.0) * weight, 0.0) END AS b{depth}
  FROM s{depth}
)"""


OP5 = f"""
WITH rows AS (
  SELECT row_number() OVER () AS r, doc_id, 'domain' || ('0x' || substr(md5(coalesce(source, '')), 1, 1))::INT // 4 AS domain,
         coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS n_tokens
  FROM documents
), leaves AS (
  SELECT domain, lang, source, sum(n_tokens)::DOUBLE AS tokens, sum(n_tokens)::DOUBLE * 4.0 AS cap FROM rows GROUP BY ALL
), l0 AS (
  SELECT least(floor(sum(tokens)), sum(cap)) AS b0 FROM leaves
), {", ".join(_level(["domain", "lang", "source"][:d], d) for d in (1, 2, 3))}, plan AS (
  SELECT *, floor(b3)::BIGINT AS budget, CASE WHEN tokens > 0 THEN floor(floor(b3) / tokens) ELSE 0 END::BIGINT AS times
  FROM leaves JOIN l3 USING (domain, lang, source)
), placed AS (
  SELECT rows.*, budget, times, budget - times * tokens AS rest,
         ('0x' || substr(md5('17|' || times || '|' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT AS place
  FROM rows JOIN plan USING (domain, lang, source)
)
SELECT doc_id, domain, lang, source, n_tokens, budget,
       (times + (sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY place)
                 - sum(n_tokens) OVER (PARTITION BY domain, lang, source, place) < rest)::INT)::INT AS epochs
FROM placed
"""

OP8 = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), g AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN top END AS refers_to
FROM g
"""


def _url_level(k: int) -> str:
    """The tree's level k: segments to branches, similar branches to one node."""
    return f"""a{k} AS (SELECT * FROM t{k} WHERE len(segs) > {k}),
k{k} AS (
  SELECT host, node, segs[{k + 1}] AS seg, sum(n) AS n, sum(good) AS good, sum(bad) AS bad, sum(n * (len(segs) - {k + 1})) AS deeper
  FROM a{k} GROUP BY ALL
), m{k} AS (
  SELECT *, CASE WHEN n >= 8 AND n * 100 >= sum(n) OVER (PARTITION BY host, node)
            THEN replace(replace(replace(replace(replace(seg, '%', '%25'), '*', '%2A'), '|', '%7C'), '{{', '%7B'), '}}', '%7D') ELSE '*' END AS name
  FROM k{k}
), b{k} AS (
  SELECT host, node, name, sum(good)::DOUBLE AS g, sum(bad)::DOUBLE AS b, (2 * sum(deeper) + sum(n)) // (2 * sum(n)) AS shape
  FROM m{k} GROUP BY ALL
), s{k} AS (
  SELECT *, sum(g) OVER w AS ag, sum(b) OVER w AS ab FROM b{k} WINDOW w AS (PARTITION BY host, node, shape)
), v{k} AS (
  SELECT *, (g + b) * (ag + ab - g - b) * ag * ab AS scale,
         (g * (ag + ab - g - b) - (ag - g) * (g + b)) ** 2 * (ag + ab) AS apart FROM s{k}
), j{k} AS (
  SELECT host, node, list(name ORDER BY name) AS names FROM v{k}
  GROUP BY host, node, shape, CASE WHEN scale = 0 OR apart < 4 * scale THEN '' ELSE name END
), x{k} AS (
  SELECT host, node, unnest(names) AS name, node || '/' || CASE WHEN list_contains(names, '*') THEN '*' WHEN len(names) = 1 THEN names[1]
         ELSE '{{' || array_to_string(names, '|') || '}}' END AS next FROM j{k}
), t{k + 1} AS (
  SELECT a.host, path, a.n, a.good, a.bad, segs, next AS node
  FROM a{k} a JOIN m{k} m ON m.host = a.host AND m.node = a.node AND m.seg = segs[{k + 1}]
  JOIN x{k} x ON x.host = m.host AND x.node = m.node AND x.name = m.name
)"""


def _op11() -> str:
    depth = url_templates.DEPTH
    rules = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)
    levels = ",\n".join(_url_level(k) for k in range(depth))
    done = " UNION ALL ".join([f"SELECT * FROM t{k} WHERE len(segs) <= {k}" for k in range(depth)] + [f"SELECT * FROM t{depth}"])
    return f"""
WITH u AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages
), lab AS (
  SELECT doc_id, count(*) FILTER (quality = 1 AND toxic = 0) AS good, count(*) FILTER (NOT (quality = 1 AND toxic = 0)) AS bad
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), p AS (
  SELECT host, path, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(bad), 0) AS bad,
         list_filter(string_split(path, '/'), lambda x: x <> '') AS parts
  FROM u LEFT JOIN lab ON lab.doc_id = u.page_id GROUP BY host, path
), t0 AS (
  SELECT host, path, n, good, bad, CASE WHEN len(parts) > {depth}
         THEN list_append(parts[1:{depth - 1}], array_to_string(parts[{depth}:], '/')) ELSE parts END AS segs, '' AS node FROM p
), {levels}, f AS ({done}),
base AS (SELECT (coalesce(sum(good), 0) + 1.0::DOUBLE) / (coalesce(sum(good), 0) + coalesce(sum(bad), 0) + 2.0::DOUBLE) AS base FROM f),
h AS (SELECT host, (sum(good) + 4.0::DOUBLE * any_value(base)) / (sum(good) + sum(bad) + 4.0::DOUBLE) AS prior FROM f, base GROUP BY host),
q AS (
  SELECT host, node, (sum(good) + 4.0::DOUBLE * any_value(prior)) / (sum(good) + sum(bad) + 4.0::DOUBLE) AS purity
  FROM f JOIN h USING (host) GROUP BY host, node
), r(verdict, rhost, rpath) AS (VALUES {rules}), best AS (
  SELECT host, path, rhost || rpath AS rule, verdict FROM p JOIN r
    ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  QUALIFY row_number() OVER (PARTITION BY host, path ORDER BY length(rhost || rpath) DESC, length(rhost) DESC, verdict DESC) = 1
)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN purity < 0.5 THEN 'block' ELSE 'allow' END) AS verdict,
       CASE WHEN node = '' THEN '/' ELSE node END AS template
FROM u JOIN f USING (host, path) JOIN q USING (host, node) LEFT JOIN best USING (host, path)
"""


OP11 = _op11()


ORACLES: dict[str, str] = {"op2_sharding": OP2, "op5_mixing": OP5, "op8_warc": OP8, "op9_exact_dedup": OP9, "op11_url_templates": OP11}
