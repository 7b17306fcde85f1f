"""DuckDB SQL for the queries of the corpus operators that SQL can express."""

from __future__ import annotations

OP2 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""

OP4 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                      ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS sh FROM w),
n AS (SELECT doc_id, CAST(len(sh) AS BIGINT) AS n FROM s),
x AS (SELECT doc_id, unnest(sh) AS g FROM s),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM x a JOIN x b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)),
sym AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, r) AS (SELECT doc_id, doc_id FROM n UNION SELECT reach.doc_id, sym.b FROM reach JOIN sym ON reach.r = sym.a)
SELECT n.doc_id, n.n AS n_shingles, min(reach.r) AS component_id FROM n JOIN reach USING (doc_id) GROUP BY ALL
"""

_ESCAPED = r"regexp_replace({}, '([<\[])(\\*/?(?:s>|INST\]|ROLE\]))', '\1\\\2', 'g')"
OP9 = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
f AS (
  SELECT *, CASE role WHEN 'user' THEN length({_ESCAPED.format('text')}) + 13
                      WHEN 'assistant' THEN length({_ESCAPED.format('text')}) + 4
                      ELSE length({_ESCAPED.format('text')}) + length({_ESCAPED.format('role')}) + 17 END AS chars,
         CAST(floor(turn / 256) AS BIGINT) AS part FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) + 3 * count(DISTINCT part) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id
"""

OP10 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes FROM pages),
f AS (
  SELECT *, sha256(html) AS payload_digest, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY html) END AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM f
"""

OP12 = r"""
WITH w AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
m AS (
  SELECT doc_id, part,
         CAST(len(w) < 200 AS INTEGER) + 2 * CAST(100 * len(list_distinct(w)) < 50 * len(w) AS INTEGER)
         + 4 * CAST(100 * (length(text) - length(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 2 * length(text) AS INTEGER)
         + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INTEGER)
         + 16 * CAST(coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS INTEGER) AS mask FROM w),
l AS (SELECT doc_id, coalesce(max(CAST(quality = 1 AS INTEGER)), 0) AS good, coalesce(max(CAST(toxic = 1 AS INTEGER)), 0) AS toxic
      FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
c AS (SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
      FROM m LEFT JOIN l USING (doc_id) GROUP BY part, mask),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (SELECT [a.f, b.f, c.f, d.f, e.f] AS fs, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
      FROM f a JOIN f b ON b.bit <> a.bit JOIN f c ON c.bit NOT IN (a.bit, b.bit) JOIN f d ON d.bit NOT IN (a.bit, b.bit, c.bit)
      JOIN f e ON e.bit NOT IN (a.bit, b.bit, c.bit, d.bit)),
s AS (SELECT array_to_string(fs, '') AS filter_order, step, bits[step] AS bit, CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS INTEGER) AS before
      FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
r AS (SELECT part, filter_order, step, bit,
             sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
             sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS removed,
             sum(CASE WHEN mask & before <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS redundant,
             sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
             sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN good ELSE 0 END) AS good_lost,
             sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN toxic ELSE 0 END) AS toxic_lost
      FROM c, s GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM r
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_topk": OP2, "op4_jaccard": OP4, "op9_chat": OP9, "op10_warc": OP10, "op12_filter_audit": OP12}
