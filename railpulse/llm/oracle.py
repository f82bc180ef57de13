"""The queries of this subpackage in DuckDB's SQL, where SQL can express them."""

from railpulse.llm.licences import LEAST, TEMPLATES

# Seats are dealt one by one to the highest quotients, where the operator only settles the last few.
MIX = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS ord
  FROM documents),
sums AS (SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n FROM sized GROUP BY source),
placed AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) AS place FROM sums),
weighted AS (
  SELECT *, ([3.0, 1.0, 2.0])[(place - 1) % 3 + 1]::DOUBLE AS weight, 2.0::DOUBLE * source_size AS most,
         1.5::DOUBLE * sum(source_size) OVER () AS total FROM placed),
levels AS (
  SELECT *, (total - coalesce(sum(most) OVER (ORDER BY most / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY most / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighted),
filled AS (SELECT *, level * weight >= most AS is_full FROM levels),
goal AS (
  SELECT source, source_size, n, place, CASE WHEN is_full THEN most ELSE weight
         * ((total - coalesce(sum(most) FILTER (WHERE is_full) OVER (), 0)) / sum(weight) FILTER (WHERE NOT is_full) OVER ()) END AS target
  FROM filled),
seats AS (SELECT floor(sum(target / 4) + 0.5)::BIGINT AS seats FROM goal),
dealt AS (
  SELECT place, k, row_number() OVER (ORDER BY target / 4 / (2 * k - 1) DESC, place, k) AS turn
  FROM goal, generate_series(1, (floor(target / 4) + 2 * (SELECT count(*) FROM goal))::BIGINT) AS s(k)),
quotas AS (SELECT place, count(*) AS quota FROM dealt, seats WHERE turn <= seats GROUP BY place),
sharded AS (
  SELECT sized.*, source_size, place, target, coalesce(quota, 0) AS source_quota,
         ('0x' || substr(ord, 1, 8))::BIGINT % ceil(n / (SELECT greatest(256, ceil(sqrt(count(*)))) FROM sized))::BIGINT AS shard
  FROM sized JOIN goal ON sized.source IS NOT DISTINCT FROM goal.source LEFT JOIN quotas USING (place)),
shards AS (
  SELECT place, shard, sum(size) AS words, CASE WHEN any_value(source_size) > 0
         THEN any_value(source_quota) * sum(size)::DOUBLE / any_value(source_size) ELSE 0 END AS share,
         any_value(source_quota) AS seats, ceil(sum(size) / 4)::BIGINT AS blocks
  FROM sharded GROUP BY place, shard),
shard_dealt AS (
  SELECT place, shard, seats, row_number() OVER (PARTITION BY place ORDER BY share / (2 * k - 1) DESC, shard, k) AS turn
  FROM shards, generate_series(1, (floor(share) + 2 + seats * 0 + (SELECT max(c) FROM (SELECT count(*) AS c FROM shards GROUP BY place)))::BIGINT) AS s(k)),
shard_quotas AS (SELECT place, shard, count(*) AS quota FROM shard_dealt WHERE turn <= seats GROUP BY place, shard),
runs AS (
  SELECT place, shard, blocks, quota // greatest(blocks, 1) AS every, quota % greatest(blocks, 1) AS more,
         ('0x' || substr(md5('mix:' || place || ':' || shard), 1, 8))::BIGINT % greatest(blocks, 1) AS start
  FROM (SELECT place, shard, blocks, least(coalesce(quota, 0), 2 * blocks) AS quota FROM shards LEFT JOIN shard_quotas USING (place, shard))),
laid AS (
  SELECT *, sum(size) OVER (PARTITION BY place, shard ORDER BY ord, doc_id, size ROWS UNBOUNDED PRECEDING)::BIGINT AS upto FROM sharded),
ends AS (
  SELECT doc_id, size, source_size, target, every, more, start, blocks, p, p // 4 AS whole, side
  FROM laid JOIN runs USING (place, shard), LATERAL (SELECT upto AS p, 1 AS side UNION ALL SELECT upto - size, -1) AS e),
counted AS (
  SELECT doc_id, size, source_size, target, side * (4 * (every * whole + CASE WHEN start + more <= blocks
           THEN least(greatest(whole - start, 0), more)
           ELSE least(whole, start + more - blocks) + greatest(whole - start, 0) END)
         + (p - 4 * whole) * (every + CASE WHEN start + more <= blocks THEN (whole >= start AND whole < start + more)::INT
           ELSE (whole < start + more - blocks OR whole >= start)::INT END)) AS part
  FROM ends)
SELECT doc_id, size, source_size, target, sum(part)::BIGINT AS taken FROM counted GROUP BY ALL
"""

URLS = r"""
WITH parsed AS (
  SELECT page_id, coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '') AS raw,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
lowered AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM parsed),
rules(verdict, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
                                ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
numbered AS (SELECT *, row_number() OVER () AS rn FROM lowered),
best AS (
  SELECT rn, arg_max(h || p, length(h) * 1000 + length(p)) AS rule, arg_max(verdict, length(h) * 1000 + length(p)) AS verdict
  FROM numbered JOIN rules ON (host = h OR host LIKE '%.' || h) AND starts_with(path, p) GROUP BY rn)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM numbered LEFT JOIN best USING (rn)
"""

TOP_K = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_dot_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
ranked AS (SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score FROM scored)
SELECT * FROM ranked WHERE rank <= 10
"""

CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
escaped AS (
  SELECT *, regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\]|image>|audio>|document>)', '\1\\\2\3', 'g') AS content FROM turns)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(3 + length(role) + CASE WHEN role = 'assistant' THEN 7 ELSE 6 END + length(content) + 4)::BIGINT AS formatted_chars
FROM escaped GROUP BY conv_id
"""


def licences() -> str:
    """Every unit against every template; the template texts are the operator's."""
    values = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, texts in TEMPLATES.items() for text in texts)
    grams = "list_distinct(CASE WHEN len(w) < 2 THEN w ELSE list_transform(list_zip(w[:-2], w[2:]), lambda p: p[1] || ' ' || p[2]) END)"
    return rf"""
WITH templates AS (SELECT licence, {grams} AS t FROM (SELECT licence, regexp_extract_all(lower(x), '[\p{{L}}\p{{N}}]+') AS w FROM (VALUES {values}) AS v(licence, x))),
units AS (
  SELECT doc_id, 'line' AS kind, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS unit_no, unnest(string_split(text, chr(10))) AS unit FROM documents
  UNION ALL SELECT doc_id, 'text', 0, text FROM documents WHERE contains(text, chr(10))
  UNION ALL SELECT doc_id, 'paragraph', generate_subscripts(p, 1) - 1, unnest(p)
            FROM (SELECT doc_id, regexp_split_to_array(text, '
[ 	]*
') AS p FROM documents WHERE regexp_matches(text, '
[ 	]*
'))),
grams AS (SELECT doc_id, kind, unit_no, {grams} AS g FROM (SELECT *, regexp_extract_all(lower(unit), '[\p{{L}}\p{{N}}]+') AS w FROM units)),
scored AS (SELECT doc_id, kind, unit_no, licence, 2.0::DOUBLE * len(list_intersect(g, t)) / (len(g) + len(t)) AS dice
           FROM grams JOIN templates ON len(g) BETWEEN len(t) / 4 AND len(t) * 4)
SELECT doc_id, kind, unit_no::INT AS unit_no, licence, dice FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id, kind, unit_no ORDER BY dice DESC, licence) AS r FROM scored WHERE dice >= {LEAST}) WHERE r = 1
"""

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def centroids(rounds: int = 5) -> str:
    """Each round as two tables: the nearest centroid of every vector, and the centroids after it."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
near{i} AS MATERIALIZED (
  SELECT r, cl, dist FROM (
    SELECT r, cl, list_sum(list_transform(range(1, 65), lambda d: (q[d] - c[d]) * (q[d] - c[d])))::BIGINT AS dist FROM v, c{i})
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY dist, cl) = 1)""")
        if i < rounds:
            steps.append(f"""
sums{i} AS (
  SELECT cl, d, sum(q[d])::HUGEINT AS s, count(*)::HUGEINT AS n
  FROM near{i} JOIN v USING (r), (SELECT unnest(range(1, 65)) AS d) GROUP BY cl, d),
c{i + 1} AS MATERIALIZED (
  SELECT cl, coalesce(m.c, old.c) AS c FROM c{i} AS old
  LEFT JOIN (SELECT cl, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY d) AS c FROM sums{i} GROUP BY cl) AS m USING (cl))""")
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h) - 1 AS cl, q AS c
  FROM (SELECT sha256('2:' || vec_id) AS h, q FROM v ORDER BY h LIMIT 40)),{",".join(steps)}
SELECT vec_id, cl::INT AS cluster, dist AS distance, (sum(dist) OVER (PARTITION BY cl))::BIGINT AS cluster_inertia,
       (sum(dist) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM near{rounds} JOIN v USING (r) JOIN c{rounds} USING (cl)"""


COLLOCATIONS = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({LOWERED}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
f AS MATERIALIZED (
  SELECT lang, g, len(g) AS k, count(*) AS f FROM (
    SELECT lang, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) AS g
    FROM words, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(w) >= k)
  GROUP BY lang, g),
totals AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS MATERIALIZED (SELECT lang, g, k, f AS a FROM f WHERE k > 1 AND f >= 100),
inside AS (
  SELECT lang, g[i:i + m - 1] AS g, max(a) AS longer
  FROM cand, (SELECT unnest([2, 3, 4]) AS m), (SELECT unnest([1, 2, 3, 4]) AS i)
  WHERE m < k AND i + m - 1 <= k GROUP BY ALL),
kept AS (
  SELECT cand.* FROM cand LEFT JOIN inside ON cand.lang = inside.lang AND cand.g = inside.g
  WHERE inside.g IS NULL OR 100 * longer < 100 * a),
cuts AS (
  SELECT kept.lang, kept.g, a, cut, l.f AS l, r.f AS r, totals.n AS n,
         (1000::HUGEINT * a * totals.n) // (l.f::HUGEINT * r.f) AS score
  FROM kept, (SELECT unnest([1, 2, 3, 4]) AS cut), f AS l, f AS r, totals
  WHERE cut < kept.k AND l.lang = kept.lang AND l.g = kept.g[1:cut] AND r.lang = kept.lang AND r.g = kept.g[cut + 1:]
    AND totals.lang = kept.lang),
best AS (
  SELECT *, array_to_string(g, ' ') AS phrase FROM cuts
  QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a::BIGINT AS a,
       l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM best QUALIFY rank <= 2000"""

EXACT = f"""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept,
       sha256(t) AS text_sha256
FROM (SELECT doc_id, {LOWERED} AS t FROM documents) WINDOW same AS (PARTITION BY t)"""
