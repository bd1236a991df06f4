"""SQL that gives the rows of the training-data queries that SQL can express."""

from __future__ import annotations

from hourtally.llm import licences, mixing

OP2 = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce('s' || source, '') AS k, md5(coalesce(doc_id::VARCHAR, '')) AS o FROM documents
),
sizes AS (SELECT k, count(*) AS n, floor(sqrt(count(*)) * 1000)::HUGEINT AS w FROM d GROUP BY k),
scaled AS (
  SELECT k, n, w * ({mixing.SLOTS} - count(*) OVER ()) AS share, greatest(sum(w) OVER (), 1)::HUGEINT AS total,
         {mixing.SLOTS} - count(*) OVER () AS spare
  FROM sizes
),
parts AS (
  SELECT k, n, 1 + (share // total)::BIGINT
    + CASE WHEN row_number() OVER (ORDER BY share % total DESC, k) <= spare - sum(share // total) OVER ()
           THEN 1 ELSE 0 END AS q
  FROM scaled
),
l AS (SELECT list(q ORDER BY k) AS q, list(n ORDER BY k) AS n, list(k ORDER BY k) AS k FROM parts),
steps AS (
  SELECT 0::BIGINT AS t, list_transform(q, lambda x: 0::BIGINT) AS done, 0::BIGINT AS p FROM l
  UNION ALL
  SELECT t + 1, list_transform(done, lambda x, i: x + CASE WHEN i = p1 THEN 1 ELSE 0 END), p1
  FROM (
    SELECT s.t, s.done, list_min(list_filter(
        list_transform(l.q, lambda x, i: {{'due': ((s.done[i] + 1) * {mixing.SLOTS} + x - 1) // x, 'i': i::BIGINT,
                                          'r': s.done[i] * {mixing.SLOTS} // x}}),
        lambda e: e.r <= s.t)).i AS p1
    FROM steps s, l WHERE s.t < {mixing.SLOTS}
  )
),
period AS (
  SELECT b.t - 1 AS slot, b.p AS i, l.k[b.p] AS k, l.q[b.p] AS q, b.done[b.p] - 1 AS turn,
         list_transform(b.done, lambda x, j: x - CASE WHEN j = b.p THEN 1 ELSE 0 END) AS done, l.q AS all_q, l.n AS sizes
  FROM steps b, l WHERE b.t > 0
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY o, doc_id NULLS FIRST) - 1 AS rank FROM d)
SELECT doc_id, source, rank // {mixing.BLOCK_DOCS} AS mix_block,
       ((rank // {mixing.BLOCK_DOCS}) // q) * {mixing.SLOTS} + slot AS mix_slot,
       (list_sum(list_transform(done, lambda x, j: least(sizes[j],
          {mixing.BLOCK_DOCS} * (((rank // {mixing.BLOCK_DOCS}) // q) * all_q[j] + x))))
        + rank % {mixing.BLOCK_DOCS})::BIGINT AS position
FROM ranked JOIN period USING (k) WHERE turn = (rank // {mixing.BLOCK_DOCS}) % q
"""

_SCHEME = "^[a-zA-Z][a-zA-Z0-9+.-]*://"
OP5 = f"""
WITH p AS (
  SELECT page_id, url, TIMESTAMP '2024-01-01' + to_hours((page_id % 8784)::INTEGER) AS t,
         regexp_replace(regexp_replace(lower(regexp_extract(coalesce(url, ''), '{_SCHEME}([^/?#]*)', 1)), '^.*@', ''),
                        '[.]?(:[0-9]*)?$', '') AS host,
         regexp_extract(coalesce(url, ''), '{_SCHEME}[^/?#]*([^?#]*)', 1) AS path
  FROM pages
),
s AS (
  SELECT *, string_split(host, '.') AS labels, list_filter(string_split(path, '/'), lambda x: x <> '') AS segs,
         string_split(path, '/')[2] AS folder
  FROM p
),
named AS (
  SELECT 'hosts' AS list_id, host AS pattern FROM s WHERE host <> ''
  UNION SELECT 'domains', array_to_string(labels[2:], '.') FROM s WHERE host <> '' AND len(labels) > 3
  UNION SELECT 'folders', concat_ws('/', host, folder) FROM s WHERE host <> ''
),
days AS (
  SELECT *, ('0x' || md5(pattern)[1:2])::INTEGER AS a, ('0x' || md5(pattern)[3:4])::INTEGER AS b,
         ('0x' || md5(pattern)[5:6])::INTEGER AS c
  FROM named
),
spans AS (
  SELECT list_id, pattern, DATE '2024-01-01' + a AS since, DATE '2024-01-01' + (a + 1 + b) AS until FROM days
  UNION ALL
  SELECT list_id, pattern, DATE '2024-01-01' + (a + 2 + b + c), DATE '9999-12-31' FROM days
),
keys AS (
  SELECT page_id, url, t, unnest(list_distinct(list_concat(
      list_transform(range(1, len(labels) + 1), lambda i: array_to_string(labels[i:], '.')),
      list_transform(range(1, len(segs) + 1), lambda i: host || '/' || array_to_string(segs[1:i], '/'))))) AS key
  FROM s WHERE host <> ''
),
met AS (
  SELECT page_id, url, t, list_id, pattern, since,
         row_number() OVER (PARTITION BY page_id ORDER BY length(pattern) DESC, list_id, pattern, since) AS n
  FROM keys JOIN spans ON key = pattern AND t >= since AND t < until
)
SELECT p.page_id, p.url, met.n IS NOT NULL AS blocked, list_id, pattern,
       strftime(p.t, '%Y-%m-%d %H:%M:%S') AS fetched_at, strftime(since, '%Y-%m-%d %H:%M:%S') AS since
FROM p LEFT JOIN met ON p.page_id = met.page_id AND met.n = 1
"""

_KNOWN = ", ".join(f"({number}, '{plain}')" for number, plain in licences.SENTENCES.items())
_RULES = ", ".join(
    f"('{name}', '%{'%'.join(f'<{i}>' for i in ids)}%')" for name, ids in licences.RULES
)
_PLAINLY = "lower(coalesce(text, ''))"
for _pattern, _by, _group in licences.STEPS:
    _PLAINLY = f"regexp_replace({_PLAINLY}, '{_pattern}', '{chr(92) + '1' if _group else ''}{_by}', 'g')"
_MOST = max(len(plain.split()) for plain in licences.SENTENCES.values())
OP10 = f"""
WITH known(number, plain) AS (VALUES {_KNOWN}),
rules(licence, shape) AS (VALUES {_RULES}),
plainly AS (SELECT doc_id, string_split(trim({_PLAINLY}), 'S') AS sentences FROM documents),
each AS (SELECT doc_id, unnest(range(len(sentences))) AS place, string_split(unnest(sentences), 'L') AS pieces FROM plainly),
after AS (
  SELECT doc_id, place, unnest(range(len(pieces))) AS piece,
         array_to_string(pieces[unnest(range(len(pieces))) + 1 : unnest(range(len(pieces))) + {_MOST}], 'L') AS there
  FROM each
),
met AS (
  SELECT doc_id, place, piece, length(plain) AS size, number
  FROM after JOIN known ON starts_with(replace(there, 'L', ' '), plain) AND substr(there, length(plain) + 1, 1) IN ('L', '')
),
lines AS (
  SELECT doc_id, string_agg('<' || number || '>', '' ORDER BY place, piece, size) AS line,
         string_agg(number::VARCHAR, ',' ORDER BY place, piece, size) AS numbers
  FROM met GROUP BY doc_id
),
named AS (
  SELECT doc_id, string_agg(DISTINCT licence, ',' ORDER BY licence) AS licences
  FROM lines JOIN rules ON line LIKE shape GROUP BY doc_id
)
SELECT d.doc_id, coalesce(licences, '') AS licences, coalesce(numbers, '') AS sentences
FROM documents d LEFT JOIN lines USING (doc_id) LEFT JOIN named USING (doc_id)
"""

OP11 = """
WITH RECURSIVE table_of_crc AS (
  SELECT b::UINTEGER AS b, list_reduce(range(8), lambda a, _: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, b) AS v
  FROM range(256) t(b)
),
crc AS (SELECT list(v ORDER BY b) AS v FROM table_of_crc),
docs AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce('=' || lang, '') AS tree,
    CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR END
      || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
      || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END AS before,
    n_chars, CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS after,
    xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
        lambda a, c: xor(a >> 8, crc.v[(xor(a, c) & 255) + 1]), 4294967295), 4294967295) AS number
  FROM documents, crc
),
leaves AS (
  SELECT row, doc_id, tree,
    sha256(before || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(n_chars::VARCHAR) || ':' || n_chars END || after) AS leaf,
    CASE WHEN n_chars IS NOT NULL AND number % 7 = 0
      THEN sha256(before || strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1) || after) END AS tampered
  FROM docs
),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, row) - 1 AS place,
    count(*) OVER (PARTITION BY tree) AS total
  FROM leaves
),
nodes AS (
  SELECT tree, 0 AS level, place, total, leaf AS digest FROM ordered
  UNION ALL
  SELECT tree, level + 1, place // 2, (total + 1) // 2, sha256(string_agg(digest, '' ORDER BY place))
  FROM nodes WHERE total > 1 GROUP BY tree, level, place // 2, total
),
subroots AS (
  SELECT tree, level AS height, digest, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS total
  FROM nodes WHERE total = 1
),
upper AS (
  SELECT 0 AS level, place, total, digest FROM subroots
  UNION ALL
  SELECT level + 1, place // 2, (total + 1) // 2, sha256(string_agg(digest, '' ORDER BY place))
  FROM upper WHERE total > 1 GROUP BY level, place // 2, total
),
root AS (SELECT digest AS root, level AS height FROM upper WHERE total = 1),
steps AS (
  SELECT o.row, l.level AS rung, (o.place >> l.level) % 2 AS is_right, s.digest AS other
  FROM ordered o JOIN subroots t USING (tree) JOIN range(64) l(level) ON l.level < t.height
  LEFT JOIN nodes s ON s.tree = o.tree AND s.level = l.level AND s.place = xor(o.place >> l.level, 1)
  UNION ALL
  SELECT o.row, 64 + l.level, (t.place >> l.level) % 2, s.digest
  FROM ordered o JOIN subroots t USING (tree), root r JOIN range(64) l(level) ON l.level < r.height
  LEFT JOIN upper s ON s.level = l.level AND s.place = xor(t.place >> l.level, 1)
),
paths AS (SELECT row, list({'right': is_right, 'other': coalesce(other, '')} ORDER BY rung) AS path FROM steps GROUP BY row),
proven AS (
  SELECT o.doc_id, o.leaf, t.digest AS subroot, r.root,
    list_transform(coalesce(p.path, []), lambda s: s.other) AS others,
    coalesce(p.path, []) AS path, coalesce(o.tampered, o.leaf) AS now
  FROM ordered o JOIN subroots t USING (tree) LEFT JOIN paths p ON p.row = o.row, root r
),
folded AS (
  SELECT *, list_reduce(list_transform(path, lambda s: {'v': s.other, 'right': s.right}),
      lambda a, s: {'v': sha256(CASE WHEN s.right = 1 THEN s.v || a.v ELSE a.v || s.v END), 'right': 0::BIGINT},
      {'v': now, 'right': 0::BIGINT}).v AS folded_root
  FROM proven
)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(others, '')) AS proof_sha256, folded_root,
       folded_root = root AS verified
FROM folded
"""

def _clustering_sql() -> str:
    """Rounds are written out one after another."""
    steps = [
        """kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, embedding FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0
)""",
        """parts AS MATERIALIZED (
  SELECT row, unnest(range(64)) AS place, floor(256 * unnest(embedding)::DOUBLE)::BIGINT AS q FROM kept
)""",
        """chosen AS (
  SELECT row, row_number() OVER (ORDER BY sha256('2:' || vec_id) NULLS LAST, vec_id, embedding) - 1 AS cluster FROM kept
  QUALIFY cluster < 40
)""",
        "centres_0 AS MATERIALIZED (SELECT cluster, place, q FROM chosen JOIN parts USING (row))",
    ]
    for k in range(6):
        steps.append(f"""nearest_{k} AS MATERIALIZED (
  SELECT row, min({{'d': d, 'cluster': cluster}}) AS best FROM (
    SELECT row, cluster, sum((p.q - c.q) * (p.q - c.q))::BIGINT AS d
    FROM parts p JOIN centres_{k} c USING (place) GROUP BY row, cluster
  ) GROUP BY row
)""")
        if k < 5:
            steps.append(f"""sums_{k} AS MATERIALIZED (
  SELECT best.cluster AS cluster, place, sum(q)::BIGINT AS s, count(*) AS n
  FROM nearest_{k} JOIN parts USING (row) GROUP BY best.cluster, place
)""")
            steps.append(f"""centres_{k + 1} AS MATERIALIZED (
  SELECT c.cluster, c.place, coalesce((s - (s % n + n) % n) // n, c.q) AS q
  FROM centres_{k} c LEFT JOIN sums_{k} m ON m.cluster = c.cluster AND m.place = c.place
)""")
    steps.append("""digests AS (
  SELECT cluster, sha256(string_agg(q::VARCHAR, ',' ORDER BY place)) AS centroid_sha256 FROM centres_5 GROUP BY cluster
)""")
    return "WITH " + ",\n".join(steps) + """
SELECT vec_id, best.cluster::INTEGER AS cluster, best.d AS distance,
       (sum(best.d) OVER (PARTITION BY best.cluster))::BIGINT AS cluster_inertia, (sum(best.d) OVER ())::BIGINT AS inertia,
       centroid_sha256
FROM kept JOIN nearest_5 USING (row) JOIN digests ON digests.cluster = best.cluster
"""


ORACLES = {
    "op2_pfair_mixing": OP2,
    "op5_temporal_url_filter": OP5,
    "op10_licence_sentences": OP10,
    "op11_merkle_manifest": OP11,
    "op13_hilbert_clustering": _clustering_sql(),
}
