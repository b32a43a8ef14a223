"""DuckDB SQL of the registered queries that SQL can express."""

ORACLES: dict[str, str] = {}

ORACLES["op4_decontaminate"] = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), item AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item, least(len(w), 13) AS size, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS phrase
  FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM item WHERE len(w) > 0)
), gram AS (
  SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM doc, (SELECT DISTINCT size FROM win))
), hit AS (SELECT DISTINCT g.doc_id, g.i, g.size, win.item FROM gram g JOIN win USING (size, phrase)),
word AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hit) GROUP BY doc_id),
found AS (SELECT doc_id, count(DISTINCT item) AS n_items, array_to_string(list_sort(list(DISTINCT item)), ',') AS items FROM hit GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN word USING (doc_id) LEFT JOIN found USING (doc_id)
"""


def _codes_sql(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    """One pair of CTEs a round: nearest entries, then the means. ``best`` packs distance and entry: the least is the answer."""
    def near(k: int) -> str:
        return f"""a{k} AS (SELECT r, p, min(d * 256 + e) AS best FROM (
  SELECT r, part.p, e, list_sum(list_transform(list_zip(m, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM part JOIN b{k} b ON b.p = part.p
) GROUP BY r, p)"""

    def moved(k: int) -> str:
        return f"""b{k + 1} AS (SELECT b.p, b.e, coalesce(n.c, b.c) AS c FROM b{k} b LEFT JOIN (
  SELECT p, e, list(x ORDER BY i) AS c FROM (
    SELECT p, e, i, CAST(floor(CAST(sum(x) AS DOUBLE) / count(*)) AS BIGINT) AS x FROM (
      SELECT part.p, best % 256 AS e, unnest(m) AS x, unnest(range(len(m))) AS i FROM part JOIN a{k} a ON a.r = part.r AND a.p = part.p
    ) GROUP BY p, e, i) GROUP BY p, e) n ON n.p = b.p AND n.e = b.e)"""

    steps = ",\n".join(s for k in range(rounds) for s in (near(k), moved(k)))
    return f"""
WITH kept AS (
  SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS r FROM (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS v FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding))
), part AS (SELECT r, p, v[p * w + 1:(p + 1) * w] AS m FROM (SELECT r, v, len(v) // {parts} AS w, unnest(range({parts})) AS p FROM kept)),
b0 AS (SELECT p, r AS e, m AS c FROM part WHERE r < {entries}),
{steps},
{near(rounds)},
told AS (SELECT r, string_agg(printf('%02x', best % 256), '' ORDER BY p) AS code, CAST(sum(best // 256) AS BIGINT) AS error FROM a{rounds} GROUP BY r),
book AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS digest FROM b{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, digest AS codebooks_sha256
FROM kept JOIN told USING (r), book
"""


ORACLES["op11_vector_codes"] = _codes_sql()

ORACLES["op12_prefix_trie"] = """
WITH own AS (
  SELECT conv_id, list(struct_pack(r := role, t := text) ORDER BY turn NULLS FIRST, role, text) AS turns
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL) GROUP BY conv_id
), hashed AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda s, b: list_reduce(list_prepend(xor(s, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 9 AS h FROM own
), built AS (
  SELECT a.conv_id, list_concat(coalesce(b.turns, a.turns[1:0])[1:a.h], a.turns[a.h + 1:]) AS seq
  FROM hashed a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 5
), pre AS (SELECT conv_id, d, seq[1:d] AS node, d = len(seq) AS ends FROM (SELECT conv_id, seq, unnest(range(len(seq) + 1)) AS d FROM built)),
node AS (
  SELECT node, d, min(conv_id) AS least, count(*) AS n,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS digest
  FROM pre GROUP BY node, d
), child AS (SELECT node[1:d - 1] AS node, d - 1 AS d, count(*) AS n_children FROM node WHERE d > 0 GROUP BY 1, 2),
whole AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN child USING (node, d)),
below AS (
  SELECT node[1:k] AS node, k AS d, count(*) FILTER (n_children = 0) AS n_leaves, sum(CASE WHEN d = 0 THEN 0 ELSE (n - 1) * strlen(node[d].t) END) AS saved
  FROM (SELECT *, unnest(range(d + 1)) AS k FROM whole) GROUP BY 1, 2
)
SELECT w.least AS conv_id, w.d AS depth, up.least AS parent_conv_id, w.n AS n_convs, w.n_children, n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, w.digest AS ends_sha256
FROM whole w JOIN below USING (node, d) LEFT JOIN node up ON up.d = w.d - 1 AND up.node = w.node[1:w.d - 1]
"""
