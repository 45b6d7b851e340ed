"""DuckDB SQL for the results of the registered queries that SQL can express."""

_USABLE = """
SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
"""

OP3 = f"""
WITH rows AS ({_USABLE}),
codes AS (SELECT vec_id, list_transform(v, lambda x: floor(256 * x)) AS c FROM rows),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.c, c.c)::BIGINT AS score
  FROM codes q JOIN codes c ON q.vec_id <> c.vec_id AND len(q.c) = len(c.c)
  WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank,
         vec_id, score
  FROM scored
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""

OP9 = f"""
WITH rows AS ({_USABLE}),
normed AS (SELECT vec_id, v, sqrt(list_inner_product(v, v)) AS n FROM rows),
nonzero AS (SELECT * FROM normed WHERE n > 0 AND isfinite(n)),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) / (q.n * c.n) AS score
  FROM nonzero q JOIN nonzero c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank,
         vec_id, score
  FROM scored
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""

OP6 = r"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS k
  FROM split, unnest(range(1, len(w) - 48)) AS r(i)
), firsts AS (
  SELECT k, min(doc_id) AS first_id FROM windows GROUP BY k
), gone AS (
  SELECT doc_id, list(DISTINCT p) AS places
  FROM (SELECT DISTINCT doc_id, i FROM windows JOIN firsts USING (k) WHERE first_id < doc_id),
       unnest(range(i, i + 50)) AS r(p)
  GROUP BY doc_id
), cut AS (
  SELECT split.doc_id, w,
         CASE WHEN places IS NULL THEN w
              ELSE list_filter(w, lambda x, i: NOT list_contains(places, i)) END AS kept
  FROM split LEFT JOIN gone ON split.doc_id = gone.doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - len(kept))::BIGINT AS n_removed,
       sha256(array_to_string(kept, ' ')) AS kept_sha256
FROM cut
"""

ORACLES = {
    "op3_exact_topk": OP3,
    "op6_substring_dedup": OP6,
    "op9_block_ann": OP9,
}
