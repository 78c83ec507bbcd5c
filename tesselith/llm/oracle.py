"""The same rows in DuckDB's SQL, for the operators that SQL can express over whole tables. All is compared with all there,
so these are for tables of the size that the driver compares."""

WORDS = "'[^\\x20\\x09-\\x0D]+'"

_COMPONENTS = """both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a, b FROM both_ways UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON l.a = r.b),
comp AS (SELECT a AS id, min(least(a, b)) AS c FROM reach GROUP BY a)"""

NEAR_VECTORS = f"""WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] e FROM embeddings WHERE label IS NOT NULL AND len(embedding) > 0 AND NOT list_contains(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x)), TRUE) AND list_sum(list_transform(embedding, lambda x: abs(x))) > 0),
links AS (SELECT p.vec_id a, q.vec_id b FROM v p JOIN v q ON p.label = q.label AND p.vec_id < q.vec_id WHERE list_cosine_similarity(p.e, q.e) >= 0.93),
{_COMPONENTS},
n AS (SELECT a AS id, count(*) AS k FROM both_ways GROUP BY a)
SELECT vec_id, coalesce(k, 0)::BIGINT AS n_links, coalesce(c, vec_id) AS component_id, coalesce(c, vec_id) = vec_id AS kept FROM embeddings LEFT JOIN comp ON comp.id = vec_id LEFT JOIN n ON n.id = vec_id"""

PHRASES = f"""WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {WORDS}) ws FROM documents),
i AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) i FROM w WHERE len(ws) >= 13),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') k FROM i),
m AS (SELECT k, min(doc_id) f FROM g GROUP BY k),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) j FROM g JOIN m USING (k) WHERE f < doc_id),
each_word AS (SELECT doc_id, unnest(ws) word, unnest(range(1, len(ws) + 1)) j FROM w),
kept AS (SELECT e.doc_id, string_agg(word, ' ' ORDER BY e.j) AS t, count(*) AS n FROM each_word e ANTI JOIN gone USING (doc_id, j) GROUP BY e.doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, len(ws)::BIGINT - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)"""

NEAR_COPIES = f"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {WORDS}) ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')] ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))) END x FROM w),
sizes AS (SELECT doc_id, len(x)::BIGINT n FROM s),
e AS (SELECT doc_id, unnest(x) x FROM s),
shared AS (SELECT p.doc_id a, q.doc_id b, count(*) k FROM e p JOIN e q ON p.x = q.x AND p.doc_id < q.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * k >= 80 * (p.n + q.n - k)),
{_COMPONENTS}
SELECT doc_id, n AS n_shingles, coalesce(c, doc_id) AS component_id, coalesce(c, doc_id) = doc_id AS kept FROM sizes LEFT JOIN comp ON comp.id = doc_id"""

#: Strings of bytes have none: a row a byte took minutes on the smallest tables; brute force in the tests stands for it.
ORACLE_SQL = {"op2_nn_descent": NEAR_VECTORS, "op3_phrase_automata": PHRASES, "op9_minhash_forest": NEAR_COPIES}
