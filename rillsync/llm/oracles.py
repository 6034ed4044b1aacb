"""The SQL of the queries that SQL can express, for DuckDB: exact, by joins on units, shingles and vectors."""

_UNITS = r"\n|(?:[^\n.!?]|[.!?]+[^\s.!?])+[.!?]*|[.!?]+"

OP1 = rf"""
WITH pieces AS (
  SELECT doc, doc_id, text_id, unnest(p) AS piece, generate_subscripts(p, 1) AS k
  FROM (
    SELECT doc_id, CAST('0x' || substr(md5(text), 1, 15) AS BIGINT) AS text_id, regexp_extract_all(text, '{_UNITS}') AS p,
      struct_pack(unnamed := doc_id IS NULL, doc_id := doc_id, text_id := text_id) AS doc
    FROM (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL))
), placed AS (
  SELECT *, sum(length(piece)) OVER (PARTITION BY doc ORDER BY k) - length(piece) AS place FROM pieces
), units AS (
  SELECT doc, k, place + length(piece) - length(regexp_replace(piece, '^\s+', '')) AS s, place + length(regexp_replace(piece, '\s+$', '')) AS e,
    trim(regexp_replace(lower(piece), '\s+', ' ', 'g')) AS body
  FROM placed WHERE regexp_matches(piece, '\S')
), counted AS (
  SELECT *, row_number() OVER d AS i, sum(len(string_split(body, ' '))) OVER d AS upto, upto - len(string_split(body, ' ')) AS before
  FROM units WINDOW d AS (PARTITION BY doc ORDER BY k)
), bodies AS (
  SELECT doc, list(body ORDER BY i) AS list FROM counted GROUP BY doc
), runs AS (
  SELECT a.doc, a.s, b.e, md5(array_to_string(list[a.i:b.i], chr(10))) AS digest
  FROM counted a ASOF JOIN counted b ON a.doc IS NOT DISTINCT FROM b.doc AND a.before + 12 <= b.upto JOIN bodies ON bodies.doc IS NOT DISTINCT FROM a.doc
), later AS (
  SELECT doc, s, e, first.doc.doc_id AS keeper
  FROM (SELECT *, min(struct_pack(doc := doc, s := s)) OVER (PARTITION BY digest) AS first FROM runs)
  WHERE first.doc IS DISTINCT FROM doc OR first.s <> s
), marked AS (
  SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY doc ORDER BY s, e, keeper ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 THEN 0 ELSE 1 END AS opens FROM later
), islands AS (
  SELECT *, sum(opens) OVER (PARTITION BY doc ORDER BY s, e, keeper ROWS UNBOUNDED PRECEDING) AS island FROM marked
)
SELECT doc.doc_id AS doc_id, doc.text_id AS text_id, CAST(min(s) AS BIGINT) AS start, CAST(max(e) AS BIGINT) AS "end", min(keeper) AS keeper_id
FROM islands GROUP BY doc, island
"""

_REACH = """
reach AS (
  SELECT a AS id, a AS to_id FROM links UNION SELECT reach.id, links.b FROM reach JOIN links ON links.a = reach.to_id
), least AS (
  SELECT id, min(to_id) AS component FROM reach GROUP BY id
)"""

OP6 = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+') AS w FROM documents WHERE doc_id IS NOT NULL
), sets AS (
  SELECT doc_id, list_sort(list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i+4], ' ')))) AS found FROM words WHERE len(w) > 0
), classes AS (
  SELECT md5(array_to_string(found, chr(10))) AS class, min(doc_id) AS rep, count(*) AS n_rows, any_value(found) AS found FROM sets GROUP BY 1
), grams AS (
  SELECT rep, len(found) AS n, hash(unnest(found)) AS gram FROM classes
), links AS (
  SELECT a.rep AS a, b.rep AS b FROM grams a JOIN grams b ON a.gram = b.gram AND a.rep <> b.rep
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 10 * count(*) >= 8 * (a.n + b.n - count(*))
), {_REACH}, n_links AS (
  SELECT a, sum(n_rows) AS n FROM links JOIN classes ON rep = b GROUP BY a
), per_class AS (
  SELECT class, rep, coalesce(component, rep) AS class_id, n_rows - 1 + coalesce(n, 0) AS n_links
  FROM classes LEFT JOIN least ON id = rep LEFT JOIN n_links ON a = rep
), named AS (
  SELECT doc_id, md5(array_to_string(found, chr(10))) AS class FROM sets
)
SELECT doc_id, class_id, CAST(n_links AS BIGINT) AS n_links, rep AS copy_id FROM named JOIN per_class USING (class)
UNION ALL SELECT doc_id, doc_id, 0, doc_id FROM documents WHERE coalesce(len(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+')), 0) = 0 OR doc_id IS NULL
"""

OP10 = f"""
WITH RECURSIVE valid AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM valid x JOIN valid y ON x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
  WHERE list_cosine_similarity(x.v, y.v) >= 0.95
), {_REACH}, n_links AS (
  SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(component, vec_id) AS component_id, coalesce(component, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN least ON id = vec_id LEFT JOIN n_links ON a = vec_id
"""

SQL = {"op1_substring_dedup": OP1, "op6_ngram_join": OP6, "op10_embedding_dedup": OP10}
