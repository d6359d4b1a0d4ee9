"""The registered queries as ANSI-style SQL over the same tables, for checking."""

from __future__ import annotations

# Fixed values, written out here so that a wrong constant in the engine shows.
DEFAULT_SYSTEM_PROMPT = (
    "You are a helpful AI assistant. Answer the question based on the provided context. "
    "If the context doesn't contain enough information to answer the question, say so clearly. "
    "Be concise and accurate in your response."
)
INSUFFICIENT_CONTEXT_PHRASES = [
    "don't have enough information",
    "context doesn't contain",
    "cannot answer",
    "insufficient information",
    "not enough context",
]

DIM = 64
SPACE = r"\s+"

STORE = """store AS (
  SELECT doc_id AS id, text AS document_text,
         '{"lang":"' || lang || '","source":"' || source || '","n_chars":' || n_chars || '}' AS metadata,
         timestamp '2024-01-01' + to_seconds(doc_id) AS created_at
  FROM documents)"""

EMBEDDED = f"""{STORE},
embedded AS (
  SELECT e.vec_id AS id, coalesce(s.document_text, '') AS document_text, coalesce(s.metadata, '{{}}') AS metadata,
         s.created_at, e.embedding::DOUBLE[] AS vec
  FROM embeddings e LEFT JOIN store s ON e.vec_id = s.id)"""

FIRST = "first_item AS (SELECT text FROM benchmark ORDER BY item_id LIMIT 1)"


def hashed(name: str, source: str) -> str:
    """CTEs giving ``name(id, vec)``: the hash encoding of ``source(id, text)``."""
    return f"""
{name}_words AS (
  SELECT id, unnest(string_split(trim(regexp_replace(lower(replace(text, chr(0), '')), '{SPACE}', ' ', 'g')), ' ')) AS w
  FROM {source}),
{name}_sums AS (
  SELECT id, ('0x' || substring(md5(w), 1, 8))::BIGINT % {DIM} AS bucket,
         sum(CASE WHEN substring(md5(w), 9, 1) < '8' THEN 1 ELSE -1 END) AS c
  FROM {name}_words GROUP BY ALL),
{name}_weights AS (
  SELECT id, bucket, c / sqrt(sum(c * c) OVER (PARTITION BY id)) AS weight
  FROM {name}_sums WHERE c <> 0),
{name}_all AS (
  SELECT s.id, b.bucket, coalesce(w.weight, 0.0)::FLOAT::DOUBLE AS weight
  FROM {source} s CROSS JOIN (SELECT unnest(range({DIM})) AS bucket) b
  LEFT JOIN {name}_weights w ON w.id = s.id AND w.bucket = b.bucket),
{name} AS (SELECT id, list(weight ORDER BY bucket) AS vec FROM {name}_all GROUP BY id)"""


DOC_VECTORS = "docs AS (SELECT doc_id AS id, text FROM documents)," + hashed("dv", "docs")
ASKED_VECTORS = "asked AS (SELECT item_id AS id, text FROM benchmark)," + hashed("qv", "asked")
FIRST_VECTOR = f"{FIRST}, one AS (SELECT 0 AS id, text FROM first_item)," + hashed("ov", "one")

COSINE = "(1 - list_dot_product({a}, {b}) / (sqrt(list_dot_product({a}, {a})) * sqrt(list_dot_product({b}, {b}))))"
EUCLID = "list_distance({a}, {b})"


def similar(metric: str, exclude: bool, columns: str) -> str:
    formula = (COSINE if metric == "cosine" else EUCLID).format(a="e.vec", b="t.vec")
    where = "WHERE e.id <> 7" if exclude else ""
    return f"""WITH {EMBEDDED},
ranked AS (
  SELECT e.id, e.document_text, e.metadata, {formula} AS d
  FROM embedded e, (SELECT vec FROM embedded WHERE id = 7) t {where}
  ORDER BY round(d, 9), e.id LIMIT 10)
SELECT {columns} FROM ranked"""


def self_topk(metric: str) -> str:
    formula = (COSINE if metric == "cosine" else EUCLID).format(a="q.vec", b="e.vec")
    return f"""WITH v AS (SELECT vec_id AS id, embedding::DOUBLE[] AS vec FROM embeddings),
pairs AS (SELECT q.id AS qid, e.id, {formula} AS d FROM v q JOIN v e ON q.id <> e.id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(d, 9), id) AS rn FROM pairs)
SELECT qid, rn, id, round(d, 6) AS distance FROM ranked WHERE rn <= 10"""


def probed_topk(cells: int, probes: int) -> str:
    """Cosine neighbours within the cells around the vectors of least md5."""
    formula = COSINE.format(a="q.vec", b="e.vec")
    return f"""WITH v AS (SELECT vec_id AS id, embedding::DOUBLE[] AS vec FROM embeddings),
u AS (SELECT id, list_transform(vec, lambda x: x / sqrt(list_dot_product(vec, vec))) AS unit FROM v),
centres AS (
  SELECT unit AS centre, row_number() OVER (ORDER BY md5(id::VARCHAR), id::VARCHAR) AS cell
  FROM u QUALIFY cell <= {cells}),
near AS (
  SELECT id, cell, row_number() OVER (PARTITION BY id ORDER BY -list_dot_product(unit, centre), cell) AS place
  FROM u, centres),
pairs AS (
  SELECT q.id AS qid, e.id, {formula} AS d
  FROM v q JOIN near a ON a.id = q.id AND a.place <= {probes}
  JOIN near b ON b.cell = a.cell AND b.place = 1 JOIN v e ON e.id = b.id AND e.id <> q.id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(d, 9), id) AS rn FROM pairs)
SELECT qid, rn, id, round(d, 6) AS distance FROM ranked WHERE rn <= 10"""


def filled_topk(cells: int, probes: int, least: int) -> str:
    """The same, where a query reads cells, nearest first, until they hold ``least`` rows."""
    whole = probed_topk(cells, probes)
    sized = f"""sizes AS (SELECT cell, count(*) AS n FROM near WHERE place = 1 GROUP BY cell),
reach AS (
  SELECT id, cell, place, coalesce(sum(coalesce(n, 0)) OVER (
    PARTITION BY id ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM near LEFT JOIN sizes USING (cell)),
pairs AS ("""
    whole = whole.replace("pairs AS (", sized, 1)
    return whole.replace(f"JOIN near a ON a.id = q.id AND a.place <= {probes}", f"JOIN reach a ON a.id = q.id AND (a.place <= {probes} OR a.before < {least})")


def semantic(metric: str, limit: int, columns: str, having: str = "") -> str:
    formula = (COSINE if metric == "cosine" else EUCLID).format(a="v.vec", b="o.vec")
    return f"""WITH {STORE}, {DOC_VECTORS}, {FIRST_VECTOR},
ranked AS (
  SELECT s.id, s.document_text, s.metadata, {formula} AS d
  FROM store s JOIN dv v ON v.id = s.id, ov o
  ORDER BY round(d, 9), s.id LIMIT {limit})
SELECT {columns} FROM ranked {having}"""


RETRIEVED = f"""{STORE}, {DOC_VECTORS}, {ASKED_VECTORS},
pairs AS (
  SELECT q.id AS qid, v.id, {COSINE.format(a="v.vec", b="q.vec")} AS d FROM qv q, dv v),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(d, 9), id) AS rn FROM pairs)"""

TEXT_SCORE = f"""{FIRST},
tokens AS (
  SELECT DISTINCT w FROM (
    SELECT unnest(string_split(trim(regexp_replace(lower(text), '{SPACE}', ' ', 'g')), ' ')) AS w
    FROM first_item) WHERE length(w) >= 3),
hits AS (
  SELECT id, w, count(*) AS tf FROM (
    SELECT doc_id AS id,
           unnest(string_split(trim(regexp_replace(lower(text), '{SPACE}', ' ', 'g')), ' ')) AS w
    FROM documents) WHERE w IN (SELECT w FROM tokens) GROUP BY id, w),
idf AS (
  SELECT w, log10((SELECT count(*) FROM documents)::DOUBLE / count(*)) AS idf FROM hits GROUP BY w),
scores AS (
  SELECT id, sum(tf * idf.idf * idf.idf) AS match FROM hits JOIN idf USING (w) GROUP BY id)"""

CONTEXT = f"""{RETRIEVED},
parts AS (
  SELECT r.qid, r.rn, '[Context ' || r.rn || ']: ' || CASE WHEN length(s.document_text) > 1000
         THEN substring(s.document_text, 1, 1000) || '...' ELSE s.document_text END AS part
  FROM ranked r JOIN store s USING (id) WHERE r.rn <= 3),
context AS (
  SELECT qid, string_agg(part, chr(10) || chr(10) ORDER BY rn) AS context_text,
         count(*)::INTEGER AS context_count
  FROM parts GROUP BY qid)"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def chunks(size: int, overlap: int, count: str, extra: str = "") -> str:
    step = size - overlap
    n = count.format(size=size, step=step)
    return f"""WITH counted AS (
  SELECT doc_id, text, length(text) > {size} AS is_chunk,
         CASE WHEN length(text) <= {size} THEN 1 ELSE {n} END::BIGINT AS n FROM documents),
based AS (
  SELECT *, sum(n) OVER (ORDER BY doc_id) - n AS base,
         row_number() OVER (ORDER BY doc_id) - 1 AS position FROM counted),
cut AS (
  SELECT doc_id, is_chunk, base, position, k,
         CASE WHEN is_chunk THEN substring(text, CAST(k * {step} + 1 AS BIGINT), {size}) ELSE text END AS chunk
  FROM (SELECT *, unnest(range(n)) AS k FROM based))
SELECT doc_id, k::INTEGER AS chunk_no, {extra} is_chunk,
       CASE WHEN is_chunk THEN k * {step} END::INTEGER AS chunk_start,
       CASE WHEN is_chunk THEN k * {step} + length(chunk) END::INTEGER AS chunk_end,
       md5(chunk) AS chunk_md5 FROM cut"""


CORE_COUNT = "ceil((length(text) - {size}) / {step}) + 1"
TAIL_COUNT = "ceil(length(text) / {step})"
CLEAN = "trim(regexp_replace(replace({c}, chr(0), ''), '" + SPACE + "', ' ', 'g'))"

BLANKED = """blanked AS (
  SELECT conv_id * 2097152 + turn * 2 AS doc_id, text FROM conversations
  UNION ALL
  SELECT conv_id * 2097152 + turn * 2 + 1, ' ' FROM conversations WHERE role = 'assistant')"""

WORDS = (
    "list_distinct(list_filter(string_split(regexp_replace(lower({c}), '"
    + SPACE
    + "', ' ', 'g'), ' '), lambda x: x <> ''))"
)
INSUFFICIENT = " OR ".join(
    f"contains(lower(answer), {_quoted(p)})" for p in INSUFFICIENT_CONTEXT_PHRASES
)

CHUNK_ROWS = f"""WITH counted AS (
  SELECT doc_id, text, length(text) > 500 AS is_chunk,
         CASE WHEN length(text) <= 500 THEN 1 ELSE {CORE_COUNT.format(size=500, step=450)} END::BIGINT AS n
  FROM documents),
cut AS (
  SELECT doc_id, is_chunk, k,
         CASE WHEN is_chunk THEN substring(text, CAST(k * 450 + 1 AS BIGINT), 500) ELSE text END AS chunk
  FROM (SELECT *, unnest(range(n)) AS k FROM counted))"""

ORACLES: dict[str, str] = {
    "similar_documents_cosine": similar(
        "cosine", True, "id, document_text, metadata, round(d, 6) AS distance"
    ),
    "similar_documents_euclidean": similar(
        "euclidean", True, "id, document_text, metadata, round(d, 6) AS distance"
    ),
    "similar_documents_with_self": similar("cosine", False, "id, document_text, metadata"),
    "similar_documents_all": self_topk("cosine"),
    "similar_documents_all_blocked": self_topk("euclidean"),
    "ann_topk_all_cells": self_topk("cosine"),
    "ann_topk_given_cells": probed_topk(8, 3),
    "ann_topk_filled": filled_topk(100, 1, 11),
    "table_search": similar(
        "cosine", True, "id, document_text, metadata, round(d, 6) AS distance"
    ),
    "adhoc_similarity": f"""WITH {FIRST_VECTOR}
SELECT e.vec_id AS "index", e.label::VARCHAR AS text,
       round({COSINE.format(a="e.embedding::DOUBLE[]", b="o.vec")}, 6) AS distance
FROM embeddings e, ov o
ORDER BY round({COSINE.format(a="e.embedding::DOUBLE[]", b="o.vec")}, 9), e.vec_id LIMIT 10""",
    "vector_distances": f"""WITH {EMBEDDED}, {DOC_VECTORS}
SELECT e.id, round({COSINE.format(a="e.vec", b="v.vec")}, 6) AS cosine,
       round({EUCLID.format(a="e.vec", b="v.vec")}, 6) AS euclidean
FROM embedded e JOIN dv v USING (id)""",
    "vector_text_roundtrip": """SELECT vec_id, ('[' || array_to_string(embedding, ',') || ']')::FLOAT[] = embedding AS same,
       len(embedding)::BIGINT AS dimensions FROM embeddings""",
    "semantic_topk": semantic("cosine", 10, "id, document_text, metadata"),
    "semantic_topk_distance": semantic(
        "cosine", 10, "id, document_text, metadata, round(d, 6) AS distance"
    ),
    "drop_table": f"""WITH {EMBEDDED}
SELECT id, document_text, true AS dropped, false AS left_over, true AS other_listed FROM embedded""",
    "execute_command": f"""WITH {EMBEDDED}
SELECT id, document_text, (SELECT count(*) FROM embedded) AS affected FROM embedded""",
    "execute_command_cte": f"""WITH {EMBEDDED}
SELECT id, document_text, (SELECT count(*) FROM embedded) AS affected, true AS refused FROM embedded""",
    "insert_twice": f"""WITH {EMBEDDED}
SELECT id, metadata, true AS refused, true AS stamped FROM embedded""",
    "read_documents": "SELECT doc_id, text FROM documents",
    "semantic_threshold": semantic("cosine", 100, "id, document_text, metadata", "WHERE d <= 0.55"),
    "semantic_metric_override": semantic(
        "euclidean", 10, "id, document_text, metadata, round(d, 6) AS distance"
    ),
    "batch_search": f"""WITH {RETRIEVED}
SELECT qid, rn, id, round(d, 6) AS distance FROM ranked WHERE rn <= 10""",
    "text_score": f"""WITH {TEXT_SCORE}
SELECT d.doc_id AS id, round(coalesce(s.match, 0), 6) AS match
FROM documents d LEFT JOIN scores s ON s.id = d.doc_id""",
    "hybrid_search": f"""WITH {STORE}, {DOC_VECTORS}, {FIRST_VECTOR},
{TEXT_SCORE.replace(FIRST + ",", "", 1)},
ranked AS (
  SELECT s.id, s.document_text, s.metadata, coalesce(t.match, 0) AS match,
         {COSINE.format(a="v.vec", b="o.vec")} AS d
  FROM store s JOIN dv v ON v.id = s.id LEFT JOIN scores t ON t.id = s.id, ov o)
SELECT id, document_text, metadata, round(0.3::DOUBLE * (1 - match) + 0.7::DOUBLE * d, 6) AS combined_score
FROM ranked WHERE match > 0 OR d < 1.0
ORDER BY round(0.3::DOUBLE * (1 - match) + 0.7::DOUBLE * d, 9), id LIMIT 10""",
    "metadata_eq_string": f"""WITH {STORE}
SELECT * FROM store WHERE json_extract_string(metadata, '$.lang') = 'de'
ORDER BY created_at DESC, id LIMIT 100""",
    "metadata_eq_number": """SELECT event_id AS id, event_type AS document_text, props AS metadata, ts AS created_at
FROM events WHERE json_extract(props, '$.k')::VARCHAR = '42' ORDER BY ts DESC, event_id LIMIT 100""",
    "metadata_in_list": f"""WITH {STORE}
SELECT * FROM store WHERE json_extract_string(metadata, '$.lang') IN ('fr', 'es')
  AND json_extract_string(metadata, '$.source') IN ('src1', 'src4', 'src9')
ORDER BY created_at DESC, id LIMIT 100""",
    "metadata_promoted": f"""WITH {EMBEDDED}
SELECT id, document_text, metadata FROM embedded WHERE json_extract_string(metadata, '$.lang') IN ('fr', 'es')
  AND json_extract_string(metadata, '$.source') IN ('src1', 'src4', 'src9')""",
    "chunk_documents": chunks(500, 50, CORE_COUNT),
    "chunk_documents_tail": chunks(500, 50, TAIL_COUNT),
    "chunk_documents_wide_overlap": chunks(200, 150, CORE_COUNT),
    "chunk_global_index": chunks(
        500,
        50,
        CORE_COUNT,
        "(base + k)::BIGINT AS chunk_index, position::BIGINT AS original_doc_index,",
    ),
    "sanitize_text": f"SELECT page_id, {CLEAN.format(c='html')} AS clean FROM pages",
    "preview_text": """SELECT doc_id, substring(text, 1, 100) AS head,
  CASE WHEN length(text) > 1000 THEN substring(text, 1, 1000) || '...' ELSE text END AS cut FROM documents""",
    "empty_placeholder": f"""WITH {BLANKED}
SELECT doc_id, CASE WHEN {CLEAN.format(c="text")} = '' THEN '[EMPTY]' ELSE {CLEAN.format(c="text")} END AS encoder_text
FROM blanked""",
    "validate_documents": """SELECT count(*) > 0 AND count(*) FILTER (trim(text) = '') = 0 AS is_valid,
  count(*) AS documents, count(*) FILTER (trim(text) = '') AS invalid,
  min(doc_id) FILTER (trim(text) = '') AS first_invalid, CAST(NULL AS VARCHAR) AS reason FROM documents""",
    "validate_documents_blank": f"""WITH {BLANKED}
SELECT count(*) FILTER (trim(text) = '') = 0 AS is_valid, count(*) AS documents,
  count(*) FILTER (trim(text) = '') AS invalid, min(doc_id) FILTER (trim(text) = '') AS first_invalid,
  'empty' AS reason FROM blanked""",
    "invalid_documents": f"""WITH {BLANKED}
SELECT doc_id, 'empty' AS reason FROM blanked WHERE trim(text) = ''""",
    "processing_stats": f"""SELECT count(*) AS documents_processed,
  sum(CASE WHEN length(text) <= 500 THEN 1 ELSE {CORE_COUNT.format(size=500, step=450)} END)::BIGINT AS chunks_created,
  count(*) FILTER (trim(text) = '') AS errors FROM documents""",
    "processing_run": f"""SELECT count(*) AS documents_processed, c AS chunks_created, c AS embeddings_generated,
  c AS records_inserted, 0::BIGINT AS errors, true AS timed FROM documents, (
    SELECT sum(CASE WHEN length(text) <= 500 THEN 1 ELSE {CORE_COUNT.format(size=500, step=450)} END)::BIGINT AS c
    FROM documents) GROUP BY c""",
    "hash_encode": f"""WITH {DOC_VECTORS}
SELECT id AS doc_id, bucket::INTEGER AS bucket, round(weight, 6) AS weight FROM dv_weights""",
    "encode_batch_udf": f"""WITH {DOC_VECTORS}
SELECT id AS doc_id, bucket::INTEGER AS bucket, round(weight, 6) AS weight FROM dv_all""",
    "rag_context": f"WITH {CONTEXT} SELECT qid, context_text, context_count FROM context",
    "rag_prompt": f"""WITH {CONTEXT}
SELECT qid, {_quoted(DEFAULT_SYSTEM_PROMPT)} || chr(10) || chr(10) || 'Context:' || chr(10) || context_text
  || chr(10) || chr(10) || 'Question: ' || b.text || chr(10) || chr(10) || 'Answer:' AS prompt
FROM context JOIN benchmark b ON b.item_id = qid""",
    "rag_batch": f"""WITH {CONTEXT}
SELECT qid, b.text AS question, trim(split_part(substring(context_text, 14), chr(10), 1)) AS answer,
  context_count, CAST(NULL AS VARCHAR) AS error
FROM context JOIN benchmark b ON b.item_id = qid""",
    "rag_batch_refused": f"""WITH {CONTEXT}
SELECT qid, trim(split_part(substring(context_text, 14), chr(10), 1)) AS answer,
  context_count, CAST(NULL AS VARCHAR) AS error FROM context
UNION ALL
SELECT -1 - conv_id * 2097152 - turn, NULL, 0, 'the question is blank' FROM conversations WHERE role = 'user'""",
    "rag_query": f"""WITH {CONTEXT}
SELECT b.text AS question, trim(split_part(substring(context_text, 14), chr(10), 1)) AS answer, context_count,
  (SELECT string_agg(id::VARCHAR, ',' ORDER BY rn) FROM ranked r WHERE r.qid = c.qid AND rn <= 3) AS ids
FROM context c JOIN benchmark b ON b.item_id = qid WHERE qid = (SELECT min(item_id) FROM benchmark)""",
    "rag_answer_quality": f"""WITH pairs AS (
  SELECT q.conv_id, q.turn, q.text AS question, a.text AS answer, g.text AS truth,
         list_filter([e.text, q.text], lambda x: x IS NOT NULL) AS context
  FROM conversations q
  JOIN conversations a ON a.conv_id = q.conv_id AND a.turn = q.turn + 1 AND a.role = 'assistant'
  LEFT JOIN conversations g ON g.conv_id = q.conv_id AND g.turn = q.turn + 2
  LEFT JOIN conversations e ON e.conv_id = q.conv_id AND e.turn = q.turn - 1
  WHERE q.role = 'user'),
sets AS (
  SELECT *, {WORDS.format(c="question")} AS qw, {WORDS.format(c="answer")} AS aw,
         {WORDS.format(c="array_to_string(context, ' ')")} AS cw, {WORDS.format(c="truth")} AS tw,
         list_sum(list_transform(context, lambda x: length(x)))::BIGINT AS total
  FROM pairs)
SELECT conv_id, turn, length(answer)::INTEGER AS answer_length, len(context)::INTEGER AS context_count,
  total AS context_total_length, round(length(answer) / greatest(total, 1), 6) AS answer_to_context_ratio,
  ({INSUFFICIENT}) AS indicates_insufficient_context,
  round(len(list_intersect(qw, aw)) / greatest(len(qw), 1), 6) AS question_answer_overlap,
  round(len(list_intersect(cw, aw)) / greatest(len(aw), 1), 6) AS context_answer_overlap,
  CASE WHEN truth <> '' THEN round(len(list_intersect(tw, aw)) / greatest(len(tw), 1), 6) END AS ground_truth_overlap
FROM sets""",
    "search_stats": f"""WITH {STORE}
SELECT count(*) AS total_documents, round(avg(length(document_text)), 6) AS avg_text_length,
  min(created_at) AS oldest_document, max(created_at) AS newest_document,
  (SELECT count(*) FROM (SELECT DISTINCT unnest(json_keys(metadata)) AS f FROM store)) AS metadata_field_count,
  (SELECT string_agg(f, ',' ORDER BY f) FROM (SELECT DISTINCT unnest(json_keys(metadata)) AS f FROM store)) AS metadata_fields,
  'unknown' AS table_config FROM store""",
    "metadata_fields": f"""WITH {STORE}
SELECT DISTINCT unnest(json_keys(metadata)) AS field
FROM (SELECT metadata FROM store UNION ALL SELECT props FROM events)""",
    "rag_stats": f"""WITH {STORE}
SELECT 'documents' AS "table", count(*) AS total_documents, round(avg(length(document_text)), 6) AS avg_document_length,
  (SELECT count(*) FROM (SELECT DISTINCT unnest(json_keys(metadata)) AS f FROM store)) AS metadata_field_count,
  (SELECT string_agg(f, ',' ORDER BY f) FROM (SELECT DISTINCT unnest(json_keys(metadata)) AS f FROM store)) AS metadata_fields,
  'cosine' AS distance_metric, 'hash' AS embedding_model, {DIM}::INTEGER AS embedding_dimension FROM store""",
    "insert_embeddings": f"""WITH {EMBEDDED}
SELECT row_number() OVER (ORDER BY id) - 1 AS id, document_text, metadata FROM embedded""",
    "embed_documents": f"""{CHUNK_ROWS}
SELECT row_number() OVER (ORDER BY doc_id, k) - 1 AS id, md5(chunk) AS chunk_md5, doc_id,
  CASE WHEN is_chunk THEN k * 450 END::INTEGER AS chunk_start, {DIM}::INTEGER AS dimensions FROM cut""",
    "embed_documents_stream": f"""{CHUNK_ROWS}
SELECT doc_id * 1048576 + k AS id, md5(chunk) AS chunk_md5, {DIM}::INTEGER AS dimensions FROM cut""",
    "table_info": f"""WITH {EMBEDDED}
SELECT id, substring(document_text, 1, 100) AS preview, (SELECT count(*) FROM embedded) AS row_count,
  6::INTEGER AS columns, {DIM}::INTEGER AS dimensions, 'cosine' AS distance_metric, true AS is_listed
FROM embedded ORDER BY id LIMIT 5""",
    "get_record": f"""WITH {EMBEDDED}
SELECT id, document_text, metadata FROM embedded WHERE id = 7""",
    "delete_records": f"""WITH {EMBEDDED}
SELECT id, document_text, metadata,
  (SELECT count(*) FROM embedded WHERE json_extract_string(metadata, '$.lang') = 'en') AS deleted
FROM embedded WHERE json_extract_string(metadata, '$.lang') IS DISTINCT FROM 'en'""",
    "update_metadata": f"""WITH {EMBEDDED}
SELECT e.id, e.document_text, CASE WHEN e.id = 7 THEN '{{"reviewed": true}}'
  WHEN l.doc_id IS NOT NULL THEN '{{"quality":' || l.quality || ',"toxic":' || l.toxic || '}}'
  ELSE e.metadata END AS metadata
FROM embedded e LEFT JOIN labels l ON l.doc_id = e.id""",
    "optimize_table": f"""WITH {EMBEDDED}
SELECT id, document_text, metadata, 'optimized' AS status,
  (SELECT count(*) FROM embedded) AS row_count FROM embedded""",
    "execute_query": f"""WITH {STORE}
SELECT id, length(document_text)::INTEGER AS characters FROM store
WHERE json_extract_string(metadata, '$.lang') = 'fr'""",
}

ORACLES["text_score_postings"] = ORACLES["text_score"]
ORACLES["hybrid_search_postings"] = ORACLES["hybrid_search"]
ORACLES["similar_pairs"] = f"""WITH v AS (SELECT vec_id AS id, embedding::DOUBLE[] AS vec FROM embeddings)
SELECT a.id AS a, b.id AS b, round(1 - {COSINE.format(a="a.vec", b="b.vec")}, 6) AS similarity
FROM v a JOIN v b ON a.id < b.id WHERE round(1 - {COSINE.format(a="a.vec", b="b.vec")}, 9) >= 0.35"""
