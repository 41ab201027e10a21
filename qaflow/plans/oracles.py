"""DuckDB oracle SQL, one per registered query (same output columns)."""

from __future__ import annotations

from qaflow.plans import sqlparts as S

ORACLES: dict[str, str] = {}

ORACLES["passages_100w"] = f"""WITH {S.PASSAGES.strip()}
SELECT doc_id, idx, title, text FROM passages"""

ORACLES["lead_chunk_100"] = f"""
SELECT doc_id, array_to_string(list_slice({S.ws_tokens("text")}, 1, 100), ' ') AS text
FROM documents WHERE text IS NOT NULL"""

ORACLES["sliding_chunks_100_20"] = f"""
WITH t AS (SELECT doc_id, {S.ws_tokens("text")} AS w FROM documents WHERE text IS NOT NULL),
x AS (SELECT doc_id, w, unnest(generate_series(0, greatest(len(w) - 20 - 1, 0), 80)) AS st FROM t)
SELECT doc_id, CAST(st // 80 AS BIGINT) AS idx,
       CAST(len(list_slice(w, st + 1, st + 100)) AS BIGINT) AS n_tokens,
       array_to_string(list_slice(w, st + 1, st + 100), ' ') AS text
FROM x"""

ORACLES["dense_passage_ids"] = f"""WITH {S.PASSAGES.strip()}
SELECT CAST(row_number() OVER (ORDER BY doc_id, idx) - 1 AS BIGINT) AS passage_id, doc_id, idx
FROM passages"""

_POS_DOCS = """
pos AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos, count(*) OVER () AS n FROM documents)"""

ORACLES["shards_floor_7"] = f"""WITH {_POS_DOCS.strip()},
s AS (SELECT doc_id, CASE WHEN n // 7 = 0 THEN 6 ELSE least(pos // (n // 7), 6) END AS shard FROM pos)
SELECT CAST(shard AS BIGINT) AS shard, count(*) AS n, min(doc_id) AS min_id, max(doc_id) AS max_id
FROM s GROUP BY shard"""

ORACLES["shards_balanced_7"] = f"""WITH {_POS_DOCS.strip()},
s AS (SELECT doc_id, n // 7 AS q, n % 7 AS r, pos FROM pos),
t AS (SELECT doc_id, CASE WHEN pos < r * (q + 1) THEN pos // (q + 1)
                          ELSE r + (pos - r * (q + 1)) // q END AS shard FROM s)
SELECT CAST(shard AS BIGINT) AS shard, count(*) AS n, min(doc_id) AS min_id, max(doc_id) AS max_id
FROM t GROUP BY shard"""

ORACLES["split_80_10_10"] = """
WITH o AS (SELECT item_id, row_number() OVER (ORDER BY md5('42|' || CAST(item_id AS VARCHAR)), item_id) - 1 AS pos,
                  count(*) OVER () AS n FROM benchmark),
s AS (SELECT item_id, pos, CAST(floor(n * 0.8::DOUBLE) AS BIGINT) AS nt, n FROM o),
l AS (SELECT item_id, CASE WHEN pos < nt THEN 'train' WHEN pos < nt + (n - nt) // 2 THEN 'val'
                           ELSE 'test' END AS split FROM s)
SELECT split, count(*) AS n, CAST(sum(item_id) AS BIGINT) AS key_sum FROM l GROUP BY split"""

ORACLES["train_val_90_10"] = f"""WITH {S.QA_PAIRS.strip()},
k AS (SELECT conv_id, CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR) AS key FROM qa_pairs),
o AS (SELECT conv_id, row_number() OVER (ORDER BY md5('7|' || key), key) - 1 AS pos, count(*) OVER () AS n FROM k),
l AS (SELECT conv_id, CASE WHEN pos < CAST(floor(n * (1 - 0.1)::DOUBLE) AS BIGINT) THEN 'train'
                           ELSE 'validation' END AS split FROM o)
SELECT split, count(*) AS n, CAST(sum(conv_id) AS BIGINT) AS key_sum FROM l GROUP BY split"""

ORACLES["micro_batches_32"] = """
WITH p AS (SELECT text, row_number() OVER (ORDER BY conv_id, turn) - 1 AS pos FROM conversations)
SELECT CAST(pos // 32 AS BIGINT) AS batch, count(*) AS n, round(avg(length(text)), 6) AS mean_len
FROM p GROUP BY pos // 32"""

ORACLES["qa_pairs"] = f"""WITH {S.QA_PAIRS.strip()}
SELECT conv_id, turn, question, answer FROM qa_pairs
WHERE coalesce(length(question), 0) > 0 AND coalesce(length(answer), 0) > 0"""

_GOLD = f"""{S.QA_PAIRS.strip()},
lines AS (SELECT conv_id, turn, question, answer,
                 list_filter(list_transform(string_split(a_raw, chr(10)), lambda x: {S.strip("x")}),
                             lambda x: x <> '') AS ls FROM qa_pairs),
gold AS (SELECT conv_id, turn, question, answer,
                CASE WHEN len(ls) > 1 THEN ls ELSE [answer] END AS golds FROM lines)"""

ORACLES["gold_fallback"] = f"""WITH {_GOLD}
SELECT conv_id, turn, CAST(len(golds) AS BIGINT) AS n_golds, golds[1] AS first_gold,
       array_to_string(golds, '|') AS golds_joined FROM gold"""

ORACLES["em_f1_set"] = f"""WITH {_GOLD}
SELECT conv_id, turn,
       CAST(list_bool_or(list_transform(golds, lambda g: {S.norm_a("g")} = {S.norm_a("question")})) AS BIGINT) AS em,
       round(list_max(list_transform(golds, lambda g: {S.f1_set("question", "g")})), 6) AS f1
FROM gold"""

ORACLES["em_f1_bag"] = f"""WITH {_GOLD}
SELECT conv_id, turn,
       CAST(list_max(list_transform(golds, lambda g: CAST({S.norm_b("g")} = {S.norm_b("question")} AS INTEGER))) AS BIGINT) AS em,
       round(list_max(list_transform(golds, lambda g: {S.f1_bag("question", "g")})), 6) AS f1
FROM gold"""

ORACLES["eval_pct"] = f"""WITH {_GOLD}
SELECT round(100.0 * avg(list_max(list_transform(golds, lambda g: CAST({S.norm_b("g")} = {S.norm_b("question")} AS INTEGER)))), 6) AS em,
       round(100.0 * avg(list_max(list_transform(golds, lambda g: {S.f1_bag("question", "g")}))), 6) AS f1
FROM gold"""

ORACLES["batch_mean_of_means"] = f"""WITH {_GOLD},
s AS (SELECT (row_number() OVER (ORDER BY conv_id, turn) - 1) // 8 AS batch,
             CAST(list_bool_or(list_transform(golds, lambda g: {S.norm_a("g")} = {S.norm_a("question")})) AS DOUBLE) AS em,
             list_max(list_transform(golds, lambda g: {S.f1_set("question", "g")})) AS f1
      FROM gold),
per AS (SELECT batch, sum(em) AS em_s, sum(f1) AS f1_s, count(*) AS n FROM s GROUP BY batch)
SELECT round(coalesce(sum(em_s) / sum(n), 0.0), 6) AS em_mean,
       round(coalesce(avg(em_s / n), 0.0), 6) AS em_mean_of_means,
       round(coalesce(sum(f1_s) / sum(n), 0.0), 6) AS f1_mean,
       round(coalesce(avg(f1_s / n), 0.0), 6) AS f1_mean_of_means
FROM per"""

ORACLES["normalize_a"] = f"""SELECT doc_id, {S.norm_a("text")} AS norm FROM documents WHERE text IS NOT NULL"""
ORACLES["normalize_b"] = f"""SELECT doc_id, {S.norm_b("text")} AS norm FROM documents WHERE text IS NOT NULL"""

ORACLES["unit_vectors"] = """
WITH n AS (SELECT vec_id, embedding::DOUBLE[] AS e,
                  sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))) AS norm FROM embeddings),
u AS (SELECT vec_id, norm, CASE WHEN norm > 0 THEN list_transform(e, lambda x: x / norm)
                                ELSE list_transform(e, lambda x: 0.0) END AS u FROM n)
SELECT vec_id, round(norm, 6) AS norm, round(u[1], 6) AS first, round(list_sum(u), 6) AS coord_sum FROM u"""

ORACLES["exact_top15"] = """
WITH s AS (SELECT q.vec_id AS q_id, c.vec_id AS c_id,
                  round(list_inner_product(q.embedding::DOUBLE[], c.embedding::DOUBLE[]), 6) AS score
           FROM embeddings q CROSS JOIN embeddings c)
SELECT q_id, CAST(row_number() OVER (PARTITION BY q_id ORDER BY score DESC, c_id) AS BIGINT) AS rank, c_id, score
FROM s QUALIFY rank <= 15"""

ORACLES["cell_bounds_top15"] = ORACLES["exact_top15"]

ORACLES["skewed_norm_top15"] = """
WITH scaled AS (SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: x * (100.0::DOUBLE / (1 + vec_id % 211))) AS e FROM embeddings),
s AS (SELECT q.vec_id AS q_id, c.vec_id AS c_id, round(list_inner_product(q.embedding::DOUBLE[], c.e), 6) AS score
      FROM embeddings q CROSS JOIN scaled c)
SELECT q_id, CAST(row_number() OVER (PARTITION BY q_id ORDER BY score DESC, c_id) AS BIGINT) AS rank, c_id, score
FROM s QUALIFY rank <= 15"""

_CENTROIDS = """
long AS (SELECT label AS cell, unnest(generate_series(1, len(embedding))) AS pos,
                unnest(embedding)::DOUBLE AS x FROM embeddings),
cent AS (SELECT cell, list(m ORDER BY pos) AS centroid
         FROM (SELECT cell, pos, avg(x) AS m FROM long GROUP BY cell, pos) GROUP BY cell),
unit AS (SELECT vec_id, embedding::DOUBLE[] AS e,
                list_transform(embedding::DOUBLE[], lambda x: x / sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda y: y * y)))) AS u
         FROM embeddings),
assigned AS (SELECT vec_id, e, cell FROM (
    SELECT vec_id, e, cell, row_number() OVER (PARTITION BY vec_id ORDER BY round(list_inner_product(u, centroid), 6) DESC, cell) AS r
    FROM unit CROSS JOIN cent) WHERE r = 1)"""

ORACLES["label_cells"] = f"""WITH {_CENTROIDS.strip()}
SELECT CAST(cell AS BIGINT) AS cell, count(*) AS n FROM assigned GROUP BY cell"""

ORACLES["ivf_top15_probe3"] = f"""WITH {_CENTROIDS.strip()},
probe AS (SELECT vec_id AS q_id, e AS q, cell FROM (
    SELECT vec_id, e, cell, row_number() OVER (PARTITION BY vec_id ORDER BY round(list_inner_product(e, centroid), 6) DESC, cell) AS r
    FROM unit CROSS JOIN cent) WHERE r <= 3),
s AS (SELECT p.q_id, a.vec_id AS c_id, round(list_inner_product(p.q, a.e), 6) AS score
      FROM probe p JOIN assigned a ON a.cell = p.cell)
SELECT q_id, CAST(row_number() OVER (PARTITION BY q_id ORDER BY score DESC, c_id) AS BIGINT) AS rank, c_id, score
FROM s QUALIFY rank <= 15"""

ORACLES["precision_at_5"] = """
WITH s AS (SELECT q.vec_id AS q_id, q.label AS q_label, c.label,
                  row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_inner_product(q.embedding::DOUBLE[], c.embedding::DOUBLE[]), 6) DESC, c.vec_id) AS r
           FROM embeddings q CROSS JOIN embeddings c),
p AS (SELECT q_id, sum(CASE WHEN label = q_label THEN 1 ELSE 0 END) / 5.0 AS p FROM s WHERE r <= 5 GROUP BY q_id)
SELECT CAST(5 AS BIGINT) AS k, round(100.0 * avg(p), 6) AS precision FROM p"""

ORACLES["hash_encode"] = f"""WITH {S.hash_long("benchmark", "item_id", "text", "b").strip()}
SELECT k AS item_id, CAST(bucket AS BIGINT) AS bucket, CAST(w AS BIGINT) AS weight FROM b_long"""

ORACLES["retrieve_top15"] = f"""{S.retrieval(15)}
SELECT item_id, rank, passage_id, score FROM hits"""

ORACLES["recall_at_15"] = f"""{S.retrieval(15)},
j AS (SELECT h.item_id, max(CASE WHEN list_bool_or(list_transform(q.golds, lambda g: contains(lower(p.text), {S.norm_a("g")}))) THEN 1 ELSE 0 END) AS hit
      FROM hits h JOIN passages p USING (passage_id) JOIN questions q USING (item_id) GROUP BY h.item_id),
a AS (SELECT q.item_id, coalesce(j.hit, 0) AS hit FROM questions q LEFT JOIN j USING (item_id))
SELECT count(*) AS n, CAST(sum(hit) AS BIGINT) AS hits, round(sum(hit) / count(*), 6) AS recall FROM a"""

ORACLES["retrieve_full"] = f"""{S.retrieval(5)}
SELECT h.item_id, CAST(count(*) AS BIGINT) AS n_docs,
       string_agg(CAST(h.passage_id AS VARCHAR), ',' ORDER BY h.rank) AS ids,
       string_agg(p.title, ',' ORDER BY h.rank) AS titles,
       round(sum(h.score), 6) AS score_sum,
       round(sum(u.u[1]), 6) AS emb1_sum
FROM hits h JOIN passages p USING (passage_id) JOIN p_unit u ON u.k = h.passage_id
GROUP BY h.item_id"""

_CTX5 = f"""{S.retrieval(5)},
ctx AS (SELECT h.item_id, list(p.text ORDER BY h.rank) AS contexts
        FROM hits h JOIN passages p USING (passage_id) GROUP BY h.item_id)"""

ORACLES["train_source"] = f"""{_CTX5}
SELECT q.item_id, '' || (q.question || ' ' || array_to_string(coalesce(c.contexts, []), ' ')) AS src,
       q.golds[1] AS tgt
FROM questions q LEFT JOIN ctx c USING (item_id)"""

ORACLES["qa_prompt"] = f"""{_CTX5}
SELECT q.item_id,
       'answer_question: ' || q.question ||
         CASE WHEN len(coalesce(c.contexts, [])) > 0 THEN
           ' context: ' || array_to_string(list_transform(c.contexts, lambda x, i: '[' || CAST(i AS VARCHAR) || '] ' || x), ' ')
         ELSE '' END AS prompt,
       'Query: ' || q.question || chr(10) || 'Context: ' || c.contexts[1] || chr(10) || 'Score:' AS rr_prompt,
       q.question || ' ' || q.golds[1] AS expanded
FROM questions q LEFT JOIN ctx c USING (item_id)"""

ORACLES["bucketed_lookup"] = f"""{S.retrieval(15)}
SELECT h.item_id, h.rank, h.passage_id, p.title, md5(p.text) AS text_md5 FROM hits h JOIN passages p USING (passage_id)"""

ORACLES["rerank_6"] = f"""{S.retrieval(15)},
s AS (SELECT h.item_id, h.rank, h.passage_id, p.text,
             round({S.f1_set("q.question", "p.text")}, 6) AS rr_score
      FROM hits h JOIN passages p USING (passage_id) JOIN questions q USING (item_id))
SELECT item_id, rr_rank AS rank, passage_id, rr_score FROM (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY rr_score DESC, text DESC, rank) AS BIGINT) AS rr_rank,
         passage_id, rr_score FROM s)
WHERE rr_rank <= 6"""

ORACLES["provenance_lines"] = f"""{S.retrieval(5)}
SELECT h.item_id, string_agg(regexp_replace(p.title, '^"|"$', '', 'g'), chr(9) ORDER BY h.rank) AS provenance
FROM hits h JOIN passages p USING (passage_id) GROUP BY h.item_id"""

ORACLES["char_lengths"] = """
SELECT lang, count(*) AS n, CAST(min(length(text)) AS BIGINT) AS min_len, round(avg(length(text)), 6) AS avg_len,
       CAST(max(length(text)) AS BIGINT) AS max_len
FROM documents GROUP BY lang"""

ORACLES["gold_literal_roundtrip"] = f"""WITH {S.QUESTIONS.strip()}
SELECT CAST(row_number() OVER (ORDER BY item_id) - 1 AS BIGINT) AS line_no, CAST(len(golds) + 2 AS BIGINT) AS n, golds[1] AS first,
       'it' || chr(39) || 's "' || golds[1] || '"' AS quotes,
       'a\\n' || golds[1] || chr(10) || chr(9) || chr(39) || 'end' || chr(39) AS breaks
FROM questions"""

ORACLES["line_breaks_roundtrip"] = """
SELECT CAST(row_number() OVER (ORDER BY conv_id, turn) - 1 AS BIGINT) AS line_no, role, conv_id, md5(text) AS text_md5 FROM conversations"""

ORACLES["jsonl_roundtrip"] = f"""{S.retrieval(5)},
ctx AS (SELECT h.item_id, list(p.text ORDER BY h.rank) AS contexts
        FROM hits h JOIN passages p USING (passage_id) GROUP BY h.item_id)
SELECT count(*) AS n, CAST(sum(len(coalesce(c.contexts, []))) AS BIGINT) AS n_contexts,
       CAST(sum(coalesce(list_sum(list_transform(c.contexts, lambda x: length(x))), 0)) AS BIGINT) AS ctx_chars,
       CAST(sum(length(q.golds[1])) AS BIGINT) AS answer_chars,
       CAST(sum(length(q.question)) AS BIGINT) AS question_chars
FROM questions q LEFT JOIN ctx c USING (item_id)"""

ORACLES["line_files_roundtrip"] = f"""WITH {S.QA_PAIRS.strip()},
k AS (SELECT *, CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR) AS key FROM qa_pairs),
o AS (SELECT *, row_number() OVER (ORDER BY md5('42|' || key), key) - 1 AS pos, count(*) OVER () AS n FROM k),
s AS (SELECT *, CAST(floor(n * 0.8::DOUBLE) AS BIGINT) AS nt FROM o),
l AS (SELECT question, answer, CASE WHEN pos < nt THEN 'train' WHEN pos < nt + (n - nt) // 2 THEN 'val'
                                    ELSE 'test' END AS split FROM s)
SELECT split, count(*) AS n, CAST(sum(length(question)) AS BIGINT) AS src_chars,
       CAST(sum(length(answer)) AS BIGINT) AS tgt_chars
FROM l WHERE length(question) > 0 AND length(answer) > 0 GROUP BY split"""

ORACLES["passages_roundtrip"] = f"""WITH {S.PASSAGES.strip()}
SELECT count(*) AS n, count(DISTINCT title) AS n_titles, CAST(sum(length(text)) AS BIGINT) AS text_chars,
       CAST(sum(idx) AS BIGINT) AS idx_sum FROM passages"""

ORACLES["vector_shards_roundtrip"] = """
WITH p AS (SELECT vec_id, embedding, row_number() OVER (ORDER BY vec_id) - 1 AS pos, count(*) OVER () AS n FROM embeddings),
s AS (SELECT *, CASE WHEN n // 4 = 0 THEN 3 ELSE least(pos // (n // 4), 3) END AS shard FROM p)
SELECT CAST(shard AS BIGINT) AS shard, count(*) AS n, CAST(sum(vec_id) AS BIGINT) AS id_sum,
       round(sum(embedding[1]::DOUBLE), 6) AS first_sum, CAST(0 AS BIGINT) AS unpaired
FROM s GROUP BY shard"""

_FINAL = f"""WITH {S.PASSAGES.strip()}
SELECT CAST({{v}} AS BIGINT) AS version, count(*) AS n, CAST(sum(passage_id) AS BIGINT) AS checksum,
       count(DISTINCT doc_id) AS n_docs FROM passages"""
ORACLES["refresh_swap"] = _FINAL.format(v=2)
ORACLES["refresh_stream"] = _FINAL.format(v=4)

ORACLES["stream_upserts"] = """
SELECT doc_id, source, CAST(1700000002 AS BIGINT) AS at, md5('v2 ' || text) AS text_md5 FROM documents WHERE text IS NOT NULL"""

def _feistel(x: str, key: str) -> str:
    """Four rounds over the digits of ``x``: even ones add a hash of the right digit to the left, odd ones the other way."""
    return f"""list_reduce([0, 1, 2, 3], lambda p, i: CASE WHEN i % 2 = 0
        THEN ((p // b + ('0x' || substr(md5({key} || '|' || i || '|' || (p % b)), 1, 8))::BIGINT % a) % a) * b + p % b
        ELSE (p // b) * b + (p % b + ('0x' || substr(md5({key} || '|' || i || '|' || (p // b)), 1, 8))::BIGINT % b) % b END, {x})"""


ORACLES["shuffle_epoch"] = f"""
WITH RECURSIVE m AS (SELECT max(doc_id) + 1 AS n FROM documents),
r AS (SELECT n, a, -(-n // a) AS b FROM (SELECT n, CAST(ceil(sqrt(n::DOUBLE)) AS BIGINT) AS a FROM m)),
w AS (
  SELECT epoch, doc_id, n, a, CAST(ceil(n / a::DOUBLE) AS BIGINT) AS b, doc_id AS x, 0 AS step
  FROM documents, r, (SELECT unnest([0, 1])::BIGINT AS epoch)
  UNION ALL
  SELECT epoch, doc_id, n, a, b, {_feistel("x", "(42 * 1000003 + epoch)")}, step + 1
  FROM w WHERE step = 0 OR x >= n
)
SELECT epoch, doc_id, x // 32 AS batch, x % 32 AS slot FROM w WHERE step > 0 AND x < n"""

_B = f"""WITH {S.QUESTIONS.strip()},
b AS (SELECT item_id, {S.tok_a("x.text")} AS st, {S.tok_a("q.value")} AS tt
      FROM benchmark x JOIN questions q USING (item_id)),
w AS (SELECT DISTINCT t FROM (SELECT unnest(st) AS t FROM b UNION ALL SELECT unnest(tt) AS t FROM b)),
v AS (SELECT t, dense_rank() OVER (ORDER BY t) + 3 AS id FROM w),
se AS (SELECT item_id, list(v.id ORDER BY p) AS ids FROM
        (SELECT item_id, unnest(st) AS t, generate_subscripts(st, 1) AS p FROM b) JOIN v USING (t) GROUP BY item_id),
te AS (SELECT item_id, list(v.id ORDER BY p) AS ids FROM
        (SELECT item_id, unnest(tt) AS t, generate_subscripts(tt, 1) AS p FROM b) JOIN v USING (t) GROUP BY item_id),
e AS (SELECT b.item_id,
             list_slice(list_concat(coalesce(se.ids, []), [1]), 1, 64) AS s,
             list_slice(list_concat(coalesce(te.ids, []), [1]), 1, 8) AS t
      FROM b LEFT JOIN se USING (item_id) LEFT JOIN te USING (item_id)),
r AS (SELECT (row_number() OVER (ORDER BY item_id) - 1) // 8 AS batch, s, t,
             list_concat(t, list_transform(range(8 - len(t)), lambda x: 0)) AS tp FROM e)"""

ORACLES["encode_pad_trim"] = _B + """
SELECT CAST(batch AS BIGINT) AS batch, count(*) AS n, CAST(max(len(s)) AS BIGINT) AS width,
       CAST(sum(len(s) + len(t)) AS BIGINT) AS tokens,
       CAST(sum(list_sum(s)) AS BIGINT) AS src_id_sum,
       CAST(sum(len(s)) AS BIGINT) AS mask_sum,
       CAST(sum(3 + coalesce(list_sum(list_slice(tp, 1, 7)), 0)) AS BIGINT) AS dec_sum,
       CAST(sum(list_sum(tp)) AS BIGINT) AS label_sum
FROM r GROUP BY batch"""

_NUM = r"^[+-]?([0-9](_?[0-9])*(\.([0-9](_?[0-9])*)?)?|\.[0-9](_?[0-9])*)([eE][+-]?[0-9](_?[0-9])*)?$"


def _parse(x: str) -> str:
    s = S.strip(x)
    return (f"(CASE WHEN regexp_full_match({s}, '{_NUM}') AND NOT isnan(TRY_CAST(replace({s}, '_', '') AS DOUBLE)) "
            f"THEN TRY_CAST(replace({s}, '_', '') AS DOUBLE) "
            f"WHEN lower({s}) IN ('inf', '+inf', 'infinity', '+infinity') THEN 'inf'::DOUBLE "
            f"WHEN lower({s}) IN ('-inf', '-infinity') THEN '-inf'::DOUBLE ELSE 0.0 END)")


ORACLES["parse_scores"] = f"""
WITH v AS (
  SELECT 'event_k' AS src, event_id AS key, json_extract_string(props, '$.k') AS s FROM events
  UNION ALL SELECT 'doc_word', doc_id * 1000000 + generate_subscripts(string_split(text, ' '), 1) - 1,
                   unnest(string_split(text, ' ')) FROM documents
  UNION ALL SELECT 'doc_us', doc_id, CAST(n_chars AS VARCHAR) || '_5' FROM documents
  UNION ALL SELECT 'doc_d', doc_id, CAST(n_chars AS VARCHAR) || 'd' FROM documents
  UNION ALL SELECT 'doc_frac', doc_id, ' .' || CAST(n_chars AS VARCHAR) || 'e-2 ' FROM documents)
SELECT src, key, round({_parse("s")}, 6) AS score FROM v"""

ORACLES["best_checkpoint"] = """
WITH h AS (SELECT CAST(trunc(doc_id / 25) AS BIGINT) AS step, avg(quality) AS quality, avg(toxic) AS toxic
           FROM labels GROUP BY 1),
l AS (SELECT 'quality' AS metric, step, quality AS v, 1.0 AS sg FROM h
      UNION ALL SELECT 'toxic', step, toxic, -1.0 FROM h),
x AS (SELECT metric, step, v * sg AS sv,
             max(v * sg) OVER (PARTITION BY metric ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pb
      FROM l),
y AS (SELECT metric, step, sum(CASE WHEN pb IS NULL OR sv > pb THEN 1 ELSE 0 END)
             OVER (PARTITION BY metric ORDER BY step ROWS UNBOUNDED PRECEDING) AS grp FROM x),
z AS (SELECT metric, step, row_number() OVER (PARTITION BY metric, grp ORDER BY step) - 1 AS since FROM y),
stop AS (SELECT metric, min(step) AS stopped_at FROM z WHERE since >= 3 GROUP BY metric),
best AS (SELECT metric, step AS best_step, sv * (CASE WHEN metric = 'quality' THEN 1.0 ELSE -1.0 END) AS best
         FROM (SELECT *, row_number() OVER (PARTITION BY metric ORDER BY sv DESC, step) AS r FROM x) WHERE r = 1)
SELECT b.metric, b.best_step, round(b.best, 6) AS best, s.stopped_at
FROM best b LEFT JOIN stop s USING (metric)"""

ORACLES["counts"] = f"""WITH {S.PASSAGES.strip()}, {S.QUESTIONS.strip()}, {S.QA_PAIRS.strip()}
SELECT 'documents' AS item, count(*) AS n FROM documents
UNION ALL SELECT 'passages', count(*) FROM passages
UNION ALL SELECT 'questions', count(*) FROM questions
UNION ALL SELECT 'qa_pairs', count(*) FROM qa_pairs
UNION ALL SELECT 'vectors', count(*) FROM embeddings"""

ORACLES["token_report"] = f"""WITH {S.PASSAGES.strip()},
pt AS (SELECT doc_id, sum(len({S.ws_tokens("text")})) AS nt FROM passages GROUP BY doc_id),
d AS (SELECT d.lang, coalesce(pt.nt, 0) AS nt FROM documents d LEFT JOIN pt USING (doc_id) WHERE d.text IS NOT NULL)
SELECT lang, count(*) AS n_docs, round(avg(nt), 6) AS mean_tokens, CAST(sum(nt) AS BIGINT) AS total_tokens,
       round(count(*) / 4.0 * 3, 6) AS steps
FROM d GROUP BY lang"""

ORACLES["answers_base"] = f"""{S.retrieval(15)},
ctx AS (SELECT q.item_id, q.question, list(p.text ORDER BY h.rank) AS contexts
        FROM hits h JOIN passages p USING (passage_id) JOIN questions q USING (item_id)
        GROUP BY q.item_id, q.question),
{S.extractive("question", "ctx").strip()},
hit AS (SELECT h.item_id, max(CASE WHEN list_bool_or(list_transform(q.golds, lambda g: contains(lower(p.text), {S.norm_a("g")}))) THEN 1 ELSE 0 END) AS hit
        FROM hits h JOIN passages p USING (passage_id) JOIN questions q USING (item_id) GROUP BY h.item_id)
SELECT a.item_id, a.prediction,
       CAST(list_bool_or(list_transform(q.golds, lambda g: {S.norm_a("g")} = {S.norm_a("a.prediction")})) AS BIGINT) AS em,
       round(list_max(list_transform(q.golds, lambda g: {S.f1_set("a.prediction", "g")})), 6) AS f1,
       CAST(coalesce(hit.hit, 0) AS BIGINT) AS hit
FROM answers a JOIN questions q USING (item_id) LEFT JOIN hit USING (item_id)"""

ORACLES["provenance_precision"] = f"""{S.retrieval(15)},
t AS (SELECT h.item_id, h.rank, regexp_replace(p.title, '^"|"$', '', 'g') AS title,
             list_bool_or(list_transform(q.golds, lambda g: contains(lower(p.text), {S.norm_a("g")}))) AS rel
      FROM hits h JOIN passages p USING (passage_id) JOIN questions q USING (item_id)),
per AS (SELECT item_id,
               list_distinct(list(title ORDER BY rank) FILTER (WHERE rank <= 5)) AS hyp,
               list_distinct(coalesce(list(title ORDER BY rank) FILTER (WHERE rel), [])) AS ref
        FROM t GROUP BY item_id)
SELECT CAST(5 AS BIGINT) AS k, count(*) AS n,
       round(100.0 * avg(len(list_intersect(hyp, ref)) / 5.0), 6) AS precision
FROM questions q LEFT JOIN per USING (item_id)"""

ORACLES["eval_e2e_pct"] = f"""{S.retrieval(15)},
ctx AS (SELECT q.item_id, q.question, list(p.text ORDER BY h.rank) AS contexts
        FROM hits h JOIN passages p USING (passage_id) JOIN questions q USING (item_id)
        GROUP BY q.item_id, q.question),
{S.extractive("question", "ctx").strip()}
SELECT round(100.0 * avg(CASE WHEN {S.norm_b("a.prediction")} = {S.norm_b("q.golds[1]")} THEN 1 ELSE 0 END), 6) AS em,
       round(100.0 * avg({S.f1_bag("a.prediction", "q.golds[1]")}), 6) AS f1
FROM answers a JOIN questions q USING (item_id)"""

# --- answering modes ------------------------------------------------------------

_CTX = """
{name} AS (SELECT q.item_id, q.question,
                  (SELECT list(p.text ORDER BY h.rank) FROM hits h JOIN passages p USING (passage_id)
                   WHERE h.item_id = q.item_id AND h.rank <= {k}) AS contexts
           FROM questions q)"""


def _iter_chain() -> str:
    """R4 in SQL: round 0 over the base contexts, round 1 over the expanded query."""
    return f"""{_CTX.format(name="ctx", k=15).strip()},
{S.extractive("question", "ctx", prefix="r0_").strip()},
q1 AS (SELECT c.item_id, c.question || ' ' || a.prediction AS query FROM ctx c JOIN r0_answers a USING (item_id)),
{S.query_hits("h1", "q1", "item_id", "query", 15)},
{S.extractive("question", "h1_ctx", prefix="r1_").strip()}"""


ORACLES["iterate_2"] = f"""{S.retrieval(15)},
{_iter_chain()}
SELECT item_id, CAST(0 AS BIGINT) AS round, c.question AS query, a.prediction AS answer
FROM ctx c JOIN r0_answers a USING (item_id)
UNION ALL
SELECT item_id, CAST(1 AS BIGINT), c.question, a.prediction FROM h1_ctx c JOIN r1_answers a USING (item_id)"""

ORACLES["stream_answers"] = f"""{S.retrieval(15)},
{_CTX.format(name="ctx5", k=5).strip()},
{S.extractive("question", "ctx5", prefix="g5_").strip()}
SELECT item_id, prediction, (SELECT count(*) FROM benchmark) AS all_answered FROM g5_answers"""

_EM = f"""CAST(list_bool_or(list_transform(q.golds, lambda g: {S.norm_a("g")} = {S.norm_a("m.prediction")})) AS INTEGER)"""
_F1 = f"""coalesce(list_max(list_transform(q.golds, lambda g: {S.f1_set("m.prediction", "g")})), 0.0)"""

ORACLES["six_modes"] = f"""{S.retrieval(15)},
{_iter_chain()},
q2 AS (SELECT c.item_id, c.question || ' ' || a.prediction AS query FROM h1_ctx c JOIN r1_answers a USING (item_id)),
{S.query_hits("h2", "q2", "item_id", "query", 15)},
lead AS (SELECT item_id, coalesce(array_to_string(list_slice(string_split_regex({S.strip("contexts[1]")}, '\\s+'), 1, 25), ' '), '')
                AS prediction FROM ctx),
rr_s AS (SELECT h.item_id, h.rank, p.text, round({S.f1_set("q.question", "p.text")}, 6) AS rr_score
         FROM hits h JOIN passages p USING (passage_id) JOIN questions q USING (item_id)),
rr AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY rr_score DESC, text DESC, rank) AS rr_rank
                      FROM rr_s) WHERE rr_rank <= 6),
rr_ctx AS (SELECT q.item_id, q.question, (SELECT list(text ORDER BY rr_rank) FROM rr WHERE rr.item_id = q.item_id) AS contexts
           FROM questions q),
{S.extractive("question", "rr_ctx", prefix="rr_").strip()},
rr_hit AS (SELECT q.item_id, coalesce(max(CASE WHEN list_bool_or(list_transform(q.golds, lambda g: contains(lower(rr.text), {S.norm_a("g")}))) THEN 1 ELSE 0 END), 0) AS hit
           FROM questions q LEFT JOIN rr USING (item_id) GROUP BY q.item_id),
{_CTX.format(name="ctx5", k=5).strip()},
{S.extractive("question", "ctx5", prefix="g5_").strip()},
base_hit AS {S.hit_of("hits")},
iter_hit AS {S.hit_of("h2_hits")},
preds AS (
  SELECT 'base' AS mode, a.item_id, a.prediction, h.hit FROM r0_answers a JOIN base_hit h USING (item_id)
  UNION ALL SELECT 'lora', l.item_id, l.prediction, h.hit FROM lead l JOIN base_hit h USING (item_id)
  UNION ALL SELECT 'rerank', a.item_id, a.prediction, h.hit FROM rr_answers a JOIN rr_hit h USING (item_id)
  UNION ALL SELECT 'iter', a.item_id, a.prediction, h.hit FROM r1_answers a JOIN iter_hit h USING (item_id)
  UNION ALL SELECT 'gen_only', item_id, '', 0 FROM questions
  UNION ALL SELECT 'rag', a.item_id, a.prediction, 0 FROM g5_answers a)
SELECT m.mode, count(*) AS n, round(avg({_EM}), 6) AS em, round(avg({_F1}), 6) AS f1,
       round(sum(m.hit) / count(*), 6) AS recall
FROM preds m JOIN questions q USING (item_id) GROUP BY m.mode"""

ORACLES["lsh_top15_recall"] = """
WITH planes AS (
  SELECT a.p, list(('0x' || substr(md5(CAST(a.p AS VARCHAR) || '|' || CAST(b.j AS VARCHAR)), 1, 8))::BIGINT
                   / 2147483648.0 - 1.0 ORDER BY b.j) AS w
  FROM range(32) a(p) CROSS JOIN range(64) b(j) GROUP BY a.p),
bits AS (SELECT e.vec_id, pl.p, CASE WHEN list_inner_product(e.embedding::DOUBLE[], pl.w) >= 0 THEN 1 ELSE 0 END AS bit
         FROM embeddings e CROSS JOIN planes pl),
bands AS (SELECT vec_id, (p // 4) * 16 + sum(bit * (1 << (p % 4))) AS g FROM bits GROUP BY vec_id, p // 4),
cand AS (SELECT DISTINCT a.vec_id AS q_id, b.vec_id AS c_id FROM bands a JOIN bands b USING (g)),
sc AS (SELECT c.q_id, c.c_id, round(list_inner_product(q.embedding::DOUBLE[], d.embedding::DOUBLE[]), 6) AS score
       FROM cand c JOIN embeddings q ON q.vec_id = c.q_id JOIN embeddings d ON d.vec_id = c.c_id),
approx AS (SELECT q_id, c_id FROM sc QUALIFY row_number() OVER (PARTITION BY q_id ORDER BY score DESC, c_id) <= 15),
ex AS (SELECT q_id, c_id FROM (
         SELECT q.vec_id AS q_id, c.vec_id AS c_id,
                round(list_inner_product(q.embedding::DOUBLE[], c.embedding::DOUBLE[]), 6) AS score
         FROM embeddings q CROSS JOIN embeddings c)
       QUALIFY row_number() OVER (PARTITION BY q_id ORDER BY score DESC, c_id) <= 15),
per AS (SELECT e.q_id, count(a.c_id) AS h FROM ex e LEFT JOIN approx a USING (q_id, c_id) GROUP BY e.q_id)
SELECT round(sum(h) / (count(*) * 15.0), 6) AS recall, count(*) AS n_queries FROM per"""

# LCS by dynamic programming over the longer token list; each DP row is the
# prefix maximum of the per-position candidates (match: diagonal + 1, else above).
ORACLES["rouge_l"] = f"""WITH RECURSIVE {S.QA_PAIRS.strip()},
tk AS (SELECT conv_id, turn, regexp_extract_all(lower(answer), '[a-z0-9]+') AS tp,
              regexp_extract_all(lower(question), '[a-z0-9]+') AS tr FROM qa_pairs),
pr AS (SELECT conv_id, turn, tp, tr,
              CASE WHEN len(tp) <= len(tr) THEN tp ELSE tr END AS a,
              CASE WHEN len(tp) <= len(tr) THEN tr ELSE tp END AS b FROM tk),
dp AS (
  SELECT conv_id, turn, 0 AS j, list_transform(range(len(a) + 1), lambda x: 0) AS r FROM pr
  UNION ALL
  SELECT d.conv_id, d.turn, d.j + 1,
         list_prepend(0, list_transform(range(1, len(p.a) + 1), lambda i:
             list_max(list_transform(range(1, i + 1), lambda t:
                 CASE WHEN p.a[t] = p.b[d.j + 1] THEN d.r[t] + 1 ELSE d.r[t + 1] END))))
  FROM dp d JOIN pr p ON p.conv_id = d.conv_id AND p.turn = d.turn
  WHERE d.j < len(p.b)
),
lcs AS (SELECT p.conv_id, p.turn, p.tp, p.tr, coalesce(d.r[-1], 0) AS l
        FROM pr p LEFT JOIN dp d ON d.conv_id = p.conv_id AND d.turn = p.turn AND d.j = len(p.b))
SELECT conv_id, turn,
       round(CASE WHEN l = 0 THEN 0.0
                  ELSE 2 * (l / len(tp)) * (l / len(tr)) / ((l / len(tp)) + (l / len(tr))) END, 6) AS rouge_l
FROM lcs"""

# --- inputs, limits and conversions; several checkpoints; supplied predictions ---------------

ORACLES["corpus_subsets"] = f"""WITH {S.PASSAGES.strip()}
SELECT d.lang AS subset, count(DISTINCT d.doc_id) AS n, true AS in_files,
       count(p.doc_id) AS n_passages, CAST(sum(length(p.text)) AS BIGINT) AS chars
FROM documents d LEFT JOIN passages p USING (doc_id) WHERE d.lang IN ('de', 'fr') GROUP BY d.lang"""

ORACLES["qa_head"] = f"""WITH {S.QUESTIONS.strip()},
head AS (SELECT item_id, question FROM questions WHERE item_id % 2 <> 0 ORDER BY question LIMIT 20),
last AS (SELECT item_id FROM head ORDER BY question DESC LIMIT 5)
SELECT item_id, question, item_id IN (SELECT item_id FROM last) AS last FROM head"""

ORACLES["vectors_as_double"] = """
SELECT vec_id, CAST(len(embedding) AS BIGINT) AS dim,
       round(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x)), 6) AS squares FROM embeddings"""

ORACLES["decoded_answers"] = f"""
WITH t AS (SELECT conv_id, turn, list_transform(string_split(text, chr(10)), lambda x: {S.strip("x")}) AS lines FROM conversations)
SELECT conv_id, turn, 'answer: ' || array_to_string(lines[1:3], ' | ') AS text,
       round((SELECT avg(len(lines)) FROM t), 6) AS mean_lines FROM t"""

ORACLES["exploded_words"] = r"""
SELECT item_id, word, count(*) AS n FROM (SELECT item_id, unnest(string_split_regex(text, '\s+')) AS word FROM benchmark)
WHERE word <> '' GROUP BY item_id, word"""

ORACLES["checkpoint_sweep"] = f"""WITH {_GOLD},
p AS (SELECT CAST(i - 1 AS BIGINT) AS checkpoint, golds, array_to_string(list_slice(string_split(golds[1], ' '), 1, 5 * i), ' ') AS prediction
      FROM gold, (SELECT unnest([1, 2, 3, 4, 5]) AS i)),
s AS (SELECT checkpoint, CAST(list_bool_or(list_transform(golds, lambda g: {S.norm_a("g")} = {S.norm_a("prediction")})) AS INTEGER) AS em,
             coalesce(list_max(list_transform(golds, lambda g: {S.f1_set("prediction", "g")})), 0.0) AS f1 FROM p)
SELECT checkpoint, 'lead' AS mode, count(*) AS n, round(avg(em), 6) AS em, round(avg(f1), 6) AS f1, round(sum(em) / count(*), 6) AS recall
FROM s GROUP BY checkpoint"""

ORACLES["rag_supplied"] = f"""WITH {S.QUESTIONS.strip()},
m AS (SELECT 'rag' AS mode, item_id, golds[-1] AS prediction FROM questions UNION ALL SELECT 'gen_only', item_id, '' FROM questions)
SELECT m.mode, count(*) AS n, round(avg({_EM}), 6) AS em, round(avg({_F1}), 6) AS f1, CAST(0 AS DOUBLE) AS recall
FROM m JOIN questions q USING (item_id) GROUP BY m.mode"""

ORACLES["metrics_history"] = f"""WITH {_GOLD},
e AS (SELECT 0 AS step, golds, question AS prediction FROM gold UNION ALL SELECT 1, golds, answer FROM gold)
SELECT CAST(step AS BIGINT) AS step, count(*) AS n,
       CAST(max(CAST(list_bool_or(list_transform(golds, lambda g: {S.norm_a("g")} = {S.norm_a("prediction")})) AS INTEGER)) AS BIGINT) AS best_em
FROM e GROUP BY step"""

ORACLES["trained_cells"] = """
SELECT least(8, count(DISTINCT embedding)) AS cells, least(8, count(DISTINCT embedding)) AS close FROM embeddings"""
