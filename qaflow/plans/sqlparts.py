"""DuckDB SQL fragments for the independent oracles of the registered queries.

Each fragment restates the semantics of one operator in plain SQL over the
pre-registered views (``documents``, ``benchmark``, ``embeddings`` ...).
The Spark side never uses these: they exist to check it.
"""

from __future__ import annotations

from qaflow.functions.text import PUNCT

PUNCT_SQL = PUNCT.replace("'", "''")
STRIDE = 1_000_000


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def clean(x: str) -> str:
    return f"replace({strip(x)}, chr(10), ' ')"


def tok_a(x: str) -> str:
    """F11(F1(x)) as a list."""
    return rf"list_filter(string_split_regex(lower({x}), '\s+'), lambda t: t <> '')"


def norm_a(x: str) -> str:
    return f"array_to_string({tok_a(x)}, ' ')"


def tok_b(x: str) -> str:
    """F11(F2(x)) as a list: articles dropped as whole tokens."""
    return (rf"list_filter(string_split_regex(translate(lower({x}), '{PUNCT_SQL}', ''), '\s+'), "
            "lambda t: t NOT IN ('a', 'an', 'the', ''))")


def norm_b(x: str) -> str:
    return f"array_to_string({tok_b(x)}, ' ')"


def ws_tokens(x: str) -> str:
    s = strip(x)
    return rf"(CASE WHEN {s} = '' THEN []::VARCHAR[] ELSE string_split_regex({s}, '\s+') END)"


def f1_ratio(com: str, n_p: str, n_g: str) -> str:
    return (f"(CASE WHEN ({com}) = 0 THEN 0.0 ELSE 2 * (({com})::DOUBLE / ({n_p})) * (({com})::DOUBLE / ({n_g})) "
            f"/ ((({com})::DOUBLE / ({n_p})) + (({com})::DOUBLE / ({n_g}))) END)")


def f1_set(p: str, g: str) -> str:
    tp, tg = tok_a(p), tok_a(g)
    return f1_ratio(f"len(list_intersect({tp}, {tg}))", f"len({tp})", f"len({tg})")


def bag_overlap(tp: str, tg: str) -> str:
    return (f"coalesce(list_sum(list_transform(list_intersect({tp}, {tg}), lambda w: "
            f"least(len(list_filter({tp}, lambda x: x = w)), len(list_filter({tg}, lambda y: y = w))))), 0)")


def f1_bag(p: str, g: str) -> str:
    tp, tg = tok_b(p), tok_b(g)
    return f1_ratio(bag_overlap(tp, tg), f"len({tp})", f"len({tg})")


# --- shared derived tables ---------------------------------------------------

PASSAGES = rf"""
passages AS (
  SELECT doc_id * {STRIDE} + idx AS passage_id, doc_id, idx, title,
         {strip("array_to_string(list_slice(w, idx * 100 + 1, idx * 100 + 100), ' ')")} AS text
  FROM (SELECT doc_id, title, w,
               unnest(generate_series(0, CAST(ceil(len(w) / 100.0) AS BIGINT) - 1)) AS idx
        FROM (SELECT doc_id, coalesce(source, '') AS title, string_split(text, ' ') AS w
              FROM documents WHERE text IS NOT NULL))
)"""

QUESTIONS = f"""
questions AS (
  SELECT item_id, question, value, golds FROM (
    SELECT item_id, question, value,
           CASE WHEN len(found) = 0 THEN [value] ELSE list_filter(found, lambda x, i: list_position(found, x) = i) END AS golds
    FROM (
      SELECT item_id, {clean("array_to_string(w[1:(len(w) + 1) // 2], ' ')")} AS question,
             {clean("array_to_string(w[(len(w) + 1) // 2 + 1:], ' ')")} AS value,
             list_filter(list_prepend({clean("array_to_string(w[(len(w) + 1) // 2 + 1:], ' ')")},
               list_transform(string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)),
                              lambda x: {clean("x")})), lambda x: x <> '') AS found
      FROM (SELECT item_id, text, string_split(text, ' ') AS w FROM benchmark)))
)"""

QA_PAIRS = f"""
qa_pairs AS (
  SELECT u.conv_id, u.turn, {clean("u.text")} AS question, {clean("a.text")} AS answer,
         a.text AS a_raw
  FROM conversations u JOIN conversations a
    ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant'
)"""


def hash_long(src: str, key: str, text: str, name: str) -> str:
    """F14 long form over ``src``: (key, bucket, weight)."""
    return f"""
{name}_tok AS (
  SELECT {key} AS k, unnest({tok_b(text)}) AS t FROM {src}
),
{name}_long AS (
  SELECT k, CAST(('0x' || substr(md5(t), 1, 8))::BIGINT % 64 AS INTEGER) AS bucket,
         SUM(CASE WHEN substr(md5(t), 9, 1) IN ('8','9','a','b','c','d','e','f') THEN -1 ELSE 1 END) AS w
  FROM {name}_tok GROUP BY ALL
),
{name}_vec AS (
  SELECT ids.k, list(coalesce(l.w, 0)::DOUBLE ORDER BY b.b) AS v
  FROM (SELECT {key} AS k FROM {src}) ids CROSS JOIN range(64) b(b)
  LEFT JOIN {name}_long l ON l.k = ids.k AND l.bucket = b.b
  GROUP BY ids.k
),
{name}_unit AS (
  SELECT k, CASE WHEN n > 0 THEN list_transform(v, lambda x: x / n) ELSE v END AS u
  FROM (SELECT k, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS n FROM {name}_vec)
)"""


def retrieval(k: int) -> str:
    """Exact top-k of benchmark questions over document passages (hash encoder)."""
    return f"""WITH {PASSAGES.strip()},
{QUESTIONS.strip()},
{hash_long("passages", "passage_id", "text", "p").strip()},
{hash_long("questions", "item_id", "question", "q").strip()},
scored AS (
  SELECT q.k AS item_id, p.k AS passage_id, round(list_inner_product(q.u, p.u), 6) AS score
  FROM q_unit q CROSS JOIN p_unit p
),
hits AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, passage_id) AS BIGINT) AS rank,
         passage_id, score
  FROM scored QUALIFY rank <= {k}
)"""


def extractive(question: str, contexts_table: str, key: str = "item_id", prefix: str = "") -> str:
    """U2 stand-in in SQL: best-overlap sentence of the ranked contexts, 25 words.

    ``contexts_table`` has (key, question, contexts list in rank order).
    Sentences end at ``.!?`` followed by whitespace.  CTE names carry
    ``prefix`` so several generator runs fit in one statement; the result
    is ``{prefix}answers(key, prediction)``.
    """
    return f"""
{prefix}sent AS (
  SELECT {key}, i, generate_subscripts(ss, 1) AS j, unnest(ss) AS s, question
  FROM (SELECT {key}, question, i,
               string_split(regexp_replace(c, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)) AS ss
        FROM (SELECT {key}, {question} AS question, unnest(contexts) AS c, generate_subscripts(contexts, 1) AS i
              FROM {contexts_table}))
),
{prefix}best AS (
  SELECT {key}, s FROM (
    SELECT {key}, s, row_number() OVER (PARTITION BY {key}
             ORDER BY len(list_intersect({tok_a("s")}, {tok_a("question")})) DESC, i, j) AS r
    FROM {prefix}sent) WHERE r = 1
),
{prefix}answers AS (
  SELECT t.{key}, CASE WHEN len(coalesce(t.contexts, [])) = 0 THEN '' ELSE
         coalesce(array_to_string(list_slice(string_split_regex({strip("b.s")}, '\\s+'), 1, 25), ' '), '') END
         AS prediction
  FROM {contexts_table} t LEFT JOIN {prefix}best b USING ({key})
)"""


def query_hits(name: str, src: str, key: str, text: str, k: int) -> str:
    """Exact top-k over ``p_unit`` for the texts of ``src``: CTE ``{name}_hits``.

    Requires the ``passages`` and ``p_unit`` CTEs of :func:`retrieval`.
    """
    return f"""{hash_long(src, key, text, name).strip()},
{name}_hits AS (
  SELECT item_id, rank, passage_id, score FROM (
    SELECT q.k AS item_id, p.k AS passage_id, round(list_inner_product(q.u, p.u), 6) AS score,
           CAST(row_number() OVER (PARTITION BY q.k ORDER BY round(list_inner_product(q.u, p.u), 6) DESC, p.k) AS BIGINT) AS rank
    FROM {name}_unit q CROSS JOIN p_unit p) WHERE rank <= {k}
),
{name}_ctx AS (
  SELECT s.{key} AS item_id, s.{text} AS question,
         (SELECT list(p.text ORDER BY h.rank) FROM {name}_hits h JOIN passages p USING (passage_id)
          WHERE h.item_id = s.{key}) AS contexts
  FROM {src} s
)"""


def hit_of(hits: str, key: str = "item_id") -> str:
    """J5 over a hits CTE: (item_id, hit)."""
    return f"""(SELECT q.item_id, coalesce(max(CASE WHEN list_bool_or(list_transform(q.golds, lambda g:
               contains(lower(p.text), {norm_a("g")}))) THEN 1 ELSE 0 END), 0) AS hit
        FROM questions q LEFT JOIN {hits} h USING (item_id) LEFT JOIN passages p USING (passage_id)
        GROUP BY q.item_id)"""
