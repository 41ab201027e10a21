"""Retrieval, lookup, re-ranking and the answering modes.

Data flow of one mode: questions --embed--> top-k join (J4) --lookup (J1)-->
contexts per question (bounded by k) --generator (U2)--> prediction --score.
Every step is keyed by the question id; the only per-question collection is
the k contexts, never an unbounded group.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qaflow.functions import text as T
from qaflow.operators import chunk, models, prep, vectors

# Passage key = doc_id * PASSAGE_STRIDE + idx: a total order equal to
# (doc_id, idx) without a global numbering job.  A document of more passages
# fails the query, so keys never collide silently.
PASSAGE_STRIDE = 1_000_000


def passage_key(doc_id="doc_id", idx="idx") -> Column:
    fits = F.assert_true(F.coalesce(T._c(idx) < PASSAGE_STRIDE, F.lit(True)), f"a document has more than {PASSAGE_STRIDE} parts")
    return F.when(fits.isNull(), (T._c(doc_id).cast("bigint") * PASSAGE_STRIDE + T._c(idx)).cast("bigint"))


# ---------------------------------------------------------------------------
# Inputs derived from the given tables
# ---------------------------------------------------------------------------

def corpus_passages(documents: DataFrame, n: int = 100) -> DataFrame:
    """Documents as a KB: ``title := source``; C1 passages with a passage key."""
    kb = documents.select("doc_id", F.col("source").alias("title"), "text")
    return chunk.split_passages(kb, n).withColumn("passage_id", passage_key()) \
        .select("passage_id", "doc_id", "idx", "title", "text")


def benchmark_questions(benchmark: DataFrame) -> DataFrame:
    """QA records from ``benchmark``: the first half of a text's words asks (the longer
    half, if they differ), the second half answers, so no word is lost.

    Shape of the reference QA record: ``question``, ``answer{aliases,value}``
    with ``golds`` (P4) resolved.  ``value`` is the second half; each whole sentence
    of the text is an alias after it, since an answer that quotes the item is right.
    """
    def record(words):
        ask = F.ceil(F.size(words) / 2).cast("int")
        value = T.clean_question(F.array_join(F.slice(words, ask + 1, F.size(words) - ask), " "))
        sentences = F.transform(F.split(F.col("text"), models.SENTENCE_SPLIT, -1), lambda x: T.clean_question(x))
        return F.struct(
            T.clean_question(F.array_join(F.slice(words, 1, ask), " ")).alias("question"),
            F.struct(F.array_distinct(F.filter(F.concat(F.array(value), sentences), lambda x: x != "")).alias("aliases"),
                     value.alias("value")).alias("answer"))

    return benchmark.select("item_id", T.let(F.split(F.col("text"), " ", -1), record).alias("r")) \
        .select("item_id", "r.question", "r.answer").withColumn("golds", prep.gold_list("answer"))


def qa_pairs(conversations: DataFrame) -> DataFrame:
    """A user turn and the assistant turn right after it (S6-style pairing).

    An equi-join on the unique ``(conv_id, turn)`` key: no window over a
    conversation, so one very long conversation cannot become one task.
    """
    u = conversations.where(F.col("role") == "user").select(
        "conv_id", "turn", F.col("text").alias("q_text"))
    a = conversations.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("a_text"))
    return u.join(a, ["conv_id", "turn"]).select(
        "conv_id", "turn", T.clean_question("q_text").alias("question"),
        T.clean_question("a_text").alias("answer"))


# ---------------------------------------------------------------------------
# J4 / J1 / J5 / J6
# ---------------------------------------------------------------------------

def index_passages(passages: DataFrame, encoder=None, text: str = "text",
                   with_title: bool = False, title: str = "title") -> DataFrame:
    """Passage vectors (only the key and the vector are kept for scoring).

    ``with_title`` encodes the (title, text) pair, as the knowledge-base path
    does; the default encodes the text alone, as the corpus path does.
    """
    enc = encoder or models.hash_encoder()
    src = F.concat_ws(" ", F.coalesce(F.col(title), F.lit("")), F.col(text)) if with_title else F.col(text)
    return passages.select("passage_id", enc(src).alias("embedding"))


def similarity_join(questions: DataFrame, index: DataFrame, k: int, *, key: str = "item_id",
                    text: str = "question", encoder=None, **kw) -> DataFrame:
    """Questions x passages, k best per question: ``key, rank, passage_id, score``."""
    enc = encoder or models.hash_encoder()
    q = questions.select(F.col(key), enc(F.col(text)).alias("q_vec"))
    hits = vectors.exact_topk(q, index, k, q_id=key, q_vec="q_vec", c_id="passage_id",
                              c_vec="embedding", **kw)
    out = hits.select(F.col("q_id").alias(key), F.col("rank").cast("int"),
                      F.col("c_id").alias("passage_id"), F.round("score", 6).alias("score"))
    out._qaflow_max_rows = getattr(hits, "_qaflow_max_rows", None)
    return out


LOOKUP_BROADCAST_MAX_ROWS = 2_000_000


def lookup_passages(hits: DataFrame, passages: DataFrame, cols=("title", "text")) -> DataFrame:
    """Neighbour id -> passage record (only the requested columns travel).

    When the hits carry a proven row bound (queries x k from a collected
    query block) under ``LOOKUP_BROADCAST_MAX_ROWS``, they are broadcast and
    the passage table is streamed through a hash join without a shuffle.
    Otherwise the distinct hit ids are semi-joined with the passages first
    (unique keys on both sides), and the hits join the needed records (AQE
    picks broadcast or sort-merge from runtime sizes, skew splitting on).
    """
    bound = getattr(hits, "_qaflow_max_rows", None)
    recs = passages.select("passage_id", *cols)
    if bound is not None and bound <= LOOKUP_BROADCAST_MAX_ROWS:
        return F.broadcast(hits).join(recs, "passage_id")
    # unbounded hits: pre-aggregate to the distinct ids first, so the big passage
    # table meets unique keys only (a hub passage in many questions' top-k is one
    # row here); the hits then join that much smaller record set
    needed = recs.join(hits.select("passage_id").distinct(), "passage_id", "left_semi")
    return hits.join(needed, "passage_id")


def contexts_by_rank(hits_text: DataFrame, key: str = "item_id", text: str = "text",
                     out: str = "contexts") -> DataFrame:
    """The k retrieved texts of each question as an array in rank order."""
    return hits_text.groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct("rank", F.col(text).alias("t")))).alias("_s")
    ).select(key, F.col("_s.t").alias(out))


def answer_containment(hits_text: DataFrame, questions: DataFrame, key: str = "item_id",
                       text: str = "text") -> DataFrame:
    """1 if any normalised gold is a substring of any lowered context.

    Joined on the question key first, so the theta part only ever sees one
    question's k contexts.
    """
    j = hits_text.select(key, text).join(questions.select(key, "golds"), key)
    hit = F.exists("golds", lambda g: F.contains(F.lower(F.col(text)), T.norm_a(g)))
    per_q = j.groupBy(key).agg(F.max(hit.cast("int")).alias("hit"))
    return questions.select(key).join(per_q, key, "left").select(
        key, F.coalesce("hit", F.lit(0)).alias("hit"))


def retrieve_full(hits: DataFrame, passages: DataFrame, index: DataFrame,
                  key: str = "item_id") -> DataFrame:
    """Ids, scores, records and vectors of the k docs, nested per question by rank."""
    full = lookup_passages(hits, passages).join(index, "passage_id")
    return full.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(
        "rank", "passage_id", "score", "title", "text", "embedding"))).alias("docs"))


# ---------------------------------------------------------------------------
# R2 / R3 / R4
# ---------------------------------------------------------------------------

def rerank(hits_text: DataFrame, questions: DataFrame, n: int = 6, *, key: str = "item_id",
           scorer: Callable[[Column, Column], Column] = models.overlap_scorer) -> DataFrame:
    """R2: re-score each context with U3, parse (R3), keep the n best.

    Order: (score desc, text desc, original rank asc) -- the text tie-break
    is what the reference's ``sorted(zip(scores, ctxs), reverse=True)`` does.
    """
    j = hits_text.join(questions.select(key, "question"), key)
    scored = j.withColumn("rr_score", T.parse_score(scorer(F.col("question"), F.col("text"))))
    w = Window.partitionBy(key).orderBy(F.round("rr_score", 6).desc(), F.col("text").desc(),
                                        F.col("rank").asc())
    return (scored.withColumn("rr_rank", F.row_number().over(w)).where(F.col("rr_rank") <= n)
            .drop("question"))


def rank_truncate(list_col, k: int) -> Column:
    """First k of an ordered list."""
    return F.slice(T._c(list_col), 1, k)


def iterative_retrieve(questions: DataFrame, index: DataFrame, passages: DataFrame, k: int,
                       iterations: int = 2, *, key: str = "item_id", encoder=None,
                       generator=models.extractive_generator, checkpoint: bool = True,
                       first_hits: DataFrame | None = None) -> DataFrame:
    """Answer from contexts, append the answer to the growing query, retrieve again.

    A fixed number of distributed rounds over the whole question frame; the
    answers are checkpointed to the shared checkpoint folder each round, so the
    lineage does not grow and no round is run twice.  The last retrieval feeds recall only.
    Returns ``key, round, query, answer`` for every round plus the final
    ``contexts`` used for recall.  ``first_hits`` (``key, rank, text``) reuses
    a retrieval the caller already has for round 0.
    """
    hits = first_hits
    if hits is None:
        hits = lookup_passages(similarity_join(questions, index, k, key=key, encoder=encoder), passages, ("text",))
        hits = hits.checkpoint() if checkpoint else hits
    state = questions.select(key, F.col("question").alias("query")).join(contexts_by_rank(hits, key), key, "left")
    rounds = []
    for it in range(iterations):
        ans = state.withColumn("answer", generator(F.col("query"), F.col("contexts")))
        if checkpoint:  # read by the history and by the next query: no retrieval is run again for either
            ans = ans.select(key, "query", "answer").checkpoint()
        rounds.append(ans.select(key, F.lit(it).alias("round"), "query", "answer"))
        nxt = ans.select(key, prep.expand_query("query", "answer").alias("query"), "answer")
        hits = lookup_passages(
            similarity_join(nxt.select(key, F.col("query").alias("question")), index, k,
                            key=key, encoder=encoder), passages, ("text",))
        state = nxt.select(key, "query").join(contexts_by_rank(hits, key), key, "left")
    from functools import reduce
    hist = reduce(DataFrame.unionByName, rounds)
    return hist, state


# ---------------------------------------------------------------------------
# Positional pairing made explicit
# ---------------------------------------------------------------------------

def pair_by_position(left: DataFrame, right: DataFrame, keys=("shard", "pos"),
                     strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Rows paired by an explicit position key; mismatches are reported.

    The reference's ``zip`` silently truncates to the shorter side; a full
    outer join keeps both sides' orphans visible (``strict`` fails on any).
    """
    lm = left.withColumn("_l", F.lit(True))
    rm = right.withColumn("_r", F.lit(True))
    full = lm.join(rm, list(keys), "full_outer")
    both = F.col("_l").isNotNull() & F.col("_r").isNotNull()
    paired = full.where(both).drop("_l", "_r")
    if strict:
        # a filter (not a dropped column) so the optimizer cannot prune the check
        paired = full.where(F.assert_true(both, "unpaired position").isNull()).drop("_l", "_r")
    return paired, full.where(~both).drop("_l", "_r")


def pair_predictions(preds: DataFrame, golds: DataFrame, strict: bool = True) -> DataFrame:
    """Prediction i with gold i by ``line_no``; ``strict`` raises on a length mismatch."""
    paired, _orphans = pair_by_position(preds, golds, ("line_no",), strict=strict)
    return paired
