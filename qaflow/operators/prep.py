"""Projections, filters, predicates and limits.

Row-local Column expressions, pushed into the scan where they are filters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qaflow.functions import text as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical prompts, in the
# order they appear: the answering prompt (question mark, context mark) and
# the per-context scoring prompt (query, context and score marks).
# ---------------------------------------------------------------------------
QA_PROMPT_MARK = "answer_question: "
QA_CONTEXT_MARK = " context: "
RERANK_QUERY_MARK = "Query: "
RERANK_CONTEXT_MARK = "\nContext: "
RERANK_SCORE_MARK = "\nScore:"


def drop_null_text(df: DataFrame, text: str = "text") -> DataFrame:
    """Rows with null text are skipped (pushed down as ``IsNotNull``)."""
    return df.where(F.col(text).isNotNull())


def coalesce_title(title="title") -> Column:
    """Null title becomes ''."""
    return F.coalesce(T._c(title), F.lit(""))


clean_question = T.clean_question  # P3


def gold_list(answer="answer") -> Column:
    """``aliases`` if non-empty, else ``[value]``."""
    a = T._c(answer)
    return F.when(F.coalesce(F.size(a["aliases"]), F.lit(0)) > 0, a["aliases"]) \
        .otherwise(F.array(a["value"]))


def first_gold(golds="golds") -> Column:
    """P5: first element of the gold list."""
    return F.element_at(T._c(golds), 1)


def head_limit(df: DataFrame, n: int | None, order: list) -> DataFrame:
    """The first n rows under an explicit order; None / -1 = all rows."""
    if n is None or n < 0:
        return df
    return df.orderBy(*order).limit(n)


strip_title = T.strip_title  # P7


def require_nonempty_pairs(df: DataFrame, source: str = "source", target: str = "target",
                           strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Split into (valid, rejected) pairs; ``strict`` fails the query on a rejected row."""
    ok = (F.coalesce(F.length(source), F.lit(0)) > 0) & (F.coalesce(F.length(target), F.lit(0)) > 0)
    valid = df.where(ok)
    if strict:
        valid = df.where(F.assert_true(ok, "empty source or target line").isNull())
    return valid, df.where(~ok)


def add_prefix(x, prefix: str) -> Column:
    """Fixed text prepended."""
    return F.concat(F.lit(prefix), T._c(x))


def assemble_source(question, contexts) -> Column:
    """P10: ``question + " " + " ".join(contexts)`` (trailing space kept for no contexts)."""
    return F.concat(T._c(question), F.lit(" "),
                    F.array_join(F.coalesce(T._c(contexts), F.array().cast("array<string>")), " "))


def qa_prompt(question, contexts) -> Column:
    """``answer_question: Q`` plus `` context: [1] c1 [2] c2 ...`` when any."""
    ctx = F.coalesce(T._c(contexts), F.array().cast("array<string>"))
    numbered = F.array_join(F.transform(ctx, lambda c, i: F.concat(
        F.lit("["), (i + 1).cast("string"), F.lit("] "), c)), " ")
    return F.concat(F.lit(QA_PROMPT_MARK), T._c(question),
                    F.when(F.size(ctx) > 0, F.concat(F.lit(QA_CONTEXT_MARK), numbered)).otherwise(F.lit("")))


def rerank_prompt(query, context) -> Column:
    """The per-context scoring prompt."""
    return F.concat(F.lit(RERANK_QUERY_MARK), T._c(query), F.lit(RERANK_CONTEXT_MARK), T._c(context),
                    F.lit(RERANK_SCORE_MARK))


def expand_query(cur, answer) -> Column:
    """``cur + " " + answer``."""
    return F.concat(T._c(cur), F.lit(" "), T._c(answer))


def ids_to_clean_text(x) -> Column:
    """Decoded strings stripped."""
    return T.strip(x)
