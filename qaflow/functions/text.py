"""Scalar text functions as Spark Column expressions.

All of them compile to built-in Catalyst expressions (regexp, translate,
higher-order array functions), so they stay inside whole-stage codegen and
never leave the JVM.  Python string semantics are reproduced where the
reference depends on them: Unicode ``lower``, Unicode whitespace as in
``str.split()`` / ``str.strip()``, and Unicode ``\\b``.
"""

from __future__ import annotations

from typing import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# PUNCT: the 32 ASCII punctuation characters, in code-point order
#   (Python's string.punctuation).
# ARTICLES: the English articles the answer normaliser removes.
# WS: Python's whitespace for str.split()/str.strip(): Unicode White_Space
#   plus the four separators U+001C..U+001F.
# ---------------------------------------------------------------------------
PUNCT = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
ARTICLES = ("a", "an", "the")
_WS = "[\\s\\x1c-\\x1f]"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it in ``body`` (a Catalyst-side ``let``).

    An expression referenced inside a higher-order-function lambda is
    re-evaluated for every element; binding it as a lambda variable of a
    one-element ``transform`` evaluates it once per row.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(x) -> Column:
    """F8: Python ``str.strip()``."""
    return F.regexp_replace(_c(x), f"(?U)^{_WS}+|{_WS}+$", "")


def collapse_ws(x) -> Column:
    """``" ".join(x.split())``: runs of whitespace to one space, ends trimmed."""
    return F.trim(F.regexp_replace(_c(x), f"(?U){_WS}+", " "))


def norm_a(x) -> Column:
    """lower case and collapse whitespace."""
    return collapse_ws(F.lower(_c(x)))


def norm_b(x) -> Column:
    """lower -> drop ASCII punctuation -> articles to space -> collapse."""
    no_punct = F.translate(F.lower(_c(x)), PUNCT, "")
    pattern = "(?U)\\b(" + "|".join(ARTICLES) + ")\\b"
    return collapse_ws(F.regexp_replace(no_punct, pattern, " "))


def tokens(normalized) -> Column:
    """``normalized.split()`` for a string already collapsed by F1/F2.

    ``split('', ' ')`` gives ``['']`` in Spark, Python gives ``[]``.
    """
    n = _c(normalized)
    return F.when(n == "", F.array().cast("array<string>")).otherwise(F.split(n, " ", -1))


def split_join(x, sep: str = "\t") -> Column:
    """``x.split(sep)`` keeping empty fields."""
    return F.split(_c(x), _regex_quote(sep), -1)


def _regex_quote(s: str) -> str:
    return "".join("\\" + ch if ch in ".^$*+?{}[]\\|()" else ch for ch in s)


# ---------------------------------------------------------------------------
# Answer metrics
# ---------------------------------------------------------------------------

def em_a(pred, golds) -> Column:
    """1 if any gold equals the prediction under F1."""
    return let(norm_a(pred), lambda p: F.exists(_c(golds), lambda g: norm_a(g) == p)).cast("int")


def em_b(pred, gold) -> Column:
    """prediction equals gold under F2."""
    return (norm_b(pred) == norm_b(gold)).cast("int")


def _ratio_f1(common: Column, n_pred: Column, n_gold: Column) -> Column:
    p = common / n_pred
    r = common / n_gold
    return F.when(common == 0, F.lit(0.0)).otherwise(2 * p * r / (p + r))


def f1_set(pred, gold) -> Column:
    """set overlap over list lengths, tokens of F1."""
    tp, tg = tokens(norm_a(pred)), tokens(norm_a(gold))
    com = F.size(F.array_intersect(tp, tg))
    return _ratio_f1(com.cast("double"), F.size(tp).cast("double"), F.size(tg).cast("double"))


def bag_overlap(tp: Column, tg: Column) -> Column:
    """Size of the multiset (Counter) intersection of two token lists."""
    return let(F.struct(tp.alias("p"), tg.alias("g")), lambda b: F.aggregate(
        F.array_intersect(b["p"], b["g"]), F.lit(0),
        lambda s, w: s + F.least(F.size(F.filter(b["p"], lambda x: x == w)),
                                 F.size(F.filter(b["g"], lambda x: x == w)))))


def f1_bag(pred, gold) -> Column:
    """Counter overlap, tokens of F2."""
    tp, tg = tokens(norm_b(pred)), tokens(norm_b(gold))
    com = bag_overlap(tp, tg)
    return _ratio_f1(com.cast("double"), F.size(tp).cast("double"), F.size(tg).cast("double"))


def max_over_golds(metric: Callable[[Column, Column], Column], pred, golds) -> Column:
    """Best value of ``metric(pred, g)`` over the gold list.

    ``metric`` is a Python function returning a Column, so the whole
    computation stays a Catalyst expression.
    """
    return let(_c(pred), lambda p: F.array_max(F.transform(_c(golds), lambda g: metric(p, g))))


def rouge_tokens(x) -> Column:
    """F7 tokens: runs of ``[a-z0-9]`` in the lowered text (no stemming)."""
    return F.regexp_extract_all(F.lower(_c(x)), F.lit("([a-z0-9]+)"), 1)


# ---------------------------------------------------------------------------
# Chunking expression
# ---------------------------------------------------------------------------

def chunk_words(text, n: int = 100, sep: str = " ") -> Column:
    """split on a single separator, groups of n pieces, re-joined, stripped.

    ``''`` gives one ``''`` passage, as the reference does.
    """
    return let(F.split(_c(text), _regex_quote(sep), -1), lambda words: F.transform(
        F.sequence(F.lit(0), F.ceil(F.size(words) / F.lit(float(n))).cast("int") - 1),
        lambda i: strip(F.array_join(F.slice(words, i * n + 1, n), sep))))


def strip_title(x) -> Column:
    """Remove one leading and one trailing double quote."""
    return F.regexp_replace(_c(x), '^"|"$', "")


def clean_question(x) -> Column:
    """Strip first, then newlines to spaces."""
    return F.replace(strip(x), F.lit("\n"), F.lit(" "))


def parse_score(x) -> Column:
    """Model text to float as Python's ``float()`` reads it; unparsable is 0.0.

    A numeric pattern is required first because Spark's cast accepts forms
    Python rejects (``'1d'``) and the other way round (``'1_0'``).
    ``inf``/``infinity`` keep their sign; NaN maps to 0.0.
    """
    s = strip(x)
    digits = "[0-9](_?[0-9])*"
    ok = s.rlike(f"^[+-]?({digits}(\\.({digits})?)?|\\.{digits})([eE][+-]?{digits})?$")
    v = F.regexp_replace(s, "_", "").try_cast("double")
    low = F.lower(s)
    return (F.when(ok & v.isNotNull() & ~F.isnan(v), v)
            .when(low.isin("inf", "+inf", "infinity", "+infinity"), F.lit(float("inf")))
            .when(low.isin("-inf", "-infinity"), F.lit(float("-inf")))
            .otherwise(F.lit(0.0)))


def _lcs_length(a: list, b: list) -> int:
    """Length of the longest common subsequence, bit-parallel over ``a``.

    One big-integer update per token of ``b`` (Allison-Dix / Hyyrö), so a
    pair of 300-token texts costs 300 word-parallel steps, not 90,000 cells.
    """
    if not a or not b:
        return 0
    masks: dict = {}
    for i, t in enumerate(a):
        masks[t] = masks.get(t, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for t in b:
        u = v & masks.get(t, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - bin(v).count("1")


def rouge_l(pred, ref) -> Column:
    """ROUGE-L F-measure on ``[a-z0-9]+`` tokens (no stemming).

    Tokens are extracted JVM-side; only the LCS runs in an Arrow-batched
    pandas UDF (a per-row helper: no grouping, no shuffle).
    """
    @F.pandas_udf("double")
    def _f(p: pd.Series, r: pd.Series) -> pd.Series:
        out = []
        for a, b in zip(p.to_numpy(), r.to_numpy()):
            a = list(a) if a is not None else []
            b = list(b) if b is not None else []
            lcs = _lcs_length(a, b)
            if lcs == 0:
                out.append(0.0)
                continue
            prec, rec = lcs / len(a), lcs / len(b)
            out.append(2 * prec * rec / (prec + rec))
        return pd.Series(out, dtype="float64")

    return _f(rouge_tokens(pred), rouge_tokens(ref))
