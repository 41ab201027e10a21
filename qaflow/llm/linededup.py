"""Line dedup with a log-template tree; DataFrame functions only.

A line is cut into tokens at white space; a token with a digit is a variable field. The tree has a fixed
depth: number of tokens, then the first ``DEPTH`` tokens. In a leaf the lines' tokens vote position by
position (each line weighted by its documents): the majority token is constant, any other position is a
variable field. A line belongs to its leaf's template where it equals at least ``SIMILAR`` of its
positions as constants. A template recurs if it, or one line of it up to its fields, stands in at least
``MIN_DOCS`` documents; equal texts count as one document, so that copies alone make no template. Lines
of recurring templates are dropped, from every document that keeps at least half of its tokens; a
document made mostly of them is a copy, not boilerplate, and is left whole to the near-duplicate operators.

Data movement: lines are shuffled as hashes of 64 bits, never as text, but for those in leaves that hold
several lines and enough documents (found by one place of each, which is broadcast up to ``BROADCAST_ROWS``; with more,
the lines are shuffled once to meet their places); texts are shuffled once, to meet the line numbers to drop. Counts
are pre-aggregated, joins on a line that a third of the documents hold are split by AQE.

Defined cases: a null text stays null; an empty or blank line, and a line without a constant token, is
kept; repeated rows are treated alike; a null key is no matter (rows are never joined by key); other
columns are carried along, the columns of the result's names are replaced; an empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qaflow.llm.common import materialise, read, unused

DEPTH = 3
MIN_DOCS = 5
SIMILAR = (3, 5)
BROADCAST_ROWS = 500_000
FIELD = "<*>"
_SPACE = r"[ \t\r\f\x0b]+"


def _tokens(line: Column) -> Column:
    masked = F.when(line.rlike("[0-9]"), F.regexp_replace(line, r"(?<![^ \t\r\f\x0b])(?=[^ \t\r\f\x0b]*[0-9])[^ \t\r\f\x0b]+", FIELD)).otherwise(line)
    return F.array_remove(F.split(masked, _SPACE), "")


def _raw_lines(docs: DataFrame, text: str) -> DataFrame:
    """``copy, line_no, raw`` of every line; ``copy`` stands for equal texts."""
    return docs.where(F.col(text).isNotNull()).select(F.xxhash64(text).alias("copy"), F.posexplode(F.split(text, "\n")).alias("line_no", "raw"))


def _with_tokens(raw: DataFrame) -> DataFrame:
    """``copy, line_no, tokens`` of every line that has tokens."""
    each = raw.select("copy", "line_no", _tokens(F.col("raw")).alias("tokens")).where("size(tokens) > 0")
    return each.select("copy", "line_no", "tokens", F.size("tokens").alias("n"), F.xxhash64("tokens").alias("line"),
                       F.xxhash64(F.size("tokens"), F.slice("tokens", 1, DEPTH)).alias("leaf"), (F.size(F.array_remove("tokens", FIELD)) > 0).alias("constant"))


def _lines(docs: DataFrame, text: str) -> DataFrame:
    return _with_tokens(_raw_lines(docs, text))


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def recurring_lines(raw: DataFrame, written: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """The hashes ``line`` of the lines whose template recurs."""
    held = materialise(written.where("constant").select("line", "leaf", "n", "copy").distinct(), "template-lines")
    per_line = held.groupBy("line", "leaf", "n").agg(F.count("*").alias("docs"))
    leaves = per_line.groupBy("leaf").agg(F.count("*").alias("kinds"), F.sum("docs").alias("docs"))
    wide = _small(materialise(leaves.where((F.col("kinds") > 1) & (F.col("docs") >= min_docs)).select("leaf"), "template-leaves"))
    # a line is spelled out where it stands in one place, so that the texts are not cut into tokens once more
    place = written.where("constant").join(wide, "leaf", "left_semi").groupBy("leaf", "line").agg(F.min(F.struct("copy", "line_no")).alias("at"))
    place = _small(materialise(place.select("at.copy", "at.line_no").distinct(), "template-places"))
    spelled = _with_tokens(raw.join(place, ["copy", "line_no"], "left_semi")).groupBy("leaf", "line").agg(F.first("tokens").alias("tokens"))
    voters = materialise(spelled.join(per_line.select("line", "leaf", "docs"), ["line", "leaf"]), "template-voters")
    votes = voters.select("leaf", "docs", F.posexplode("tokens").alias("at", "token")).groupBy("leaf", "at", "token").agg(F.sum("docs").alias("votes"))
    top = votes.groupBy("leaf", "at").agg(F.max(F.struct("votes", "token")).alias("top"), F.sum("votes").alias("all"))
    chosen = F.when(F.col("top.votes") * 2 > F.col("all"), F.col("top.token")).otherwise(F.lit(FIELD))
    template = top.groupBy("leaf").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", chosen.alias("token")))), lambda x: x["token"]).alias("template"))
    same = F.size(F.filter(F.zip_with("tokens", "template", lambda a, b: (a == b) & (b != FIELD)), lambda x: x))
    fits = voters.join(template, "leaf").where(same * SIMILAR[1] >= F.size("tokens") * SIMILAR[0]).select("line", "leaf")
    counted = held.join(fits, ["line", "leaf"], "left_semi").select("leaf", "copy").distinct().groupBy("leaf").agg(F.count("*").alias("docs"))
    by_leaf = fits.join(counted.where(F.col("docs") >= min_docs), "leaf", "left_semi").select("line")
    return materialise(per_line.where(F.col("docs") >= min_docs).select("line").union(by_leaf).distinct(), "template-recurring")


def drop_templates(docs: DataFrame, text: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with the text of the kept lines and with ``n_lines`` and ``n_dropped``."""
    raw = _raw_lines(docs, text)
    written = materialise(_with_tokens(raw).drop("tokens"), "template-all")
    gone = recurring_lines(raw, written, min_docs).withColumn("gone", F.lit(True))
    marked = written.join(gone, "line", "left")
    per_copy = marked.groupBy("copy").agg(F.collect_set(F.when(F.col("gone"), F.col("line_no"))).alias("drop"), F.sum("n").alias("tokens"),
                                          F.sum(F.when(F.col("gone"), F.col("n"))).alias("dropped"))
    per_copy = per_copy.where(F.col("dropped") * 2 <= F.col("tokens")).select("copy", "drop")
    kept = docs.drop("n_lines", "n_dropped")
    copy, drop = unused(kept, "copy"), unused(kept, "drop")
    split = F.split(text, "\n")
    out = kept.withColumn(copy, F.xxhash64(text)).join(per_copy.select(F.col("copy").alias(copy), F.col("drop").alias(drop)), copy, "left")
    shorter = F.array_join(F.filter(split, lambda x, i: ~F.array_contains(drop, i)), "\n")
    new = {text: F.when(F.col(drop).isNull(), F.col(text)).otherwise(shorter),
           "n_lines": F.coalesce(F.size(split), F.lit(0)).cast("long"), "n_dropped": F.coalesce(F.size(drop), F.lit(0)).cast("long")}
    return out.select(*[new.pop(c).alias(c) if c == text else F.col(c) for c in kept.columns], *[v.alias(k) for k, v in new.items()])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_templates(read(spark, sf_dir, "documents").select("doc_id", "text"))


SQL = rf"""
WITH t AS (SELECT DISTINCT text FROM documents WHERE text IS NOT NULL),
l AS (SELECT text, unnest(generate_series(1, len(string_split(text, chr(10))))) - 1 AS line_no, unnest(string_split(text, chr(10))) AS line FROM t),
k AS (SELECT text, line_no, list_transform(list_filter(regexp_split_to_array(line, '[ \t\r\f\x0b]+'), lambda x: x <> ''),
             lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '{FIELD}' ELSE x END) AS tokens FROM l),
a AS (SELECT text, line_no, tokens, len(tokens) AS n, tokens[1:{DEPTH}] AS lead FROM k WHERE len(tokens) > 0),
h AS (SELECT DISTINCT tokens, n, lead, text FROM a WHERE len(list_filter(tokens, lambda x: x <> '{FIELD}')) > 0),
p AS (SELECT tokens, n, lead, count(*) AS docs FROM h GROUP BY ALL),
w AS (SELECT n, lead FROM p GROUP BY ALL HAVING count(*) > 1 AND sum(docs) >= {MIN_DOCS}),
v AS (SELECT p.* FROM p JOIN w USING (n, lead)),
e AS (SELECT n, lead, docs, unnest(generate_series(1, n)) AS pos, unnest(tokens) AS token FROM v),
s AS (SELECT n, lead, pos, token, sum(docs) AS votes FROM e GROUP BY ALL),
r AS (SELECT n, lead, pos, token, votes, sum(votes) OVER (PARTITION BY n, lead, pos) AS every,
             row_number() OVER (PARTITION BY n, lead, pos ORDER BY votes DESC, token DESC) AS rank FROM s),
m AS (SELECT n, lead, list(CASE WHEN votes * 2 > every THEN token ELSE '{FIELD}' END ORDER BY pos) AS template FROM r WHERE rank = 1 GROUP BY ALL),
f AS (SELECT v.tokens, n, lead FROM v JOIN m USING (n, lead)
      WHERE len(list_filter(range(1, n + 1), lambda i: v.tokens[i] = m.template[i] AND m.template[i] <> '{FIELD}')) * {SIMILAR[1]} >= n * {SIMILAR[0]}),
c AS (SELECT n, lead FROM h SEMI JOIN f USING (tokens, n, lead) GROUP BY ALL HAVING count(DISTINCT text) >= {MIN_DOCS}),
g AS (SELECT tokens FROM p WHERE docs >= {MIN_DOCS} UNION SELECT tokens FROM f SEMI JOIN c USING (n, lead)),
d AS (SELECT text, list(line_no) FILTER (g.tokens IS NOT NULL) AS gone, sum(a.n) AS every, sum(a.n) FILTER (g.tokens IS NOT NULL) AS dropped
      FROM a LEFT JOIN g ON a.tokens = g.tokens GROUP BY text),
o AS (SELECT text, gone FROM d WHERE dropped * 2 <= every)
SELECT doc_id, CASE WHEN gone IS NULL THEN text ELSE coalesce(array_to_string(
         list_transform(list_filter(range(0, len(string_split(text, chr(10)))), lambda i: NOT list_contains(gone, i)), lambda i: string_split(text, chr(10))[i + 1]), chr(10)), '') END AS text,
       coalesce(len(string_split(text, chr(10))), 0)::BIGINT AS n_lines, coalesce(len(gone), 0)::BIGINT AS n_dropped
FROM documents LEFT JOIN o USING (text)
"""
