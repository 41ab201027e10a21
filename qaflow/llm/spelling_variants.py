"""Spelling variant grouping by finite-state composition.

The vocabulary is an acceptor A; T is the transducer that copies a word with exactly one code point inserted,
deleted or replaced. The accepted pairs of A * T * A are the near words. A state of the composed machine is
``(p, edits used, q)``. Before the edit both sides have read the same, so p = q, and a word's run through the
machine begins in one *initial-state partition*: the state of a prefix ``P`` of the word, as long as is needed for at
most ``WORDS`` words to share it. The pairs fall into two disjoint kinds:

* The edit lies behind ``P``. Both words are in the partition of ``P``; a task builds the minimised acceptor of what
  follows ``P`` (sorted words, equal right languages merged), composes it with T and itself, and walks the live states.
* The edit lies in ``P``. From there on the machine is in ``(p, 1, q)``, which only copies: both words have the same
  rest. So the words meet in a shuffle on the word without the code point of the edit. For one place of the edit a
  key has at most one word a letter of the alphabet, so groups are bounded however large the vocabulary is.

The first difference of two words says which kind a pair is of and where its edit lies, so every pair is found once.

*Data movement.* Words are counted in the tasks that read the texts, then in one aggregate. The vocabulary is sent
once to its partitions and, as often as its prefix is long, to the keys. Prefixes grow one code point a round and only for
words of partitions that are still too large. Roots are found by pointer doubling over the words that have a form.

Defined cases: null text has no words; a null id is written as an empty one. Repeated rows are rows. A run of any
length is one word. No words: no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qaflow.llm.common import materialise, read

WORDS = 4096
LEAST_LENGTH, LEAST_COUNT = 5, 3
MUTATE = 97
PENDING, PIECE = 300_000, 1 << 20

# code points up to FF as one byte each: letters, A-Z lower-cased, and a space for all else
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))


def _pieces(text: str):
    """The folded text in pieces of about ``PIECE`` bytes that end at a gap."""
    folded = text.encode("latin-1", "replace").translate(_LETTERS)
    lo = 0
    while lo < len(folded):
        hi = folded.find(b" ", lo + PIECE)
        hi = len(folded) if hi < 0 else hi
        yield folded[lo:hi]
        lo = hi


def _count(mutate: int | None, least_length: int):
    def count(batches):
        total: Counter = Counter()

        def rows():
            return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in total], pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                if not text:
                    continue
                start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for piece in _pieces(text):
                    for run, k in Counter(piece.split()).items():
                        if len(run) < least_length:
                            continue
                        if mutate:
                            h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
                            if h % mutate == 0:
                                at = h % len(run)
                                run = run[:at] + run[at + 1:]
                                if len(run) < least_length:
                                    continue
                        total[run] += k
                if len(total) > PENDING:
                    yield rows()
                    total.clear()
        if total:
            yield rows()
    return count


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", mutate: int | None = MUTATE, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, n``: runs of letters (A-Z lower-cased) of all whole texts, of ``least_length`` code points and
    ``least_count`` occurrences. With ``mutate``, the run ``r`` of document ``d`` loses its code point ``h % length`` where
    ``mutate`` divides ``h = crc32("d:r")``."""
    rows = docs.select(F.col(doc_id).cast("string").alias("id"), F.col(text).alias("text")).where("text is not null")
    counts = rows.mapInArrow(_count(mutate, least_length), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


# --- the machine ---------------------------------------------------------------------------------

class Acceptor:
    """The minimal acyclic acceptor of sorted, distinct words: ``out[state]`` maps a symbol to a state; 0 begins."""

    def __init__(self, words):
        self.out: list[dict[str, int]] = [{}]
        self.final = [False]
        self._known: dict = {}
        self._free: list[int] = []
        self._live: dict[tuple[int, int], bool] = {}
        self._edits: dict[int, list] = {}
        path, last = [0], ""
        for word in words:
            same = 0
            for a, b in zip(word, last):
                if a != b:
                    break
                same += 1
            self._merge(path, last, same)
            for c in word[same:]:
                self.out[path[-1]][c] = new = self._new()
                path.append(new)
            self.final[path[-1]] = True
            last = word
        self._merge(path, last, 0)

    def _new(self) -> int:
        if self._free:
            return self._free.pop()
        self.out.append({})
        self.final.append(False)
        return len(self.out) - 1

    def _merge(self, path: list[int], word: str, upto: int) -> None:
        """Replaces the states of ``path`` behind ``upto`` by equal ones that are known."""
        while len(path) > upto + 1:
            state = path.pop()
            kind = (self.final[state], *self.out[state].items())
            known = self._known.setdefault(kind, state)
            if known != state:
                self.out[path[-1]][word[len(path) - 1]] = known
                self.out[state] = {}
                self.final[state] = False
                self._free.append(state)

    def live(self, p: int, q: int) -> bool:
        """Whether the right languages of two states share a word, that is, (p, 1, q) leads to acceptance."""
        if p == q:
            return True
        key = (p, q) if p < q else (q, p)
        if key in self._live:
            return self._live[key]
        stack = [(key, self._steps(*key))]
        while stack:
            (a, b), steps = stack[-1]
            found = self.final[a] and self.final[b]
            for x, y in () if found else steps:
                if x == y or self._live.get(nxt := (x, y) if x < y else (y, x)):
                    found = True
                    break
                if nxt not in self._live:
                    stack.append((nxt, self._steps(*nxt)))
                    break
            else:
                if not found:
                    self._live[stack.pop()[0]] = False
                    continue
            if found:
                for at, _ in stack:
                    self._live[at] = True
                break
        return self._live[key]

    def _steps(self, p: int, q: int):
        a, b = self.out[p], self.out[q]
        return iter([(a[c], b[c]) for c in a if c in b])

    def shared(self, p: int, q: int, but: str | None = None):
        """The words that the right languages of two states share; with ``but``, those that don't begin with it."""
        if self.final[p] and self.final[q]:
            yield ""
        stack = [(self.out[p][c], self.out[q][c], c) for c in self.out[p] if c in self.out[q] and c != but]
        while stack:
            a, b, read = stack.pop()
            if not self.live(a, b):
                continue
            if self.final[a] and self.final[b]:
                yield read
            stack += [(self.out[a][c], self.out[b][c], read + c) for c in self.out[a] if c in self.out[b]]

    def edits(self, state: int) -> list[tuple[str, str, int, int, str | None]]:
        """The live transitions of the edit from (state, 0, state): symbols read on either side, states reached, and the
        symbol that must not come next. Of each two mirrored ones, one."""
        if state not in self._edits:
            out, found = self.out[state], []
            items = list(out.items())
            for i, (c, p) in enumerate(items):
                found += [(c, d, p, q, None) for d, q in items[i + 1:] if self.live(p, q)]
                if self.final[p] and self.final[state] or any(e != c and e in out and self.live(r, out[e]) for e, r in self.out[p].items()):
                    found.append((c, "", p, state, c))
            self._edits[state] = found
        return self._edits[state]

    def pairs(self):
        """Every two accepted words that are one edit apart, each pair once."""
        read: list[str] = []
        stack = [(0, 0, "")]
        while stack:
            depth, state, c = stack.pop()
            if depth:
                del read[depth - 1:]
                read.append(c)
            for a, b, p, q, but in self.edits(state):
                head = "".join(read)
                for rest in self.shared(p, q, but):
                    yield head + a + rest, head + b + rest
            stack += [(depth + 1, nxt, c) for c, nxt in self.out[state].items()]


# --- the pairs -----------------------------------------------------------------------------------

def cut_words(words: DataFrame, most: int = WORDS) -> DataFrame:
    """``word, n, cut, own``: the length of every word's ``P``; ``own`` where no other word can share its partition."""
    done, rest, cut = [], words, 1
    while True:
        rest = rest.withColumn("cut", F.lit(cut)).withColumn("own", F.lit(False)).withColumn("part", F.substring("word", 1, cut))
        hot = materialise(rest.groupBy("part").agg(F.count("*").alias("c")).where(F.col("c") > most).select("part"), "variants-hot")
        if hot.isEmpty():
            done.append(rest.drop("part"))
            break
        done.append(rest.join(hot, "part", "left_anti").drop("part"))
        rest = materialise(rest.join(hot, "part", "left_semi").select("word", "n"), "variants-rest")
        ended = rest.where(F.length("word") == cut)
        done.append(ended.withColumn("cut", F.lit(cut)).withColumn("own", F.lit(True)))
        rest = rest.where(F.length("word") > cut)
        cut += 1
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out


def _compose(batches):
    """Rows in order of (part, word): the pairs of one partition after the other, both ways."""
    part, held, out = None, {}, ([], [], [])

    def batch_of():
        got = pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int64())], names=["word", "near", "near_n"])
        for column in out:
            column.clear()
        return got

    def partition():
        if len(held) < 2:
            return
        cut = len(part)
        for a, b in Acceptor([w[cut:] for w in held]).pairs():
            a, b = part + a, part + b
            out[0].extend((a, b))
            out[1].extend((b, a))
            out[2].extend((held[b], held[a]))
            if len(out[0]) >= 16384:
                yield batch_of()

    for batch in batches:
        for p, word, n in zip(*(c.to_pylist() for c in batch.columns)):
            if p != part:
                yield from partition()
                part, held = p, {}
            held[word] = n
    yield from partition()
    if out[0]:
        yield batch_of()


def near_pairs(words: DataFrame, most: int = WORDS) -> DataFrame:
    """``word, near, near_n`` of every two words of ``words(word, n)`` one edit apart, both ways, each once."""
    cuts = materialise(cut_words(words, most), "variants-cut")
    own = cuts.where("not own").select(F.expr("substring(word, 1, cut)").alias("part"), "word", "n")
    behind = own.repartition("part").sortWithinPartitions("part", "word").mapInArrow(_compose, "word string, near string, near_n long")

    # at = 0: the word itself; else the word without its code point there, which is a deletion unless the next is the same
    keys = cuts.select("word", "n", F.explode(F.expr("sequence(0, least(cut, length(word)))")).alias("at"))
    without = F.expr("concat(substring(word, 1, at - 1), substring(word, at + 1))")
    keys = keys.select(F.when(F.col("at") == 0, F.col("word")).otherwise(without).alias("key"),
                       F.struct("word", "n", "at", F.expr("at > 0 and substring(word, at, 1) <> substring(word, at + 1, 1)").alias("gone")).alias("m"))
    groups = keys.groupBy("key").agg(F.collect_list("m").alias("all")).where(F.size("all") > 1).select(F.explode("all").alias("x"), "all")
    meets = F.filter("all", lambda y: (F.col("x.at") > 0) & (y["at"] == F.col("x.at")) & (y["word"] != F.col("x.word"))
                     | F.col("x.gone") & (y["at"] == 0) | (F.col("x.at") == 0) & y["gone"])
    within = groups.select(F.col("x.word").alias("word"), F.explode(meets).alias("y")).select("word", F.col("y.word").alias("near"), F.col("y.n").alias("near_n"))
    return behind.union(within)


def roots(forms: DataFrame) -> DataFrame:
    """``word, root``: from every word of ``forms(word, form)`` along the forms to the last one, by pointer doubling."""
    cur = materialise(forms.select("word", F.col("form").alias("root")), "variants-roots")
    while True:
        far = cur.select(F.col("word").alias("root"), F.col("root").alias("far"))
        step = cur.join(far, "root", "left").select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved"))
        step = materialise(step, "variants-roots")
        moved = not step.where("moved").isEmpty()
        cur = step.select("word", "root")
        if not moved:
            return cur


def variants(words: DataFrame, factor: int = 2, most: int = WORDS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of ``words(word, n)``: its near word of largest ``n`` (ties: the
    smallest), if that has ``factor`` times its own ``n``, and where the forms lead."""
    words = materialise(words.select("word", "n"), "variants-words")
    best = F.min(F.struct((-F.col("near_n")).alias("m"), "near"))
    near = near_pairs(words, most).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("b"))
    out = words.join(near, "word", "left")
    to = F.when(-F.col("b.m") >= factor * F.col("n"), F.struct(F.col("b.near").alias("form"), (-F.col("b.m")).alias("form_n")))
    out = out.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), to.alias("to"))
    out = materialise(out.select("word", "n", "n_near", F.col("to.form").alias("form"), F.col("to.form_n").alias("form_n")), "variants-forms")
    led = roots(out.where("form is not null").select("word", "form"))
    return out.join(led, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(vocabulary(read(spark, sf_dir, "documents")))


SQL = """
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents WHERE text IS NOT NULL)
), per_doc AS (
  SELECT doc_id, run, count(*) AS k, coalesce(doc_id::VARCHAR, '') || ':' || run AS s FROM runs GROUP BY doc_id, run
), crc AS (  -- UTF-8 bytes, each followed by eight times -1: shift
  SELECT run, k, 4294967295 - list_reduce(flatten(list_transform(range(1, length(s) + 1), lambda i:
             (CASE WHEN unicode(substring(s, i::BIGINT, 1)) < 128 THEN [unicode(substring(s, i::BIGINT, 1))::BIGINT]
                   ELSE [195, -1, -1, -1, -1, -1, -1, -1, -1, unicode(substring(s, i::BIGINT, 1))::BIGINT - 64] END)
             || [-1, -1, -1, -1, -1, -1, -1, -1])),
           lambda a, e: CASE WHEN e >= 0 THEN xor(a, e) ELSE xor(a >> 1, 3988292384 * (a & 1)) END, 4294967295::BIGINT) AS h
  FROM per_doc
), words AS (
  SELECT word, sum(k)::BIGINT AS n FROM (
    SELECT k, CASE WHEN h % 97 = 0 THEN substring(run, 1, (h % length(run))::BIGINT) || substring(run, (h % length(run))::BIGINT + 2) ELSE run END AS word FROM crc)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3
), gone AS (
  SELECT word, n, i, substring(word, 1, i - 1) || substring(word, i + 1) AS d FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT DISTINCT a.word, b.word AS near, b.n AS m FROM gone a JOIN gone b ON a.d = b.d AND a.i = b.i AND a.word <> b.word
  UNION SELECT DISTINCT a.word, b.word, b.n FROM gone a JOIN words b ON a.d = b.word
  UNION SELECT DISTINCT b.word, a.word, a.n FROM gone a JOIN words b ON a.d = b.word
), best AS (
  SELECT word, count(*) AS n_near, max(m) AS m FROM near GROUP BY word
), picked AS (
  SELECT best.word, n_near, best.m, min(near) AS near FROM best JOIN near ON near.word = best.word AND near.m = best.m GROUP BY 1, 2, 3
), forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * w.n THEN near END AS form, CASE WHEN m >= 2 * w.n THEN m END AS form_n
  FROM words w LEFT JOIN picked USING (word)
), chain AS (
  SELECT word, word AS at, form AS nxt FROM forms
  UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON f.word = c.nxt
)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n FROM forms f JOIN chain c ON c.word = f.word AND c.nxt IS NULL
"""
