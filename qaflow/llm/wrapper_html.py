"""HTML extraction by wrapper induction over the pages of a host.

Pages of a host come to a task as one sorted stream. The first ``REFERENCES`` different pages of the stream are
its references; every page's DOM tree is aligned with each reference by simple tree matching (the largest
order-preserving matching of equally labelled nodes; neighbouring siblings of one label form a run, whose
members are matched in order). A matched node whose text is equal on both sides is constant: template. One whose
text varies is a slot. A reference that shares 0.8 of the page's text or more is a copy and says nothing.

The content root is the ``article`` or ``main`` element with the most varying text (with its like siblings), else
the deepest element that holds most of the page's varying text. Of the root go: elements that are no article text
by their tag or by the words in their class, id or role (menus, headers, footers, sidebars, notices, adverts,
forms, scripts, styles, reader comments; the words don't count on what holds most of the page), and template nodes: those that at least two references hold (one, if
there is no other). In an ``article`` or ``main`` prose elements (paragraphs, headings, list items, quotes) always
stay, since documents may well share a passage. Without such an element, lists that are mostly links go too.

A host that holds a large share of all pages (and over ``STREAM``) is split by page into streams, each with its
own references, so no task takes a whole hot host, and a task holds a few pages at a time. Child lists whose matching
would compare more than ``PAIRS`` nodes are matched greedily in order, and nodes deeper than ``DEPTH`` count as
slots; either only changes what is known to be template.

Defined cases: null or empty html gives the empty text; a null url or one without a host is a page by itself;
repeated rows are each returned; cut tags and comments at the end are dropped; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qaflow.llm.common import partitions, read

REFERENCES = 3
STREAM = 1000
PAIRS = 200_000
DEPTH = 150

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
SCOPE = frozenset("html body div article section main aside nav header footer td th li dd dt table ul ol dl blockquote figure form button object fieldset details".split())
SELF_CLOSING = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
                "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
DROP_TAGS = frozenset("nav header footer aside form script style noscript template iframe svg canvas object button select textarea input dialog menu head title".split())
DROP_WORDS = frozenset("""ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu
    breadcrumb breadcrumbs header masthead footer sidebar aside comment comments disqus respond replies cookie cookies consent gdpr notice alert
    newsletter subscribe subscription signup popup modal overlay share sharing social related recommended recommendations widget pagination pager
    login search complementary contentinfo""".split())
READERS = frozenset("comment comments disqus respond replies related recommended recommendations".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre dd dt td th figcaption".split())

TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>")
HINT = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.IGNORECASE)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Node:
    __slots__ = ("tag", "label", "words", "kids", "sig", "size", "linked", "vary", "seen")

    def __init__(self, tag: str, attributes: str = ""):
        got = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in HINT.finditer(attributes)} if attributes.strip() else {}
        self.tag, self.kids = tag, []
        self.label = tag + "." + re.sub(r"\d+", "", got.get("class", ""))
        self.words = frozenset(w.lower() for v in got.values() for w in WORD.findall(v))
        self.seen = 0

    def boilerplate(self) -> bool:
        words = READERS if self.tag in ("article", "main") else DROP_WORDS
        return self.tag in DROP_TAGS or bool(self.words & words) and self.tag not in ("html", "body")


def parse(page: str) -> Node:
    """The DOM tree of ``page``: lenient about unclosed and stray tags, one pass over the text."""
    root = Node("#")
    stack, opened = [root], {}

    def close(upto: int):
        while len(stack) > upto:
            opened[stack.pop().tag] -= 1

    def close_within(tags, scope):
        if not any(opened.get(t) for t in tags):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                return close(i)
            if stack[i].tag in scope:
                return

    def text(s: str):
        if s:
            stack[-1].kids.append(entities.unescape(s) if "&" in s else s)

    at, n = 0, len(page)
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            text(page[at:])
            break
        text(page[at:lt])
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        after = page[lt + 1:lt + 3]
        if after[:1] in ("!", "?"):
            end = page.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        if not re.match("/?[a-zA-Z]", after):
            text("<")
            at = lt + 1
            continue
        m = TAG.match(page, lt)
        if m:
            closing, tag, attributes, at = m[1], m[2].lower(), m[3], m.end()
        else:
            end = page.find(">", lt)
            if end < 0:
                break
            bare = re.match(r"(/?)([a-zA-Z][^\s/>]*)", page[lt + 1:end])
            closing, tag, attributes, at = bare[1], bare[2].lower(), "", end + 1
        if closing:
            if opened.get(tag):
                i = len(stack) - 1
                while stack[i].tag != tag:
                    i -= 1
                close(i)
            continue
        if tag in CLOSES_P:
            close_within({"p"}, SCOPE)
        if tag in SELF_CLOSING:
            close_within(*SELF_CLOSING[tag])
        node = Node(tag, attributes)
        stack[-1].kids.append(node)
        if tag in VOID:
            continue
        if tag in RAW:
            end = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.IGNORECASE).search(page, at)
            if end is None:
                break
            gt = page.find(">", end.end())
            at = n if gt < 0 else gt + 1
            continue
        stack.append(node)
        opened[tag] = opened.get(tag, 0) + 1
    nodes = walk(root)
    for node in reversed(nodes):
        parts, node.size, node.linked = [], 0, 0
        for kid in node.kids:
            if isinstance(kid, str):
                words = kid.split()
                parts += words
                node.size += sum(map(len, words))
            else:
                parts.append(kid.sig)
                node.size += kid.size
                node.linked += kid.linked
        if node.tag == "a":
            node.linked = node.size
        node.sig = hash((node.tag, *parts))
    dropped = {id(k) for n in nodes for k in n.kids if not isinstance(k, str) and k.tag in DROP_TAGS and n.tag not in DROP_TAGS}
    total = root.size - sum(n.size for n in nodes if id(n) in dropped)
    for node in nodes:  # "with-sidebar" on the element that holds the page says nothing about it
        if 2 * node.size > total and not node.words & READERS:
            node.words = frozenset()
    return root


def walk(root: Node) -> list[Node]:
    """The nodes under ``root`` and itself, parents first."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo += [k for k in reversed(node.kids) if not isinstance(k, str)]
    return out


def _runs(node: Node) -> list[list[Node]]:
    out: list[list[Node]] = []
    for kid in node.kids:
        if isinstance(kid, str):
            continue
        if out and out[-1][0].label == kid.label:
            out[-1].append(kid)
        else:
            out.append([kid])
    return out


def match(a: Node, b: Node) -> list[tuple[Node, Node]]:
    """Simple tree matching of two trees with equally labelled roots: the matched pairs of nodes."""
    left = [PAIRS]

    def run(x: list[Node], y: list[Node], depth: int):
        out: list[tuple[Node, Node]] = []
        for p, q in zip(x, y):
            out += pairs(p, q, depth)
        return out

    def pairs(p: Node, q: Node, depth: int):
        out = [(p, q)]
        x, y = _runs(p), _runs(q)
        left[0] -= 1
        if not x or not y or depth >= DEPTH:
            return out
        if [r[0].label for r in x] == [r[0].label for r in y]:
            for r, s in zip(x, y):
                out += run(r, s, depth + 1)
            return out
        if len(x) * len(y) > left[0]:
            j = 0
            places: dict[str, list[int]] = {}
            for k, s in enumerate(y):
                places.setdefault(s[0].label, []).append(k)
            for r in x:
                nxt = next((k for k in places.get(r[0].label, ()) if k >= j), None)
                if nxt is not None:
                    out += run(r, y[nxt], depth + 1)
                    j = nxt + 1
            return out
        left[0] -= len(x) * len(y)
        got = {(i, j): run(r, s, depth + 1) for i, r in enumerate(x) for j, s in enumerate(y) if r[0].label == s[0].label}
        most = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        for i in range(len(x)):
            for j in range(len(y)):
                most[i + 1][j + 1] = max(most[i][j + 1], most[i + 1][j], most[i][j] + len(got[i, j]) if (i, j) in got else 0)
        i, j, kept = len(x), len(y), []
        while i and j:
            if (i - 1, j - 1) in got and most[i][j] == most[i - 1][j - 1] + len(got[i - 1, j - 1]):
                i, j = i - 1, j - 1
                kept.append(got[i, j])
            elif most[i][j] == most[i - 1][j]:
                i -= 1
            else:
                j -= 1
        for some in reversed(kept):
            out += some
        return out

    return pairs(a, b, 0)


def mark_template(page: Node, references: list[Node]) -> None:
    """Set ``vary`` of every node (characters of text that no reference holds at the same place; a node that is
    template has none) from the references that are not copies of ``page``."""
    nodes, votes = walk(page), 0
    for other in references:
        same = [p for p, q in match(page, other) if p.size and p.sig == q.sig]
        held = {id(p) for p in same}
        inner = {id(k) for p in same for k in p.kids if not isinstance(k, str)}
        if 10 * sum(p.size for p in same if id(p) not in inner) >= 8 * page.size:
            continue
        votes += 1
        for node in nodes:
            node.seen += id(node) in held
    need = min(2, votes) or 1
    for node in reversed(nodes):
        own = sum(len("".join(k.split())) for k in node.kids if isinstance(k, str))
        node.seen = int(node.seen >= need)
        node.vary = 0 if node.seen else own + sum(k.vary for k in node.kids if not isinstance(k, str) and not k.boilerplate())


def content_roots(page: Node) -> tuple[list[Node], bool]:
    """The elements that hold the article, in page order, and whether their tag says so."""
    nodes = walk(page)
    parent = {id(k): n for n in nodes for k in n.kids if not isinstance(k, str)}
    inside = set()
    for n in nodes:
        up = parent.get(id(n))
        if up is not None and (id(up) in inside or up.tag in DROP_TAGS or up.words & READERS):
            inside.add(id(n))
    for tag in ("article", "main"):
        named = [n for n in nodes if n.tag == tag and n.size and id(n) not in inside and not n.boilerplate()]
        if named:
            top = max(named, key=lambda n: n.vary)
            if not top.vary:
                top = max(named, key=lambda n: n.size)
            up = parent.get(id(top))
            return [n for n in named if n is top or n.label == top.label and parent.get(id(n)) is up], True
    at = page
    while True:
        inner = [k for k in at.kids if not isinstance(k, str) and not k.boilerplate() and k.tag not in INLINE and k.tag not in PROSE and k.vary >= 0.8 * at.vary > 0]
        if not inner:
            return [at], False
        at = inner[0]


def blocks(root: Node, named: bool) -> list[str]:
    out: list[str] = []
    held: list[str] = []

    def flush():
        if got := " ".join("".join(held).split()):
            out.append(got)
        held.clear()

    todo: list[Node | str | None] = [root]
    while todo:
        x = todo.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            held.append(x)
        elif x.tag == "br":
            held.append(" ")
        else:
            if x is not root:
                template = x.seen and (not named or x.tag not in PROSE and x.tag not in INLINE)
                menu = not named and x.tag in ("ul", "ol", "div") and 10 * x.linked > 6 * x.size and x.linked
                if x.boilerplate() or template or menu:
                    if x.tag not in INLINE:
                        flush()
                    continue
            if x.tag not in INLINE:
                flush()
                todo.append(None)
            todo += reversed(x.kids)
    flush()
    return out


def main_text(page: str | None, references: list[str] = ()) -> str:
    """The article of ``page``, given other pages of its host."""
    return _extract(parse(page), [parse(r) for r in references if r != page]) if page else ""


def _extract(page: Node, references: list[Node]) -> str:
    mark_template(page, references)
    roots, named = content_roots(page)
    return "\n\n".join(b for r in roots for b in blocks(r, named))


class _Stream:
    """The pages of one host in order of their digests: references first, then page by page."""

    def __init__(self):
        self.references: list[tuple[int, str, Node]] = []
        self.last: tuple[int, str, str] | None = None

    def text(self, digest: int, page: str) -> str:
        if self.last is None or self.last[:2] != (digest, page):
            others = [node for d, p, node in self.references if (d, p) != (digest, page)]
            self.last = (digest, page, _extract(parse(page), others))
        return self.last[2]


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages(page_id, url, html)``."""
    spark = pages.sparkSession
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("host", F.when(host != "", host)).withColumn("digest", F.xxhash64("html"))
    # at most 4 * partitions hosts hold more than that share of all rows, whatever the table's size
    share = 4 * partitions(spark)
    sizes = pages.select(host.alias("host")).where("host <> ''").groupBy("host").count()
    most = max(pages.count() / share, STREAM)
    hot = sizes.where(F.col("count") > most).select("host", F.ceil(F.col("count") / most).cast("int").alias("streams"))
    spread = F.xxhash64("page_id", "url", F.when(F.col("host").isNull(), F.col("digest")))
    salt = F.when(F.col("host").isNull(), spread).otherwise(F.pmod(spread, F.coalesce("streams", F.lit(1)).cast("long")))
    rows = rows.join(F.broadcast(hot), "host", "left").withColumn("salt", salt).drop("streams")
    rows = rows.repartition(partitions(spark), "host", "salt").sortWithinPartitions("host", "salt", "digest", "page_id")

    def run(batches):
        key, stream, waiting = None, _Stream(), []

        def ready():
            got = [(i, u, stream.text(d, h)) for i, u, d, h in waiting]
            waiting.clear()
            return got

        def record(got):
            return pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in got], pa.int64()), pa.array([x[1] for x in got], pa.string()), pa.array([x[2] for x in got], pa.string()), pa.array([len(x[2]) for x in got], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                out = []
                for row in zip(*(c.to_pylist() for c in batch.slice(lo, 256).columns)):
                    i, u, h, host, salt, d = row
                    if (host, salt) != key:
                        out += ready()
                        key, stream = (host, salt), _Stream()
                    if host is not None and len(stream.references) < REFERENCES and h and all((d, h) != r[:2] for r in stream.references):
                        stream.references.append((d, h, parse(h)))
                    waiting.append((i, u, d, h))
                    if host is None or len(stream.references) == REFERENCES or len(waiting) >= 64:
                        out += ready()
                yield record(out)
        yield record(ready())

    return rows.select("page_id", "url", "html", "host", "salt", "digest").mapInArrow(run, "page_id long, url string, text string, n_chars long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages"))
