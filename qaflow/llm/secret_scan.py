"""Secret scans: pattern candidates, then structural confirmation by decoding.

Three base patterns (assignments, access ids, hex runs) give the base spans, left to right without
overlap within a kind. Structural kinds are added only when the decoded bytes parse to their end:

* ``key``: base64 or hex that decodes to an ASN.1 private or public key (nested lengths that fill the
  outer one exactly, an object identifier or version where the encoding has one) or to an OpenSSH key
  (nested 32-bit lengths), inside a ``BEGIN ... KEY`` frame or bare, with the standard or the URL-safe
  base64 alphabet; base64 may be cut into lines, whose ends may be written as a backslash and ``n``
  (keys in JSON). Bare lines are joined as far as the length in the key's own header says;
* ``token``: a signed token ``header.payload.signature`` in base64url whose header is a JSON object with
  a string ``alg`` and whose payload is a JSON object.

Every text is scanned whole. Offsets are code points, ends exclusive. Defined cases: a null text is
empty; no finding gives empty lists; repeated rows give repeated results; other columns are ignored.
The work is a per-row map without shuffle, so no key can be hot.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qaflow.llm.common import read, unused

KINDS = ("assign", "access", "hex", "key", "token")
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
_CHAR = "[A-Za-z0-9+/_-]"
_START = rf"(?<!{_CHAR})(?:(?<=\\)[nrt])?+"  # the letter of an escaped white space is no part of a run
_EOL = r"(?:\r\n?|\n|(?:\\+r)?\\+n)[\x20\t]*"
B64 = re.compile(rf"{_START}({_CHAR}{{40,}}={{0,2}})")
ONE_ALPHABET = (re.compile(r"[A-Za-z0-9+/]{40,}={0,2}"), re.compile(r"[A-Za-z0-9_-]{40,}={0,2}"))
INNER_KEY = re.compile(r"(?<=[+/_-])(?=M[A-P]|AAAA|b3Bl)")
WRAPPED = re.compile(rf"{_START}((?:M[A-P]|AAAA|b3Bl){_CHAR}{{6,}}+(?:{_EOL}{_CHAR}++)++)")
LINE = re.compile(rf"\\+[nr]|({_CHAR}++)")
FRAME = re.compile(r"-----BEGIN ([A-Z0-9 ]*KEY)-----((?:[A-Za-z0-9+/=\s_]++|\\++[nr/]|-(?!----(?:BEGIN|END)))++)-----END \1-----")
TOKEN = re.compile(r"(?<![A-Za-z0-9_.-])(e[wy][A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)")
FINDINGS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                                     T.StructField("end", T.LongType()), T.StructField("detail", T.StringType())]))


def _length(data: bytes, at: int) -> tuple[int, int] | None:
    """Length and content start of an ASN.1 element whose length begins at ``at``; None if not minimal or cut."""
    if at >= len(data):
        return None
    first = data[at]
    if first < 128:
        return first, at + 1
    n = first & 127
    if n not in (1, 2, 3, 4) or at + 1 + n > len(data) or data[at + 1] == 0:
        return None
    size = int.from_bytes(data[at + 1:at + 1 + n], "big")
    return (size, at + 1 + n) if size >= 128 else None


def _children(data: bytes, depth: int = 0) -> list[tuple[int, bytes]] | None:
    """The elements that fill ``data`` exactly, sequences checked all the way down; else None."""
    out, at = [], 0
    while at < len(data):
        tag, got = data[at], _length(data, at + 1)
        if got is None or got[1] + got[0] > len(data):
            return None
        body = data[got[1]:got[1] + got[0]]
        if tag & 0x20 and (depth > 8 or _children(body, depth + 1) is None):
            return None
        out.append((tag, body))
        at = got[1] + got[0]
    return out


def _asn1_key(data: bytes) -> str | None:
    if len(data) < 24 or data[0] != 0x30:
        return None
    outer = _children(data)
    if outer is None or len(outer) != 1:
        return None
    parts = _children(outer[0][1]) or []
    tags = [t for t, _ in parts]
    if len(tags) >= 9 and set(tags[:9]) == {2} and len(parts[1][1]) >= 32:
        return "pkcs1-private"
    if tags[:3] == [2, 0x30, 4] and len(parts[0][1]) == 1 and parts[1][1][:1] == b"\x06":
        return "pkcs8-private"
    if tags[:2] == [2, 4] and parts[0][1] == b"\x01" and len(parts[1][1]) >= 16:
        return "ec-private"
    if tags[:2] == [0x30, 4] and parts[0][1][:1] == b"\x06":
        return "pkcs8-encrypted"
    if tags == [0x30, 3] and parts[0][1][:1] == b"\x06":
        return "public"
    return None


def _ssh_key(data: bytes) -> str | None:
    def fields(at: int, n: int) -> int | None:
        for _ in range(n):
            if at + 4 > len(data):
                return None
            at += 4 + int.from_bytes(data[at:at + 4], "big")
            if at > len(data):
                return None
        return at

    magic = b"openssh-key-v1\0"
    if data.startswith(magic):
        at = fields(len(magic), 3)
        if at is None or at + 4 > len(data):
            return None
        keys = int.from_bytes(data[at:at + 4], "big")
        return "openssh-private" if 1 <= keys <= 64 and fields(at + 4, keys + 1) == len(data) else None
    if re.match(rb"\0\0\0.(ssh-|ecdsa-|sk-)", data, re.S):
        at, n = 0, 0
        while at is not None and at < len(data):
            at, n = fields(at, 1), n + 1
        return "ssh-public" if at == len(data) and n >= 2 else None
    return None


def _decode(text: str) -> bytes | None:
    text = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(text) % 4 == 1:
        return None
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _key(data: bytes | None) -> str | None:
    return data and (_asn1_key(data) or _ssh_key(data)) or None


def _key_sizes(text: str, at: int) -> Iterator[int]:
    """The sizes in bytes that the header of a key whose base64 begins at ``at`` allows."""
    def take(start: int, n: int) -> bytes:
        data = _decode(text[at + start // 3 * 4:at + -(-(start + n) // 3) * 4]) or b""
        return data[start % 3:start % 3 + n]

    def after(start: int) -> int | None:
        size = take(start, 4)
        return start + 4 + int.from_bytes(size, "big") if len(size) == 4 else None

    if text[at] == "M":
        if got := _length(take(0, 6), 1):
            yield got[0] + got[1]
        return
    magic = b"openssh-key-v1\0"
    openssh = take(0, len(magic)) == magic
    end, todo, n = len(magic) if openssh else 0, 3 if openssh else 64, 0
    while n < todo and (end := after(end)) is not None:
        n += 1
        if not openssh and n > 1:
            yield end
    if openssh and end is not None and len(keys := take(end, 4)) == 4 and 1 <= int.from_bytes(keys, "big") <= 64:
        end, n = end + 4, int.from_bytes(keys, "big") + 1
        while n and (end := after(end)) is not None:
            n -= 1
        if end is not None:
            yield end


def _run_keys(run: str) -> Iterator[tuple[int, int, str]]:
    """The keys in a maximal run of base64 characters: all of it, else behind a prefix, else in one alphabet."""
    kind = _key(bytes.fromhex(run)) if len(run) % 2 == 0 and re.fullmatch(r"(?i)[0-9a-f]+", run) else None
    if kind := kind or _key(_decode(run)):
        yield 0, len(run), kind
        return
    size = len(run.rstrip("="))
    for m in INNER_KEY.finditer(run):
        if any(m.start() + -(-4 * n // 3) == size for n in _key_sizes(run, m.start())) and (kind := _key(_decode(run[m.start():]))):
            yield m.start(), len(run), kind
            return
    seen = set()
    for alphabet in ONE_ALPHABET:
        for m in alphabet.finditer(run):
            if m.span() in seen or m[0] == run:
                continue
            seen.add(m.span())
            kind = _key(bytes.fromhex(m[0])) if len(m[0]) % 2 == 0 and re.fullmatch(r"(?i)[0-9a-f]+", m[0]) else None
            if kind := kind or _key(_decode(m[0])):
                yield m.start(), m.end(), kind


def _wrapped_keys(text: str, start: int, end: int) -> Iterator[tuple[int, int, str]]:
    """The keys in base64 lines without a frame: each ends with the line in which its header says it does."""
    spans = [m.span(1) for m in LINE.finditer(text, start, end) if m[1]]
    joined = "".join(text[a:b] for a, b in spans)
    begin, ends, at = [], {}, 0
    for i, (a, b) in enumerate(spans):
        begin.append(at)
        at += b - a
        ends[at] = i
    i = 0
    while i < len(spans):
        last = i
        if joined.startswith(("M", "AAAA", "b3Bl"), begin[i]):
            for n in _key_sizes(joined, begin[i]):
                stop = begin[i] + -(-4 * n // 3)
                if ends.get(stop, i) > i and (kind := _key(_decode(joined[begin[i]:stop]))):
                    last = ends[stop]
                    yield spans[i][0], re.compile("={0,2}").match(text, spans[last][1]).end(), kind
                    break
        i = last + 1


def _json_object(text: str) -> dict | None:
    data = _decode(text)
    try:
        got = json.loads(data.decode("utf-8")) if data else None
    except (ValueError, RecursionError):
        return None
    return got if isinstance(got, dict) else None


def base_findings(text: str) -> list[tuple[str, int, int, str]]:
    out = [("assign", m.start(), m.end(), m[1].lower()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        out += [("access", m.start(), m.end(), "") for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    return out + [("hex", m.start(), m.end(), "") for m in HEX.finditer(text)]


def confirmed_findings(text: str) -> list[tuple[str, int, int, str]]:
    out, done = [], []
    if "-----BEGIN " in text:
        for m in FRAME.finditer(text):
            if kind := _key(_decode(re.sub(r"\\+[nr]|\\+(?=/)|\s", "", m[2]))):
                out.append(("key", m.start(), m.end(), kind))
                done.append((m.start(), m.end()))
    for m in WRAPPED.finditer(text):
        for a, b, kind in _wrapped_keys(text, m.start(1), m.end(1)):
            if not any(x <= a < y for x, y in done):
                out.append(("key", a, b, kind))
                done.append((a, b))
    for m in B64.finditer(text):
        if any(a <= m.start(1) < b for a, b in done):
            continue
        out += [("key", m.start(1) + a, m.start(1) + b, kind) for a, b, kind in _run_keys(m[1])]
    if ".e" in text or "ey" in text or "ew" in text:
        for m in TOKEN.finditer(text):
            head = _json_object(m[1])
            if head is not None and isinstance(head.get("alg"), str) and _json_object(m[2]) is not None:
                out.append(("token", m.start(), m.end(), head["alg"]))
    return out


def _ordered(found: list) -> list:
    return sorted(found, key=lambda f: (f[1], KINDS.index(f[0]), f[2]))


def scan(df: DataFrame, text: str = "text", to: str = "findings") -> DataFrame:
    """``df`` with the column ``to``: an array of (kind, start, end, detail) by start, then kind.

    A column of ``df`` that is already called ``to`` is replaced."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("detail", pa.string())]))
        for batch in batches:
            found = [[dict(zip(("kind", "start", "end", "detail"), f)) for f in _ordered(base_findings(t) + confirmed_findings(t))]
                     for t in (x.as_py() or "" for x in batch.column(batch.num_columns - 1))]
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(found, kind)], names=[*batch.schema.names[:-1], to])

    kept = df.drop(to)
    schema = T.StructType([*kept.schema.fields, T.StructField(to, FINDINGS)])
    return kept.select("*", kept[text].alias(unused(kept, "scanned"))).mapInArrow(rows, schema)


def digest(found: list) -> str:
    return ",".join(f"{f['kind']}:{f['start']}:{f['end']}" for f in found)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = scan(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    base = F.filter("findings", lambda f: f["kind"].isin("assign", "access", "hex"))
    line = lambda a: F.array_join(F.transform(a, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ",")
    n = lambda k: F.size(F.filter("findings", lambda f: f["kind"] == k)).cast("long").alias(f"n_{k}")
    return got.select("doc_id", n("assign"), n("access"), n("hex"), F.sha2(line(base), 256).alias("base_sha256"), line(F.col("findings")).alias("spans"))
