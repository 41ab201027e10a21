"""Python list literals of strings and line escapes as column expressions (F10, and what the line sinks need).

A literal is a regular language as long as it is one list of strings, so it is read by three regular
expressions: one that accepts the whole literal, one that cuts it into its strings and one that cuts a
string into plain runs and escapes.  All quantifiers are possessive: a long literal neither
backtracks nor recurses.  What is no such list (numbers, nested lists, an open quote) gives null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from qaflow.functions.text import _c

_WS = r"[\s\f]*+"
_ONE = r"'[^'\\\n\r]*+(?:\\[\s\S][^'\\\n\r]*+)*+'"
_TWO = r'"[^"\\\n\r]*+(?:\\[\s\S][^"\\\n\r]*+)*+"'
_STRING = f"(?:{_ONE}|{_TWO})"
_ITEM = rf"{_STRING}(?:{_WS}{_STRING})*+"  # strings side by side are one string
_LIST = rf"\A{_WS}\[{_WS}(?:{_ITEM}{_WS}(?:,{_WS}{_ITEM}{_WS})*+,?+{_WS})?+\]{_WS}\z"
_PIECE = r"[^\\]++|\\(?:x[0-9a-fA-F]{2}|u[0-9a-fA-F]{4}|U[0-9a-fA-F]{8}|[0-7]{1,3}|\r\n|[\s\S])"

# ---------------------------------------------------------------------------
# Fixed values of the literal syntax: the letter after a backslash and what it stands for.
# ---------------------------------------------------------------------------
ESCAPES = {"\\": "\\", "'": "'", '"': '"', "a": "\a", "b": "\b", "f": "\f", "n": "\n", "r": "\r", "t": "\t", "v": "\v",
           "\n": "", "\r\n": "", "\r": ""}


def _char(hex_digits: Column) -> Column:
    """The character of a code point in hexadecimal digits."""
    return F.decode(F.unhex(F.lpad(hex_digits, 8, "0")), "UTF-32")


def _unescape_piece(p: Column) -> Column:
    rest = F.substring(p, 2, 1 << 30)
    known = F.create_map(*[F.lit(x) for kv in ESCAPES.items() for x in kv])
    return (F.when(~p.startswith("\\"), p)
            .when(rest.rlike(r"\A[xuU][0-9a-fA-F]{2,8}\z"), _char(F.substring(rest, 2, 8)))
            .when(rest.rlike(r"\A[0-7]{1,3}\z"), _char(F.conv(rest, 8, 16)))
            .otherwise(F.coalesce(F.element_at(known, rest), p)))


def unescape(x) -> Column:
    """The value of what stands between the quotes of a Python string literal."""
    x = _c(x)
    pieces = F.regexp_extract_all(x, F.lit(f"({_PIECE})"), F.lit(1))
    return F.when(F.instr(x, "\\") == 0, x).otherwise(F.array_join(F.transform(pieces, _unescape_piece), ""))


def parse_list(x) -> Column:
    """``ast.literal_eval`` of a list of strings as ``array<string>``; null for anything else."""
    x = _c(x)
    items = F.regexp_extract_all(x, F.lit(f"({_ITEM})"), F.lit(1))

    def value(item):
        strings = F.regexp_extract_all(item, F.lit(f"({_STRING})"), F.lit(1))
        return F.array_join(F.transform(strings, lambda s: unescape(F.substring(s, F.lit(2), F.length(s) - 2))), "")

    return F.when(x.rlike(_LIST), F.transform(items, value))


def list_literal(values) -> Column:
    """``repr`` of a list of strings: single quotes, unless a value holds one and no double quote."""
    def one(v):
        quote = F.when((F.instr(v, "'") > 0) & (F.instr(v, '"') == 0), F.lit('"')).otherwise(F.lit("'"))
        body = F.replace(v, F.lit("\\"), F.lit("\\\\"))
        for char, name in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
            body = F.replace(body, F.lit(char), F.lit(name))
        body = F.when(quote == "'", F.replace(body, F.lit("'"), F.lit("\\'"))).otherwise(body)
        return F.concat(quote, body, quote)

    return F.concat(F.lit("["), F.array_join(F.transform(_c(values), one), ", "), F.lit("]"))


def escape_line(x) -> Column:
    """A value as one line: backslash, line feed and carriage return become two characters each."""
    out = F.replace(_c(x), F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(out, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def unescape_line(x) -> Column:
    """The inverse of :func:`escape_line`."""
    x = _c(x)
    pieces = F.regexp_extract_all(x, F.lit(r"([^\\]++|\\[\s\S]?+)"), F.lit(1))
    known = F.create_map(*[F.lit(v) for v in ("\\\\", "\\", "\\n", "\n", "\\r", "\r")])
    plain = F.array_join(F.transform(pieces, lambda p: F.coalesce(F.element_at(known, p), p)), "")
    return F.when(F.instr(x, "\\") == 0, x).otherwise(plain)
