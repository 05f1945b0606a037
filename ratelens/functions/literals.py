"""Python list literals as Spark expressions, without a Python worker.

Texts as ``repr`` mostly writes them (single quotes, no escapes) are cut at ``', '``.
All others go through a small grammar made of built-in functions:

1. one anchored regular expression cuts the text into tokens, each match where
   the last one ended: string literals, numbers, names and ``[ ] ,``;
2. the tokens must cover the text, and their kinds, written as one letter
   each, must be a list (adjacent strings count as one, a trailing comma is allowed);
3. strings lose their quotes and escapes, numbers and names are written as
   ``str()`` writes them;
4. the pieces between two commas are one item.

Not in the grammar, so no list (NULL): tuples, sets, dicts, nested lists, raw,
bytes and triple-quoted strings, ``\\N{...}``, escaped surrogates, other than decimal numbers, comments.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ratelens.functions.expr import col

_BLANK = r"[ \t\f\r\n]*+"
#: What may follow a backslash in a string: hexadecimal and octal numbers of a character, or any other one.
_ESCAPE = (r"\\(?:x[0-9A-Fa-f]{2}|u(?![dD][89A-Fa-f])[0-9A-Fa-f]{4}|U(?!0000[dD][89A-Fa-f])00(?:0[0-9A-Fa-f]|10)[0-9A-Fa-f]{4}"
           r"|[0-7]{1,3}|\r\n|[^xuUN0-7\x00])")


def _string(quote: str) -> str:
    run = rf"[^{quote}\\\r\n\x00]*+"
    return rf"{quote}{run}(?:{_ESCAPE}{run})*+{quote}"


_STRING = rf"[uU]?(?:(?!'''|\"\"\")(?:{_string(chr(39))}|{_string(chr(34))}))"
_DIGITS = r"[0-9](?:_?[0-9])*+"
_FLOAT = rf"(?:(?:{_DIGITS})?\.{_DIGITS}|{_DIGITS}\.?)(?:[eE][+-]?{_DIGITS})?"
_NUMBER = rf"[+-]?{_FLOAT}"
#: A token, or all that is left where none begins, whose first group is empty.
_TOKEN = rf"\G(?:{_BLANK}({_STRING}|(?:{_NUMBER}|None|True|False)(?![\w.'\"])|[\[\],]){_BLANK}|[\s\S]++)"
_INTEGER = r"^[+-]?(?:0(?:_?0)*+|[1-9](?:_?[0-9])*+)$"
#: One escape, or a run without one.
_RUNS = rf"{_ESCAPE}|[^\\]++"
#: Stands for a comma between items, with 1 behind it; a text's own one gets a 0 behind it, a None is one with 2.
_MARK = "\x01"
# fixed values: Python's escapes by letter and what they stand for
_LETTERS = {"\\": "\\", "'": "'", '"': '"', "a": "\x07", "b": "\x08", "f": "\x0c", "n": "\n", "r": "\r", "t": "\t", "v": "\x0b",
            "\n": "", "\r": "", "\r\n": ""}


def _character(run: Column) -> Column:
    """A run of a string's content with its escape (if it is one) replaced; unknown escapes stay."""
    kind = F.substring(run, 2, 1)
    digits = F.when(kind.isin("x", "u", "U") & (F.length(run) > 2), F.substring(run, 3, 8)).when(
        kind.between("0", "7"), F.conv(F.substring(run, 2, 3), 8, 16))
    out = F.when(~run.startswith("\\"), run).when(digits.isNotNull(), F.decode(F.unhex(F.lpad(digits, 8, "0")), "UTF-32"))
    for letter, char in _LETTERS.items():
        out = out.when(F.substring(run, 2, 2) == letter, F.lit(char))
    return out.otherwise(run)


def _content(token: Column) -> Column:
    """The characters of a string token."""
    start = F.when(F.substring(token, 1, 1).isin("u", "U"), 3).otherwise(2)
    inner = F.substring(token, start, F.length(token) - start)
    return F.when(~token.contains("\\"), inner).otherwise(
        F.array_join(F.transform(F.regexp_extract_all(inner, F.lit(_RUNS), F.lit(0)), _character), ""))


def _number(token: Column) -> Column:
    """``str()`` of a number: integers without underscores, floats in the shortest form."""
    minus = F.when(token.startswith("-"), "-").otherwise("")
    body = F.regexp_replace(token, F.lit("^[+-]|_"), F.lit(""))
    whole = F.regexp_replace(body, F.lit("^0+(?=[0-9])"), F.lit(""))
    value = body.try_cast("double")
    java = value.cast("string")
    mantissa = F.regexp_replace(F.regexp_extract(java, r"^([0-9.]+)E", 1), F.lit(r"\.0$"), F.lit(""))
    power = F.regexp_extract(java, r"E(-?[0-9]+)$", 1).try_cast("int")
    digits = F.replace(mantissa, F.lit("."), F.lit(""))
    # Python writes a power of ten from 16 on and below -4
    steps = F.abs(power).cast("string")
    short = (F.when(power.isNull(), java)
             .when((power >= 0) & (power < 16) & (F.length(digits) <= power + 1), F.concat(F.rpad(digits, power + 1, "0"), F.lit(".0")))
             .when((power >= 0) & (power < 16), F.concat(F.substring(digits, F.lit(1), power + 1), F.lit("."), F.substring(digits, power + 2, F.lit(30))))
             .when(power == -4, F.concat(F.lit("0.000"), digits))
             .otherwise(F.concat(mantissa, F.lit("e"), F.when(power < 0, "-").otherwise("+"), F.when(F.length(steps) < 2, "0").otherwise(""), steps)))
    integer = F.when(whole == "0", F.lit("0")).otherwise(F.concat(minus, whole))
    return (F.when(token.rlike(_INTEGER), integer)
            .when(java == "Infinity", F.concat(minus, F.lit("inf"))).otherwise(F.concat(minus, short)))


def _shape(token: Column) -> Column:
    """One letter a token: S a string, A any other item, I no item (an integer with leading zeros, or no token), or the sign itself."""
    return (F.when(token.isin("[", "]", ","), token).when(F.substring(token, -1, 1).isin("'", '"'), F.lit("S")).when(token == "", F.lit("I"))
            .when(token.rlike(r"^[+-]?0[0-9_]*$") & ~token.rlike(_INTEGER), F.lit("I")).otherwise(F.lit("A")))


def _once(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once a row, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _by_grammar(x: Column, none: str | None) -> Column:
    tokens = F.regexp_extract_all(x, F.lit(_TOKEN), F.lit(1))
    return _once(tokens, lambda t: _once(F.regexp_replace(F.array_join(F.transform(t, _shape), ""), F.lit("S+"), F.lit("A")),
                                         lambda shape: _items(t, shape, none)))


def _items(tokens: Column, shape: Column, none: str | None) -> Column:
    between = F.size(tokens) - F.when(shape.endswith(",]"), 3).otherwise(2)  # without the brackets and a trailing comma

    def piece(t: Column) -> Column:
        return (F.when(t == ",", _MARK + "1")
                .when(F.substring(t, -1, 1).isin("'", '"'), F.replace(_content(t), F.lit(_MARK), F.lit(_MARK + "0")))
                .when(t == "None", _MARK + "2" if none is None else none)
                .when(t.isin("True", "False"), t).otherwise(_number(t)))
    listed = F.array_join(F.transform(F.slice(tokens, F.lit(2), between), piece), "")
    items = F.transform(F.split(listed, _MARK + "1"), lambda i: F.when(i == _MARK + "2", F.lit(None).cast("string")).otherwise(
        F.replace(i, F.lit(_MARK + "0"), F.lit(_MARK))))
    empty = F.array().cast("array<string>")
    return F.when(shape == "[]", empty).when(shape.rlike(r"^\[(?:A,)*+A?\]$"), items)


def python_list(c: str | Column, none: str | None = None) -> Column:
    """A Python list literal (text) as ``array<string>`` of its items' ``str()``; NULL if it is none.

    ``None`` items become NULL, or the text ``none`` where one is given.
    """
    x = F.rtrim(F.ltrim(col(c)))
    inner = F.substring(x, F.lit(3), F.length(x) - 4)
    plain = (x.startswith("['") & x.endswith("']") & (F.length(x) > 4)
             & ~F.replace(inner, F.lit("', '"), F.lit("")).rlike(r"['\\\r\n\x00]"))
    return F.when(plain, F.split(inner, "', '")).otherwise(_by_grammar(x, none))
