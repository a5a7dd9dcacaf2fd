"""Text to typed value, with null for whatever does not parse."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, functions as F

BLANKS = " \t\r\n\f\v"
QUOTES = "\"'"


def snake_name(name: str) -> str:
    """``eventTitle`` -> ``event_title``. Used while the plan is built, never per row."""
    return re.sub("([A-Z])", r"_\1", name).lower().lstrip("_")


def strip(c: Column, chars: str = BLANKS) -> Column:
    return F.btrim(c, F.lit(chars))


def is_empty(c: Column) -> Column:
    return c.isNull() | (c == "")


_OUTER_QUOTES = r"""(?s)\A(["'])(?:(.*)\1)?\z"""


def _has_quote(c: Column) -> Column:
    return F.contains(c, F.lit('"')) | F.contains(c, F.lit("'"))


def safe_string(c: Column) -> Column:
    """Trim, drop one pair of outer quotes, undouble quotes; missing or empty gives null.

    Most texts have no quote, so the regular expression is kept for those that do.
    """
    is_null = (F.length(c) == 4) & (F.lower(c) == "null")
    bare = strip(F.when(~is_null, c))
    text = F.regexp_replace(bare, _OUTER_QUOTES, "$2")
    for quote in QUOTES:
        text = F.replace(text, F.lit(quote * 2), F.lit(quote))
    return F.nullif(F.when(_has_quote(c), text).otherwise(bare), F.lit(""))


def safe_int(c: Column, kind: str = "int") -> Column:
    """Whole numbers only: ``"123.45"`` is null, not 123."""
    return strip(c, QUOTES).try_cast(kind)


def safe_double(c: Column) -> Column:
    # A trailing d or f after a digit is a Java literal suffix, not a number.
    lower = F.lower(c)
    suspect = (F.contains(lower, F.lit("d")) | F.contains(lower, F.lit("f"))) & c.rlike(r"[0-9.][dDfF][\s\"']*$")
    return F.when(~suspect, strip(c, QUOTES).try_cast("double"))


def metadata_map(c: Column) -> Column:
    """JSON object text -> map of text. Anything else gives an empty map; JSON null gives ``null``.

    One pair of quotes around the whole text is dropped; of a repeated key the last value counts.
    """
    empty = F.create_map().cast("map<string,string>")
    stripped = strip(c)
    quoted = F.startswith(stripped, F.lit('"')) | F.startswith(stripped, F.lit("'"))
    bare = F.when(quoted, F.regexp_replace(stripped, _AROUND_ALL, "$2")).otherwise(stripped)
    return F.coalesce(text_values(F.from_json(bare, "map<string,string>")), empty)


_AROUND_ALL = r"""(?s)\A(["'])(.*)\1\z"""


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` mentions it.

    A column is an expression: mentioned in a lambda, it would be computed again for every element.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def last_of_each(entries: Column) -> Column:
    """Map entries without those whose key comes again later."""
    def without_earlier(listed: Column) -> Column:
        keys = F.transform(listed, lambda e: e["key"])

        def last(entry: Column, i: Column) -> Column:
            return ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), entry["key"])

        repeats = F.size(F.array_distinct(keys)) < F.size(keys)
        return F.when(repeats, F.filter(listed, last)).otherwise(listed)

    return bound(entries, without_earlier)


def text_values(m: Column) -> Column:
    """A parsed map with ``null`` for missing values and one entry per key."""
    entries = F.transform(
        F.map_entries(m),
        lambda e: F.struct(e["key"].alias("key"), F.coalesce(e["value"], F.lit("null")).alias("value")),
    )
    return F.map_from_entries(last_of_each(entries))


# One stretch of a field: quoted (by either quote) or bare. A backslash takes the next character
# along; a quote left open runs to the end of the line. The quantifiers are possessive, so long
# fields cost neither backtracking nor stack.
def _quoted_body(quote: str) -> str:
    return rf"(?:[^{quote}\\]++|{quote}{quote}|\\.)*+"


_QUOTED = {quote: rf"{quote}{_quoted_body(quote)}(?:{quote}|\\?\z)" for quote in QUOTES}
_BARE = r"""(?:[^,"'\\]++|\\.|\\\z)++"""
_STRETCH = "|".join((*_QUOTED.values(), _BARE))


def split_quoted_line(line: Column) -> Column:
    r"""Split a line of the two-quote CSV dialect into its fields, unquoted and stripped.

    Both ``"`` and ``'`` quote, a doubled quote is a literal one, ``\x`` stands for ``x``.
    """
    # A leading comma makes every field start with one, so empty fields match too.
    fields = F.regexp_extract_all(
        F.concat(F.lit(","), line), F.lit(f"(?s),((?:{_STRETCH})*+)"), F.lit(1)
    )
    return F.transform(fields, lambda field: strip(_plain_field(field)))


def _plain_field(field: Column) -> Column:
    stretches = F.regexp_extract_all(field, F.lit(f"(?s){_STRETCH}"), F.lit(0))
    joined = F.array_join(F.transform(stretches, _plain_stretch), "")
    return F.when(field.rlike(r"""["'\\]"""), joined).otherwise(field)


def _plain_stretch(stretch: Column) -> Column:
    text = F.regexp_replace(stretch, r"(?s)\\(.)", "$1")
    for quote in QUOTES:
        body = F.regexp_extract(
            stretch, rf"(?s)\A{quote}({_quoted_body(quote)}\\?){quote}?\z", 1
        )
        unquoted = F.regexp_replace(body, rf"(?s){quote}({quote})|\\(.)", "$1$2")
        text = F.when(stretch.startswith(quote), unquoted).otherwise(text)
    return text
