"""Expressions over one event: category, day, keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .timestamps import time_text


def event_category(event_type: Column, title: Column) -> Column:
    """``view``, ``click`` or ``other``: by exact type, else by a word in the title."""
    lower_title = F.lower(title)
    chain = F.when(event_type.isin("view", "VIEW"), "view")
    chain = chain.when(event_type.isin("click", "CLICK"), "click")
    for word in ("view", "click"):
        chain = chain.when(lower_title.contains(word), word)
    return chain.otherwise("other")


def event_day(created_at: Column) -> Column:
    return F.to_date(created_at)


def percent(part: Column, whole: Column) -> Column:
    """``part / whole * 100``; 0 where there is no whole."""
    ratio = F.try_divide(part.cast("double"), whole.cast("double"))
    return F.coalesce(ratio * 100.0, F.lit(0.0))


def content_id(*columns: Column) -> Column:
    """A stable id for a record that carries none, so that a second run gives the same one."""
    mark = F.lit("\0")
    return F.md5(F.concat_ws("\x1f", *(F.coalesce(c.cast("string"), mark) for c in columns)))


# The columns that make two events the same, besides the two coordinates.
DUPLICATE_NAMES = ("id", "user_id", "session_id", "type", "created_at")


def duplicate_coordinates() -> tuple[Column, Column]:
    """``x`` and ``y`` as they count for sameness: a missing coordinate is 0."""
    return F.coalesce("x", F.lit(0)), F.coalesce("y", F.lit(0))


def duplicate_hash() -> Column:
    """MD5 over everything that makes two events the same, as text."""
    parts = [
        time_text(F.col(name)) if name == "created_at" else F.col(name).cast("string")
        for name in DUPLICATE_NAMES
    ]
    parts += [c.cast("string") for c in duplicate_coordinates()]
    return F.md5(F.concat_ws("_", *(F.coalesce(part, F.lit("None")) for part in parts)))
