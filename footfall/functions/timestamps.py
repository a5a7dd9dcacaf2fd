"""Timestamps without zone. The cast is tried only on text of an accepted shape."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import QUOTES

_DATE = r"\d{4}-\d{1,2}-\d{1,2}"
_TIME = r"\d{1,2}:\d{1,2}:\d{1,2}"
_ANY_QUOTES = f"[{QUOTES}]*"
MICROS, MILLIS = 6, 3  # fraction digits that a parse keeps


def _fraction(kept: int, allowed: int) -> tuple[str, str]:
    """Patterns of up to ``kept`` fraction digits, and of those beyond them that are cut off."""
    beyond = rf"(?:(?<=\.\d{{{kept}}})\d{{1,{allowed - kept}}})?" if allowed > kept else ""
    return rf"(?:\.\d{{1,{kept}}})?", beyond


# Fixed shapes; group 1 is the text to cast.
def message_shape(kept: int = MICROS) -> str:
    """``T`` or blank between date and time, fraction optional, ``Z`` only with ``T``."""
    fraction, beyond = _fraction(kept, 9)
    return (
        rf"^\s*{_ANY_QUOTES}(?!{_DATE} .*Z)({_DATE}[T ]{_TIME}{fraction})"
        rf"{beyond}Z?{_ANY_QUOTES}\s*$"
    )


def csv_shape(kept: int = MICROS) -> str:
    """No ``Z``, and no fraction after a blank."""
    fraction, beyond = _fraction(kept, 6)
    return rf"^{_ANY_QUOTES}({_DATE}(?:T{_TIME}{fraction}| {_TIME})){beyond}{_ANY_QUOTES}$"


def iso_shape(kept: int = MICROS) -> str:
    """ISO local date-time: two-digit parts, seconds optional."""
    fraction, beyond = _fraction(kept, 9)
    return rf"^(\d{{4}}-\d{{2}}-\d{{2}}T\d{{2}}:\d{{2}}(?::\d{{2}}{fraction})?){beyond}$"


NUMBER_SHAPE = rf"^\s*{_ANY_QUOTES}([+-]?\d+(?:\.\d*)?(?:[eE][+-]?\d+)?){_ANY_QUOTES}\s*$"


# The years 1 to 9999 in epoch seconds.
FIRST_SECOND, END_SECOND = -62_135_596_800, 253_402_300_800


def _cast_shaped(c: Column, shape: str) -> Column:
    """One pass over the text: no match extracts nothing, which casts to null."""
    return F.regexp_extract(c, shape, 1).try_cast("timestamp_ntz")


def epoch_seconds(c: Column) -> Column:
    """Seconds since 1970 (whole or fractional) -> timestamp; null outside the years 1 to 9999."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    seconds = c.try_cast("decimal(18,6)")
    known = (seconds >= FIRST_SECOND) & (seconds < END_SECOND)
    return epoch + F.make_dt_interval(secs=F.when(known, seconds))


def parse_message_time(c: Column, kept: int = MICROS) -> Column:
    """Text of a topic message: a shaped date-time, or a number of epoch seconds.

    All parsers cut to ``kept`` fraction digits, in the text, which costs nothing.
    """
    number = epoch_seconds(F.regexp_extract(c, NUMBER_SHAPE, 1))
    return F.coalesce(_cast_shaped(c, message_shape(kept)), number if kept == MICROS else to_millis(number))


def parse_csv_time(c: Column, kept: int = MICROS) -> Column:
    return _cast_shaped(c, csv_shape(kept))


def parse_iso_time(c: Column, kept: int = MICROS) -> Column:
    return _cast_shaped(c, iso_shape(kept))


def to_millis(c: Column) -> Column:
    """Cut to the millisecond, the precision the tables keep. No zone takes part in it."""
    beyond = F.pmod(F.extract(F.lit("SECOND"), c), F.lit(0.001).cast("decimal(8,6)"))
    return c - F.make_dt_interval(secs=beyond.cast("decimal(18,6)"))


def time_text(c: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``, followed by six fraction digits only where there is a fraction."""
    text = c.cast("timestamp_ntz").cast("string")  # trailing zeros are cut off, and no zone takes part
    return F.when(F.contains(text, F.lit(".")), F.rpad(text, 26, "0")).otherwise(text)


def micros_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end)


def as_time(value) -> Column:
    """A ``datetime`` or text as a literal timestamp; a column is passed through."""
    return value if isinstance(value, Column) else F.lit(str(value)).cast("timestamp_ntz")
