"""Timestamp rules: wall clock and offset are kept apart, nothing is shifted to UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions.text import clean_text, iso_text

_YEAR = "(?!0000)[0-9]{4}"
_OFFSET = r"Z|[+-](?:[01][0-9]|2[0-3])(?::?[0-5][0-9](?::?[0-5][0-9])?)?"
_CLOCK = r"[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}"
_DAY = "[0-9]{1,2}"
# What the cast to timestamp_ntz reads as it stands.
_PLAIN = (
    rf"^{_YEAR}-[0-9]{{2}}-[0-9]{{2}}"
    r"(?:[T ][0-9]{2}:[0-9]{2}(?::[0-9]{2}(?:\.[0-9]{1,6})?)?)?\z"
)
# Other ISO spellings: compact dates and times, hour only, comma or long fraction, offset.
_ISO = (
    rf"^({_YEAR})(-?)([0-9]{{2}})\2([0-9]{{2}})"
    r"(?:[T ]([0-9]{2})(?:(:?)([0-9]{2})(?:\6([0-9]{2})(?:[.,]([0-9]{1,6})[0-9]*)?)?)?"
    rf"(?:{_OFFSET})?)?\z"
)
_ISO_DIGITS = "$1$3$4$5$7$8"
_ISO_FRACTION = "$9"
_FOURTEEN = "^(....)(..)(..)(..)(..)(..)"
# Written layouts and what they become. Day/month comes before month/day; a text cannot
# be a valid date under both unless the first of the two applies.
_LAYOUTS = (
    (rf"^({_YEAR})-({_DAY})-({_DAY})(?:(?:\s+|T)({_CLOCK}))?\z", "$1-$2-$3 $4"),
    (rf"^({_DAY})/(0?[1-9]|1[0-2])/({_YEAR})(?:\s+({_CLOCK}))?\z", "$3-$2-$1 $4"),
    (rf"^({_DAY})/({_DAY})/({_YEAR})\s+({_CLOCK})\z", "$3-$1-$2 $4"),
    (rf"^({_YEAR})/({_DAY})/({_DAY})\s+({_CLOCK})\z", "$1-$2-$3 $4"),
)
_TAIL_OFFSET = rf"^[0-9-]{{8,10}}[T ][0-9:.,]+?({_OFFSET})\z"


def wall_clock(text: Column) -> Column:
    """Wall-clock time of clean text: ISO 8601 first, then the written layouts, else null.

    The text is brought into the usual spelling and cast once. A row that already has it
    is settled by the first branch and never pays for the rarer ones.
    """
    digits = F.rpad(F.regexp_replace(text, _ISO, _ISO_DIGITS), 14, "0")
    fraction = F.rpad(F.regexp_replace(text, _ISO, _ISO_FRACTION), 6, "0")
    spelled = F.when(text.rlike(_PLAIN), text).when(
        text.rlike(_ISO),
        F.concat(F.regexp_replace(digits, _FOURTEEN, "$1-$2-$3 $4:$5:$6"), F.lit("."), fraction),
    )
    for shape, form in _LAYOUTS:
        spelled = spelled.when(text.rlike(shape), F.regexp_replace(text, shape, form))
    return spelled.try_cast("timestamp_ntz")


def offset_text(text: Column) -> Column:
    """Offset of clean text as ``+hh:mm`` (``Z`` is ``+00:00``); null without a time or offset."""
    signed = F.regexp_replace(F.regexp_extract(text, _TAIL_OFFSET, 1), "Z", "+0000")
    padded = F.rpad(F.translate(signed, ":", ""), 7, "0")
    minutes = F.regexp_replace(padded, "^(...)(..)00$", "$1:$2")
    seconds = F.regexp_replace(minutes, "^(...)(..)(..)$", "$1:$2:$3")
    # Cheap signs of an offset first: Z at the end, or + or - behind the date.
    hint = text.endswith("Z") | text.contains("+") | F.substring(text, 11, 40).contains("-")
    return F.when(
        hint & text.rlike(_TAIL_OFFSET), F.regexp_replace(seconds, "^-00:00$", "+00:00")
    )


def parse_timestamp(c: Column, dtype: T.DataType | None = None) -> Column:
    """Wall-clock time of a text, date or timestamp column; null if it does not parse."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return c.cast("timestamp_ntz")
    return wall_clock(clean_text(c, dtype))


def timestamp_offset(c: Column, dtype: T.DataType | None = None) -> Column:
    """Offset written after a time of day, else null."""
    if dtype is not None and not isinstance(dtype, T.StringType):
        return F.lit(None).cast("string")
    return offset_text(clean_text(c))


def timestamp_text(c: Column, dtype: T.DataType | None = None) -> Column:
    """ISO 8601 text of the parsed time with its own offset; null if it does not parse."""
    return F.concat(
        iso_text(parse_timestamp(c, dtype)), F.coalesce(timestamp_offset(c, dtype), F.lit(""))
    )


def instant(wall: Column, offset: Column) -> Column:
    """UTC wall clock of a local time and its offset (no offset counts as UTC)."""
    sign = F.when(F.substring(offset, 1, 1) == "-", -1).otherwise(1)
    minutes = (
        F.substring(offset, 2, 2).cast("int") * 60 + F.substring(offset, 5, 2).cast("int")
    )
    shift = F.coalesce(sign * minutes, F.lit(0))
    return wall - F.make_dt_interval(mins=shift)
