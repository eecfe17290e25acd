"""Text rules as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.contract import (
    CHANNELS,
    FALSE_TEXT,
    MISSING_TEXT,
    TRUE_TEXT,
    WHITESPACE,
)


_LONGEST_MARKER = max(map(len, MISSING_TEXT))


def strip(c: Column) -> Column:
    """Drop white space of any kind from both ends (plain ``trim`` only drops spaces)."""
    return F.trim(c, F.lit(WHITESPACE))


def _number_text(c: Column) -> Column:
    # Whole numbers print without a fraction; others in plain decimal notation, because
    # the JVM switches to an exponent from 1e7 on. A decimal keeps the shortest digits.
    c = c.cast("double")
    whole = c.cast("decimal(38,0)").cast("string")
    plain = F.rtrim(c.cast("decimal(38,18)").cast("string"), F.lit("0"))
    size = F.abs(c)
    return (
        F.when(F.isnan(c), None)
        .when((c == F.floor(c)) & (size < 1e18), whole)
        .when((size >= 1e-4) & (size < 1e16), plain)
        .otherwise(c.cast("string"))
    )


def _clean(c: Column) -> Column:
    # Most cells begin and end with a visible ASCII character and need no stripping, which
    # is the costly part.
    first, last = F.substring(c, 1, 1), F.substring(c, -1, 1)
    visible = first.between("!", "~") & last.between("!", "~")
    text = F.when(visible, c).otherwise(strip(c))
    # Only short texts are lower-cased.
    missing = (F.length(text) <= _LONGEST_MARKER) & F.lower(text).isin(*MISSING_TEXT)
    return F.when(~missing, text)


def clean_text(c: Column, dtype: T.DataType | None = None) -> Column:
    """Stripped text, or null for an empty-cell marker. ``dtype`` is the column's type."""
    if dtype is None or isinstance(dtype, (T.StringType, T.NullType)):
        return _clean(c.cast("string"))
    if isinstance(dtype, T.BooleanType):
        return F.initcap(c.cast("string"))
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return _number_text(c)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return iso_text(c.cast("timestamp_ntz"))
    return c.cast("string")


def iso_text(ntz: Column) -> Column:
    """ISO 8601 text of a wall-clock time: seconds always, six fraction digits if any.

    Built from the plain string cast: ``date_format`` would pass through the session zone
    and move a time that falls into a daylight-saving gap.
    """
    text = ntz.cast("string")
    fraction = F.substring(text, 21, 6)
    return F.concat(
        F.translate(F.substring(text, 1, 19), " ", "T"),
        F.when(fraction != "", F.concat(F.lit("."), F.rpad(fraction, 6, "0"))).otherwise(""),
    )


def truth(text: Column) -> Column:
    """Boolean of clean text."""
    word = F.lower(text)
    return F.when(word.isin(*TRUE_TEXT), True).when(word.isin(*FALSE_TEXT), False)


def channel_form(text: Column) -> Column:
    """Clean text in capitals, every run of other characters as one underscore."""
    return F.trim(F.regexp_replace(F.upper(text), "[^A-Z0-9]+", "_"), F.lit("_"))


def currency_form(text: Column) -> Column:
    """Upper-cased clean text if it is three letters, else null."""
    code = F.upper(text)
    return F.when(code.rlike(r"^[A-Z]{3}\z"), code)


def four_digits(text: Column) -> Column:
    """Clean text if it is exactly four digits, else null."""
    return F.when(text.rlike(r"^[0-9]{4}\z"), text)


def parse_bool(c: Column, dtype: T.DataType | None = None) -> Column:
    """True/false tokens in any case; numbers only 0 and 1; anything else is null."""
    if isinstance(dtype, T.BooleanType):
        return c
    if isinstance(dtype, T.NumericType):
        return F.when(c == 1, True).when(c == 0, False)
    return truth(clean_text(c))


def normalize_channel(
    c: Column, allowed: tuple[str, ...] = CHANNELS, dtype: T.DataType | None = None
) -> Column:
    """Channel label in canonical form if it is an allowed one, else null."""
    code = channel_form(clean_text(c, dtype))
    return F.when(code.isin(*allowed), code)


def normalize_currency(c: Column, dtype: T.DataType | None = None) -> Column:
    """Upper-cased three-letter code, else null."""
    return currency_form(clean_text(c, dtype))


def card_suffix(c: Column, dtype: T.DataType | None = None) -> Column:
    """Exactly four digits with leading zeros kept, else null."""
    return four_digits(clean_text(c, dtype))
