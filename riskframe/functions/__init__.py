from riskframe.functions.numbers import parse_number, percentage, present, share
from riskframe.functions.text import (
    card_suffix,
    clean_text,
    iso_text,
    normalize_channel,
    normalize_currency,
    parse_bool,
    strip,
)
from riskframe.functions.times import (
    instant,
    parse_timestamp,
    timestamp_offset,
    timestamp_text,
)

__all__ = [
    "card_suffix", "clean_text", "instant", "iso_text", "normalize_channel",
    "normalize_currency", "parse_bool", "parse_number", "parse_timestamp", "percentage",
    "present", "share", "strip", "timestamp_offset", "timestamp_text",
]
