"""Column roles: categorical, continuous, temporal."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.contract import MAX_CATEGORIES, MAX_PERIODS, NOT_PERIOD_WORDS, PERIOD_WORDS
from riskframe.operators.columns import is_category_type, is_number, value_of

_ROLE_SCHEMA = "ordinal int, column string, role string"


def at_most_distinct(df: DataFrame, limits: dict[str, int]) -> dict[str, bool]:
    """Whether each column has at most its limit of distinct non-null values, exactly.

    One scan of sketches settles every column whose estimate is far above its limit. Only
    the others, which are small, are counted exactly: their map-side combine leaves a few
    values per task, however many rows there are.
    """
    if not limits:
        return {}
    names = list(limits)
    guess = df.agg(
        *[F.approx_count_distinct(value_of(df, n)).alias(f"d{i}") for i, n in enumerate(names)]
    ).first()
    close = [n for i, n in enumerate(names) if guess[f"d{i}"] <= 4 * limits[n]]
    result = dict.fromkeys(names, False)
    if close:
        exact = df.agg(
            *[F.count_distinct(value_of(df, n)).alias(f"d{i}") for i, n in enumerate(close)]
        ).first()
        result.update({n: exact[f"d{i}"] <= limits[n] for i, n in enumerate(close)})
    return result


def split_columns(
    df: DataFrame, exclude: Iterable[str] = (), max_categories: int = MAX_CATEGORIES
) -> tuple[list[str], list[str]]:
    """Names of the categorical and of the continuous columns, in column order.

    Text and booleans are categorical, as is a number with few distinct values; any other
    number is continuous. Dates and nested types are neither.
    """
    exclude = set(exclude)
    fields = [f for f in df.schema if f.name not in exclude]
    few = at_most_distinct(
        df, {f.name: max_categories for f in fields if is_number(f.dataType)}
    )
    categorical = [f.name for f in fields if is_category_type(f.dataType) or few.get(f.name)]
    continuous = [f.name for f in fields if is_number(f.dataType) and not few[f.name]]
    return categorical, continuous


def _has_word(words: Sequence[str]) -> re.Pattern:
    return re.compile(rf"(?<![a-z0-9])(?:{'|'.join(words)})(?![a-z0-9])", re.IGNORECASE | re.ASCII)


_PERIOD, _NO_PERIOD = _has_word(PERIOD_WORDS), _has_word(NOT_PERIOD_WORDS)


def named_like_periods(columns: Iterable[str]) -> list[str]:
    """Columns whose name has a period word and no word for a count or an amount."""
    return [c for c in columns if _PERIOD.search(c) and not _NO_PERIOD.search(c)]


def period_columns(df: DataFrame, max_periods: int = MAX_PERIODS) -> list[str]:
    """Columns named like periods that hold few distinct values."""
    few = at_most_distinct(df, dict.fromkeys(named_like_periods(df.columns), max_periods))
    return [n for n, held in few.items() if held]


def _role_frame(df: DataFrame, roles: dict[str, str]) -> DataFrame:
    rows = [(i, n, roles[n]) for i, n in enumerate(df.columns) if n in roles]
    return df.sparkSession.createDataFrame(rows, _ROLE_SCHEMA)


def classify_columns(
    df: DataFrame, exclude: Iterable[str] = (), max_categories: int = MAX_CATEGORIES
) -> DataFrame:
    """``(ordinal, column, role)`` with role ``categorical`` or ``continuous``.

    To type on a head of the data only, pass ``head(df, n, order_by)``.
    """
    categorical, continuous = split_columns(df, exclude, max_categories)
    roles = dict.fromkeys(categorical, "categorical") | dict.fromkeys(continuous, "continuous")
    return _role_frame(df, roles)


def temporal_columns(df: DataFrame, max_periods: int = MAX_PERIODS) -> DataFrame:
    """``(ordinal, column, role)`` of the temporal columns."""
    return _role_frame(df, dict.fromkeys(period_columns(df, max_periods), "temporal"))
