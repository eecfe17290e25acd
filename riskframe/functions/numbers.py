"""Number rules as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.contract import CURRENCY_SIGNS, WHITESPACE

# Fixed value: sign, digits with well-formed thousands groups, optional fraction.
NUMBER_SHAPE = r"^[+-]?(([0-9]{1,3}(,[0-9]{3})+|[0-9]+)(\.[0-9]*)?|\.[0-9]+)\z"
_PLAIN = r"^[+-]?[0-9]{1,300}(\.[0-9]{0,300})?\z"


def parse_number(c: Column, dtype: T.DataType | None = None) -> Column:
    """Finite double from a number or from text such as ``- $5,000.00``; null otherwise.

    Plain digits, the usual case, are settled by one test and one cast. A cast is only
    tried on text of the right shape: a failing one costs an exception.
    """
    if isinstance(dtype, T.BooleanType):
        return F.lit(None).cast("double")
    if isinstance(dtype, T.NumericType):
        return _finite(c.cast("double"))
    text = c.cast("string")
    digits = F.translate(text, CURRENCY_SIGNS + WHITESPACE, "")
    written = F.replace(digits, F.lit(","), F.lit("")).try_cast("double")
    return F.when(text.rlike(_PLAIN), text.try_cast("double")).when(
        digits.rlike(NUMBER_SHAPE),
        F.when(F.octet_length(text) < 300, written).otherwise(_finite(written)),
    )


def _finite(number: Column) -> Column:
    # NaN sorts above infinity, so one comparison drops both.
    return F.when(F.abs(number) < float("inf"), number)


def share(part: Column, whole: Column) -> Column:
    """``part / whole``, 0 when there is no whole."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def percentage(part: Column, whole: Column) -> Column:
    """Share in percent, 0 when there is no whole."""
    return share(part, whole) * 100


def present(c: Column) -> Column:
    """A double with NaN as null: Spark counts NaN as a value, the analyses do not."""
    number = c.cast("double")
    return F.when(~F.isnan(number), number)
