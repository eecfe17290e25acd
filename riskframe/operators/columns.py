"""Shared column helpers of the analysis operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions import present

_REAL = (T.FloatType, T.DoubleType)


def cell(name: str) -> Column:
    """A column by its exact name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_number(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def is_category_type(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.BooleanType, T.StringType))


def value_of(df: DataFrame, name: str) -> Column:
    """The column with NaN as null."""
    c = cell(name)
    return F.when(~F.isnan(c), c) if isinstance(df.schema[name].dataType, _REAL) else c


def text_of(df: DataFrame, name: str) -> Column:
    """The column as text, one text per distinct value (negative zero is zero)."""
    c = value_of(df, name)
    if isinstance(df.schema[name].dataType, _REAL):
        c = c + F.lit(0.0)
    return c.cast("string")


def number_of(df: DataFrame, name: str) -> Column:
    """The column as double with NaN as null."""
    if isinstance(df.schema[name].dataType, _REAL):
        return present(cell(name))
    return cell(name).cast("double")


def is_positive(df: DataFrame, target: str, positive=1) -> Column:
    """True on rows of the positive class; false, not null, where the label is missing."""
    return F.coalesce(value_of(df, target) == _label(df, target, positive), F.lit(False))


def _label(df: DataFrame, target: str, positive) -> Column:
    """The positive class in the label column's own type."""
    dtype = df.schema[target].dataType
    if isinstance(dtype, T.BooleanType):
        return F.lit(positive.lower() == "true" if isinstance(positive, str) else bool(positive))
    return F.lit(str(positive)) if isinstance(dtype, T.StringType) else F.lit(positive)


def label_value(df: DataFrame, target: str, positive=1) -> Column:
    """The label as a number, null where missing. A text or boolean label counts 1 for ``positive``."""
    if isinstance(df.schema[target].dataType, (T.StringType, T.BooleanType)):
        return (cell(target) == _label(df, target, positive)).cast("double")
    return number_of(df, target)


def require(df: DataFrame, *names: str) -> None:
    """A missing column is an error before anything runs."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"no such column(s): {', '.join(missing)}")


def melt(
    df: DataFrame, cells: Mapping[str, Column], name: str, keep: Mapping[str, Column] | None = None
) -> DataFrame:
    """One row ``(column, <name>)`` per non-null cell, with the ``keep`` columns repeated.

    An aggregate grouped by ``column`` is one small piece of generated code for any number of
    columns. The same aggregates side by side grow past what the JVM compiles from about a
    dozen columns on, and then run many times slower.
    """
    keep = keep or {}
    taken = {n.lower() for n in cells}
    own = {}
    for k in keep:
        own[k] = k
        while own[k].lower() in taken:
            own[k] += "_"
    wide = df.select(
        *[c.alias(own[k]) for k, c in keep.items()], *[c.alias(n) for n, c in cells.items()]
    )
    long = wide.unpivot([F.col(o) for o in own.values()], [cell(n) for n in cells], "column", name)
    long = long.toDF(*keep, "column", name)
    return long.filter(F.col(name).isNotNull())


def listed(
    df: DataFrame, structs: Sequence[Column], names: Sequence[str], stats: DataFrame
) -> DataFrame:
    """``stats``, one row per column at most, brought to one row per struct of known facts.

    Columns without a row in ``stats`` have nulls there.
    """
    facts = df.sparkSession.range(1).select(F.inline(F.array(*structs)))
    return facts.join(F.broadcast(stats), "column", "left").select(*names)


def empty_frame(df: DataFrame, schema: str) -> DataFrame:
    return df.sparkSession.createDataFrame([], schema)


def rows_from(one_row: DataFrame, structs: Sequence[Column], schema: str) -> DataFrame:
    """Turn a one-row aggregate into one row per struct."""
    if not structs:
        return one_row.sparkSession.createDataFrame([], schema)
    return one_row.select(F.inline(F.array(*structs)))


def held(df: DataFrame) -> DataFrame:
    """A table of a few rows per column, worked out once and kept as rows in one partition."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema).coalesce(1)
