"""Signs that a column gives the label away."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.contract import (
    HIGH_CORRELATION,
    LEAKY_MIN_LIFT,
    LEAKY_MIN_RATE,
    LEAKY_MIN_ROWS,
)
from riskframe.functions import share
from riskframe.operators.categories import value_counts
from riskframe.operators.columns import (
    empty_frame,
    label_value,
    melt,
    number_of,
    require,
)
from riskframe.operators.profile import presence


def pearson(x: Column, y: Column) -> Column:
    # ``corr`` would raise a division by zero on a constant under ANSI rules; here it has no
    # value.
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def constant_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns among the given ones with a single value, null counted as one."""
    require(df, *columns)
    return presence(df, columns).filter("is_constant").select("column", "n")


def label_correlations(
    df: DataFrame, columns: Sequence[str], target: str, positive=1
) -> DataFrame:
    """Pearson correlation of each column with the label over rows that have both.

    Null for a constant; a column without a row that has both is absent.
    """
    require(df, target, *columns)
    if not columns:
        return empty_frame(df, "column string, n bigint, r double")
    y = label_value(df, target, positive)
    pairs = melt(
        df.filter(y.isNotNull()), {c: number_of(df, c) for c in columns}, "x", {"y": y}
    )
    return pairs.groupBy("column").agg(
        F.count(F.lit(1)).alias("n"), pearson(F.col("x"), F.col("y")).alias("r")
    )


def high_correlations(
    df: DataFrame, columns: Sequence[str], target: str, positive=1, threshold: float = HIGH_CORRELATION
) -> DataFrame:
    """Columns whose |r| with the label exceeds the threshold, strongest first."""
    r = label_correlations(df, columns, target, positive)
    return r.filter(F.abs("r") > threshold).orderBy(F.abs("r").desc(), "column")


def majority_positive_categories(
    df: DataFrame,
    columns: Sequence[str],
    target: str,
    positive=1,
    min_rows: int = LEAKY_MIN_ROWS,
    min_rate: float = LEAKY_MIN_RATE,
    min_lift: float = LEAKY_MIN_LIFT,
    counts: DataFrame | None = None,
    baseline: float | None = None,
) -> DataFrame:
    """Categories with many positives, both in absolute terms and against the base rate.

    The category's rate counts a missing label as negative, the base rate leaves it out.
    Without any positive label the lift is infinite. ``counts`` and ``baseline`` are the columns' value
    counts and the mean label where they are at hand.
    """
    if counts is None:
        counts = value_counts(df, columns, target, positive)
    base = F.lit(baseline) if baseline is not None else df.agg(F.avg(label_value(df, target, positive)).alias("base")).scalar()
    rated = counts.filter(F.col("n") >= min_rows).select(
        "column", "value", "n",
        share(F.col("positives"), F.col("n")).alias("positive_rate"),
        base.alias("baseline"),
    )
    lift = F.when(F.col("baseline") > 0, F.col("positive_rate") / F.col("baseline")).otherwise(
        F.lit(float("inf"))
    )
    return rated.withColumn("lift", lift).filter(
        (F.col("positive_rate") >= min_rate) & (F.col("lift") >= min_lift)
    )


def near_duplicates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Numeric columns equal to an earlier one: ``(column, duplicate_of)``.

    One scan fingerprints every column over all its rows and a second confirms, value by value,
    the columns that share a fingerprint.
    """
    require(df, *columns)
    number = {c: number_of(df, c) for c in columns}
    # A column without values has the fingerprint of no cells.
    prints = dict.fromkeys(columns, 0)
    if columns:
        # Any number will do that no other row of the same scan has.
        cells = melt(df, number, "x", {"row": F.monotonically_increasing_id()})
        # The row's own number goes into the hash, so equal values in other rows differ; the
        # exclusive or needs no row order and one long per column.
        marks = cells.groupBy("column").agg(F.bit_xor(F.xxhash64("row", F.col("x") + F.lit(0.0))).alias("mark"))
        prints.update({r["column"]: r["mark"] for r in marks.collect()})
    pairs = confirmed_duplicates(df, number, prints)
    return df.sparkSession.createDataFrame(pairs, "column string, duplicate_of string")


def confirmed_duplicates(
    df: DataFrame, number: dict[str, Column], prints: dict[str, int]
) -> list[tuple[str, str]]:
    """Pairs (column, first column with its fingerprint) that agree in every row."""
    first: dict[int, str] = {}
    pairs = []
    for name, mark in prints.items():
        if mark in first:
            pairs.append((name, first[mark]))
        else:
            first[mark] = name
    if not pairs:
        return []
    row = df.agg(
        *[
            F.bool_and(number[a].eqNullSafe(number[b])).alias(f"p{i}")
            for i, (a, b) in enumerate(pairs)
        ]
    ).first()
    return [pair for i, pair in enumerate(pairs) if row[f"p{i}"] is not False]
