"""Counts and label rates per period, and the order of rows in time."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskframe.contract import PERIOD_JUMP
from riskframe.functions import share
from riskframe.operators.columns import cell, held, is_positive, label_value, require, text_of, value_of
from riskframe.operators.profile import FIXED_WIDTH, with_share
from riskframe.sources.scratch import materialize


def period_counts(
    df: DataFrame, column: str, target: str | None = None, positive=1
) -> DataFrame:
    """Rows, share and positive rate per period, ascending, the missing period last."""
    require(df, column, *([target] if target else []))
    hits = (
        F.count_if(is_positive(df, target, positive))
        if target
        else F.max(F.lit(None).cast("bigint"))
    )
    counts = df.groupBy(value_of(df, column).alias("period")).agg(
        F.count(F.lit(1)).alias("n"), hits.alias("hits")
    )
    rate = share(F.col("hits"), F.col("n")) if target else F.lit(None).cast("double")
    return (
        with_share(counts, df)
        .select(
            F.lit(column).alias("column"), "period", "n", "share", rate.alias("positive_rate")
        )
        .orderBy(F.col("period").asc_nulls_last())
    )


def row_order(df: DataFrame, column: str, order_by: Sequence[str]) -> DataFrame:
    """Whether the rows, taken in ``order_by`` order, are sorted by ``column``.

    ``increasing`` or ``decreasing``, not strictly; ``none`` otherwise or with any null.
    Rows are sorted by a column exactly if the stretches of positions its values occupy
    follow each other, so the rows collapse to one stretch per distinct value before any
    shuffle. The stretches are compared within ranges of values, and the ranges, one row
    each, with their neighbours. Rows at one position may stand in either order.
    """
    require(df, column)
    position = F.struct(*order_by) if len(order_by) > 1 else F.col(order_by[0])
    stretches = (
        df.select(value_of(df, column).alias("value"), position.alias("at"))
        .groupBy("value")
        .agg(F.min("at").alias("first"), F.max("at").alias("last"))
    )
    ranged = stretches.repartitionByRange("value").withColumn("range", F.spark_partition_id())
    inside = Window.partitionBy("range").orderBy("value")
    before_first, before_last = F.lag("first").over(inside), F.lag("last").over(inside)
    ends = (
        ranged.withColumn("up", F.coalesce(before_last <= F.col("first"), F.lit(True)))
        .withColumn("down", F.coalesce(before_first >= F.col("last"), F.lit(True)))
        .groupBy("range")
        .agg(
            F.bool_or(F.col("value").isNull()).alias("gap"),
            F.bool_and("up").alias("up"),
            F.bool_and("down").alias("down"),
            F.min("value").alias("low"),
            F.min_by("first", "value").alias("low_first"),
            F.min_by("last", "value").alias("low_last"),
            F.max_by("first", "value").alias("high_first"),
            F.max_by("last", "value").alias("high_last"),
        )
    )
    across = Window.orderBy("low")
    joined = ends.withColumn(
        "up", F.col("up") & F.coalesce(F.lag("high_last").over(across) <= F.col("low_first"), F.lit(True))
    ).withColumn(
        "down",
        F.col("down") & F.coalesce(F.lag("high_first").over(across) >= F.col("low_last"), F.lit(True)),
    )
    verdict = joined.agg(
        F.bool_or("gap").alias("gap"), F.bool_and("up").alias("up"), F.bool_and("down").alias("down")
    )
    return verdict.select(F.lit(column).alias("column"), _direction().alias("direction"))


def row_orders(df: DataFrame, columns: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """:func:`row_order` of several columns with few values, by one small table of stretches."""
    require(df, *columns)
    position = F.struct(*order_by) if len(order_by) > 1 else F.col(order_by[0])
    cells = df.select(position.alias("__at"), F.col(order_by[0]).alias("__lead"), *[text_of(df, c).alias(c) for c in columns])
    long = cells.unpivot([F.col("__at"), F.col("__lead")], [cell(c) for c in columns], "column", "value")
    if len(order_by) > 1 and isinstance(cells.schema["__lead"].dataType, FIXED_WIDTH):
        long = _at_ends(long)
    stretches = long.groupBy("column", "value").agg(F.min("__at").alias("first"), F.max("__at").alias("last"))
    small = held(stretches)
    found = []
    for c in columns:
        value = F.col("value").cast(df.schema[c].dataType)
        of = small.filter(F.col("column") == c).select(value.alias("value"), "first", "last")
        in_order = Window.orderBy("value")
        steps = of.select(
            "value",
            F.coalesce(F.lag("last").over(in_order) <= F.col("first"), F.lit(True)).alias("up"),
            F.coalesce(F.lag("first").over(in_order) >= F.col("last"), F.lit(True)).alias("down"),
        )
        verdict = steps.agg(F.bool_or(F.col("value").isNull()).alias("gap"), F.bool_and("up").alias("up"), F.bool_and("down").alias("down"))
        found.append(verdict.select(F.lit(c).alias("column"), _direction().alias("direction")))
    return reduce(DataFrame.unionByName, found)


def _at_ends(long: DataFrame) -> DataFrame:
    """The rows whose first position column is the least or the greatest of their value; one more scan.

    The least and greatest of whole positions, which are structs, are found by sorting rows; of a fixed-width
    column they are not, and they leave few rows. Null comes before all others.
    """
    lead = F.col("__lead")
    ends = long.groupBy("column", "value").agg(
        F.min(lead).alias("low"), F.max(lead).alias("high"), F.bool_or(lead.isNull()).alias("gap")
    )
    ends = held(ends.select(
        F.col("column").alias("end_column"), F.col("value").alias("end_value"),
        F.when(~F.col("gap"), F.col("low")).alias("low"), "high",
    ))
    same = (F.col("column") == F.col("end_column")) & F.col("value").eqNullSafe(F.col("end_value"))
    # One row per value of the columns.
    at = lead.eqNullSafe(F.col("low")) | lead.eqNullSafe(F.col("high"))
    return long.join(F.broadcast(ends), same & at, "left_semi")


def _direction() -> Column:
    return (
        F.when(F.coalesce("gap", F.lit(False)), "none")
        .when(F.coalesce("up", F.lit(True)), "increasing")
        .when(F.col("down"), "decreasing")
        .otherwise("none")
    )


def period_rates(df: DataFrame, column: str, target: str, positive=1) -> DataFrame:
    """Mean label per period with missing labels left out, and how many labels there are."""
    require(df, column, target)
    y = label_value(df, target, positive)
    return df.groupBy(value_of(df, column).alias("period")).agg(
        F.avg(y).alias("rate"), F.count(y).alias("n")
    )


def period_shifts(
    df: DataFrame,
    column: str,
    target: str,
    positive=1,
    threshold: float = PERIOD_JUMP,
    min_drop: float | None = None,
    rates: DataFrame | None = None,
) -> DataFrame:
    """Periods whose mean label changed by more than ``threshold`` times the previous one.

    A period without labels keeps the last known rate; a rise from zero is an infinite
    change. A drop is at most one, so it is only reported with ``min_drop``, the share of
    the previous rate it must lose. The series is sorted into ranges of periods; each range is
    walked by itself and starts from the last rate known in the ranges before it. ``rates`` are the
    column's ``period_rates`` where they are at hand in few rows, which one task then walks.
    """
    in_time = F.col("period").asc_nulls_last()
    if rates is not None:
        walk = Window.orderBy(in_time)
        known = F.last("rate", ignorenulls=True).over(walk.rowsBetween(Window.unboundedPreceding, 0))
        series = rates.coalesce(1).withColumn("known", known).withColumn("previous_rate", F.lag("known").over(walk))
        return _flagged(series, column, threshold, min_drop)
    rates = period_rates(df, column, target, positive).repartitionByRange(in_time)
    ranged = materialize(rates.withColumn("range", F.spark_partition_id()), "period-rates")
    inside = Window.partitionBy("range").orderBy(in_time)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    known = F.last("rate", ignorenulls=True)
    # One row per range.
    ends = ranged.groupBy("range").agg(F.max_by("rate", F.when(F.col("rate").isNotNull(), F.struct(F.col("period").isNull(), "period"))).alias("end"))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("range", F.last("end", ignorenulls=True).over(earlier).alias("carried"))
    series = ranged.join(F.broadcast(ends), "range").withColumn("known", F.coalesce(known.over(upto), "carried"))
    series = series.withColumn("previous_rate", F.coalesce(F.lag("known").over(inside), "carried"))
    return _flagged(series, column, threshold, min_drop)


def _flagged(series: DataFrame, column: str, threshold: float, min_drop: float | None) -> DataFrame:
    now, then = F.col("known"), F.col("previous_rate")
    change = F.when((then == 0) & (now > 0), F.lit(float("inf"))).otherwise(
        F.try_divide(now, then) - 1
    )
    flagged = F.abs(F.col("change")) > threshold
    if min_drop is not None:
        flagged = flagged | (F.col("change") <= -min_drop)
    return (
        series.withColumn("change", change)
        .filter(flagged)
        .select(
            F.lit(column).alias("column"),
            F.col("period").cast("string").alias("period"),
            "n",
            F.col("known").alias("rate"),
            "previous_rate",
            "change",
        )
    )
