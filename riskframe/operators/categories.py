"""Value counts of many columns at once, and what follows from them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from riskframe.functions import share
from riskframe.operators.columns import (
    cell,
    empty_frame,
    is_number,
    is_positive,
    label_value,
    melt,
    number_of,
    require,
    text_of,
)


def value_counts(
    df: DataFrame,
    columns: Sequence[str],
    target: str | None = None,
    positive=1,
    order_by: Sequence[str] = (),
    keep_null: bool = True,
) -> DataFrame:
    """``(column, value, n, positives, label_sum, label_n, first)`` over all given columns.

    One unpivot and one shuffle serve every column. Counting starts before the shuffle, so
    a value that holds a third of all rows arrives as one row per task. ``first`` is the
    first position in ``order_by`` order, null without one.
    """
    require(df, *columns, *([target] if target else []))
    if not columns:
        raise ValueError("no columns to count")
    label: dict[str, Column] = {}
    if target:
        label["__pos"] = is_positive(df, target, positive)
        label["__y"] = label_value(df, target, positive)
    if order_by:
        label["__first"] = F.struct(*order_by) if len(order_by) > 1 else F.col(order_by[0])
    # Not unpivot(): its columns are numbered anew where a plan holds it twice, and then the shuffle of
    # counts is not seen to be the same.
    pairs = [x for c in columns for x in (F.lit(c), text_of(df, c))]
    long = df.select(*[c.alias(n) for n, c in label.items()], F.stack(F.lit(len(columns)), *pairs).alias("column", "value"))
    if not keep_null:
        long = long.filter(F.col("value").isNotNull())
    none = F.lit(None)
    return long.groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("n"),
        (F.count_if("__pos") if target else F.max(none.cast("bigint"))).alias("positives"),
        (F.sum("__y") if target else F.max(none.cast("double"))).alias("label_sum"),
        (F.count("__y") if target else F.max(none.cast("bigint"))).alias("label_n"),
        (F.min("__first") if order_by else F.max(none.cast("bigint"))).alias("first"),
    )


def _top(counts: DataFrame, top: int, first_seen: bool) -> DataFrame:
    # A rank limit right above the window lets each task keep its own best rows per column
    # before the shuffle by column, so no task ever holds all categories of a column.
    ties = [F.col("first").asc()] if first_seen else [F.col("value").asc_nulls_last()]
    w = Window.partitionBy("column").orderBy(F.col("n").desc(), *ties)
    return counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)


def _with_totals(counts: DataFrame, top: int, first_seen: bool, small: bool = False) -> DataFrame:
    """The best of each column with the number of its categories and rows."""
    if small:
        # A bounded table in one partition: nothing moves.
        whole = Window.partitionBy("column")
        counts = counts.withColumns({"categories": F.count(F.lit(1)).over(whole), "rows": F.sum("n").over(whole)})
        return _top(counts, top, first_seen)
    # The ranks and the totals read one shuffle of counts. It is reused where both ask for the same
    # columns, so the totals look at those that only the ranks need; the test always holds.
    seen = F.coalesce(F.col("positives") >= 0, F.lit(True))
    if first_seen:
        seen = seen & F.coalesce(F.col("first") <= F.col("first"), F.lit(True))
    totals = counts.groupBy("column").agg(F.count_if(seen).alias("categories"), F.sum("n").alias("rows"))
    # One row per column on the broadcast side.
    return _top(counts, top, first_seen).join(F.broadcast(totals), "column")


def category_counts(
    df: DataFrame,
    columns: Sequence[str],
    target: str | None = None,
    positive=1,
    top: int = 15,
    order_by: Sequence[str] = (),
    counts: DataFrame | None = None,
    keep_null: bool = True,
    small: bool = False,
) -> DataFrame:
    """The ``top`` categories per column by count, null among them, with share of all rows,
    share of positives, and how many categories there are and are left out.

    Equal counts go by first position if ``order_by`` is given, else by value. ``counts``
    are the columns' ``value_counts`` where they are at hand, ``small`` if they are a bounded table.
    No table of all categories is written: each task gives its best per column and its totals.
    """
    if counts is None:
        counts = value_counts(df, columns, target, positive, order_by, keep_null)
    best = _with_totals(counts.coalesce(1) if small else counts, top, bool(order_by), small)
    rate = share(F.col("positives"), F.col("n")) if target else F.lit(None).cast("double")
    return best.select(
        "column",
        "value",
        "n",
        share(F.col("n"), F.col("rows")).alias("share"),
        rate.alias("positive_rate"),
        "rank",
        "categories",
        F.greatest(F.col("categories") - top, F.lit(0)).alias("hidden"),
    )


def label_by_category(
    df: DataFrame,
    columns: Sequence[str],
    target: str,
    positive=1,
    top: int = 8,
    order_by: Sequence[str] = (),
    counts: DataFrame | None = None,
) -> DataFrame:
    """Share of positives in the ``top`` categories per column."""
    if counts is None:
        counts = value_counts(df, columns, target, positive, order_by)
    rate = share(F.col("positives"), F.col("n")).alias("positive_rate")
    return _top(counts, top, bool(order_by)).select("column", "value", "n", rate, "rank")


def most_common(
    df: DataFrame, columns: Sequence[str] | None = None, order_by: Sequence[str] = ()
) -> DataFrame:
    """Cardinality and most frequent value of each non-numeric column, nulls left out."""
    if columns is None:
        columns = [f.name for f in df.schema if not is_number(f.dataType)]
    counts = value_counts(df, columns, order_by=order_by, keep_null=False)
    return _with_totals(counts, 1, bool(order_by)).select("column", "categories", "value", "n")


def with_first(df: DataFrame, counts: DataFrame, ties: Sequence[tuple[str, str | None]], order_by: Sequence[str]) -> DataFrame:
    """``counts`` with the first position of the values in ``ties``, which is all that ranking by first
    position needs; one more scan, and none without ties."""
    if not ties:
        return counts
    columns = list(dict.fromkeys(c for c, _ in ties))
    position = F.struct(*order_by) if len(order_by) > 1 else F.col(order_by[0])
    long = df.select(position.alias("__first"), *[text_of(df, c).alias(c) for c in columns]).unpivot(
        [F.col("__first")], [cell(c) for c in columns], "column", "value"
    )
    tied = df.sparkSession.createDataFrame(list(ties), "tied_column string, tied_value string")
    same = (F.col("column") == F.col("tied_column")) & F.col("value").eqNullSafe(F.col("tied_value"))
    # As many ties as there are values in the small table of counts, at most.
    firsts = long.join(F.broadcast(tied), same).groupBy("tied_column", "tied_value").agg(F.min("__first").alias("at"))
    return counts.drop("first").join(F.broadcast(firsts), same, "left").withColumnRenamed("at", "first").drop("tied_column", "tied_value")


def distinct_counts(
    df: DataFrame, columns: Sequence[str] | None = None, ranges: Mapping[str, tuple[float, float, int]] | None = None
) -> DataFrame:
    """Exact number of distinct non-null values per column (columns without any are absent).

    Numbers are unpivoted as what they are, a whole or a real number: fixed-width keys are cheaper to group
    than their texts. ``ranges`` gives the least and greatest value and the number of values of columns
    where they are known. A whole-number column whose range is dense enough is counted by bitmaps: one bit per
    value and BUCKET_BITS values in a row, so buckets move and not values.
    """
    names = list(df.columns if columns is None else columns)
    require(df, *names)
    numbers: dict[str, Column] = {}
    texts: dict[str, Column] = {}
    dense: dict[str, Column] = {}
    for name in names:
        dtype = df.schema[name].dataType
        if isinstance(dtype, T.IntegralType):
            whole = cell(name).cast("bigint")
            if _is_dense(*(ranges or {}).get(name, (None, None, 0))):
                dense[name] = whole
            else:
                numbers[name] = F.when(whole.isNotNull(), F.struct(whole.alias("whole"), F.lit(None).cast("double").alias("real")))
        elif isinstance(dtype, (T.FloatType, T.DoubleType)):
            real = number_of(df, name) + F.lit(0.0)
            numbers[name] = F.when(real.isNotNull(), F.struct(F.lit(None).cast("bigint").alias("whole"), real.alias("real")))
        else:
            texts[name] = text_of(df, name)
    parts = []
    if dense:
        value = F.col("value")
        parts.append(
            melt(df, dense, "value")
            .groupBy("column", F.bitmap_bucket_number(value).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias("bits"))
            .groupBy("column").agg(F.sum(F.bitmap_count("bits")).alias("distinct"))
        )
    for cells, keys in ((numbers, ("value.whole", "value.real")), (texts, ("value",))):
        if cells:
            pairs = melt(df, cells, "value").groupBy("column", *keys).agg(F.count(F.lit(1)).alias("n"))
            parts.append(pairs.groupBy("column").agg(F.count(F.lit(1)).alias("distinct")))
    return reduce(DataFrame.unionByName, parts) if parts else empty_frame(df, "column string, distinct bigint")


#: Values of one bitmap, a fixed size of the functions.
BUCKET_BITS = 32_768


def _is_dense(low: float | None, high: float | None, n: int) -> bool:
    """Whether the bitmaps of a range are smaller than its values, eight bytes each."""
    if low is None or high is None or max(abs(low), abs(high)) >= 2**53:
        return False
    return ((high - low) // BUCKET_BITS + 2) * (BUCKET_BITS // 8) <= 8 * n
