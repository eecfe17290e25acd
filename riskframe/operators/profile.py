"""Overview, data quality, feature profile and class balance."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions import share
from riskframe.operators.categories import distinct_counts
from riskframe.operators.columns import (
    empty_frame,
    is_number,
    is_positive,
    listed,
    melt,
    number_of,
    require,
    rows_from,
    value_of,
)

_STATS = (
    "ordinal", "column", "type", "n", "missing", "missing_share", "is_constant", "neg_one",
    "other_negative", "mean", "std", "min", "max",
)
# Presence and constancy are three small aggregates per column; this many columns side by
# side still make code the JVM compiles.
_SIDE_BY_SIDE = 16
FIXED_WIDTH = (
    T.IntegralType, T.FloatType, T.DoubleType, T.BooleanType, T.DateType, T.TimestampType,
    T.TimestampNTZType,
)


def overview(df: DataFrame) -> DataFrame:
    """``(ordinal, column, type)`` of every column."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema)]
    return df.sparkSession.createDataFrame(rows, "ordinal int, column string, type string")


def dataset_size(df: DataFrame) -> DataFrame:
    """``(n, columns)``: logical rows and number of columns."""
    return df.agg(
        F.count(F.lit(1)).alias("n"), F.lit(len(df.columns)).alias("columns")
    )


def can_compare(dtype: T.DataType) -> bool:
    return not isinstance(dtype, (T.MapType, T.VariantType))


def presence(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: rows, missing cells and whether it has a single value, null counted as one.

    Wide tables are taken a few columns at a time, texts apart from fixed-width columns: one
    text minimum would take the hash aggregate away from all others. A columnar source
    reads no column twice.
    """
    names = list(df.columns if columns is None else columns)
    if not names:
        return empty_frame(df, "column string, n bigint, missing bigint, is_constant boolean")
    fixed = [c for c in names if isinstance(df.schema[c].dataType, FIXED_WIDTH)]
    groups = [
        kind[start : start + _SIDE_BY_SIDE]
        for kind in (fixed, [c for c in names if c not in fixed])
        for start in range(0, len(kind), _SIDE_BY_SIDE)
    ]
    parts = []
    for group in groups:
        sums, rows = [F.count(F.lit(1)).alias("n")], []
        for i, name in enumerate(group):
            c = value_of(df, name)
            same = F.min(c) == F.max(c) if can_compare(df.schema[name].dataType) else F.lit(None)
            sums += [F.count(c).alias(f"have{i}"), same.cast("boolean").alias(f"same{i}")]
            n, have = F.col("n"), F.col(f"have{i}")
            constant = F.when(have == 0, True).otherwise((have == n) & F.col(f"same{i}"))
            rows.append(
                F.struct(
                    F.lit(name).alias("column"),
                    n.alias("n"),
                    (n - have).alias("missing"),
                    constant.alias("is_constant"),
                )
            )
        parts.append(df.agg(*sums).select(F.inline(F.array(*rows))))
    return reduce(DataFrame.unionByName, parts)


def moments(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per numeric column with a value: sentinels, other negatives, mean, std and range."""
    if columns is None:
        columns = [f.name for f in df.schema if is_number(f.dataType)]
    if not columns:
        return empty_frame(
            df,
            "column string, neg_one bigint, other_negative bigint, mean double, std double, "
            "min double, max double",
        )
    x = F.col("x")
    return (
        melt(df, {c: number_of(df, c) for c in columns}, "x")
        .groupBy("column")
        .agg(
            F.count_if(x == -1).alias("neg_one"),
            F.count_if((x < 0) & (x != -1)).alias("other_negative"),
            F.avg(x).alias("mean"),
            F.stddev_samp(x).alias("std"),
            F.min(x).alias("min"),
            F.max(x).alias("max"),
        )
    )


def column_scan(df: DataFrame) -> DataFrame:
    """Per column: type, missing, constancy, sentinel and other negatives, mean, std, range.

    Two aggregates with one small row per column and task: presence of all columns side by
    side, and the moments of the numeric ones.
    """
    facts = [
        F.struct(
            F.lit(i).alias("ordinal"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.lit(is_number(f.dataType)).alias("number"),
        )
        for i, f in enumerate(df.schema)
    ]
    # One row per column on either side.
    seen = presence(df).join(F.broadcast(moments(df)), "column", "left")

    def counted(name: str) -> Column:
        return F.when(F.col("number"), F.coalesce(name, F.lit(0).cast("bigint")))

    return (
        listed(df, facts, ["number", *[c for c in _STATS if c != "missing_share"]], seen)
        .withColumns(
            {
                "missing_share": share(F.col("missing"), F.col("n")),
                "neg_one": counted("neg_one"),
                "other_negative": counted("other_negative"),
            }
        )
        .select(*_STATS)
    )


def column_stats(df: DataFrame, distinct: str = "exact") -> DataFrame:
    """``column_scan`` plus the number of distinct non-null values.

    ``exact`` counts them through one shuffle of (column, value) pairs per kind of column;
    ``approximate`` by a sketch per column.
    """
    if distinct == "approximate":
        guess = df.agg(
            *[F.approx_count_distinct(value_of(df, c)).alias(f"d{i}") for i, c in enumerate(df.columns)]
        )
        pairs = [
            F.struct(F.lit(c).alias("column"), F.col(f"d{i}").alias("distinct"))
            for i, c in enumerate(df.columns)
        ]
        counts = guess.select(F.inline(F.array(*pairs)))
    elif distinct == "exact":
        counts = distinct_counts(df)
    else:
        raise ValueError(f"unknown distinct: {distinct!r}")
    # One row per column on the broadcast side.
    stats = column_scan(df).join(F.broadcast(counts), "column", "left")
    stats = stats.withColumn("distinct", F.coalesce("distinct", F.lit(0).cast("bigint")))
    first = ["ordinal", "column", "type", "n", "missing", "missing_share", "distinct"]
    return stats.select(*first, *[c for c in stats.columns if c not in first])


def missing_values(df: DataFrame) -> DataFrame:
    """Columns with missing values, most first."""
    stats = presence(df).filter(F.col("missing") > 0)
    rate = share(F.col("missing"), F.col("n")).alias("missing_share")
    return stats.select("column", "missing", rate).orderBy(F.desc("missing"), "column")


def constant_columns(df: DataFrame) -> DataFrame:
    """Columns with a single value, null counted as one."""
    return presence(df).filter("is_constant").select("column")


def negative_values(df: DataFrame) -> DataFrame:
    """Count and share of the sentinel -1 and of other negatives per numeric column."""
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    stats = moments(df).withColumn("n", total)
    return stats.select(
        "column",
        "neg_one",
        share(F.col("neg_one"), F.col("n")).alias("neg_one_share"),
        "other_negative",
        share(F.col("other_negative"), F.col("n")).alias("other_negative_share"),
    )


def duplicate_rows(
    df: DataFrame, columns: Sequence[str] | None = None, digest: bool = False, n: int | None = None
) -> DataFrame:
    """Rows beyond the first of each group of identical rows; null equals null.

    Groups by the values themselves. ``digest`` does it in two phases: rows are grouped by two
    differently seeded 64-bit hashes, sixteen bytes per row whatever the width, and only rows whose
    hashes repeat are then grouped by their values. Both are exact; the second costs less where rows are
    wide and mostly unique, and it runs its first phase at once. ``n`` is the number of rows where it is
    at hand.
    """
    names = list(df.columns if columns is None else columns)
    require(df, *names)
    keys = [value_of(df, n) for n in names]
    rows = df.select(*[k.alias(f"k{i}") for i, k in enumerate(keys)])
    if digest:
        # The hash skips nulls, so their places go in as well.
        cells = [F.col(c) for c in rows.columns]
        nulls = F.concat_ws("", *[F.when(k.isNull(), "1").otherwise("0") for k in cells])
        marks = {m: F.xxhash64(F.lit(i), nulls, *cells) for i, m in ((1, "a"), (2, "b"))}
        total = df.agg(F.count(F.lit(1)).alias("n")).scalar() if n is None else F.lit(n).cast("bigint")
        again = rows.select(*[m.alias(name) for name, m in marks.items()]).groupBy("a", "b").count()
        again = again.filter(F.col("count") > 1).select("a", "b")
        if again.isEmpty():
            if n is not None:
                return df.sparkSession.createDataFrame([(n, 0, 0.0)], "n bigint, duplicates bigint, share double").coalesce(1)
            return df.sparkSession.range(1).select(total.alias("n"), F.lit(0).cast("bigint").alias("duplicates"), F.lit(0.0).alias("share")).coalesce(1)
        rows = rows.withColumns(marks).join(again, ["a", "b"], "left_semi")
        groups = rows.groupBy(*[f"k{i}" for i in range(len(keys))]).agg(F.count(F.lit(1)).alias("copies"))
        extra = F.coalesce(F.sum(F.col("copies") - 1), F.lit(0))
        found = groups.agg(extra.alias("duplicates")).withColumn("n", total)
        return found.select("n", "duplicates", share(F.col("duplicates"), F.col("n")).alias("share"))
    groups = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies"))
    total = F.coalesce(F.sum("copies"), F.lit(0))
    extra = F.coalesce(F.sum(F.col("copies") - 1), F.lit(0))
    return groups.agg(
        total.alias("n"), extra.alias("duplicates"), share(extra, total).alias("share")
    )


def quality_warnings(df: DataFrame) -> DataFrame:
    """``(warning, n)``: mostly missing columns, constant columns, duplicate rows; n > 0 only."""
    stats = presence(df).agg(
        F.count_if(share(F.col("missing"), F.col("n")) > 0.5).alias("missing"),
        F.count_if("is_constant").alias("constant"),
    )
    found = rows_from(
        stats,
        [
            F.struct(F.lit("columns_over_half_missing").alias("warning"), F.col("missing").alias("n")),
            F.struct(F.lit("constant_columns").alias("warning"), F.col("constant").alias("n")),
        ],
        "warning string, n bigint",
    )
    copies = duplicate_rows(df).select(
        F.lit("duplicate_rows").alias("warning"), F.col("duplicates").alias("n")
    )
    return found.unionByName(copies).filter(F.col("n") > 0)


def class_counts(df: DataFrame, target: str) -> DataFrame:
    """Rows and share per label value in value order, null kept and last."""
    require(df, target)
    counts = df.groupBy(value_of(df, target).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return with_share(counts, df).orderBy(F.col("value").asc_nulls_last())


def with_share(counts: DataFrame, df: DataFrame) -> DataFrame:
    """Add each row's share of all rows of ``df``; that count is a scalar subquery which
    reads no column."""
    total = df.agg(F.count(F.lit(1)).alias("total")).scalar()
    return counts.withColumn("share", share(F.col("n"), total))


def class_balance(df: DataFrame, target: str, positive=1) -> DataFrame:
    """Positive and negative rate and the negatives per positive (null without positives).

    A missing label counts as negative.
    """
    require(df, target)
    n, pos = F.count(F.lit(1)), F.count_if(is_positive(df, target, positive))
    return df.agg(
        n.alias("n"),
        pos.alias("positives"),
        (n - pos).alias("negatives"),
        share(pos, n).alias("positive_rate"),
        share(n - pos, n).alias("negative_rate"),
        F.try_divide((n - pos).cast("double"), pos).alias("imbalance_ratio"),
    )
