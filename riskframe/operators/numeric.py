"""Descriptive statistics, label comparison and outliers of continuous columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskframe.functions import share
from riskframe.operators.columns import (
    empty_frame,
    is_positive,
    listed,
    melt,
    number_of,
    require,
)
from riskframe.operators.quantiles import quantiles

_SUMMARY = (
    "column", "n", "mean", "median", "std", "min", "max", "p5", "p25", "p75", "p95", "zeros",
    "zero_share", "neg_ones", "neg_one_share",
)
_COMPARED = (
    "column", "pos_n", "pos_mean", "pos_median", "neg_n", "neg_mean", "neg_median", "comparable",
)
_OUTLIERS = ("column", "q1", "q3", "lower", "upper", "n", "outliers", "share")
SPREAD = (0.05, 0.25, 0.5, 0.75, 0.95)
_EXTREMES = "column string, value double, distance double, rank int"


def _schema(names: Sequence[str], **types: str) -> str:
    return ", ".join(f"{n} {types.get(n, 'double')}" for n in names)


def _known(values: Mapping[str, float | None]) -> list[Column]:
    return [F.lit(v).cast("double").alias(k) for k, v in values.items()]


def numeric_summary(
    df: DataFrame, columns: Sequence[str], approx: bool = False, spread: Mapping[str, list] | None = None
) -> DataFrame:
    """Count, mean, median, std, range, percentiles, zeros and -1 of the non-null values.

    Shares are of the non-null count. Percentiles are exact unless ``approx``; ``spread`` are those of
    ``SPREAD`` where they are at hand.
    """
    require(df, *columns)
    if not columns:
        return empty_frame(df, _schema(_SUMMARY, column="string", n="bigint", zeros="bigint", neg_ones="bigint"))
    cells = {c: number_of(df, c) for c in columns}
    spread = quantiles(df, cells, SPREAD, approx) if spread is None else spread
    x = F.col("x")
    stats = (
        melt(df, cells, "x")
        .groupBy("column")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.avg(x).alias("mean"),
            F.stddev_samp(x).alias("std"),
            F.min(x).alias("min"),
            F.max(x).alias("max"),
            F.count_if(x == 0).alias("zero_rows"),
            F.count_if(x == -1).alias("neg_rows"),
        )
    )
    facts = [
        F.struct(
            F.lit(c).alias("column"),
            *_known(dict(zip(("p5", "p25", "median", "p75", "p95"), spread[c]))),
        )
        for c in columns
    ]
    kept = ["column", "rows", "mean", "median", "std", "min", "max", "p5", "p25", "p75", "p95",
            "zero_rows", "neg_rows"]
    none = F.lit(0).cast("bigint")
    table = listed(df, facts, kept, stats).withColumns(
        {
            "n": F.coalesce("rows", none),
            "zeros": F.coalesce("zero_rows", none),
            "neg_ones": F.coalesce("neg_rows", none),
        }
    )
    return table.withColumns(
        {
            "zero_share": share(F.col("zeros"), F.col("n")),
            "neg_one_share": share(F.col("neg_ones"), F.col("n")),
        }
    ).select(*_SUMMARY)


def summary_of(df: DataFrame, columns: Sequence[str], states: Mapping[str, Row], spread: Mapping[str, list]) -> DataFrame:
    """:func:`numeric_summary` of columns whose states and percentiles are at hand."""
    rows = []
    for c in columns:
        s, (p5, p25, middle, p75, p95) = states.get(c), spread[f"all {c}"]
        n, zeros, ones = (s["have"], s["zeros"], s["neg_one"]) if s else (0, 0, 0)
        mean, std, low, high = (s["mean"], s["std"], s["min"], s["max"]) if s else (None,) * 4
        rows.append((c, n, mean, middle, std, low, high, p5, p25, p75, p95, zeros, zeros / n if n else 0.0, ones, ones / n if n else 0.0))
    schema = _schema(_SUMMARY, column="string", n="bigint", zeros="bigint", neg_ones="bigint")
    return df.sparkSession.createDataFrame(rows, schema).coalesce(1)


def sides_of(df: DataFrame, columns: Sequence[str], states: Mapping[str, Row], spread: Mapping[str, list]) -> DataFrame:
    """:func:`label_by_numeric` of columns whose states and percentiles are at hand."""
    rows = []
    for c in columns:
        s = states.get(c)
        pos, neg = ((s["pos_rows"], s["neg_rows"]) if s else (0, 0))
        means = (s["pos_mean"], s["neg_mean"]) if s else (None, None)
        rows.append((c, pos, means[0], spread[f"pos {c}"][2], neg, means[1], spread[f"neg {c}"][2], pos > 0 and neg > 0))
    schema = _schema(_COMPARED, column="string", pos_n="bigint", neg_n="bigint", comparable="boolean")
    return df.sparkSession.createDataFrame(rows, schema).coalesce(1)


def label_by_numeric(
    df: DataFrame,
    columns: Sequence[str],
    target: str,
    positive=1,
    middle: Mapping[str, list] | None = None,
) -> DataFrame:
    """Mean and median on positive rows and on all others (a missing label is among those).

    ``comparable`` is false if either side has no value.
    """
    require(df, target, *columns)
    if not columns:
        return empty_frame(df, _schema(
            _COMPARED, column="string", pos_n="bigint", neg_n="bigint", comparable="boolean"))
    pos = is_positive(df, target, positive)
    cells = {c: number_of(df, c) for c in columns}
    if middle is None:
        middle = quantiles(df, label_sides(df, columns, target, positive), (0.5,))
    stats = (
        melt(df, cells, "x", {"pos": pos})
        .groupBy("column")
        .agg(
            F.count_if("pos").alias("pos_rows"),
            F.avg(F.when(F.col("pos"), F.col("x"))).alias("pos_mean"),
            F.count_if(~F.col("pos")).alias("neg_rows"),
            F.avg(F.when(~F.col("pos"), F.col("x"))).alias("neg_mean"),
        )
    )
    facts = [
        F.struct(
            F.lit(c).alias("column"),
            *_known({"pos_median": middle[f"pos {c}"][0], "neg_median": middle[f"neg {c}"][0]}),
        )
        for c in columns
    ]
    kept = ["column", "pos_rows", "pos_mean", "pos_median", "neg_rows", "neg_mean", "neg_median"]
    none = F.lit(0).cast("bigint")
    table = listed(df, facts, kept, stats).withColumns(
        {"pos_n": F.coalesce("pos_rows", none), "neg_n": F.coalesce("neg_rows", none)}
    )
    both = (F.col("pos_n") > 0) & (F.col("neg_n") > 0)
    return table.withColumn("comparable", both).select(*_COMPARED)


def label_sides(df: DataFrame, columns: Sequence[str], target: str, positive=1) -> dict[str, Column]:
    """The columns on positive rows (``pos name``) and on all others (``neg name``)."""
    pos = is_positive(df, target, positive)
    sides = {f"pos {c}": F.when(pos, number_of(df, c)) for c in columns}
    return sides | {f"neg {c}": F.when(~pos, number_of(df, c)) for c in columns}


def quartiles(
    df: DataFrame, columns: Sequence[str]
) -> dict[str, list[float | None]]:
    """First quartile, median and third quartile per column, on the driver."""
    require(df, *columns)
    return quantiles(df, {c: number_of(df, c) for c in columns}, (0.25, 0.5, 0.75))


def _fences(quartile: Mapping[str, list[float | None]], k: float) -> dict[str, tuple]:
    found = {}
    for name, (q1, middle, q3) in quartile.items():
        if q1 is not None:
            found[name] = (q1, middle, q3, q1 - k * (q3 - q1), q3 + k * (q3 - q1))
    return found


def iqr_outliers(
    df: DataFrame,
    columns: Sequence[str],
    k: float = 1.5,
    quartile: Mapping[str, list[float | None]] | None = None,
) -> DataFrame:
    """Fences ``k`` interquartile ranges outside the quartiles and the values beyond them.

    The fences are known before the scan, so counting is one aggregate without a join.
    Columns without values have null fences.
    """
    require(df, *columns)
    if not columns:
        return empty_frame(df, _schema(_OUTLIERS, column="string", n="bigint", outliers="bigint"))
    quartile = quartiles(df, columns) if quartile is None else quartile
    fences = _fences(quartile, k)
    # 1 beyond the fences, 0 within them, null without a value.
    beyond, facts = {}, []
    for name in columns:
        v = number_of(df, name)
        q1, _, q3, low, high = fences.get(name, (None,) * 5)
        if low is not None:
            beyond[name] = F.when(v.isNotNull(), ((v < low) | (v > high)).cast("int"))
        known = _known({"q1": q1, "q3": q3, "lower": low, "upper": high})
        facts.append(F.struct(F.lit(name).alias("column"), *known))
    if beyond:
        stats = melt(df, beyond, "out").groupBy("column").agg(
            F.count(F.lit(1)).alias("rows"), F.sum("out").alias("hits")
        )
    else:
        stats = empty_frame(df, "column string, rows bigint, hits bigint")
    none = F.lit(0).cast("bigint")
    table = listed(
        df, facts, ["column", "q1", "q3", "lower", "upper", "rows", "hits"], stats
    ).withColumns({"n": F.coalesce("rows", none), "outliers": F.coalesce("hits", none)})
    return table.withColumn("share", share(F.col("outliers"), F.col("n"))).select(*_OUTLIERS)


def extreme_values(
    df: DataFrame,
    columns: Sequence[str],
    k: float = 1.5,
    top: int = 5,
    quartile: Mapping[str, list[float | None]] | None = None,
) -> DataFrame:
    """The ``top`` outliers farthest from the median per column, repeated values included.

    Only outliers leave the scan, and each task keeps its own ``top`` per column before the
    shuffle. Equal distances go by value.
    """
    quartile = quartiles(df, columns) if quartile is None else quartile
    cells, distance = {}, []
    for name, (_, middle, _, low, high) in _fences(quartile, k).items():
        v = number_of(df, name)
        cells[name] = F.when((v < low) | (v > high), v)
        distance.append(F.when(F.col("column") == name, F.abs(F.col("value") - middle)))
    if not cells:
        return empty_frame(df, _EXTREMES)
    outliers = melt(df, cells, "value").withColumn("distance", F.coalesce(*distance))
    w = Window.partitionBy("column").orderBy(F.desc("distance"), F.desc("value"))
    return outliers.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)


def outlier_tables(
    df: DataFrame, columns: Sequence[str], quartile: Mapping[str, list[float | None]], counts: Mapping[str, int], k: float = 1.5, top: int = 5
) -> tuple[DataFrame, DataFrame]:
    """:func:`iqr_outliers` and :func:`extreme_values` of columns whose quartiles and counts are at hand, by one action.

    Only outliers leave the scans: their number, and each task's ``top`` per column.
    """
    fences = _fences(quartile, k)
    hits: dict[str, int] = {}
    best: list[tuple] = []
    if fences:
        cells = {}
        for c, (_, _, _, low, high) in fences.items():
            v = number_of(df, c)
            cells[c] = F.when((v < low) | (v > high), v)
        far = extreme_values(df, columns, k, top, quartile).select("column", "value", "distance", "rank", F.lit(None).cast("bigint").alias("hits"))
        none = F.lit(None).cast("double")
        many = melt(df, cells, "v").groupBy("column").agg(F.count(F.lit(1)).alias("hits"))
        rows = far.unionByName(many.select("column", none.alias("value"), none.alias("distance"), F.lit(None).cast("int").alias("rank"), "hits")).collect()
        hits = {r["column"]: r["hits"] for r in rows if r["hits"] is not None}
        best = sorted((tuple(r)[:4] for r in rows if r["hits"] is None), key=lambda r: (columns.index(r[0]), r[3]))
    table = []
    for c in columns:
        q1, _, q3, low, high = fences.get(c, (None,) * 5)
        n = counts[c]
        table.append((c, q1, q3, low, high, n, hits.get(c, 0), hits.get(c, 0) / n if n else 0.0))
    spark = df.sparkSession
    return (
        spark.createDataFrame(table, _schema(_OUTLIERS, column="string", n="bigint", outliers="bigint")).coalesce(1),
        spark.createDataFrame(best, _EXTREMES).coalesce(1),
    )
