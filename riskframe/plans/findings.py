"""All signs of leakage in one table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.contract import (
    HIGH_CORRELATION,
    LEAKY_MIN_LIFT,
    LEAKY_MIN_RATE,
    LEAKY_MIN_ROWS,
    MAX_CATEGORIES,
    MAX_PERIODS,
    PERIOD_JUMP,
)
from riskframe.operators.columns import require
from riskframe.operators.state import TableState
from riskframe.operators.temporal import period_shifts
from riskframe.sources.scratch import materialize

_SCHEMA = "check string, column string, value string, n bigint, statistic double, detail string"


def _tidy(check: str, df: DataFrame, detail: str, value: str, statistic: str) -> DataFrame:
    return df.select(
        F.lit(check).alias("check"),
        "column",
        F.col(value).cast("string").alias("value"),
        F.col("n").cast("bigint").alias("n"),
        F.col(statistic).cast("double").alias("statistic"),
        F.lit(detail).alias("detail"),
    )


def leakage_findings(
    df: DataFrame,
    target: str,
    positive=1,
    max_categories: int = MAX_CATEGORIES,
    max_periods: int = MAX_PERIODS,
    correlation: float = HIGH_CORRELATION,
    min_rows: int = LEAKY_MIN_ROWS,
    min_rate: float = LEAKY_MIN_RATE,
    min_lift: float = LEAKY_MIN_LIFT,
    jump: float = PERIOD_JUMP,
    state: TableState | None = None,
) -> DataFrame:
    """All checks in one tidy table; a single row ``none`` says that nothing was found.

    Constants, correlations and candidates of equal columns come from the column states; categories
    and the rates of the first period column from the value counts. ``state`` is the table's where it is
    at hand. The findings are written down, so that reading them, and asking whether there are any,
    runs nothing twice.
    """
    require(df, target)
    state = state or TableState(df, target, positive, (), max_categories, max_periods)
    categorical, continuous = state.roles
    rows = [
        ("constant", c, None, state.rows, None, "one value only, no signal")
        for c in (*categorical, *continuous) if state.constants[c]
    ]
    rows += [
        ("correlation", c, None, n, abs(r), "moves with the label")
        for c, n, r in state.correlations() if r is not None and abs(r) > correlation
    ]
    rows += [("duplicate", a, b, None, None, "same values as another column") for a, b in state.near_duplicates()]
    findings = [df.sparkSession.createDataFrame(rows, _SCHEMA).coalesce(1)]
    if any(state.have(c) or state.rows for c in categorical):
        leaky = state.leaky_categories(min_rows=min_rows, min_rate=min_rate, min_lift=min_lift)
        findings.append(_tidy("category", leaky, "mostly positive, far above the base rate", "value", "positive_rate"))
    for name in state.periods[:1]:
        rates = state.period_rates(name)
        shifts = period_shifts(df, name, target, positive, jump, rates=rates)
        findings.append(_tidy("period_shift", shifts, "label rate jumps from the period before", "period", "change"))
    written = materialize(reduce(DataFrame.unionByName, findings), "findings")
    nothing = (
        written.agg(F.count(F.lit(1)).alias("found"))
        .filter(F.col("found") == 0)
        .select(
            F.lit("none").alias("check"),
            F.lit(None).cast("string").alias("column"),
            F.lit(None).cast("string").alias("value"),
            F.lit(None).cast("bigint").alias("n"),
            F.lit(None).cast("double").alias("statistic"),
            F.lit("no sign of leakage found").alias("detail"),
        )
    )
    return written.unionByName(nothing)
