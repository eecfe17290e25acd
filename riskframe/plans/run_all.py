"""All ten analyses of one dataset; one that fails is noted and does not stop the rest."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.contract import MAX_CATEGORIES, MAX_PERIODS, TARGET
from riskframe.operators import numeric, profile, temporal
from riskframe.operators.columns import held, is_category_type
from riskframe.operators.state import TableState
from riskframe.plans.findings import leakage_findings
from riskframe.sources.scratch import materialize

_LONG = (
    "analysis string, part string, column string, item string, metric string, value string, "
    "status string"
)
_ITEMS = ("check", "period", "value")
TOP, TOP_LABELLED = 15, 8


@dataclass
class Analyses:
    """Result tables by ``analysis.part``, the status of each, and all of it in long form."""

    tables: dict[str, DataFrame]
    status: DataFrame
    long: DataFrame


def run_all(
    df: DataFrame,
    target: str | None = TARGET,
    positive=1,
    order_by: Sequence[str] = (),
    max_categories: int = MAX_CATEGORIES,
    max_periods: int = MAX_PERIODS,
    materialize_input: bool = False,
) -> Analyses:
    """Run every analysis over one :class:`TableState` of the data.

    The result tables are bounded by the number of columns, not by the rows, so they are held as they
    come; class counts and findings, which the data may make long, are written down.
    ``materialize_input`` first writes the input as Parquet, in as many parts as there are cores at
    least: for sources that are costly to parse, or that come in few pieces.
    Analyses that need the label are skipped without it; ``order_by`` adds the row order of temporal
    columns.
    """
    if materialize_input:
        df = materialize(dealt_out(df), "input")
    label = target if target in df.columns else None
    state = TableState(df, label, positive, order_by, max_categories, max_periods)
    tables: dict[str, DataFrame] = {}
    states = []
    for analysis, part, needs_label, build in _parts(df, label, positive, order_by, state):
        name = f"{analysis}.{part}"
        if needs_label and label is None:
            states.append((analysis, part, f"skipped: no column {target}"))
            continue
        try:
            tables[name] = build()
            states.append((analysis, part, "ok"))
        except Exception as error:  # noqa: BLE001 - the other analyses go on
            reason = (str(error).splitlines() or [""])[0]
            states.append((analysis, part, f"failed: {type(error).__name__}: {reason}"))
    status = df.sparkSession.createDataFrame(states, "analysis string, part string, status string")
    rows = [_long(name, table) for name, table in tables.items()]
    bad = [s for s in states if s[2] != "ok"]
    if bad:
        gaps = [(a, p, None, None, None, None, state) for a, p, state in bad]
        rows.append(df.sparkSession.createDataFrame(gaps, _LONG))
    return Analyses(tables, status, reduce(DataFrame.unionByName, rows))


def dealt_out(df: DataFrame) -> DataFrame:
    """The table in at least as many parts as there are cores."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _parts(df: DataFrame, label: str | None, positive, order_by: Sequence[str], state: TableState):
    """``(analysis, part, needs the label, how to build it)`` in the order of the report."""
    spark = df.sparkSession

    def local(rows: list[tuple], schema: str) -> DataFrame:
        return spark.createDataFrame(rows, schema).coalesce(1)

    def quality() -> DataFrame:
        rows = [(c, *row) for c, _, *row in (r[:7] for r in state.column_rows())]
        return local(rows, "column string, missing bigint, missing_share double, is_constant boolean, neg_one bigint, other_negative bigint")

    def features() -> DataFrame:
        rows = [(c, kind, state.distinct[c], missing, rate, *numbers) for c, kind, missing, rate, _, _, _, *numbers in state.column_rows()]
        return local(rows, "column string, type string, distinct bigint, missing bigint, missing_share double, mean double, std double, min double, max double")

    def common() -> DataFrame:
        named = [f.name for f in df.schema if is_category_type(f.dataType)]
        best = state.top_categories(named, 1, keep_null=False).select("column", "categories", "value", "n")
        return best if set(named) <= set(state.few) else held(best)

    def balance() -> DataFrame:
        return local([state.class_balance()], "n bigint, positives bigint, negatives bigint, positive_rate double, negative_rate double, imbalance_ratio double")

    def orders() -> DataFrame:
        return temporal.row_orders(df, state.periods, order_by)

    def labelled() -> DataFrame:
        best = top().filter(F.col("rank") <= TOP_LABELLED)
        return best.select("column", "value", "n", "positive_rate", "rank")

    tops: list[DataFrame] = []

    def top() -> DataFrame:
        if not tops:
            best = state.top_categories(state.roles[0], TOP)
            tops.append(best if set(state.roles[0]) <= set(state.few) else held(best))
        return tops[0]

    beyond: list[tuple[DataFrame, DataFrame]] = []

    def outliers() -> tuple[DataFrame, DataFrame]:
        if not beyond:
            beyond.append(numeric.outlier_tables(df, state.roles[1], state.quartiles(), {c: state.have(c) for c in state.roles[1]}))
        return beyond[0]

    def summary() -> DataFrame:
        return numeric.summary_of(df, state.roles[1], state.states, state.spread)

    def sides() -> DataFrame:
        return numeric.sides_of(df, state.roles[1], state.states, state.spread)

    parts: list[tuple[str, str, bool, Callable[[], DataFrame]]] = [
        ("overview", "size", False, lambda: local([(state.rows, len(df.columns))], "n bigint, columns int")),
        ("overview", "columns", False, lambda: profile.overview(df).coalesce(1)),
        ("data_quality", "columns", False, quality),
        ("data_quality", "duplicates", False, lambda: profile.duplicate_rows(df, digest=True, n=state.rows)),
        ("feature_profile", "columns", False, features),
        ("feature_profile", "most_common", False, common),
        ("target", "counts", True, state.class_counts),
        ("target", "balance", True, balance),
        ("categorical", "counts", False, top),
        ("numeric", "summary", False, summary),
        ("temporal", "periods", False, state.period_counts),
        ("temporal", "row_order", False, orders),
        ("relationships", "categories", True, labelled),
        ("relationships", "numbers", True, sides),
        ("outliers", "fences", False, lambda: outliers()[0]),
        ("outliers", "extremes", False, lambda: outliers()[1]),
        ("leakage", "findings", True, lambda: leakage_findings(df, label, positive, state=state)),
    ]
    return [p for p in parts if p[1] != "row_order" or order_by]


def _long(name: str, table: DataFrame) -> DataFrame:
    analysis, part = name.split(".")
    have = table.columns
    item = next((F.col(c) for c in _ITEMS if c in have), F.lit(None))
    metrics = [c for c in have if c not in ("column", *_ITEMS)]
    pieces = [
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("string").alias("value"))
        for c in metrics
    ]
    return table.select(
        F.lit(analysis).alias("analysis"),
        F.lit(part).alias("part"),
        (F.col("column") if "column" in have else F.lit(None)).cast("string").alias("column"),
        item.cast("string").alias("item"),
        F.inline(F.array(*pieces)),
    ).withColumn("status", F.lit("ok"))
