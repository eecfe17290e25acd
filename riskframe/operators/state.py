"""One mergeable state per column, from one long-form aggregate that every analysis reads.

The table is unpivoted once to rows (column, value as a double) with the label beside them. One aggregate
by column then holds all that the analyses need of a column except its values: presence, range and
so constancy, moments, moments on either side of the label, co-moments with the label, sentinels, and
a fingerprint of its cells. A state is a few numbers and merges before the shuffle, so what moves and
what the driver sees has one row per column, whatever the number of rows. Values that are no numbers
take part by a hash; a column that looks constant by it is looked at again by value.

What needs values is asked for once, narrowed by the states: columns with few values are counted in
full (their counts, categories, periods and distinct numbers come from one small table), ranks of the
continuous columns are searched with the counts at hand.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.contract import MAX_CATEGORIES, MAX_PERIODS
from riskframe.functions import share
from riskframe.operators import categories, leakage, numeric
from riskframe.operators.columns import (
    is_category_type,
    is_number,
    is_positive,
    label_value,
    melt,
    number_of,
    require,
    value_of,
)
from riskframe.operators.profile import can_compare, class_counts, presence
from riskframe.operators.quantiles import quantiles
from riskframe.operators.roles import named_like_periods
from riskframe.sources.scratch import materialize

#: Estimated distinct counts up to so many times a limit are settled by counting.
_SLACK = 4
#: Buckets per value that counts as few.
_BUCKETS = 16


def _rows_name(df: DataFrame) -> str:
    """A name for the pseudo column that has a value in every row."""
    name = "rows"
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def _as_number(df: DataFrame, name: str) -> Column:
    """The cell as a double, null where missing: its value, or a hash where it is no number."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.NumericType):
        return number_of(df, name)
    cell = value_of(df, name)
    if isinstance(dtype, T.BooleanType):
        return cell.cast("int").cast("double")
    if not can_compare(dtype):
        return F.when(cell.isNotNull(), F.lit(0.0))
    return F.when(cell.isNotNull(), F.shiftright(F.xxhash64(cell), 11).cast("double"))


def column_states(
    df: DataFrame, target: str | None = None, positive=1, columns: Sequence[str] | None = None
) -> DataFrame:
    """One row per column with a value, and one of the pseudo column that has a value in every row.

    ``(column, have, neg_one, other_negative, zeros, mean, std, min, max, mark, pos_rows, pos_mean,
    neg_rows, neg_mean, pairs, r, label_mean)``; the label's parts are null without one.
    """
    if target:
        require(df, target)
    names = df.columns if columns is None else columns
    cells = {_rows_name(df): F.lit(1.0)} | {c: _as_number(df, c) for c in names}
    x, y, pos = F.col("x"), F.col("y"), F.col("pos")
    keep = {"row": F.monotonically_increasing_id()}
    if target:
        keep |= {"y": label_value(df, target, positive), "pos": is_positive(df, target, positive)}
    none = lambda kind: F.max(F.lit(None).cast(kind))
    known = F.when(y.isNotNull(), x)
    sides = {
        "pos_rows": ("bigint", lambda: F.count_if(pos)),
        "pos_mean": ("double", lambda: F.avg(F.when(pos, x))),
        "neg_rows": ("bigint", lambda: F.count_if(~pos)),
        "neg_mean": ("double", lambda: F.avg(F.when(~pos, x))),
        "pairs": ("bigint", lambda: F.count(y)),
        "r": ("double", lambda: leakage.pearson(known, y)),
        "label_mean": ("double", lambda: F.avg(y)),
    }
    return melt(df, cells, "x", keep).groupBy("column").agg(
        F.count(F.lit(1)).alias("have"),
        F.count_if(x == -1).alias("neg_one"),
        F.count_if((x < 0) & (x != -1)).alias("other_negative"),
        F.count_if(x == 0).alias("zeros"),
        F.avg(x).alias("mean"),
        F.stddev_samp(x).alias("std"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
        F.bit_xor(F.xxhash64("row", x + F.lit(0.0))).alias("mark"),
        *[(build() if target else none(kind)).alias(name) for name, (kind, build) in sides.items()],
    )


class TableState:
    """States of a table's columns and what follows from them, each part worked out on first use."""

    def __init__(
        self,
        df: DataFrame,
        target: str | None = None,
        positive=1,
        order_by: Sequence[str] = (),
        max_categories: int = MAX_CATEGORIES,
        max_periods: int = MAX_PERIODS,
    ):
        self.df, self.target, self.positive, self.order_by = df, target, positive, tuple(order_by)
        self.max_categories, self.max_periods = max_categories, max_periods

    # --- one row per column ---------------------------------------------------------------------

    @cached_property
    def states(self) -> dict[str, Row]:
        """By column; a column without a value has none. A column that cannot be read is left out, see ``broken``."""
        self.broken: dict[str, Exception] = {}
        return self._states_of(self.df.columns)

    def _states_of(self, columns: Sequence[str]) -> dict[str, Row]:
        try:
            rows = column_states(self.df, self.target, self.positive, columns).collect()
            return {r["column"]: r for r in rows}
        except Exception as error:
            if not columns:
                raise
            if len(columns) == 1:
                self.broken[columns[0]] = error
                return self._states_of([])
        # Halves, until the columns that fail stand alone.
        half = len(columns) // 2
        return self._states_of(columns[:half]) | self._states_of(columns[half:])

    def require_whole(self, columns: Sequence[str] | None = None) -> None:
        """An error if one of the columns could not be read."""
        for c in self.df.columns if columns is None else columns:
            if self.states is not None and c in self.broken:
                raise self.broken[c]

    @cached_property
    def rows(self) -> int:
        state = self.states.get(_rows_name(self.df))
        return state["have"] if state else 0

    @property
    def table(self) -> Row | None:
        """The state of the pseudo column: counts and label of all rows."""
        return self.states.get(_rows_name(self.df))

    def have(self, column: str) -> int:
        return self.states[column]["have"] if column in self.states else 0

    @cached_property
    def constants(self) -> dict[str, bool | None]:
        """Whether a column has a single value, null counted as one; unknown for types without an order."""
        found, look = {}, []
        for f in self.df.schema:
            state = self.states.get(f.name)
            if state is None:
                found[f.name] = True
            elif state["have"] < self.rows:
                found[f.name] = False
            elif not can_compare(f.dataType):
                found[f.name] = None
            else:
                found[f.name] = state["min"] == state["max"]
                exact = isinstance(f.dataType, (T.FloatType, T.DoubleType, T.ByteType, T.ShortType, T.IntegerType, T.BooleanType))
                if found[f.name] and not exact:
                    look.append(f.name)
        if look:
            # Doubles and hashes may be equal where values are not.
            found |= {r["column"]: r["is_constant"] for r in presence(self.df, look).collect()}
        return found

    def column_rows(self) -> list[tuple]:
        """(column, type, missing, missing_share, is_constant, neg_one, other_negative, mean, std, min, max) in column order."""
        self.require_whole()
        out = []
        for f in self.df.schema:
            state, number = self.states.get(f.name), is_number(f.dataType)
            missing = self.rows - self.have(f.name)
            counted = [(state[k] if state else 0) if number else None for k in ("neg_one", "other_negative")]
            numbers = [float(state[k]) if number and state and state[k] is not None else None for k in ("mean", "std", "min", "max")]
            out.append((f.name, f.dataType.simpleString(), missing, missing / self.rows if self.rows else 0.0, self.constants[f.name], *counted, *numbers))
        return out

    # --- columns with few values ----------------------------------------------------------------

    @cached_property
    def _guess(self) -> dict[str, int]:
        """Estimated distinct counts of the columns whose role or counts depend on them.

        Values are dealt into buckets by a hash; how many buckets of a column have one tells few values from many.
        No column has fewer values than buckets. One small piece of generated code serves any number of columns, where
        sketches side by side have none.
        """
        named = [f.name for f in self.df.schema if is_number(f.dataType) or is_category_type(f.dataType)]
        named = list(dict.fromkeys([*named, *named_like_periods(self.df.columns)]))
        known = {c: 0 for c in named if not self.have(c) and c not in self.broken}
        look = [c for c in named if c not in known and c not in self.broken]
        if look:
            buckets = _BUCKETS * self._few_limit
            cells = {c: value_of(self.df, c) for c in look}
            dealt = {c: F.when(v.isNotNull(), F.pmod(F.xxhash64(v), F.lit(buckets)).cast("int")) for c, v in cells.items()}
            hit = melt(self.df, dealt, "bucket").groupBy("column", "bucket").agg(F.count(F.lit(1)).alias("n"))
            known |= dict.fromkeys(look, 0)
            known |= {r["column"]: r["hit"] for r in hit.groupBy("column").agg(F.count(F.lit(1)).alias("hit")).collect()}
        return known

    @cached_property
    def few(self) -> list[str]:
        """Columns that can have at most as many values as a category or a period may."""
        return [c for c in self.df.columns if self._guess.get(c, self._few_limit + 1) <= self._few_limit]

    @property
    def _few_limit(self) -> int:
        return _SLACK * max(self.max_categories, self.max_periods)

    @cached_property
    def counts(self) -> DataFrame:
        """Value counts of the columns with few values: at most some hundred rows per column, kept as rows."""
        if not self.few:
            raise ValueError("no columns to count")
        counts = categories.value_counts(self.df, self.few, self.target, self.positive)
        self._count_rows = counts.collect()
        return self.df.sparkSession.createDataFrame(self._count_rows, counts.schema).coalesce(1)

    @cached_property
    def _values_of_few(self) -> dict[str, list[Row]]:
        found: dict[str, list[Row]] = {c: [] for c in self.few}
        for r in self._count_rows if self.few and self.counts is not None else []:
            found[r["column"]].append(r)
        return found

    @cached_property
    def distinct_of_few(self) -> dict[str, int]:
        return {c: sum(r["value"] is not None for r in rows) for c, rows in self._values_of_few.items()}

    def at_most(self, column: str, limit: int) -> bool:
        """Whether a column has at most so many distinct values, exactly."""
        self.require_whole([column])
        if not self.have(column):
            return True
        return column in self.distinct_of_few and self.distinct_of_few[column] <= limit

    @cached_property
    def roles(self) -> tuple[list[str], list[str]]:
        """Names of the categorical and of the continuous columns."""
        fields = [f for f in self.df.schema if f.name != self.target]
        few = {f.name: self.at_most(f.name, self.max_categories) for f in fields if is_number(f.dataType)}
        categorical = [f.name for f in fields if is_category_type(f.dataType) or few.get(f.name)]
        return categorical, [f.name for f in fields if is_number(f.dataType) and not few[f.name]]

    @cached_property
    def periods(self) -> list[str]:
        return [c for c in named_like_periods(self.df.columns) if self.at_most(c, self.max_periods)]

    @cached_property
    def distinct(self) -> dict[str, int]:
        """Exact distinct counts of all columns; only those with many values are counted anew."""
        known = dict.fromkeys(self.df.columns, 0) | self.distinct_of_few
        many = [c for c in self.df.columns if c not in self.distinct_of_few and self.have(c)]
        if many:
            ranges = {c: (self.states[c]["min"], self.states[c]["max"], self.have(c)) for c in many}
            known |= {r["column"]: r["distinct"] for r in categories.distinct_counts(self.df, many, ranges).collect()}
        return known

    # --- categories -----------------------------------------------------------------------------

    def top_categories(self, columns: Sequence[str], top: int, keep_null: bool = True) -> DataFrame:
        """The ``top`` categories of the columns, as :func:`categories.category_counts` gives them."""
        few = [c for c in columns if c in self.few]
        parts = []
        if few:
            parts.append(categories.category_counts(
                self.df, few, self.target, self.positive, top, self.order_by, self._counts_of(few, keep_null), small=True))
        many = [c for c in columns if c not in few]
        if many:
            parts.append(categories.category_counts(self.df, many, self.target, self.positive, top, self.order_by, keep_null=keep_null))
        return reduce(DataFrame.unionByName, parts)

    def _counts_of(self, columns: Sequence[str], keep_null: bool) -> DataFrame:
        counts = self.counts.filter(F.col("column").isin(list(columns)))
        if not keep_null:
            counts = counts.filter(F.col("value").isNotNull())
        return categories.with_first(self.df, counts, self._ties(columns), self.order_by) if self.order_by else counts

    def _ties(self, columns: Sequence[str]) -> list[tuple[str, str | None]]:
        """Values that are as frequent as another of their column."""
        out = []
        for c in columns:
            often = Counter(r["n"] for r in self._values_of_few.get(c, []))
            out += [(c, r["value"]) for r in self._values_of_few.get(c, []) if often[r["n"]] > 1]
        return out

    def leaky_categories(self, **limits) -> DataFrame:
        """:func:`leakage.majority_positive_categories` of the categorical columns."""
        few = [c for c in self.roles[0] if c in self.few]
        many = [c for c in self.roles[0] if c not in self.few]
        base = self.table["label_mean"] if self.table else None
        parts = []
        if few:
            parts.append(leakage.majority_positive_categories(
                self.df, few, self.target, self.positive, counts=self.counts.filter(F.col("column").isin(few)).coalesce(1), baseline=base, **limits))
        if many:
            parts.append(leakage.majority_positive_categories(self.df, many, self.target, self.positive, baseline=base, **limits))
        return reduce(DataFrame.unionByName, parts)

    def period_rates(self, column: str) -> DataFrame:
        """``temporal.period_rates`` of a period column, from its counts."""
        of = self.counts.filter(F.col("column") == column)
        period = F.col("value").cast(self.df.schema[column].dataType).alias("period")
        return of.select(period, F.try_divide("label_sum", "label_n").alias("rate"), F.col("label_n").alias("n"))

    def period_counts(self) -> DataFrame:
        """(column, period, n, share, positive_rate) of all period columns, from their counts."""
        rate = share(F.col("positives"), F.col("n")) if self.target else F.lit(None).cast("double")
        of = self.counts.filter(F.col("column").isin(self.periods))
        return of.select("column", F.col("value").alias("period"), "n", share(F.col("n"), F.lit(self.rows)).alias("share"), rate.alias("positive_rate"))

    # --- continuous columns ---------------------------------------------------------------------

    @cached_property
    def spread(self) -> Mapping[str, list]:
        """Percentiles of the continuous columns, over all rows and on either side of the label, by one search."""
        columns = self.roles[1]
        cells = {f"all {c}": number_of(self.df, c) for c in columns}
        counts = {f"all {c}": self.have(c) for c in columns}
        if self.target:
            cells |= numeric.label_sides(self.df, columns, self.target, self.positive)
            for side in ("pos", "neg"):
                counts |= {f"{side} {c}": self.states[c][f"{side}_rows"] if c in self.states else 0 for c in columns}
        return quantiles(self.df, cells, numeric.SPREAD, counts=counts)

    def quartiles(self) -> dict[str, list]:
        return {c: list(self.spread[f"all {c}"][1:4]) for c in self.roles[1]}

    def correlations(self) -> list[tuple]:
        """(column, n, r) of the continuous columns with the label."""
        return [(c, self.states[c]["pairs"], self.states[c]["r"]) for c in self.roles[1] if c in self.states and self.states[c]["pairs"]]

    def near_duplicates(self) -> list[tuple[str, str]]:
        """(column, duplicate_of) of the continuous columns."""
        marks = {c: self.states[c]["mark"] if c in self.states else 0 for c in self.roles[1]}
        return leakage.confirmed_duplicates(self.df, {c: number_of(self.df, c) for c in self.roles[1]}, marks)

    def class_counts(self) -> DataFrame:
        """:func:`profile.class_counts` of the label, from its counts where it has few values."""
        if self.target not in self.few:
            return materialize(class_counts(self.df, self.target), "class-counts")
        of = self.counts.filter(F.col("column") == self.target)
        value = F.col("value").cast(self.df.schema[self.target].dataType).alias("value")
        return of.select(value, "n", share(F.col("n"), F.lit(self.rows)).alias("share")).coalesce(1)

    def class_balance(self) -> tuple:
        """(n, positives, negatives, positive_rate, negative_rate, imbalance_ratio)."""
        n = self.rows
        pos = self.table["pos_rows"] if self.table else 0
        return n, pos, n - pos, (pos / n if n else 0.0), ((n - pos) / n if n else 0.0), ((n - pos) / pos if pos else None)

