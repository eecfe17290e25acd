"""Repeated keys: the first row in a stated order wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskframe.operators.columns import cell


def first_per_key(df: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """One row per key, the first in ``order_by`` order.

    The limit right above the rank lets each task keep its own first row per key before the
    shuffle, so a key that holds a third of all rows reaches it as one row per task.
    ``dropDuplicates`` would pick an arbitrary row.
    """
    nth = F.row_number().over(Window.partitionBy(cell(key)).orderBy(*map(cell, order_by)))
    return df.withColumn("__nth", nth).filter("__nth = 1").drop("__nth")


def duplicate_counts(df: DataFrame, key: str, order_by: Sequence[str], by: str) -> DataFrame:
    """Rows dropped by ``first_per_key`` per value of ``by``: rows before minus rows kept."""
    order = F.struct(*map(cell, order_by)) if len(order_by) > 1 else cell(order_by[0])
    named = F.struct(order.alias("at"), cell(by).alias("by"))
    before = df.groupBy(cell(by).alias("by")).agg(F.count(F.lit(1)).alias("n"))
    kept = df.groupBy(cell(key).alias("key")).agg(F.min(named).alias("first"))
    after = kept.groupBy(F.col("first.by").alias("kept_by")).agg(F.count(F.lit(1)).alias("kept"))
    joined = before.join(after, F.col("by").eqNullSafe(F.col("kept_by")), "left")
    return joined.select(
        F.col("by").alias(by), "n", (F.col("n") - F.coalesce("kept", F.lit(0))).alias("duplicates_removed")
    )
