"""Sinks: canonical frames, CSV, Parquet and the quarantine of rejected records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.contract import CANONICAL_SCHEMA
from riskframe.operators.columns import cell
from riskframe.sources.files import with_row_index


def canonical_frame(df: DataFrame) -> DataFrame:
    """Exactly the canonical columns in contract order; absent ones are null, others dropped."""
    have = set(df.columns)
    return df.select(
        *[
            (cell(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in CANONICAL_SCHEMA
        ]
    )


def write_csv(
    df: DataFrame,
    path: str,
    index: bool = False,
    order_by: Sequence[str] = (),
    mode: str = "errorifexists",
) -> str:
    """Write a folder of CSV part files with headers and return its path.

    Maps and structs go out as JSON text, which CSV can hold. ``index`` adds a leading
    0-based position in ``order_by`` order.
    """
    if index:
        if not order_by:
            raise ValueError("index=True needs order_by")
        df = with_row_index(df, order_by)
        df = df.select("index", *[cell(c) for c in df.columns if c != "index"])
    nested = (T.MapType, T.StructType, T.ArrayType)
    flat = df.select(
        *[
            F.to_json(cell(f.name)).alias(f.name) if isinstance(f.dataType, nested) else cell(f.name)
            for f in df.schema
        ]
    )
    flat.write.mode(mode).csv(path, header=True, quote='"', escape='"')
    return path


def write_parquet(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "errorifexists"
) -> str:
    """Write Parquet, the default sink, and return the path."""
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)
    return path


def write_rejects(rejects: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """Quarantine table: Parquet partitioned by source. Partitioning adds no shuffle."""
    return write_parquet(rejects, path, partition_by=["source"], mode=mode)
