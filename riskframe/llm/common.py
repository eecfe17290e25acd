"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A word, wherever an operator counts words: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def packed(docs: DataFrame) -> DataFrame:
    """Every row as the struct ``row``: no column of the caller can clash with a working column."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))


def unpacked(df: DataFrame, names: list[str], **changed: Column) -> DataFrame:
    """The caller's columns again, those in ``changed`` replaced."""
    return df.select(*(changed[c].alias(c) if c in changed else F.col("row").getField(c).alias(c) for c in names))


def digest(text: Column) -> Column:
    """Tells the texts of rows with one id apart; used with the id only."""
    return F.xxhash64(text)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of a text as an array; none for null."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, r"[\x20\x09-\x0D]+"))


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType) -> DataFrame:
    return df.mapInArrow(fn, schema)


def batch(**columns) -> pa.RecordBatch:
    """A record batch from arrays and lists, in the order given."""
    arrays = [c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, names=list(columns))
