"""Ingestion of a stream: the same mappings and rules, with repeated ids dropped within a
watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskframe.contract import READER_MISSING
from riskframe.functions import instant
from riskframe.operators.mappings import SourceMapping
from riskframe.operators.validation import (
    event_time,
    rejected_records,
    valid_records,
    validate,
)

_ORIGIN = {"__file": "path", "__block": "block_start"}


def read_stream(
    spark: SparkSession, folder: str, mapping: SourceMapping, origin: bool = False, **reader: str
) -> DataFrame:
    """Stream of the CSV files that appear in a folder, every required column as text.

    Files must have the mapping's columns in its order; a header that differs is an error.
    ``origin`` adds the file and block of each row; ``reader`` are options of the file stream.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in mapping.required])
    raw = spark.readStream.options(**reader).schema(schema).csv(
        folder, header=True, quote='"', escape='"', nullValue="", emptyValue="",
        enforceSchema=False,
    )
    return raw.select(
        *[F.when(~F.col(c).isin(*READER_MISSING), F.col(c)).alias(c) for c in mapping.required],
        *[F.col(f"_metadata.file_{part}").alias(name) for name, part in _ORIGIN.items() if origin],
    )


def annotate_stream(raw: DataFrame, mapping: SourceMapping, **options) -> DataFrame:
    """Map and validate; row by row, so a stream needs nothing of its own."""
    return validate(mapping.apply(raw, clean=False), **options)


def first_within(valid: DataFrame, delay: str) -> DataFrame:
    """Drop repeats of a transaction id that arrive within ``delay`` of its event time.

    State is kept no longer than that. Unlike the batch rule the first to arrive wins, and
    a record later than the watermark is left out, as in any watermarked stream.
    """
    # A watermark wants an instant, so the wall clock is read in the session's zone.
    at = instant(F.col("event_ts"), F.col("event_offset")).cast("timestamp")
    return (
        event_time(valid)
        .withColumn("event_at", at)
        .withWatermark("event_at", delay)
        .dropDuplicatesWithinWatermark(["transaction_id"])
        .drop("event_ts", "event_offset", "event_at")
    )


def start_ingest(
    raw: DataFrame,
    mapping: SourceMapping,
    records_path: str,
    rejects_path: str,
    checkpoint: str,
    delay: str = "1 day",
    trigger: dict | None = None,
    **options,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Write accepted and rejected records of a stream as Parquet, each by its own query."""
    annotated = annotate_stream(raw, mapping, **options)
    trigger = trigger or {"availableNow": True}

    def write(df: DataFrame, path: str, name: str) -> StreamingQuery:
        return (
            df.writeStream.format("parquet")
            .option("path", path)
            .option("checkpointLocation", f"{checkpoint}/{name}")
            .trigger(**trigger)
            .start()
        )

    kept = first_within(valid_records(annotated), delay)
    return (
        write(kept, records_path, "records"),
        write(rejected_records(annotated), rejects_path, "rejects"),
    )
