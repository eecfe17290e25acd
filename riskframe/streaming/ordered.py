"""Ingestion of streams where the first record by position wins, whatever the order of arrival.

Two queries, each exactly once by its own checkpoint. The first parses and validates the files of all
sources once and appends every row with its position to a table. The second reads that table as a
stream: valid records of one transaction id whose event times lie within ``delay`` of each other are a
session; it is kept as one record, the first by position seen so far, with its copies counted per source,
and comes out when the watermark has passed its end. So state holds one record per open id and not the rows,
and lies on the executors' disks (RocksDB), whatever number of ids is open; a restart copies its files.

The records are those of the batch ``ingest`` as long as all copies of an id lie within ``delay`` and none
arrives later than the watermark. Copies further apart give a record each; later ones stay ``waiting``
in the report for good.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskframe.contract import CANONICAL_FIELDS
from riskframe.functions import instant
from riskframe.operators.mappings import SourceMapping
from riskframe.operators.validation import event_time, rejected_records, valid_records, validate
from riskframe.streaming.ingest import read_stream

_POSITION = ("__source", "__file", "__block", "__row")
_MAP = "raw_source_data"
_NOW = {"availableNow": True}
#: State on disk, within a fixed memory for all of an executor's partitions; changes are logged, not whole states.
_STATE = "spark.sql.streaming.stateStore."
_ON_DISK = {
    _STATE + "providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    _STATE + "rocksdb.boundedMemoryUsage": "true",
    _STATE + "rocksdb.changelogCheckpointing.enabled": "true",
    _STATE + "rocksdb.trackTotalNumberOfRows": "false",
}


@contextmanager
def on_disk(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state on disk; a query takes the settings with it, the session gets its own back.

    A checkpoint that was begun with other settings of these goes on with them.
    """
    before = {k: spark.conf.get(k, None) for k in _ON_DISK}
    try:
        for k, v in _ON_DISK.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def with_rows(raw: DataFrame) -> DataFrame:
    """Add ``__row``, the number of a row in its task.

    A task reads the blocks of files one after another, so within a block the numbers are in the file's
    order. Spark's own running number is not for streams.
    """

    def number(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        at = 0
        for b in batches:
            rows = pa.array(np.arange(at, at + b.num_rows), pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns, rows], names=[*b.schema.names, "__row"])
            at += b.num_rows

    return raw.mapInArrow(number, T.StructType([*raw.schema.fields, T.StructField("__row", T.LongType())]))


def first_by_position(annotated: DataFrame, sources: int, delay: str) -> DataFrame:
    """One record per session of a transaction id, the first by position, with its copies per source.

    Copies are counted and compared within each task before they move. Positions differ, so the least record is
    the first one; entries stand for the map, which has no order.
    """
    at = instant(F.col("event_ts"), F.col("event_offset")).cast("timestamp")
    timed = event_time(valid_records(annotated)).withColumn("event_at", at).withWatermark("event_at", delay)
    cells = [F.map_entries(c).alias(c) if c == _MAP else F.col(c) for c in CANONICAL_FIELDS]
    record = F.struct(*_POSITION, *cells)
    copies = F.array(*[F.count_if(F.col("__source") == i) for i in range(sources)])
    sessions = timed.groupBy(F.session_window("event_at", delay).alias("session"), F.col("transaction_id").alias("id"))
    first = sessions.agg(F.min(record).alias("first"), copies.alias("copies")).select("first.*", "copies")
    return first.withColumn(_MAP, F.map_from_entries(_MAP))


@dataclass
class OrderedIngest:
    """Streams of CSV files, by name a folder and its mapping; the order of the names ranks the sources.

    ``land`` and ``settle`` start the two queries. With a running trigger both go on side by side; with
    the default each takes what is there and ends, so ``settle`` follows when ``land`` has ended.
    """

    spark: SparkSession
    sources: Mapping[str, tuple[str, SourceMapping]]
    path: str
    delay: str = "1 day"
    reader: Mapping[str, str] = field(default_factory=dict)
    options: Mapping[str, object] = field(default_factory=dict)

    def annotated(self) -> DataFrame:
        """The stream of all rows with their position, ``reject`` and ``record``."""
        frames = []
        for ordinal, (folder, mapping) in enumerate(self.sources.values()):
            raw = with_rows(read_stream(self.spark, folder, mapping, origin=True, **self.reader)).withColumn("__source", F.lit(ordinal))
            rows = validate(mapping.apply(raw, clean=False), **self.options)
            texts = [F.col(f"record.{n}").cast("string").alias(n) for n in rows.schema["record"].dataType.names]
            frames.append(rows.withColumn("record", F.struct(*texts)))
        return reduce(DataFrame.unionByName, frames)

    def land(self, trigger: Mapping | None = None) -> StreamingQuery:
        """Append the annotated rows of new files."""
        return self._write(self.annotated(), "annotated", trigger)

    def settle(self, trigger: Mapping | None = None) -> StreamingQuery:
        """Append the records whose sessions the watermark has passed."""
        landed = self.spark.readStream.schema(self.annotated().schema).parquet(f"{self.path}/annotated")
        return self._write(first_by_position(landed, len(self.sources), self.delay), "records", trigger)

    def _write(self, df: DataFrame, name: str, trigger: Mapping | None) -> StreamingQuery:
        writer = df.writeStream.format("parquet").option("path", f"{self.path}/{name}")
        with on_disk(self.spark):
            return writer.option("checkpointLocation", f"{self.path}/state-{name}").trigger(**(trigger or _NOW)).start()

    def records(self) -> DataFrame:
        """The records that have come out, with their positions and copies."""
        return self._named(self.spark.read.parquet(f"{self.path}/records"))

    def rejects(self) -> DataFrame:
        return self._named(rejected_records(self.spark.read.parquet(f"{self.path}/annotated")))

    def report(self) -> DataFrame:
        """Per source: rows read, valid and invalid ones, duplicates removed, and valid rows still ``waiting``.

        A row waits while its session is open, or for good if it came later than the watermark.
        """
        landed, records = (self.spark.read.parquet(f"{self.path}/{n}") for n in ("annotated", "records"))
        n = F.count(F.lit(1))
        read = landed.groupBy("__source").agg(n.alias("rows_read"), F.count_if(F.col("reject").isNull()).alias("valid"))
        kept = records.groupBy(F.col("__source").alias("own")).agg(n.alias("kept"))
        # One row with a number for each source.
        sums = records.agg(F.array(*[F.coalesce(F.sum(F.get("copies", F.lit(i))), F.lit(0)) for i in range(len(self.sources))]).alias("sums"))
        settled = sums.select(F.posexplode("sums").alias("at", "settled"))
        rows = self._named(read).join(kept, F.col("__source") == F.col("own"), "left").join(settled, F.col("__source") == F.col("at"))
        return rows.select(
            "source", "rows_read", "valid", (F.col("rows_read") - F.col("valid")).alias("invalid"),
            (F.col("settled") - F.coalesce("kept", F.lit(0))).alias("duplicates_removed"),
            (F.col("valid") - F.col("settled")).alias("waiting"),
        )

    def _named(self, df: DataFrame) -> DataFrame:
        names = F.array(*map(F.lit, self.sources))
        return df.withColumn("source", F.get(names, F.col("__source")))
