"""Shared scratch folder: where intermediate tables go so that lost executors cost nothing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_CHOSEN: dict[str, str] = {}
_MADE: list[str] = []


def use_scratch_dir(folder: str) -> None:
    """The folder for sessions that set no ``spark.checkpoint.dir``; every executor must reach it."""
    _CHOSEN["folder"] = folder.rstrip("/")


def scratch_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``, else the folder of :func:`use_scratch_dir`."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or _CHOSEN.get("folder")
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the scratch folder."""
    path = f"{scratch_dir(spark)}/riskframe-{label}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


def clear_scratch(spark: SparkSession) -> None:
    """Delete every scratch table made so far; results that still read one must be written before."""
    while _MADE:
        path = spark._jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write a frame once as Parquet and read it back: the lineage ends at the written table."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
