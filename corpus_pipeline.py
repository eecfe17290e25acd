"""Corpus preparation in stages, each over all that the one before kept.

Quality rules drop rejected documents, line dedup shortens texts, SimHash near-dedup keeps one
document of each group, mixing drops or repeats documents, and the last stage adds their pieces and
checks that they decode to the text.
Each stage's result is written to the scratch folder and read again, so a lost executor costs no
more than the tasks it ran. Rows with nulls, repeated rows, empty tables and extra columns fare
as the operators' modules say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import line_dedup, mixing, pieces, quality_rules, simhash
from riskframe.llm.common import read, unpacked
from riskframe.sources.scratch import materialize

#: Column of the decoded text while it is compared.
BACK = "decoded of pieces"


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return quality_rules.filter_quality(docs, quality_rules.trusted_ids(read(spark, folder, "labels")))


def lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    kept = line_dedup.dedup(docs)
    return unpacked(kept, docs.columns, text=kept["kept"])


def near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return simhash.dedup(docs)


def mixed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return mixing.mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents with their pieces; a document that its pieces do not give back fails the stage."""
    back = pieces.decode(pieces.encode(docs), "pieces", BACK)
    whole = F.col(BACK) == F.coalesce("text", F.lit(""))
    lost = F.raise_error(F.concat(F.lit("pieces do not decode to the text of document "), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    return back.withColumn("pieces", F.when(whole, F.col("pieces")).otherwise(lost.cast(back.schema["pieces"].dataType))).drop(BACK)


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("simhash near-dedup", near_copies),
    ("mixing sources", mixed),
    ("sentencepiece encoding", encoded),
]
#: SQL can't express likelihood ratios, fingerprints or best paths; tests/llm holds run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, folder), name.replace(" ", "-"))
    return docs
