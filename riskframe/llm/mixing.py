"""Mixing sources to target weights by documents of exact length.

A source's target is its share by weight of EPOCHS times all words, at most MOST times its own
words. Whole copies of a source come first; the budget that remains is fitted as a subset sum.
Documents are counted by exact length; the same share of every length is taken, evenly along the
lengths, and a bounded-knapsack dynamic program over the lengths left over fills the last FIT words
of the budget. Which documents of a length are taken is decided by a seeded hash of id and text,
so that reruns agree: the k smallest of a length, found by counting hash buckets first and
ranking inside one bucket only, so a length that a third of all documents share is never one group.

Defined cases. A null or blank text has size 0 and is taken 0 words. Null is a source of its own,
last in order. An empty table gives an empty result, a table without words targets of 0. Rows with
one id and one text are taken or left together; they may move their source's sum by their size.
Extra columns are kept by ``mix``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskframe.llm.common import WORD, digest, packed, unpacked
from riskframe.sources.scratch import materialize

WEIGHTS = (3, 1, 2)
EPOCHS = 1.5
MOST = 2
SEED = 20_240_501
#: Words of a source's budget that are left to the dynamic program.
FIT = 1 << 17
#: Hash buckets of a length.
BUCKETS = 1 << 10


def size_of(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def order_of(doc_id: Column, text: Column) -> Column:
    """The seeded hash that decides which documents of a length come first."""
    return F.xxhash64(F.lit(SEED), doc_id, digest(text))


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Filling up to a common level per weight is where resharing the excess ends: sources whose cap
    lies below the level stop there. One row per source, so one task orders them.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    fill = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    weights = F.array(*map(F.lit, WEIGHTS))
    ranked = (
        sizes.withColumn("weight", F.get(weights, ((F.row_number().over(by_name) - 1) % len(WEIGHTS)).cast("int")))
        .withColumn("cap", MOST * F.col("source_size"))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("nth", F.row_number().over(fill))
        .withColumn("budget", F.sum("source_size").over(everything) * EPOCHS)
        .withColumn("level", (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
                    / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    )
    level = F.min_by(F.when(F.col("level") <= F.col("ratio"), F.col("level")), F.when(F.col("level") <= F.col("ratio"), F.col("nth"))).over(everything)
    target = F.least(F.col("cap").cast("double"), F.coalesce(level, F.col("ratio")) * F.col("weight"))
    return ranked.select("source", "source_size", target.alias("target"))


def fit(lengths: np.ndarray, counts: np.ndarray, budget: int, seed: int = SEED) -> np.ndarray:
    """How many documents of each length to take so that their words come as near under ``budget`` as can be."""
    total = int((lengths * counts).sum())
    if budget >= total:
        return counts.copy()
    order = np.argsort(lengths, kind="stable")
    lengths_, counts_ = lengths[order], counts[order]
    # The same share of all lengths, rounded along the lengths, up to what is left to the program.
    share = max(0, budget - FIT) / total if total else 0.0
    upto = np.floor(np.cumsum(counts_) * share).astype(np.int64)
    taken = np.diff(upto, prepend=0)
    rest = budget - int((lengths_ * taken).sum())
    for i in range(len(taken) - 1, -1, -1):
        if rest >= 0:
            break
        back = min(int(taken[i]), -(rest // int(lengths_[i]))) if lengths_[i] else 0
        taken[i] -= back
        rest += back * int(lengths_[i])
    # Rounding can leave more than the program should hold: long documents first.
    for i in range(len(taken) - 1, -1, -1):
        if rest <= 2 * FIT:
            break
        more = min(int(counts_[i] - taken[i]), rest // int(lengths_[i])) if lengths_[i] else 0
        taken[i] += more
        rest -= more * int(lengths_[i])
    taken += knapsack(lengths_, counts_ - taken, rest, seed)
    out = np.empty_like(taken)
    out[order] = taken
    return out


def knapsack(lengths: np.ndarray, counts: np.ndarray, budget: int, seed: int) -> np.ndarray:
    """Bounded knapsack: how many of each length give the largest sum up to ``budget``.

    Sums are reached lot by lot (a length's count in powers of two), in a seeded order; each sum
    keeps the lot that first reached it, and earlier lots alone reach what that lot was added to.
    """
    taken = np.zeros(len(lengths), np.int64)
    if budget <= 0:
        return taken
    via = np.full(budget + 1, -1, np.int32)
    reached = np.zeros(budget + 1, bool)
    reached[0] = True
    lots: list[tuple[int, int]] = []
    for i in np.random.default_rng(seed).permutation(len(lengths)):
        left, lot = min(int(counts[i]), budget // int(lengths[i])) if lengths[i] else 0, 1
        while left > 0 and not reached[budget]:
            n = min(lot, left)
            step = n * int(lengths[i])
            new = np.zeros_like(reached)
            new[step:] = reached[: budget + 1 - step]
            new &= ~reached
            via[new] = len(lots)
            reached |= new
            lots.append((int(i), n))
            left, lot = left - n, lot * 2
        if reached[budget]:
            break
    at = int(np.flatnonzero(reached)[-1])
    while at:
        i, n = lots[via[at]]
        taken[i] += n
        at -= n * int(lengths[i])
    return taken


def fit_source(rows: pd.DataFrame) -> pd.DataFrame:
    """One source's lengths, with ``copies`` of all of it and ``take`` documents more of each length."""
    size, target = int(rows["source_size"].iloc[0]), float(rows["target"].iloc[0])
    copies = min(MOST, int(target // size)) if size else 0
    lengths, counts = rows["size"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)
    budget = round(target) - copies * size if copies < MOST else 0
    take = fit(lengths, counts, budget) if budget > 0 else np.zeros(len(rows), np.int64)
    return rows.assign(copies=copies, take=np.where(lengths > 0, take, 0))


def plan(docs: DataFrame) -> DataFrame:
    """(source, size, source_size, target, copies, cut): a document is taken ``copies`` times, and once more if its hash is at most ``cut``."""
    rows = docs.select("source", size_of(F.col("text")).alias("size"), order_of(F.col("doc_id"), F.col("text")).alias("h"))
    rows = materialize(rows.withColumn("bucket", F.shiftrightunsigned("h", 54).cast("int")), "sizes")
    # Unsigned order, as buckets are leading bits.
    rank = F.col("h").bitwiseXOR(F.lit(-(1 << 63)))
    counts = materialize(rows.groupBy("source", "size", "bucket").agg(F.count("*").alias("n")), "length-counts")
    lengths = counts.groupBy("source", "size").agg(F.sum("n").alias("n"))
    sources = targets(lengths.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size")))
    same = lambda a, b, *keys: [a[k].eqNullSafe(b[k]) for k in keys]
    with_target = lengths.join(sources.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    schema = "source string, size long, n long, source_size long, target double, copies int, take long"
    takes = materialize(with_target.groupBy("source").applyInPandas(fit_source, schema), "length-takes")
    some = takes.where((F.col("take") > 0) & (F.col("take") < F.col("n"))).select(F.col("source").alias("s"), F.col("size").alias("z"), "take")
    here = F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z"))
    upto = Window.partitionBy("s", "z").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    cut_bucket = (
        counts.join(some, here)
        .withColumn("before", F.coalesce(F.sum("n").over(upto), F.lit(0)))
        .where((F.col("before") < F.col("take")) & (F.col("before") + F.col("n") >= F.col("take")))
        .select("s", "z", F.col("bucket").alias("b"), (F.col("take") - F.col("before")).alias("nth"))
    )
    inside = rows.join(cut_bucket, here & (F.col("bucket") == F.col("b")))
    ranked = inside.withColumn("rank", rank).withColumn("at", F.row_number().over(Window.partitionBy("s", "z", "b").orderBy("rank")))
    cuts = ranked.where("at = nth").select("s", "z", F.col("rank").alias("cut"))
    last, never = F.lit((1 << 63) - 1), F.lit(-(1 << 63))
    cut = F.when(F.col("take") == 0, F.lit(None).cast("long")).when(F.col("take") == F.col("n"), last).otherwise(F.coalesce("cut", never))
    return takes.join(cuts, here, "left").select("source", "size", "source_size", "target", "copies", cut.alias("cut"))


def taken(docs: DataFrame) -> DataFrame:
    """``row`` (the document), size, source_size, target, times: how often the mix takes it."""
    planned = plan(docs).select(*(F.col(c).alias(f"p_{c}") for c in ("source", "size", "source_size", "target", "copies", "cut")))
    text, doc_id = F.col("row").getField("text"), F.col("row").getField("doc_id")
    rows = packed(docs).withColumns({"source": F.col("row").getField("source"), "size": size_of(text), "h": order_of(doc_id, text).bitwiseXOR(F.lit(-(1 << 63)))})
    joined = rows.join(planned, F.col("source").eqNullSafe(F.col("p_source")) & (F.col("size") == F.col("p_size")))
    more = F.when(F.col("p_cut").isNotNull() & (F.col("h") <= F.col("p_cut")), 1).otherwise(0)
    times = F.when(F.col("size") == 0, 0).otherwise(F.col("p_copies") + more)
    return joined.select("row", "size", F.col("p_source_size").alias("source_size"), F.col("p_target").alias("target"), times.alias("times"))


def mix_report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken."""
    narrow = docs.select("doc_id", "text", "source")
    return taken(narrow).select(F.col("row.doc_id"), "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))


def mix(docs: DataFrame) -> DataFrame:
    """The mixed documents, with all their columns: a document taken twice is there twice."""
    rows = taken(docs).where("times > 0")
    return unpacked(rows.select("row", F.explode(F.sequence(F.lit(1), F.col("times")))), docs.columns)
