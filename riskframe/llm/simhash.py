"""SimHash near-dedup: fingerprints that differ in few bits are linked, and links make groups.

With at most 3 differing bits, one of two 32-bit segments differs by one bit at most. Each distinct
fingerprint is indexed under its deletion variants: for either segment, the segment with one of its
bits taken out, 64 keys in all. Fingerprints that share a key are compared in full. Equal keys meet
by a sort, and a bucket yields a spanning forest of its links, never all its pairs. A bucket of more
than BUCKET fingerprints is not held: its members go to a second round under a narrower key, the
variant and one of the four bytes of the other segment, which 3 differing bits must leave equal in
one byte. What then shares a key agrees in 39 of 64 bits, so at most 2^25 fingerprints do.

Defined cases. A text of fewer words than a shingle is one shingle; a text without words, a null
one too, has fingerprint 0 and is linked like any other. Rows with a null id take part in links;
a component of such rows only has a null id. ``dedup`` keeps one row of each component: that with
the smallest id, and of repeated rows with that id any one. Extra columns are kept. An empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from riskframe.llm.common import batch, digest, packed, unpacked
from riskframe.llm.components import components
from riskframe.sources.scratch import materialize

SHINGLE = 3
MAX_BITS = 3
SEED = 42
#: Fingerprints under one key that are compared at once.
BUCKET = 2048
_HASHES = 1 << 15


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The signed 64-bit fingerprint of a UTF-8 text."""
    found = (text or b"").lower().split()  # on bytes: A-Z, and ASCII white space
    if not found:
        return 0
    line = b" ".join(found)
    ends = list(accumulate((len(w) + 1 for w in found), initial=-1))[1:]
    starts = [0, *(e + 1 for e in ends[:-1])]
    spans = list(zip(starts, ends[shingle - 1 :])) or [(0, len(line))]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(spans), _HASHES):
        hashes = np.array([xxhash.xxh64_intdigest(line[a:b], SEED) for a, b in spans[at : at + _HASHES]], np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(spans), bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, dig, fp) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield batch(doc_id=b.column(0), dig=b.column(1), fp=pa.array([fingerprint(x.as_py(), shingle) for x in b.column(2)], pa.int64()))

    columns = F.col("doc_id").cast("long").alias("doc_id"), digest(F.col("text")).alias("dig"), F.col("text").cast("binary").alias("body")
    return docs.select(*columns).mapInArrow(run, "doc_id long, dig long, fp long")


def variants(prints: DataFrame) -> DataFrame:
    """(key, fp): the 64 deletion variants of each fingerprint; the key tells segment, bit and the 31 bits left."""
    segment = F.expr("(CASE WHEN v < 32 THEN fp ELSE shiftrightunsigned(fp, 32) END) & 4294967295L")
    bit = F.expr("shiftleft(1L, v % 32)")
    cleared = F.expr("~0L").bitwiseXOR(bit)
    key = F.expr("shiftleft(CAST(v AS BIGINT), 32)").bitwiseOR(segment.bitwiseAND(cleared))
    return prints.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("v")).select(key.alias("key"), "fp")


def differing(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def spanning_links(prints: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Links (member, smallest of its group) that connect what chains of close fingerprints connect.

    Each step compares one fingerprint with those not yet reached, so a dense group costs little.
    """
    left, out = np.sort(prints), []
    while len(left) > 1:
        root, queue, left = left[0], [left[0]], left[1:]
        while queue and len(left):
            near = differing(left, queue.pop()) <= most
            if near.any():
                reached = left[near]
                left = left[~near]
                queue.extend(reached)
                out.extend((int(x), int(root)) for x in reached)
    return out


def near_links(most: int, limit: int | None):
    """Task function over rows (key, fp) sorted by key: (a, b, key), or members of too large buckets with b null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, size, over = None, [], 0, False
        out: list[tuple] = []

        def close() -> None:
            nonlocal parts
            if not over and size > 1:
                for a, b in spanning_links(np.concatenate(parts), most):
                    out.append((a, b, None))
            parts = []

        def emit() -> pa.RecordBatch:
            rows = list(zip(*out)) or [[], [], []]
            out.clear()
            # Unsigned order in numpy, signed longs in Spark.
            long = lambda x: pa.array([None if v is None else v - (1 << 64) if v >= 1 << 63 else v for v in x], pa.int64())
            return batch(a=long(rows[0]), b=long(rows[1]), key=long(rows[2]))

        for b in batches:
            keys, prints = b.column(0).to_numpy(), b.column(1).to_numpy().view(np.uint64)
            edges = np.r_[0, np.flatnonzero(keys[1:] != keys[:-1]) + 1, len(keys)] if len(keys) else [0]
            # Buckets of one inside a batch need no look; the first and last may go on in another batch.
            runs = [i for i in range(len(edges) - 1) if i == 0 or i == len(edges) - 2 or edges[i + 1] - edges[i] > 1]
            for i in runs:
                lo, hi = edges[i], edges[i + 1]
                if keys[lo] != key:
                    close()
                    key, size, over = keys[lo], 0, False
                parts.append(prints[lo:hi])
                size += hi - lo
                if limit and size > limit:
                    over = True
                    out.extend((int(x), None, int(key)) for part in parts for x in part)
                    parts = []
            if len(out) > 50_000:
                yield emit()
        close()
        yield emit()

    return run


def sorted_by_key(rows: DataFrame) -> DataFrame:
    return rows.repartition("key").sortWithinPartitions("key")


def links(prints: DataFrame, most: int = MAX_BITS) -> DataFrame:
    """(a, b), a > b: links between distinct fingerprints (column fp) whose components are those of all links."""
    if most > 3:
        raise ValueError("two segments and one deletion find at most 3 differing bits")
    schema = "a long, b long, key long"
    first = materialize(sorted_by_key(variants(prints)).mapInArrow(near_links(most, BUCKET), schema), "simhash-links")
    large = first.where(F.col("b").isNull())
    # The other segment's byte; (variant, byte number, byte) hashed to one key, checked in full afterwards.
    other = F.expr("CASE WHEN shiftright(key, 32) < 32 THEN shiftrightunsigned(a, 32) ELSE a END & 4294967295L")
    narrowed = large.select(F.col("a").alias("fp"), "key", other.alias("other"), F.explode(F.sequence(F.lit(0), F.lit(3))).alias("byte"))
    narrowed = narrowed.select(F.xxhash64("key", "byte", F.expr("shiftright(other, byte * 8) & 255")).alias("key"), "fp").distinct()
    second = sorted_by_key(narrowed).mapInArrow(near_links(most, None), schema)
    found = first.where(F.col("b").isNotNull()).select("a", "b").unionByName(second.select("a", "b"))
    return found.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def grouped(docs: DataFrame, shingle: int = SHINGLE, most: int = MAX_BITS) -> tuple[DataFrame, DataFrame]:
    """((doc_id, dig, fp) of every row, (fp, root, first) of every fingerprint): ``first`` is the smallest (doc_id, dig) of the component."""
    rows = materialize(fingerprints(docs, shingle), "fingerprints")
    named = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "dig")
    classes = materialize(rows.groupBy("fp").agg(F.min(named).alias("first")), "fingerprint-classes")
    roots = components(links(classes.select("fp"), most))
    placed = classes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("root"), "first")
    firsts = placed.groupBy("root").agg(F.min("first").alias("first"))
    return rows, placed.select("fp", "root").join(firsts, "root").select("fp", "root", "first")


def component_ids(docs: DataFrame, shingle: int = SHINGLE, most: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id) of every row."""
    rows, groups = grouped(docs, shingle, most)
    return rows.join(groups, "fp").select("doc_id", "fp", F.col("first.doc_id").alias("component_id"))


def dedup(docs: DataFrame, shingle: int = SHINGLE, most: int = MAX_BITS) -> DataFrame:
    """One row of each component, with all its columns."""
    _, groups = grouped(docs, shingle, most)
    stay = groups.select(F.col("first.doc_id").alias("stay_id"), F.col("first.dig").alias("stay_dig")).distinct()
    rows = packed(docs).withColumns({"id": F.col("row").getField("doc_id").cast("long"), "dig": digest(F.col("row").getField("text"))})
    same = F.col("id").eqNullSafe(F.col("stay_id")) & (F.col("dig") == F.col("stay_dig"))
    once = Window.partitionBy("id", "dig").orderBy(F.lit(0))
    kept = rows.join(stay, same).withColumn("nth", F.row_number().over(once)).where("nth = 1")
    return unpacked(kept, docs.columns)
