"""Line dedup: long lines that many documents hold stay only in the newest of them.

Lines are known by a 128-bit hash of their key (blanks stripped at both ends, A-Z lower-cased).
Tasks add up their own lines' document counts before the shuffle; the lines found often enough go
to shards, each with a minimal perfect hash over one half of the line hash that indexes a
fingerprint array (the other half), a count array and an array of the largest document id.
Documents send their lines' hashes to the shards and get back the numbers of the lines to drop;
lines themselves are never joined. A shard is read by as many lanes of documents as its lines'
counts ask for, so a line that a third of all documents hold is spread over many tasks; so are
exact copies of a text, as the lane comes from id and text.

Defined cases. A null or empty text is one empty line. A document is a row: repeated rows count
as documents of their own and fare alike. A null id ranks below every other, and where all holders
of a line have a null id each keeps it. Extra columns are kept. An empty table gives an empty
result. Line hashes are taken as equal only if all 128 bits are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm import perfect_hash
from riskframe.llm.common import BLANKS, batch, digest, packed
from riskframe.sources.scratch import materialize

MIN_CHARS = 40
MIN_DOCS = 5
#: Lines in a shard and lines asked for by one lane, about.
SHARD = 1 << 16
LANE = 200_000
#: A task passes its counts on after so many distinct lines.
HELD = 300_000

_STRIP = BLANKS.encode()
_CONT = bytes(range(0x80, 0xC0))


def line_hashes(text: bytes | None, least: int) -> Iterator[tuple[int, bytes]]:
    """(line number, 16-byte hash) of the lines whose key has ``least`` characters or more."""
    for number, line in enumerate((text or b"").split(b"\n")):
        key = line.strip(_STRIP).lower()  # on bytes, lower() changes A-Z alone
        if len(key) >= least and len(key.translate(None, _CONT)) >= least:
            yield number, xxhash.xxh3_128_digest(key)


def halves(hashes: list[bytes]) -> np.ndarray:
    """(n, 2) signed 64-bit halves."""
    return np.frombuffer(b"".join(hashes), np.int64).reshape(-1, 2)


def line_counts(docs: DataFrame, least: int) -> DataFrame:
    """(hi, lo, n, newest): documents per long line and the largest id among them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list] = {}

        def flush() -> pa.RecordBatch:
            hi, lo = halves(list(held)).T
            out = batch(hi=hi.copy(), lo=lo.copy(), n=pa.array([v[0] for v in held.values()], pa.int64()), newest=pa.array([v[1] for v in held.values()], pa.int64()))
            held.clear()
            return out

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                for h in {h for _, h in line_hashes(text.as_py(), least)}:
                    entry = held.setdefault(h, [0, None])
                    entry[0] += 1
                    if doc_id is not None and (entry[1] is None or doc_id > entry[1]):
                        entry[1] = doc_id
                if len(held) >= HELD:
                    yield flush()
        if held:
            yield flush()

    parts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(count, "hi long, lo long, n long, newest long")
    return parts.groupBy("hi", "lo").agg(F.sum("n").alias("n"), F.max("newest").alias("newest"))


def shard_of(hi: Column, shards: int) -> Column:
    return F.pmod(hi, F.lit(shards)).cast("int")


def build_shard(lines: pd.DataFrame) -> pd.DataFrame:
    lines = lines.drop_duplicates("lo")
    keys = lines["lo"].to_numpy(np.int64).view(np.uint64)
    sizes, bits = perfect_hash.build(keys)
    at = perfect_hash.slots(keys, sizes, bits)
    place = lambda values, kind: (out := np.zeros(len(keys), kind), out.__setitem__(at, values))[0].tobytes()
    return pd.DataFrame(
        {
            "shard": [lines["shard"].iloc[0]], "lines": [len(keys)], "sizes": [sizes.tobytes()], "bits": [np.packbits(bits).tobytes()],
            "prints": [place(lines["hi"].to_numpy(np.int64), np.int64)], "counts": [place(lines["n"].to_numpy(np.int64), np.int64)],
            "newest": [place(lines["newest"].fillna(0).to_numpy(np.int64), np.int64)], "named": [place(lines["newest"].notna().to_numpy(bool), bool)],
        }
    )


def probe(asks: pd.DataFrame, arrays: pd.DataFrame) -> pd.DataFrame:
    """Line numbers to drop of each asking document."""
    none = pd.DataFrame({"doc_id": pd.Series([], dtype="Int64"), "dig": pd.Series([], dtype="int64"), "gone": pd.Series([], dtype=object)})
    if asks.empty or arrays.empty:
        return none
    a = arrays.iloc[0]
    sizes = np.frombuffer(a["sizes"], np.int64)
    bits = np.unpackbits(np.frombuffer(a["bits"], np.uint8), count=int(sizes.sum())).astype(bool)
    prints, newest, named = np.frombuffer(a["prints"], np.int64), np.frombuffer(a["newest"], np.int64), np.frombuffer(a["named"], bool)
    size = np.array([len(x) for x in asks["number"]])
    hi, lo = np.concatenate(list(asks["hi"])).astype(np.int64), np.concatenate(list(asks["lo"])).astype(np.int64)
    owner = np.repeat(np.arange(len(asks)), size)
    slot = perfect_hash.slots(lo.view(np.uint64), sizes, bits)
    ids = asks["doc_id"].fillna(0).to_numpy(np.int64)[owner]
    known = asks["doc_id"].notna().to_numpy()[owner]
    keeps = np.where(named[slot], known & (newest[slot] == ids), True)
    drop = np.flatnonzero((slot >= 0) & (prints[slot] == hi) & ~keeps)
    if not len(drop):
        return none
    number, owner = np.concatenate(list(asks["number"]))[drop], owner[drop]
    firsts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    rows = asks.iloc[owner[firsts]]
    return pd.DataFrame({"doc_id": rows["doc_id"].astype("Int64").to_numpy(), "dig": rows["dig"].to_numpy(), "gone": [x.tolist() for x in np.split(number, firsts[1:])]})


def asks_of(docs: DataFrame, least: int, lanes: list[int]) -> DataFrame:
    """(shard, lane, doc_id, dig, number, hi, lo): what each document asks of each shard. ``lanes`` has the lanes of each shard, 0 where it holds no line."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lanes_of, shards = np.array(lanes, np.int64), len(lanes)
        for b in batches:
            out: list[list] = [[] for _ in range(7)]
            asked = set()
            for doc_id, dig, spread, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3)):
                # Repeated rows get one answer, so one of them asks.
                if (doc_id, dig) in asked:
                    continue
                asked.add((doc_id, dig))
                found = list(line_hashes(text.as_py(), least))
                if not found:
                    continue
                numbers, both = np.array([n for n, _ in found], np.int32), halves([h for _, h in found])
                of = np.mod(both[:, 0], shards)
                for s in np.unique(of):
                    if lanes_of[s]:
                        own = of == s
                        for x, v in zip(out, (s, spread % lanes_of[s], doc_id, dig, numbers[own], both[own, 0], both[own, 1])):
                            x.append(v)
            yield batch(
                shard=pa.array(out[0], pa.int32()), lane=pa.array(out[1], pa.int32()), doc_id=pa.array(out[2], pa.int64()), dig=pa.array(out[3], pa.int64()),
                number=pa.array(out[4], pa.list_(pa.int32())), hi=pa.array(out[5], pa.list_(pa.int64())), lo=pa.array(out[6], pa.list_(pa.int64())),
            )

    keyed = docs.select(F.col("doc_id").cast("long").alias("id"), digest(F.col("text")).alias("dig"), F.col("text").cast("binary").alias("body"))
    # Copies of one text under many ids spread over the lanes.
    return keyed.select("id", "dig", F.xxhash64("id", "dig"), "body").mapInArrow(
        ask, "shard int, lane int, doc_id long, dig long, number array<int>, hi array<long>, lo array<long>"
    )


def lines_to_drop(docs: DataFrame, least: int = MIN_CHARS, often: int = MIN_DOCS) -> DataFrame:
    """(doc_id, dig, gone): numbers, from 0, of the lines each document loses; documents that lose none are left out."""
    often_held = materialize(line_counts(docs, least).where(F.col("n") >= often), "lines")
    shards = max(1, math.ceil(often_held.count() / SHARD))
    often_held = often_held.withColumn("shard", shard_of(F.col("hi"), shards))
    arrays = materialize(
        often_held.groupBy("shard").applyInPandas(build_shard, "shard int, lines long, sizes binary, bits binary, prints binary, counts binary, newest binary, named binary"),
        "line-shards",
    )
    # One number per shard of SHARD lines comes to the driver: how many lanes of documents read it.
    hits = dict(often_held.groupBy("shard").agg(F.sum("n")).collect())
    share = docs.count() / shards
    lanes = [max(4, math.ceil((share + hits.get(s, 0)) / LANE)) if s in hits else 0 for s in range(shards)]

    asks = asks_of(docs, least, lanes)
    each = F.get(F.split(F.lit(",".join(map(str, lanes))), ",").cast("array<int>"), F.col("shard"))
    copies = arrays.withColumn("lane", F.explode(F.sequence(F.lit(0), each - 1)))
    gone = asks.groupBy("shard", "lane").cogroup(copies.groupBy("shard", "lane")).applyInPandas(probe_group, "doc_id long, dig long, gone array<int>")
    # Repeated rows have asked more than once; a document's lines may lie in several shards.
    once = gone.withColumn("first", F.col("gone")[0]).dropDuplicates(["doc_id", "dig", "first"])
    return once.groupBy("doc_id", "dig").agg(F.flatten(F.collect_list("gone")).alias("gone"))


def probe_group(key: tuple, asks: pd.DataFrame, arrays: pd.DataFrame) -> pd.DataFrame:
    return probe(asks, arrays)


def dedup(docs: DataFrame, least: int = MIN_CHARS, often: int = MIN_DOCS) -> DataFrame:
    """``row`` (the document), ``kept`` (its text without the dropped lines), n_lines, n_dropped."""
    gone = lines_to_drop(docs, least, often).select(F.col("doc_id").alias("gone_id"), F.col("dig").alias("gone_dig"), "gone")
    rows = packed(docs).withColumns({"id": F.col("row").getField("doc_id").cast("long"), "dig": digest(F.col("row").getField("text"))})
    joined = rows.join(gone, F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("dig") == F.col("gone_dig")), "left")
    text = F.col("row").getField("text")
    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    return (
        joined.withColumn("lines", lines)
        .withColumn("kept", F.when(F.col("gone").isNull(), text).otherwise(F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n")))
        .select("row", "kept", F.size("lines").cast("long").alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"))
    )
