"""Suffix-array dedup: bytes covered by a long string that occurs anywhere else are removed.

The suffix arrays are sparse. In every run of 400 bytes the 100-byte string with the smallest hash
is an anchor (the first of equals), so two equal runs have their anchors at one and the same offset,
and only suffixes that start at anchors are indexed, about one in 150. A suffix entry holds the hash
of its first 100 bytes, by which equal beginnings meet in a grouping (levels are not ordered), and the hash of its
context: all bytes that 400-byte runs over the anchor can reach, 300 before it and 400 from it.

Batches of documents get an array each. Arrays form a logarithmic family: a new one becomes a level of
its own, and levels of one size class are merged into the next class, so an entry is rewritten a
logarithmic number of times. One scan over all levels, after the last batch, finds the long matches:

* entries with equal contexts: every run over these anchors occurs elsewhere, nothing is compared;
* entries with equal beginnings in different contexts: one context of each kind is fetched, and the
  runs at each of the 301 offsets are compared by 64-bit hashes.

A beginning with more than HELD different contexts is not gathered: its runs are counted by
(beginning, offset, hash), with counts added up in each task first.

Defined cases. A null text is empty. Texts under 400 bytes lose nothing. Repeated rows are texts
like any other, so each loses what it shares with the others. Matches never cross documents. Ids may
be null or repeated: a document is known by its id and a hash of its text. Extra columns are kept
by ``dedup``. An empty table gives an empty result. Equal strings are taken from equal 64-bit
hashes within one beginning, itself a 64-bit hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.llm.common import batch, digest, packed
from riskframe.sources.scratch import materialize

LENGTH = 400
GRAM = 100
#: Batches that a whole table is taken in.
BATCHES = 3
#: Bytes hashed at a time, and contexts compared at a time.
STRETCH, AT_ONCE = 1 << 22, 4096
#: Contexts of one beginning that are gathered; more are counted.
HELD = AT_ONCE
#: Longer texts are hashed in overlapping stretches.
CUT = STRETCH

_REACH = LENGTH - GRAM
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_TABLE = np.random.default_rng(2024).integers(1, 1 << 63, 256, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_POWERS = np.ones(STRETCH + 1, np.uint64)
_DOWN = np.ones(STRETCH + 1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, made once."""
    if _POWERS[1] == 1:
        _POWERS[1:] = _BASE
        _DOWN[1:] = _INVERSE
        np.multiply.accumulate(_POWERS, out=_POWERS)
        np.multiply.accumulate(_DOWN, out=_DOWN)
    return _POWERS[:n], _DOWN[:n]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Polynomial prefix hashes of bytes: entry i is that of the first i bytes."""
    up, _ = _powers(len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_TABLE[data] * up, out=out[1:])
    return out


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the least value in each window (leading bits; the first of equals), by blocks of prefix and suffix minima."""
    n = len(values)
    blocks = -(-n // width)
    full = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    # Positions in the low bits: ties fall to the first, and a minimum tells where it is.
    full[:n] = (values & ~np.uint64(STRETCH - 1)) | np.arange(n, dtype=np.uint64)
    grid = full.reshape(blocks, width)
    before = np.minimum.accumulate(grid, axis=1).ravel()
    after = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(after[: n - width + 1], before[width - 1 : n])
    return (least & np.uint64(STRETCH - 1)).astype(np.int64)


def anchors(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(positions, beginnings, contexts) of the anchors of one text."""
    if len(text) < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    if len(text) > CUT:
        # Stretches overlap so that every run and every context lies in one of them whole.
        step, parts = CUT - 4 * LENGTH, []
        for at in range(0, len(text), step):
            lo, hi = max(0, at - 2 * LENGTH), min(len(text), at + step + 2 * LENGTH)
            if hi - lo < LENGTH:
                continue
            pos, beginning, context = _anchors(np.frombuffer(text, np.uint8, hi - lo, lo), lo, len(text))
            own = (pos >= at) & (pos < at + step)
            parts.append((pos[own], beginning[own], context[own]))
        return tuple(np.concatenate(x) for x in zip(*parts))
    return _anchors(np.frombuffer(text, np.uint8), 0, len(text))


def _anchors(data: np.ndarray, base: int, total: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sums = prefix_sums(data)
    _, down = _powers(len(data))
    of = lambda a, b: (sums[b] - sums[a]) * down[a]
    starts = np.arange(len(data) - GRAM + 1)
    grams = _mix((sums[GRAM:] - sums[:-GRAM]) * down[starts])
    pos = np.unique(sliding_least(grams, _REACH + 1))
    lo, hi = np.maximum(pos - _REACH, 0), np.minimum(pos + LENGTH, len(data))
    # A context at an end of its text is shorter, and equal to one cut alike only.
    cut = ((pos - lo) * 1024 + (hi - pos)).astype(np.uint64)
    context = _mix(of(lo, hi) ^ (cut * np.uint64(0xC2B2AE3D27D4EB4F)))
    return pos + base, grams[pos], context


def anchor_rows(docs: DataFrame) -> DataFrame:
    """(id, dig, pos, beginning, context): arrays, one row per document with anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, digs, out = [], [], [[], [], []]
            for doc_id, dig, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                if text.is_valid and len(raw := text.as_py()) >= LENGTH:
                    found = anchors(raw)
                    ids.append(doc_id)
                    digs.append(dig)
                    for x, v in zip(out, (found[0].astype(np.int32), found[1].view(np.int64), found[2].view(np.int64))):
                        x.append(v)
            yield batch(
                id=pa.array(ids, pa.int64()), dig=pa.array(digs, pa.int64()), pos=pa.array(out[0], pa.list_(pa.int32())),
                beginning=pa.array(out[1], pa.list_(pa.int64())), context=pa.array(out[2], pa.list_(pa.int64())),
            )

    keyed = docs.select(F.col("doc_id").cast("long").alias("id"), digest(F.col("text")).alias("dig"), F.col("text").cast("binary").alias("body"))
    return keyed.mapInArrow(run, "id long, dig long, pos array<int>, beginning array<long>, context array<long>")


def each_anchor(rows: DataFrame) -> DataFrame:
    return rows.select("id", "dig", F.explode(F.arrays_zip("pos", "beginning", "context")).alias("a")).select("id", "dig", "a.*")


def array_of(rows: DataFrame) -> DataFrame:
    """A batch's suffix array: (beginning, context, n, at), ``at`` one place where the context occurs."""
    entries = each_anchor(rows)
    return entries.groupBy("beginning", "context").agg(F.count("*").alias("n"), F.min(F.struct("id", "dig", "pos")).alias("at"))


class Family:
    """Levels of suffix arrays; a level's size class is the power of two of batches that it holds."""

    def __init__(self) -> None:
        self.levels: dict[int, DataFrame] = {}

    def add(self, array: DataFrame) -> None:
        size = 0
        while size in self.levels:
            array = merged([self.levels.pop(size), array])
            size += 1
        self.levels[size] = materialize(array, f"suffix-level-{size}")

    def scan(self) -> DataFrame:
        """All levels merged, with the number of different contexts of each beginning (``kinds``)."""
        every = merged(list(self.levels.values()))
        kinds = every.groupBy(F.col("beginning").alias("b")).agg(F.count("*").alias("kinds")).where("kinds > 1")
        return every.join(kinds, F.col("beginning") == F.col("b"), "left").select("beginning", "context", "n", "at", F.coalesce("kinds", F.lit(1)).alias("kinds"))


def merged(arrays: list[DataFrame]) -> DataFrame:
    union = arrays[0]
    for other in arrays[1:]:
        union = union.unionByName(other)
    return union if len(arrays) == 1 else union.groupBy("beginning", "context").agg(F.sum("n").alias("n"), F.min("at").alias("at"))


def contexts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(beginning, n, kinds, id, dig, pos, left, bytes): the contexts of wanted entries, fetched from their documents."""
    places = wanted.groupBy(F.col("at.id").alias("at_id"), F.col("at.dig").alias("at_dig")).agg(
        F.collect_list(F.struct(F.col("at.pos").alias("pos"), "beginning", "n", "kinds")).alias("places")
    )
    keyed = docs.select(F.col("doc_id").cast("long").alias("id"), digest(F.col("text")).alias("dig"), F.col("text").cast("binary").alias("body"))
    joined = keyed.join(places, F.col("id").eqNullSafe(F.col("at_id")) & (F.col("dig") == F.col("at_dig"))).select("id", "dig", "body", "places")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[] for _ in range(8)]
            for doc_id, dig, text, found in zip(*(b.column(c) for c in range(4))):
                raw, key = text.as_py(), (doc_id.as_py(), dig.as_py())
                for p in found.as_py():
                    lo = max(0, p["pos"] - _REACH)
                    row = (p["beginning"], p["n"], p["kinds"], *key, p["pos"], p["pos"] - lo, raw[lo : p["pos"] + LENGTH])
                    for x, v in zip(out, row):
                        x.append(v)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
            names = ("beginning", "n", "kinds", "id", "dig", "pos", "left", "bytes")
            yield batch(**{name: pa.array(x, kind) for name, x, kind in zip(names, out, kinds)})

    schema = "beginning long, n long, kinds long, id long, dig long, pos int, left int, bytes binary"
    # Repeated rows give the same place more than once.
    return joined.mapInArrow(run, schema).dropDuplicates(["beginning", "id", "dig", "pos"])


def run_hashes(lefts: np.ndarray, raws: list[bytes]) -> np.ndarray:
    """[context, offset] hashes of the runs that start ``offset`` bytes before the anchor; 0 where there is none."""
    width = _REACH + LENGTH
    grid = np.zeros((len(raws), width), np.uint8)
    sizes = np.fromiter(map(len, raws), np.int64, len(raws))
    for i, raw in enumerate(raws):
        grid[i, _REACH - lefts[i] : _REACH - lefts[i] + len(raw)] = np.frombuffer(raw, np.uint8)
    up, _ = _powers(width)
    sums = np.zeros((len(raws), width + 1), np.uint64)
    np.cumsum(_TABLE[grid] * up, axis=1, out=sums[:, 1:])
    # Column of the run's start; runs at one offset start in one column, so no shift is needed.
    columns = _REACH - np.arange(_REACH + 1)
    hashes = _mix(sums[:, columns + LENGTH] - sums[:, columns])
    right = sizes - lefts
    fits = (np.arange(_REACH + 1)[None, :] <= lefts[:, None]) & (LENGTH - np.arange(_REACH + 1)[None, :] <= right[:, None])
    hashes |= np.uint64(1)
    hashes[~fits] = 0
    return hashes


def spans_of(repeated: np.ndarray, pos: int) -> list[tuple[int, int]]:
    """Byte ranges that the repeated offsets of one anchor cover."""
    offsets = np.flatnonzero(repeated)
    if not len(offsets):
        return []
    breaks = np.flatnonzero(np.diff(offsets) > LENGTH)
    first, last = offsets[np.r_[0, breaks + 1]], offsets[np.r_[breaks, len(offsets) - 1]]
    return [(int(pos - b), int(pos - a + LENGTH)) for a, b in zip(first, last)]


def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, dig, lo, hi) from contexts sorted by beginning."""
    held: list[tuple] = []

    def settle(rows: list[tuple]) -> pa.RecordBatch:
        out: list[tuple] = []
        lefts = np.array([r[6] for r in rows], np.int64)
        hashes = run_hashes(lefts, [r[7] for r in rows])
        group = _mix(np.array([r[0] for r in rows], np.int64).view(np.uint64))[:, None]
        none = hashes == 0
        hashes ^= group
        hashes[none] = 0
        order = np.argsort(hashes, axis=0)
        placed = np.take_along_axis(hashes, order, axis=0)
        same = (placed[1:] == placed[:-1]) & (placed[1:] != 0)
        hit = np.zeros_like(none)
        hit[1:] |= same
        hit[:-1] |= same
        repeated = np.zeros_like(none)
        np.put_along_axis(repeated, order, hit, axis=0)
        for r, own in zip(rows, repeated):
            if r[1] == 1 and own.any():
                out.extend((r[3], r[4], lo, hi) for lo, hi in spans_of(own, r[5]))
        columns = list(zip(*out)) or [[], [], [], []]
        return batch(id=pa.array(columns[0], pa.int64()), dig=pa.array(columns[1], pa.int64()), lo=pa.array(columns[2], pa.int64()), hi=pa.array(columns[3], pa.int64()))

    for b in (whole.slice(at, AT_ONCE) for whole in batches for at in range(0, whole.num_rows, AT_ONCE)):
        held.extend(zip(*(b.column(c).to_pylist() for c in range(8))))
        if len(held) >= AT_ONCE:
            # All but the last beginning, which may go on.
            last = held[-1][0]
            keep = next(i for i in range(len(held) - 1, -2, -1) if i < 0 or held[i][0] != last) + 1
            if keep:
                yield settle(held[:keep])
                held = held[keep:]
    if held:
        yield settle(held)


def counted(rows: DataFrame) -> DataFrame:
    """The same as ``compared`` for beginnings with too many contexts for a task: runs are counted, not gathered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data = b.to_pydict()
            lefts = np.array(data["left"], np.int64)
            for at in range(0, len(lefts), 64):
                hashes = run_hashes(lefts[at : at + 64], data["bytes"][at : at + 64])
                i, offset = np.nonzero(hashes)
                of = lambda name, kind: pa.array(data[name][at : at + 64], kind).take(pa.array(i))  # noqa: B023, E731
                yield batch(
                    beginning=of("beginning", pa.int64()), offset=pa.array(offset, pa.int32()), hash=pa.array(hashes[i, offset].view(np.int64)),
                    n=of("n", pa.int64()), id=of("id", pa.int64()), dig=of("dig", pa.int64()), pos=of("pos", pa.int32()),
                )

    runs = rows.mapInArrow(run, "beginning long, offset int, hash long, n long, id long, dig long, pos int")
    by = ["beginning", "offset", "hash"]
    often = runs.groupBy(*by).agg(F.count("*").alias("found")).where("found > 1").drop("found")
    start = F.col("pos").cast("long") - F.col("offset")
    return runs.where("n = 1").join(often, by).select("id", "dig", start.alias("lo"), (start + LENGTH).alias("hi"))


def repeated_spans(docs: DataFrame, batches: int = BATCHES, held: int = HELD) -> DataFrame:
    """(id, dig, spans): sorted, possibly overlapping byte ranges that occur elsewhere, of the documents that have any."""
    rows = materialize(anchor_rows(docs), "anchors")
    family = Family()
    for i in range(batches):
        family.add(array_of(rows.where(F.pmod(F.xxhash64("id", "dig"), F.lit(batches)) == i)))
    entries = materialize(family.scan().where("n > 1 OR kinds > 1"), "matches")
    # Equal contexts: every run over the anchor is repeated.
    often = entries.where("n > 1").select(F.col("beginning").alias("b"), F.col("context").alias("c"))
    whole = each_anchor(rows).join(often, (F.col("beginning") == F.col("b")) & (F.col("context") == F.col("c")))
    whole = whole.select("id", "dig", (F.col("pos") - _REACH).cast("long").alias("lo"), (F.col("pos") + LENGTH).cast("long").alias("hi"))
    fetched = materialize(contexts(docs, entries.where("kinds > 1")), "contexts")
    schema = "id long, dig long, lo long, hi long"
    some = fetched.where(F.col("kinds") <= held).repartition("beginning").sortWithinPartitions("beginning").mapInArrow(compared, schema)
    many = counted(fetched.where(F.col("kinds") > held))
    spans = whole.unionByName(some).unionByName(many).distinct()
    return spans.groupBy("id", "dig").agg(F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("spans"))


def cut_out(text: bytes, spans: list[dict] | None) -> tuple[bytes, int, int]:
    """(what is left, bytes removed, runs removed)."""
    kept, at, runs, end = [], 0, 0, -1
    for s in spans or ():
        lo, hi = max(0, s["lo"]), min(len(text), s["hi"])
        if lo > end:
            kept.append(text[at:lo])
            runs += 1
        end = max(end, hi)
        at = end
    kept.append(text[at:])
    left = b"".join(kept)
    return left, len(text) - len(left), runs


def dedup(docs: DataFrame, batches: int = BATCHES, held: int = HELD) -> DataFrame:
    """``row`` (the document), ``kept`` (binary: bytes of a text may be cut anywhere), n_bytes, n_removed, n_spans."""
    spans = repeated_spans(docs, batches, held).select(F.col("id").alias("s_id"), F.col("dig").alias("s_dig"), "spans")
    rows = packed(docs).withColumns({"id": F.col("row").getField("doc_id").cast("long"), "dig": digest(F.col("row").getField("text"))})
    joined = rows.join(spans, F.col("id").eqNullSafe(F.col("s_id")) & (F.col("dig") == F.col("s_dig")), "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [cut_out(t.as_py() or b"", s.as_py()) for t, s in zip(b.column(1), b.column(2))]
            ints = lambda k: pa.array([m[k] for m in made], pa.int64())
            sizes = pa.array([len(m[0]) + m[1] for m in made], pa.int64())
            yield batch(row=b.column(0), kept=pa.array([m[0] for m in made], pa.binary()), n_bytes=sizes, n_removed=ints(1), n_spans=ints(2))

    schema = T.StructType([rows.schema["row"], T.StructField("kept", T.BinaryType()), *(T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans"))])
    return joined.select("row", F.col("row").getField("text").cast("binary").alias("body"), "spans").mapInArrow(cut, schema)
