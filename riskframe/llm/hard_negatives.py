"""Hard negatives by vertical scans of decomposed vectors (BOND).

An anchor's positives are its best rows of the same label; a positive's hard negatives are the best
rows of other labels whose score lies between two shares of the positive's.

Vectors, as whole numbers floor(SCALE * x), are stored by dimension: a block holds up to BLOCK rows as
one column per dimension, with each column's least and greatest value. Rows are range partitioned by
length, label and a hash, so a block holds few labels and a hot label fills many blocks. An anchor reads
a block's columns in the descending order of its own components' size, STEP columns at a time. What
the columns not yet read can still add lies between the sums of the smaller and larger of (component *
least, component * greatest). Rows whose partial score with these bounds cannot reach the anchor's
window drop out of the block's bitmap, until the rest have exact scores. The window's lower end rises
with the k-th best score found so far.

Anchors are packed into groups of at most GROUP rows and blocks into bands of about BAND rows; every
group meets every band once, first among rows of its anchors' labels for the positives, then among the
others for the negatives. A meeting gives at most k rows for each anchor, or positive.

Defined cases. Rows whose id, label or vector is null, or whose vector has a null or non-finite
component, take no part. Rows of an anchor's own id are neither positive nor negative for it; anchors
repeated with the same label and vector count once. Other repeated rows count as rows. Vectors of
another length than the anchor's take no part in its search. Ties go to the smaller id. A positive
without a row in its window gives none; nor does a negative positive score, whose window is empty.
Components so large that a sum may pass 2^53 are multiplied in whole numbers without bounds; scores
beyond 64 bits are clamped after ranking within a band. An empty table gives an empty result. Only the
three named columns are read; other columns may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskframe.llm.common import batch
from riskframe.sources.scratch import materialize

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
#: A negative's score lies between these percentages of the positive's.
LEAST, MOST = 30, 90
BLOCK, BAND, GROUP = 4096, 8192, 2048
#: Columns read between two looks at the bounds.
STEP = 8
_MAX = (1 << 63) - 1


class Block:
    """Rows of one vector length by dimension, in the order of their labels."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, columns: np.ndarray):
        self.ids, self.labels, self.columns = ids, labels, columns
        self.least, self.greatest = (f(axis=1).astype(float) if columns.size else np.zeros(len(columns)) for f in (columns.min, columns.max))
        self.narrow = columns.astype(np.float32)

    def stretch(self, label: int) -> tuple[int, int]:
        return tuple(int(np.searchsorted(self.labels, label, side)) for side in ("left", "right"))


class Found:
    """The k best (score, id) so far, best first; ties to the smaller id."""

    def __init__(self, k: int, least: int | None = None, most: int | None = None):
        self.k, self.most = k, most
        self.floor = least
        self.scores, self.ids = np.zeros(0, object), np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        keep = np.ones(len(scores), bool)
        if self.floor is not None:
            keep &= scores >= self.floor
        if self.most is not None:
            keep &= scores <= self.most
        if not keep.any():
            return
        scores, ids = np.concatenate([self.scores, scores[keep]]), np.concatenate([self.ids, ids[keep]])
        # Whole numbers beyond 64 bits stay Python's.
        kind = np.int64 if max(abs(int(scores.max())), abs(int(scores.min()))) < _MAX else object
        order = np.lexsort((ids, -scores.astype(kind)))[: self.k]
        self.scores, self.ids = scores[order], ids[order]
        if len(order) == self.k:
            self.floor = int(self.scores[-1])


def scan(anchor: np.ndarray, block: Block, rows: tuple[int, int], floor: float, ceiling: float, read: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, exact scores) of the rows whose score may lie between ``floor`` and ``ceiling``."""
    lo, hi = rows
    if lo >= hi:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    bound = float((np.abs(anchor) * np.maximum(np.abs(block.least), np.abs(block.greatest))).sum())
    if bound >= 2**53:
        whole = np.vectorize(int, otypes=[object])
        return np.arange(lo, hi), (whole(anchor) @ whole(block.columns[:, lo:hi])) if len(anchor) else np.zeros(hi - lo, object)
    # Sums of whole numbers below the type's precision are exact.
    columns, a = (block.narrow, anchor.astype(np.float32)) if bound < 2**24 else (block.columns, anchor)
    order = np.argsort(-np.abs(anchor), kind="stable")
    ends = anchor[order] * block.least[order], anchor[order] * block.greatest[order]
    more, less = (np.concatenate([np.cumsum(f(*ends)[::-1])[::-1], [0]]) for f in (np.maximum, np.minimum))
    live, partial = None, np.zeros(hi - lo, columns.dtype)
    for s in range(0, len(order), STEP):
        dims, e = order[s : s + STEP], min(s + STEP, len(order))
        part = columns[dims, lo:hi] if live is None else columns[np.ix_(dims, live)]
        partial = partial + a[dims] @ part
        if read is not None:
            read.append(part.size)
        bitmap = partial >= floor - more[e]
        if ceiling < math.inf:
            bitmap &= partial <= ceiling - less[e]
        kept = int(bitmap.sum())
        if not kept:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        if kept < 0.8 * len(partial) or e == len(order):
            live = (np.arange(lo, hi) if live is None else live)[bitmap]
            partial = partial[bitmap]
    return (np.arange(lo, hi) if live is None else live), partial.astype(np.int64)


def positives_of(anchor: np.ndarray, own: int, label: int, blocks: list[Block], k: int) -> Found:
    found = Found(k)
    for b in blocks:
        at, scores = scan(anchor, b, b.stretch(label), -math.inf if found.floor is None else found.floor, math.inf)
        other = b.ids[at] != own
        found.add(scores[other], b.ids[at][other])
    return found


def window_of(score: int, least: int = LEAST, most: int = MOST) -> tuple[int, int]:
    """Whole scores from ``least`` to ``most`` per cent of a score."""
    return -(-least * score // 100), most * score // 100


def negatives_of(anchor: np.ndarray, own: int, label: int, scores: list[int], blocks: list[Block], k: int) -> list[Found]:
    """The best of other labels for each of the positives' scores."""
    all_found = [Found(k, *window_of(s)) for s in scores]
    open_ = [f for f in all_found if f.floor <= f.most]
    if not open_:
        return all_found
    ceiling = max(f.most for f in open_)
    for b in blocks:
        lo, hi = b.stretch(label)
        for rows in ((0, lo), (hi, len(b.ids))):
            at, got = scan(anchor, b, rows, min(f.floor for f in open_), ceiling)
            other = b.ids[at] != own
            for f in open_:
                f.add(got[other], b.ids[at][other])
    return all_found


def taking_part(rows: DataFrame, vec_id: str, label: str, embedding: str) -> DataFrame:
    """(vec_id, label, dim, vec) of the rows that take part, components as whole doubles."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    there = F.col(vec_id).isNotNull() & F.col(label).isNotNull() & F.col(embedding).isNotNull()
    vec = F.transform(F.col(embedding), lambda x: F.floor(x.cast("double") * SCALE).cast("double"))
    return rows.where(there & F.coalesce(finite, F.lit(False))).select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), F.size(embedding).alias("dim"), vec.alias("vec")
    )


def packed_rows(rows: DataFrame, parts: int, most: int) -> DataFrame:
    """(part, block, dim, ids, labels, vectors): up to ``most`` rows of one length each, by label, vectors by dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        held: list[tuple] = []

        def full(rows: list[tuple]) -> pa.RecordBatch:
            ids, labels = (np.array([r[i] for r in rows], np.int64) for i in (0, 1))
            matrix = np.array([r[3] for r in rows], np.float64).reshape(len(rows), rows[0][2]).T
            return batch(part=[part], block=[number], dim=[rows[0][2]], ids=[ids.tobytes()], labels=[labels.tobytes()], vectors=[np.ascontiguousarray(matrix).tobytes()])

        for b in batches:
            for row in zip(*(b.column(i).to_pylist() for i in range(3)), (v.values for v in b.column(3))):
                if held and (len(held) >= most or held[0][2] != row[2]):
                    yield full(held)
                    number, held = number + 1, []
                held.append((*row[:3], row[3].to_numpy()))
        if held:
            yield full(held)

    # The hash spreads a hot label over the ranges.
    spread = rows.withColumn("spread", F.xxhash64("vec_id", "vec"))
    ordered = spread.repartitionByRange(parts, "dim", "label", "spread").sortWithinPartitions("dim", "label", "spread").drop("spread")
    return ordered.mapInArrow(run, "part long, block long, dim long, ids binary, labels binary, vectors binary")


def unpack(table: pa.Table) -> list[Block]:
    out = []
    for r in table.sort_by("block").to_pylist():
        ids, labels = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["labels"], np.int64)
        out.append(Block(ids, labels, np.frombuffer(r["vectors"], np.float64).reshape(r["dim"], len(ids))))
    return out


def meet(groups: DataFrame, bands: DataFrame, n_groups: int, n_bands: int, fn, schema: str) -> DataFrame:
    """``fn`` of every group of anchors and every band of blocks, as tables of one meeting each."""
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<long>"))
    left = groups.withColumn("band", each(n_bands))
    right = bands.withColumnRenamed("part", "band").withColumn("part", each(n_groups))
    return left.groupBy("part", "band").cogroup(right.groupBy("part", "band")).applyInArrow(fn, schema)


def mine(rows: DataFrame, every: int = 100, positives: int = POSITIVES, negatives: int = NEGATIVES, vec_id: str = "vec_id", label: str = "label", embedding: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of the anchors, the rows whose id ``every`` divides."""
    vectors = materialize(taking_part(rows, vec_id, label, embedding), "vectors")
    anchors = vectors.where(F.col("vec_id") % every == 0).distinct()
    bands = materialize(packed_rows(vectors, max(1, math.ceil(vectors.count() / BAND)), BLOCK), "columns")
    groups = materialize(packed_rows(anchors, max(1, math.ceil(anchors.count() / GROUP)), GROUP), "anchors")
    n_bands, n_groups = (1 + (t.agg(F.max("part")).first()[0] or 0) for t in (bands, groups))

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        blocks, out = unpack(right) if right.num_rows else [], []
        for number, group in zip(left["block"].to_pylist(), unpack(left)):
            same = [b for b in blocks if len(b.columns) == len(group.columns)]
            for i, (own, lab) in enumerate(zip(group.ids.tolist(), group.labels.tolist())):
                found = positives_of(group.columns[:, i], own, lab, same, positives)
                out += [(left["part"][0].as_py(), number, i, own, p, clamped(s)) for s, p in zip(found.scores.tolist(), found.ids.tolist())]
        return columns_of(out, ("part", "block", "slot", "anchor_id", "positive_id", "positive_score"))

    schema = "part long, block long, slot long, anchor_id long, positive_id long, positive_score long"
    best = ranked(meet(groups, bands, n_groups, n_bands, scored, schema), ["part", "block", "slot"], "positive_score", "positive_id", positives)
    best = materialize(best, "positives")
    # At most ``positives`` for each anchor of a group.
    known = best.groupBy("part", "block").agg(F.collect_list(F.struct("slot", "rank", "positive_id", "positive_score")).alias("positives"))
    asking = groups.join(known, ["part", "block"])

    def mined(left: pa.Table, right: pa.Table) -> pa.Table:
        blocks, out = unpack(right) if right.num_rows else [], []
        wanted = left.sort_by("block")["positives"].to_pylist()
        for number, group, asked in zip(sorted(left["block"].to_pylist()), unpack(left), wanted):
            same = [b for b in blocks if len(b.columns) == len(group.columns)]
            of: dict[int, list] = {}
            for p in asked:
                of.setdefault(p["slot"], []).append(p)
            for i, ps in of.items():
                own = int(group.ids[i])
                for p, found in zip(ps, negatives_of(group.columns[:, i], own, int(group.labels[i]), [p["positive_score"] for p in ps], same, negatives)):
                    key = (left["part"][0].as_py(), number, i, p["rank"], own, p["positive_id"], p["positive_score"])
                    out += [(*key, n, clamped(s)) for s, n in zip(found.scores.tolist(), found.ids.tolist())]
        return columns_of(out, ("part", "block", "slot", "place", "anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"))

    schema = "part long, block long, slot long, place long, anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    worst = ranked(meet(asking, bands, n_groups, n_bands, mined, schema), ["part", "block", "slot", "place"], "negative_score", "negative_id", negatives)
    return worst.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def clamped(score: int) -> int:
    return max(-_MAX - 1, min(_MAX, int(score)))


def columns_of(rows: list[tuple], names: tuple[str, ...]) -> pa.Table:
    cols = list(zip(*rows)) if rows else [()] * len(names)
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, cols)})


def ranked(df: DataFrame, by: list[str], score: str, tie: str, k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc(score), tie)
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def moved_label(vec_id: str = "vec_id", label: str = "label") -> Column:
    """The label, moved on by one of ten where 7 divides the id."""
    return F.when(F.col(vec_id) % 7 == 0, (F.col(label) + 1) % 10).otherwise(F.col(label))
