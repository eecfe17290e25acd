"""Exact top-k search by inner product, with a pivot table that rules candidates out.

Vectors are taken as integers, floor(SCALE * x). The distances of every vector to PIVOTS pivots are
computed once. For a query q and a candidate c the largest |d(q, p) - d(c, p)| over the pivots is a
lower bound of d(q, c), and so (|q|^2 + |c|^2 - bound^2) / 2 an upper bound of their inner product.
Candidates are evaluated in the order of that bound until it falls below the k-th best score so far;
a query starts with the k-th best score it has among SAMPLE known rows, so most blocks of candidates
give little. Queries and candidates are dealt into blocks by row and each pair of blocks is one
group of a co-grouped join: at most a few thousand rows of either side in a task at once.

The pivots come from a sample of SAMPLE rows (those with the smallest hash) by farthest-first
choice; they only steer how much is evaluated. Every result is exact.

Defined cases. Vectors that are null or hold null or non-finite components take no part, nor do
rows with a null id. A row is not a candidate for queries of its own id. Vectors of another length
than the query's are no candidates for it. Repeated rows count as rows; queries repeated with
the same id and vector are answered once. With fewer candidates than k all are given. Scores beyond
64 bits are clamped to that range after ranking. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskframe.llm.common import batch
from riskframe.sources.scratch import materialize

SCALE = 1024
K = 10
PIVOTS = 32
SAMPLE = 1024
#: Rows of a block.
QUERIES, CANDIDATES = 512, 4096
#: Candidates evaluated before the first look at the bound; twice as many before each next one.
STEP = 64
_MAX = (1 << 63) - 1


def inner(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Exact inner products of integer-valued float64 rows: int64, or Python integers where these could overflow."""
    if not queries.size or not candidates.size:
        return np.zeros((len(queries), len(candidates)), np.int64)
    most = float(np.abs(queries).max()) * float(np.abs(candidates).max()) * queries.shape[1]
    if most < 2**53:
        return (queries @ candidates.T).astype(np.int64)
    kind = np.int64 if most < 2**62 else object
    whole = lambda x: x.astype(np.int64) if kind is np.int64 else np.vectorize(int, otypes=[object])(x)
    return whole(queries) @ whole(candidates).T


def distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.stack([np.sqrt(((rows - p) ** 2).sum(axis=1)) for p in pivots], axis=1) if len(pivots) else np.zeros((len(rows), 0))


def farthest_first(rows: np.ndarray, count: int) -> np.ndarray:
    """Rows that lie far from each other, the first of them first."""
    chosen, near = [0], distances(rows, rows[:1])[:, 0]
    while len(chosen) < min(count, len(rows)) and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, distances(rows, rows[chosen[-1:]])[:, 0])
    return rows[chosen]


def best_of_block(queries: pd.DataFrame, candidates: pd.DataFrame, k: int) -> pd.DataFrame:
    """Rows (query_id, query, vec_id, score) that may be among a query's k best, at most k for each."""
    out: list[tuple] = []
    if queries.empty or candidates.empty:
        return pd.DataFrame(out, columns=["query_id", "query", "vec_id", "score", "whole"])
    q, c = np.stack(queries["vec"].to_list()), np.stack(candidates["vec"].to_list())
    dq, dc = np.stack(queries["far"].to_list()), np.stack(candidates["far"].to_list())
    ids = candidates["vec_id"].to_numpy(np.int64)
    order = np.argsort(ids, kind="stable")
    c, dc, ids = c[order], dc[order], ids[order]
    norm_q, norm_c = (q**2).sum(axis=1), (c**2).sum(axis=1)
    for i, (qid, qno, floor) in enumerate(zip(queries["vec_id"], queries["query"], queries["floor"])):
        far = np.abs(dc - dq[i]).max(axis=1) if dc.shape[1] else np.zeros(len(c))
        size = norm_q[i] + norm_c
        # Distances are rounded; a little more than the bound is allowed for.
        bound = (size - far**2) / 2 + 1e-9 * size + 1
        least = -np.inf if floor is None or np.isnan(floor) else floor
        open_ = np.flatnonzero((bound >= least) & (ids != qid))
        open_ = open_[np.argsort(-bound[open_], kind="stable")]
        scores, rows, at, step = np.zeros(0, np.int64), np.zeros(0, np.int64), 0, STEP
        while at < len(open_) and bound[open_[at]] >= least:
            part = open_[at : at + step]
            # The next look at the bound comes later each time: what is left open is less and less likely to close.
            at, step = at + step, 2 * step
            scores, rows = np.concatenate([scores, inner(q[i : i + 1], c[part])[0]]), np.concatenate([rows, part])
            if len(scores) >= k:
                kth = np.partition(scores, len(scores) - k)[len(scores) - k]
                # Those as good as the k-th stay: the smaller id decides at the end.
                keep = scores >= kth
                scores, rows = scores[keep], rows[keep]
                least = max(least, float(np.nextafter(float(kth), -np.inf)))
        ranked = sorted(zip(scores.tolist(), rows.tolist()), key=lambda x: (-x[0], ids[x[1]]))[:k]
        for score, j in ranked:
            if score >= least or len(scores) <= k:
                out.append((int(qid), int(qno), int(ids[j]), max(-_MAX - 1, min(_MAX, int(score))), str(int(score))))
    return pd.DataFrame(out, columns=["query_id", "query", "vec_id", "score", "whole"])


def whole_vectors(rows: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, vec, dim) of the rows that take part, components as whole doubles."""
    vec = F.transform(F.col(embedding), lambda x: F.floor(x.cast("double") * SCALE).cast("double"))
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    taking = rows.where(F.col(vec_id).isNotNull() & F.col(embedding).isNotNull() & F.coalesce(finite, F.lit(False)))
    return taking.select(F.col(vec_id).cast("long").alias("vec_id"), vec.alias("vec"), F.size(embedding).alias("dim"))


def search(rows: DataFrame, every: int = 100, k: int = K, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of every row whose id ``every`` divides."""
    spark = rows.sparkSession
    vectors = whole_vectors(rows, vec_id, embedding)
    # At most SAMPLE rows come to the driver; pivots and floors go to the tasks with the code.
    sample = vectors.orderBy(F.xxhash64("vec_id", "vec"), "vec_id").limit(SAMPLE).collect()
    known = {}
    for dim in {r["dim"] for r in sample}:
        of = [r for r in sample if r["dim"] == dim]
        mat = np.array([r["vec"] for r in of], np.float64).reshape(len(of), dim)
        known[dim] = (np.array([r["vec_id"] for r in of], np.int64), mat, farthest_first(mat, PIVOTS))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, dims = b.column(0).to_numpy(), b.column(2).to_numpy()
            far: list = [[]] * len(ids)
            floors: list = [None] * len(ids)
            for dim in np.unique(dims):
                if dim not in known:
                    continue
                at = np.flatnonzero(dims == dim)
                mat = np.array([b.column(1)[int(i)].as_py() for i in at], np.float64).reshape(len(at), int(dim))
                own, others, pivots = known[dim]
                for i, d in zip(at, distances(mat, pivots)):
                    far[i] = d
                asks = np.flatnonzero(ids[at] % every == 0)
                for j, scores in zip(asks, inner(mat[asks], others)):
                    rest = sorted(scores[own != ids[at[j]]].tolist(), reverse=True)
                    if len(rest) >= k:
                        # Rounded down, as the score itself must pass.
                        floors[at[j]] = float(np.nextafter(float(rest[k - 1]), -np.inf))
            yield batch(vec_id=b.column(0), vec=b.column(1), dim=b.column(2), far=pa.array(far, pa.list_(pa.float64())), floor=pa.array(floors, pa.float64()))

    measured = vectors.mapInArrow(measure, "vec_id long, vec array<double>, dim int, far array<double>, floor double")
    table = materialize(measured.withColumn("row", F.monotonically_increasing_id()), "pivot-table")
    asked = table.where(F.col("vec_id") % every == 0).groupBy("vec_id", "vec", "dim").agg(F.first("far").alias("far"), F.first("floor").alias("floor"))
    asked = materialize(asked.withColumn("query", F.monotonically_increasing_id()), "queries")
    q_blocks, c_blocks = (max(1, math.ceil(t.count() / n)) for t, n in ((asked, QUERIES), (table, CANDIDATES)))
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    block = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    left = asked.withColumn("qb", block("query", q_blocks)).withColumn("cb", all_of(c_blocks))
    right = table.withColumn("cb", block("row", c_blocks)).withColumn("qb", all_of(q_blocks)).select("qb", "cb", "dim", "vec_id", "vec", "far")

    def pair(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        return best_of_block(queries, candidates, k)

    by = ["qb", "cb", "dim"]
    parts = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(pair, "query_id long, query long, vec_id long, score long, whole string")
    # Beyond 64 bits the whole score decides.
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.desc(F.col("whole").cast("double")), "vec_id")
    ranked = parts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
