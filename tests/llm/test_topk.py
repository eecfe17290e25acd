import math
import random

import numpy as np
import pytest
from helpers import ordered, rows_of

from riskframe.llm import topk as K

SCHEMA = "vec_id long, embedding array<float>, label int, query int, row long, dim string"


def table(n=260, dim=6, seed=2):
    rng = random.Random(seed)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(dim)], 1, 2, 3, "d") for i in range(n)]
    rows += [(1000 + i, list(rows[7][1]), None, None, None, None) for i in range(15)]  # ties
    rows += [(50, None, 1, 1, 1, "x"), (101, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1, 1, 1, "x"), (150, [float("nan")] * 6, 1, 1, 1, "x")]
    rows += [(200, [float("inf")] * 6, 1, 1, 1, "x"), (None, [0.5] * 6, 1, 1, 1, "x"), (2000, [0.25, 0.5], 1, 1, 1, "x"), (2100, [], 1, 1, 1, "x")]
    return rows + [rows[20], rows[20], rows[100]]


def brute(rows, every, k):
    whole = []
    for r in rows:
        if r[0] is None or r[1] is None or any(x is None or not math.isfinite(x) for x in r[1]):
            continue
        whole.append((r[0], [math.floor(1024 * float(np.float32(x))) for x in r[1]]))
    out = []
    for q, qv in sorted({(i, tuple(v)) for i, v in whole if i % every == 0}):
        scored = [(-sum(a * b for a, b in zip(qv, v)), i) for i, v in whole if i != q and len(v) == len(qv)]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scored)[:k])]
    return ordered(out)


@pytest.mark.parametrize("sizes", [(512, 4096, 1024), (7, 40, 16)])
def test_matches_brute_force(spark, monkeypatch, sizes):
    for name, size in zip(("QUERIES", "CANDIDATES", "SAMPLE"), sizes):
        monkeypatch.setattr(K, name, size)
    rows = table()
    got = K.search(spark.createDataFrame(rows, SCHEMA).repartition(3), every=10)
    assert rows_of(got, "query_id", "rank", "vec_id", "score") == brute(rows, 10, 10)


def test_fewer_candidates_than_k_and_empty(spark):
    rows = table()[:4]
    assert rows_of(K.search(spark.createDataFrame(rows, SCHEMA), every=1), "query_id", "rank", "vec_id", "score") == brute(rows, 1, 10)
    assert K.search(spark.createDataFrame([], SCHEMA)).collect() == []


def test_large_components_stay_exact():
    a, b = np.array([[2.0**40, 3.0, 1.0]]), np.array([[2.0**40, 5.0, 7.0], [1.0, 2.0**45, 2.0]])
    assert list(K.inner(a, b)[0]) == [2**80 + 22, 2**40 + 3 * 2**45 + 2]
