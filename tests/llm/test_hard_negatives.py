import math
import random

import numpy as np
import pytest
from helpers import ordered, rows_of

from riskframe.llm import hard_negatives as H

SCHEMA = "vec_id long, label int, embedding array<float>, part int, block int, rank int"
COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def table(n=300, dim=12, seed=3, labels=4):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.4) for _ in range(dim)] for _ in range(3)]
    rows = [(i, 1 if rng.random() < 0.4 else rng.randrange(labels), [c + rng.gauss(0, 0.4) for c in rng.choice(centres)]) for i in range(n)]
    rows += [(2000 + i, rng.randrange(labels), list(rows[10][2])) for i in range(20)]  # ties
    rows += [(50, None, [0.1] * dim), (60, 1, None), (70, 1, [0.1, None] + [0.0] * (dim - 2)), (80, 1, [float("nan")] * dim), (90, 2, [float("-inf")] * dim)]
    rows += [(None, 1, [0.5] * dim), (4000, 1, [0.5, 0.25]), (4010, 2, [0.5, 0.25]), (4020, 1, [0.25, 0.25]), (4030, 1, []), (5000, 3, [0.0] * dim)]
    return [(*r, 1, 2, 3) for r in rows + [rows[20], rows[20], rows[33]]]


def brute(rows, every):
    whole = []
    for r in rows:
        if r[0] is not None and r[1] is not None and r[2] is not None and all(x is not None and math.isfinite(x) for x in r[2]):
            whole.append((r[0], r[1], tuple(math.floor(256 * float(np.float32(x))) for x in r[2])))
    out = []
    for a, label, av in sorted({w for w in whole if w[0] % every == 0}):
        scored = [(-sum(x * y for x, y in zip(av, v)), i, lab) for i, lab, v in whole if i != a and len(v) == len(av)]
        for s, p, _ in sorted((s, i, lab) for s, i, lab in scored if lab == label)[:5]:
            near = sorted((t, i) for t, i, lab in scored if lab != label and 30 * -s <= 100 * -t <= 90 * -s)[:10]
            out += [(a, p, n + 1, i, -s, -t) for n, (t, i) in enumerate(near)]
    return ordered(out)


@pytest.mark.parametrize("sizes", [(4096, 8192, 2048), (16, 40, 7)])
def test_matches_brute_force(spark, monkeypatch, sizes):
    for name, size in zip(("BLOCK", "BAND", "GROUP"), sizes):
        monkeypatch.setattr(H, name, size)
    rows = table()
    got = H.mine(spark.createDataFrame(rows, SCHEMA).repartition(3), every=10)
    assert got.columns == list(COLUMNS)
    assert rows_of(got, *COLUMNS) == brute(rows, 10)


def test_hot_label(spark):
    rows = [(i, 0 if i % 3 else i % 5, r[2], 1, 2, 3) for i, r in enumerate(table(900, 8, 5))]
    got = H.mine(spark.createDataFrame(rows, SCHEMA), every=25)
    assert rows_of(got, *COLUMNS) == brute(rows, 25)


def test_large_components(spark):
    rng = random.Random(1)
    rows = [(i, i % 2, [rng.choice([1e5, 1e6, -2e6, 1.0]) * rng.random() for _ in range(4)], 1, 1, 1) for i in range(60)]
    rows += [(100 + i, i % 2, [2e14 * rng.random(), 1e13], 1, 1, 1) for i in range(20)]
    rows += [(r[0] + 500, *r[1:]) for r in rows]
    got = H.mine(spark.createDataFrame(rows, SCHEMA), every=10)
    limit = (1 << 63) - 1
    want = [r for r in brute(rows, 10) if max(map(abs, r[4:])) < limit]
    assert [r for r in rows_of(got, *COLUMNS) if max(map(abs, r[4:])) < limit] == want and want


def test_empty_and_moved_labels(spark):
    assert H.mine(spark.createDataFrame([], SCHEMA)).collect() == []
    df = spark.createDataFrame([(7, 9, None, 0, 0, 0), (8, 9, None, 0, 0, 0), (14, 3, None, 0, 0, 0), (21, None, None, 0, 0, 0)], SCHEMA)
    assert [r[0] for r in df.select(H.moved_label()).collect()] == [0, 9, 4, None]


def test_bounds_rule_out():
    """Share of components read when clustered rows are scanned for a window that few reach."""
    rng = np.random.default_rng(0)
    centres = rng.normal(0, 40, (10, 64))
    rows = np.floor(centres[rng.integers(0, 10, 4000)] + rng.normal(0, 12, (4000, 64)))
    block = H.Block(np.arange(4000), np.zeros(4000, np.int64), np.ascontiguousarray(rows.T))
    read, whole = [], 0
    for q in rows[:40]:
        exact = rows @ q
        floor = np.sort(exact)[-50]
        at, scores = H.scan(q, block, (0, 4000), floor, np.inf, read)
        assert sorted(at) == np.flatnonzero(exact >= floor).tolist() and (exact[at] == scores).all()
        whole += rows.size
    share = sum(read) / whole
    print(f"components read: {share:.2f}")
    assert share < 0.7
