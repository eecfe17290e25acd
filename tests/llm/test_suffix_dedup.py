import random
from collections import Counter

import numpy as np
import pytest
from helpers import odd_docs, odd_frame, ordered, prose, rows_of

from riskframe.llm import suffix_dedup as X


def plain(rows, length=400):
    held = Counter()
    raw = [(i, (t or "").encode()) for i, t in rows]
    for _, b in raw:
        held.update(b[p : p + length] for p in range(len(b) - length + 1))
    out = []
    for i, b in raw:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if held[b[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        kept = bytes(c for c, g in zip(b, gone) if not g)
        runs = sum(1 for j, g in enumerate(gone) if g and (not j or not gone[j - 1]))
        out.append((i, bytearray(kept), len(b), sum(gone), runs))
    return out


def cases():
    rng = random.Random(12)
    shared = [prose(rng, n)[: 380 + 10 * i] for i, n in enumerate([90] * 8)]
    rows = [(i, prose(rng, 40) + "|" + shared[i % 8] + "|" + prose(rng, 40)) for i in range(24)]
    own = prose(rng, 400)
    rows += [(50, own + " x " + own), (51, "ab" * 900), (52, "z" * 399), (53, "z" * 401), (54, own[:500] + "é" + own[500:]), (55, own[7:1200])]
    edited = list(prose(rng, 500))
    for at in range(150, len(edited), 457):
        edited[at] = "Ü"
    base = "".join(edited)
    return rows + [(60 + i, base[:at] + "#" + base[at:]) for i, at in enumerate(range(100, 2000, 333))]


@pytest.mark.parametrize("batches,held,stretch", [(3, 1 << 16, 1 << 22), (1, 1, 1 << 22), (4, 1 << 16, 2048)])
def test_matches_brute_force(spark, monkeypatch, batches, held, stretch):
    if stretch != X.STRETCH:
        # Powers are made for the full stretch; only the cutting of texts is smaller.
        monkeypatch.setattr(X, "CUT", stretch, raising=False)
    rows = [(r[0], r[1]) for r in odd_docs()] + cases()
    docs = spark.createDataFrame([(i, t, *[None] * 10) for i, t in rows], odd_frame(spark).schema)
    got = X.dedup(docs, batches, held)
    assert got.select("row.*").columns == docs.columns
    found = got.select("row.doc_id", "kept", "n_bytes", "n_removed", "n_spans")
    want = plain(rows)
    assert sum(w[3] for w in want) > 10_000
    assert rows_of(found, "doc_id", "kept", "n_bytes", "n_removed", "n_spans") == ordered(want)


def test_every_run_has_an_anchor_in_step():
    rng = np.random.default_rng(3)
    text = rng.integers(97, 101, 5000, dtype=np.uint8).tobytes()
    pos, beginning, _ = X.anchors(text)
    assert np.diff(pos).max() <= X._REACH + 1
    shifted, other, _ = X.anchors(b"some other start" * 9 + text)
    inside = {(int(p) - 144, int(b)) for p, b in zip(shifted, other)}
    assert {(int(p), int(b)) for p, b in zip(pos, beginning) if X._REACH < p} <= inside


def test_family_merges_geometrically(spark):
    family = X.Family()
    for i in range(7):
        family.add(spark.createDataFrame([(i, i, 1, (i, i, i))], "beginning long, context long, n long, at struct<id:long,dig:long,pos:int>"))
    assert sorted(family.levels) == [0, 1, 2]
    assert sorted(level.count() for level in family.levels.values()) == [1, 2, 4]


def test_empty_table(spark):
    assert X.dedup(odd_frame(spark).limit(0)).collect() == []


def test_contexts_compared_at_once_are_few(monkeypatch):
    assert X.HELD <= X.AT_ONCE
    sizes = []
    monkeypatch.setattr(X, "run_hashes", lambda lefts, raws: (sizes.append(len(raws)), np.zeros((len(raws), X._REACH + 1), np.uint64))[1])
    n = 10_000
    rows = X.batch(beginning=[i // 2000 for i in range(n)], n=[1] * n, kinds=[2000] * n, id=list(range(n)), dig=[0] * n, pos=[0] * n, left=[0] * n, bytes=[b"x"] * n)
    assert sum(b.num_rows for b in X.compared(iter([rows]))) == 0
    assert sum(sizes) == n and max(sizes) < X.HELD + X.AT_ONCE
