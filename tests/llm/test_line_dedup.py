from collections import Counter

import numpy as np
import pytest
from helpers import odd_docs, odd_frame, ordered, rows_of

from riskframe.llm import line_dedup as L
from riskframe.llm import perfect_hash

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(UPPER)
    held, newest = Counter(), {}
    for doc_id, text in rows:
        for k in {key(x) for x in (text or "").split("\n")}:
            if len(k) >= 40:
                held[k] += 1
                if doc_id is not None:
                    newest[k] = max(newest.get(k, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        gone = [held[key(x)] >= 5 and key(x) in newest and newest[key(x)] != doc_id for x in lines]
        out.append((doc_id, "\n".join(x for x, g in zip(lines, gone) if not g), len(lines), sum(gone)))
    return out


@pytest.mark.parametrize("shard,lane", [(1 << 16, 200_000), (2, 3)])
def test_matches_plain_python(spark, monkeypatch, shard, lane):
    monkeypatch.setattr(L, "SHARD", shard)
    monkeypatch.setattr(L, "LANE", lane)
    more = [(500 + i, f"line {j} " + "é" * (30 + j), "en", "a", *[None] * 8) for i in range(6) for j in (1, 4, 9)]
    long = [(700, "\n".join(f"  Line {j} " + "é" * (30 + j) for j in range(12)), "en", "a", *[None] * 8)] * 2
    rows = [*odd_docs(), *more, *long]
    docs = spark.createDataFrame(rows, odd_frame(spark).schema)
    got = L.dedup(docs)
    assert [c for c in got.select("row.*").columns] == docs.columns
    found = got.selectExpr("row.doc_id", "coalesce(kept, '') as kept", "n_lines", "n_dropped")
    want = plain([(r[0], r[1]) for r in rows])
    assert any(w[3] for w in want)
    assert rows_of(found, "doc_id", "kept", "n_lines", "n_dropped") == ordered(want)


def test_empty_table_and_nameless_holders(spark):
    docs = odd_frame(spark)
    assert L.dedup(docs.limit(0)).collect() == []
    line = "a line of more than forty characters, held by rows without an id"
    nameless = spark.createDataFrame([(None, line)] * 6, "doc_id long, text string")
    assert [r.n_dropped for r in L.dedup(nameless).collect()] == [0] * 6


def test_copies_spread_over_lanes(spark):
    text = "a line of more than forty characters that many documents hold"
    copies = spark.createDataFrame([*((i, text) for i in range(4000)), *[(None, text)] * 4000], "doc_id long, text string")
    taken = [r["count"] for r in L.asks_of(copies, 40, [8]).groupBy("shard", "lane").count().collect()]
    assert len(taken) == 8 and max(taken) < 1000
    assert sum(taken) < 4100


def test_perfect_hash_is_minimal():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 5000, dtype=np.uint64))
    sizes, bits = perfect_hash.build(keys)
    assert sorted(perfect_hash.slots(keys, sizes, bits)) == list(range(len(keys)))
    assert len(perfect_hash.slots(keys[:0], *perfect_hash.build(keys[:0]))) == 0
