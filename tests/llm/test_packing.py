import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from helpers import odd_docs, odd_frame
from tokenizers import Tokenizer

from riskframe.llm import packing as K


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(K.tokenizer_path("word_bpe_49k.json"))


def held(library, docs, rows, window):
    """Checks that the pieces are the documents' ids, each once, in gapless sequences; returns (padding, ids)."""
    want = defaultdict(list)
    for doc_id, text in docs:
        want[doc_id].append([*library.encode(text or "", add_special_tokens=False).ids, K.END])
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
        assert r.ids_crc32 == zlib.crc32(r.ids) and len(r.ids) == 4 * r.length > 0
    assert set(by_doc) == set(want)
    for doc_id, texts in want.items():
        found = sorted((r.start, bytes(r.ids), r.doc_tokens) for r in by_doc[doc_id])
        total = sorted(len(t) for t in texts)
        assert sum(len(i) // 4 for _, i, _ in found) == sum(total) and {n for *_, n in found} == set(total)
        if len(texts) == 1:
            at = 0
            for start, ids, _ in found:
                assert start == at and np.frombuffer(ids, "<u4").tolist() == texts[0][at : at + len(ids) // 4]
                at += len(ids) // 4
        else:
            spans = {np.array(t[s : s + len(i) // 4], "<u4").tobytes() for t in texts for s, i, _ in found}
            assert {i for _, i, _ in found} <= spans
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding, sum(sum(map(len, t)) for t in want.values())


@pytest.mark.parametrize("window", [4096, 256, 16])
def test_odd_documents(spark, library, window):
    docs = [(r[0], r[1]) for r in odd_docs()]
    rows = K.pack(odd_frame(spark).repartition(3, "text"), window=window).collect()
    padding, _ = held(library, docs, rows, window)
    assert padding == 0


def test_empty_and_very_long(spark, library):
    assert K.pack(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    docs = [(1, "lorem ipsum dolor " * 60_000), (2, "x" * 30_000), (3, None), (4, "á — 日本 " * 5000)]
    rows = K.pack(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert held(library, docs, rows, K.WINDOW)[0] == 0


def test_parts_are_the_library(library):
    rng = random.Random(4)
    latin = [chr(i) for i in range(K.LATIN)]
    texts = ["".join(rng.choice(latin) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    texts += ["".join(rng.choice("abZ'sdl 1.,-\"<|>İ̇é́Σ \x1c") for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    texts += [f(c) for c in latin for f in (str, lambda x: "a" + x + "b", lambda x: x + "1", lambda x: "." + x + "!")]
    texts += ["a<|endoftext|>b", "<|ENDOFTEXT|>", "x <|startoftext|>y", "don't we'll 'S"]
    coded = K.Encoder(K.tokenizer_path("word_bpe_49k.json"))(texts)
    assert [c.tolist() for c in coded] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_remembered_parts_are_bounded(library, monkeypatch):
    monkeypatch.setattr(K, "KEPT", 10)
    rng = random.Random(9)
    encode = K.Encoder(K.tokenizer_path("word_bpe_49k.json"))
    for _ in range(20):
        texts = [" ".join("".join(rng.choice("abcdef") for _ in range(4)) for _ in range(8)) for _ in range(3)]
        assert [c.tolist() for c in encode(texts)] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        assert len(encode.place) <= 10 + 24


def slow_least_squares(ways, counts, rounds):
    """The same problem with a dense matrix, by projected gradient from zero."""
    a = np.zeros((len(counts), len(ways)))
    for j, (times, *lengths) in enumerate(ways):
        a[lengths[0], j] += times
        for v in lengths[1:]:
            if v:
                a[v, j] += 1
    w = np.where(counts > 0, 1 / np.maximum(counts, 1), 0)
    x, step = np.zeros(len(ways)), 1 / np.linalg.norm(a.T @ (w[:, None] * a), 2)
    for _ in range(rounds):
        x = np.maximum(0, x - step * (a.T @ (w * (a @ x - counts))))
    return a, w, x


def test_least_squares_is_near_the_optimum():
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 60, 65)
    counts[0] = counts[64] = 0
    ways = K.combinations(counts, 64)
    assert (ways[:, 0] * ways[:, 1] + ways[:, 2] + ways[:, 3] == 64).all()
    a, w, best = slow_least_squares(ways, counts, 20_000)
    cost = lambda x: (w * (a @ x - counts) ** 2).sum()
    x = K.least_squares(ways, counts, 400)
    assert (x >= 0).all() and cost(x) <= cost(best) + 0.02 * cost(np.zeros(len(x)))


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_length_once(seed):
    rng = np.random.default_rng(seed)
    counts = np.zeros(K.WINDOW + 1, np.int64)
    many = [3, 50, 400, 4000, 4095, 1][seed]
    counts[rng.integers(1, K.WINDOW, many)] = rng.integers(1, [3, 40, 10_000, 20, 2, 10**9][seed], many)
    plan = K.Plan(counts)
    total = int((np.arange(len(counts)) * counts).sum())
    assert sum(count * length for _, _, count, _, length, *_ in plan.rows) == total
    # Windows but for the last, which is cut into powers of two: no padding at all.
    assert total // K.WINDOW <= plan.sequences <= total // K.WINDOW + 12
    keys, edges, pieces = plan.segments()
    for i in range(len(keys)):
        rest = keys[i] // K.RANKS
        own = pieces[edges[i] : edges[i + 1]]
        if len(own):
            assert own[0, 0] == 0 and (own[1:, 0] == own[:-1, 0] + own[:-1, 1]).all() and own[-1, :2].sum() == rest


def test_most_documents_stay_whole():
    rng = np.random.default_rng(0)
    lengths = np.minimum(rng.lognormal(6.4, 1, 50_000).astype(int) + 1, 30_000) % K.WINDOW
    plan = K.Plan(np.bincount(lengths[lengths > 0], minlength=K.WINDOW + 1))
    # Combinations of the least-squares solution fill most sequences.
    assert plan.whole > 0.7 * plan.sequences
    keys, edges, _ = plan.segments()
    ranks = np.append(keys[1:], keys[-1]) - keys
    cut = ranks[(edges[1:] - edges[:-1] > 1)].sum()
    assert cut < 0.02 * len(lengths)
