import functools
import random

import numpy as np
import pytest
from helpers import odd_docs, odd_frame, prose

from riskframe.llm import pieces as P


def fields(raw):
    """(number, bytes of the field, bytes of its value) of a protobuf message."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte, at = raw[at], at + 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        start, key = at, varint()
        if key & 7 == 2:
            size = varint()
            value, at = raw[at : at + size], at + size
        else:
            value = None
            at = at + {1: 8, 5: 4}[key & 7] if key & 7 else (varint(), at)[1]
        yield key >> 3, raw[start:at], value


def varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


@pytest.fixture(scope="module")
def library():
    """The library over the same pieces, marked as a unigram model (trainer_spec.model_type = 1)."""
    import sentencepiece

    out = b""
    with open(P.model_path(), "rb") as f:
        for number, whole, value in fields(f.read()):
            if number == 2:
                body = b"".join(w for n, w, _ in fields(value) if n != 3) + varint(3 << 3) + varint(1)
                whole = varint(2 << 3 | 2) + varint(len(body)) + body
            out += whole
    return sentencepiece.SentencePieceProcessor(model_proto=out)


def texts():
    rng = random.Random(8)
    return ["", "Hello world", "a  b   c", " lead", "tail ", "naïve café ñandú", "日本語 text", "one\ntwo\tthree", "x" * 90, prose(rng, 200)]


def test_sums_equal_the_library(library):
    v = P.vocabulary(P.model_path())
    score = lambda ids: sum(library.get_score(i) for i in ids if not library.is_byte(i))
    for word in sorted({w for t in texts() for w in t.split()}, key=len)[:300]:
        # The library's fast path is not always its best one; its n-best search is exact.
        assert score(v.encode(word)) == pytest.approx(score(library.nbest_encode_as_ids(word, 2)[0]), abs=0.5)


def brute(v, text):
    best = [0] + [None] * len(text)
    for end in range(1, len(text) + 1):
        best[end] = max(best[end - n] + w for n, w in v.edges(text, end))
    return best[-1]


@pytest.mark.parametrize("chunk", [16, 23, 100])
def test_chunks_give_the_same_pieces(chunk):
    v = P.vocabulary(P.model_path())
    for text in [*(t.replace("▁", "_") for t in texts()), "ab" * 70 + "▁" + "é" * 40, " " * 50]:
        line = P.marked(text)
        if not line:
            continue
        cut = [(line[i : i + chunk + v.longest - 1], min(chunk, len(line) - i)) for i in range(0, len(line), chunk)]
        states = P.states_between([v.matrix(*c) for c in cut], 0, 0)
        ids = [i for c, a, z in zip(cut, states, states[1:]) for i in v.trace(*c, a, z)]
        weight = lambda x: sum(v.table[v.pieces[i]][1] for i in x if v.pieces[i] in v.table)
        assert v.decode(ids) == text == v.decode(v.encode(text))
        assert weight(ids) == weight(v.encode(text)) and ids == v.encode(text)
        assert sum(v.path(w)[1] for w in P.words_of(line)) == brute(v, line)


def test_product_is_associative():
    v = P.vocabulary(P.model_path())
    line = P.marked(texts()[-1])
    a, b, c = (v.matrix(line[i : i + 20 + v.longest - 1], 20) for i in (0, 20, 40))
    assert (P.times(P.times(a, b), c) == P.times(a, P.times(b, c))).all()
    run = P.marked("a" * 200)
    a, b, c = (v.matrix(run[i : i + 20 + v.longest - 1], 20) for i in (20, 40, 60))
    assert (P.times(P.times(a, b), c) == P.times(a, P.times(b, c))).all()
    whole = v.matrix(run[20 : 80 + v.longest - 1], 60)
    assert (P.times(P.times(a, b), c) == whole).all()


@pytest.mark.parametrize("chunk", [16, 17, 29, 64, 100])
def test_ties_do_not_depend_on_the_cuts(chunk):
    v, rng = P.vocabulary(P.model_path()), random.Random(chunk)
    ties = ["a" * 700, "ab" * 300, "aab" * 150 + " " + "-" * 333, "=" * 400, "0" * 257 + "1" + "0" * 90, "x " * 60 + "z" * 150]
    ties += ["".join(rng.choice("aae") for _ in range(rng.randint(100, 400))) for _ in range(10)]
    for text in ties:
        line = P.marked(text)
        cut = [(line[i : i + chunk + v.longest - 1], min(chunk, len(line) - i)) for i in range(0, len(line), chunk)]
        matrices = [v.matrix(*c) for c in cut]
        states = P.states_between(matrices, 0, 0)
        assert [i for c, a, z in zip(cut, states, states[1:]) for i in v.trace(*c, a, z)] == v.encode(text)
        # The same states by blocks of three.
        blocks = [functools.reduce(P.times, matrices[i : i + 3]) for i in range(0, len(matrices), 3)]
        assert P.states_between(blocks, 0, 0) == [*states[:-1:3], states[-1]]


@pytest.mark.parametrize("chunk,block", [(1 << 14, 256), (64, 3)])
def test_round_trip_in_spark(spark, monkeypatch, chunk, block):
    monkeypatch.setattr(P, "BLOCK", block)
    docs = odd_frame(spark).withColumnRenamed("kept", "pieces")
    coded = P.encode(docs, chunk=chunk)
    assert coded.columns == [c for c in docs.columns if c != "pieces"] + ["pieces"]
    rows = P.decode(coded).collect()
    assert len(rows) == len(odd_docs())
    v = P.vocabulary(P.model_path())
    for r in rows:
        assert r.decoded == (r.text or "") and r.pieces == v.encode(r.text or "")
    assert P.encode(docs.limit(0)).collect() == []


def test_small_chunks_are_refused(spark):
    with pytest.raises(ValueError):
        P.encode_long(spark.createDataFrame([], "doc_id long, dig long, text string"), P.model_path(), 5)


def test_words_together_and_one_by_one():
    v = P.Vocabulary(P.model_path())
    words = sorted({w for t in texts() for w in P.words_of(P.marked(t))}) + ["▁" * 20, "x", "\ue000a", "▁日本", "a" * 40, "▁"]
    found, sums = v.solve(words)
    for w, raw, total in zip(words, found, sums):
        ids, best = v.path(w)
        assert best == total and np.frombuffer(raw, np.int32).tolist() == ids
    assert v.solve([])[0] == []
