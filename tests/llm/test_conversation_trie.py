import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from riskframe.llm import conversation_trie as C

SCHEMA = "conv_id long, turn int, role string, text string, path string, key string, n int, run long"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute(rows):
    """The trie by plain dictionaries of prefixes."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [(r, t) for *_, r, t in sorted(ts)] for c, ts in turns.items()}
    whole = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        whole[c] = tuple(turns.get(base, [])[:h] + turns[c][h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, t in whole.items():
        ends[t].append(c)
        for d in range(len(t) + 1):
            members[t[:d]].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[c] for c in children[p]) or 1
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        saved[p] = (len(members[p]) - 1) * words + sum(saved[c] for c in children[p])
    return sorted(
        (
            (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p],
             hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest())
            for p, m in members.items()
        ),
        key=lambda r: r[:2],
    )


def conversations(seed, count, deep=12):
    """Families that share openings, copies, a common first turn, deep ones, ties, nulls and repeated rows."""
    rng = random.Random(seed)
    text = lambda: rng.choice([None, "", " ", "hi", "a b c", "so  it\tgoes", "é ü"]) if rng.random() < 0.7 else f"w{rng.randint(0, 40)} x"
    rows = []
    common = [(rng.choice(["user", "assistant", None]), text()) for _ in range(deep * 4)]
    for c in rng.sample(range(-60, 10 * count), count):
        kind = rng.random()
        if kind < 0.3:
            own = common[: rng.randint(0, 6)]
        elif kind < 0.5:
            own = common[: rng.randint(1, len(common))] + [("user", text()) for _ in range(rng.randint(0, 3))]
        else:
            own = [(rng.choice(["user", "assistant"]), text()) for _ in range(rng.randint(1, deep))]
        rows += [(c, i if rng.random() < 0.95 else rng.choice([None, i - 1]), r, t) for i, (r, t) in enumerate(own)]
    rows += rng.sample(rows, 5) + [(None, 0, "user", "nobody"), (7, None, None, None)]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "p", "k", 1, 2) for r in rows], SCHEMA)


def got(df):
    assert df.columns == list(COLUMNS)
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[:2])


@pytest.mark.parametrize("seed", range(3))
def test_trie(spark, seed):
    rows = conversations(seed, 150)
    assert got(C.trie(frame(spark, rows))) == brute(rows)


def test_small_runs_and_many_rounds(spark, monkeypatch):
    rows = conversations(11, 300)
    monkeypatch.setattr(C, "FAN", 3)
    assert got(C.trie(frame(spark, rows))) == brute(rows)


def test_peel_in_pieces():
    """Spines of any cut of the sorted chains close to the same nodes as one peel."""
    rng = random.Random(2)
    paths = sorted({tuple(rng.choice("ab") for _ in range(rng.randint(0, 7))) for _ in range(60)})

    def key(path):
        k, out = b"", b""
        for t in path:
            k = hashlib.blake2b(k + t.encode(), digest_size=C.KEY).digest()
            out += k
        return out

    chains = sorted((key(p), len(p), i) for i, p in enumerate(paths))
    closed = lambda nodes: sorted(
        (int(c), int(d), int(n), int(k), int(v), int(s), e) for x in nodes for c, d, n, k, v, s, e in zip(x["conv_id"], x["depth"], x["n_convs"], x["n_children"], x["n_leaves"], x["saved_tokens"], x["ends"])
    )

    def load(part):
        held = C.Chains()
        for path, size, i in part:
            held.add(path, [3] * size, 2, i, f"digest {i}")
        return held

    want = closed(C.peel(load(chains), False)[0])
    for _ in range(50):
        cuts = sorted(rng.sample(range(1, len(chains)), rng.randint(1, 12)))
        parts = [chains[a:b] for a, b in zip([0, *cuts], [*cuts, len(chains)])]
        nodes, spines = [], []
        for part in parts:
            done, left = C.peel(load(part), True)
            nodes += done
            spines += left
        while len(spines) > 5:
            again = []
            for a in range(0, len(spines), 5):
                held = C.Chains()
                for s in spines[a : a + 5]:
                    held.add_spine(s)
                done, left = C.peel(held, True)
                nodes += done
                again += left
            if len(again) == len(spines):
                break
            spines = again
        held = C.Chains()
        for s in spines:
            held.add_spine(s)
        nodes += C.peel(held, False)[0]
        assert closed(nodes) == want


def test_hot_conversation_and_first_turn(spark):
    """More copies of one conversation than a task holds ids of, over several runs."""
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 20 * 14_000, 20) for t in range(2)]
    rows += [(c, t, "user", "turn 0" if t == 0 else f"own {c}") for c in range(1_000_000, 1_004_000, 20) for t in range(3)]
    assert got(C.trie(frame(spark, rows))) == brute(rows)


def test_deep_and_very_long(spark):
    rows = [(40, t, "user", f"t{t}") for t in range(700)] + [(41, t, "user", f"t{t}") for t in range(650)] + [(60, 0, "user", "word " * 500_000)]
    assert got(C.trie(frame(spark, rows))) == brute(rows)


def test_empty(spark):
    assert C.trie(frame(spark, [])).collect() == []
    assert C.trie(frame(spark, [(None, 1, "user", "x")])).collect() == []
