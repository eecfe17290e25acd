import numpy as np
import xxhash
from helpers import odd_docs, odd_frame, ordered, rows_of

from riskframe.llm import simhash as S
from riskframe.llm.components import components


def plain_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints, most=3):
    """Component number of every fingerprint."""
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= most:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def test_components_match_plain_python(spark):
    rows = odd_docs()
    base = rows[25][1]
    near = [(300 + i, base + " " + "tail" * i, "en", "a", *[None] * 8) for i in range(6)]
    docs = spark.createDataFrame([*rows, *near], odd_frame(spark).schema)
    prints = [plain_print(r[1]) for r in [*rows, *near]]
    of = groups(prints)
    ids = {}
    for r, g in zip([*rows, *near], of):
        if r[0] is not None:
            ids[g] = min(ids.get(g, r[0]), r[0])
    want = ordered((r[0], p - (1 << 64) if p >> 63 else p, ids.get(g)) for r, p, g in zip([*rows, *near], prints, of))
    got = S.component_ids(docs)
    assert rows_of(got, "doc_id", "fp", "component_id") == want
    kept = S.dedup(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(ids.values())


def test_links_of_close_fingerprints_in_small_and_large_buckets(spark, monkeypatch):
    rng = np.random.default_rng(3)
    seeds = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    prints = {int(s) for s in seeds}
    for s in seeds[:12]:
        at = s
        for _ in range(12):  # a chain: each differs from the one before in up to 3 bits
            for b in rng.choice(64, rng.integers(1, 4), replace=False):
                at ^= np.uint64(1) << np.uint64(b)
            prints.add(int(at))
    prints |= {int(seeds[20]) ^ (1 << i) for i in range(40)} | {int(seeds[21]) ^ (1 << i) ^ (1 << 50) for i in range(30)}
    prints = sorted(prints)
    of = groups(prints)
    want = {frozenset(p for p, g in zip(prints, of) if g == k) for k in set(of)}
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    frame = spark.createDataFrame(signed, "fp long")
    for limit in (2048, 4):
        monkeypatch.setattr(S, "BUCKET", limit)
        found = {}
        for r in components(S.links(frame)).collect():
            found.setdefault(r.root, set()).add(r.node % (1 << 64))
        linked = {frozenset(g) for g in found.values()}
        assert linked == {g for g in want if len(g) > 1}


def test_long_chain_and_empty_links(spark):
    chain = spark.range(1, 400).selectExpr("id as a", "id - 1 as b")
    assert {r.root for r in components(chain).collect()} == {0}
    assert components(chain.limit(0)).collect() == []
    assert S.component_ids(odd_frame(spark).limit(0)).collect() == []
