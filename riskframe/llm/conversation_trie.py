"""Prefix trie of conversations by truncation peeling.

A conversation is written as its chain of prefix keys, 16 bytes a turn: key d digests key d-1 and
turn d, so a key names a node of the trie and equal prefixes have equal beginnings. Sorted by chain,
the members of any node stand together.

A run of sorted chains is peeled from its maximum depth: at each depth the chains that end there join
the nodes that survive from below, all are regrouped by their key of that depth, and their last turn
is stripped. A node's members, children, leaves and saved tokens are sums over what reaches it, taken
in that one descent. Nodes at the run's two edges may go on in the neighbouring runs. They stay open:
each run leaves its first and last chain with the partial sums along them (a spine). Spines are chains
like any other, so they are peeled in the same way in fewer runs, until one run of at most FAN spines
closes the rest.

Runs are the partitions of a range partitioning by (chain, conv_id), read as a sorted stream of which
ROWS chains or TURNS turns are held at a time; neither a common beginning nor any number of equal
conversations gathers in a task. The ids that end at a node are digested as they stream by. Where
the node may straddle runs, or has more than IDS of them, they are written as texts of at most IDS
numbers and digested in order by key.

Only digests and word counts of turns move after the one shuffle of texts; a single conversation's
(24 bytes a turn) must fit a task.

Defined cases. Rows with a null conv_id belong to no conversation. Null roles and texts are empty;
a null turn comes first. Turns of equal number are ordered by role, then text; a repeated row is a
turn of its own. A conversation whose rebuilt form has no turn is a member of the root that ends
there. Texts count whole, however long. An empty table has no trie: an empty result. Only
``conv_id``, ``turn``, ``role`` and ``text`` are read; other columns may have any name.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskframe.llm.common import WORD, batch
from riskframe.sources.scratch import materialize

#: Chains, turns, and ids of one chain that are held at a time; spines that one task closes.
ROWS, TURNS, IDS, FAN = 20_000, 1_000_000, 4096, 4096
#: Conversations of so many ids share the opening of the first; the opening's length is a digest of the id modulo OPENINGS.
FAMILY, OPENINGS = 20, 4
KEY = 16
NONE = hashlib.sha256(b"").hexdigest()
_MAX = np.iinfo(np.int64).max
#: What a spine holds at each depth: members, smallest member, children, leaves and saved tokens so far, words of the turn.
SUMS = ("n", "least", "kids", "leaves", "saved")
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends string, key binary, parent_key binary"
SPINE = "path binary, n array<long>, least array<long>, kids array<long>, leaves array<long>, saved array<long>, words array<long>, ended array<string>"
OUT = f"kind string, run long, {NODE}, {SPINE}, first long, ids string"
FIELDS = [f.strip().split(" ") for f in OUT.split(",")]
TYPES = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}


class Chains:
    """Sorted chains with their partial sums; entry ``offset[i] + d`` of the flat arrays is depth d of chain i."""

    def __init__(self):
        self.paths: list[bytes] = []
        self.parts: dict[str, list[np.ndarray]] = {c: [] for c in (*SUMS, "words", "end")}
        #: Digests by number; an ``end`` of 0 is none, of -1 one that is made from written ids.
        self.digests: list[str] = [NONE]
        self.turns = 0

    def add(self, path: bytes, words: np.ndarray, n: int, least: int, digest: str | None) -> None:
        """A chain of ``n`` conversations that end at its last key; no digest: their ids are written."""
        size = len(path) // KEY + 1
        for c in self.parts:
            self.parts[c].append(np.zeros(size, np.int64))
        last = {c: p[-1] for c, p in self.parts.items()}
        last["least"][:] = _MAX
        last["n"][-1], last["least"][-1], last["words"][1:] = n, least, words
        last["end"][-1] = -1 if digest is None else len(self.digests)
        if digest is not None:
            self.digests.append(digest)
        self.paths.append(path)
        self.turns += size

    def add_spine(self, row: dict) -> None:
        for c in (*SUMS, "words"):
            self.parts[c].append(np.array(row[c], np.int64))
        end = np.zeros(len(row["ended"]), np.int64)
        for d, digest in enumerate(row["ended"]):
            if digest == "":
                end[d] = -1
            elif digest is not None:
                end[d] = len(self.digests)
                self.digests.append(digest)
        self.parts["end"].append(end)
        self.paths.append(row["path"])
        self.turns += len(end)

    def ended(self, ends: np.ndarray) -> list[str | None]:
        return [None if e == 0 else "" if e < 0 else self.digests[e] for e in ends.tolist()]


def key_of(path: bytes, depth: int) -> bytes:
    return path[KEY * (depth - 1) : KEY * depth] if depth else b""


def peel(chains: Chains, open_: bool) -> tuple[list[dict], list[dict]]:
    """(closed nodes, spines): with ``open_``, the nodes along the first and last chain stay open."""
    depth = np.array([len(p) // KEY for p in chains.paths])
    rows = len(depth)
    offset = np.concatenate([[0], np.cumsum(depth + 1)])[:-1]
    flat = {c: np.concatenate(p) for c, p in chains.parts.items()}
    keys = np.frombuffer(b"".join(b"\0" * KEY + p for p in chains.paths), np.uint64).reshape(-1, 2)
    ends_open = [0, rows - 1] if open_ else []
    spines = [{c: flat[c][offset[i] : offset[i] + depth[i] + 1].copy() for c in flat} for i in ends_open]
    nodes: list[dict] = []
    #: Of the nodes of the depth below: first chain, closed, and their sums.
    below: dict[str, np.ndarray] = {}
    for d in range(int(depth.max()), -1, -1):
        at = np.flatnonzero(depth >= d)
        entry = offset[at] + d
        key = keys[entry]
        starts = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1)])) if d else np.array([0])
        own = {c: np.add.reduceat(flat[c][entry], starts) for c in SUMS if c != "least"}
        own["least"] = np.minimum.reduceat(flat["least"][entry], starts)
        ended, written = np.maximum.reduceat(flat["end"][entry], starts), np.minimum.reduceat(flat["end"][entry], starts)
        ended = np.where(written < 0, -1, ended)
        words = flat["words"][entry[starts]]
        first = at[starts]
        closed = np.ones(len(first), bool)
        groups = [int(np.searchsorted(first, i, "right")) - 1 if depth[i] >= d else -1 for i in ends_open]
        for g in groups:
            if g >= 0:
                closed[g] = False
        if below:
            up = np.searchsorted(first, below["first"], "right") - 1
            # An open child is counted where it is closed; its sums stay on its spine.
            counted = below["closed"]
            own["kids"] += np.bincount(up[counted], minlength=len(first))
            for c in ("n", "leaves", "saved"):
                np.add.at(own[c], up[counted], below[c][counted])
            np.minimum.at(own["least"], up, below["least"])
            if counted.any():
                parent = up[counted]
                known = closed[parent]
                node = {k: v[counted] for k, v in below.items() if k not in ("closed", "first")}
                node["parent"] = np.where(known, own["least"][parent], 0)
                node["run"], node["known"], node["depth"] = below["first"][counted], known, d + 1
                nodes.append(node)
        for s, i in enumerate(ends_open):
            g = groups[s]
            if g < 0:
                continue
            shared = s == 1 and groups[0] == g
            for c in SUMS:
                spines[s][c][d] = (_MAX if c == "least" else 0) if shared else own[c][g]
            spines[s]["end"][d] = 0 if shared else ended[g]
        own["leaves"] = np.where(closed & (own["kids"] == 0), 1, own["leaves"])
        own["saved"] = own["saved"] + np.where(closed, (own["n"] - 1) * words, 0)
        below = own | {"first": first, "closed": closed, "end": ended}
    if below["closed"][0]:
        nodes.append({k: v for k, v in below.items() if k not in ("closed", "first")} | {"parent": np.zeros(1, np.int64), "run": below["first"], "known": np.ones(1, bool), "depth": 0})

    found = []
    for node in nodes:
        d = node["depth"]
        paths = [chains.paths[i] for i in node["run"].tolist()]
        found.append({
            "conv_id": node["least"], "depth": np.full(len(paths), d), "n_convs": node["n"], "n_children": node["kids"], "n_leaves": node["leaves"],
            "parent_conv_id": pa.array(node["parent"], pa.int64(), mask=~node["known"] if d else np.ones(len(paths), bool)),
            "saved_tokens": node["saved"], "ends": [NONE if e is None else e for e in chains.ended(node["end"])],
            "key": [key_of(p, d) for p in paths], "parent_key": [None if k else key_of(p, d - 1) for p, k in zip(paths, node["known"].tolist())],
        })
    if rows == 1:
        spines = spines[:1]
    left = [{c: s[c].tolist() for c in (*SUMS, "words")} | {"path": chains.paths[i], "ended": chains.ended(s["end"])} for s, i in zip(spines, ends_open)]
    return found, left


def out(kind: str, run: int, **columns) -> pa.RecordBatch:
    """A batch of OUT; columns not given are null."""
    rows = len(next(iter(columns.values())))
    full = {"kind": [kind] * rows, "run": [run] * rows} | columns
    return batch(**{name: pa.array(full[name], TYPES[t]) if name in full else pa.nulls(rows, TYPES[t]) for name, t in FIELDS})


def spines_out(run: int, spines: list[dict]) -> Iterator[pa.RecordBatch]:
    if spines:
        yield out("spine", run, **{c: [s[c] for s in spines] for c in spines[0]})


def peel_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes, spines and written ids of one run of (path, conv_id, words) in order."""
    run = TaskContext.get().partitionId()
    chains = Chains()
    path, words, ids, n, least, wrote, first = None, None, [], 0, 0, False, True

    def write() -> pa.RecordBatch:
        return out("ids", run, key=[path[-KEY:]], first=[ids[0]], ids=[",".join(map(str, ids))])

    def close(edge: bool) -> Iterator[pa.RecordBatch]:
        """The chain is complete; at the run's edge its ids may go on next door."""
        digest = None
        if wrote or edge:
            if ids:
                yield write()
        else:
            digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        chains.add(path, words, n, least, digest)

    def shrink() -> Iterator[pa.RecordBatch]:
        nonlocal chains
        nodes, spines = peel(chains, True)
        for node in nodes:
            yield out("node", run, **node)
        chains = Chains()
        for s in spines:
            chains.add_spine(s)

    for b in batches:
        paths, convs, counts = b.column(0), b.column(1).to_pylist(), b.column(2)
        for i, conv in enumerate(convs):
            p = paths[i].as_py()
            if p != path:
                if path is not None:
                    yield from close(first)
                    first = False
                    if len(chains.paths) >= ROWS or chains.turns >= TURNS:
                        yield from shrink()
                path, words, ids, n, least, wrote = p, counts[i].values.to_numpy(zero_copy_only=False), [], 0, conv, False
            ids.append(conv)
            n += 1
            if len(ids) >= IDS:
                yield write()
                ids, wrote = [], True
    if path is not None:
        yield from close(True)
        nodes, spines = peel(chains, True)
        for node in nodes:
            yield out("node", run, **node)
        yield from spines_out(run, spines)


def peel_spines(round_: int, open_: bool):
    """The same over spines, in the order of their chains."""

    def peeled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = (round_ << 40) + TaskContext.get().partitionId()
        chains = Chains()
        for b in batches:
            for row in b.to_pylist():
                chains.add_spine(row)
        if chains.paths:
            nodes, spines = peel(chains, open_)
            for node in nodes:
                yield out("node", run, **node)
            yield from spines_out(run, spines)

    return peeled


def digest_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, digest) of written ids, in the order of (key, first)."""
    key, digest = None, None
    for b in batches:
        done: list[tuple[bytes, str]] = []
        for k, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if k != key:
                if key is not None:
                    done.append((key, digest.hexdigest()))
                key, digest = k, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if done:
            yield batch(end_key=pa.array([k for k, _ in done], pa.binary()), digest=pa.array([x for _, x in done], pa.string()))
    if key is not None:
        yield batch(end_key=pa.array([key], pa.binary()), digest=[digest.hexdigest()])


def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, conv_id, words) of (conv_id, turns)."""
    for b in batches:
        paths, words = [], []
        for turns in b.column(1).to_pylist():
            key, keys = b"", []
            for t in turns:
                key = hashlib.blake2b(key + t["digest"], digest_size=KEY).digest()
                keys.append(key)
            paths.append(b"".join(keys))
            words.append([t["words"] for t in turns])
        yield batch(path=pa.array(paths, pa.binary()), conv_id=b.column(0), words=pa.array(words, pa.list_(pa.int64())))


def rebuilt(turns: DataFrame, family: int = FAMILY, openings: int = OPENINGS) -> DataFrame:
    """(path, conv_id, words) of every conversation: the opening of its family's first, then its own turns."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    conv = F.col("conv_id").cast("long")
    rows = turns.where(F.col("conv_id").isNotNull()).select(conv.alias("conv_id"), (conv - conv % family).alias("base"), "turn", text("role").alias("role"), text("text").alias("text"))
    # One shuffle: all that follows groups by the family first.
    rows = rows.repartition("base")
    place = F.row_number().over(Window.partitionBy("base", "conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text"))
    turn = F.struct(
        place.alias("place"),
        F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))).alias("digest"),
        F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"),
    )
    own = rows.select("base", "conv_id", turn.alias("turn")).groupBy("base", "conv_id").agg(F.sort_array(F.collect_list("turn")).alias("own"))
    most = openings - 1
    opening = F.first(F.when(F.col("conv_id") == F.col("base"), F.slice("own", 1, most)), ignorenulls=True).over(
        Window.partitionBy("base").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % openings).cast("int")
    none = F.slice("own", 1, 0)
    own = own.select("conv_id", "own", F.coalesce(opening, none).alias("opening"), taken.alias("taken"))
    turns = F.concat(F.slice("opening", F.lit(1), F.col("taken")), F.slice("own", F.col("taken") + 1, F.greatest(F.size("own") - F.col("taken"), F.lit(0))))
    slim = F.transform(turns, lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words")))
    return own.select("conv_id", slim.alias("turns")).mapInArrow(chained, "path binary, conv_id long, words array<long>")


def trie(turns: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    chains = materialize(rebuilt(turns), "chains")
    ordered = chains.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    rounds = [materialize(ordered.mapInArrow(peel_sorted, OUT), "peeled")]
    spine = [f.split(" ")[0] for f in SPINE.split(", ")]
    while True:
        spines = rounds[-1].where("kind = 'spine'").select(*spine)
        runs = math.ceil(spines.count() / FAN)
        if runs <= 1:
            break
        dealt = spines.repartitionByRange(runs, "path").sortWithinPartitions("path")
        rounds.append(materialize(dealt.mapInArrow(peel_spines(len(rounds), True), OUT), "peeled"))
    rounds.append(materialize(spines.repartition(1).sortWithinPartitions("path").mapInArrow(peel_spines(len(rounds), False), OUT), "peeled"))

    every = reduce(DataFrame.unionByName, rounds)
    nodes = every.where("kind = 'node'").select("run", *(f.split(" ")[0] for f in NODE.split(", ")))
    # Where a parent was open at first: its smallest member by the run that asks and the parent's key.
    later = reduce(DataFrame.unionByName, rounds[1:]).where("kind = 'node'").select(F.col("key").alias("up_key"), F.col("conv_id").alias("up_conv"))
    asked = spine_keys(every)
    parents = asked.join(later, "up_key").select(F.col("run").alias("up_run"), "up_key", "up_conv")
    written = every.where("kind = 'ids'").select("key", "first", "ids").repartition("key").sortWithinPartitions("key", "first")
    digests = written.select("key", "ids").mapInArrow(digest_ids, "end_key binary, digest string")
    settled = F.col("parent_key").isNull() & (F.col("ends") != "")
    rest = nodes.where(~settled)
    rest = rest.join(parents, (F.col("run") == F.col("up_run")) & (F.col("parent_key") == F.col("up_key")), "left").join(digests, F.col("key") == F.col("end_key"), "left")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return (
        nodes.where(settled).withColumn("ends_sha256", F.col("ends")).select(*columns)
        .unionByName(
            rest.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "up_conv"))
            .withColumn("ends_sha256", F.when(F.col("ends") != "", F.col("ends")).otherwise(F.col("digest")))
            .select(*columns)
        )
    )


def spine_keys(every: DataFrame) -> DataFrame:
    """(run, up_key): the keys along each run's spines."""
    keys = F.expr(f"transform(sequence(0, size(n) - 1), d -> if(d = 0, unhex(''), substring(path, {KEY} * (d - 1) + 1, {KEY})))")
    return every.where("kind = 'spine'").select("run", F.explode(keys).alias("up_key")).distinct()
