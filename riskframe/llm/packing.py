"""Packing of documents into sequences of WINDOW tokens by non-negative least squares.

Every document is encoded once; its ids, with the end id, go to a scratch table. Full windows of a
long document are sequences of their own, so what is left of each document is a length below WINDOW.
The histogram of these lengths, at most WINDOW - 1 numbers whatever the table's size, is all the
driver sees. On it:

1. combinations of up to three distinct lengths, the first repeated, that fill a window exactly are enumerated;
2. repeat counts x >= 0 minimise the weighted |A x - h|, A's columns being the combinations and h
   the histogram (multiplicative updates, ROUNDS of them);
3. the counts are rounded in the order of their size, never beyond the lengths there are;
4. the rest is packed greedily, longest first, as many equal sequences at a time as the lengths allow.
   A window that no whole length closes is closed by a cut: the shortest longer piece gives its
   beginning, and its remainder takes part again.
5. What is left at the end is less than a window and is cut into powers of two, which need no padding.

The plan is a table of rank ranges: the documents of one length are ranked by task and position (the
ranks of tasks come from one sum per task and length), and a document finds its pieces by its length
and rank. No document moves to the driver, and the only shuffle of ids joins the rank offsets.

Encoding splits Latin texts as the tokenizer does, others at ASCII white space, which it drops, and asks
the library once per distinct part of a task (at most KEPT are remembered).

Defined cases. A null or empty text is the end id alone. Repeated rows, and rows with a null id, are
documents of their own. An empty table gives an empty result. Texts are encoded whole, however long;
a document of a hot length, source or text is ranked in its own task, so no group is gathered. Ties
of equal length are broken by task and position. Only ``doc_id`` and ``text`` are read; other columns
may have any name.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskframe.llm.common import batch
from riskframe.llm.token_counts import LATIN, tokenizer_path
from riskframe.sources.scratch import materialize

WINDOW = 4096
END = 2
#: Parts of texts remembered by a task.
KEPT = 1 << 18
#: Characters of texts that are encoded at a time.
AT_ONCE = 1 << 20
#: Repeats of a combination's first length, and lengths tried as its second.
REPEATS, PARTNERS = 6, 24
ROUNDS = 150


#: The tokenizer's own split, written out for the characters below LATIN, which it leaves as they are but for
#: case; some have their lower case in the letters beyond.
LETTERS, DIGITS = r"a-z\xaa\xb5\xba\xdf-\xf6\xf8-ʯⱥⱦ", r"0-9\xb2\xb3\xb9\xbc-\xbe"
PARTS = re.compile(rf"'(?:s|t|re|ve|m|ll|d)|[{LETTERS}]+|[{DIGITS}]|[^\s{LETTERS}{DIGITS}]+")
#: White space to Python only, a letter whose lower case is two characters, and what is not Latin.
ODD = re.compile("[\x1c-\x1fİ" + chr(LATIN) + "-\U0010ffff]")


def plain(text: str) -> bool:
    return "<|" not in text and not ODD.search(text)


def parts(text: str) -> list[str]:
    """Parts of a text that are encoded on their own: the tokenizer's words of Latin text, else runs between ASCII blanks, marked by a blank before."""
    if plain(text):
        return PARTS.findall(text.lower())
    words = [w.decode() for w in text.encode().split()]
    return [p for w in words for p in (PARTS.findall(w.lower()) if plain(w) else (" " + w,))]


class Places(dict):
    """Numbers words as they are first asked for."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n

    def fresh(self) -> list[str]:
        """The words numbered since the last call."""
        new, self.new = self.new, []
        return new


def byte_merges(path: str):
    """The ids of one part by ``tiktoken``, ten times as fast as the library with the same merges.

    The mark of a word's end becomes the byte 255, which no UTF-8 text holds and which joins the byte
    before it first of all.
    """
    import json

    import tiktoken
    from tokenizers.pre_tokenizers import ByteLevel

    with open(path) as f:
        model = json.load(f)["model"]
    letters = {c: b for b in range(256) for c in [byte_letter(b, ByteLevel)]}
    ranks, ids = {}, {}
    single = [(t, i) for t, i in model["vocab"].items() if len(t.removesuffix("</w>")) == 1]
    pairs = [(a + b, model["vocab"][a + b]) for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["merges"])]
    for token, i in sorted(single, key=lambda x: not x[0].endswith("</w>")) + pairs:
        key = bytes(letters[c] for c in token.removesuffix("</w>")) + b"\xff" * token.endswith("</w>")
        ids[ranks.setdefault(key, len(ranks))] = i
    ids[ranks.setdefault(b"\xff", len(ranks))] = 0
    core = tiktoken.Encoding("parts", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})

    def one(part: str) -> list[int]:
        return [ids[r] for r in core._encode_single_piece(part.encode() + b"\xff")]

    return one


def byte_letter(b: int, kind) -> str:
    """The character that byte-level vocabularies write for a byte: itself where it prints, else the next free one from 256."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return chr(b) if b in prints else chr(256 + sum(x not in prints for x in range(b)))


class Encoder:
    """Ids of texts by one library call per distinct part."""

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.merge = None if path != tokenizer_path("word_bpe_49k.json") else byte_merges(path)
        self.forget()

    def forget(self) -> None:
        self.place, self.known = Places(), 0
        self.ids = np.zeros(0, np.uint32)
        self.starts = np.zeros(1, np.int64)

    def learn(self, fresh: list[str]) -> None:
        self.known += len(fresh)
        coded = [self.merge(p) if self.merge and p[0] != " " else None for p in fresh]
        rest = [i for i, ids in enumerate(coded) if ids is None]
        for i, e in zip(rest, self.tokenizer.encode_batch([fresh[i] for i in rest], add_special_tokens=False)):
            coded[i] = e.ids
        sizes = np.fromiter(map(len, coded), np.int64, len(coded))
        self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(coded), np.uint32, int(sizes.sum()))])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, without the end id."""
        words = [parts(t) for t in texts]
        if self.known > KEPT:
            self.forget()
        counts = np.fromiter(map(len, words), np.int64, len(words))
        at = np.fromiter(map(self.place.__getitem__, chain.from_iterable(words)), np.int64, int(counts.sum()))
        self.learn(self.place.fresh())
        sizes = (self.starts[1:] - self.starts[:-1])[at]
        ends = np.cumsum(sizes)
        flat = self.ids[np.repeat(self.starts[at] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]
        edges = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        return [flat[a:b] for a, b in zip(edges[:-1], edges[1:])]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def slices(texts: list[str], most: int) -> Iterator[list[str]]:
    """The texts in runs of about ``most`` characters."""
    run, size = [], 0
    for t in texts:
        run.append(t)
        size += len(t)
        if size >= most:
            yield run
            run, size = [], 0
    if run:
        yield run


def encoded(docs: DataFrame, path: str, end: int, window: int) -> DataFrame:
    """(doc_id, lane, rest, nth, before, n, ids) of every document, its ids packed as unsigned 32-bit.

    A lane is a task; ``nth`` and ``before`` count the documents, and their full windows, of the same
    ``rest`` that the lane gave earlier.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lane = TaskContext.get().partitionId()
        encode, nth, before = encoder(path), defaultdict(int), defaultdict(int)
        for b in batches:
            done = 0
            for texts in slices([t or "" for t in b.column(1).to_pylist()], AT_ONCE):
                rows: list[tuple] = []
                for ids in encode(texts):
                    n = len(ids) + 1
                    rest = n % window
                    rows.append((rest, nth[rest], before[rest], n, np.append(ids, np.uint32(end)).astype("<u4").tobytes()))
                    nth[rest] += 1
                    before[rest] += n // window
                cols = list(zip(*rows))
                yield batch(
                    doc_id=b.column(0).slice(done, len(rows)), lane=pa.array([lane] * len(rows), pa.int32()), rest=pa.array(cols[0], pa.int32()),
                    nth=pa.array(cols[1], pa.int64()), before=pa.array(cols[2], pa.int64()), n=pa.array(cols[3], pa.int64()), ids=pa.array(cols[4], pa.binary()),
                )
                done += len(rows)

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lane int, rest int, nth long, before long, n long, ids binary")


def combinations(counts: np.ndarray, window: int) -> np.ndarray:
    """Rows (a, l1, l2, l3): a * l1 + l2 + l3 = window, zeros for lengths not used; every length is one there is."""
    lengths = np.flatnonzero(counts)
    if not len(lengths):
        return np.zeros((0, 4), np.int64)
    mass = np.cumsum(counts[lengths])
    partners = np.unique(lengths[np.searchsorted(mass, mass[-1] * (np.arange(PARTNERS) + 0.5) / PARTNERS)])
    second = np.concatenate([[0], partners])
    a, l1, l2 = (x.ravel() for x in np.meshgrid(np.arange(1, REPEATS + 1), lengths, second, indexing="ij"))
    l3 = window - a * l1 - l2
    fits = (l3 >= 0) & (a <= counts[l1])
    there = np.zeros(window + 1, bool)
    there[lengths], there[0] = True, True
    fits[fits] = there[l3[fits]]
    small, large = np.minimum(l2, l3)[fits], np.maximum(l2, l3)[fits]
    return np.unique(np.stack([a[fits], l1[fits], small, large], axis=1), axis=0)


def least_squares(ways: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Repeat counts x >= 0 of the combinations that bring their lengths near the histogram.

    Each length weighs the inverse of its count, so rare ones count too. The update x * (A'Wh) / (A'WAx)
    keeps x non-negative and never raises the error.
    """
    if not len(ways):
        return np.zeros(0)
    goal = counts.astype(float)
    weight = np.divide(1.0, goal, out=np.zeros_like(goal), where=goal > 0)
    cols, uses = ways[:, 1:], np.stack([ways[:, 0], ways[:, 2] > 0, ways[:, 3] > 0], axis=1).astype(float)

    def used(x: np.ndarray) -> np.ndarray:
        return np.bincount(cols.ravel(), (uses * x[:, None]).ravel(), minlength=len(goal))

    def pulled(v: np.ndarray) -> np.ndarray:
        return (uses * v[cols]).sum(axis=1)

    up = pulled(weight * goal)
    x = goal[cols[:, 0]] / np.bincount(cols[:, 0], minlength=len(goal))[cols[:, 0]]
    for _ in range(rounds):
        x *= up / np.maximum(pulled(weight * used(x)), 1e-12)
    return x


class Plan:
    """Pieces by length and rank; ``rows`` holds (rest, first rank, count, start, length, sequence, offset)."""

    def __init__(self, counts: np.ndarray, window: int = WINDOW):
        self.window, self.rows, self.sequences, self.whole = window, [], 0, 0
        self.left = counts.astype(np.int64).copy()
        #: By current length: (rest, first rank, start, count) of pieces not yet placed.
        self.parts: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
        for rest in np.flatnonzero(counts):
            self.parts[int(rest)].append((int(rest), 0, 0, int(counts[rest])))
        ways = combinations(self.left, window)
        x = least_squares(ways, self.left)
        for j in np.argsort(-x, kind="stable"):
            if x[j] < 0.5:
                break
            a, *lengths = (int(v) for v in ways[j])
            slots = [lengths[0]] * a + [v for v in lengths[1:] if v]
            times = min(int(x[j] + 0.5), *(int(self.left[v]) // slots.count(v) for v in set(slots)))
            if times > 0:
                self.place(slots, times)
        self.whole = self.sequences
        while self.left.any():
            self.greedy()

    def take(self, length: int, times: int) -> list[tuple[int, int, int, int]]:
        """``times`` pieces of a length."""
        out = []
        self.left[length] -= times
        while times:
            rest, rank, start, count = self.parts[length].pop()
            if count > times:
                self.parts[length].append((rest, rank + times, start, count - times))
                count = times
            out.append((rest, rank, start, count))
            times -= count
        return out

    def place(self, slots: list[int], times: int, cut: tuple[int, int] | None = None) -> None:
        """``times`` sequences of these lengths; ``cut`` = (length, gap) closes each with the first ``gap`` ids of one more."""
        offset = 0
        for length in slots:
            self.lay(self.take(length, times), length, offset)
            offset += length
        if cut:
            length, gap = cut
            taken = self.take(length, times)
            self.lay(taken, gap, offset)
            self.parts[length - gap] += [(rest, rank, start + gap, count) for rest, rank, start, count in taken]
            self.left[length - gap] += times
        self.sequences += times

    def lay(self, taken: list[tuple[int, int, int, int]], length: int, offset: int) -> None:
        at = self.sequences
        for rest, rank, start, count in taken:
            self.rows.append((rest, rank, count, start, length, at, offset))
            at += count

    def greedy(self) -> None:
        """The longest length left, filled up by the longest that fit, as often as the lengths allow."""
        there = np.flatnonzero(self.left).tolist()
        slots, gap = [there[-1]], self.window - there[-1]
        uses = {there[-1]: 1}
        while gap:
            k = bisect_right(there, gap) - 1
            while k >= 0 and self.left[there[k]] == uses.get(there[k], 0):
                k -= 1
            if k < 0:
                break
            slots.append(there[k])
            uses[there[k]] = uses.get(there[k], 0) + 1
            gap -= there[k]
        times = min(int(self.left[v]) // n for v, n in uses.items())
        longer = [v for v in there[bisect_right(there, gap) :] if self.left[v] > uses.get(v, 0)] if gap else []
        if longer:
            v = longer[0]
            times = min(times, int(self.left[v]) // (uses.get(v, 0) + 1))
            self.place(slots, times, (v, gap))
        elif gap:
            self.powers(slots)
        else:
            self.place(slots, times)

    def powers(self, slots: list[int]) -> None:
        """The last pieces of all, cut into sequences whose lengths are powers of two."""
        total = sum(slots)
        sizes = [1 << b for b in range(total.bit_length() - 1, -1, -1) if total >> b & 1]
        room, offset = sizes[0], 0
        for length in slots:
            ((rest, rank, start, _),) = self.take(length, 1)
            while length:
                part = min(length, room)
                self.rows.append((rest, rank, 1, start, part, self.sequences, offset))
                start, length, room, offset = start + part, length - part, room - part, offset + part
                if not room:
                    sizes.pop(0)
                    self.sequences += 1
                    room, offset = (sizes[0] if sizes else 0), 0

    def segments(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The plan by stretches of ranks within which all documents have the same pieces.

        ``keys`` (rest and first rank) begin the stretches; the pieces of stretch i are rows
        ``edges[i]`` to ``edges[i + 1]`` of (start, length, sequence at rank 0, offset).
        """
        by: dict[int, list[tuple]] = defaultdict(list)
        for rest, *row in self.rows:
            by[rest].append(row)
        keys, edges, pieces = [], [0], []
        for rest in sorted(by):
            begins, ends = defaultdict(list), defaultdict(list)
            for i, (rank, count, *_) in enumerate(by[rest]):
                begins[rank].append(i)
                ends[rank + count].append(i)
            live: set[int] = set()
            for rank in sorted(begins.keys() | ends.keys()):
                live = (live - set(ends[rank])) | set(begins[rank])
                keys.append(rest * RANKS + rank)
                own = sorted(by[rest][i][2:] + [by[rest][i][0]] for i in live)
                pieces += [(start, length, sequence - first, offset) for start, length, sequence, offset, first in own]
                edges.append(len(pieces))
        return np.array(keys, np.int64), np.array(edges, np.int64), np.array(pieces, np.int64).reshape(-1, 4)


#: More than the documents of a table.
RANKS = 1 << 48


def pack(docs: DataFrame, path: str | None = None, window: int = WINDOW, end: int = END) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (unsigned 32-bit, little-endian), ids_crc32, doc_tokens, sequence_id, offset."""
    path = path or tokenizer_path("word_bpe_49k.json")
    kind = docs.schema["doc_id"].dataType.simpleString()
    table = materialize(encoded(docs, path, end, window), "encoded")
    full = F.floor(F.col("n") / window).cast("long")
    sums = table.groupBy("lane", "rest").agg(F.count("*").alias("docs"), F.sum(full).alias("windows"))
    sums = materialize(sums, "lanes")
    histogram = sums.groupBy("rest").agg(F.sum("docs").alias("docs"), F.sum("windows").alias("windows")).collect()
    counts, windows = np.zeros(window + 1, np.int64), np.zeros(window + 1, np.int64)
    for r in histogram:
        counts[r["rest"]], windows[r["rest"]] = r["docs"] if r["rest"] else 0, r["windows"]
    plan = Plan(counts, window)
    keys, edges, pieces = plan.segments()
    first_window = plan.sequences + np.concatenate([[0], np.cumsum(windows)[:-1]])

    earlier = Window.partitionBy("rest").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("lane", "rest", *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("docs", "windows")))
    placed = table.join(offsets, ["lane", "rest"]).select(
        "doc_id", "rest", (F.col("docs_before") + F.col("nth")).alias("rank"), (F.col("windows_before") + F.col("before")).alias("windows"), "n", "ids"
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rest, rank, before, n = (b.column(i).to_numpy() for i in range(1, 5))
            rest = rest.astype(np.int64)
            at = np.searchsorted(keys, rest * RANKS + rank, "right") - 1
            few = np.where(rest > 0, edges[at + 1] - edges[at], 0) if len(keys) else np.zeros(len(n), np.int64)
            whole = n // window
            sizes = whole + few
            row = np.repeat(np.arange(len(n)), sizes)
            k = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            start, length, offset = k * window, np.full(len(row), window, np.int64), np.zeros(len(row), np.int64)
            sequence = first_window[rest[row]] + before[row] + k
            tail = np.flatnonzero(k >= whole[row])
            if len(tail):
                own = row[tail]
                piece = pieces[edges[at[own]] + k[tail] - whole[own]]
                start[tail], length[tail] = whole[own] * window + piece[:, 0], piece[:, 1]
                sequence[tail], offset[tail] = piece[:, 2] + rank[own], piece[:, 3]
            raw = b.column(5)
            # A slice of rows at a time, so that the copies of long documents' ids stay small.
            for lo in range(0, len(row), 4096):
                hi = min(lo + 4096, len(row))
                ids, held, doc = [], -1, b""
                for i in range(lo, hi):
                    if row[i] != held:
                        held, doc = row[i], raw[int(row[i])].as_py()
                    ids.append(doc[4 * start[i] : 4 * (start[i] + length[i])])
                some = slice(lo, hi)
                yield batch(
                    doc_id=b.column(0).take(pa.array(row[some])), start=start[some], length=length[some], ids=pa.array(ids, pa.binary()),
                    ids_crc32=pa.array([zlib.crc32(x) for x in ids], pa.int64()), doc_tokens=n[row[some]], sequence_id=sequence[some], offset=offset[some],
                )

    schema = f"doc_id {kind}, start long, length long, ids binary, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return placed.mapInArrow(cut, schema)
