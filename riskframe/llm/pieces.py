"""SentencePiece encoding and decoding by a max-plus scan.

The pieces and scores of a SentencePiece model file are used as a unigram vocabulary: a text's
pieces are the segmentation with the largest sum of scores, a best path. Texts longer than CHUNK
characters are cut into chunks. At a cut the path is in one of a few states: how many characters
the piece that crosses the cut reaches into the next chunk. Each chunk gives a max-plus matrix of
best sums from entry state to exit state; matrices are combined associatively, in blocks and then
over blocks, which settles the state at every cut, and each chunk is then traced back by itself.
No piece holds a word mark after another character, so a path passes every word start; between
word starts a word's pieces are looked up or computed once per task and kept.

The vocabulary's own order of merges plays no part: a model file trained for merging gives the
pieces that its scores make best, as the library gives for the same pieces marked as a unigram model.
Equal sums are told apart by a fixed weight of each piece, and paths that are equal still by their
lengths from the end: the longer last piece wins, then the longer one before it. Each matrix carries,
beside the sums, the rank of its entry states by that rule, and ranks combine as the sums do, so the
pieces do not depend on the cuts.

Defined cases. As the library does, a text gets a word mark in front and spaces become word marks;
nothing else is normalised, so decoding gives back the text. A character without a piece of its own,
and a word mark that the text itself holds, become byte pieces. A null or empty text has no pieces
and decodes to an empty text. Repeated rows and extra columns stay, an empty table gives an empty
result.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.llm.common import batch, digest, let, packed
from riskframe.sources.scratch import materialize

CHUNK = 1 << 16
#: Chunks whose matrices are multiplied as one block.
BLOCK = 256
#: Words kept per Python worker.
KEPT = 150_000

MARK = "▁"
#: Stands for a word mark of the text itself; it cannot occur in UTF-8.
OWN_MARK = "\udc81"
#: Scores are clamped to this and scaled, with a small weight per piece below the scale.
LOWEST, SCALE, FLOOR = -1_000_000, 1 << 16, -(1 << 61)
_LAST = 1 << 40


def model_path(model: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(model)


#: Words up to this length are solved together, so many at a time; texts so many at a time.
TOGETHER, SOLVED, AT_ONCE = 24, 1 << 14, 200
_BASE, _SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)
_POWERS = np.array([pow(int(_BASE), n, 1 << 64) for n in range(64)], np.uint64)


def _key(piece: str) -> int:
    """The hash by which a piece is looked up."""
    h = 0
    for c in piece:
        h = (h * int(_BASE) + ord(c)) % (1 << 64)
    return (h * int(_SPREAD) + len(piece)) % (1 << 64)


class Vocabulary:
    """Pieces with integer weights, and the best paths over them."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces: list[str] = []
        self.byte_ids: dict[int, int] = {}
        self.table: dict[str, tuple[int, int]] = {}
        scores = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            self.pieces.append(piece)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                score = max(LOWEST, model.get_score(i))
                scores.append(score)
                self.table[piece] = (i, round(score * SCALE) + xxhash.xxh32_intdigest(piece) % (SCALE // 4))
        self.bytes_of = {i: b for b, i in self.byte_ids.items()}
        if len(self.byte_ids) < 256:
            raise ValueError("the model has no byte pieces")
        if any(MARK in p.lstrip(MARK) for p in self.table):
            raise ValueError("pieces that cross word starts are not supported")
        self.unknown = round((min(scores) - 10) * SCALE)
        self.longest = max(map(len, self.table))
        # Weights of pieces by text, and False for texts that only begin a piece.
        self.beginnings: dict[str, int | bool] = {p[:n]: False for p in self.table for n in range(1, len(p))}
        self.beginnings.update({p: w for p, (_, w) in self.table.items()})
        # Pieces by a 64-bit hash, sorted, with a table of leading bits that rules most others out.
        hashes = {_key(p): p for p in self.table}
        if len(hashes) < len(self.table):
            raise ValueError("two pieces have one hash")
        self.keys = np.array(sorted(hashes), np.uint64)
        self.numbers, self.weights = (np.array([self.table[hashes[int(k)]][c] for k in self.keys], t) for c, t in ((0, np.int32), (1, np.int64)))
        self.ascii_ids = np.array([*(self.byte_ids[b] for b in range(128)), -1], np.int32)
        self.seen = np.zeros(1 << 20, bool)
        self.seen[self.keys >> np.uint64(44)] = True
        self.words: dict[str, bytes] = {}
        self.written = [p.replace(MARK, " ") for p in self.pieces]
        for byte, i in self.byte_ids.items():
            if byte < 0x80:
                self.written[i] = chr(byte)
        self.parts_of_characters = frozenset(i for b, i in self.byte_ids.items() if b >= 0x80)

    def edges(self, text: str, end: int) -> list[tuple[int, int]]:
        """(length, weight) of the pieces that end at ``end``; a character without a piece is an edge of its own."""
        out = []
        for start in range(max(0, end - self.longest), end):
            found = self.table.get(text[start:end])
            if found:
                out.append((end - start, found[1]))
        if text[end - 1] not in self.table:
            out.append((1, self.unknown))
        return out

    def ids(self, piece: str) -> list[int]:
        found = self.table.get(piece)
        if found:
            return [found[0]]
        return [self.byte_ids[b] for b in (MARK if piece == OWN_MARK else piece).encode()]

    def path(self, text: str) -> tuple[list[int], int]:
        """(ids, sum) of the best path over a whole text; of equal ones that with the longer last piece."""
        size, longest, beginnings, unknown = len(text), self.longest, self.beginnings, self.unknown
        best: list[int | None] = [0] + [None] * size
        back = [0] * (size + 1)
        for start in range(size):
            so_far, end = best[start], start + 1
            weight = beginnings.get(text[start])
            if weight is None or weight is False:
                total = so_far + unknown
                if best[end] is None or total > best[end]:
                    best[end], back[end] = total, start
            while weight is not None:
                if weight is not False:
                    total = so_far + weight
                    if best[end] is None or total > best[end]:
                        best[end], back[end] = total, start
                end += 1
                if end > size or end - start > longest:
                    break
                weight = beginnings.get(text[start:end])
        cuts, at = [], size
        while at:
            cuts.append(text[back[at] : at])
            at = back[at]
        ids: list[int] = []
        for piece in reversed(cuts):
            found = self.table.get(piece)
            if found:
                ids.append(found[0])
            else:
                ids += self.ids(piece)
        return ids, best[-1]

    def solve(self, words: list[str]) -> tuple[list[bytes], np.ndarray]:
        """(ids as 32-bit numbers, sum) of the best path of each word; all words take a step at a time."""
        found: list[bytes] = [b""] * len(words)
        sums = np.zeros(len(words), np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        rest = np.flatnonzero((sizes > TOGETHER) & (sizes > 0)).tolist()
        # The longest first: the words that are long enough for a step are the first so many.
        order = np.argsort(-sizes, kind="stable")
        order = order[(sizes[order] <= TOGETHER) & (sizes[order] > 0)]
        if len(order):
            own, n = sizes[order], len(order)
            line = np.frombuffer("".join([words[i] for i in order]).encode("utf-32-le", "surrogatepass"), np.uint32)
            starts = np.cumsum(own) - own
            width = int(own[0])
            sums_to = np.zeros((width + 1, n), np.uint64)
            best = np.full((width + 1, n), FLOOR, np.int64)
            best[0] = 0
            back, used = np.zeros((width + 1, n), np.int8), np.full((width + 1, n), -1, np.int32)
            for end in range(1, width + 1):
                k = int(np.searchsorted(-own, -end, side="right"))
                sums_to[end, :k] = sums_to[end - 1, :k] * _BASE + line[starts[:k] + end - 1]
                total, step, piece = best[end, :k], back[end, :k], used[end, :k]
                for length in range(min(end, self.longest), 0, -1):
                    before = best[end - length, :k]
                    keys = (sums_to[end, :k] - sums_to[end - length, :k] * _POWERS[length]) * _SPREAD + np.uint64(length)
                    may = np.flatnonzero(self.seen[keys >> np.uint64(44)])
                    at = np.minimum(np.searchsorted(self.keys, keys[may]), len(self.keys) - 1)
                    hit = self.keys[at] == keys[may]
                    may, at = may[hit], at[hit]
                    made = before[may] + self.weights[at]
                    better = made > total[may]
                    may, at = may[better], at[better]
                    total[may], step[may], piece[may] = made[better], length, self.numbers[at]
                    if length == 1:
                        # A character without a piece of its own: one byte piece if it is ASCII; words
                        # with others are traced one by one.
                        code = np.minimum(line[starts[:k] + end - 1], 128)
                        lone = np.ones(k, bool)
                        lone[np.flatnonzero(self.seen[keys >> np.uint64(44)])[hit]] = False
                        made = before + self.unknown
                        better = lone & (made > total)
                        total[better], step[better], piece[better] = made[better], 1, self.ascii_ids[code[better]]
            sums[order] = best[own, np.arange(n)]
            out = np.full((n, width), -1, np.int32)
            place, at, rows = np.full(n, width), own.copy(), np.arange(n)
            strange = np.zeros(n, bool)
            while len(rows):
                place[rows] -= 1
                ids = used[at[rows], rows]
                strange[rows] |= ids < 0
                out[rows, place[rows]] = ids
                at[rows] -= back[at[rows], rows]
                rows = rows[at[rows] > 0]
            raw, row = out.tobytes(), 4 * width
            for j, (i, first) in enumerate(zip(order.tolist(), place.tolist())):
                found[i] = raw[j * row + 4 * first : (j + 1) * row]
            rest += order[strange].tolist()
        for i in rest:
            ids, sums[i] = self.path(words[i])
            found[i] = array("i", ids).tobytes()
        return found, sums

    def raw(self, texts: list[str]) -> list[bytes]:
        """The pieces of whole texts as 32-bit numbers."""
        known, split = self.words, []
        for text in texts:
            if text[:1] == " " or text[-1:] == " " or "  " in text:
                split.append(words_of(marked(text)))
            else:
                split.append([MARK + w for w in text.replace(MARK, OWN_MARK).split(" ")] if text else [])
        fresh = list({w for words in split for w in words if w not in known})
        made: dict[str, bytes] = {}
        for at in range(0, len(fresh), SOLVED):
            made.update(zip(fresh[at : at + SOLVED], self.solve(fresh[at : at + SOLVED])[0]))
        # The words met first are the frequent ones; they stay.
        if len(known) < KEPT:
            known.update((w, x) for w, x in made.items() if len(w) <= TOGETHER)
        return [b"".join([known[w] if w in known else made[w] for w in words]) for words in split]

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.raw([text])[0], np.int32).tolist()

    # A chunk is ``text[:size]`` followed by up to ``longest - 1`` characters of the next one.

    def sums(self, text: str, size: int, starts: int) -> np.ndarray:
        """[2, entry, exit] best sums over a stretch without word starts inside, entries below ``starts``, and ranks.

        Ranks order the entries of one exit by the lengths of their best paths' pieces from the end,
        the longest first; entries that do not reach it share the last place.
        """
        states = self.longest
        best = np.full((len(text) + 1, starts), FLOOR, np.int64)
        rank = np.full((len(text) + 1, starts), starts, np.int64)
        for s in range(min(starts, len(text) + 1)):
            best[s, s], rank[s, s] = 0, 0
        for end in range(1, min(len(text), size + states - 1) + 1):
            path = np.where(best[end] > FLOOR, 0, _LAST)
            # Longer pieces come first, and a shorter one must be better than they are.
            for n, w in self.edges(text, end):
                # A piece that starts at the cut or beyond belongs to the next chunk.
                if end - n < size:
                    made = np.where(best[end - n] > FLOOR, best[end - n] + w, FLOOR)
                    better = made > best[end]
                    best[end][better] = made[better]
                    path[better] = (states - n + 1) * (starts + 1) + rank[end - n][better]
            # The entry at this place comes first: the piece that ends here began before the chunk.
            rank[end] = np.where(best[end] > FLOOR, np.searchsorted(np.sort(path), path), starts)
        out = np.stack([np.full((starts, states), FLOOR, np.int64), np.full((starts, states), starts, np.int64)])
        for into, rows in zip(out, (best, rank)):
            last = rows[size : size + states].T
            into[:, : last.shape[1]] = last
        return out

    def spread(self, chunk: str, size: int) -> tuple[str, list[str], str]:
        """The chunk before its first word start, its whole words, and from its last word start on."""
        starts = [m.start() + 1 for m in re.finditer(f"[^{MARK}]{MARK}", chunk) if m.start() + 1 < size]
        if not starts:
            return chunk, [], ""
        return chunk[: starts[0]], words_of(chunk[starts[0] : starts[-1]]), chunk[starts[-1] :]

    def matrix(self, chunk: str, size: int) -> np.ndarray:
        head, words, tail = self.spread(chunk, size)
        states = self.longest
        if not tail:
            return self.sums(chunk, size, states)
        first, ranks = self.sums(head, len(head), states)[:, :, 0]
        middle = self.solve(words)[1].sum()
        last = self.sums(tail, size - (len(chunk) - len(tail)), 1)[0, 0]
        out = first[:, None] + (middle + last)[None, :]
        reached = (first[:, None] > FLOOR) & (last[None, :] > FLOOR)
        # All paths meet at the word start behind the head, so the head alone ranks them.
        return np.stack([np.where(reached, out, FLOOR), np.where(reached, ranks[:, None], states)])

    def trace(self, chunk: str, size: int, entry: int, leave: int) -> list[int]:
        """The pieces that start in the chunk, on the best path between two states."""
        whole = chunk[entry : size + leave]
        return np.frombuffer(b"".join(self.solve(words_of(whole))[0]), np.int32).tolist()

    def decode(self, ids: list[int]) -> str:
        if self.parts_of_characters.isdisjoint(ids):
            text = "".join([self.written[i] for i in ids])
        else:
            out = bytearray()
            for i in ids:
                byte = self.bytes_of.get(i)
                out += self.written[i].encode() if byte is None else bytes([byte])
            text = out.decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


def marked(text: str) -> str:
    if not text:
        return ""
    return MARK + text.replace(MARK, OWN_MARK).replace(" ", MARK)


def words_of(text: str) -> list[str]:
    """Cut before every run of word marks; the first part may have none."""
    return re.findall(f"{MARK}+[^{MARK}]*|[^{MARK}]+", text)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The max-plus product of two stretches' matrices, with the ranks of its entries.

    Of equal sums that state between the two is taken whose path through the second ranks first.
    """
    (left, left_ranks), (right, right_ranks) = a, b
    states = len(right)
    sums = np.where((left[:, :, None] > FLOOR) & (right[None, :, :] > FLOOR), left[:, :, None] + right[None, :, :], FLOOR)
    most = sums.max(axis=1)
    by_rank = np.where(sums == most[:, None, :], right_ranks[None, :, :], states + 1)
    between = by_rank.argmin(axis=1)
    exits = np.arange(right.shape[1])
    path = right_ranks[between, exits] * (states + 2) + left_ranks[np.arange(len(left))[:, None], between]
    path = np.where(most > FLOOR, path, _LAST)
    order = np.sort(path, axis=0)
    ranks = np.stack([np.searchsorted(order[:, z], path[:, z]) for z in exits], axis=1)
    return np.stack([most, np.where(most > FLOOR, ranks, states)])


def states_between(matrices: list[np.ndarray], entry: int, leave: int) -> list[int]:
    """The states before the first matrix, between all, and after the last, on the best path."""
    forward = [np.full(len(matrices[0][0]), FLOOR, np.int64)]
    forward[0][entry] = 0
    for sums, _ in matrices:
        before = forward[-1][:, None]
        forward.append(np.where((before > FLOOR) & (sums > FLOOR), before + sums, FLOOR).max(axis=0))
    states = [leave]
    for (sums, ranks), before in zip(reversed(matrices), reversed(forward[:-1])):
        column = sums[:, states[-1]]
        total = np.where((before > FLOOR) & (column > FLOOR), before + column, FLOOR)
        states.append(int(np.argmin(np.where(total == total.max(), ranks[:, states[-1]], len(total) + 1))))
    return states[::-1]


def _square(raw: bytes) -> np.ndarray:
    n = int(round((len(raw) // 16) ** 0.5))
    return np.frombuffer(raw, np.int64).reshape(2, n, n)


def block_product(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("chunk")
    product = None
    for raw in rows["matrix"]:
        product = _square(raw) if product is None else times(product, _square(raw))
    return rows.iloc[:1][["doc_id", "dig", "block"]].assign(matrix=product.tobytes())


def block_states(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("block")
    states = states_between([_square(x) for x in rows["matrix"]], 0, 0)
    return rows[["doc_id", "dig", "block"]].assign(entry=states[:-1], leave=states[1:])


def chunk_states(key: tuple, rows: pd.DataFrame, ends: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("chunk")
    states = states_between([_square(x) for x in rows["matrix"]], int(ends["entry"].iloc[0]), int(ends["leave"].iloc[0]))
    return rows[["doc_id", "dig", "chunk"]].assign(entry=states[:-1], leave=states[1:])


def encode_long(docs: DataFrame, path: str, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, dig, pieces) of distinct documents (doc_id, dig, text), by chunks."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ahead = vocabulary(path).longest - 1
        for b in batches:
            for doc_id, dig, text in zip(*(c.to_pylist() for c in b.columns)):
                line = marked(text)
                for n, at in enumerate(range(0, len(line), chunk)):
                    part = line[at : at + chunk + ahead]
                    yield batch(
                        doc_id=pa.array([doc_id], pa.int64()), dig=pa.array([dig], pa.int64()), chunk=pa.array([n], pa.int32()),
                        size=pa.array([min(chunk, len(line) - at)], pa.int32()), part=pa.array([part.encode("utf-8", "surrogatepass")], pa.binary()),
                    )

    def transfer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for b in batches:
            sizes, parts = b.column(3).to_pylist(), b.column(4).to_pylist()
            made = [v.matrix(p.decode("utf-8", "surrogatepass"), n).tobytes() for n, p in zip(sizes, parts)]
            yield batch(doc_id=b.column(0), dig=b.column(1), chunk=b.column(2), matrix=pa.array(made, pa.binary()))

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for b in batches:
            rows = zip(*(b.column(c).to_pylist() for c in range(3, 7)))
            made = [v.trace(p.decode("utf-8", "surrogatepass"), n, a, z) for n, p, a, z in rows]
            yield batch(doc_id=b.column(0), dig=b.column(1), chunk=b.column(2), ids=pa.array(made, pa.list_(pa.int32())))

    if chunk < vocabulary(path).longest:
        raise ValueError("a piece may reach into the next chunk, not beyond it")
    key = "doc_id long, dig long"
    chunks = materialize(docs.mapInArrow(cut, f"{key}, chunk int, size int, part binary"), "chunks")
    matrices = chunks.repartition(F.col("doc_id"), F.col("dig"), F.col("chunk")).mapInArrow(transfer, f"{key}, chunk int, matrix binary")
    matrices = materialize(matrices.withColumn("block", (F.col("chunk") / BLOCK).cast("int")), "matrices")
    products = matrices.groupBy("doc_id", "dig", "block").applyInPandas(block_product, f"{key}, block int, matrix binary")
    ends = products.groupBy("doc_id", "dig").applyInPandas(block_states, f"{key}, block int, entry int, leave int")
    by = ["doc_id", "dig", "block"]
    states = matrices.groupBy(*by).cogroup(ends.groupBy(*by)).applyInPandas(chunk_states, f"{key}, chunk int, entry int, leave int")
    states = states.select(F.col("doc_id").alias("d"), F.col("dig").alias("g"), F.col("chunk").alias("c"), "entry", "leave")
    here = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("dig") == F.col("g")) & (F.col("chunk") == F.col("c"))
    traced = chunks.join(states, here).drop("d", "g", "c").mapInArrow(trace, f"{key}, chunk int, ids array<int>")
    ordered = F.sort_array(F.collect_list(F.struct("chunk", "ids")))
    return traced.groupBy("doc_id", "dig").agg(F.flatten(F.transform(ordered, lambda x: x["ids"])).alias("pieces"))


def encode(docs: DataFrame, path: str | None = None, chunk: int = CHUNK) -> DataFrame:
    """The documents with all their columns and ``pieces`` (array<int>; replaces a column of that name)."""
    path = path or model_path()
    rows = packed(docs).withColumns({"id": F.col("row").getField("doc_id").cast("long"), "dig": digest(F.col("row").getField("text"))})
    text = F.col("row").getField("text")
    is_long = F.coalesce(F.length(text) >= chunk, F.lit(False))

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        parts = (b.slice(at, AT_ONCE) for b in batches for at in range(0, b.num_rows, AT_ONCE))
        for b in parts:
            made = v.raw([x or "" for x in b.column(1).to_pylist()])
            offsets = np.cumsum([0, *(len(x) // 4 for x in made)], dtype=np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(made), np.int32)))
            yield pa.RecordBatch.from_arrays([b.column(0), ids], names=["row", "pieces"])

    schema = T.StructType([rows.schema["row"], T.StructField("pieces", T.ArrayType(T.IntegerType()))])
    coded = rows.where(~is_long).select("row", text.alias("text")).mapInArrow(short, schema)
    long_rows = rows.where(is_long)
    once = long_rows.groupBy(F.col("id").alias("doc_id"), "dig").agg(F.first(text).alias("text"))
    found = encode_long(once, path, chunk).select(F.col("doc_id").alias("d"), F.col("dig").alias("g"), "pieces")
    joined = long_rows.join(found, F.col("id").eqNullSafe(F.col("d")) & (F.col("dig") == F.col("g"))).select("row", "pieces")
    names = [c for c in docs.columns if c.lower() != "pieces"]
    return coded.unionByName(joined).select(*(F.col("row").getField(c).alias(c) for c in names), "pieces")


def decode(coded: DataFrame, column: str = "pieces", into: str = "decoded", path: str | None = None) -> DataFrame:
    """Adds the text that an array of ids stands for; null ids give an empty text.

    Native: every id's bytes, as hexadecimal digits, come from one constant array.
    """
    v = vocabulary(path or model_path())
    digits = [bytes([v.bytes_of[i]]).hex() if i in v.bytes_of else w.encode().hex() for i, w in enumerate(v.written)]
    table = F.split(F.lit(",".join(digits)), ",")
    ids = F.coalesce(F.col(f"`{column}`"), F.array().cast("array<int>"))
    text = F.unhex(F.array_join(F.transform(ids, lambda i: F.get(table, i)), "")).cast("string")
    return coded.withColumn(into, let(text, lambda t: F.when(t.startswith(" "), F.substring(t, 2, (1 << 31) - 1)).otherwise(t)))
