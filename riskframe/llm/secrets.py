"""Secret scans: three fixed kinds, and a battery of randomness tests with false-discovery control.

Beside assignments, access keys and hex strings, every token of TOKEN characters or more is tested.
Its encoding is the smallest alphabet that holds its characters (padding left out). Against
uniformity over that alphabet: a chi-squared test of the symbols' counts, a runs test of symbols
below and above the middle, and a test of the serial correlation of neighbouring symbols; a token that
any of them finds non-uniform at STRICT is no secret. Against ordinary text: the probability that
characters drawn as the corpus draws them, within that alphabet, are spread as evenly as the token's.
Short tokens can't tell the two apart and get a large probability, so length is accounted for; over
all tested tokens of a length class the Benjamini-Hochberg rule then holds the share of false
discoveries at FALSE, and what passes is added as kind ``random``. Tokens that overlap a span of the
fixed kinds are not tested and count in no class.

Power, measured with sf0.01's characters on random base64 tokens that are alone in their class: 43 %
pass at 20 characters, 72 % at 22, 87 % at 24, 99 % at 32, all of 1,500 at 40. The median
probability is 0.012, 0.006, 0.004, 0.0009 and 0.0001. Among m tested tokens a single one passes
only below FALSE / m, so tokens under about 24 characters are found only where they are many.

The means and variances of the count statistic are exact for multinomial draws. The corpus gives the
tasks 256 character counts, and the driver one histogram of probabilities per length class.

Defined cases. A null text is an empty one. Repeated rows count as tokens of their own and get the
same spans; extra columns are ignored. An empty table gives an empty result. Spans count code points.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import batch
from riskframe.sources.scratch import materialize

# The three kinds in order, their patterns and least lengths. The assignment's keywords
# are tried only at one of their first letters, and runs too short to count are not matched at all:
# leftmost matches that do not overlap are the same.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(?=[pstak])(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_CHARS, ACCESS_CHARS = 12, 18

TOKEN = 20
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{TOKEN},}}")
STRICT = 1e-3
FALSE = 0.01
#: Length classes are factors of sqrt(2); probabilities are binned by a tenth of a decade.
BINS, TENTHS = 64, 300

_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Alphabets from the smallest on; "-" and "_" are the file-name forms of "+" and "/".
ALPHABETS = (
    _DIGITS, _DIGITS + _LOWER[:6], _DIGITS + _UPPER[:6], _LOWER, _UPPER, _DIGITS + _LOWER, _DIGITS + _UPPER,
    _LOWER + _UPPER, _DIGITS + _LOWER + _UPPER, _DIGITS + _LOWER + _UPPER + "+/",
)
_SETS = [frozenset(a + ("-_" if "+" in a else "")) for a in ALPHABETS]
_PLACE = [{c: i for i, c in enumerate(a)} | ({"-": 62, "_": 63} if "+" in a else {}) for a in ALPHABETS]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed kinds, in order."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_CHARS]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_CHARS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def tail(z: float) -> float:
    """P(Z >= z) of the standard normal distribution."""
    return 0.5 * math.erfc(z / math.sqrt(2))


def spread(n: int, s2: float, s3: float) -> tuple[float, float]:
    """Mean and standard deviation of sum c(c-1) over the counts of n draws with sums of squares and cubes s2, s3."""
    pairs = n * (n - 1)
    variance = 4 * pairs * (n - 2) * s3 + 2 * pairs * s2 - 2 * pairs * (2 * n - 3) * s2 * s2
    return pairs * s2, math.sqrt(max(variance, 1e-9))


def battery(token: str, text_sums: list[tuple[float, float]]) -> tuple[float, float]:
    """(least probability of the uniformity tests, probability under ordinary text)."""
    symbols = token.replace("=", "")
    used, n = set(symbols), len(symbols)
    if n < TOKEN:
        return 0.0, 1.0
    kind = next(i for i, s in enumerate(_SETS) if used <= s)
    place, size = _PLACE[kind], len(ALPHABETS[kind])
    at = np.fromiter((place[c] for c in symbols), np.int64, n)
    counts = np.bincount(at, minlength=size)
    same = float((counts * (counts - 1)).sum())
    mean, sd = spread(n, 1 / size, 1 / size**2)
    uniform = tail((same - mean) / sd)
    high = at >= size / 2
    runs, above = 1 + int((high[1:] != high[:-1]).sum()), int(high.sum())
    expected = 2 * above * (n - above) / n + 1
    deviation = math.sqrt(max((expected - 1) * (expected - 2) / (n - 1), 1e-9))
    by_runs = 2 * tail(abs(runs - expected) / deviation) if 0 < above < n else 0.0
    centred = at - at.mean()
    power = float((centred**2).sum())
    serial = 2 * tail(abs(float((centred[1:] * centred[:-1]).sum()) / power + 1 / n) * math.sqrt(n)) if power else 0.0
    mean, sd = spread(n, *text_sums[kind])
    return min(uniform, by_runs, serial), tail((mean - same) / sd)


def length_class(n: int) -> int:
    return min(BINS - 1, int(2 * math.log2(n)))


def tenth(p: float) -> int:
    return min(TENTHS - 1, int(-10 * math.log10(max(p, 1e-300))))


def text_sums(docs: DataFrame) -> list[tuple[float, float]]:
    """Per alphabet the sums of squares and cubes of its symbols' shares in all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(256, np.int64)
        for b in batches:
            for text in b.column(0):
                if text.is_valid:
                    total += np.bincount(np.frombuffer(text.as_buffer(), np.uint8), minlength=256)
        yield batch(byte=pa.array(range(256), pa.int32()), n=pa.array(total, pa.int64()))

    rows = docs.select(F.col("text").cast("binary")).mapInArrow(count, "byte int, n long").groupBy("byte").agg(F.sum("n")).collect()
    counts = dict(rows)
    sums = []
    for place in _PLACE:
        own = np.zeros(max(place.values()) + 1)
        for c, i in place.items():
            own[i] += counts.get(ord(c), 0)
        share = own / own.sum() if own.sum() else np.full(len(own), 1 / len(own))
        sums.append((float((share**2).sum()), float((share**3).sum())))
    return sums


def scanned(docs: DataFrame) -> DataFrame:
    """(doc_id, starts, kinds, ends, token_starts, token_ends, classes, tenths): base spans, and the tokens the battery lets through."""
    sums = text_sums(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans, tokens = [], []
            for text in b.column(1).to_pylist():
                text = text or ""
                own, found, taken = base_spans(text), [], -1
                edges = [(s, e) for s, _, e in own]
                for m in CANDIDATE.finditer(text):
                    start, end = m.span()
                    while edges and edges[0][1] <= start:
                        taken = max(taken, edges.pop(0)[1])
                    free = taken <= start and not any(s < end for s, e in edges[:4] if e > start)
                    if not free:
                        continue
                    uniform, ordinary = battery(m.group(), sums)
                    # Every tested token counts in its class; those that can't be secrets with probability 1.
                    p = ordinary if uniform >= STRICT else 1.0
                    found.append((start, end, length_class(end - start), tenth(p)))
                spans.append(own)
                tokens.append(found)
            ints = lambda rows, k: pa.array([[x[k] for x in row] for row in rows], pa.list_(pa.int32()))
            yield batch(
                doc_id=b.column(0), starts=ints(spans, 0), kinds=ints(spans, 1), ends=ints(spans, 2),
                token_starts=ints(tokens, 0), token_ends=ints(tokens, 1), classes=ints(tokens, 2), tenths=ints(tokens, 3),
            )

    names = ("starts", "kinds", "ends", "token_starts", "token_ends", "classes", "tenths")
    schema = "doc_id long, " + ", ".join(f"{n} array<int>" for n in names)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def cuts(histogram: dict[tuple[int, int], int], false: float = FALSE) -> dict[int, int]:
    """Benjamini-Hochberg per length class: the bin from which on (towards smaller p) tokens are discoveries."""
    out = {}
    for c in {c for c, _ in histogram}:
        total, below = sum(n for (k, _), n in histogram.items() if k == c), 0
        for t in range(TENTHS - 1, -1, -1):
            below += histogram.get((c, t), 0)
            # The bin's largest probability.
            if below and 10 ** (-t / 10) * total <= false * below:
                out[c] = t
    return out


def find_secrets(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, ``base`` and ``spans`` as arrays of struct<kind, start, end>."""
    rows = materialize(scanned(docs), "secret-spans")
    tokens = rows.select(F.explode(F.arrays_zip("classes", "tenths")).alias("t")).groupBy("t.classes", "t.tenths").count()
    # At most BINS * TENTHS numbers.
    limits = cuts({(r["classes"], r["tenths"]): r["count"] for r in tokens.collect()})
    limit = F.array(*(F.lit(limits.get(c, TENTHS)) for c in range(BINS)))
    span = lambda s, k, e: F.struct(s.alias("start"), k.alias("nth"), e.alias("end"))
    base = F.transform(F.arrays_zip("starts", "kinds", "ends"), lambda x: span(x["starts"], x["kinds"], x["ends"]))
    passed = F.filter(F.arrays_zip("token_starts", "token_ends", "classes", "tenths"), lambda x: x["tenths"] >= F.get(limit, x["classes"]))
    added = F.transform(passed, lambda x: span(x["token_starts"], F.lit(KINDS.index("random")), x["token_ends"]))
    kind = F.array(*map(F.lit, KINDS))
    named = lambda a: F.transform(a, lambda x: F.struct(F.get(kind, x["nth"]).alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    return rows.select("doc_id", named(base).alias("base"), named(F.sort_array(F.concat(base, added))).alias("spans"))


def base_digest(text: str | None) -> str:
    """What the query's base_sha256 is for one text."""
    return hashlib.sha256(written(base_spans(text or "")).encode()).hexdigest()
