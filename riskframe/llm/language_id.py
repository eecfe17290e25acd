"""Language identification by interpolated Kneser-Ney character models.

One model of order ORDER per language, over the letters of lower-cased words with word ends marked.
A model is two sorted hash arrays, of n-grams with their discounted probabilities and of contexts
with the weight of the next lower order. A text gets the language with the lowest cross-entropy per
character. Where even that is higher than all but 1 - ACCEPTED of the language's own texts had, on
learning texts kept out of the counts, and by MARGIN nats, the prediction is marked as rejected.

Learning counts the n-grams of every learning document in Spark: tasks add up their own words before
the shuffle, and lower orders, discounts and context weights are aggregates of the n-grams' table.
The models, one number per n-gram and context, come to the driver and go to every task. Only
calibration takes a bounded sample: the SAMPLE documents of each language with the smallest hash of
id and text, at most one in five, which are not counted. Prediction covers every whole text.

Defined cases. A null text and one without a letter is ``und`` with score 0; so is every text where
no language was learned. Ties go to the language first by code point. Rows with a null id are
neither held out nor learned from. Repeated rows are learned from once and predicted alike. A very long
text is scored whole. Only doc_id, text and, to learn, lang are read, so other columns cannot clash. An
empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import batch, digest
from riskframe.sources.scratch import materialize

ORDER = 5
#: Documents of each language that are kept for calibration, at most.
SAMPLE = 400
SEED = 77
ACCEPTED = 0.99
MARGIN = 0.25
#: How steeply the score follows the gap in nats per character.
STEEPNESS = 20.0
UNKNOWN = "und"
#: Words kept per task, about, and texts whose new words are looked up together.
KEPT, AT_ONCE = 300_000, 500
#: A task passes its counts on after so many distinct words.
HELD = 300_000

BEGIN, END = "\x02", "\x03"
_WORD = re.compile(r"[^\W\d_]+")


def letters(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def grams_of(word: str) -> Iterator[str]:
    """The ORDER-grams of a word, one for each of its characters and its end."""
    padded = BEGIN * (ORDER - 1) + word + END
    return (padded[i : i + ORDER] for i in range(len(word) + 1))


def gram_hashes(codes: np.ndarray, tag: int) -> np.ndarray:
    """64-bit hashes of rows of code points; ``tag`` tells n-grams from contexts, the width orders apart."""
    h = np.full(len(codes), (tag * 64 + codes.shape[1]) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF, np.uint64)
    for column in codes.T:
        h = (h ^ column.astype(np.uint64)) * np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(32)
    return h


def codes_of(grams: list[str]) -> np.ndarray:
    return np.frombuffer("".join(grams).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(grams), -1)


class Model:
    """One language: sorted hashes of n-grams and contexts, and their numbers."""

    def __init__(self, grams: list[str], counts: np.ndarray):
        codes, probs, weights = codes_of(grams), [], []
        alphabet = len(np.unique(codes[:, -1])) + 1
        self.uniform = 1.0 / alphabet
        for order in range(ORDER, 0, -1):
            hashes = gram_hashes(codes, 0)
            contexts = gram_hashes(codes[:, :-1], 1) if order > 1 else np.zeros(len(codes), np.uint64)
            once, twice = (counts == 1).sum(), (counts == 2).sum()
            discount = once / (once + 2 * twice) if once else 0.5
            unique, at = np.unique(contexts, return_inverse=True)
            totals = np.bincount(at, weights=counts)
            probs.append((hashes, np.maximum(counts - discount, 0) / totals[at]))
            weights.append((unique, np.bincount(at, weights=np.minimum(counts, discount)) / totals))
            # Below the highest order an n-gram counts as often as it has different characters before it.
            codes, counts = np.unique(codes[:, 1:], axis=0, return_counts=True) if order > 1 else (codes, counts)
        # The context of order 1 is empty: one weight, under one hash.
        self.grams, self.probs = self._sorted(probs)
        self.contexts, self.weights = self._sorted(weights)

    @classmethod
    def made(cls, alphabet: int, grams: tuple[np.ndarray, np.ndarray], contexts: tuple[np.ndarray, np.ndarray]) -> Model:
        """From the hashes and numbers that ``model_tables`` gives, and the number of different characters."""
        model = cls.__new__(cls)
        model.uniform = 1.0 / (alphabet + 1)
        model.grams, model.probs = cls._sorted([grams])
        model.contexts, model.weights = cls._sorted([contexts])
        return model

    @staticmethod
    def _sorted(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        keys, values = np.concatenate([k for k, _ in parts]), np.concatenate([v for _, v in parts])
        order = np.argsort(keys)
        return keys[order], values[order].astype(np.float32)

    def costs(self, codes: np.ndarray) -> np.ndarray:
        """-log P of the last character of each row after the others."""
        p = np.full(len(codes), self.uniform)
        for order in range(1, ORDER + 1):
            own = codes[:, ORDER - order :]
            contexts = gram_hashes(own[:, :-1], 1) if order > 1 else np.zeros(len(codes), np.uint64)
            weight = look_up(self.contexts, self.weights, contexts, 1.0)
            p = look_up(self.grams, self.probs, gram_hashes(own, 0), 0.0) + weight * p
        return -np.log(p)


def look_up(keys: np.ndarray, values: np.ndarray, asked: np.ndarray, default: float) -> np.ndarray:
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[at] == asked, values[at], default)


class Scorer:
    """Cross-entropies of texts under all models; costs of n-grams and of words are kept while a task runs."""

    def __init__(self, models: list[Model]):
        self.models = models
        self.reset()

    def reset(self) -> None:
        self.at: dict[str, int] = {}
        self.rows = np.zeros((1024, len(self.models) + 1), np.float64)
        self.known = np.zeros(0, np.uint64)
        self.costs = np.zeros((0, len(self.models)))

    def learn_words(self, words: list[str]) -> None:
        """Costs of new words: sums over their n-grams, each distinct n-gram looked up once."""
        first = len(self.at)
        while len(self.rows) < first + len(words):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        sizes = np.fromiter((len(w) + 1 for w in words), np.int64, len(words))
        line = np.frombuffer("".join(BEGIN * (ORDER - 1) + w + END for w in words).encode("utf-32-le", "surrogatepass"), np.uint32)
        # Places in the padded line at which an n-gram of a word ends.
        owner = np.repeat(np.arange(len(words)), sizes)
        place = np.arange(len(owner)) + (owner + 1) * (ORDER - 1)
        codes = np.stack([line[place - ORDER + 1 + k] for k in range(ORDER)], axis=1)
        hashes = gram_hashes(codes, 0)
        unique, sample, back = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.known, unique)
        old = np.zeros(len(unique), bool) if not len(self.known) else self.known[np.minimum(at, len(self.known) - 1)] == unique
        costs = np.zeros((len(unique), len(self.models)))
        if old.any():
            costs[old] = self.costs[at[old]]
        if not old.all():
            fresh = codes[sample[~old]]
            costs[~old] = np.stack([m.costs(fresh) for m in self.models], axis=1)
            keys = np.concatenate([self.known, unique[~old]])
            order = np.argsort(keys)
            self.known, self.costs = keys[order], np.concatenate([self.costs, costs[~old]])[order]
        starts = np.r_[0, np.cumsum(sizes)[:-1]]
        self.rows[first : first + len(words), :-1] = np.add.reduceat(costs[back], starts, axis=0)
        # Runs of characters that are numerals and no letters count for nothing.
        self.rows[first : first + len(words), -1] = [n if any(map(str.isalpha, w)) else 0 for w, n in zip(words, sizes)]
        for i in np.flatnonzero(self.rows[first : first + len(words), -1] == 0):
            self.rows[first + i] = 0
        self.at.update(zip(words, range(first, first + len(words))))

    def entropies(self, texts: list[str | None]) -> np.ndarray:
        """[text, model] nats per character, NaN for texts without letters."""
        out = np.full((len(texts), len(self.models)), np.nan)
        if not self.models:
            return out
        for at in range(0, len(texts), AT_ONCE):
            split = [letters(t) for t in texts[at : at + AT_ONCE]]
            if len(self.at) > KEPT:
                self.reset()
            fresh = list({w for words in split for w in words if w not in self.at})
            if fresh:
                self.learn_words(fresh)
            for i, words in enumerate(split, at):
                if words:
                    total = self.rows[np.fromiter(map(self.at.__getitem__, words), np.int64, len(words))].sum(axis=0)
                    if total[-1]:
                        out[i] = total[:-1] / total[-1]
        return out


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


class Languages:
    """The learned languages with their models and the entropies from which on a text is rejected."""

    def __init__(self, names: list[str], models: list[Model]):
        self.names, self.models, self.limits = names, models, np.full(len(names), np.inf)


def learning(docs: DataFrame, size: int = SAMPLE) -> tuple[DataFrame, DataFrame]:
    """(lang, text) of all learning documents to count, and of at most ``size`` of each language to calibrate by.

    Repeated rows are one document: documents are numbered and thinned by distinct hashes.
    """
    may = ~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull()
    rows = docs.where(may).select("lang", "text", F.xxhash64(F.lit(SEED), "doc_id", digest(F.col("text"))).alias("h"))
    keys = materialize(rows.select("lang", "h").distinct(), "language-keys")
    # One row per language comes to the driver, then about 2 * size hashes of each.
    total = dict(keys.groupBy("lang").count().collect())
    bound = {lang: min((1 << 63) - 1, ((2 * size + 50) << 64) // n - (1 << 63)) for lang, n in total.items()}
    least = keys.where(F.col("h") <= _each(bound, "long")).groupBy("lang").agg(F.sort_array(F.collect_list("h")).alias("h"))
    last = {}
    for lang, hashes in least.collect():
        if taken := hashes[: min(size, total[lang] // 5)]:
            last[lang] = taken[-1]
    kept = F.coalesce(F.col("h") <= _each(last, "long"), F.lit(False))
    once = lambda some: some.groupBy("lang", "h").agg(F.first("text").alias("text")).select("lang", "text")
    return once(rows.where(~kept)), once(rows.where(kept))


def _each(values: dict, kind: str) -> Column:
    """The value of the row's language, null where there is none."""
    if not values:
        return F.lit(None).cast(kind)
    return F.try_element_at(F.create_map(*(x for lang, v in values.items() for x in (F.lit(lang), F.lit(v).cast(kind)))), F.col("lang"))


def gram_counts(texts: DataFrame) -> DataFrame:
    """(lang, gram, n) of the ORDER-grams of all texts (lang, text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, own in words.items():
                held: Counter = Counter()
                for word, n in own.items():
                    for gram in grams_of(word):
                        held[gram] += n
                yield batch(lang=pa.array([lang] * len(held), pa.string()), gram=pa.array(list(held), pa.string()), n=pa.array(list(held.values()), pa.int64()))
            words.clear()

        size = 0
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
                own = words.setdefault(lang, Counter())
                size -= len(own)
                own.update(letters(text.as_py()))
                size += len(own)
                if size >= HELD:
                    yield from flush()
                    size = 0
        yield from flush()

    return texts.mapInArrow(count, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def gram_tables(counted: DataFrame) -> DataFrame:
    """(lang, order, gram, n) of all orders, from the counts of ORDER-grams.

    Below the highest order an n-gram counts as often as it has different characters before it.
    """
    level = materialize(counted, f"grams-{ORDER}")
    every = level.select("lang", F.lit(ORDER).alias("order"), "gram", "n")
    for order in range(ORDER - 1, 0, -1):
        level = materialize(level.groupBy("lang", F.substring("gram", 2, order).alias("gram")).agg(F.count("*").alias("n")), f"grams-{order}")
        every = every.unionByName(level.select("lang", F.lit(order).alias("order"), "gram", "n"))
    return every


def model_tables(every: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lang, hash, value): discounted probabilities of n-grams, and weights of contexts."""
    times = lambda n: F.sum(F.when(F.col("n") == n, 1).otherwise(0))
    discount = F.when(times(1) > 0, times(1) / (times(1) + 2 * times(2))).otherwise(0.5)
    # One row per language and order.
    discounts = every.groupBy("lang", "order").agg(discount.alias("discount"))
    own = every.join(F.broadcast(discounts), ["lang", "order"]).withColumn("context", F.expr("substring(gram, 1, order - 1)"))
    taken = F.sum(F.least(F.col("n").cast("double"), "discount"))
    contexts = own.groupBy("lang", "order", "context").agg(F.sum("n").alias("total"), (taken / F.sum("n")).alias("weight"))
    prob = F.greatest(F.col("n") - F.col("discount"), F.lit(0.0)) / F.col("total")
    probs = own.join(contexts, ["lang", "order", "context"]).select("lang", "gram", prob.alias("prob"))
    return hashed(probs, 0), hashed(contexts.select("lang", "context", "weight"), 1)


def hashed(rows: DataFrame, tag: int) -> DataFrame:
    """Rows (lang, gram or context, value) with the string's hash; the empty context of order 1 has hash 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            strings = b.column(1).to_pylist()
            sizes, out = np.fromiter(map(len, strings), np.int64, len(strings)), np.zeros(len(strings), np.uint64)
            for n in np.unique(sizes[sizes > 0]):
                at = np.flatnonzero(sizes == n)
                out[at] = gram_hashes(codes_of([strings[i] for i in at]), tag)
            yield batch(lang=b.column(0), hash=pa.array(out.view(np.int64)), value=b.column(2).cast(pa.float32()))

    return rows.mapInArrow(run, "lang string, hash long, value float")


def learn(docs: DataFrame, size: int = SAMPLE) -> Languages:
    """Models of the languages of ``docs`` (doc_id, text, lang)."""
    texts, others = learning(docs, size)
    every = gram_tables(gram_counts(texts))
    alphabets = dict(every.where(F.col("order") == 1).groupBy("lang").count().collect())
    parts = [
        {lang: (own["hash"].to_numpy(np.int64).view(np.uint64), own["value"].to_numpy(np.float32)) for lang, own in table.toArrow().to_pandas().groupby("lang")}
        for table in model_tables(every)
    ]
    names = sorted(alphabets)
    languages = Languages(names, [Model.made(alphabets[lang], *(p[lang] for p in parts)) for lang in names])
    if names:
        calibrate(languages, others)
    return languages


def calibrate(languages: Languages, texts: DataFrame) -> None:
    """Sets each language's limit from texts (lang, text) that were not counted."""
    rows = predicted(texts.select(F.col("lang").alias("own"), "text"), languages, "own string").select("own", "lang_pred", "entropy")
    seen = rows.where("own = lang_pred").toPandas()
    for i, name in enumerate(languages.names):
        own = seen.loc[seen["own"] == name, "entropy"]
        if len(own):
            languages.limits[i] = float(np.quantile(own, ACCEPTED)) + MARGIN


def predicted(rows: DataFrame, languages: Languages, first: str) -> DataFrame:
    """Rows (key, text) as (key, lang_pred, score, entropy, rejected)."""
    sent = rows.sparkSession.sparkContext.broadcast(languages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        names, limits = [*known.names, UNKNOWN], np.r_[known.limits, np.inf]
        scorer = Scorer(known.models)
        for b in batches:
            h = scorer.entropies(b.column(1).to_pylist())
            none = np.isnan(h).all(axis=1) if known.models else np.ones(len(h), bool)
            best = np.where(none, len(names) - 1, np.argmin(np.where(np.isnan(h), np.inf, h), axis=1) if known.models else 0)
            least = h.min(axis=1) if known.models else np.full(len(h), np.nan)
            share = 1 / np.exp(-STEEPNESS * (h - least[:, None])).sum(axis=1) if known.models else np.zeros(len(h))
            yield batch(
                key=b.column(0), lang_pred=pa.array([names[i] for i in best], pa.string()), score=pa.array(np.where(none, 0.0, share), pa.float64()),
                entropy=pa.array(least, pa.float64(), from_pandas=True), rejected=pa.array(~none & (np.nan_to_num(least) > limits[best]), pa.bool_()),
            )

    return rows.mapInArrow(run, f"{first}, lang_pred string, score double, entropy double, rejected boolean")


def identify(docs: DataFrame, languages: Languages | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, entropy, rejected. Learns from ``docs`` if no models are given."""
    languages = languages or learn(docs)
    found = predicted(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), languages, "doc_id long")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "entropy", "rejected")
