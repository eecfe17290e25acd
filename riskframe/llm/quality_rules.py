"""Quality rules: plain counts per document, and a hashed n-gram log-likelihood ratio.

Two multinomials over hashed n-grams are counted: one over the whole corpus, one over trusted
documents. A document's score is the mean log ratio of the two over its n-grams, so that its
length does not matter; a document under a fixed threshold goes. The n-grams are words, and pairs
of neighbouring word shapes (runs of lower-case letters, of capitals and of digits are each
written as one character, everything else stays), as invented words are rare but their shapes
are not. Native expressions only.

Defined cases. A null or empty text has no words: it fails the base rule. A document whose n-grams
no trusted document has, scores low; without trusted documents both multinomials are the same, the
score is 0 and only the base rule decides. Repeated rows are judged alike, extra columns are kept
by ``filter_quality``, and an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import let, words

#: Buckets of either kind of n-gram. The model is this many doubles twice, whatever the corpus.
BUCKETS = 1 << 14
#: Pseudo-count of the corpus' own distribution in the trusted one.
PRIOR = 1_000.0
#: A document is kept from this mean log ratio on.
THRESHOLD = -1.0

WINDOW = 5
#: Bits of a sieve of ids, and of each of its rows (what ``bitmap_construct_agg`` makes).
SIEVE, SIEVE_ROW = 1 << 26, 1 << 15


def base_counts(text: Column) -> dict[str, Column]:
    """Counts of a text that need no corpus, all but those on words."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return {
        "n_symbols": F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[#*$%&|<>]")).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
    }


def repeated_words(hashes: Column) -> Column:
    """Words inside 5-word windows that a text holds twice or more; linear but for one sort.

    A window is known by a 64-bit hash of its words' 64-bit hashes.
    """
    windows = F.transform(F.sequence(F.lit(1), F.size(hashes) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(hashes, i, WINDOW)))

    def covered(found: Column) -> Column:
        def marked(order: Column) -> Column:
            same = lambda k, x: F.get(order, k)["h"].eqNullSafe(x["h"])
            hits = F.filter(order, lambda x, k: same(k - 1, x) | same(k + 1, x))
            start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
            step = lambda a, p: F.struct(
                (a["n"] + (p + WINDOW) - F.greatest(p, a["end"])).alias("n"), (p + WINDOW).alias("end")
            )
            return F.aggregate(F.sort_array(F.transform(hits, lambda x: x["p"])), start, step)["n"]

        pairs = F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("p")))
        return F.when(F.size(F.array_distinct(found)) == F.size(found), F.lit(0)).otherwise(let(F.sort_array(pairs), marked))

    return F.when(F.size(hashes) < WINDOW, F.lit(0)).otherwise(let(windows, covered)).cast("long")


def shapes(text: Column) -> Column:
    short = F.regexp_replace(F.coalesce(text, F.lit("")), r"\p{Ll}+", "a")
    return words(F.regexp_replace(F.regexp_replace(short, r"\p{Lu}+", "A"), r"\p{Nd}+", "0"))


def features(word_hashes: Column, shape_hashes: Column) -> Column:
    """Buckets of a text's n-grams: words below BUCKETS, pairs of shapes from there on."""
    pair = lambda all_, h, i: F.pmod(F.xxhash64(F.get(all_, i - 1), h), F.lit(BUCKETS)) + BUCKETS
    of_words = F.transform(word_hashes, lambda h: F.pmod(h, F.lit(BUCKETS)).cast("int"))
    of_shapes = let(shape_hashes, lambda s: F.transform(s, lambda h, i: pair(s, h, i).cast("int")))
    return F.concat(of_words, of_shapes)


def hashes(found: Column) -> Column:
    return F.transform(found, lambda w: F.xxhash64(w))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids of all documents labelled good and not toxic."""
    good = labels.where((F.col("quality") == 1) & (F.col("toxic") == 0) & F.col("doc_id").isNotNull())
    return good.select(F.col("doc_id").alias("trusted_id")).distinct()


def with_good(rows: DataFrame, trusted: DataFrame) -> DataFrame:
    """The rows with ``good``: 1 where ``trusted`` holds their ``id``, else null.

    ``trusted`` may grow with the corpus, so the join is a shuffle unless Spark finds it small. So that few texts
    move, a sieve of bits, of a fixed size at most, first tells the rows whose id is surely not in ``trusted``;
    ids that it lets through are compared.
    """
    flagged = trusted.withColumn("good", F.lit(1))
    joined = lambda df: df.join(flagged, F.col("id") == F.col("trusted_id"), "left").select("id", "body", "good")
    if rows.schema["id"].dataType != trusted.schema["trusted_id"].dataType:
        return joined(rows)
    bit = lambda c: F.pmod(F.xxhash64(c), F.lit(SIEVE))
    place = F.pmod(F.col("bit"), F.lit(SIEVE_ROW))
    sieve = trusted.select(bit("trusted_id").alias("bit")).groupBy(F.floor(F.col("bit") / SIEVE_ROW).alias("sieve_row"))
    sieve = sieve.agg(F.bitmap_construct_agg(place).alias("bits"))
    byte = F.conv(F.hex(F.substring("bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = F.call_function("shiftright", byte, F.pmod(place, F.lit(8)).cast("int")).bitwiseAND(F.lit(1)) == 1
    placed = rows.withColumn("bit", bit("id")).join(F.broadcast(sieve), F.floor(F.col("bit") / SIEVE_ROW) == F.col("sieve_row"), "left")
    placed = placed.select("id", "body", F.coalesce(held, F.lit(False)).alias("maybe"))
    others = placed.where(~F.col("maybe")).select("id", "body", F.lit(None).cast("int").alias("good"))
    return joined(placed.where("maybe").select("id", "body")).unionByName(others)


def ratio_model(docs: DataFrame, trusted: DataFrame) -> list[float]:
    """The log ratio of each bucket: 2 * BUCKETS numbers, whatever the corpus.

    Every n-gram of every document is counted; tasks add up their own counts before the shuffle.
    """
    rows = with_good(docs.select(F.col("doc_id").alias("id"), F.col("text").alias("body")), trusted)
    gram = features(hashes(words(F.col("body"))), hashes(shapes(F.col("body"))))
    grams = rows.select("good", F.explode(gram).alias("bucket"))
    counts = grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.count("good").alias("good"))
    every = docs.sparkSession.range(2 * BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    full = every.join(counts, "bucket", "left").select(
        "bucket", F.coalesce("raw", F.lit(0)).alias("raw"), F.coalesce("good", F.lit(0)).alias("good"), (F.col("bucket") < BUCKETS).alias("kind")
    )
    totals = F.struct("bucket", "raw", "good", "kind")
    one = full.agg(F.collect_list(totals).alias("all"), *(
        F.sum(F.when(F.col("kind") == kind, F.col(c))).alias(f"{c}_{kind}".lower()) for c in ("raw", "good") for kind in (True, False)
    ))
    total = lambda c, x: F.when(x["kind"], F.col(f"{c}_true")).otherwise(F.col(f"{c}_false"))

    def weight(x: Column) -> Column:
        raw = (x["raw"] + 1.0) / (total("raw", x) + float(BUCKETS))
        return F.log((x["good"] + PRIOR * raw) / (total("good", x) + PRIOR) / raw)

    return one.select(F.transform(F.sort_array("all"), weight).alias("weights")).first()["weights"]


def constant(weights: list[float]) -> Column:
    """The model as one constant of the plan; Spark folds it into an array before it runs."""
    return F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")


def verdict(text: Column, model: list[float], threshold: float = THRESHOLD) -> Column:
    """The counts, ``score``, ``base_failed`` and ``kept`` of a text as one struct.

    Every array of words is bound once, whatever the optimizer makes of the expression.
    """
    weights = constant(model)

    def with_words(w: Column, h: Column) -> Column:
        grams = features(h, hashes(shapes(text)))
        mean = let(weights, lambda v: let(grams, lambda g: F.aggregate(g, F.lit(0.0), lambda a, f: a + v[f]) / F.size(g)))
        return F.struct(
            F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            *(c.alias(name) for name, c in base_counts(text).items()), repeated_words(h).alias("n_repeat_words"),
            F.when(F.size(w) > 0, mean).otherwise(0.0).alias("score"),
        )

    def with_counts(c: Column) -> Column:
        failed = (c["n_words"] < 10) | (100 * c["n_repeat_words"] > 20 * c["n_words"])
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score")
        return F.struct(*(c[n].alias(n) for n in names), failed.alias("base_failed"), (~failed & (c["score"] >= threshold)).alias("kept"))

    return let(let(words(text), lambda w: let(hashes(w), lambda h: with_words(w, h))), with_counts)


def quality_report(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: counts, score, base_failed, kept."""
    return docs.select("doc_id", verdict(F.col("text"), ratio_model(docs, trusted), threshold).alias("v")).select("doc_id", "v.*")


def filter_quality(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that are kept, with all their columns."""
    return docs.where(verdict(F.col("text"), ratio_model(docs, trusted), threshold)["kept"])
