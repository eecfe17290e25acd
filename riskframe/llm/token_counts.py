"""Token counts with a digest cache.

A text is known by the SHA-256 of its UTF-8 bytes (null counts as empty), a tokenizer by the SHA-256
of its files and the versions of the libraries that read them. Counts stored for that pair are taken from the cache; each
other distinct text is encoded once, and its count is appended to the cache, a Parquet folder
partitioned by tokenizer. Texts are made distinct within each task before any of them moves, and the
counts come back to the documents by digest. Digests of HOT documents or more, at most one per HOT rows
of the table, are broadcast with their counts, so a large group of copies never meets in one task.

Counts are those of the ``tokenizers`` library for the file. Texts of Latin characters only (code
points below LATIN) are encoded by ``tiktoken`` from the same vocabulary where its ranks are given:
six times the speed, the same tokens; any other text, and one that ``tiktoken`` gives up on (about a
million blanks in a row), goes to ``tokenizers`` itself. A special token's
string inside a text is one token, as is the library's default.

Defined cases. A null or empty text has 0 bytes and 0 tokens. Repeated rows get their own result
rows. An empty table gives an empty result and leaves the cache as it is. A cache folder that holds
a count twice (two runs at once) is read as holding it once. Other columns of the documents are not
read, so no name can clash. A very long text is encoded whole, by itself.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import batch
from riskframe.sources.scratch import materialize

LIMIT = 1024
#: Latin, Latin-1 and Latin Extended: here the two libraries' character classes agree.
LATIN = 0x250
#: Copies of a text from which on its count is broadcast.
HOT = 1_000_000
CACHE = "digest binary, n_bytes long, n_tokens long, added string, tokenizer string"
#: Characters handed to the tokenizer at a time.
AT_ONCE = 1 << 20


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def version_of(path: str, ranks: str | None = None) -> str:
    """Digest of the tokenizer's files and the versions of the libraries that read them."""
    import tokenizers

    made = hashlib.sha256(tokenizers.__version__.encode())
    if ranks:
        import tiktoken

        made.update(b"/" + tiktoken.__version__.encode())
    for name in filter(None, (path, ranks)):
        with open(name, "rb") as f:
            made.update(hashlib.sha256(f.read()).digest())
    return made.hexdigest()


@lru_cache(maxsize=2)
def counter(path: str, ranks: str | None):
    """A function from a list of texts to their token counts."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    import json

    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(path)
    exact.no_truncation()
    exact.no_padding()

    def slow(texts: list[str]) -> list[int]:
        return [len(e.ids) for e in exact.encode_batch_fast(texts, add_special_tokens=False)]

    if not ranks:
        return slow
    import public_tokenizers
    import tiktoken

    with open(ranks, "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    with open(path) as f:
        special = {t["content"]: t["id"] for t in json.load(f).get("added_tokens", []) if t.get("special")}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens=special)

    def one(text: str) -> int:
        try:
            return len(fast.encode(text, allowed_special="all"))
        except ValueError:
            # Its pattern runs out of stack in about a million blanks in a row.
            return slow([text])[0]

    def count(texts: list[str]) -> list[int]:
        other = [i for i, t in enumerate(texts) if not t.isascii() and max(t) >= chr(LATIN)]
        counts = dict(zip(other, slow([texts[i] for i in other])))
        return [counts[i] if i in counts else one(t) for i, t in enumerate(texts)]

    return count


def text_digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def stored(spark, cache: str, version: str) -> DataFrame:
    """The cache's counts of one tokenizer; none where no cache is yet."""
    try:
        rows = spark.read.schema(CACHE).parquet(cache)
    except AnalysisException:
        rows = spark.createDataFrame([], CACHE)
    return rows.where(F.col("tokenizer") == version).select(F.col("digest").alias("known"), "n_bytes", "n_tokens", "added").dropDuplicates(["known"])


def encode_misses(misses: DataFrame, path: str, ranks: str | None) -> DataFrame:
    """(digest, n_bytes, n_tokens) of rows (digest, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path, ranks)
        for b in batches:
            texts, made, at = [x.as_py() for x in b.column(1)], [], 0
            while at < len(texts):
                to, size = at, 0
                while to < len(texts) and size < AT_ONCE:
                    size += len(texts[to])
                    to += 1
                made.extend(count(texts[at:to]))
                at = to
            sizes = [len(t.encode()) for t in texts]
            yield batch(digest=b.column(0), n_bytes=pa.array(sizes, pa.int64()), n_tokens=pa.array(made, pa.int64()))

    return misses.mapInArrow(run, "digest binary, n_bytes long, n_tokens long")


def token_counts(
    docs: DataFrame, cache: str, path: str | None = None, ranks: str | None = None, limit: int = LIMIT, hot: int = HOT
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit, cached. Counts that the cache lacks are added to it.

    ``cached`` says that the count was in the cache before this call.
    """
    spark = docs.sparkSession
    if path is None:
        path, ranks = tokenizer_path(), tokenizer_path("byte_bpe_50k.tiktoken")
    version, run = version_of(path, ranks), uuid.uuid4().hex
    distinct = docs.select(text_digest(F.col("text")).alias("digest"), F.coalesce("text", F.lit("")).alias("body"))
    distinct = distinct.groupBy("digest").agg(F.first("body").alias("body"))
    known = stored(spark, cache, version)
    misses = distinct.join(known, F.col("digest") == F.col("known"), "left_anti")
    made = encode_misses(misses, path, ranks).withColumns({"added": F.lit(run), "tokenizer": F.lit(version)})
    made.write.mode("append").partitionBy("tokenizer").parquet(cache)

    counts = stored(spark, cache, version).withColumn("cached", ~F.coalesce(F.col("added") == run, F.lit(False))).drop("added")
    digests = materialize(docs.select("doc_id", text_digest(F.col("text")).alias("digest")), "digests")
    many = digests.groupBy("digest").count().where(F.col("count") >= hot).select("digest")
    many = many.join(counts, F.col("digest") == F.col("known")).select(F.col("known").alias("hot"), F.struct("n_bytes", "n_tokens", "cached").alias("held"))
    rows = digests.join(F.broadcast(many), F.col("digest") == F.col("hot"), "left")
    # Rows that have their count go on under keys of their own, which no digest equals.
    own = F.concat("digest", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).cast("binary"))
    rows = rows.withColumn("key", F.when(F.col("hot").isNull(), F.col("digest")).otherwise(own))
    joined = rows.join(counts, F.col("key") == F.col("known"), "left")
    value = lambda name: F.coalesce(F.col(f"held.{name}"), F.col(name))
    return joined.select(
        "doc_id", *(value(n).alias(n) for n in ("n_bytes", "n_tokens")), (value("n_tokens") > limit).alias("over_limit"), value("cached").alias("cached")
    )
