import random

import pytest
from helpers import odd_docs, odd_frame, ordered, rows_of
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskframe.llm import token_counts as C
from riskframe.sources.scratch import scratch_path


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(C.tokenizer_path())


def want(library, rows):
    counts = [(r[0], len((r[1] or "").encode()), len(library.encode(r[1] or "", add_special_tokens=False).ids)) for r in rows]
    return ordered((i, b, n, n > 1024) for i, b, n in counts)


def test_counts_and_cache(spark, library):
    docs, cache = odd_frame(spark), scratch_path(spark, "test-cache")
    columns = ("doc_id", "n_bytes", "n_tokens", "over_limit")
    first = C.token_counts(docs.where("doc_id % 2 = 0"), cache)
    assert rows_of(first, *columns) == want(library, [r for r in odd_docs() if r[0] is not None and r[0] % 2 == 0])
    before = spark.read.parquet(cache).count()
    assert rows_of(C.token_counts(docs, cache), *columns) == want(library, odd_docs())
    after = spark.read.parquet(cache)
    assert after.count() == after.select("digest").distinct().count() > before
    C.token_counts(docs, cache).count()
    assert spark.read.parquet(cache).count() == after.count()
    # Another tokenizer has counts of its own.
    other = C.tokenizer_path("word_bpe_49k.json")
    got = C.token_counts(docs, cache, other)
    assert rows_of(got, *columns) == want(Tokenizer.from_file(other), odd_docs())
    assert C.token_counts(docs.limit(0), cache).collect() == []
    assert C.token_counts(docs.limit(0), scratch_path(spark, "no-cache")).collect() == []


def test_both_libraries_agree_on_latin(library):
    rng = random.Random(3)
    latin = [chr(i) for i in range(C.LATIN)]
    texts = ["".join(rng.choice(latin) for _ in range(rng.randint(0, 50))) for _ in range(3000)]
    texts += ["a<|endoftext|>b", " <|endoftext|>\n", *latin, *(" " + c for c in latin), *("a" + c + "1" for c in latin)]
    count = C.counter(C.tokenizer_path(), C.tokenizer_path("byte_bpe_50k.tiktoken"))
    assert count(texts) == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert count(["日本語 “quoted” text", ""]) == [len(library.encode("日本語 “quoted” text").ids), 0]


def test_long_runs_of_blanks(library):
    texts = ["word " + " " * 1_200_000 + "end", "short", "\n" * 1_100_000, "a\t" + "\t \xa0" * 400_000]
    count = C.counter(C.tokenizer_path(), C.tokenizer_path("byte_bpe_50k.tiktoken"))
    assert count(texts) == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_hot_copies_and_hits(spark, library):
    rows = [(i, "copied text") for i in range(60)] + [(i, None) for i in range(60, 90)] + [(i, f"text {i} of its own") for i in range(90, 120)] + [(None, "copied text")]
    docs, cache = spark.createDataFrame(rows, "doc_id long, text string").withColumn("digest", F.lit("clash")), scratch_path(spark, "hot-cache")
    C.token_counts(docs.where("doc_id % 2 = 0"), cache)
    before = {r[1] or "" for r in rows if r[0] is not None and r[0] % 2 == 0}
    got = C.token_counts(docs, cache, hot=20)
    assert rows_of(got, "doc_id", "n_bytes", "n_tokens", "over_limit") == want(library, rows)
    hits = sorted((r.doc_id or -1, r.cached) for r in got.collect())
    assert hits == sorted((r[0] or -1, (r[1] or "") in before) for r in rows)
    assert {h for _, h in hits} == {True, False}
    assert all(r.cached for r in C.token_counts(docs, cache).collect())


def test_versions_tell_files_and_libraries_apart(tmp_path):
    path, ranks = C.tokenizer_path(), C.tokenizer_path("byte_bpe_50k.tiktoken")
    other = tmp_path / "ranks"
    other.write_bytes(b"IQ== 0\n")
    assert len({C.version_of(path), C.version_of(path, ranks), C.version_of(path, str(other)), C.version_of(C.tokenizer_path("word_bpe_49k.json"))}) == 4
