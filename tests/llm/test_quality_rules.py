from helpers import WORDS, odd_docs, odd_frame, ordered, rows_of

from riskframe.llm import quality_rules as Q


def plain_counts(text):
    words = WORDS.findall(text or "")
    windows = {}
    for i in range(len(words) - 4):
        windows.setdefault(tuple(words[i : i + 5]), []).append(i)
    marked = {j for places in windows.values() if len(places) > 1 for i in places for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if WORDS.search(x)]
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    failed = len(words) < 10 or 100 * len(marked) > 20 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(marked), failed


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, trusted_id int")


def test_counts_match_plain_python(spark):
    extra = [(900, "a b c d e f a b c d e f g h\n#x\n#x\n| |", "en", "a", *[None] * 8), (901, "a " * 9 + "b", "en", "a", *[None] * 8)]
    docs = odd_frame(spark).unionByName(spark.createDataFrame(extra, odd_frame(spark).schema))
    trusted = Q.trusted_ids(labels(spark, [(0, 1, 0, 1), (3, 1, 0, 1), (None, 1, 0, 1), (6, 0, 0, 1), (9, None, None, None)]))
    assert trusted.count() == 2
    got = Q.quality_report(docs, trusted)
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    want = ordered((r[0], *plain_counts(r[1])) for r in [*odd_docs(), *extra])
    assert rows_of(got, "doc_id", *columns) == want
    assert all(r.kept == (not r.base_failed and r.score >= Q.THRESHOLD) for r in got.collect())


def test_unlike_the_trusted_goes_and_the_clean_stay(spark):
    clean = [(i, f"The quiet river number {i % 7} runs under a green bridge and past the old town.") for i in range(400)]
    junk = [(1000 + i, "BUY!!! NOW### $$$WIN$$$ ***FREE*** CLICK%%% HERE&&& CASH!!! DEAL### *** GO!!! NOW%%% $$$") for i in range(30)]
    docs = spark.createDataFrame(clean + junk, "doc_id long, text string")
    trusted = Q.trusted_ids(labels(spark, [(i, 1, 0, 0) for i in range(300)]))
    kept = Q.filter_quality(docs, trusted)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in clean}
    # Without trusted documents only the base rule decides.
    assert Q.filter_quality(docs, trusted.limit(0)).count() == 430


def test_all_trusted_documents_count(spark):
    many = spark.range(20_500).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    trusted = Q.trusted_ids(many.unionByName(many.limit(10)))
    assert trusted.count() == 20_500
    docs = many.selectExpr("doc_id", "concat('w', doc_id % 3, ' the river and the stone') AS text")
    # Every document is trusted: n-grams that occur are as likely in both multinomials, but for smoothing.
    assert all(abs(r.score) < 0.5 for r in Q.quality_report(docs, trusted).collect())


def test_plan_is_native_and_empty_tables_work(spark):
    docs = odd_frame(spark)
    trusted = Q.trusted_ids(labels(spark, [(0, 1, 0, 1)]))
    plan = Q.filter_quality(docs, trusted)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    assert Q.quality_report(docs.limit(0), trusted.limit(0)).collect() == []


def test_only_texts_that_may_be_trusted_move(spark, monkeypatch):
    ids = [None, *range(-300, 300), *range(40), 1 << 62]
    rows = spark.createDataFrame([(i, f"text {i}") for i in ids], "id long, body string")
    trusted = Q.trusted_ids(labels(spark, [(i, 1, 0, None) for i in (None, *range(0, 900, 3), 1 << 62)]))
    wanted = sorted(((str(i), 1 if i is not None and (0 <= i and i % 3 == 0 or i == 1 << 62) else None) for i in ids), key=str)
    shown = lambda df: sorted(((str(r.id), r.good) for r in df.collect()), key=str)
    assert shown(Q.with_good(rows, trusted)) == wanted
    plan = Q.with_good(rows, trusted)._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "bitmap_construct_agg" in plan
    # Whatever collides, and with ids of another type.
    monkeypatch.setattr(Q, "SIEVE", 16)
    assert shown(Q.with_good(rows, trusted)) == wanted
    assert shown(Q.with_good(rows, trusted.selectExpr("cast(trusted_id AS decimal(20,0)) AS trusted_id"))) == wanted
    assert {g for _, g in shown(Q.with_good(rows, trusted.limit(0)))} == {None}
