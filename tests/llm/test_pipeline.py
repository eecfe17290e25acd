import os

import pytest
from helpers import odd_frame

import corpus_pipeline

SMALL = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")
def test_pipeline_matches_its_parts(spark):
    import test_line_dedup
    import test_quality_rules
    import test_simhash
    from riskframe.llm import mixing, pieces, quality_rules
    from riskframe.llm.common import read

    docs = read(spark, SMALL, "documents")
    out = corpus_pipeline.run(spark, SMALL)
    assert out.columns == [*docs.columns, "pieces"]
    rows = {r.doc_id: r.text for r in docs.collect()}
    report = quality_rules.quality_report(docs, quality_rules.trusted_ids(read(spark, SMALL, "labels"))).collect()
    for r in report:
        assert r.base_failed == test_quality_rules.plain_counts(rows[r.doc_id])[-1]
    kept = [(r.doc_id, rows[r.doc_id]) for r in report if r.kept]
    cut = [(i, t) for i, t, _, _ in test_line_dedup.plain(kept)]
    of, first = test_simhash.groups([test_simhash.plain_print(t) for _, t in cut]), {}
    for (i, _), g in zip(cut, of):
        first[g] = min(first.get(g, i), i)
    stay = {i: t for i, t in cut if i in set(first.values())}
    found = out.collect()
    assert {r.doc_id: r.text for r in found}.items() <= stay.items()
    source = {r.doc_id: r.source for r in docs.collect()}
    left = spark.createDataFrame([(i, t, source[i]) for i, t in stay.items()], "doc_id long, text string, source string")
    times = {r.doc_id: r.taken // r.size for r in mixing.mix_report(left).collect() if r.size}
    assert {i: n for i, n in times.items() if n} == {i: sum(r.doc_id == i for r in found) for i in {r.doc_id for r in found}}
    vocabulary = pieces.vocabulary(pieces.model_path())
    assert all(vocabulary.decode(r.pieces) == r.text for r in found)


def test_stages_take_odd_and_empty_documents(spark, tmp_path):
    spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for docs in (odd_frame(spark), odd_frame(spark).limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == [*docs.columns, "pieces"][: len(out.columns)] and set(docs.columns) <= set(out.columns)
            out.collect()


def test_last_stage_decodes(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a whole text"), (2, None)], "doc_id long, text string")
    assert corpus_pipeline.encoded(spark, docs, "").count() == 2
    decode = corpus_pipeline.pieces.decode
    monkeypatch.setattr(corpus_pipeline.pieces, "decode", lambda coded, column, into: decode(coded.limit(0), column, into).unionByName(coded.selectExpr("*", f"'other' AS `{into}`")))
    with pytest.raises(Exception, match="do not decode"):
        corpus_pipeline.encoded(spark, docs, "").collect()
