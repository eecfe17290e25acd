import random
import zlib

import numpy as np
from helpers import odd_frame

from riskframe.llm import language_id as L

POOLS = {
    "en": "the of and river stone light walks slowly under bridge night green window paper seven thing where house".split(),
    "de": "der und fluss stein licht geht langsam unter brücke nacht grün fenster papier sieben straße größe haus".split(),
    "es": "el de y río piedra luz camina despacio bajo puente noche verde ventana papel siete niño calle casa".split(),
}


def corpus(n=240):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        lang = list(POOLS)[i % 3]
        rows.append((i, " ".join(rng.choice(POOLS[lang]).capitalize() if j % 9 == 0 else rng.choice(POOLS[lang]) for j in range(40)), lang))
    return rows


def test_held_out_accuracy(spark):
    rows = corpus()
    wrong = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 4 == 2 else lang) for i, t, lang in rows]  # must not be learned from
    extra = [(900, None, "en"), (901, "", "en"), (902, "12 34 !! ² ½", "de"), (None, "the river and the stone", "es"), (904, "qqqq xxxx zzzz " * 30, None)]
    docs = spark.createDataFrame([*wrong, *extra, wrong[0]], "doc_id long, text string, lang string")
    got = {}
    for r in L.identify(docs).collect():
        got.setdefault(r.doc_id, r)
        assert 0 <= r.score <= 1 and r.lang_pred in {*POOLS, "und"}
    for i, _, lang in rows:
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert got[i].lang_pred == lang
    assert [got[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3 and got[901].score == 0
    assert got[None].lang_pred == "en" and got[None].held_out is False
    assert got[904].rejected and not any(got[i].rejected for i, _, _ in rows)


def test_probabilities_sum_to_one():
    grams = [g for w in POOLS["en"] for g in L.grams_of(w)]
    unique, counts = np.unique(grams, return_counts=True)
    model = L.Model(list(unique), counts)
    letters = sorted({g[-1] for g in unique})
    for context in ("\x02\x02\x02\x02", "\x02\x02th", "iver", "qqqq"):
        costs = model.costs(L.codes_of([context + c for c in letters]))
        assert 0.9 < np.exp(-costs).sum() <= 1 + 1e-6


def test_nothing_to_learn_and_empty(spark):
    docs = spark.createDataFrame([(1, "some text", None), (2, None, "en")], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in L.identify(docs).collect()} == {"und"}
    assert L.identify(odd_frame(spark).limit(0)).collect() == []
    assert L.identify(odd_frame(spark)).count() == odd_frame(spark).count()


def test_word_cache_resets(monkeypatch):
    monkeypatch.setattr(L, "KEPT", 5)
    unique, counts = np.unique([g for w in POOLS["en"] for g in L.grams_of(w)], return_counts=True)
    model = L.Model(list(unique), counts)
    texts = ["the river", "stone light walks", "the bridge and the night window paper seven house", "the river"]
    once = np.concatenate([L.Scorer([model]).entropies([t]) for t in texts])
    assert np.allclose(L.Scorer([model]).entropies(texts), once)


def test_every_learning_document_is_counted(spark):
    rng = random.Random(8)
    text = lambda pool: " ".join(rng.choice(pool) for _ in range(12))
    greek = "ποτάμι πέτρα φως περπατά αργά κάτω γέφυρα νύχτα πράσινο παράθυρο".split()
    rows = [(i, text(POOLS["en"]), "en") for i in range(400)] + [(1000 + i, text(greek if i % 100 == 7 else POOLS["es"]), "sx") for i in range(400)]
    docs = spark.createDataFrame([*rows, *rows[:20]], "doc_id long, text string, lang string")
    languages = L.learn(docs, 10)
    assert languages.names == ["en", "sx"] and np.isfinite(languages.limits).all()
    rare = L.gram_hashes(L.codes_of([g for w in greek for g in L.grams_of(w)]), 0)
    assert np.isin(rare, languages.models[1].grams).all()
    asked = spark.createDataFrame([(1, "πέτρα περπατά νύχτα"), (2, "river bridge"), (3, "noche verde")], "doc_id long, text string")
    assert {r.doc_id: r.lang_pred for r in L.identify(asked, languages).collect()} == {1: "sx", 2: "en", 3: "sx"}


def test_models_equal_those_of_plain_counts(spark):
    rows = [(t, lang) for _, t, lang in corpus(30)] + [("ᾳ \U00010400\U00010401 ß", "de")]
    docs = spark.createDataFrame([(lang, t) for t, lang in rows], "lang string, text string")
    every = L.gram_tables(L.gram_counts(docs))
    grams, contexts = (t.toArrow().to_pandas() for t in L.model_tables(every))
    for name in POOLS:
        unique, counts = np.unique([g for t, lang in rows if lang == name for w in L.letters(t) for g in L.grams_of(w)], return_counts=True)
        want = L.Model(list(unique), counts)
        own, around = grams[grams["lang"] == name], contexts[contexts["lang"] == name]
        got = L.Model.made(
            every.where(f"lang = '{name}' AND order = 1").count(),
            (own["hash"].to_numpy().view(np.uint64), own["value"].to_numpy()), (around["hash"].to_numpy().view(np.uint64), around["value"].to_numpy()),
        )
        assert got.uniform == want.uniform
        assert (got.grams == want.grams).all() and np.allclose(got.probs, want.probs)
        assert (got.contexts == want.contexts).all() and np.allclose(got.weights, want.weights)


def test_repeated_rows_do_not_hide_a_language(spark):
    rows = [(i, "the river and the stone " * 3, "en") for i in range(300)]
    rows += [(1000, "noche verde ventana papel siete", "es")] * 3000 + [(1001 + i, f"piedra luz camina {w} despacio", "es") for i, w in enumerate(POOLS["es"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    texts, others = L.learning(docs, 10)
    learned = {(t, lang) for i, t, lang in rows if zlib.crc32(str(i).encode()) % 4 != 2}
    assert {(r.text, r.lang) for r in texts.unionByName(others).collect()} == learned
    distinct = len({(i, t) for i, t, lang in rows if lang == "es" and zlib.crc32(str(i).encode()) % 4 != 2})
    assert others.where("lang = 'es'").count() == min(10, distinct // 5)
    assert texts.where("lang = 'es'").count() == distinct - min(10, distinct // 5)
