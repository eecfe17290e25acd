"""Documents that hold every odd case, and plain Python versions of the counting rules."""

import random
import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
#: Extra columns are named like working columns of the operators.
SCHEMA = "doc_id long, text string, lang string, source string, row string, dig int, id int, size int, kept string, key string, bucket int, n int"


def prose(rng, words):
    pool = ["the", "of", "and", "river", "stone", "light", "walks", "slowly", "under", "bridge", "night", "green", "window", "paper", "seven"]
    return " ".join(rng.choice(pool) + ("" if rng.random() < 0.8 else rng.choice("abcdefg")) for _ in range(words))


def odd_docs(seed=5):
    rng = random.Random(seed)
    line = "This line is long enough to be removed when five documents hold it."
    passage = prose(rng, 120)
    texts = [None, "", " \n\t ", "one", "two words", "ß émile ▁ 日本語 \U0001f600 x"]
    texts += [prose(rng, rng.randint(5, 120)) for _ in range(25)]
    texts += [f"{prose(rng, 8)}\n  {line.upper() if i % 2 else line} \n{prose(rng, 5)}" for i in range(7)]
    texts += [prose(rng, 30) + " " + passage + " " + prose(rng, 20) for _ in range(4)]
    texts += [texts[10]] * 4 + [prose(rng, 6000), "x" * 3000, "same words " * 60]
    rows = [(i * 3 % 101, t, "en" if i % 4 else None, ["b", "a", None, "c"][i % 4], "r", i, None, 1, "k", None, 2, 3) for i, t in enumerate(texts)]
    return rows + [rows[20], rows[20], (None, texts[12], "en", "a", None, None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None, None, None, None)]


def odd_frame(spark, seed=5):
    return spark.createDataFrame(odd_docs(seed), SCHEMA)


def rows_of(df, *columns):
    """Rows as sorted tuples, nulls first."""
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=lambda r: tuple((v is not None, v) for v in r))


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, v) for v in r))
