import random

import pytest

SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="session")
def corpus():
    """Documents with exact and near copies, shared passages and lines, hot lines, ties, nulls, empty and long texts."""
    rng = random.Random(7)
    vocab = [f"{a}{b}" for a in ("th", "Er", "on", "ñe", "st") for b in ("a", "en", "ing.", "ion", "ou,", "ä")]
    say = lambda n: [rng.choice(vocab) for _ in range(n)]
    passage, long = say(60), say(3000)
    base = say(200)
    docs = []
    for i in range(60):
        w = say(rng.randint(5, 120))
        if i % 4 == 0:
            at = rng.randint(0, len(w))
            w = w[:at] + passage + w[at:]
        if i % 5 == 0:
            w = list(base)
            for _ in range(rng.randint(0, 6)):
                w[rng.randrange(len(w))] = f"edit{rng.random():.5f}"
        docs.append(" ".join(w))
    docs += [docs[0], docs[0], docs[5], docs[0].upper(), " ".join(long), " ".join(long[:2000] + say(50))]
    block = ["one line", "two line", "three line", "four line"]
    docs += ["\n".join([" ".join(say(3)), *block, " ".join(say(3))]) for _ in range(5)]
    docs += ["\n".join(["same"] * 9), "x y " * 120, "y x " * 90, "", None, " \t\n", "one", "One", "a b c d e", "a b c d", "ÄÖ ñandú", "ÄÖ Ñandú", "end\n", "\n"]
    return list(enumerate(docs))


@pytest.fixture(scope="session")
def frame(spark, corpus):
    return spark.createDataFrame(corpus, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def odd(spark):
    """Null ids, repeated ids, repeated rows, and columns whose names clash with the operators' own."""
    t = " ".join(f"w{i}" for i in range(50))
    rows = [(None, t, "a"), (1, t, "b"), (1, t, "b"), (2, "other words that are here now", "c"), (2, t + " more", "d"), (None, None, None), (3, "", "e")]
    return spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], "doc_id long, text string, lang string, id int, n int, kept int, words int")


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
