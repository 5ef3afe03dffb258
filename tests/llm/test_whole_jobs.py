"""Cases in which an operator once did less than the whole job."""

import random

import numpy as np
import pytest

import corpus_pipeline
from sparkloom.llm import language_id, minmax_dedup, queries
from tests.llm import brute

SCHEMA = "doc_id long, text string"


def near_at(docs, percent):
    """Ids that stay when of each group of near copies the least id stays; written from the definition."""
    sets = {}
    for d, text in docs:
        w = brute.WORD.findall(brute.lower(text))
        sets[d] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    least = {d: d for d in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                common = len(sets[a] & sets[b])
                if a < b and common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common) and least[a] != least[b]:
                    least[a] = least[b] = min(least[a], least[b])
                    changed = True
    return {d for d in sets if least[d] == d}


def test_pipeline_drops_near_copies_from_080(spark, corpus):
    say = lambda n, rng=random.Random(3): [f"v{rng.randrange(10**6)}" for _ in range(n)]
    w = say(204)  # 200 shingles; with the last 20 words changed 180 in common of 220: J = 0.818; with 24, 176 of 224: 0.786
    docs = [(d, t) for d, t in corpus] + [(1000, " ".join(w)), (1001, " ".join(w[:-20] + say(20))), (1002, " ".join(w[24:] + say(24)))]
    want = near_at(docs, 80)
    assert 1001 in near_at(docs, 85) and 1001 not in want and 1002 in want
    got = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(docs, SCHEMA).repartition(5), "")
    assert {r.doc_id for r in got.collect()} == want


def test_pipeline_keeps_what_brute_force_keeps_at_080(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    kept = [(d, t) for d, t, _, _ in brute.identified(docs)]
    kept = [(d, t) for (d, t), e in zip(kept, brute.exact(kept), strict=True) if e[3]]
    stay = near_at(kept, 80)
    assert len(near_at(kept, 85) - stay) == 2
    want = set()
    for d, t in kept:
        w, hit, _ = brute.hit_words(t, items)
        if d in stay and len(hit) <= 0.5 * len(w):
            want.add(d)
    assert {r.doc_id for r in corpus_pipeline.run(spark, sf).select("doc_id").collect()} == want


def test_language_model_query_keeps_n_grams_that_occur_once(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, queries.op6_lm_scoring(spark, sf).collect()))
    want = sorted(brute.lm(docs, least=1))
    for a, b in zip(got, want, strict=True):
        assert a[:5] == b[:5]
        assert a[5] == pytest.approx(b[5], abs=1e-6) and a[6] == pytest.approx(b[6], abs=2e-4 * b[2])
    pruned = {x[0]: x[6] for x in brute.lm(docs, least=2)}
    assert any(abs(pruned[a[0]] - a[6]) > 2e-4 * a[2] for a in got)


def test_later_rounds_use_all_texts_of_a_repeated_id(spark, monkeypatch):
    say = lambda n, rng=random.Random(5): [f"u{rng.randrange(10**6)}" for _ in range(n)]
    long = say(120)
    docs = [(1, " ".join(say(90))), (2, " ".join(say(20))), (2, " ".join(long)), (3, " ".join(long[:-4] + say(4)))]
    # One bucket, and one pivot a round: document 2 is the third round's, and its smaller text comes first.
    monkeypatch.setattr(minmax_dedup, "bands", lambda found, count: np.zeros(count, np.int64))
    monkeypatch.setattr(minmax_dedup, "SALT_STEP", 1)
    got = sorted(map(tuple, minmax_dedup.op1(spark, spark.createDataFrame(docs, SCHEMA)).collect()))
    assert got == sorted(brute.near(docs)) and got[-1][2] == 2


def test_more_labels_than_a_task_holds(spark):
    docs = [(i, f"word{i} and some others " * 3, f"x{i % 600:03}") for i in range(1200)]
    frame = lambda n: spark.createDataFrame(docs, SCHEMA + ", lang string").coalesce(1).repartition(n)
    languages, table = language_id.train(frame(1))
    assert languages == sorted({x[2] for x in docs})
    for lang in (0, 299, 599):
        seen = sum(language_id.gram_counts(t.encode()) for _, t, x in docs if x == languages[lang]) + 1
        want = (1 - language_id.BACKGROUND) * seen / seen.sum() + language_id.BACKGROUND / language_id.BUCKETS
        assert table[lang] == pytest.approx(np.log(want))
    assert (language_id.train(frame(8))[1] == table).all()


def test_pipeline_stage_with_many_labels(spark):
    docs = [(i, f"word{i} and some others " * 3, f"x{i:03}", "web") for i in range(300)]
    frame = spark.createDataFrame(docs, SCHEMA + ", lang string, source string").coalesce(1)
    got = corpus_pipeline.identify_language(spark, frame, "")
    assert got.columns == frame.columns and {r.doc_id for r in got.collect()} <= {x[0] for x in docs}
