import pytest

from sparkloom.llm import decontaminate, exact_dedup, line_dedup, minmax_dedup, ngram_lm, substring_dedup
from tests.llm import brute


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def same(got, want):
    assert rows(got) == sorted(want, key=repr)


ITEMS = [(1, "Tha enou ering: stion! ERa onen ñeion thou stä oning thion era stou"), (2, "one"), (3, "a B c"), (4, None), (5, "..."), (12, "one line two line"), (None, "ñandú")]


def items_of(spark, corpus):
    """Items as above, and one that is part of a document."""
    return [*ITEMS, (100, " ".join(corpus[0][1].split()[3:17]))]


def test_near_copies(spark, frame, corpus):
    same(minmax_dedup.op1(spark, frame), brute.near(corpus))


def test_lines(spark, frame, corpus):
    same(line_dedup.op2(spark, frame), brute.lines(corpus))


def test_substrings(spark, frame, corpus, monkeypatch):
    same(substring_dedup.op4(spark, frame), brute.substrings(corpus))


def test_substrings_of_hot_anchors(spark, frame, corpus, monkeypatch):
    monkeypatch.setattr(substring_dedup, "HOT", 1)  # all windows are dealt one by one
    same(substring_dedup.op4(spark, frame), brute.substrings(corpus))


def test_own_reference(spark, frame, corpus):
    text = corpus[0][1] + " " + corpus[1][1]
    got = {r.doc_id: sum(s.t - s.f for s in r.spans) for r in substring_dedup.matching_spans(frame, [text]).collect()}
    assert got[0] == len(corpus[0][1].split()) and got[2] == 0
    with pytest.raises(ValueError):
        substring_dedup.matching_spans(frame, ["x " * 2_000_001])


def test_decontamination(spark, frame, corpus):
    items = items_of(spark, corpus)
    bench = spark.createDataFrame(items, "item_id long, text string")
    same(decontaminate.op5(spark, frame, bench), brute.contaminated(corpus, [("null" if i is None else i, t) for i, t in items]))


def test_cleaning(spark, frame, corpus):
    items = items_of(spark, corpus)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate.clean(spark, frame.selectExpr("doc_id", "text", "'x' AS lang", "length(text) AS n_chars"), bench).collect()}
    for d, t in corpus:
        w, hit, _ = brute.hit_words(t, items)
        if not hit:
            assert got[d].text == t
        elif len(hit) > 0.5 * len(w):
            assert d not in got
        else:
            assert brute.NORMAL.findall(brute.lower(got[d].text)) == [x for i, x in enumerate(w) if i not in hit]
            assert got[d].n_chars == len(got[d].text)


def test_decontamination_by_several_automata(spark, frame, corpus):
    items = [*items_of(spark, corpus), (200, " ".join(corpus[1][1].split()[:40]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for most in (12, 25):  # items are cut, and shared out among automata
        assert len(list(decontaminate.matchers(bench, most=most))) > 1
        got = decontaminate.find(spark, frame, bench, most=most).drop("spans")
        same(got, brute.contaminated(corpus, [("null" if i is None else i, t) for i, t in items]))
        one = rows(decontaminate.clean(spark, frame, bench))
        assert rows(decontaminate.clean(spark, frame, bench, most=most)) == one


def test_automaton_is_small(spark):
    import random
    import tracemalloc

    rng = random.Random(2)
    text = " ".join(str(rng.randrange(10**5)) for _ in range(20_000)).encode()
    tracemalloc.start()
    held = decontaminate.ItemMatcher([("1", text)])
    size, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert held.hits(text.split())[0] == [(0, 20_000)]
    assert size / 20_000 * decontaminate.AUTOMATON_WORDS < 300 << 20


def test_exact_copies(spark, frame, corpus):
    same(exact_dedup.op7(spark, frame), brute.exact(corpus))


def test_language_model(spark, frame, corpus):
    got = sorted(map(tuple, ngram_lm.op6(spark, frame).collect()))
    for a, b in zip(got, brute.lm(corpus), strict=True):
        assert a[:5] == b[:5]
        assert a[5] == pytest.approx(b[5], abs=1e-6) and a[6] == pytest.approx(b[6], abs=2e-4 * b[2])


def test_language_model_in_many_parts(spark, frame, corpus, monkeypatch):
    """Contexts, pairs and single texts that go on over the ends of parts and blocks."""
    hot = [(1000 + i, "the same " * 30 + f"end{i % 7} x{i}") for i in range(40)]
    docs = corpus + hot + [hot[0]]
    monkeypatch.setattr(ngram_lm, "PART_TOKENS", 120)
    monkeypatch.setattr(ngram_lm, "BLOCK_TOKENS", 700)
    monkeypatch.setattr(ngram_lm, "SHARD_WORDS", 50)
    got = sorted(map(tuple, ngram_lm.op6(spark, frame.unionByName(spark.createDataFrame([*hot, hot[0]], frame.schema))).collect()))
    for a, b in zip(got, sorted(brute.lm(docs)), strict=True):
        assert a[:5] == b[:5]
        assert a[5] == pytest.approx(b[5], abs=1e-6) and a[6] == pytest.approx(b[6], abs=2e-4 * b[2])


def test_contexts_over_the_ends_of_parts():
    """A word whose pairs lie in three parts, and a pair whose trigrams do."""
    import numpy as np

    a, b, c = (np.array(x) for x in zip(*[(1, 5, k) for k in range(30)] + [(1, 6, k) for k in range(4)] + [(1, 7 + k, 0) for k in range(9)] + [(2, 1, 1)], strict=True))
    n = np.arange(1, len(a) + 1)
    blob = lambda lo, hi: ngram_lm.pack([*np.unique(a[lo:hi], return_counts=False)[None], *_pairs(a[lo:hi], b[lo:hi]), c[lo:hi], n[lo:hi]])

    def _pairs(x, y):
        p, q, inverse = ngram_lm._unique_pairs(x, y)
        return [np.unique(p, return_counts=True)[1], q, np.bincount(inverse)]

    marks = [0, 7, 19, 32, len(a)]
    cuts = [(int(a[k]), int(b[k]), int(c[k])) for k in marks[1:-1]]
    merged = [ngram_lm._merge([blob(lo, hi)], 100) for lo, hi in zip(marks, marks[1:], strict=False)]
    parts = [ngram_lm.Part(k, "", "") for k in range(4)]
    ngram_lm._totals(parts, [ngram_lm._cut_contexts(m, cuts[max(0, k - 1) : k + 1]) for k, m in enumerate(merged)])
    total, distinct = int(n[:-1].sum()), 2 + 9
    assert {p.words[1] for p in parts} == {(total, distinct)}
    assert {p.pairs[1, 5] for p in parts[:3]} == {(int(n[:30].sum()), 30)}
    for k, (m, p) in enumerate(zip(merged, parts, strict=True)):
        shard = ngram_lm.TrieShard(ngram_lm.shard_arrays(m, p))
        # Each part is also asked for a pair and a trigram that it has nothing of.
        for asked, held in (([m[0], m[1], m[2], m[4], m[5]], shard), ([np.array([1]), np.array([1]), np.array([5]), np.array([1]), np.array([99])], None if k else shard)):
            got = [ngram_lm.probability(x) for x in ngram_lm.answer(p, held, asked)]
            assert got[0][0] == pytest.approx(0.75 * distinct / total, rel=3e-4)
            if (1, 5) in p.pairs and asked[2][0] == 5:
                assert got[1][0] == pytest.approx((n[:30].sum() - 0.75) / total, rel=3e-4)
                assert got[2][0] == pytest.approx(0.75 * 30 / n[:30].sum(), rel=3e-4)
                assert got[3][0] == (0 if asked[4][0] == 99 else pytest.approx((m[6][0] - 0.75) / n[:30].sum(), rel=3e-4))
        assert (shard.find("2", np.array([0]), np.array([99])) == -1).all()


def test_held_out_score_of_all_n_grams(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = ngram_lm.op6(spark, docs).where("held_out").agg({"score": "sum", "base_score": "sum"}).first()
    assert held["sum(base_score)"] == pytest.approx(-234_375, abs=5)
    assert held["sum(score)"] >= -189_000


def test_held_out_texts_are_likelier_than_by_words_alone(spark, frame):
    held = ngram_lm.op6(spark, frame).where("held_out").agg({"score": "sum", "base_score": "sum"}).first()
    assert held["sum(score)"] > held["sum(base_score)"]
