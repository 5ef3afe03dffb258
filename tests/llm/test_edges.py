"""Nulls, repeated rows and ids, clashing columns and empty tables."""

import pytest
from pyspark.sql import functions as F

from sparkloom.llm import common, decontaminate, elias_fano, exact_dedup, language_id, line_dedup, minmax_dedup, ngram_lm, sentencepiece_viterbi, substring_dedup, token_counts, url_filter
from tests.llm import brute


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_odd_rows(spark, odd):
    plain = [(r.doc_id, r.text) for r in odd.collect()]
    assert rows(minmax_dedup.op1(spark, odd)) == sorted(brute.near(plain), key=repr)
    assert rows(substring_dedup.op4(spark, odd)) == sorted(brute.substrings(plain), key=repr)
    assert [r[:3] for r in rows(exact_dedup.op7(spark, odd))] == [r[:3] for r in sorted(brute.exact(plain), key=repr)]
    kept = exact_dedup.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(r.text or "" for r in kept.collect()) == sorted({t or "" for _, t in plain})
    assert line_dedup.op2(spark, odd).count() == len(plain)
    assert ngram_lm.op6(spark, odd).count() == len(plain)
    encoded = sentencepiece_viterbi.encode(spark, odd)
    assert [r.ids for r in encoded.where("ids IS NULL").collect()] == [None]
    assert sorted((r.text or "~") for r in sentencepiece_viterbi.decode(spark, encoded).collect()) == sorted((t if t is not None else "~") or "~" for _, t in plain)
    near = minmax_dedup.keep_one(odd)
    assert near.columns == odd.columns
    assert language_id.keep_identified(odd.withColumnRenamed("words", "source")).columns[-1] == "source"


def test_decontamination_of_odd_rows(spark, odd):
    plain = [(r.doc_id, r.text) for r in odd.collect()]
    bench = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(5, 25))), (2, "now")], "item_id long, text string")
    assert rows(decontaminate.op5(spark, odd, bench)) == sorted(brute.contaminated(plain, [(1, bench.first().text), (2, "now")]), key=repr)
    assert rows(decontaminate.find(spark, odd, bench, most=12).drop("spans")) == rows(decontaminate.op5(spark, odd, bench))


def test_token_counts_of_the_query(spark):
    """The whole query, its deletes and revisions and repeated batches, against plain counting."""
    import public_tokenizers as files

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumns({"docs": F.lit(7), "tokens": F.lit(7), "version": F.lit("x"), "slot": F.lit(1)})
    extra = [(None, None, None, None), (1, "again", "en", "src1"), (1, "again", "en", "src1"), (5, "", None, "src2"), (10**9, "long " * 100_000, "en", "src1")]
    docs = docs.select("doc_id", "text", "lang", "source", "docs", "tokens", "version", "slot").unionByName(spark.createDataFrame([(*r, 1, 1, "y", 0) for r in extra], "doc_id long, text string, lang string, source string, docs int, tokens int, version string, slot int"))
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").select("doc_id", "quality", "toxic")
    labels = labels.unionByName(spark.createDataFrame([(1, 0, 0), (1, 0, 0), (5, 0, 1), (None, 0, 0)], labels.schema))
    toxic = {r.doc_id for r in labels.where("toxic = 1").collect()}
    want = {}
    for r in docs.collect():
        if r.doc_id in toxic:
            continue
        for version, file in token_counts.VERSIONS.items():
            key = (r.source, r.lang, version)
            n, t = want.get(key, (0, 0))
            want[key] = (n + 1, t + len(token_counts.encoding(files.path(file), files.PATTERN).encode_ordinary(r.text or "")))
    got = {(r.source, r.lang, r.version): (r.n_docs, r.n_tokens) for r in token_counts.op3(spark, docs, labels).collect()}
    assert got == want


def test_revised_ids_are_exactly_those(spark):
    """Documents that the bitmap admits by chance are not revised."""
    docs = spark.createDataFrame([(i, f"t {i}", "en", "s") for i in range(200)], "doc_id long, text string, lang string, source string")
    rollup = token_counts.TokenRollup(spark, common.scratch(spark, "rollup"), {"v": lambda ts: [len(t) for t in ts]})
    slots, token_counts.SLOTS = token_counts.SLOTS, 1 << 15
    try:
        ids = spark.createDataFrame([(i,) for i in range(0, 200, 3)] + [(999,), (None,)], "doc_id long")
        assert sorted(r.doc_id for r in rollup.count(docs, ids).collect()) == list(range(0, 200, 3))
    finally:
        token_counts.SLOTS = slots


def test_empty_tables(spark, none):
    bench = spark.createDataFrame([], "item_id long, text string")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for df in (
        minmax_dedup.op1(spark, none), line_dedup.op2(spark, none), token_counts.op3(spark, none, labels), substring_dedup.op4(spark, none), decontaminate.op5(spark, none, bench),
        ngram_lm.op6(spark, none), exact_dedup.op7(spark, none), language_id.op8(spark, pages, none), url_filter.op9(spark, pages), sentencepiece_viterbi.op10(spark, none),
    ):
        assert df.collect() == []


def test_nothing_to_hit_or_train_on(spark, frame):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.op5(spark, frame, bench).where("contaminated").isEmpty()
    pages = spark.createDataFrame([(1, None, None), (2, "http://a.b/", "<html lang=de>x")], "page_id long, url string, html string")
    assert language_id.op8(spark, pages, frame.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")).where("accepted").isEmpty()


def test_index_keeps_what_it_has_seen(spark):
    index = exact_dedup.DigestIndex(spark, common.scratch(spark, "index"), buckets=4)
    one = spark.createDataFrame([(1, "a"), (5, "a"), (2, "b")], "doc_id long, text string")
    two = spark.createDataFrame([(9, "a"), (3, "c"), (4, "c")], "doc_id long, text string")
    look = lambda df, batch: {r.doc_id: (r.keep_id, r.kept) for r in exact_dedup.deduplicate(df, index, batch).collect()}
    first = {1: (5, False), 5: (5, True), 2: (2, True)}
    assert look(one, "x") == first
    second = {9: (5, False), 3: (4, False), 4: (4, True)}
    assert look(two, "y") == second
    assert look(two, "y") == second and look(one, "x") == first  # batches sent again
    assert index.entries().count() == 3
    again = exact_dedup.DigestIndex(spark, index.path, buckets=4)
    assert again.entries().count() == 3


def test_rollups(spark):
    words = lambda texts: [len(t.split()) for t in texts]
    rollup = token_counts.TokenRollup(spark, common.scratch(spark, "rollup"), {"w1": words, "chars": lambda ts: list(map(len, ts))})
    docs = lambda *r: spark.createDataFrame(r, "doc_id long, source string, lang string, text string")
    totals = lambda: {(r.source, r.lang, r.version): (r.n_docs, r.n_tokens) for r in rollup.totals().collect()}
    load = docs((1, "s", "en", "a b c"), (2, "s", "en", "d"), (3, None, None, None), (3, None, None, None))
    assert rollup.commit("load", insert=load)
    want = {("s", "en", "w1"): (2, 4), ("s", "en", "chars"): (2, 6), (None, None, "w1"): (2, 0), (None, None, "chars"): (2, 0)}
    assert totals() == want
    assert not rollup.commit("load", insert=load) and totals() == want
    assert rollup.commit("fix", delete=docs((3, "", "", ""), (77, "", "", "")), revise=docs((1, "t", "en", "a b")))
    want = {("s", "en", "w1"): (1, 1), ("s", "en", "chars"): (1, 1), ("t", "en", "w1"): (1, 2), ("t", "en", "chars"): (1, 3)}
    assert totals() == want
    # A batch that was lost before its commit counts for nothing, and is written anew.
    rollup._read("log", token_counts.LOG).drop("batch").write.parquet(f"{rollup.path}/log/batch=lost")
    rollup._read("rollup", "source string, lang string, version string, docs long, tokens long").drop("batch").write.parquet(f"{rollup.path}/rollup/batch=lost")
    assert totals() == want
    assert rollup.commit("lost", insert=docs((9, "s", "en", "x"))) and totals() == want | {("s", "en", "w1"): (2, 2), ("s", "en", "chars"): (2, 2)}


def test_real_tokenizers_count_like_the_library(spark, frame):
    import public_tokenizers as files
    import tiktoken

    rollup = token_counts.TokenRollup(spark, common.scratch(spark, "rollup"))
    rollup.commit("load", insert=frame.selectExpr("doc_id", "text", "'s' AS source", "'en' AS lang"))
    got = {r.version: r.n_tokens for r in rollup.totals().collect()}
    for version, file in token_counts.VERSIONS.items():
        enc: tiktoken.Encoding = token_counts.encoding(files.path(file), files.PATTERN)
        assert got[version] == sum(len(enc.encode_ordinary(r.text or "")) for r in frame.collect())


URLS = {
    "http://a.com/en/1": ("a.com", "/en/1", "com/en/", "block"),
    "http://x.EXAMPLE.com/en/71?q#f": ("x.example.com", "/en/71", "example.com/en/7", "allow"),
    "https://example.net/de/8": ("example.net", "/de/8", "example.net/de/8", "block"),
    "https://example.net/de/7#a": ("example.net", "/de/7", "net/de/", "allow"),
    "https://notexample.org/es/": ("notexample.org", "/es/", "org/es/", "block"),
    "https://casino-win.example.net/fr/310": ("casino-win.example.net", "/fr/310", None, "block"),
    "https://ththre.example.com/fr/825": ("ththre.example.com", "/fr/825", None, "allow"),
    "x://h?/en/": ("h", "", None, None),
    "a://b://c/en/": ("b:", "//c/en/", None, None),
    "no scheme.com/en/": ("", "", None, None),
    "": ("", "", None, None),
    None: ("", "", None, None),
}


def test_urls(spark):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string")
    for got, (url, want) in zip(sorted(url_filter.op9(spark, df).collect()), URLS.items(), strict=True):
        assert (got.host, got.path, got.rule) == want[:3], url
        assert got.verdict == want[3] if want[3] else got.verdict in ("allow", "block")


def test_regression_separates_the_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = url_filter.filter_urls(pages, rules=()).collect()
    bad = ("spam-farm", "cheap-pills", "casino-win", "adult-x", "free-bets", "ads-track")
    right = sum((r.verdict == "block") == any(b in r.host for b in bad) for r in got)
    assert right >= 0.98 * len(got)
    with pytest.raises(ValueError):
        url_filter.filter_urls(pages, rules=(("block", "a", "/"),) * 1001)


def test_elias_fano():
    import numpy as np

    rng = np.random.default_rng(1)
    for n, most in ((0, 1), (1, 0), (500, 10), (5000, 1 << 40), (5000, (1 << 64) - 1)):
        values = np.sort(rng.integers(0, most, n, np.uint64, endpoint=True))
        coded = elias_fano.EliasFano(**elias_fano.EliasFano.parts(values))
        if n:
            assert (coded.get(np.arange(n)) == values).all()
        asked = np.concatenate([values, rng.integers(0, most, 100, np.uint64, endpoint=True)])
        at, equal = coded.successor(asked)
        want = np.searchsorted(values, asked)
        assert (at == want).all() and (equal == np.isin(asked, values)).all()
