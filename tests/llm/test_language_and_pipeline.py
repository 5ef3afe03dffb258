import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from sparkloom.llm import language_id, sentencepiece_viterbi
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def test_texts_alone_tell_the_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    train, held = docs.where("doc_id % 2 = 0"), docs.where("doc_id % 2 = 1")
    languages, table = language_id.train(train)
    rows = held.select(F.struct("doc_id", "lang").alias("row"), "text", F.lit(None).cast("string").alias("declared"), F.lit(None).cast("string").alias("host"))
    got = language_id.identify(rows, languages, table)
    assert got.where("lang = row.lang").count() >= 0.99 * held.count()


def test_evidence_is_fused(spark):
    docs = spark.createDataFrame([(1, "der die das und ist nicht " * 20, "de"), (2, "the and that with this from " * 20, "en")], "doc_id long, text string, lang string")
    page = lambda i, host, lang, text: (i, f"http://{host}/x", f"<html{lang}><script>the and</script><p>{text}</p>")
    pages = [page(i, "a.b.de", "", "der die das und ist nicht") for i in range(8)] + [
        page(100, "a.b.de", "", ""), page(101, "c.b.de", ' lang="de-AT"', ""), page(102, "x.com", ' lang="en"', "the and that"), page(103, "x.com", "", "12345 @@@"), page(104, "x.com", ' lang="xx"', ""), (105, None, None),
    ]
    got = {r.page_id: r for r in language_id.op8(spark, spark.createDataFrame(pages, "page_id long, url string, html string"), docs).collect()}
    assert got[0].lang == "de" and got[0].accepted and got[101].lang == "de" and got[101].accepted and got[102].lang == "en"
    assert not got[100].accepted and not got[103].accepted and not got[104].accepted and not got[105].accepted and got[105].host == ""


def test_fusion_is_the_brute_force_one(spark):
    pages = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").collect()]
    pages += [(-1, None, None), (-2, "http://a.b/", ""), (-3, "no host", "<html lang=fr>"), (-4, "http://X.example.com:80/", "<html lang='DE-at'>12"), (-5, "http://x.example.com", "<p>" + "der die das " * 30000), *pages[:3]]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumns({c: F.lit("clash") for c in ("lang", "host", "row", "vote", "a.b")})
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    asked = frame.select("page_id", language_id.html_text(F.col("html")), F.lower(F.regexp_extract(F.coalesce("html", F.lit("")), r"""(?is)<html\b[^>]*?\blang\s*=\s*["']?([a-z]+)""", 1)), language_id.host_of(F.col("url"))).collect()
    want = brute.languages([(t, x, h) for _, t, x, h in asked], [tuple(r) for r in docs.select("text", "lang").collect()])
    got = language_id.op8(spark, frame, docs).collect()
    assert len(got) == len(asked)
    plain = lambda rows: sorted(rows, key=repr)
    want = plain((p, x or "", h or "", n, lang, round(c, 4), ok) for (p, _, x, h), (n, lang, c, ok) in zip(asked, want, strict=True))
    assert plain((r.page_id, r.declared or "", r.host, r.n_grams, r.lang, round(r.confidence, 4), r.accepted) for r in got) == want


def test_wrong_labels_and_texts_of_no_language_go(spark):
    docs = [list(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang", "source").collect()]
    schema = "doc_id long, text string, lang string, source string"
    clean = {r.doc_id for r in language_id.keep_identified(spark.createDataFrame(docs, schema)).collect()}
    assert len(clean) >= 0.995 * len(docs)
    rng = random.Random(11)
    names = ["de", "en", "es", "fr"]
    wrong = rng.sample([d for d in docs if len(d[1]) > 300 and d[0] in clean], 40)
    for d in wrong:
        d[2] = rng.choice([x for x in names if x != d[2]])
    junk = [[10**6 + i, t, "en", "src1"] for i, t in enumerate(["", None, "12 34 %% 5", *[" ".join("".join(rng.choice("qxzjvkw") for _ in range(9)) for _ in range(60)) for _ in range(20)]])]
    left = {r.doc_id for r in language_id.keep_identified(spark.createDataFrame(docs + junk, schema)).collect()}
    assert not left & {d[0] for d in junk}
    assert len(left & {d[0] for d in wrong}) <= 1
    assert len(clean - {d[0] for d in wrong} - left) <= 2


def test_pipeline_stage_with_many_labels(spark):
    docs = [list(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]
    docs += [[10**6 + i, f"dirty label {i} on a text", f"label {i}", f"h{i % 7}.example.com"] for i in range(300)]
    left = language_id.keep_identified(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")).collect()
    assert sorted(r.doc_id for r in left) == sorted(d[0] for d in brute.identified([tuple(d) for d in docs]))


def test_pipeline_is_its_stages(spark):
    import corpus_pipeline

    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = [(d, t) for d, t, _, _ in brute.identified(docs)]
    kept = [(d, t) for (d, t), e in zip(kept, brute.exact(kept), strict=True) if e[3]]
    kept = [(d, t) for (d, t), n in zip(kept, brute.near(kept, corpus_pipeline.NEAR), strict=True) if n[3]]
    want = {}
    for d, t in kept:
        w, hit, _ = brute.hit_words(t, items)
        if len(hit) <= 0.5 * len(w):
            want[d] = [x for i, x in enumerate(w) if i not in hit]
    got = corpus_pipeline.run(spark, SF)
    assert sorted(r.doc_id for r in got.collect()) == sorted(want)
    assert got.where("NOT round_trip").isEmpty()
    stage = spark.read.parquet(f"{SF}/documents.parquet")
    for _, f in corpus_pipeline.STAGES[:-1]:
        stage = f(spark, stage, SF)
        assert stage.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    for r in stage.collect():
        assert brute.NORMAL.findall(brute.lower(r.text)) == want[r.doc_id]
    again = {r.doc_id: r.ids_sha256 for r in sentencepiece_viterbi.op10(spark, stage).collect()}
    assert again == {r.doc_id: r.ids_sha256 for r in got.collect()}


def test_stages_keep_columns_of_any_name(spark):
    import corpus_pipeline

    de, en = "der die das und ist nicht " * 20, "the and that with this from " * 20
    rows = [(i, " ".join(f"{w} {i}x{j}" for j, w in enumerate(x.split())), lang, "s") for i, (x, lang) in enumerate([(de, "de"), (en, "en")] * 8)]
    rows += [(None, de + "x", "de", "s"), (None, None, None, None), (0, rows[0][1], "de", "s"), (99, en * 10_000, "en", "s")]
    schema = "doc_id long, text string, lang string, source string"
    odd = spark.createDataFrame(rows, schema).withColumn("n_chars", F.length("text").cast("int"))
    for k, name in enumerate(("my col", "a.b", "__place", "__row", "__id", "key", "id", "spans", "`q`")):
        odd = odd.withColumn(name, F.lit(k))
    empty = odd.limit(0)
    stage, none = odd, empty
    for _, f in corpus_pipeline.STAGES[:-1]:
        stage, none = f(spark, stage, SF), f(spark, none, SF)
        assert stage.schema.simpleString() == odd.schema.simpleString() and none.count() == 0
        for r in stage.collect():
            assert tuple(r)[5:] == tuple(range(9))
    assert {r.doc_id for r in stage.select("doc_id").collect()} >= set(range(1, 16)) | {99}
    assert corpus_pipeline.STAGES[-1][1](spark, stage, SF).where("round_trip").count() == stage.count()


@pytest.mark.parametrize("name", [n for n in entry.queries() if n.startswith("op") and n != "oneof_dispatch"])
def test_registered_queries(spark, name):
    import duckdb

    from tests.test_queries import TABLES, normal

    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = normal(tuple(r[c] for c in columns) for r in df.collect())
    assert got
    if name in entry.oracle_sql():
        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
        answer = con.execute(entry.oracle_sql()[name])
        names = [d[0] for d in answer.description]
        assert got == normal(tuple(r[names.index(c)] for c in columns) for r in answer.fetchall())
