import corpus_pipeline
from sparkloom.llm import decontaminate, langid, secrets
from sparkloom.llm.queries import queries
from test_similar import components, linked


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    by_name = dict(corpus_pipeline.STAGES)
    one = by_name["language"](spark, docs, sf_dir)
    assert one.columns == docs.columns and docs.count() * 0.95 < one.count() <= docs.count()
    two = by_name["near_duplicates"](spark, one, sf_dir).cache()
    rows = sorted(one.select("doc_id", "text").collect())
    want = components(len(rows), linked([r["text"] for r in rows]))
    assert {r["doc_id"] for r in two.collect()} == {rows[w]["doc_id"] for w in want}
    three = by_name["decontamination"](spark, two, sf_dir)
    bad = {r["doc_id"] for r in decontaminate.hit_words(two, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).where("contaminated").collect()}
    assert bad and {r["doc_id"] for r in three.collect()} == {r["doc_id"] for r in two.collect()} - bad
    four = by_name["secrets"](spark, three, sf_dir)
    assert four.columns == docs.columns and four.count() == three.count()
    assert secrets.scan(four).where("n_assign + n_access + n_hex > 0").count() == 0
    assert four.where("n_chars <> length(text)").count() == 0
    five = by_name["mixing"](spark, four, sf_dir)
    assert set(docs.columns) < set(five.columns) and {r["doc_id"] for r in five.collect()} <= {r["doc_id"] for r in four.collect()}


def test_run(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.count() > 0 and [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "secrets", "mixing"]


def test_stages_bear_odd_rows(spark, sf_dir, docs_schema):
    good = "the cat and the dog went to the house of the man who had it " * 3
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, good, "en", None, 10), (3, good, "en", None, 10), (None, good + "x", "en", "s", 5), (4, "der Hund und die Katze " * 9, "de", "s", None), (5, good + " token = abcdef123456", "en", "t", 1)]
    for docs in (spark.createDataFrame([(*r, "q") for r in rows], docs_schema + ", score string"), spark.createDataFrame([], docs_schema)):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, sf_dir)
        docs.collect()


def test_queries_cover_the_operators():
    assert [int(n[2:].split("_")[0]) for n in queries()] == list(range(1, 14))
    assert langid.BUCKETS == 1 << 16
