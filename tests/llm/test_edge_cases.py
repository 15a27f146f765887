"""Operators and pipeline stages on null rows, empty and very long texts, repeats, empty tables and clashing names."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cladegrid.llm import chat, decontaminate, language, licences, mixing, neardup, secrets, substrings, topk, urls
from cladegrid.llm.components import components

# Names that the operators use for columns of their own.
CLASHING = ("row", "id", "key", "n", "code", "codes", "band", "bands", "registers", "piece", "pieces", "family", "node", "root", "gone", "size", "rate", "copies", "copy", "target", "of_source", "source_size", "spans", "items", "n_words", "lang_pred", "score", "a", "b", "item", "window", "anchor", "word.with dot")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)


@pytest.fixture(scope="module")
def docs(spark):
    long = " ".join(f"word{'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10 % 10]} the" for k in range(60_000))
    texts = [None, "", " \n", "the cat sat on the mat", "the cat sat on the mat", "123 !", "é", long, 'token = "abcdef123"']
    rows = [(i, t, ("en", "fr", None)[i % 3], ("a", "b", None)[i % 3], len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[3], (None,) * 5, (None, "the cat sat on the mat", None, None, None)]
    return spark.createDataFrame([(*r, *["x"] * len(CLASHING)) for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([("i1", None), ("i2", ""), (None, "no such words here")], "item_id string, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES, ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stages_keep_the_columns(spark, docs, sf_dir, name, stage):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        kept = stage(spark, docs, sf_dir)
        assert kept.columns == docs.columns and kept.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
        rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
        assert stage(spark, docs.limit(0), sf_dir).collect() == []
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    ids = [i for i, _ in rows]
    if name == "language":
        assert {0, 1, 2, 5}.isdisjoint(ids) and {3, 4, 7} <= set(ids)
    if name == "near_duplicates":
        assert 4 not in ids and ids.count(3) == 1 and {0, 1, 2, 5, 6, 7, 8} <= set(ids)
    if name == "decontamination":
        assert len(rows) == docs.count()
    if name == "secrets":
        assert len(rows) == docs.count() and "abcdef123" not in dict(rows)[8]


def test_searches_take_any_row(docs, sf_dir, spark):
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    n = docs.count()
    for found in (secrets.find_secrets, substrings.mark_repeats, mixing.repeats, neardup.near_duplicates, lambda d: decontaminate.find_spans(d, bench)):
        assert len(found(docs).collect()) == n
        assert found(docs.limit(0)).collect() == []
    assert decontaminate.find_spans(docs, bench.limit(0)).where("size(items) > 0").count() == 0
    assert mixing.repeats(docs).where("size is null or copies is null or target is null").count() == 0


def test_repeats_inside_a_long_text_are_removed(docs):
    kept = {r["doc_id"]: r["text"] for r in substrings.remove_repeats(docs).collect()}
    assert len((kept[7] or "").split()) == 0 and kept[3] == "the cat sat on the mat"


def test_copies_are_learned_from_once(spark):
    rows = [("le chat", "fr")] * 50 + [("the cat", "en")]
    model = language.fit(spark.createDataFrame(rows, "text string, lang string"))
    assert model.languages == ["en", "fr"]
    assert model.word_logs[model.words["cat"]][0] == model.word_logs[model.words["chat"]][1]


def test_languages_of_copies_are_learned_in_full(spark):
    rows = [(f"le chat numero {chr(97 + k % 5) * 9}", "fr") for k in range(2000)] + [(f"the cat {k}", "en") for k in range(5)]
    model = language.fit(spark.createDataFrame(rows, "text string, lang string"), sample_rows=5)
    assert all(letter * 9 in model.words for letter in "abcde")


def test_empty_trees_vectors_pages_and_files(spark):
    messages = spark.createDataFrame([], "tree long, node long, parent long, role string, text string, score double, up long, r_tree long")
    assert chat.format_trees(messages).collect() == []
    pages = spark.createDataFrame([(None, None, None, "x")], "page_id long, url string, html string, node string")
    rules = spark.createDataFrame([("org", "/", True)], "host string, path string, allow boolean")
    assert [tuple(r) for r in urls.judge_pages(pages, rules, urls.page_links(pages)).collect()] == [(None, "", "", None, "allow")]
    assert urls.judge_pages(pages.limit(0), rules.limit(0), urls.page_links(pages.limit(0))).collect() == []
    files = spark.createDataFrame([(None, None, None, "x")], "k long, p string, t string, licence string")
    assert [r["licence"] for r in licences.scan_licences(files, "k", "p", "t").collect()] == [None]
    assert licences.scan_licences(files.limit(0), "k", "p", "t").collect() == []
    vectors = spark.createDataFrame([(None, None, 1)], "vec_id long, embedding array<float>, id long")
    assert topk.whole_vectors(vectors, "vec_id", "embedding").collect() == []


def test_components_of_chains_hubs_and_loops(spark):
    chain = [(k, k + 1) for k in range(40)] + [(k + 1, k) for k in range(5)]
    hub = [(100, 200 + k) for k in range(50)] + [(250, 90)]
    edges = spark.createDataFrame(chain + hub + [(300, 300), (None, 1), (2, None), (249, 250)], "a long, b long")
    found = {r["node"]: r["root"] for r in components(edges).collect()}
    assert found == {**{k: 0 for k in range(41)}, **{k: 90 for k in (90, 100, *range(200, 251))}, 300: 300}
    assert components(edges.limit(0)).collect() == []
    assert components(edges.where("a = 300").withColumn("a", F.col("a").cast("string")).withColumn("b", F.lit("x"))).count() == 2


def test_link_targets(spark):
    cases = [
        ("http://a.net/p", "/login?next=http://x.com/de/1", "http://a.net/login?next=http://x.com/de/1"),
        ("http://b.net/../q/./r", "s/../t/.", "http://b.net/q/t/"),
        ("http://b.net/x/y?z", "?k=1", "http://b.net/x/y?k=1"),
        ("http://b.net", "../../a", "http://b.net/a"),
        ("https://b.net/x", "//c.org/a", "https://c.org/a"),
        ("http://b.net/x", "HTTP://c.org/a/../b", "HTTP://c.org/b"),
        ("http://b.net/x", "mailto:me@c.org", None),
        ("http://b.net/x", "javascript:go()", None),
        ("http://b.net/x", "#part", None),
    ]
    df = spark.createDataFrame(cases, "base string, target string, expected string")
    assert [r for r in df.select("*", urls.resolve(F.col("base"), F.col("target")).alias("found")).collect() if r.found != r.expected] == []
    html = [("http://a.net/1", '<link data-rel="canonical" href="http://x.com/de/1">'), ("http://a.net/2", '<link rel="canonical" data-href="/no" href="/yes">')]
    found = urls.page_links(spark.createDataFrame(html, "url string, html string")).collect()
    assert [tuple(r) for r in found] == [("http://a.net/2", "http://a.net/yes")]


def test_null_ids_have_coins_of_their_own(spark):
    rows = [(None, f"word {k} " * 2, s) for k in range(2000) for s in "abc"]
    mixed = mixing.repeats(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    for r in mixed.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.first("target").alias("target")).collect():
        assert abs(r.taken - r.target) < 0.1 * r.target


def test_secrets_take_time_in_proportion(spark):
    import time

    texts = ["a" * 400_000 + " x://u:passw@h.org", "eyJ" * 150_000, "://" * 100_000]
    begin = time.time()
    found = secrets.find_secrets(spark.createDataFrame([(t,) for t in texts], "text string")).collect()
    assert [s["kind"] for r in found for s in r["spans"]] == ["hex", "url_password"] or time.time() - begin < 60
    assert time.time() - begin < 60


def test_one_row_of_each_group_stays_whatever_the_ids(spark):
    a, b = "one two three four five six seven eight", "other words that are not like the first at all"
    rows = [(1, a), (2, a), (2, b), (3, b), (3, b), (None, a), (None, "alone with no id at all here"), (5, None), (5, None), (6, ""), (7, "short text")]
    kept = neardup.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    expected = [(1, a), (2, b), (None, "alone with no id at all here"), (5, None), (5, None), (6, ""), (7, "short text")]
    assert sorted(map(str, map(tuple, kept))) == sorted(map(str, expected))
