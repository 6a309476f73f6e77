"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing extra columns, for every operator and stage."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlight.llm import ann, decontam, licenses, lm, mixing, pii, quality, secrets, simhash, urls

CLASH = ["rid", "score", "fp", "spans", "words", "stats", "d", "h", "hits", "grp", "low", "p", "batch", "size", "copies",
         "owner", "live", "new", "occ", "target", "__rid", "s", "fold", "held", "kind"]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "the word of token = abcdefgh12345678 mit license " * 20_000


def docs_table(spark, rows=None):
    rows = rows if rows is not None else [
        (None, None, None, None, None), (1, "", "en", "a", 0), (2, "alpha beta", "en", None, 10), (2, "alpha beta", "en", None, 10),
        (3, LONG, None, "b", len(LONG)), (4, " \t\n ", "en", "a", 4), (5, "Éa ünd ßx mit License +1 (743) 555-3824", "de", "b", 30),
        (2, "another text under one id", None, "a", None), (6, None, "fr", "b", None)]
    df = spark.createDataFrame(rows, DOCS)
    return df.select("*", *[F.lit(7).alias(c) for c in CLASH])


def labels_table(spark, rows=((1, 1, 0), (2, 0, 0), (2, 1, 0), (3, None, 0), (None, 1, 1))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int").withColumn("score", F.lit(1)).withColumn("y", F.lit(1))


def items_table(spark, rows=((1, "alpha beta gamma delta epsilon zeta"), (None, "mit license"), (2, None), (3, ""), (3, "..."))):
    return spark.createDataFrame(list(rows), "item_id long, text string").withColumn("hits", F.lit(1)).withColumn("h", F.lit(1))


DOC_OPERATORS = {
    "quality": lambda s, d: quality.classify(s, d, labels_table(s)),
    "quality without labels": lambda s, d: quality.classify(s, d, labels_table(s, ())),
    "pii": pii.find, "licenses": licenses.scan, "secrets": secrets.scan, "lm": lm.score_documents,
    "simhash": simhash.simhash_groups, "mixing": mixing.mix}


@pytest.fixture(scope="module")
def stored_docs(spark, tmp_path_factory):
    def store(rows=None):
        path = str(tmp_path_factory.mktemp("docs") / "t")
        docs_table(spark, rows).write.parquet(path)
        return spark.read.parquet(path)
    return store


@pytest.mark.parametrize("name", DOC_OPERATORS)
def test_every_row_has_a_result(spark, stored_docs, name):
    docs = stored_docs()
    out = DOC_OPERATORS[name](spark, docs).toPandas()
    assert len(out) == 9
    assert sorted(out.doc_id.dropna()) == [1, 2, 2, 2, 3, 4, 5, 6]
    empty = DOC_OPERATORS[name](spark, stored_docs([]))
    assert empty.count() == 0 and empty.columns == list(out.columns)


def test_null_and_empty_texts_have_defined_results(spark, stored_docs):
    docs = stored_docs()
    base = pii.find(spark, docs).toPandas()
    assert set(base[base.doc_id.isin([1, 4, 6])].base_sha256) == {"e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"}
    lic = licenses.scan(spark, docs).toPandas().set_index("doc_id")
    assert lic.n_words[1] == 0 and lic.base_labels[1] == "" and lic.score[6] == 0
    assert lic.n_base[3] == 20_000 and lic.labels[5] == "mit"
    sec = secrets.scan(spark, docs).toPandas().set_index("doc_id")
    assert sec.n_assign[3] == 20_000
    sim = simhash.simhash_groups(spark, docs).toPandas()
    zero = sim[sim.doc_id.isin([1, 4, 6]) | sim.doc_id.isna()]
    assert set(zero.fp) == {0} and set(zero.component_id) == {1}
    tokens = lm.score_documents(spark, docs).toPandas().set_index("doc_id").n_tokens
    assert tokens[1] == 1 and tokens[6] == 1 and tokens[3] == 8 * 20_000 + 1
    mixed = mixing.mix(spark, docs).toPandas()
    assert mixed["size"].sum() == 8 * 20_000 + 2 + 2 + 9 - 1 + 5 and mixed.target.notna().all()


def test_decontamination_edges(spark, stored_docs):
    docs = stored_docs()
    hits = decontam.contaminated(spark, docs, items_table(spark)).toPandas()
    assert set(hits.doc_id) == {3, 5} and hits.item_id.isna().all() and set(hits.distance) == {0}
    assert decontam.contaminated(spark, stored_docs([]), items_table(spark)).count() == 0
    assert decontam.contaminated(spark, docs, items_table(spark, ())).count() == 0
    kept = decontam.keep_clean(spark, docs, items_table(spark))
    assert kept.columns == docs.columns and kept.count() == 7


def test_neighbour_edges(spark):
    schema = "vec_id long, embedding array<float>, score int, list int, cid int, vec int, ids int"
    nan, inf = float("nan"), float("inf")
    rows = [(20, [1.0, 0.0]), (40, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 2.0]), (2, [0.0, 2.0]), (3, [-1.0, 0.0]), (4, None), (60, [0.0, 0.0]),
            (5, [1.0, None]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, []), (9, [1.0, 2.0, 3.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame([(i, v, 0, 0, 0, 0, 0) for i, v in rows], schema)
    out = ann.nearest(spark, df).orderBy("query_id", "rank").toPandas()
    assert out.values.tolist() == [[20, 1, 1, 1.0], [20, 2, 40, 1.0], [20, 3, 2, 0.0], [20, 4, 3, -1.0],
                                   [40, 1, 1, 1.0], [40, 2, 20, 1.0], [40, 3, 2, 0.0], [40, 4, 3, -1.0]]
    assert ann.nearest(spark, df.limit(0)).count() == 0
    assert ann.nearest(spark, df.filter("vec_id = 20")).count() == 0


def test_url_edges(spark):
    rows = [(1, None), (2, "no scheme"), (2, "no scheme"), (None, "http://A.net/x"), (3, "://"), (4, "http://h.org?q/fr/"), (5, "http://h.org/fr/a#b"),
            (6, "x://a.example.net/en/1?z=://"), (7, "http://net/"), (8, "http://nett/"), (9, "http://h.com/" + "a/" * 5000), (10, "http://example.com/de/\n1")]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit(1)).withColumn("shape", F.lit(1)).withColumn("n", F.lit(1))
    out = urls.judge(spark, df).toPandas()
    assert len(out) == len(rows)
    got = {int(r.page_id): (r.host, r.path[:12], r.rule, r.verdict) for r in out.itertuples() if r.page_id == r.page_id}
    assert got[1] == got[2] == got[3] == ("", "", None, "allow")
    assert got[4] == ("h.org", "", None, "allow") and got[5] == ("h.org", "/fr/a", "org/fr/", "allow")
    assert got[6] == ("a.example.net", "/en/1", "example.net/en/", "allow")
    assert got[7][2:] == ("net/", "block") and got[8][2:] == (None, "allow") and got[10][1:] == ("/de/\n1", "example.com/de/", "block")
    assert urls.judge(spark, df.limit(0)).count() == 0


@pytest.mark.parametrize("rows", [None, []], ids=["edge rows", "empty"])
def test_every_stage_survives_edge_rows(spark, stored_docs, tmp_path, rows):
    sf = str(tmp_path)
    labels_table(spark).write.parquet(f"{sf}/labels.parquet")
    items_table(spark).write.parquet(f"{sf}/benchmark.parquet")
    docs = stored_docs(rows)
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        if i < 4:
            assert out.columns == docs.columns
        out.write.parquet(f"{sf}/{i}")
        docs = spark.read.parquet(f"{sf}/{i}")
    assert (docs.count() == 0) == (rows == [])
