"""End-to-end extraction: edge cases of FIXTURES.md §4, invariants V1-V5, sinks."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from termlens.operators import audit as AU
from termlens.operators import select as SEL
from termlens.operators import stats as ST
from termlens.plans import extract as E
from termlens.sinks import updates as U

SCHEMA = "doc_id long, text string"


def _docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_null_empty_punct(spark):
    docs = _docs(spark, [(1, None), (2, ""), (3, "!!! ..."), (4, "alpha beta"), (5, "gamma delta")])
    out = _by_id(E.extract(docs, keyword_stopwords=None))
    assert 1 not in out                       # null text: not eligible
    assert out[2].keywords is None and out[3].keywords is None
    assert out[4].keywords == ["alpha", "beta"]


def test_identical_documents_give_null(spark):
    docs = _docs(spark, [(1, "same words here"), (2, "same words here")])
    out = _by_id(E.extract(docs, keyword_stopwords=None))
    assert out[1].keywords is None and out[2].keywords is None


def test_single_document_collection(spark):
    out = _by_id(E.extract(_docs(spark, [(1, "only one doc")]), keyword_stopwords=None))
    assert out[1].keywords is None


def test_stop_words_only_survive_topk(spark):
    docs = _docs(spark, [(1, "the and of zebra"), (2, "zebra yak")])
    # top-1 by rarity is 'and' (bg 1); the stop list then empties the document
    out = _by_id(E.extract(docs, max_doc_keyterms=1))
    assert out[1].keywords is None
    out2 = _by_id(E.extract(docs, max_doc_keyterms=1, filter_before_topk=True))
    assert out2[1].keywords is None or out2[1].keywords == []  # zebra is in both docs, so bg = N


def test_fewer_terms_than_k(spark):
    docs = _docs(spark, [(1, "a1 b1 c1"), (2, "x2 y2")])
    out = _by_id(E.extract(docs, keyword_stopwords=None, max_doc_keyterms=50))
    assert sorted(out[1].keywords) == ["a1", "b1", "c1"]


def test_same_term_two_cases(spark):
    docs = _docs(spark, [(1, "The cat saw the Cat"), (2, "dog")])
    raw = _by_id(E.extract(docs, keyword_stopwords=None))
    assert raw[1].keywords == ["The", "cat", "saw", "the", "Cat"]
    ana = _by_id(E.extract(docs, keyword_stopwords=None, use_termvectors=True))
    assert ana[1].keywords == ["cat", "saw", "the"]
    assert [len(o) for o in ana[1].offsets] == [2, 1, 2]


def test_more_than_max_fragments(spark):
    # twelve rare words far apart: only the first three fragments survive with max_fragments=3
    words = [f"w{i}" for i in range(12)]
    text = (" filler" * 30 + " ").join(words)
    docs = _docs(spark, [(1, text), (2, "filler")])
    out = _by_id(E.extract(docs, keyword_stopwords=None, max_fragments=3, extract_contexts=True))
    assert out[1].keywords == ["w0", "w1", "w2"]
    assert len(out[1].contexts) == 3
    for k, offs in zip(out[1].keywords, out[1].offsets):
        assert all(text[o.start:o.end] == k for o in offs)


def test_offsets_with_accents_and_astral(spark):
    text = "😀😀 élan vital 𝔘nique fin"
    docs = _docs(spark, [(1, text), (2, "fin")])
    out = _by_id(E.extract(docs, keyword_stopwords=None))
    for k, offs in zip(out[1].keywords, out[1].offsets):
        for o in offs:
            assert text[o.start:o.end] == k


def test_tfidf_rule(spark):
    docs = _docs(spark, [(1, "apple apple apple pear"), (2, "pear plum"), (3, "plum kiwi")])
    kt = SEL.keyterms(docs, k=1, rule="tfidf").collect()
    assert {(r.doc_id, r.term) for r in kt} == {(1, "apple"), (2, "pear"), (3, "kiwi")}


def test_group_significance(spark):
    df = spark.createDataFrame([(1, "g1", "red fox"), (2, "g1", "red dog"), (3, "g2", "blue cat"), (4, "g2", "blue fox")],
                               "doc_id long, source string, text string")
    lift = {(r.source, r.term) for r in ST.significant_terms(df, "source", size=1, min_doc_count=2).collect()}
    assert lift == {("g1", "red"), ("g2", "blue")}
    llr = {(r.source, r.term) for r in ST.significant_terms(df, "source", size=1, heuristic="llr").collect()}
    assert llr == {("g1", "red"), ("g2", "blue")}


def test_invariants_on_real_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    res = E.extract(docs, extract_contexts=True)
    for chk in (AU.audit_offsets(res, docs), AU.audit_keyterms(res, docs), AU.audit_contexts(res),
                AU.audit_scope(res, E.eligible(docs, E.ExtractConfig()))):
        row = chk.first()
        assert row.violations == 0 and row.checked > 0, row
    ana = E.extract(docs, use_termvectors=True, extract_contexts=True)
    row = AU.audit_analyzed(ana, docs).first()
    assert row.violations == 0 and row.checked > 0


def test_updates_and_upserts(spark):
    target = spark.createDataFrame([(1, "a", "old"), (2, "b", "keep")], "doc_id long, lang string, keywords string")
    upd = spark.createDataFrame([(1, None), (9, "new")], "doc_id long, keywords string")
    upd_rows = _by_id(U.apply_updates(target, upd, fields=["keywords"]))
    assert upd_rows[1].keywords is None          # null overwrites
    assert upd_rows[2].keywords == "keep" and 9 not in upd_rows
    ups = _by_id(U.upsert_updates(target, upd, fields=["keywords"]))
    assert ups[9].keywords == "new" and ups[9].lang is None
    assert [r.doc_id for r in U.rejected_updates(target, upd).collect()] == [9]
    counts = {r.status: r.n for r in U.update_counts(target, upd).collect()}
    assert counts == {"updated": 1, "unchanged": 1, "rejected": 1}


def test_incremental_only_missing(spark):
    docs = spark.createDataFrame([(1, "alpha beta", ["x"]), (2, "gamma delta", None), (3, "eps zeta", None)],
                                 "doc_id long, text string, keywords array<string>")
    out = _by_id(E.incremental_extract(docs, keyword_stopwords=None))
    assert set(out) == {2, 3}


def test_cross_field(spark):
    df = spark.createDataFrame([(1, "Rare Title", "the body has a rare word and title"), (2, "Other", "x")],
                               "doc_id long, title string, body string")
    out = _by_id(E.extract(df, keyword_col="title", highlight_col="body", keyword_stopwords=None))
    assert out[1].keywords == ["rare", "title"]
    assert out[2].keywords is None


def test_write_merged(spark, tmp_path):
    target = spark.createDataFrame([(1, "x")], "doc_id long, keywords string")
    upd = spark.createDataFrame([(1, "y"), (2, "z")], "doc_id long, keywords string")
    counts = U.write_merged(target, upd, str(tmp_path / "out"), mode="upsert", counts=True)
    assert counts == {"updated": 1, "unchanged": 0, "inserted": 1}
    assert sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [(1, "y"), (2, "z")]


def test_cli_update(spark, tmp_path):
    from termlens import cli
    src = str(tmp_path / "docs")
    spark.createDataFrame([(1, "alpha beta"), (2, "gamma beta"), (3, None)], SCHEMA).write.parquet(src)
    counts = cli.main([src, "text", "text", "--output", str(tmp_path / "out"), "--stopwords", "none",
                       "--extract-contexts"])
    assert counts == {"updated": 2, "unchanged": 1, "inserted": 0}
    out = {r.doc_id: r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert out[1].keywords == ["alpha"] and out[3].keywords is None and out[1].contexts == ["alpha beta"]


def test_filter_on_the_result_repeats_no_step(spark):
    """Null tests and exploded contexts must not be pushed below the per-document folds."""
    docs = spark.createDataFrame([(i, " ".join(f"w{i}x{j % 9} common" for j in range(40))) for i in range(4)], "doc_id long, text string")
    cfg = E.ExtractConfig(extract_contexts=True)
    res = E.extract(docs, cfg)
    for df in (res.where(F.col("keywords").isNull()), res.where(F.col("keywords").isNotNull()), E.flatten_contexts(res, cfg)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        filters = [line for line in plan.splitlines() if "Filter" in line]
        assert not any("aggregate(" in line or "regexp_extract" in line for line in filters)
    assert res.where(F.col("keywords").isNull()).count() == 0
    assert {r.doc_id for r in E.flatten_contexts(res, cfg).collect()} == {0, 1, 2, 3}
