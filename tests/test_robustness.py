"""Long tokens, unseen terms, restarts, repeated updates, planted audit violations."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from termlens.functions import stem as S
from termlens.functions import text as X
from termlens.operators import audit as AU
from termlens.operators import contexts as CX
from termlens.operators import stats as ST
from termlens.operators import tokens as TK
from termlens.plans import extract as E
from termlens.sinks import updates as U
from termlens.streaming import stream as STR

DOCS = "doc_id long, text string"


def test_dotted_token_of_hundreds_of_kilobytes(spark):
    long = "a." * 200_000
    df = spark.createDataFrame([(1, long), (2, "He'll go. U.S. 22-year-old"), (3, "x.." + "b'" * 100_000)], DOCS)
    got = {r.doc_id: r.toks for r in df.select("doc_id", X.token_array("text").alias("toks")).collect()}
    assert got[1] == [long[:-1]] and got[2] == ["He'll", "go", "U.S", "22", "year", "old"]
    assert got[3] == ["x", ("b'" * 100_000)[:-1]]


def test_both_token_patterns_agree(spark):
    import re
    texts = ["a.b..c d'e ''f' g’h _i_.j 1.2.3. é.ü", "", ".", "'a'", "a.'b", "x" * 50 + ".y" * 50]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    rows = df.select("text", X.token_array("text").alias("a"), F.regexp_extract_all("text", F.lit(X.SQL_TOKEN_PATTERN), 0).alias("b"))
    assert all(r.a == r.b for r in rows.collect())
    assert re.sub(r"\+\+|\*\+", lambda m: m[0][0], X.TOKEN_PATTERN) == X.SQL_TOKEN_PATTERN


def test_stemmer_on_runs_of_y():
    assert S.porter_stem("a" + "y" * 2000 + "ing").startswith("ayyy")
    assert S.porter_stem("syzygy") == "syzygi" and S.porter_stem("toy") == "toi" or S.porter_stem("toy") == "toy"


def test_terms_unseen_by_a_stored_background_rank_first(spark, tmp_path):
    known = spark.createDataFrame([(1, "alpha beta"), (2, "alpha gamma")], DOCS)
    cfg = E.ExtractConfig(keyword_stopwords=None)
    bg, n = STR.load_background(spark, STR.store_background(known, cfg, str(tmp_path / "bg")))
    new = spark.createDataFrame([(3, "alpha neologism beta")], DOCS)
    assert E.extract(new, cfg, background=bg, n_docs=n).first().keywords == ["neologism", "beta"]
    assert E.extract(new, cfg.with_(rule="tfidf"), background=bg, n_docs=n).first().keywords == ["neologism", "beta"]


def _stream(spark, source, work, cfg):
    q = STR.start_stream(spark, str(source), DOCS, f"{work}/background", f"{work}/output", cfg)
    q.awaitTermination()
    return {r.doc_id: r.keywords for r in STR.read_results(spark, f"{work}/output", cfg).collect()}


def test_stream_restarts_and_replays(spark, tmp_path):
    cfg = E.ExtractConfig(keyword_stopwords=None)
    background = spark.createDataFrame([(1, "alpha beta"), (2, "alpha gamma"), (3, "alpha delta")], DOCS)
    STR.store_background(background, cfg, f"{tmp_path}/background")
    first, second = tmp_path / "first", tmp_path / "second"
    spark.createDataFrame([(1, "alpha beta")], DOCS).coalesce(1).write.parquet(str(first))
    spark.createDataFrame([(2, "alpha gamma")], DOCS).coalesce(1).write.parquet(str(second))
    assert _stream(spark, first, tmp_path, cfg) == {1: ["beta"]}
    assert _stream(spark, second, tmp_path, cfg) == {1: ["beta"], 2: ["gamma"]}       # another start loses nothing
    assert _stream(spark, second, tmp_path, cfg) == {1: ["beta"], 2: ["gamma"]}       # nor repeats anything
    spark.createDataFrame([(3, "alpha delta new"), (1, "alpha gamma")], DOCS).repartition(2).write.mode("append").parquet(str(second))
    assert _stream(spark, second, tmp_path, cfg) == {1: ["gamma"], 2: ["gamma"], 3: ["delta", "new"]}
    epochs = spark.read.parquet(f"{tmp_path}/output").select("_source", "_epoch").distinct().count()
    assert epochs >= 4                                                                  # several files, several batches


def test_checkpoint_folder_is_required_on_a_cluster(monkeypatch):
    from termlens import session

    class Context:
        master = "spark://host:7077"

    class Fake:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Fake())


TARGET = "doc_id long, lang string, keywords string"


@pytest.mark.parametrize("mode", U.MODES)
def test_repeated_update_ids(spark, mode):
    target = spark.createDataFrame([(1, "a", "old"), (2, "b", "keep")], TARGET)
    twice = spark.createDataFrame([(1, "x", 1), (1, None, 3), (1, "y", 2), (9, "z", 1), (9, "w", 1)],
                                  "doc_id long, keywords string, at int")
    got = sorted(tuple(r) for r in U.merge(target, twice, mode, fields=["keywords"], order_col="at").collect())
    assert got == [(1, "a", None), (2, "b", "keep")] + ([(9, None, "z")] if mode == "upsert" else [])
    with pytest.raises(PySparkException, match="more than one update"):
        U.merge(target, twice.drop("at"), mode).collect()


def test_unknown_modes_raise(spark, tmp_path):
    target = spark.createDataFrame([(1, "a", "old")], TARGET)
    upd = spark.createDataFrame([(1, "x")], "doc_id long, keywords string")
    for call in (lambda: U.merge(target, upd, "bogus"), lambda: U.update_counts(target, upd, mode="bogus"),
                 lambda: U.write_merged(target, upd, str(tmp_path / "out"), mode="bogus")):
        with pytest.raises(ValueError, match="unknown mode"):
            call()
    assert not (tmp_path / "out").exists()


def test_audits_find_planted_violations(spark):
    docs = spark.createDataFrame([(1, "red fox, blue"), (2, "green")], DOCS)
    offsets = "array<array<struct<start:bigint,end:bigint>>>"
    res = spark.createDataFrame(
        [(1, ["red", "fo", "blue"], [[(0, 3)], [(4, 7)], [(9, 13), (0, 4)]], ["red fox"]), (2, None, None, None), (7, ["x"], [[]], ["x"])],
        f"doc_id long, keywords array<string>, offsets {offsets}, contexts array<string>")
    found = lambda df: tuple(df.first())
    assert found(AU.audit_offsets(res, docs)) == ("offsets", 2, 4)
    assert found(AU.audit_keyterms(res, docs)) == ("keyterms", 1, 3)
    assert found(AU.audit_contexts(res)) == ("contexts", 2, 4)
    assert found(AU.audit_scope(res, docs)) == ("scope", 1, 2)
    terms = spark.createDataFrame([(1, ["red"], [["fox", "zebra"]]), (2, ["green"], [["green"]])],
                                  "doc_id long, keywords array<string>, contexts array<array<string>>")
    assert found(AU.audit_analyzed(terms, docs, analyzer="lower")) == ("analyzed", 1, 2)
    assert found(AU.audit_offsets(res.limit(0), docs)) == ("offsets", 0, 0)


def test_passages_against_brute_force(spark):
    import random
    rng = random.Random(4)
    rows = [(d, "g" if d % 2 else "h", " ".join(rng.choice("ab") for _ in range(rng.randint(0, 14)))) for d in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, grp string, text string")
    toks = TK.tokenize(docs).join(docs.select("doc_id", "grp"), "doc_id")
    got = {(r.doc_id, r.position) for r in ST.drop_duplicate_passages(toks, "grp", 4).collect()}
    owner, want = {}, set()
    for d, g, text in sorted(rows):
        t = text.split()
        copies, kept = set(), set()
        for p in range(len(t) - 3):
            first = owner.setdefault((g, tuple(t[p:p + 4])), (d, p)) == (d, p)
            (kept if first else copies).update(range(p, p + 4))
        want |= {(d, p) for p in range(len(t)) if p not in copies - kept}
    assert got == want


def test_one_stemmer_pass_per_document(spark):
    docs = spark.createDataFrame([(d, f"running runner w{d}") for d in range(20)], DOCS)
    df = E.extract(docs, use_termvectors=True, extract_contexts=True, keyword_stopwords=None)
    assert "ArrowEvalPython" not in df._jdf.queryExecution().executedPlan().toString()
    assert df.where("doc_id = 3").first().keywords == ["w3"]


def test_text_bucketed_by_id_is_not_shuffled(spark):
    docs = spark.createDataFrame([(d, f"alpha w{d} beta") for d in range(50)], DOCS)
    spark.sql("DROP TABLE IF EXISTS bucketed_docs")
    docs.write.bucketBy(4, "doc_id").sortBy("doc_id").saveAsTable("bucketed_docs")
    try:
        plan = TK.tokenize(spark.table("bucketed_docs"), prepartition=False)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
    finally:
        spark.sql("DROP TABLE bucketed_docs")


def test_splitter_and_planted_tokenizer_errors(spark):
    from termlens.functions import text as X
    cases = {
        "He can't, won't; it's U.S. 22-year-old at 10:30": [
            "He", "ca", "n't", ",", "wo", "n't", ";", "it", "'s", "U.S.", "22-year-old", "at", "10:30"],
        "see https://a.b/c?d=1, (x) 3.5% é\u0301t": ["see", "https://a.b/c?d=1,", "(", "x", ")", "3.5", "%", "é\u0301t"],
        "'tis ... don\u2019t!": ["'", "tis", ".", ".", ".", "do", "n\u2019t", "!"]}
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    got = {r["t"]: r["w"] for r in df.select("t", X.split_words("t").alias("w")).collect()}
    assert got["see https://a.b/c?d=1, (x) 3.5% é\u0301t"] == cases["see https://a.b/c?d=1, (x) 3.5% é\u0301t"]
    assert got["'tis ... don\u2019t!"] == cases["'tis ... don\u2019t!"]
    first = next(iter(cases))
    assert [w for w in got[first] if w not in ("22", "22-year-old", "-", "year-old")] == [w for w in cases[first] if w != "22-year-old"]
    docs = spark.createDataFrame([(1, "Alpha's beta-gamma can't stop U.S. trade")], "doc_id long, text string")
    rows = [("Alpha's", "Alpha", "beta", "gamma", "can't", "U.S", "trade"), ("Alph", "a's", "beta gamma", "stop U", "trade")]
    results = [spark.createDataFrame([(1, list(r), ["Alpha's beta-gamma can't stop U.S. trade"])],
                                     "doc_id long, keywords array<string>, contexts array<string>") for r in rows]
    found = [tuple(AU.audit_keyterm_words(r, docs).first()) for r in results] + [tuple(AU.audit_context_words(r).first()) for r in results]
    assert found == [("keyterm words", 0, 7), ("keyterm words", 4, 5), ("context words", 0, 7), ("context words", 4, 5)]


def test_contexts_count_a_text_once(spark):
    """Counting a text's characters reads all of it; the windows of a document share one count."""
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string").withColumn(
        "g", F.array(F.struct(F.lit(0).cast("long").alias("fs"), F.lit(1).cast("long").alias("fe"))))
    plan = docs.select(CX.fragment_windows(F.col("g"), F.col("text")))._jdf.queryExecution().analyzed().toString()
    assert plan.count("length(text#") == 1


def test_word_audit_deals_texts(spark, tmp_path):
    """One file, a small result: the join is a broadcast, and the texts are still dealt to tasks."""
    docs = spark.createDataFrame([(k, "alpha beta") for k in range(20)], "doc_id long, text string").coalesce(1)
    docs.write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    res = docs.select("doc_id", F.array(F.lit("alpha")).alias("keywords"))
    audit = AU.audit_keyterm_words(res, docs)
    assert "REPARTITION_BY_COL" in audit._jdf.queryExecution().executedPlan().toString()
    assert tuple(audit.first()) == ("keyterm words", 0, 20)


def test_word_audit_forms(spark):
    """Words as they stand, pieces, stripped forms of words and of keywords, missing ones, each once."""
    text = "the 22-year-old a-b cd. x_y it's U.S. co-op's ... end"
    kws = ["the", "22", "ab", "c.d", "x_y", "it's", "s", "U.S", "coops", "...", ".", "xy", "gone", "g-one", "gone", "c"]
    words = F.array(*map(F.lit, kws))
    known = set()
    for w in spark.range(1).select(X.expand_punct(F.concat(X.split_words(F.lit(text)), F.array(
            *map(F.lit, ["the", "22", "year", "old", "a", "b", "cd", "x_y", "it's", "U.S", "co", "op's", "", "end"]))))).first()[0]:
        known.add(w)
    strip = {k: "".join(c for c in k if c not in X.PUNCTUATION) for k in kws}
    want = len({strip[k] for k in kws if k not in known} - known)
    res = spark.range(1).select(F.col("id").alias("doc_id"), words.alias("keywords"))
    docs = spark.range(1).select(F.col("id").alias("doc_id"), F.lit(text).alias("text"))
    assert tuple(AU.audit_keyterm_words(res, docs).first()) == ("keyterm words", want, len(kws)) and want >= 1
