"""Hot keys: a term held by a third of all doc-term pairs is salted across tasks in the
join with the background, and the keyterms equal a brute-force computation."""

import re
from collections import Counter

from pyspark.sql import functions as F

from termlens.operators import select as SEL
from termlens.operators import skew as SK
from termlens.operators import stats as ST
from termlens.operators import tokens as TK
from termlens.plans import extract as E

K = 5


def _fixture(spark):
    words = [f"w{i}" for i in range(5)]
    rows = [(d, f"the the the only{d} {words[d % 5]}") for d in range(3000)] + [(9000, "zzz")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string").repartition(8)


def _brute(rows):
    terms = {d: sorted(set(t.lower() for t in re.findall(r"[^\W]+", text))) for d, text in rows}
    bg = Counter(t for ts in terms.values() for t in ts)
    n = len(rows)
    out = []
    for d, ts in terms.items():
        ranked = sorted((bg[t], t) for t in ts if bg[t] < n)[:K]
        out += [(d, t, c, r + 1) for r, (c, t) in enumerate(ranked)]
    return sorted(out)


def test_hot_term_is_salted_and_results_exact(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # a shuffle join, as at scale
    try:
        _check_salted(spark)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _check_salted(spark):
    rows, docs = _fixture(spark)
    bg, _ = ST.background_and_size(docs)
    total = bg.select(F.sum("bg_count")).scalar()
    hot = SK.hot_keys(bg, ["term"], "bg_count", total, target_tasks=30)
    assert hot.columns == ["_hash", "_salts"]                # fixed width, whatever the terms are
    rows_of = {r["_hash"]: r["_salts"] for r in hot.collect()}
    the = bg.where("term = 'the'").select(F.xxhash64("term"))
    # 3,000 of the 12,000-odd pairs: a quarter of 30 tasks, rounded up
    assert rows_of[the.first()[0]] == 8 and len(rows_of) <= SK.HOT_DENOMINATOR
    df = E.keyterms(docs, E.ExtractConfig(keyword_stopwords=None, max_doc_keyterms=K))
    got = sorted((r.doc_id, r.term, r.bg_count, r.rank) for r in df.collect())
    assert got == _brute(rows)
    assert "xxhash64" in df._jdf.queryExecution().executedPlan().toString()


def test_salted_rows_spread_over_partitions(spark):
    big = spark.range(3000).select("id", F.lit("hot").alias("key"))
    agg = big.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = SK.salted_join(big, agg, ["key"], "n", agg.select(F.sum("n")).scalar(), "id", target_tasks=64)
        parts = joined.groupBy(F.spark_partition_id()).count().collect()
        assert len(parts) == 4 and max(r["count"] for r in parts) < 1500
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_group_with_a_hot_term(spark):
    # one group holds most rows and one term is in every document of it
    rows = [(d, "big" if d % 10 else "small", f"hot w{d % 50} x{d % 7}") for d in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = {(r.source, r.term): (r.fg_count, r.bg_count) for r in
           ST.significant_terms(docs, "source", size=100).collect()}
    for (source, term), (fg, bg) in got.items():
        held = [s for _, s, text in rows if term in text.split()]
        assert (fg, bg) == (held.count(source), len(held))
    sizes = Counter(s for _, s, _ in rows)
    for term in {t for _, _, text in rows for t in text.split()}:
        held = Counter(s for _, s, text in rows if term in text.split())
        for s in held:
            assert ((s, term) in got) == (held[s] * len(rows) > sum(held.values()) * sizes[s])


def test_salted_join_equals_plain_join(spark):
    big = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(3000)], "id long, key string")
    agg = big.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    total = agg.select(F.sum("n")).scalar()
    salted = SK.salted_join(big, agg, ["key"], "n", total, "id")
    plain = big.join(agg, "key")
    assert sorted(map(tuple, salted.select("id", "key", "n").collect())) == \
        sorted(map(tuple, plain.select("id", "key", "n").collect()))


def test_stopword_dataframe_before_topk_salted(spark):
    rows, docs = _fixture(spark)
    sw = spark.createDataFrame([("the",), ("w1",)], "word string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cfg = E.ExtractConfig(max_doc_keyterms=K, filter_before_topk=True)
        got = sorted(map(tuple, E.keyterms(docs, cfg.with_(keyword_stopwords=sw))
                         .select("doc_id", "term", "rank").collect()))
        want = sorted(map(tuple, E.keyterms(docs, cfg.with_(keyword_stopwords=["the", "w1"]))
                          .select("doc_id", "term", "rank").collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == want and not any(t in ("the", "w1") for _, t, _ in got)


def _plan(spark, df) -> str:
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_texts_are_dealt_before_they_are_analysed(spark):
    """A file of one row group is one task's: its texts are exchanged before the tokeniser."""
    docs = spark.createDataFrame([(i, f"alpha word{i} word{i % 7}", "a") for i in range(40)] + [(None, "alpha beta", "b")],
                                 "doc_id long, text string, source string").coalesce(1)
    for df in (TK.doc_terms(docs), TK.term_frequencies(docs), ST.background(docs), ST.foreground(docs, "source")):
        below = _plan(spark, df).split("Generate explode")[1]
        assert "Exchange hashpartitioning(doc_id" in below
    held = {r["term"]: r["bg_count"] for r in ST.background(docs).collect()}
    assert held["alpha"] == 41 and held["beta"] == 1 and held["word3"] == 6 and held["word30"] == 1


def test_background_is_counted_once(spark):
    """The counts, their sum, the hot terms and the number of documents read one aggregate."""
    docs = spark.createDataFrame([(i, f"alpha word{i} word{i % 7}") for i in range(40)], "doc_id long, text string")
    plan = _plan(spark, SEL.keyterms(docs, k=2))
    assert plan.count("Generate explode(concat(") == 1
