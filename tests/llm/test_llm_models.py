"""Quality rules, language ID and top-k: plain counts, held-out accuracy, brute force."""

import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from termlens.llm import langid, quality, topk
from termlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    twice = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(twice))


def test_rule_counts():
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice(["a", "b", "é", " ", "\n", "\t", "\x0b", "\x1c", "\x85", "\xa0", "#", "|", "A", "1", "\r"])
                       for _ in range(rng.randint(0, 80)))
        assert quality.count_text(text)[:5] == plain_counts(text), repr(text)
    assert quality.count_text(None)[:5] == (0, 0, 0, 0, 0)


def test_quality_query(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = QUERIES["op8_quality_rules"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        if len(texts[r["doc_id"]]) < 5000:
            assert tuple(r)[1:6] == plain_counts(texts[r["doc_id"]])
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])
    open_ = [r for r in rows if not r["base_failed"] and r["doc_id"] in labels]
    good = [r["kept"] for r in open_ if labels[r["doc_id"]] == 1]
    bad = [r["kept"] for r in open_ if labels[r["doc_id"]] == 0]
    assert np.mean(good) >= 0.98 and (not bad or np.mean(bad) <= 0.2)


def test_quality_edge_rows(spark):
    text = " ".join(f"word{k}" for k in range(60))
    df = spark.createDataFrame([(1, None, 1), (None, "", 1), (2, text, 1), (2, text, 1), (3, "x " * 100000, 1)],
                               "doc_id long, text string, kept int")
    marks = spark.createDataFrame([(1, 0), (2, None), (None, 1), (2, 1), (2, 0)], "doc_id long, quality int")
    for labels in (marks, marks.limit(0), None):
        got = {(r["doc_id"], r["n_words"], r["base_failed"]) for r in quality.judge(df, labels).collect()}
        assert got == {(1, 0, True), (None, 0, True), (2, 60, False), (3, 100000, True)}
    assert quality.judge(df.limit(0), marks).count() == 0
    assert quality.keep_good(df, None).columns == df.columns and quality.keep_good(df, None).count() == 2


def test_trees_draw_from_all_rows_whatever_the_partitions(spark):
    counts = {c: F.col("id") % (7 + k) + 100 for k, c in enumerate(quality.COUNTS)}
    stats = spark.range(40000).select(F.col("id").alias("doc_id"), *[v.alias(c) for c, v in counts.items()])
    stats = stats.withColumn("n_repeat_words", F.lit(0).cast("long")).withColumn("word_chars", F.col("doc_id") + 100)
    draws = quality.draw(stats)
    assert [len(d) for d in draws] == [quality.SUBSAMPLE] * quality.N_TREES
    assert len({r for d in draws for r in d[:, 1].tolist()}) > 20000  # chars tell the rows apart
    for other in (stats.repartition(7), stats.union(stats.limit(1)).repartition(3)):  # a repeated row counts once
        assert all(np.array_equal(a, b) for a, b in zip(draws, quality.draw(other)))
    few = quality.draw(stats.limit(30))
    assert [len(d) for d in few] == [30] * quality.N_TREES and quality.draw(stats.limit(0)) == []


def test_forest_paths_are_short_for_what_is_apart():
    rng = np.random.default_rng(3)
    rows = np.r_[rng.normal(0, 1, (500, 3)), [[9, 9, 9]]]
    forest = quality.Forest.fit(rows, seed=5)
    score = forest.score(rows)
    assert score.argmax() == 500 and score[500] > 0.6 and np.median(score) < 0.5

    def path(tree, row):
        at, depth = 0, 0
        feature, value, left, length = (x[tree] for x in (forest.feature, forest.value, forest.left, forest.length))
        while feature[at] >= 0:
            at, depth = left[at] + (row[feature[at]] > value[at]), depth + 1
        return length[at]

    for k in (0, 17, 500):
        mean = np.mean([path(t, rows[k]) for t in range(len(forest.feature))])
        assert score[k] == pytest.approx(2 ** (-mean / float(quality._expected(256))))


def test_forest_of_nearly_equal_values_grows():
    tiny = np.nextafter(1.0, 2.0)
    rows = np.array([[1.0], [tiny]] * 200)
    assert len(quality.Forest.fit(rows).feature) == quality.N_TREES


def test_language_query_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    import zlib
    rows = QUERIES["op1_language_id"](spark, sf).collect()
    assert len(rows) == len(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    apart = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in apart]) >= 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


EN = "the house stands near the river and the people walk there with their children every evening when it is warm "
DE = "das haus steht nahe am fluss und die leute gehen dort mit ihren kindern jeden abend wenn es warm ist "
RU = "дом стоит у реки и люди гуляют там со своими детьми каждый вечер когда тепло "


@pytest.fixture(scope="module")
def model(spark):
    rows = [(x, k) for k, x in (("en", EN), ("de", DE), ("ru", RU))] + [("junk", None), (None, "en")]
    return langid.train(spark.createDataFrame(rows, "text string, lang string"))


def test_copies_of_a_text_are_learned_once(spark):
    rows = [(f"{EN} {k}", "en") for k in range(5)] + [(f"{DE} anders{k}", "de") for k in range(5)]
    once = langid.train(spark.createDataFrame(rows, "text string, lang string"))
    copied = langid.train(spark.createDataFrame(rows + [rows[0]] * 500, "text string, lang string"))
    assert np.array_equal(once.table, copied.table) and np.array_equal(once.scripts, copied.scripts)


def test_texts_mostly_in_unlearned_scripts_go(spark):
    import zlib
    ids = [k for k in range(100) if zlib.crc32(str(k).encode()) % 3 != 1]  # learned from
    apart = [k for k in range(100) if zlib.crc32(str(k).encode()) % 3 == 1]
    texts = [EN, RU, EN * 2 + RU, EN + RU * 2, "中文" * 20, "中文 " + DE, "123", "ÀÉ " + EN]
    rows = [(ids[0], EN * 3, "en"), (ids[1], DE * 3, "de")] + [(k, t, None) for k, t in zip(apart, texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r["text"] for r in langid.keep_identified(df, 0.3).collect()}
    assert kept == {EN * 3, DE * 3, EN, EN * 2 + RU, "中文 " + DE, "ÀÉ " + EN}
    russian = df.unionByName(spark.createDataFrame([(ids[2], RU, "ru")], df.schema))
    assert {RU, EN + RU * 2} <= {r["text"] for r in langid.keep_identified(russian, 0.3).collect()}


def test_mixed_text_gets_spans(model):
    text = EN + DE + RU + EN
    lang, score, spans = model.predict([text, RU, "", "123 !", DE * 3])
    assert lang == ["en", "ru", "und", "und", "de"] and score[2] == 0 and score[1] == 1
    assert [s["lang"] for s in spans[0]] == ["en", "de", "ru", "en"]
    marks = [0, len(EN), len(EN + DE), len(EN + DE + RU)]
    assert all(abs(s["start"] - m) <= 8 for s, m in zip(spans[0], marks))


def test_viterbi_equals_dynamic_programming(model):
    rng = random.Random(4)
    words = (EN + DE + RU).split()
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 15))) for _ in range(60)]
    owner, _, _, scores = model.words_of(texts)
    label = model.label(scores, owner)
    for t in range(len(texts)):
        own = scores[:, owner == t].astype(float)
        picked = label[owner == t]
        n = own.shape[1]
        if not n:
            continue
        best = own[:, 0]
        for k in range(1, n):
            best = np.maximum(best, best.max() - langid.SWITCH) + own[:, k]
        got = sum(own[picked[k], k] for k in range(n)) - langid.SWITCH * int((picked[1:] != picked[:-1]).sum())
        assert got == pytest.approx(best.max(), abs=0.05)


def test_long_text_in_parts(model, monkeypatch):
    whole = model.predict([EN * 30 + DE * 30, RU])
    monkeypatch.setattr(langid, "text_parts", lambda text, parts=langid.text_parts: parts(text, 500))
    lang, score, spans = model.predict([EN * 30 + DE * 30, RU])
    assert (lang, spans) == (whole[0], whole[2]) and np.allclose(score, whole[1])


def test_language_edge_rows(spark, model):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (2, "", "x"), (None, EN * 2000, "x"), (3, "№ 5", "x")],
                               "doc_id long, text string, score string")
    got = sorted((r["doc_id"] or -1, r["lang_pred"]) for r in langid.identify(df, model).collect())
    assert got == [(-1, "en"), (1, "und"), (2, "und"), (2, "und"), (3, "und")]
    assert langid.identify(df.limit(0), model).count() == 0
    empty = langid.train(spark.createDataFrame([], "text string, lang string"))
    assert {r["lang_pred"] for r in langid.identify(df, empty).collect()} == {"und"}


def plain_topk(rows, k, is_query):
    good = [(i, np.floor(np.array(v, float) * 64)) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for q, x in good:
        if is_query(q):
            best = sorted({(-int(x @ y), i) for i, y in good if i != q})[:k]
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(best)}
    return out


def run_topk(spark, rows, k=5, step=4):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = topk.nearest(df.repartition(3).withColumn("vec", F.lit(1)), F.col("vec_id") % step == 0, k).collect()
    assert {tuple(r) for r in got} == plain_topk(
        [(i, None if v is None else [None if x is None else np.float32(x) for x in v]) for i, v in rows], k, lambda i: i % step == 0)


@pytest.mark.parametrize("annulus", [2048, 16])
def test_topk_equals_brute_force(spark, monkeypatch, annulus):
    monkeypatch.setattr(topk, "ANNULUS", annulus)
    monkeypatch.setattr(topk, "PIVOTS", 4)
    rng = np.random.default_rng(2)
    centres = rng.normal(0, 1, (5, 8))
    rows = [(k, (centres[k % 5] + rng.normal(0, 0.2, 8)).tolist()) for k in range(150)]
    rows += [(1000 + k, [0.5] * 8) for k in range(40)]  # a group of copies larger than k
    rows += [(2000 + k, [0.0] * 8) for k in range(3)]
    run_topk(spark, rows)


def test_topk_edge_rows(spark):
    rows = [(0, [1.0, 2.0]), (4, [1.0, None]), (8, None), (12, [float("nan"), 1.0]), (16, [float("inf"), 0.0]), (None, [1.0, 1.0]),
            (3, [-1.0, 0.5]), (20, [1.0, 2.0])]
    run_topk(spark, rows)
    run_topk(spark, [(0, [1.0, 1.0])])
    run_topk(spark, [])


def test_topk_unusable_vectors_change_nothing(spark):
    """Longer vectors with nulls outnumber the usable ones; repeated ids and rows; two widths."""
    usable = [(0, [1.0, 2.0]), (4, [0.5, 0.5]), (7, [2.0, 1.0])]
    broken = [(k, [1.0, None, float("nan")]) for k in range(100, 104)] + [(200, [1.0, float("-inf"), 2.0])]
    run_topk(spark, usable + broken)
    assert topk.nearest(spark.createDataFrame(usable + broken, "vec_id long, embedding array<double>"),
                        F.col("vec_id") == 0).count() == 2
    narrow = [(300, [1.0]), (304, [2.0])]
    df = spark.createDataFrame(usable + narrow, "vec_id long, embedding array<double>")
    assert {tuple(r) for r in topk.nearest(df, F.col("vec_id") % 4 == 0, 5).collect()} == plain_topk(
        usable, 5, lambda i: i % 4 == 0)
    # a repeated row is one candidate; an id with two vectors asks for each, and never finds itself
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (2, [3.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in topk.nearest(df, F.col("vec_id") % 2 == 0, 5).collect())
    assert got == [(0, 1, 2, 12288), (0, 2, 1, 4096), (0, 3, 2, 0),
                   (2, 1, 0, 0), (2, 1, 0, 12288), (2, 2, 1, 0), (2, 2, 1, 12288)]


@pytest.mark.parametrize("bits", [0, 1])
def test_topk_many_runs_and_query_blocks(spark, monkeypatch, bits):
    monkeypatch.setattr(topk, "ANNULUS", 5)
    monkeypatch.setattr(topk, "QUERIES", 7)
    monkeypatch.setattr(topk, "RING_BITS", bits)
    monkeypatch.setattr(topk, "PIVOTS", 3)
    rng = np.random.default_rng(4)
    run_topk(spark, [(k, rng.normal(0, 1, 4).tolist()) for k in range(130)], k=3)


def test_topk_makes_no_row_per_query_and_annulus(spark, monkeypatch):
    """What the grouped Python steps hand on grows with queries and vectors, not with queries times annuli."""
    from pyspark.sql.pandas.group_ops import PandasCogroupedOps, PandasGroupedOpsMixin
    made = []
    for kind, name in itertools.product((PandasCogroupedOps, PandasGroupedOpsMixin), ("applyInPandas", "applyInArrow")):
        monkeypatch.setattr(kind, name, lambda *a, f=getattr(kind, name), **b: made.append(f(*a, **b)) or made[-1])
    for name, value in (("ANNULUS", 5), ("QUERIES", 50), ("PIVOTS", 3), ("GROUPS", 1)):
        monkeypatch.setattr(topk, name, value, raising=False)
    rng = np.random.default_rng(6)
    run_topk(spark, [(k, rng.normal(0, 1, 12).tolist()) for k in range(160)], k=3)
    assert max(df.count() for df in made) <= 160


def test_topk_vectors_of_all_integer_widths(spark):
    """Components that need one, two or four bytes in one table; equal vectors stay one class."""
    rows = [(k, [(-1.0) ** k * 10.0 ** (k % 7), k % 3 - 1.0, 1.984375 * (k % 2)]) for k in range(60)]
    run_topk(spark, rows + [(100 + k, x) for k, x in rows[:20]])
    run_topk(spark, [(k, [0.5 * k, -1.0]) for k in (0, 4, 3, -4, -5)])


def test_topk_query(spark):
    rows = [(r["vec_id"], list(r["embedding"])) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = {tuple(r) for r in QUERIES["op6_exact_topk"](spark, SF).collect()}
    assert got == plain_topk(rows, 20, lambda i: i % 20 == 0)
