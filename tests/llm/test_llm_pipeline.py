"""The pipeline's stages against brute force on their own inputs, and the registered SQL twins."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from test_llm_duplicates import plain_components, plain_fingerprint

import __spark_entry__ as entry
import corpus_pipeline
from termlens.llm import langid, packing, quality
from termlens.llm.oracle import ORACLE
from termlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "conversations", "labels")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's input and output."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, SF).write.parquet(path)
        made = spark.read.parquet(path)
        out[name] = ({r["doc_id"]: r for r in docs.collect()}, made)
        docs = made
    return out


def test_stage_columns(stages):
    for name, (_, made) in stages.items():
        if name != "packing":
            assert tuple(made.columns) == corpus_pipeline.COLUMNS


def test_quality_stage_keeps_what_the_operator_keeps(spark, stages):
    before, made = stages["quality_rules"]
    judged = quality.judge(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    assert {r["doc_id"] for r in made.collect()} == {r["doc_id"] for r in judged.filter("kept").collect()}


def test_language_stage(spark, stages):
    before, made = stages["language_id"]
    docs = spark.createDataFrame(list(before.values()))
    found = langid.identify(docs, langid.train(docs.filter(~langid.held_out(F.col("doc_id"))))).collect()
    assert {r["doc_id"] for r in made.collect()} == {r["doc_id"] for r in found if r["lang_pred"] != "und" and r["score"] >= corpus_pipeline.MIN_SHARE}


def test_language_stage_rejects_what_is_foreign(spark):
    """Planted: a language nobody labelled, random letters, another script; clean and short texts stay."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rng = np.random.default_rng(3)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz "))
    clean = [r["text"] for r in docs.orderBy(F.desc("n_chars")).limit(6).collect()]
    planted = [
        "Minä olen suomalainen ja puhun suomea joka päivä kotona ystävien kanssa. " * 4,
        "Jestem z Polski i mówię po polsku każdego dnia w domu z rodziną. " * 5,
        "".join(rng.choice(letters, 600)), "Привет, как дела, друзья мои. " * 5, "1234 -- 5678"]
    rows = [(10_000 + k, t, None, "s", len(t)) for k, t in enumerate(planted)]
    rows += [(20_000 + k, t, None, "s", len(t)) for k, t in enumerate([*clean, clean[0] + " " + clean[1], "The of", "\U00030001 a"])]
    tables = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    before, after = ({r["doc_id"] for r in d.select("doc_id").collect()} for d in (
        tables, corpus_pipeline.language_id(spark, tables, SF)))
    assert {i for i in before - after if i >= 10_000} == {10_000 + k for k in range(len(planted))}
    assert not {i for i in before - after if i < 10_000}


def test_near_duplicate_stage_keeps_the_smallest_of_each_component(stages):
    before, made = stages["simhash_dedup"]
    ids = sorted(before)
    label = plain_components([plain_fingerprint(before[i]["text"]) for i in ids], 3)
    assert {r["doc_id"] for r in made.collect()} == {ids[k] for k in set(label)}
    assert all(r["text"] == before[r["doc_id"]]["text"] for r in made.collect())


def test_repeat_stage(stages):
    before, made = stages["suffix_dedup"]
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in made.collect()}
    seen, want = set(), {}
    for i, r in sorted(before.items()):
        data = r["text"].encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - 99):
            if data[p:p + 100] in seen:
                gone[p:p + 100] = True
            seen.add(data[p:p + 100])
        at, left = 0, []
        for c in r["text"]:  # a character goes as a whole
            size = len(c.encode())
            if not gone[at:at + size].any():
                left.append(c)
            at += size
        want[i] = ("".join(left), len(left))
    assert got == want and any(n < len(before[i]["text"]) for i, (_, n) in want.items())


def test_packing_stage(stages):
    before, made = stages["packing"]
    lib = packing.tokenizer(corpus_pipeline.public_tokenizers.path("word_bpe_49k.json")).library
    rows = made.collect()
    tokens = {i: len(lib.encode(r["text"], add_special_tokens=False).ids) + 1 for i, r in before.items()}
    total = {}
    for r in rows:
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["length"]
    assert total == tokens
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert all(sum(n for _, n in v) <= 2048 for v in by.values())


def test_stages_on_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, __id long, kept string, fp int"
    text = " ".join(f"word{k}" for k in range(80))
    rows = [(1, None, None, None, None, 1, "x", 1), (None, "", "en", None, 0, 1, "x", 1), (2, text, "en", "s", 9, 1, "x", 1),
            (2, text, "en", "s", 9, 1, "x", 1), (3, text + " tail", None, "s", None, 1, "x", 1), (3, "other", "de", "s", 5, 1, "x", 1)]
    df = spark.createDataFrame(rows, schema)
    for docs in (df, df.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            made = stage(spark, docs, SF)
            if name != "packing":
                assert tuple(made.columns) == corpus_pipeline.COLUMNS
            n = made.count()
            if name == "suffix_dedup":
                assert n == docs.count()
            if not docs.count():
                assert n == 0


def test_run_is_registered(spark):
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert corpus_pipeline.run(spark, SF).count() > 0
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())
    assert len(QUERIES) == 13


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cur = con.execute(ORACLE[name])
    columns = [c[0] for c in cur.description]
    want = sorted((repr(r) for r in cur.fetchall()))
    df = QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(columns)
    got = sorted(repr(tuple(x.item() if isinstance(x, np.generic) else x for x in r)) for r in df.select(*columns).collect())
    assert got == want
