"""P1, P2, S1, E2 over fields that are no plain column: absent, dotted, nested, VARIANT; repeated ids."""

import json

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from termlens.operators import tokens as TK
from termlens.plans import extract as E
from termlens.sources import documents as SRC

RAW = E.ExtractConfig(keyword_stopwords=None)


def ids(df):
    return sorted(r[0] for r in df.select("doc_id").collect())


def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_absent_field_exists_nowhere(spark):
    d = docs(spark, ["a b", None, "c"])
    assert ids(SRC.eligible_docs(d, ["text"], ["keywords", "meta.done", "text.x"])) == [0, 2]
    assert ids(SRC.eligible_docs(d, ["keywords"])) == []
    assert ids(E.eligible(d, RAW.with_(must_not_have_fields=("keywords",)))) == [0, 2]


def test_dotted_paths_into_structs_maps_arrays(spark):
    rows = [(1, ({"k": "v"}, [("x",)], None), "p"), (2, ({"k": None}, [], 5), "p"), (3, ({}, [(None,)], 5), None), (4, None, "p")]
    df = spark.createDataFrame(rows, "doc_id long, m struct<tags: map<string,string>, parts: array<struct<t: string>>, n: int>, `a.b` string")
    has = lambda f: ids(df.where(SRC.field_exists(df, f)))
    lacks = lambda f: ids(df.where(SRC.field_missing(df, f)))
    assert (has("m.tags.k"), has("m.tags"), has("m.parts.t"), has("m.parts"), has("m.n")) == ([1], [1], [1], [1], [2, 3])
    assert (has("m"), has("a.b"), has("m.other"), has("m.n.deeper")) == ([1, 2, 3], [1, 2, 4], [], [])
    for f in ("m.tags.k", "m.parts.t", "m.n", "a.b", "m.other"):
        assert sorted(has(f) + lacks(f)) == [1, 2, 3, 4]


def test_variant_documents(spark, tmp_path):
    bodies = [{"id": 1, "a": {"b": "x", "c.d": 1}, "t": [None]}, {"id": 2, "a": {"b": None}, "t": ["", None]},
              {"id": "q", "a": 3, "t": {"k": {"z": None}}}, {"a": {"b": {"deep": [[False]]}}, "t": "\":"}, {"id": 5, "a'\\": 0}]
    path = tmp_path / "docs.json"
    path.write_text("\n".join(map(json.dumps, bodies)))
    df = SRC.read_json_documents(spark, str(path), "id")
    got = df.select("doc_id", SRC.field_exists(df, "a.b", "doc"), SRC.field_exists(df, "doc.t"), SRC.field_exists(df, "a'\\", "doc"),
                    SRC.field_text(df, "a.b", "doc")).collect()
    assert sorted(map(tuple, got), key=str) == sorted([
        (1, True, False, False, "x"), (2, False, True, False, None), (None, False, False, False, None),
        (None, True, True, False, None), (5, False, False, True, None)], key=str)
    with pytest.raises(TypeError):
        SRC.field_text(df.select(F.array("doc_id").alias("l")), "l")


def test_extract_from_variant_equals_plain(spark):
    plain = docs(spark, ["alpha beta beta", "beta gamma", None, "delta alpha"])
    body = plain.select("doc_id", F.parse_json(F.to_json(F.struct(F.struct("text").alias("c")))).alias("doc"))
    cfg = RAW.with_(extract_contexts=True)
    want = sorted(map(str, E.extract(plain, cfg).collect()))
    assert sorted(map(str, E.extract(body, cfg.with_(keyword_col="c.text", body_col="doc")).collect())) == want
    nested = plain.select("doc_id", F.struct("text").alias("c"))
    assert sorted(map(str, E.extract(nested, cfg.with_(keyword_col="c.text")).collect())) == want
    assert sorted(map(str, E.extract(nested, cfg.with_(keyword_col="c.text", highlight_col="c.text")).collect())) == want
    assert E.extract(plain, cfg.with_(keyword_col="none.such")).count() == 0


def test_first_incremental_run_is_the_whole_extraction_and_the_second_empty(spark):
    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(60)
    first = E.incremental_extract(d, RAW)
    assert sorted(map(str, first.collect())) == sorted(map(str, E.extract(d, RAW).collect()))
    written = d.join(first, "doc_id", "left")
    left = ids(E.incremental_extract(written, RAW))
    assert left == ids(written.where(F.col("keywords").isNull() & F.col("text").isNotNull()))


def test_repeated_ids(spark):
    d = spark.createDataFrame([(1, "alpha beta"), (1, "gamma delta"), (2, "alpha x")], "doc_id long, text string")
    with pytest.raises(Exception, match="more than one document with id 1"):
        TK.tokenize(d).collect()
    d = d.union(spark.createDataFrame([(2, "...")], d.schema))
    for cfg in (RAW, RAW.with_(use_termvectors=True, analyzer="light"), RAW.with_(use_termvectors=True)):
        with pytest.raises(Exception, match="more than one document with id"):
            E.extract(d, cfg).collect()
    with pytest.raises(Exception, match="more than one document with id 2"):  # also beside a text without tokens
        E.extract(d.where("doc_id = 2"), RAW).collect()
    # a repeated id that is not eligible does no harm
    one = spark.createDataFrame([(2, "alpha x"), (2, None)], d.schema)
    assert len(E.extract(one, RAW).collect()) == 1


def test_no_further_exchange_for_the_check(spark):
    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    plan = TK.tokenize(d)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_keyterms_through_the_highlight_fields_own_analyzer(spark):
    rows = [(1, "Third-inning third e.g. third,inning (New-York)", "the third inning; new york, third INNING third inning. e.g"),
            (2, "third --", "third -- inning"), (3, "plain york", "york")]
    df = spark.createDataFrame(rows, "doc_id long, k string, h string")
    cfg = E.ExtractConfig(keyword_col="k", highlight_col="h", analyzer="whitespace", highlight_analyzer="lower",
                          keyword_stopwords=None, extract_contexts=True)
    got = {r["doc_id"]: r for r in E.extract(df, cfg).collect()}
    offsets = [[(o["start"], o["end"]) for o in os] for os in got[1]["offsets"]]
    assert got[1]["keywords"] == ["third inning", "new york", "third INNING", "e.g"]
    assert offsets == [[(4, 16), (41, 53)], [(18, 26)], [(28, 40)], [(55, 58)]]
    assert all(rows[0][2][a:b] == k for k, os in zip(got[1]["keywords"], offsets) for a, b in os)
    assert got[2]["keywords"] == ["third"] and got[3]["keywords"] == ["york"]
    with pytest.raises(ValueError):
        E.extract(df, cfg.with_(highlight_analyzer="english"))
