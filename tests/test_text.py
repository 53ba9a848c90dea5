import re

from pyspark.sql import functions as F

from termlens.functions import stem as S
from termlens.functions import text as X
from termlens.operators import tokens as TK


def _one(spark, col_expr, value, schema="t string"):
    return spark.createDataFrame([(value,)], schema).select(col_expr.alias("r")).first()["r"]


def test_token_pattern_cases(spark):
    got = _one(spark, X.token_array("t"), "He'll said U.S. 22-year-old Ky. .The")
    assert got == ["He'll", "said", "U.S", "22", "year", "old", "Ky", "The"]


def test_offsets_code_points(spark):
    text = "Ça 😀 naïve café 𝔘nicode end"
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    rows = TK.tokenize(df, analyzer="none").orderBy("position").collect()
    assert [r.surface for r in rows] == ["Ça", "naïve", "café", "𝔘nicode", "end"]
    for r in rows:
        assert text[r.start:r.end] == r.surface
    assert [r.position for r in rows] == list(range(5))


def test_tokenize_empty_null_punct(spark):
    df = spark.createDataFrame([(1, ""), (2, None), (3, "... !!! --"), (4, "a")], "doc_id long, text string")
    rows = TK.tokenize(df).collect()
    assert [(r.doc_id, r.surface, r.start, r.end) for r in rows] == [(4, "a", 0, 1)]


def test_tokenize_matches_python_regex(spark):
    texts = ["Hello, world! It's 3.14 o'clock.", "  leading and trailing  ", "x’y z.w. end.", "İstanbul ŞEHİR"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r.doc_id, r.position): (r.surface, r.start, r.end) for r in TK.tokenize(df, analyzer="none").collect()}
    pat = re.compile(r"[^\W]+(?:['’.][^\W]+)*")
    want = {}
    for i, t in enumerate(texts):
        for p, m in enumerate(pat.finditer(t)):
            want[(i, p)] = (m.group(0), m.start(), m.end())
    assert got == want


def test_light_stem(spark):
    words = ["ponies", "aies", "horses", "shoes", "cats", "bus", "glass", "is", "flies"]
    df = spark.createDataFrame([(w,) for w in words], "t string")
    got = [r.r for r in df.select(X.light_stem("t").alias("r")).collect()]
    assert got == ["pony", "aie", "horse", "shoe", "cat", "bus", "glass", "i", "fly"]


def test_porter_golden_words():
    # Terms of the README's analysed sample, and published examples of the algorithm.
    pairs = {"explained": "explain", "reserves": "reserv", "scrimmaged": "scrimmag", "thursday": "thursdai",
             "friday": "fridai", "players": "player", "this": "thi", "has": "ha", "he's": "he'", "we'll": "we'll",
             "probably": "probabl", "opener": "open", "caresses": "caress", "ponies": "poni", "relational": "relat",
             "generalizations": "gener", "oscillators": "oscil", "hopping": "hop", "controll": "control",
             "as": "as", "i": "i", "45": "45"}
    for w, s in pairs.items():
        assert S.porter_stem(w) == s, w


def test_porter_udf_and_map(spark):
    df = spark.createDataFrame([(["running", "ran", "runs"],)], "w array<string>")
    assert df.select(S.stem_words("w").alias("r")).first().r == ["run", "ran", "run"]


def test_expand_and_strip(spark):
    got = _one(spark, X.expand_punct(F.array(F.col("t"))), "22-year-old")
    assert set(got) == {"22-year-old", "22", "year", "old", "22yearold"}
    # underscores join, marks are pieces of their own, other punctuation only separates
    got = _one(spark, X.expand_punct(F.array(F.col("t"))), "snake_case's(end)!?")
    assert set(got) == {"snake_case's(end)!?", "snake_case", "'", "s", "end", "!", "?", "snakecasesend"}
    assert set(_one(spark, X.expand_punct(F.array(F.col("t"))), "--")) == {"--", ""}
    assert _one(spark, X.strip_punct("t"), "U.S.") == "US"


def test_marks_round_trip(spark):
    text = "a bc def"
    df = spark.createDataFrame([(text, [(2, 4), (5, 8)])], "t string, h array<struct<start:bigint,end:bigint>>")
    marked = df.select(X.mark_terms("t", "h").alias("m")).first().m
    assert marked == "a <em>bc</em> <em>def</em>"
    row = spark.createDataFrame([(marked,)], "m string").select(
        X.marked_terms("m").alias("terms"), X.unmark("m").alias("plain")).first()
    assert row.terms == ["bc", "def"] and row.plain == text


def test_parse_offsets(spark):
    got = _one(spark, X.parse_offsets("t"), "0:0-7,56-66:105")
    assert [(r.start, r.end) for r in got] == [(0, 7), (56, 66)]


def test_tokens_are_placed_inside_their_row(spark):
    """No row per token is sorted for its offsets; sums go on over the blocks of ``running_starts``."""
    text = "".join(f"{'é' * (i % 3)}w{i}{' ' * (i % 5 + 1)}" for i in range(1000))
    df = spark.createDataFrame([(1, text), (2, ""), (3, "--"), (4, None)], "doc_id long, text string")
    rows = sorted(TK.tokenize(df, analyzer="none").collect(), key=lambda r: r.position)
    assert [r.position for r in rows] == list(range(1000))
    assert all(text[r.start:r.end] == r.surface for r in rows) and rows[-1].surface.endswith("w999")
    plan = TK.tokenize(df)._jdf.queryExecution().executedPlan().toString()
    assert "position" not in "".join(line for line in plan.splitlines() if "Sort " in line or "Window " in line)
    assert "regexp_extract_all" not in "".join(line for line in plan.splitlines() if "Filter" in line)


def test_gathered_vectors_equal_rows(spark):
    df = spark.createDataFrame([(1, "b a b c a b"), (2, ""), (3, "--"), (4, None), (5, "x")], "doc_id long, text string")
    rows = TK.term_vectors(TK.tokenize(df))
    gathered = TK.tokenize(df, gathered=True)
    assert sorted(map(str, TK.term_vectors(gathered).collect())) == sorted(map(str, rows.collect()))
    order = TK.tokens_in_order(TK.term_vectors(gathered, gathered=True))
    assert sorted(map(str, order.collect())) == sorted(map(str, TK.tokens_in_order(rows).collect()))
    assert "Aggregate" not in order._jdf.queryExecution().executedPlan().toString()


def test_offsets_are_summed_in_batches(spark):
    """Before, each document's lengths were folded one by one, which took longer than all other steps."""
    df = spark.createDataFrame([(i, "é b  c" * (i % 4) if i % 5 else None) for i in range(40)], "doc_id long, text string")
    plan = TK.tokenize(df)._jdf.queryExecution().executedPlan().toString()
    assert "aggregate(" not in plan and "ArrowEvalPython" in plan
    texts = dict(df.collect())
    rows = TK.tokenize(df.coalesce(1), analyzer="none", prepartition=False).collect()
    assert len(rows) == sum(len(re.findall(r"\w+", t)) for t in texts.values() if t)
    assert all(texts[r.doc_id][r.start:r.end] == r.surface for r in rows)
