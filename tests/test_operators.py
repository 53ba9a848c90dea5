"""Sources and statistics on small hand-made fixtures."""

from pyspark.sql import functions as F

from termlens.operators import contexts as CX
from termlens.operators import stats as ST
from termlens.operators import tokens as TK
from termlens.sources import documents as SRC


def test_sentences_to_docs(spark):
    pieces = spark.createDataFrame([(1, t, f"s{t}") for t in range(7)] + [(2, 0, "x"), (2, 1, None)],
                                   "conv_id long, turn long, text string")
    got = {(r.conv_id, r.doc_no): (r.text, r.n_pieces)
           for r in SRC.sentences_to_docs(pieces, 3, "turn", "text", ["conv_id"], sep=" ", id_offset=100).collect()}
    assert got == {(1, 100): ("s0 s1 s2", 3), (1, 101): ("s3 s4 s5", 3), (1, 102): ("s6", 1), (2, 100): ("x", 1)}


def test_random_order_is_seeded_and_partition_free(spark):
    df = spark.range(50).withColumnRenamed("id", "doc_id")
    a = [r.doc_id for r in SRC.random_order(df, 3).collect()]
    b = [r.doc_id for r in SRC.random_order(df.repartition(7), 3).collect()]
    c = [r.doc_id for r in SRC.random_order(df, 4).collect()]
    assert a == b and a != c and sorted(a) == list(range(50))


def test_eligibility_and_fetch(spark):
    df = spark.createDataFrame([(1, "a", 1, None), (2, None, 1, None), (3, "c", None, None), (4, "d", 1, [1])],
                               "doc_id long, text string, quality int, tags array<int>")
    ids = lambda d: sorted(r.doc_id for r in d.collect())
    assert ids(SRC.eligible_ids(df, ["text", "quality", "text"])) == [1, 4]
    assert ids(SRC.eligible_ids(df, ["text"], ["quality"])) == [3]
    assert ids(SRC.eligible_ids(df, ["text"], ["tags"])) == [1, 3]
    assert ids(SRC.docs_by_id(df, [2, 4, 9])) == [2, 4]
    assert ids(SRC.docs_by_id(df, spark.createDataFrame([(3,), (3,)], "x long"))) == [3]


def test_page_fields(spark):
    html = "<html><head><title>My Page</title></head><body><p>Hello <b>there</b></p></body></html>"
    row = SRC.page_fields(spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")).first()
    assert row.title == "My Page" and row.body.split() == ["Hello", "there"]


def test_background_and_size(spark):
    docs = spark.createDataFrame([(1, "a b a"), (2, "b c"), (3, ""), (4, None)], "doc_id long, text string")
    bg, n = ST.background_and_size(docs)
    got = {r.term: r.bg_count for r in bg.where("term != ''").collect()}
    assert got == {"a": 1, "b": 2, "c": 1}
    assert spark.range(1).select(n.alias("n")).first().n == 3


def test_foreground_and_sampling(spark):
    docs = spark.createDataFrame([(1, "g", "x y", 5), (2, "g", "x", 9), (3, "h", "x", 1)],
                                 "doc_id long, source string, text string, n_chars long")
    fg = {(r.source, r.term): r.fg_count for r in ST.foreground(docs, "source").collect()}
    assert fg == {("g", "x"): 2, ("g", "y"): 1, ("h", "x"): 1}
    top = {(r.source, r.doc_id) for r in ST.sampled_foreground(docs, "source", F.col("n_chars"), 1).collect()}
    assert top == {("g", 2), ("h", 3)}


def test_drop_duplicate_passages(spark):
    shared = "one two three four five six seven"
    docs = spark.createDataFrame([(1, "g", f"alpha {shared}"), (2, "g", f"{shared} omega"), (3, "h", shared)],
                                 "doc_id long, grp string, text string")
    toks = TK.tokenize(docs).join(docs.select("doc_id", "grp"), "doc_id")
    kept = ST.drop_duplicate_passages(toks, "grp", shingle=3)
    got = {}
    for r in kept.collect():
        got.setdefault(r.doc_id, []).append(r.term)
    assert sorted(got[1]) == sorted(["alpha"] + shared.split())   # first holder keeps the passage
    # the copy is dropped, except tokens still covered by the unrepeated "six seven omega"
    assert sorted(got[2]) == ["omega", "seven", "six"]
    assert sorted(got[3]) == sorted(shared.split())                # other group: untouched


def test_term_vectors_round_trip(spark):
    docs = spark.createDataFrame([(1, "b a b c")], "doc_id long, text string")
    tv = TK.term_vectors(TK.tokenize(docs))
    occ = {r.term: [(o.position, o.start, o.end) for o in r.occurrences] for r in tv.collect()}
    assert occ == {"a": [(1, 2, 3)], "b": [(0, 0, 1), (2, 4, 5)], "c": [(3, 6, 7)]}
    assert TK.tokens_in_order(tv).first().terms == ["b", "a", "b", "c"]


def test_context_windows_rows(spark):
    hits = spark.createDataFrame([(1, p) for p in (0, 4, 6, 20)], "doc_id long, position long")
    got = sorted((r.island, r.lo, r.hi) for r in CX.context_windows(hits, 3).collect())
    assert got == [(1, 0, 9), (2, 17, 23)]


def test_duplicate_passages_travel_without_tokens(spark):
    """Passages are exchanged as hashes, once; before, every token with its passage was, three times."""
    rows = [(1, "a", "x y z q r s t"), (2, "a", "x y z q r s t"), (3, "a", "n x y z q m"), (4, "b", "x y z q"),
            (5, None, "x y z q"), (6, "a", "x y"), (7, "a", None)]
    docs = spark.createDataFrame(rows, "doc_id long, grp string, text string")
    grouped = ST.drop_duplicate_passages(ST.grouped_tokens(docs, "grp"), "grp", 3)
    toks = TK.tokenize(docs).join(docs.select("doc_id", "grp"), "doc_id")
    kept = ST.drop_duplicate_passages(toks, "grp", 3).select("doc_id", "grp", "position", "term")
    assert sorted(map(str, grouped.collect())) == sorted(map(str, kept.collect()))
    at = [(r.doc_id, r.position) for r in grouped.select("doc_id", "position").collect()]
    assert [p for d, p in sorted(at) if d == 2] == [] and [p for d, p in sorted(at) if d == 3] == [0, 1, 2, 3, 4, 5]
    assert len([1 for d, _ in at if d in (1, 4, 5, 6)]) == 7 + 4 + 4 + 2
    plan = grouped._jdf.queryExecution().executedPlan().toString()
    assert not any("Exchange" in line and ("term" in line or "surface" in line) for line in plan.splitlines())
