"""Fragment and word-window rules: the README sample and sequential versions of both
rules compared with the Spark expressions on random hits."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SAMPLE1_CONTEXTS, SAMPLE1_KEYWORDS, SAMPLE1_OFFSETS, SAMPLE1_TEXT
from termlens.operators import contexts as CX
from termlens.plans import extract as E

WORD = re.compile(r"[^\W]")


def seq_fragments(text, hits, size=100, maxf=8):
    """Sequential statement of the raw fragment rule; returns (windows, kept hits)."""
    hits = sorted(hits)
    groups = []
    kept = []
    for s, e in hits:
        if groups and e - groups[-1][0] <= size:
            groups[-1][1] = e
        elif len(groups) < maxf:
            groups.append([s, e])
        else:
            break
        kept.append((s, e))
    out, prev, n = [], 0, len(text)
    isw = lambda c: bool(WORD.match(c))
    for fs, fe in groups:
        pad = max(0, (size - (fe - fs)) // 2)
        ws, we = fs - pad, fe + pad
        if ws < 0:
            ws, we = 0, size
        if we > n:
            ws, we = n - size, n
        ws, we = max(ws, 0), min(we, n)
        while ws > 0 and isw(text[ws - 1]) and isw(text[ws]):
            ws -= 1
        while we < n and isw(text[we - 1]) and isw(text[we]):
            we += 1
        out.append((max(ws, prev), we))
        prev = fe
    return out, kept


def union_of_intervals(positions, w):
    """One closed interval per hit, and the union of those that touch, on a grid of half steps."""
    covered = {x for p in positions for x in range(2 * (p - w), 2 * (p + w) + 1)}
    starts = sorted(x for x in covered if x - 1 not in covered)
    ends = sorted(x for x in covered if x + 1 not in covered)
    return [(max(s // 2, 0), e // 2) for s, e in zip(starts, ends)]


def test_readme_sample_raw(spark):
    docs = spark.createDataFrame([(1, SAMPLE1_TEXT)], "doc_id long, text string")
    kt = spark.createDataFrame([(1, k.lower()) for k in SAMPLE1_KEYWORDS], "doc_id long, term string")
    row = E.locate(docs, kt, extract_contexts=True).first()
    assert row.keywords == SAMPLE1_KEYWORDS
    assert [[(o.start, o.end) for o in offs] for offs in row.offsets] == SAMPLE1_OFFSETS
    assert row.contexts == SAMPLE1_CONTEXTS


def test_readme_sample_analyzed_shape(spark):
    # fixed values: the text and terms of worked sample 2
    text = ("Rice has not played since injuring a knee in the opener with Maryland . He's looking a lot better , "
            "Meek explained . We'll let him do a lot of running , Meek said .")
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    terms = ["explain", "lot", "maryland", "meek", "rice", "we'll"]
    kt = spark.createDataFrame([(1, t) for t in terms], "doc_id long, term string")
    row = E.locate(docs, kt, use_termvectors=True, extract_contexts=True).first()
    assert row.keywords == sorted(terms)
    for kw, offs in zip(row.keywords, row.offsets):
        assert len(offs) == (2 if kw in ("lot", "meek") else 1)
        for o in offs:
            assert text[o.start:o.end].lower().startswith(kw[:3])
    assert all(any(k in c for c in row.contexts) for k in row.keywords)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=400), min_size=1, max_size=30, unique=True),
       st.integers(min_value=1, max_value=4), st.integers(min_value=20, max_value=120))
def test_fragments_equal_sequential_rule(spark, starts, maxf, size):
    text = ("lorem ipsum dolor sit amet consectetur " * 12)[:430]
    hits = sorted({(s, min(s + 3, len(text))) for s in starts})
    # keep hits disjoint like real tokens
    dis = []
    for s, e in hits:
        if not dis or s >= dis[-1][1]:
            dis.append((s, e))
    df = spark.createDataFrame([(text, [{"start": s, "end": e} for s, e in dis])],
                               "t string, h array<struct<start:bigint,end:bigint>>")
    fg = CX.fragment_groups(F.col("h"), size, maxf)
    row = df.select(CX.fragment_windows(fg["groups"], F.col("t"), size).alias("w"),
                    F.filter("h", lambda x: fg["cut"].isNull() | (x["start"] < fg["cut"])).alias("k")).first()
    want_w, want_k = seq_fragments(text, dis, size, maxf)
    assert [(w.start, w.end) for w in row.w] == want_w
    assert [(k.start, k.end) for k in row.k] == want_k


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=200), min_size=1, max_size=40, unique=True),
       st.integers(min_value=1, max_value=6))
def test_islands_are_the_union_of_intervals(spark, positions, w):
    df = spark.createDataFrame([(sorted(positions),)], "p array<bigint>")
    got = df.select(CX.island_windows(CX.islands(F.col("p"), w), w, inclusive=False).alias("x")).first().x
    assert [(x.lo, x.hi + 1) for x in got] == union_of_intervals(positions, w)


def test_window_edges_inside_long_words(spark):
    # words longer than the bounded look-around on both window edges
    long_left, long_right = "a" * 150, "b" * 170
    text = f"{long_left} key {long_right} tail"
    hits = [(151, 154)]
    df = spark.createDataFrame([(text, [{"start": 151, "end": 154}])],
                               "t string, h array<struct<start:bigint,end:bigint>>")
    fg = CX.fragment_groups(F.col("h"), 100, 8)
    row = df.select(CX.fragment_windows(fg["groups"], F.col("t"), 100).alias("w")).first()
    want, _ = seq_fragments(text, hits, 100, 8)
    assert [(w.start, w.end) for w in row.w] == want == [(0, len(long_left) + 5 + len(long_right))]
