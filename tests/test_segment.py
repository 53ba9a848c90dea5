"""Standard segmentation against the default word boundaries of an independent library."""

import random

import regex
from pyspark.sql import functions as F

from termlens.functions import segment as G
from termlens.functions import text as X
from termlens.operators import tokens as TK
from termlens.plans import extract as E

BOUNDARY = regex.compile(r"(?w)\b")
WORD_CHAR = regex.compile(r"(?V1)[[\p{Alphabetic}\p{Nd}\p{Katakana}\p{Hiragana}\p{Ideographic}]--\p{M}]")

# --- fixed values: cases of the default word boundary rules, words only ---------------------------
CASES = {
    "The quick (“brown”) fox can’t jump 32.3 feet, right?":
        ["The", "quick", "brown", "fox", "can’t", "jump", "32.3", "feet", "right"],
    "été dejà-vu": ["été", "dejà", "vu"],
    "A.B. a:b 1:2 1,234.5 a,b _x_1 x__y U.S.": ["A.B", "a:b", "1", "2", "1,234.5", "a", "b", "_x_1", "x__y", "U.S"],
    "3a a3 a.3 3.a a­b a‍b": ["3a", "a3", "a", "3", "3", "a", "a­b", "a‍b"],
    "カタカナ ひら 漢字 한국어": ["カタカナ", "ひ", "ら", "漢", "字", "한국어"],
    "צה\"ל ג' 'x'": ["צה\"ל", "ג'", "x"],
    "...  __ -- !": [],
}
# ----------------------------------------------------------------------------------------------------


def library_words(text):
    cuts = sorted({0, len(text), *(m.start() for m in BOUNDARY.finditer(text))})
    return [text[a:b] for a, b in zip(cuts, cuts[1:]) if WORD_CHAR.search(text[a:b])]


def words(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    got = dict(df.select("i", X.token_array("t", G.STANDARD_PATTERN)).collect())
    return [got[i] for i in range(len(texts))]


def test_cases(spark):
    assert dict(zip(CASES, words(spark, list(CASES)))) == CASES


MARKS = ["\u0301", "\u0308", "\u093e", "\u00ad", "\u200d", "\u2060"]  # what the rules pass over (WB4)


def test_random_texts_against_the_library(spark):
    # (no vowels: the library keeps an apostrophe with a vowel after it, as French wants it)
    pool = list("cbZž1\u0663\u0968_\u203f.,:;'\u2019\"-\u2013 жבאアーあ漢한กक\u00b7\u066c\u202fxk")
    rng = random.Random(29)
    plain = [" " + "".join(rng.choices(pool, k=rng.randrange(1, 14))) for _ in range(4000)]
    wrong = [(t, got, library_words(t)) for t, got in zip(plain, words(spark, plain)) if got != library_words(t)]
    assert not wrong, wrong[:5]
    # the library treats marks beside punctuation otherwise than the rules; by these a mark changes nothing
    marked = [t[0] + "".join(c + "".join(rng.choices(MARKS, k=rng.choice((0, 0, 1, 2)))) for c in t[1:]) for t in plain]
    for t, m, got in zip(plain, marked, words(spark, marked)):
        assert ["".join(c for c in w if c not in MARKS) for w in got] == library_words(t), m
        assert all(w[0] not in MARKS for w in got)


def test_documents_against_the_library(spark):
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(40).collect()]
    assert words(spark, texts) == [library_words(t) for t in texts]


def test_offsets_terms_and_very_long_words(spark):
    texts = ["He can’t́ say é: 3,5 𝒳x", "a" * 70_000 + ".b" * 40_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = TK.tokenize(df, analyzer="standard").collect()
    assert all(texts[r["doc_id"]][r["start"]:r["end"]] == r["surface"] for r in rows)
    assert [r["term"] for r in sorted(rows, key=lambda r: r["position"]) if r["doc_id"] == 0] == [
        "he", "can’t́", "say", "é", "3,5", "𝒳x"]
    assert sum(r["doc_id"] == 1 for r in rows) == 1


def test_extraction_takes_the_analyzer(spark):
    df = spark.createDataFrame([(1, "été 1,5 chats"), (2, "eté chat 1,5"), (3, "autre")], "doc_id long, text string")
    for analyzer, term in (("standard", "été"), ("standard_light", "été"), ("standard_english", "été")):
        for analysed in (False, True):
            cfg = E.ExtractConfig(keyword_stopwords=None, analyzer=analyzer, use_termvectors=analysed, extract_contexts=True)
            got = {r["doc_id"]: r["keywords"] for r in E.extract(df, cfg).collect()}
            assert term in got[1] and "1,5" in got[2]


def test_plain_words_take_the_short_way(spark):
    """Words of ASCII are matched before the classes of all letters are tried; the words are the same."""
    assert G.STANDARD_PATTERN.index("[0-9A-Za-z]") < G.STANDARD_PATTERN.index(r"\p{Pc}")
    texts = ["a_1 _ __x_ 1.5, a.b. c.' d' e'f g:h i:; j\"k l\". 3,4 _9_ m.", "a\u0301b n\u00ad o. p\u2019 q\u2019r s.\u0301t u'\u0301v",
             "\u05d0' \u05d0\"\u05d1 x\u3042y z\u30a2 w\u203fv 1\u0660 k:\u00e9 _\u4e2d", "end.", "end'", "x", "", "a,b;1;2 1:2 a..b"]
    short = G.STANDARD_PATTERN[G.STANDARD_PATTERN.index(r"|(?:[\p{Pc}") + 1:]
    long = "(?:" + short  # without the lookahead and the short way
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert all(r.a == r.b for r in df.select(X.token_array("t", G.STANDARD_PATTERN).alias("a"), X.token_array("t", long).alias("b")).collect())
