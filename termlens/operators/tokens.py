"""Tokens with positions and character offsets, analysed terms, term vectors.

Long form is the rule: one row per token occurrence, ``(id, position, surface, term,
start, end)``, offsets 0-based, end exclusive, counted in code points (Python slicing and
Spark ``substring`` agree).

Offsets are counted inside each document's row (``gather_tokens``, ``functions.places``).  The documents are hash-partitioned on ``id`` *before* the explode, so
Spark shuffles the text (small) instead of the token rows (about seven times larger), the check
for repeated ids sorts documents and not tokens, and every later per-document step reuses that
partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import places as P
from ..functions import segment as G
from ..functions import stem as S
from ..functions import text as X

#: An analyzer names its tokeniser and what becomes of the tokens.
ANALYZERS = {
    "none": (X.TOKEN_PATTERN, "none"), "lower": (X.TOKEN_PATTERN, "lower"),
    "english": (X.TOKEN_PATTERN, "english"), "light": (X.TOKEN_PATTERN, "light"),
    "whitespace": (X.WHITESPACE_PATTERN, "lower"),
    "standard_none": (G.STANDARD_PATTERN, "none"), "standard": (G.STANDARD_PATTERN, "lower"),
    "standard_english": (G.STANDARD_PATTERN, "english"), "standard_light": (G.STANDARD_PATTERN, "light"),
}


def _analyzer(name: str) -> tuple[str, str]:
    if name not in ANALYZERS:
        raise ValueError(f"unknown analyzer {name!r}; expected one of {tuple(ANALYZERS)}")
    return ANALYZERS[name]


def token_array(text, analyzer: str = "lower") -> Column:
    """T1, no offsets: the tokens of a text under the analyzer's tokeniser."""
    return X.token_array(text, _analyzer(analyzer)[0])


def analyze_array(tokens: Column, analyzer: str = "lower") -> Column:
    """T4: map an array of surface tokens to an aligned array of terms.

    ``none``: as written; ``lower``: T2; ``english``: T2 then the Porter stemmer (T3); ``light``: T2
    then the S-stemmer; ``whitespace``: T2 over what white space parts.  ``standard`` and ``standard_...`` do the same to tokens of the standard
    segmentation (``functions.segment``).
    """
    kind = _analyzer(analyzer)[1]
    if kind == "none":
        return tokens
    low = X.lower_terms(tokens)
    if kind == "english":
        return S.stem_words(low)
    return F.transform(low, X.light_stem) if kind == "light" else low


PYTHON_ANALYZERS = ("english", "standard_english")


def distinct_terms_array(text: Column, analyzer: str = "lower", terms_col: str | None = None) -> Column:
    """Distinct terms of one text, or of its precomputed terms.  For the stemmer, words are
    de-duplicated before the Python call, so Python sees each document's vocabulary once."""
    if terms_col:
        return F.array_distinct(terms_col)
    toks = token_array(text, analyzer)
    if analyzer in PYTHON_ANALYZERS:
        return F.array_distinct(S.stem_words(F.array_distinct(X.lower_terms(toks))))
    return F.array_distinct(analyze_array(toks, analyzer))


def refuse_repeated(doc_id: Column) -> Column:
    """Raises, when evaluated: results per document need unique ids."""
    return F.raise_error(F.concat(F.lit("more than one document with id "), doc_id.cast("string")))


_BLOCK = 64  # elements summed up in one fold


def running_starts(lengths: Column) -> Column:
    """array<bigint>: for each element the sum of those before it, in linear time.  A fold copies the list it
    appends to, so the lengths are folded in blocks, and the blocks' sums in a fold of their own."""
    zero = F.struct(F.array().cast("array<bigint>").alias("starts"), F.lit(0).cast("bigint").alias("sum"))

    def fold(values: Column) -> Column:
        return F.aggregate(values, zero, lambda acc, n: F.struct(
            F.array_append(acc["starts"], acc["sum"]).alias("starts"), (acc["sum"] + n).alias("sum")))

    def joined(blocks: Column) -> Column:
        return X.let(fold(F.transform(blocks, lambda b: b["sum"]))["starts"], lambda base: F.flatten(F.transform(
            blocks, lambda b, i: F.transform(b["starts"], lambda s: s + F.element_at(base, i + 1)))))

    def blocked(ls: Column) -> Column:
        heads = F.sequence(F.lit(1), F.size(ls), F.lit(_BLOCK))
        return X.let(F.transform(heads, lambda at: fold(F.slice(ls, at, F.lit(_BLOCK)))), joined)

    return X.let(lengths, lambda ls: F.when(F.size(ls) > 0, blocked(ls)).otherwise(F.array().cast("array<bigint>")))


def native_places(p: Column) -> Column:
    """``places`` without Python, for documents that were analysed in Python before."""
    before = running_starts(F.transform(p["surfaces"], lambda t, i: F.length(t) + F.element_at(p["gaps"], i + 1)))
    starts = F.zip_with(before, F.slice(p["gaps"], 1, F.size(p["surfaces"])), lambda s, gap: s + gap)
    return X.let(starts, lambda st: F.struct(
        F.transform(st, lambda _, i: i.cast("bigint")).alias("position"), st.alias("start"),
        F.zip_with(st, p["surfaces"], lambda s, t: s + F.length(t)).alias("end")))


def gather_tokens(docs: DataFrame, text_col: str = "text", analyzer: str = "lower",
                  flag_terms: str | None = None, terms_col: str | None = None) -> DataFrame:
    """``docs`` with ``tokens``: array<struct<position, surface, term, start, end>> in text order, one
    row per document.  Offsets are found inside the row: no row per token is made, sorted or shuffled.
    ``flag_terms`` and ``terms_col`` as in ``tokenize``."""
    docs = docs.withColumn("_surfaces", token_array(text_col, analyzer))
    gaps = X.gap_array(text_col, _analyzer(analyzer)[0])
    if terms_col:
        lengths = F.transform(gaps, lambda g: F.length(g))
        where = X.let(F.struct(F.col("_surfaces").alias("surfaces"), lengths.alias("gaps")), native_places)
    else:
        where = P.places(F.col("_surfaces"), gaps)
    docs = docs.withColumn("_places", where)
    if terms_col is None and analyzer in PYTHON_ANALYZERS:
        docs, terms_col = docs.withColumn("_stems", analyze_array(F.col("_surfaces"), analyzer)), "_stems"
    terms = F.col(terms_col) if terms_col else analyze_array(F.col("_surfaces"), analyzer)

    def flagged(p: Column) -> Column:
        def token(i: Column) -> Column:
            return F.struct(*(F.element_at(p[c], i + 1).alias(c) for c in ("position", "surface", "term", "start", "end")))

        at = F.filter(F.transform(p["term"], lambda t, i: F.when(F.array_contains(F.col(flag_terms), t), i)),
                      lambda i: i.isNotNull())
        return F.transform(at, token)

    aligned = {"position": F.col("_places.position"), "surface": F.col("_surfaces"), "term": terms,
               "start": F.col("_places.start"), "end": F.col("_places.end")}
    cols = [c.alias(name) for name, c in aligned.items()]
    tokens = X.let(F.struct(*cols), flagged) if flag_terms else F.arrays_zip(*cols)
    return docs.withColumn("tokens", tokens).drop("_surfaces", "_places", "_stems")


def tokenize(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
             analyzer: str = "lower", prepartition: bool = True,
             flag_terms: str | None = None, terms_col: str | None = None, gathered: bool = False) -> DataFrame:
    """T1+T4: ``(id, position, surface, term, start, end)`` for every token.

    Ids must be unique: if two rows with tokens share one, it raises when their offsets are computed.

    ``flag_terms`` names an array<string> column of ``docs``; when given, only tokens
    whose term is in it are returned (the hit filter is decided per document before the
    explode, so the keyterm array is never copied onto token rows).

    ``terms_col`` names a precomputed array of terms aligned with the tokens (for
    example Porter stems computed before a join).

    ``gathered``: one row per document instead, ``(id, tokens)`` as ``gather_tokens`` has them.
    """
    d = docs.where(F.col(text_col).isNotNull())
    cols = [F.col(id_col), F.col(text_col).alias("_text")]
    if flag_terms:
        cols.append(F.col(flag_terms).alias("_kt"))
    if terms_col:
        cols.append(F.col(terms_col).alias("_pre_terms"))
    d = d.select(*cols)
    if prepartition:
        d = d.repartition(id_col)
    alike = F.sum(F.col("_text").rlike(_analyzer(analyzer)[0]).cast("int")).over(Window.partitionBy(id_col))
    d = d.withColumn("_alike", alike)
    d = gather_tokens(d, "_text", analyzer, "_kt" if flag_terms else None, "_pre_terms" if terms_col else None)

    def checked(name: str) -> Column:
        refused = refuse_repeated(F.col(id_col)).cast(d.schema["tokens"].dataType if name == "tokens" else "bigint")
        return F.when(F.col("_alike") <= 1, F.col(name)).otherwise(refused).alias(name)

    if gathered:
        return d.select(id_col, checked("tokens"))
    # not the bare column: Spark would add a filter on it, which makes the tokens a second time
    rows = d.select(id_col, "_alike", F.inline(F.when(F.size("tokens") > 0, F.col("tokens"))))
    return rows.select(id_col, "position", "surface", "term", checked("start"), checked("end"))


def dealt(docs: DataFrame, text_col: str, id_col: str, terms_col: str | None = None, keep: tuple = ()) -> DataFrame:
    """``(id, text, keep...)`` of the documents with text, dealt to the tasks that analyse them: a file of
    one row group is read by one task, which would else analyse the whole of it.  Documents without an
    id are dealt by their text.  Terms analysed before (``terms_col``) stay as they lie."""
    d = docs.where(F.col(text_col).isNotNull()).select(*dict.fromkeys([id_col, text_col, *([terms_col] if terms_col else []), *keep]))
    return d if terms_col else d.repartition(id_col, F.when(F.col(id_col).isNull(), F.xxhash64(text_col)))


def doc_terms(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
              analyzer: str = "lower", terms_col: str | None = None) -> DataFrame:
    """Distinct ``(id, term)`` pairs.  No offsets are needed, so no window: only the texts are
    exchanged, before the explode."""
    return (dealt(docs, text_col, id_col, terms_col)
            .select(id_col, F.explode(distinct_terms_array(F.col(text_col), analyzer, terms_col)).alias("term")))


def term_frequencies(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                     analyzer: str = "lower", terms_col: str | None = None) -> DataFrame:
    """``(id, term, tf)``.  Partial aggregation collapses repeats inside each scan task,
    so the shuffle carries one row per distinct pair."""
    return (dealt(docs, text_col, id_col, terms_col)
            .select(id_col, F.explode(F.col(terms_col) if terms_col else analyze_array(token_array(text_col, analyzer), analyzer))
                    .alias("term"))
            .groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf")))


def term_vectors(tokens: DataFrame, id_col: str = "doc_id", gathered: bool = False) -> DataFrame:
    """T5: per ``(id, term)`` the occurrences sorted by position.

    From gathered tokens the vector is cut inside the document's row: its tokens are sorted by term and
    position, and cut where the term changes.  ``gathered``: ``(id, vector)``, one row per document."""
    if "tokens" not in tokens.columns:
        return (tokens.groupBy(id_col, "term")
                .agg(F.sort_array(F.collect_list(F.struct("position", "start", "end"))).alias("occurrences")))

    def cut(ts: Column) -> Column:
        heads = F.filter(F.sequence(F.lit(1), F.size(ts)), lambda i: (i == 1) | (
            F.element_at(ts, i)["term"] != F.element_at(ts, F.greatest(i - 1, F.lit(1)))["term"]))
        return X.let(heads, lambda hs: F.transform(hs, lambda at, j: F.struct(
            F.element_at(ts, at)["term"].alias("term"),
            F.transform(F.slice(ts, at, F.coalesce(F.get(hs, j + 1), F.size(ts) + 1) - at), lambda t: F.struct(
                t["position"].alias("position"), t["start"].alias("start"), t["end"].alias("end"))).alias("occurrences"))))

    by_term = F.sort_array(F.transform("tokens", lambda t: F.struct(
        t["term"].alias("term"), t["position"].alias("position"), t["start"].alias("start"), t["end"].alias("end"))))
    vector = X.let(by_term, cut)
    held = F.size("tokens") > 0
    if gathered:
        return tokens.select(id_col, F.explode(F.when(held, F.array(vector))).alias("vector"))
    return tokens.select(id_col, F.inline(F.when(held, vector)))


def tokens_in_order(vectors: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rebuild each document's term sequence (text order) from its term vector: rows of ``term_vectors``,
    or its gathered form (then inside the document's row)."""
    if "vector" in vectors.columns:
        places = F.sort_array(F.flatten(F.transform("vector", lambda v: F.transform(v["occurrences"], lambda o: F.struct(
            o["position"].alias("position"), v["term"].alias("term"))))))
        return vectors.select(id_col, F.transform(places, lambda x: x["term"]).alias("terms"))
    occ = vectors.select(id_col, "term", F.explode("occurrences").alias("o"))
    return (occ.groupBy(id_col)
            .agg(F.sort_array(F.collect_list(F.struct(F.col("o.position").alias("position"), "term"))).alias("_s"))
            .select(id_col, F.transform("_s", lambda x: x["term"]).alias("terms")))
