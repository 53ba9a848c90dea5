"""Choose each document's keyterms.

Ranking rules (the scoring of the original service is not recoverable, so these are
ours, each a deterministic total order with a term tie-break):

* ``rarest`` (default): ``bg_count`` ascending, then term.  For a one-document
  foreground any score that falls as ``bg_count`` rises gives this order.  Terms held by
  every document (``bg_count = N``) carry no signal and are dropped.
* ``tfidf``: ``tf * ln(N / bg_count)`` descending (Sparck Jones 1972), rounded to 9
  places before ranking so engines cannot disagree on float noise; score 0 dropped.

Top-k comes first and the stop-word / minimum-count filters after it (the original
order, so a document may end with fewer than k keyterms); ``filter_before_topk=True``
swaps them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import skew as SK
from . import stats as ST
from . import tokens as TK

RULES = ("rarest", "tfidf")


def stopword_filter(df: DataFrame, stopwords, term_col: str = "term") -> DataFrame:
    """P3.  A list is a literal ``NOT IN`` (bounded: it is a parameter, not data); a
    DataFrame of stop words is a ``left_anti`` join salted by how often ``df`` holds each
    stop word, since stop words are the hottest terms."""
    if stopwords is None:
        return df
    if isinstance(stopwords, DataFrame):
        sw = stopwords.select(F.col(stopwords.columns[0]).alias(term_col)).distinct()
        counts = df.groupBy(term_col).agg(F.count(F.lit(1)).alias("_n"))
        total = counts.select(F.sum("_n")).scalar()
        spread = next(c for c in df.columns if c != term_col) if len(df.columns) > 1 else term_col
        return SK.salted_join(df, counts.join(sw, term_col, "left_semi"), [term_col], "_n", total, spread, how="left_anti")
    words = sorted(set(stopwords))
    if not words:
        return df
    return df.where(~F.col(term_col).isin(words))


def min_bg_filter(df: DataFrame, min_bg_count: int = 1) -> DataFrame:
    """P4."""
    return df.where(F.col("bg_count") >= min_bg_count)


def rank_terms(cand: DataFrame, n_docs: Column, k: int = 16, rule: str = "rarest",
               id_col: str = "doc_id") -> DataFrame:
    """K1 over ``(id, term, bg_count[, tf])``: adds ``score`` and ``rank`` and keeps
    ``rank <= k``.  ``row_number`` with a ``<= k`` filter plans as a window group
    limit, so each map task ships at most k rows per document to the shuffle."""
    if rule == "rarest":
        scored = (cand.where(F.col("bg_count") < n_docs)
                  .withColumn("score", F.col("bg_count").cast("double")))
        order = [F.col("bg_count").asc(), F.col("term").asc()]
    elif rule == "tfidf":
        score = F.round(F.col("tf") * F.log(n_docs.cast("double") / F.col("bg_count")), 9)
        scored = cand.withColumn("score", score).where(F.col("score") > 0)
        order = [F.col("score").desc(), F.col("term").asc()]
    else:
        raise ValueError(f"unknown rule {rule!r}; expected one of {RULES}")
    w = Window.partitionBy(id_col).orderBy(*order)
    return scored.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= k)


def keyterms(docs: DataFrame, eligible: DataFrame | None = None, text_col: str = "text",
             id_col: str = "doc_id", analyzer: str = "lower", k: int = 16, rule: str = "rarest",
             stopwords=None, min_bg_count: int = 1, filter_before_topk: bool = False,
             background: DataFrame | None = None, n_docs: Column | None = None,
             terms_col: str | None = None) -> DataFrame:
    """A4: ``(id, term, bg_count, score, rank)``, the keyterms of each eligible document.

    ``docs`` is the background collection (all documents), ``eligible`` the documents
    to extract for (default: all).  ``background``/``n_docs`` may be passed in to reuse
    a stored background (incremental and streaming runs): it is cut down to the terms of the
    documents at hand, and a term it has never seen counts with the documents at hand that
    hold it, so the newest terms rank as the rare ones they are.  ``terms_col`` names a
    precomputed array of terms.
    """
    target = eligible if eligible is not None else docs
    if background is None:
        bg, n = ST.background_and_size(docs, text_col, id_col, analyzer, terms_col)
        held = "bg_count"
    else:
        n = n_docs if n_docs is not None else ST.corpus_size(docs, text_col)
        fresh = ST.background(target, text_col, id_col, analyzer, terms_col).withColumnRenamed("bg_count", "_held")
        bg = fresh.join(background, "term", "left").withColumn("_unseen", F.col("bg_count").isNull()).withColumn(
            "bg_count", F.coalesce("bg_count", "_held"))
        held = "_held"
    if rule == "tfidf":
        cand = TK.term_frequencies(target, text_col, id_col, analyzer, terms_col)
    else:
        cand = TK.doc_terms(target, text_col, id_col, analyzer, terms_col)
    # The background is an aggregate, which AQE's skew-join splitting cannot handle, so
    # terms held by very many documents are salted (operators/skew.py).
    total = bg.select(F.sum(held)).scalar()
    cand = SK.salted_join(cand, bg, ["term"], held, total, id_col)
    if background is not None:
        # what the stored collection never held is not a term every document holds
        n = F.when(F.col("_unseen"), F.greatest(n, F.col("bg_count") + 1)).otherwise(n)
    if filter_before_topk:
        if isinstance(stopwords, DataFrame):
            # every candidate pair meets the stop words here, and stop words are the
            # hottest terms: salt the anti join by the words' background counts
            sw = (stopwords.select(F.col(stopwords.columns[0]).alias("term")).distinct()
                  .join(bg, "term"))
            cand = SK.salted_join(cand, sw, ["term"], held, total, id_col, how="left_anti")
        else:
            cand = stopword_filter(cand, stopwords)
        cand = min_bg_filter(cand, min_bg_count)
        return rank_terms(cand, n, k, rule, id_col).drop("_held", "_unseen")
    ranked = rank_terms(cand, n, k, rule, id_col).drop("_held", "_unseen")
    return min_bg_filter(stopword_filter(ranked, stopwords), min_bg_count)
