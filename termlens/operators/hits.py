"""Locate keyterms and gather their offsets.

Hits are found by tokenising the highlight field with the keyterm set of each document
attached to the document row (at most k terms, so a bounded array) and filtering tokens
whose term is in it: no join between token rows and keyterm rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from . import tokens as TK


def keyterm_sets(keyterms: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(id, kt)``: each document's keyterms as an array (bounded by k).  The ranking
    window left the rows partitioned by ``id``, so this aggregate adds no shuffle."""
    return keyterms.groupBy(id_col).agg(F.collect_set("term").alias("kt"))


def keyterm_hits(docs_with_kt: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                 analyzer: str = "lower", kt_col: str = "kt", terms_col: str | None = None,
                 gathered: bool = False) -> DataFrame:
    """H1: ``(id, position, surface, term, start, end)`` for every occurrence of a
    keyterm in ``text_col`` (the highlight field, which may differ from the field the
    keyterms came from).  ``terms_col``: precomputed aligned terms (see ``tokenize``).
    ``gathered``: the rows as they are, hits in ``tokens`` (null without keyterms); ids are not checked."""
    if gathered:
        return TK.gather_tokens(docs_with_kt, text_col, analyzer, kt_col, terms_col)
    return TK.tokenize(docs_with_kt.where(F.col(kt_col).isNotNull()), text_col, id_col,
                       analyzer, flag_terms=kt_col, terms_col=terms_col)


def hit_arrays(hits: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(id, hits)``: each document's hits sorted by start (array<struct<start, end,
    position, surface, term>>).  Bounded by the document's own length.  Gathered hits become the
    column ``hits`` of their rows, null where there is none."""
    if "tokens" in hits.columns:
        own = X.let("tokens", lambda ts: F.when(F.size(ts) > 0, F.transform(ts, lambda t: F.struct(
            t["start"].alias("start"), t["end"].alias("end"), t["position"].alias("position"),
            t["surface"].alias("surface"), t["term"].alias("term")))))
        return hits.withColumn("hits", own).drop("tokens")
    return hits.groupBy(id_col).agg(
        F.sort_array(F.collect_list(F.struct("start", "end", "position", "surface", "term"))).alias("hits"))


def phrase_hit_arrays(docs_with_kt: DataFrame, text_col: str, id_col: str, analyzer: str, kt_col: str = "kt") -> DataFrame:
    """H1 where the highlight field has an analyzer of its own: the rows with ``hits`` as ``hit_arrays`` has
    them (null without one); ids are not checked.

    Every keyterm is analysed again by ``analyzer`` and may become several tokens, which must stand one
    after the other.  At each place the longest such sequence counts (ties: the keyterm that sorts
    first), and hits do not overlap: the one that starts first stays.  A hit's position is its first
    token's, its term the keyterm, its surface the text from its first to its last token.

    A document has at most k sequences, so its tokens are cut down to their words before they are
    gathered, and each gathered token is compared with the k sequences only."""
    if analyzer in TK.PYTHON_ANALYZERS:
        raise ValueError("the analyzer of the highlight field must be a native one")

    def again(k: Column) -> Column:
        return F.struct(F.array_size(TK.analyze_array(TK.token_array(k, analyzer), analyzer)).alias("size"),
                        TK.analyze_array(TK.token_array(k, analyzer), analyzer).alias("words"), k.alias("term"))

    base = docs_with_kt.withColumn(
        "_phrases", F.filter(F.transform(F.sort_array(kt_col), again), lambda p: p["size"] > 0)).withColumn(
        "_words", F.array_distinct(F.flatten(F.col("_phrases.words"))))
    tokens = hit_arrays(TK.gather_tokens(base, text_col, analyzer, flag_terms="_words"), id_col)

    def at_place(phrases: Column, hs: Column):
        def longest(h: Column, i: Column) -> Column:
            def fits(p: Column) -> Column:
                run = F.slice(hs, i + 1, p["size"])
                last = F.try_element_at(run, F.lit(-1))
                # most places fail at the first word
                return (F.element_at(p["words"], 1) == h["term"]) & (F.transform(run, lambda x: x["term"]) == p["words"]) & (
                    last["position"] - h["position"] == p["size"] - 1)

            found = F.filter(phrases, fits)
            best = F.try_element_at(F.filter(found, lambda p: p["size"] == F.array_max(F.transform(found, lambda q: q["size"]))), F.lit(1))
            return F.when(F.size(found) > 0, F.struct(
                h["start"].alias("start"), F.element_at(hs, (i + best["size"]).cast("int"))["end"].alias("end"),
                h["position"].alias("position"), best["term"].alias("term")))
        return longest

    def apart(candidates: Column) -> Column:
        kept = F.array().cast("array<struct<start: bigint, end: bigint, position: bigint, term: string>>")
        return F.aggregate(candidates, kept, lambda acc, c: F.when(
            F.coalesce(F.try_element_at(acc, F.lit(-1))["end"] > c["start"], F.lit(False)), acc).otherwise(F.array_append(acc, c)))

    def kept(hs: Column) -> Column:
        places = F.filter(F.transform(hs, at_place(F.col("_phrases"), hs)), lambda c: c.isNotNull())
        # sequences of one word cannot overlap
        single = F.forall("_phrases", lambda p: p["size"] == 1)
        return X.let(places, lambda found: F.when(single, found).otherwise(apart(found)))

    found = X.let(X.let("hits", kept), lambda ks: F.when(F.size(ks) > 0, F.transform(ks, lambda c: F.struct(
        c["start"], c["end"], c["position"],
        F.substring(F.col(text_col), c["start"].cast("int") + 1, (c["end"] - c["start"]).cast("int")).alias("surface"),
        c["term"]))))
    return tokens.withColumn("hits", found).drop("_phrases", "_words")


def stored_hits(text: Column, terms: Column, starts: Column, ends: Column, kt: Column) -> Column:
    """H1 from a stored term vector (aligned arrays in text order): the hit array of one document,
    null without a hit.  No token is looked for again, no row per token is made."""
    def hit(i):
        at = i + 1
        start, end = F.element_at(starts, at), F.element_at(ends, at)
        return F.struct(start.alias("start"), end.alias("end"), i.cast("bigint").alias("position"),
                        F.substring(text, start.cast("int") + 1, (end - start).cast("int")).alias("surface"),
                        F.element_at(terms, at).alias("term"))

    # both arrays are bound once: the positions of keyterms, then their hits
    found = F.filter(F.transform(terms, lambda t, i: F.when(F.array_contains(kt, t), i)), lambda i: i.isNotNull())
    return X.let(F.transform(found, hit), lambda h: F.when(F.size(h) > 0, h))


def offsets_by(hits: DataFrame, key: str, id_col: str = "doc_id") -> DataFrame:
    """A8 (``key='surface'``) / A9 (``key='term'``): ``(id, key, offsets, first_start)``."""
    return hits.groupBy(id_col, key).agg(
        F.sort_array(F.collect_list(F.struct("start", "end"))).alias("offsets"),
        F.min("start").alias("first_start"))


def group_offsets(hits: Column, key: str, order: str = "first") -> Column:
    """A10 on one document's sorted hit array: ``struct<keys, offsets>`` where
    ``offsets[i]`` lists (start, end) of ``keys[i]``.  ``order='first'``: keys by first
    occurrence (raw mode); ``order='key'``: keys sorted (term-vector order).

    The hits are sorted by key and cut where it changes, so a long keyterm list costs no more
    than sorting its hits."""
    def cut(by_key):
        heads = F.filter(F.sequence(F.lit(1), F.size(by_key)), lambda i: (i == 1) | (
            F.element_at(by_key, i)["k"] != F.element_at(by_key, F.greatest(i - 1, F.lit(1)))["k"]))

        def group(heads_, at, j):
            end = F.when(j + 1 < F.size(heads_), F.element_at(heads_, F.least(j + 2, F.size(heads_)))).otherwise(
                F.size(by_key) + 1)
            own = F.slice(by_key, at, end - at)
            return F.struct(F.element_at(own, 1)["start"].alias("first"), F.element_at(own, 1)["k"].alias("k"),
                            F.transform(own, lambda h: F.struct(h["start"].alias("start"), h["end"].alias("end"))).alias("o"))

        groups = X.let(heads, lambda hv: F.transform(hv, lambda at, j: group(hv, at, j)))
        if order == "first":
            groups = F.sort_array(groups)
        return X.let(groups, lambda g: F.struct(F.transform(g, lambda x: x["k"]).alias("keys"),
                                                F.transform(g, lambda x: x["o"]).alias("offsets")))

    by_key = F.sort_array(F.transform(hits, lambda h: F.struct(
        h[key].alias("k"), h["start"].alias("start"), h["end"].alias("end"))))
    return F.when(F.size(hits) > 0, X.let(by_key, cut))


def highlighted_text(text: Column, hits: Column) -> Column:
    """H3: the text with every hit of the sorted hit array wrapped in marks."""
    return X.mark_terms(text, F.transform(hits, lambda h: F.struct(h["start"].alias("start"), h["end"].alias("end"))))
