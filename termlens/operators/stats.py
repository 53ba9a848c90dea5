"""Document frequencies, collection size, foreground counts, sampling, and
duplicate-passage removal.

Every count is a ``groupBy`` with partial (map-side) aggregation, so a term held by
every document costs one row per map task, not one row per document, on the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from . import skew as SK
from . import tokens as TK


def background(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
               analyzer: str = "lower", terms_col: str | None = None) -> DataFrame:
    """A1: ``(term, bg_count)``, the number of documents holding each term, over the
    whole collection (no eligibility filter).  No term is null; saying so gives every reader of the
    counts, joined or not, the same aggregate."""
    return (TK.doc_terms(docs, text_col, id_col, analyzer, terms_col).where(F.col("term").isNotNull())
            .groupBy("term").agg(F.count(F.lit(1)).cast("bigint").alias("bg_count")))


def background_and_size(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                        analyzer: str = "lower", terms_col: str | None = None):
    """A1 and A2 from one aggregate: each document adds an empty-string marker to its
    distinct terms (no token is empty), so the marker's count is the number of
    documents.  Returns ``(bg, n)``: ``bg`` keeps the marker row, which can never join
    a token; ``n`` is a scalar subquery over the same aggregate.  A join on the term asks for terms
    that are not null, a sum over the counts does not: every reader gets that filter, so that all
    their exchanges are one and the text is not analysed again for each."""
    marked = (TK.dealt(docs, text_col, id_col, terms_col)
              .select(F.explode(F.concat(TK.distinct_terms_array(F.col(text_col), analyzer, terms_col),
                                         F.array(F.lit("")))).alias("term")))
    counts = (marked.where(F.col("term").isNotNull()).groupBy("term")
              .agg(F.count(F.lit(1)).cast("bigint").alias("bg_count")))
    n = counts.select(F.max(F.when(F.col("term") == "", F.col("bg_count"))).alias("n")).scalar()
    return counts, n


def corpus_size(docs: DataFrame, text_col: str = "text") -> Column:
    """A2: number of documents with text, as a scalar-subquery column (no action on the
    driver and no join: Spark runs it as a separate one-row job)."""
    return docs.where(F.col(text_col).isNotNull()).select(F.count(F.lit(1))).scalar()


def corpus_size_df(docs: DataFrame, text_col: str = "text") -> DataFrame:
    return docs.where(F.col(text_col).isNotNull()).agg(F.count(F.lit(1)).cast("bigint").alias("n_docs"))


def foreground(docs: DataFrame, group_col: str, text_col: str = "text", id_col: str = "doc_id",
               analyzer: str = "lower", min_doc_count: int = 1) -> DataFrame:
    """A3: ``(group, term, fg_count)`` documents of each group holding each term, kept
    when ``fg_count >= min_doc_count``."""
    pairs = (TK.dealt(docs, text_col, id_col, keep=(group_col,))
             .select(group_col, id_col, F.explode(TK.distinct_terms_array(F.col(text_col), analyzer)).alias("term")))
    return (pairs.groupBy(group_col, "term").agg(F.count(F.lit(1)).cast("bigint").alias("fg_count"))
            .where(F.col("fg_count") >= min_doc_count))


def sample_shard(id_col: str, shards: int) -> Column:
    """The shard of a document, 0 to ``shards - 1``, by a hash of its id."""
    return F.pmod(F.conv(F.substring(F.md5(F.col(id_col).cast("string")), 1, 8), 16, 10).cast("bigint"), F.lit(shards))


def hit_counts(docs: DataFrame, hits: DataFrame, id_col: str = "doc_id", name: str = "hits") -> DataFrame:
    """``docs`` with the number of ``hits`` rows of each document, 0 where it has none."""
    counts = hits.groupBy(id_col).agg(F.count(F.lit(1)).cast("bigint").alias(name))
    return docs.join(counts, id_col, "left").withColumn(name, F.coalesce(name, F.lit(0).cast("bigint")))


def sampled_foreground(docs: DataFrame, group_col: str, score: Column, shard_size: int = 100,
                       id_col: str = "doc_id", shards: int = 1) -> DataFrame:
    """A5: at most ``shard_size`` best documents per group and shard (score descending, id
    ascending).  ``shard_size < 0`` keeps every document.  The window carries a limit, so every
    map task hands on the best rows of each (group, shard) only, and a group that holds most
    documents is ranked in ``shards`` tasks."""
    if shard_size is None or shard_size < 0:
        return docs
    w = Window.partitionBy(group_col, "_shard").orderBy(score.desc(), F.col(id_col))
    return docs.withColumn("_shard", sample_shard(id_col, shards)).withColumn("_rn", F.row_number().over(w)).where(
        F.col("_rn") <= shard_size).drop("_rn", "_shard")


# --- fixed values: passages that very many documents hold ---------------------------------
HOT_SAMPLE = 64        # hot passages are looked for in one of so many documents
HOT_LEAST = 8          # and must be found there so often
# ---------------------------------------------------------------------------------------------


def grouped_tokens(docs: DataFrame, group_col: str, text_col: str = "text", id_col: str = "doc_id",
                   analyzer: str = "lower") -> DataFrame:
    """``(id, group, tokens)``: for each document its group and ``array<struct<position, term>>`` in text order,
    made inside the document's row.  Rows that share id and group are one document: their tokens
    are put together by position."""
    texts = docs.where(F.col(text_col).isNotNull()).select(id_col, F.col(text_col).alias("_text"))
    per = texts.join(docs.select(id_col, group_col), id_col).groupBy(id_col, group_col).agg(F.collect_list("_text").alias("_texts"))

    def own(text: Column) -> Column:
        return F.transform(TK.analyze_array(TK.token_array(text, analyzer), analyzer), lambda t, i: F.struct(
            i.cast("bigint").alias("position"), t.alias("term")))

    if analyzer in TK.PYTHON_ANALYZERS:
        raise ValueError("passages need a native analyzer")
    tokens = F.when(F.size("_texts") == 1, own(F.element_at("_texts", 1))).otherwise(
        F.sort_array(F.flatten(F.transform("_texts", own))))
    return per.select(id_col, group_col, tokens.alias("tokens"))


def drop_duplicate_passages(tokens: DataFrame, group_col: str, shingle: int = 6,
                            id_col: str = "doc_id") -> DataFrame:
    """Remove tokens covered only by repeated passages.

    A passage is a run of ``shingle`` consecutive terms.  Within each group, the first
    holder of a passage (least ``(id, position)``) keeps it; later copies are dropped,
    token by token, unless another, unrepeated passage still covers the token.

    ``tokens``: rows, or ``grouped_tokens``.  Passages travel once, as a 128-bit hash of group and
    terms with their place and no text; a window over each hash finds its copies, and only their
    places go back to the documents, whose tokens are cut inside their row.  Passages that very many
    documents hold would meet in one task: their first holders are found beforehand by a ``min``
    (partial, one row per passage and map task) and broadcast, and their rows are spread.  Hot ones
    are looked for in a part of the documents; which are found changes no result.

    A null group is no group: like the SQL twin's join, the owner join matches no null, so
    the tokens of documents with a null group all stay, copies included.
    """
    if "tokens" in tokens.columns:
        per, names = tokens, ["position", "term"]
    else:
        names = [c for c in tokens.columns if c not in (id_col, group_col)]
        order = ["position"] + [c for c in names if c != "position"]
        per = tokens.groupBy(id_col, group_col).agg(F.sort_array(F.collect_list(F.struct(*order))).alias("tokens"))
    n = F.size("tokens")
    terms = per.where(F.col(group_col).isNotNull() & (n >= shingle)).select(
        id_col, group_col, F.transform("tokens", lambda t: t["position"]).alias("_positions"),
        F.transform("tokens", lambda t: t["term"]).alias("_terms"))
    starts = F.sequence(F.lit(1), F.size("_terms") - (shingle - 1))
    texts = F.transform(starts, lambda i: F.slice("_terms", i, F.lit(shingle)))
    passages = (terms.select(id_col, group_col, F.posexplode(F.arrays_zip(
        F.slice("_positions", F.lit(1), F.size("_terms") - (shingle - 1)).alias("position"), texts.alias("text"))).alias("_i", "_p"))
        .select(id_col, group_col, "_i", F.col("_p.position").alias("position"),
                F.xxhash64(group_col, "_p.text").alias("_a"), F.xxhash64(F.lit(1), group_col, "_p.text").alias("_b")))
    place = F.struct(F.col(id_col).alias("id"), F.col("position").alias("position"))
    key = ["_a", "_b"]
    seen = passages.where(F.pmod(F.xxhash64(id_col), F.lit(HOT_SAMPLE)) == 0).groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    total = seen.select(F.sum("_n")).scalar()
    hot = seen.where((F.col("_n") >= HOT_LEAST) & (F.col("_n") * F.lit(SK.HOT_DENOMINATOR) >= total)).select(*key)
    first = passages.join(F.broadcast(hot), key, "left_semi").groupBy(*key).agg(F.min(place).alias("_o"))
    rows = passages.join(F.broadcast(first), key, "left").withColumn(
        "_spread", F.when(F.col("_o").isNotNull(), F.xxhash64(id_col, "_i")))
    w = Window.partitionBy(*key, "_spread").orderBy(id_col, "position")
    owner = F.coalesce(F.col("_o"), F.first(place).over(w))
    copies = rows.withColumn("_own", owner).where(
        ~((F.col(id_col) == F.col("_own.id")) & (F.col("position") == F.col("_own.position"))))
    held = copies.groupBy(id_col).agg(F.sort_array(F.collect_list(F.struct(F.col(group_col).alias("g"), F.col("_i").alias("i")))).alias("_copies"))

    # a run of copies i to j covers alone what no passage before i or after j reaches
    last = n - shingle
    own = F.transform(F.filter("_copies", lambda c: c["g"] == F.col(group_col)), lambda c: c["i"])

    def gaps(cs: Column) -> Column:
        def at(j: Column) -> Column:
            return F.get(cs, j)

        heads = F.filter(F.sequence(F.lit(0), F.size(cs) - 1), lambda j: (j == 0) | (at(j) != at(j - 1) + 1))

        def runs(hs: Column) -> Column:
            def run(h: Column, k: Column) -> Column:
                end = at(F.coalesce(F.get(hs, k + 1), F.size(cs)) - 1)
                return F.struct(F.when(at(h) == 0, 0).otherwise(at(h) + (shingle - 1)).alias("from"),
                                F.when(end == last, n).otherwise(end + 1).alias("to"))
            return F.filter(F.transform(hs, run), lambda r: r["from"] < r["to"])

        return X.let(heads, runs)

    def cut(rs: Column) -> Column:
        parts = F.transform(F.sequence(F.lit(0), F.size(rs)), lambda k: X.let(
            F.when(k == 0, 0).otherwise(F.get(rs, k - 1)["to"]), lambda lo: F.slice(
                F.col("tokens"), lo + 1, F.coalesce(F.get(rs, k)["from"], n) - lo)))
        return F.flatten(parts)

    kept = X.let(own, lambda cs: F.when(F.size(cs) > 0, X.let(gaps(cs), cut)))
    out = per.join(held, id_col, "left").withColumn("_kept", F.coalesce(kept, F.col("tokens")))
    cols = [c for c in tokens.columns if c != "tokens"]
    return out.select(id_col, group_col, F.inline(F.when(F.size("_kept") > 0, F.col("_kept")))).select(
        *cols, *(names if "tokens" in tokens.columns else []))


HEURISTICS = ("lift", "llr")


def _xlogx_term(k: Column, row: Column, col: Column, n: Column) -> Column:
    """``k * ln(k * n / (row * col))`` with ``0 ln 0 = 0``."""
    return F.when(k > 0, k * F.log((k * n) / (row * col))).otherwise(F.lit(0.0))


def significant_terms(docs: DataFrame, group_col: str, text_col: str = "text", id_col: str = "doc_id",
                      analyzer: str = "lower", min_doc_count: int = 1, size: int = 10,
                      heuristic: str = "lift", background_df: DataFrame | None = None,
                      shard_size: int | None = None, sample_score: Column | None = None, sample_shards: int = 1,
                      filter_duplicate_text: bool = False, shingle: int = 6) -> DataFrame:
    """A4 for document groups: terms over-represented in each group's documents
    (foreground) against the whole collection (background, which contains them).

    ``lift`` = (fg / fg_n) / (bg / N); ``llr`` = Dunning's G^2 (1993) over the 2x2 table
    (in group, holds term).  Only terms with fg / fg_n > bg / N are kept; top ``size``
    per group by score (rounded to 9 places), then term.

    As in the original request, the foreground may first be sampled (A5: the
    ``shard_size`` best documents of each group by ``sample_score``, ties by id) and have its
    repeated passages removed before counting (A6, ``filter_duplicate_text``).  The
    background is always the whole collection.

    A null group is no group: like the SQL twin's join, the join with the sizes matches no
    null, so such documents count in the background but get no terms (``foreground`` does
    count them).
    """
    fdocs = docs.where(F.col(text_col).isNotNull())
    if shard_size is not None and shard_size >= 0:
        fdocs = sampled_foreground(fdocs, group_col, sample_score if sample_score is not None else F.lit(0),
                                   shard_size, id_col, sample_shards)
    if filter_duplicate_text:
        if analyzer in TK.PYTHON_ANALYZERS:
            toks = TK.tokenize(fdocs, text_col, id_col, analyzer).join(fdocs.select(id_col, group_col), id_col)
        else:
            toks = grouped_tokens(fdocs, group_col, text_col, id_col, analyzer)
        pairs = drop_duplicate_passages(toks, group_col, shingle, id_col).select(group_col, id_col, "term").distinct()
        fg = (pairs.groupBy(group_col, "term").agg(F.count(F.lit(1)).cast("bigint").alias("fg_count"))
              .where(F.col("fg_count") >= min_doc_count))
    else:
        fg = foreground(fdocs, group_col, text_col, id_col, analyzer, min_doc_count)
    if background_df is not None:
        bg, n = background_df, corpus_size(docs, text_col)
    else:
        bg, n = background_and_size(docs, text_col, id_col, analyzer)
    n = n.cast("double")
    sizes = fdocs.groupBy(group_col).agg(F.count(F.lit(1)).cast("bigint").alias("fg_n"))
    # a common term has a row per group, and a few groups may hold most rows: the term join is
    # salted by the background counts, the join with the sizes (one row per group) by the
    # documents of a group, spread over its terms
    total = bg.select(F.sum("bg_count")).scalar()
    j = SK.salted_join(fg, bg, ["term"], "bg_count", total, group_col)
    j = SK.salted_join(j, sizes, [group_col], "fg_n", sizes.select(F.sum("fg_n")).scalar(), "term")
    fgc, bgc, fgn = (F.col(c).cast("double") for c in ("fg_count", "bg_count", "fg_n"))
    j = j.where(fgc * n > bgc * fgn)
    if heuristic == "lift":
        score = (fgc * n) / (fgn * bgc)
    elif heuristic == "llr":
        k11, k12, k21 = fgc, fgn - fgc, bgc - fgc
        k22 = n - fgn - bgc + fgc
        r1, r2, c1, c2 = fgn, n - fgn, bgc, n - bgc
        score = 2.0 * (_xlogx_term(k11, r1, c1, n) + _xlogx_term(k12, r1, c2, n)
                       + _xlogx_term(k21, r2, c1, n) + _xlogx_term(k22, r2, c2, n))
    else:
        raise ValueError(f"unknown heuristic {heuristic!r}; expected one of {HEURISTICS}")
    w = Window.partitionBy(group_col).orderBy(F.col("_rs").desc(), F.col("term"))
    return (j.withColumn("score", score).withColumn("_rs", F.round("score", 9))
            .withColumn("rank", F.row_number().over(w).cast("bigint"))
            .where(F.col("rank") <= size).drop("_rs"))
