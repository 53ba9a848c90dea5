"""Context fragments and word windows.

Both work on one document's *hits* (a sorted array built by a per-document aggregate
over rows already partitioned by document), never on all its tokens, so the cost is
linear in hits and no pair of hits is ever formed.

Raw fragments (rule of ours, fitted to the worked sample; the original highlighter is a
remote plugin):
  1. hits sorted by start; a group opens at a hit and takes the next hit while
     ``hit.end - group.first.start <= fragment_size``;
  2. ``pad = max(0, (fragment_size - span) div 2)``, window ``[first.start - pad,
     last.end + pad)``;
  3. a window starting before 0 becomes ``[0, fragment_size)``; one ending after the text
     becomes ``[len - fragment_size, len)``; both ends are then kept inside the text;
  4. ends grow outward to whole words; the left end is clipped to the previous group's
     last hit end;
  5. only the first ``max_fragments`` groups, and their hits, are kept.

Word windows (analysed mode): a hit at ``p`` opens a new island iff ``p - previous > 2w``;
an island is ``[max(first - w, 0), last + w]``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X

_GROUPS = "array<struct<fs:bigint,fe:bigint>>"


def fragment_groups(hits: Column, fragment_size: int = 100, max_fragments: int = 8) -> Column:
    """Steps 1 and 5: ``struct<groups: array<struct<fs,fe>>, cut: bigint>``.

    A fold over the sorted hits whose accumulator never holds more than
    ``max_fragments`` groups; ``cut`` is the start of the first dropped hit (null when
    none is dropped)."""
    if max_fragments < 1:
        raise ValueError("max_fragments must be at least 1")
    zero = F.struct(F.array().cast(_GROUPS).alias("groups"), F.lit(None).cast("bigint").alias("cut"))

    def merge(acc, h):
        g = acc["groups"]
        n = F.size(g)
        last = F.try_element_at(g, F.lit(-1))

        def state(groups, cut):
            return F.struct(groups.alias("groups"), cut.alias("cut"))

        opened = F.array(F.struct(h["start"].alias("fs"), h["end"].alias("fe")))
        return (
            F.when(acc["cut"].isNotNull(), acc)
            .when(n == 0, state(opened, acc["cut"]))
            .when(h["end"] - last["fs"] <= fragment_size,
                  state(F.concat(F.slice(g, 1, n - 1),
                                 F.array(F.struct(last["fs"].alias("fs"), h["end"].alias("fe")))), acc["cut"]))
            .when(n < max_fragments, state(F.concat(g, opened), acc["cut"]))
            .otherwise(state(g, h["start"]))
        )

    return F.aggregate(hits, zero, merge)


_NEAR = 64  # characters inspected first when growing a window edge to a whole word


def _grow_left(text: Column, ws: Column) -> Column:
    """Move ``ws`` left to the start of the word it cuts.  The word is looked for in
    the ``_NEAR`` characters before ``ws``; only a word reaching that far falls back to
    the whole prefix, so the result is exact and usually O(_NEAR)."""
    span = F.least(ws, F.lit(_NEAR))

    def grown(around: Column) -> Column:  # the characters before ``ws`` and the one after
        inside = (ws > 0) & F.substring(around, span, F.lit(2)).rlike(f"^{X.WORD_CHAR}{{2}}$")
        near = F.length(F.regexp_extract(F.reverse(F.substring(around, F.lit(1), span)), f"^{X.WORD_CHAR}+", 0))
        full = F.length(F.regexp_extract(F.reverse(F.substring(text, F.lit(1), ws)), f"^{X.WORD_CHAR}+", 0))
        return F.when(inside, ws - X.let(near, lambda run: F.when(run < span, run).otherwise(full))).otherwise(ws)

    return X.let(F.substring(text, ws - span + 1, span + 1), grown)


def _grow_right(text: Column, we: Column, n: Column) -> Column:
    """Move ``we`` right to the end of the word it cuts (same bounded look first); ``n``: the text's length."""
    def grown(around: Column) -> Column:  # the character before ``we`` and those after
        inside = (we < n) & F.substring(around, F.lit(1), F.lit(2)).rlike(f"^{X.WORD_CHAR}{{2}}$")
        near = F.length(F.regexp_extract(F.substring(around, F.lit(2), F.lit(_NEAR)), f"^{X.WORD_CHAR}+", 0))
        full = F.length(F.regexp_extract(F.substring(text, we + 1, n - we), f"^{X.WORD_CHAR}+", 0))
        return F.when(inside, we + X.let(near, lambda run: F.when(run < _NEAR, run).otherwise(full))).otherwise(we)

    return X.let(F.substring(text, we, F.lit(_NEAR + 1)), grown)


def fragment_windows(groups: Column, text: Column, fragment_size: int = 100) -> Column:
    """Steps 2-4: array<struct<start, end>> character windows, one per group."""
    # counting a text's characters reads all of it: once a document, not at each edge of each window
    return X.let(groups, lambda g: X.let(F.length(text).cast("bigint"), lambda n: _fragment_windows(g, text, n, fragment_size)))


def _fragment_windows(groups: Column, text: Column, n: Column, fragment_size: int) -> Column:
    size = F.lit(fragment_size).cast("bigint")

    def window(x, i):
        pad = F.greatest(F.lit(0).cast("bigint"), F.floor((size - (x["fe"] - x["fs"])) / 2).cast("bigint"))
        ws0, we0 = x["fs"] - pad, x["fe"] + pad
        ws1 = F.when(ws0 < 0, F.lit(0).cast("bigint")).otherwise(ws0)
        we1 = F.when(ws0 < 0, size).otherwise(we0)
        ws2 = F.when(we1 > n, n - size).otherwise(ws1)
        we2 = F.when(we1 > n, n).otherwise(we1)
        ws3 = F.greatest(ws2, F.lit(0).cast("bigint"))
        we3 = F.least(we2, n)
        prev_end = F.when(i == 0, F.lit(0).cast("bigint")).otherwise(F.element_at(groups, i)["fe"])
        return F.struct(ws3.alias("ws"), we3.alias("we"), prev_end.alias("prev"))

    # the edges are bound before they grow
    return F.transform(F.transform(groups, window), lambda w: F.struct(
        F.greatest(_grow_left(text, w["ws"]), w["prev"]).alias("start"), _grow_right(text, w["we"], n).alias("end")))


def cut_text(text: Column, windows: Column) -> Column:
    """array<string>: the text inside each window."""
    return F.transform(windows, lambda w: F.substring(text, w["start"] + 1, w["end"] - w["start"]))


def islands(positions: Column, w: int = 3) -> Column:
    """W1 on a sorted array of hit positions: array<struct<first, last>> of islands,
    a new island iff the gap to the previous hit exceeds ``2w``."""
    def from_positions(p):
        starts = F.filter(F.sequence(F.lit(1), F.size(p)),
                          lambda i: (i == 1) | (F.element_at(p, i) - F.element_at(p, F.greatest(i - 1, F.lit(1))) > 2 * w))
        return X.let(starts, lambda st: F.transform(
            st,
            lambda s, j: F.struct(
                F.element_at(p, s).alias("first"),
                F.element_at(p, F.when(j + 1 < F.size(st), F.element_at(st, j + 2) - 1)
                             .otherwise(F.size(p))).alias("last"),
            ),
        ))

    return X.let(positions, from_positions)


def island_windows(isl: Column, w: int = 3, inclusive: bool = True) -> Column:
    """array<struct<lo, hi>> token ranges; ``hi`` inclusive when ``inclusive`` (the
    documented intent), else exclusive (the original slicing)."""
    return F.transform(isl, lambda x: F.struct(
        F.greatest(x["first"] - w, F.lit(0).cast("bigint")).alias("lo"),
        (x["last"] + w + (0 if inclusive else -1)).alias("hi")))


def slice_windows(terms: Column, windows: Column) -> Column:
    """array<array<string>>: ``terms[lo..hi]`` (0-based, inclusive) per window."""
    return X.let(terms, lambda t: F.transform(windows, lambda x: F.slice(t, (x["lo"] + 1).cast("int"),
                                                                         (x["hi"] - x["lo"] + 1).cast("int"))))


def context_windows(hits: DataFrame, w: int = 3, id_col: str = "doc_id") -> DataFrame:
    """W1 as a row operator (gaps and islands): ``(id, island, lo, hi)`` from hit rows
    ``(id, position)``; ``lag`` -> new-island flag -> running sum -> min/max.  The
    window partitions by document only, the same key the hits are partitioned on."""
    o = Window.partitionBy(id_col).orderBy("position")
    flagged = hits.select(id_col, "position",
                          F.when(F.col("position") - F.lag("position").over(o) <= 2 * w, 0).otherwise(1).alias("_new"))
    numbered = flagged.withColumn(
        "island", F.sum("_new").over(o.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("bigint"))
    return (numbered.groupBy(id_col, "island")
            .agg(F.greatest(F.min("position") - w, F.lit(0)).cast("bigint").alias("lo"),
                 (F.max("position") + w).cast("bigint").alias("hi")))
