"""Exact top-k by inner product with a pivot-distance index.

Vectors are quantised to integers and scored by their integer inner product.  With one more
coordinate ``sqrt(M**2 - |x|**2)`` (``M``: the largest norm) the inner product becomes a
distance, ``d(q, x)**2 = |q|**2 + M**2 - 2 q.x`` for a query with a zero there, so the triangle
inequality bounds it.

1. Equal vectors are one class; of its ids only the smallest ``k + 1`` can be in any result
   (ties go to the smaller id, a query skips itself).  They are reduced within each batch
   first, so a group of copies costs one row per batch.
2. Pivots are chosen far apart among a bounded sample.  Every class is keyed by its nearest
   pivot and the distance to it; the sorted keys are cut into annuli of ``ANNULUS`` classes, at
   any number of classes: the index, written to the shared folder.
3. Every query class is searched in its own annulus first; the (k + 1)-th score there bounds the
   rest.  Queries are put into blocks of about ``QUERIES`` in the order of the index.  For each block and
   pivot the interval of distances that some query's bound reaches is kept, and an annulus travels
   to a block only if it meets that interval.  A group (block, span of up to ``2**RING_BITS`` annuli) holds at
   most ``2**RING_BITS * ANNULUS + QUERIES + ANNULUS`` vectors, whatever the table; in it only the sorted stretch within a query's
   bound is scored, and the bound rises with what is found.  No row per (query, annulus) is made, and a
   group hands on at most k + 1 pairs a query.

Vectors travel as integers of the fewest bytes that hold all their components (one byte for a
normalised embedding); the width tells which.
Scores are integers; bounds are widened by ``SLACK`` so that rounding drops nothing.

Defined results: vectors that are null or hold a null or a non-finite component take no part
and change nothing for the others; of the others, those whose length is not the most common one
(ties: the smaller) take no part; a row with a null id is no query and no candidate; rows that
repeat an id and a vector are one candidate; an id with several vectors is a query for each, and
none of its rows is a candidate for it; an empty table gives no rows; other columns, whatever their
names, are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termlens.llm.common import checkpoint

SCALE, PIVOTS, SAMPLE, ANNULUS, QUERIES, SLACK = 64, 32, 2048, 2048, 8192, 1e-6
#: A span is ``2**RING_BITS`` annuli at most, fewer if there would else be less than ``GROUPS`` groups.
RING_BITS, GROUPS = 5, 64


def quantised(xs: pa.Array, width: int) -> list[bytes]:
    """Every vector's integers, in the fewest bytes each that hold them all."""
    q = np.floor(xs.flatten().to_numpy(zero_copy_only=False).reshape(len(xs), width) * SCALE).astype("<i8")
    low, high = q.min(axis=1, initial=0), q.max(axis=1, initial=0)
    size = np.full(len(q), 8)
    for n in (4, 2, 1):
        size[(low >= -(1 << 8 * n - 1)) & (high < 1 << 8 * n - 1)] = n
    out: list[bytes] = [b""] * len(q)
    for n in np.unique(size):
        at = np.flatnonzero(size == n)
        for i, row in zip(at.tolist(), q[at].astype(f"<i{n}")):
            out[i] = row.tobytes()
    return out


def classes(rows: DataFrame, k: int, width: int) -> DataFrame:
    """(vec binary, ids: the smallest k + 1, asks: whether a query is among all ids), from
    usable rows (id, x, asks)."""
    def reduce_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups: dict[bytes, list] = {}
            ids, xs, asked = batch.columns
            for i, x, asks in zip(ids.to_pylist(), quantised(xs, width), asked.to_pylist()):
                group = groups.setdefault(x, [set(), False])
                group[0].add(i)
                group[1] |= asks
            yield pa.RecordBatch.from_arrays([
                pa.array(list(groups), pa.binary()),
                pa.array([sorted(g[0])[:k + 1] for g in groups.values()], pa.list_(pa.int64())),
                pa.array([g[1] for g in groups.values()], pa.bool_())], names=["vec", "ids", "asks"])

    parts = rows.mapInArrow(reduce_batch, "vec binary, ids array<long>, asks boolean")
    merged = parts.groupBy("vec").agg(F.flatten(F.collect_list("ids")).alias("ids"), F.max("asks").alias("asks"))
    return merged.select("vec", F.slice(F.array_sort(F.array_distinct("ids")), 1, k + 1).alias("ids"), "asks")


def matrix(vecs: list[bytes], width: int) -> np.ndarray:
    """Vectors from their bytes, as floats (products stay exact up to 2**53)."""
    out, size = np.empty((len(vecs), width)), np.fromiter(map(len, vecs), dtype=np.int64, count=len(vecs))
    for n in np.unique(size[size > 0]):
        at = np.flatnonzero(size == n)
        out[at] = np.frombuffer(b"".join(vecs[i] for i in at), f"<i{n // width}").reshape(len(at), width)
    return out


def far_apart(sample: np.ndarray, n: int) -> np.ndarray:
    """Pivots: each the point farthest from those before."""
    chosen = [0]
    nearest = np.linalg.norm(sample - sample[0], axis=1)
    while len(chosen) < min(n, len(sample)) and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, np.linalg.norm(sample - sample[chosen[-1]], axis=1))
    return sample[chosen]


def lifted(x: np.ndarray, top: float) -> np.ndarray:
    """Points with the coordinate that gives all of them the norm ``sqrt(top)``."""
    return np.column_stack([x, np.sqrt(np.maximum(top - (x * x).sum(axis=1), 0))])


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.column_stack([np.sqrt(((x - p) ** 2).sum(axis=1)) for p in pivots])


def in_chunks(f, x: np.ndarray, size: int = 4096) -> np.ndarray:
    return np.concatenate([f(x[a:a + size]) for a in range(0, len(x), size)])


def build(found: DataFrame, pivots: np.ndarray, top: float, width: int) -> DataFrame:
    """The index: (annulus, pivot, dist, vec, ids, asks), sorted by pivot and distance."""
    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                d = in_chunks(lambda p: distances(p, pivots), lifted(matrix(batch.column(0).to_pylist(), width), top))
                near = d.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(d)), near]), *batch.columns],
                    names=["pivot", "dist", "vec", "ids", "asks"])

    columns = "pivot int, dist double, vec binary, ids array<long>, asks boolean"

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, seen = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, piece)), pa.array(np.arange(seen, seen + n)), *batch.columns],
                names=["piece", "nth", *batch.schema.names])
            seen += n

    keyed = found.select("vec", "ids", "asks").mapInArrow(key, columns)
    ranged = checkpoint(
        keyed.repartitionByRange("pivot", "dist", "vec").sortWithinPartitions("pivot", "dist", "vec")
        .mapInArrow(number, f"piece long, nth long, {columns}"))
    # where each range begins in the whole order: as many rows as ranges
    upto = Window.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    begins = ranged.groupBy("piece").agg(F.count("*").alias("n")).select(
        "piece", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("begin"))
    place = F.col("begin") + F.col("nth")
    return ranged.join(F.broadcast(begins), "piece").withColumn("annulus", F.floor(place / ANNULUS)).drop("piece", "nth", "begin")


def reaches(q: np.ndarray, floor: np.ndarray, top: float) -> np.ndarray:
    """How far from a query a vector can lie whose score is ``floor`` or more."""
    return np.sqrt(np.maximum((q * q).sum(axis=1) + top - 2 * floor, 0)) * (1 + SLACK) + SLACK


def to_pivots(q: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return in_chunks(lambda p: distances(p, pivots), np.column_stack([q, np.zeros(len(q))]))


def search(q: np.ndarray, floor: np.ndarray, rows: pa.Table, pivots: np.ndarray, top: float, k: int):
    """(query, score, id) of every query's k + 1 best ids among ``rows`` (of the index, in any order), none
    under ``floor`` (the (k + 1)-th score known so far), in that order; and the floors as they are then."""
    rows = rows.sort_by([("pivot", "ascending"), ("dist", "ascending")]).combine_chunks()
    width, floor = q.shape[1], floor.copy()
    pivot, dist, vecs = rows["pivot"].to_numpy(), rows["dist"].to_numpy(), rows["vec"].to_pylist()
    lists = rows["ids"].combine_chunks()
    size, flat = pc.list_value_length(lists).to_numpy().astype(np.int64), lists.flatten().to_numpy()
    at = np.cumsum(size) - size
    # sums of products are at most ``top``, partial ones too
    kind = np.float32 if top < 1 << 24 else np.float64
    exact = q.astype(kind)
    j, s, c = np.empty(0, np.int64), np.empty(0, kind), np.empty(0, np.int64)
    heads = np.flatnonzero(np.r_[True, pivot[1:] != pivot[:-1]])
    own = {p: to_pivots(q, pivots[[p]])[:, 0] for p in pivot[heads]}
    for head, end in zip(heads, np.r_[heads[1:], len(pivot)]):
        for a, b in ((i, min(i + ANNULUS, end)) for i in range(head, end, ANNULUS)):
            reach = reaches(q, floor, top)
            low = np.searchsorted(dist[a:b], own[pivot[a]] - reach)
            high = np.searchsorted(dist[a:b], own[pivot[a]] + reach, side="right")
            some = np.flatnonzero(high > low)
            if not len(some):
                continue
            some = some[np.argsort(low[some], kind="stable")]
            x, more = matrix(vecs[a:b], width).astype(kind), []
            for part in (some[i:i + 256] for i in range(0, len(some), 256)):
                first, last = int(low[part].min()), int(high[part].max())
                scores = exact[part] @ x[first:last].T
                row, col = np.nonzero(scores >= floor[part].astype(kind)[:, None])
                more.append((part[row], scores[row, col], a + first + col))
            j, s, c = (np.concatenate(new) for new in zip((j, s, c), *more))
            # the k + 1 best pairs are of the k + 1 best classes by score and least id
            order = np.lexsort((flat[at[c]], -s, j))
            j, s, c = j[order], s[order], c[order]
            begin = np.searchsorted(j, j)
            before = np.cumsum(size[c]) - size[c]
            before -= before[begin]
            last = (before <= k) & (before + size[c] > k)  # holds the (k + 1)-th id
            floor[j[last]] = np.maximum(floor[j[last]], s[last])
            kept = np.arange(len(j)) - begin <= k
            j, s, c = j[kept], s[kept], c[kept]
    n = size[c]
    ids = flat[np.repeat(at[c] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
    j, s = np.repeat(j, n), np.repeat(s, n)
    order = np.lexsort((ids, -s, j))
    j, s, ids = j[order], s[order].astype(np.int64), ids[order]
    kept = np.arange(len(j)) - np.searchsorted(j, j) <= k
    return j[kept], s[kept], ids[kept], floor


def nearest(df: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): every query's k best other rows."""
    x = F.col(vec_col).cast("array<double>")
    finite = F.forall(x, lambda v: F.coalesce(F.abs(v) < float("inf"), F.lit(False)) & ~F.isnan(v))
    dims = F.when(finite, F.size(x))
    sized = df.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), x.alias("x"), F.coalesce(is_query, F.lit(False)).alias("asks"), dims.alias("d"))
    common = sized.filter(F.col("d").isNotNull()).groupBy("d").agg(F.count("*").alias("n")).orderBy(
        F.desc("n"), "d").limit(1).collect()
    width = common[0]["d"] if common else 0
    usable = sized.filter(F.col("d") == width).select("id", "x", "asks")
    found = checkpoint(classes(usable, k, width))

    def norms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array((matrix(batch.column(0).to_pylist(), width) ** 2).sum(axis=1))], names=["n"])

    stats = found.select("vec").mapInArrow(norms, "n double").agg(F.max("n").alias("top"), F.count("*").alias("n")).first()
    if not stats["n"]:
        return found.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    top = float(stats["top"])
    sample = [r["vec"] for r in found.select("vec").orderBy(F.xxhash64("vec"), "vec").limit(SAMPLE).collect()]
    pivots = far_apart(lifted(matrix([bytes(v) for v in sample], width), top), PIVOTS)
    index = build(found, pivots, top, width)

    # first look: each query class in its own annulus
    def at_home(rows: pa.Table) -> pa.Table:
        asking = rows.filter(rows["asks"]).select(["vec", "annulus"])
        floor = np.full(len(asking), -np.inf)
        if len(asking):
            floor = search(matrix(asking["vec"].to_pylist(), width), floor, rows, pivots, top, k)[3]
        return pa.table({"vec": asking["vec"], "floor": floor, "annulus": asking["annulus"]})

    floors = checkpoint(index.groupBy("annulus").applyInArrow(at_home, "vec binary, floor double, annulus long"))
    # blocks of queries in the order of the index: as many rows as annuli
    upto = Window.orderBy("annulus").rowsBetween(Window.unboundedPreceding, -1)
    block = F.floor(F.coalesce(F.sum("n").over(upto), F.lit(0)) / QUERIES)
    blocks = floors.groupBy("annulus").agg(F.count("*").alias("n")).select("annulus", block.alias("block"))
    asking = checkpoint(floors.join(blocks, "annulus").select("vec", "floor", "block"))
    n_groups = -(-stats["n"] // ANNULUS) * -(-floors.count() // QUERIES)
    span = int(max(1, min(1 << RING_BITS, n_groups // GROUPS)))

    def reached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each block and pivot the distances its queries of a batch can reach."""
        for batch in batches:
            if not batch.num_rows:
                continue
            q, of = matrix(batch.column(0).to_pylist(), width), batch.column(2).to_numpy()
            own, reach = to_pivots(q, pivots), reaches(q, batch.column(1).to_numpy(), top)[:, None]
            for one in np.unique(of):
                mine = of == one
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(pivots), one)), pa.array(np.arange(len(pivots), dtype=np.int32)),
                    pa.array((own - reach)[mine].min(axis=0)), pa.array((own + reach)[mine].max(axis=0))],
                    names=["block", "pivot", "least", "most"])

    hulls = asking.mapInArrow(reached, "block long, pivot int, least double, most double").groupBy("block", "pivot").agg(
        F.min("least").alias("least"), F.max("most").alias("most"))
    rings = index.groupBy("annulus", "pivot").agg(F.min("dist").alias("low"), F.max("dist").alias("high"))
    visits = checkpoint(rings.join(hulls, "pivot").filter((F.col("high") >= F.col("least")) & (F.col("low") <= F.col("most"))).select(
        "annulus", F.col("block").alias("to"), F.floor(F.col("annulus") / span).alias("part")).distinct())
    # an annulus goes to the blocks that it may concern, a block to the spans
    sent = asking.join(visits.select(F.col("to").alias("block"), F.col("part").alias("span")).distinct(), "block")
    spread = index.join(visits, "annulus").select("to", "part", "pivot", "dist", "vec", "ids")

    def visit(queries: pa.Table, rows: pa.Table) -> pa.Table:
        kind = pa.list_(pa.struct([("loss", pa.int64()), ("id", pa.int64())]))
        if not len(queries) or not len(rows):
            return pa.table({"vec": pa.array([], pa.binary()), "found": pa.array([], kind)})
        j, s, i, _ = search(matrix(queries["vec"].to_pylist(), width), queries["floor"].to_numpy(), rows, pivots, top, k)
        asked, begin = np.unique(j, return_index=True)
        pairs = pa.StructArray.from_arrays([pa.array(-s, pa.int64()), pa.array(i, pa.int64())], ["loss", "id"])
        return pa.table({"vec": queries["vec"].take(pa.array(asked)),
                         "found": pa.ListArray.from_arrays(pa.array(np.r_[begin, len(j)], pa.int32()), pairs)})

    visited = sent.groupBy("block", "span").cogroup(spread.groupBy("to", "part")).applyInArrow(
        visit, "vec binary, found array<struct<loss: long, id: long>>")
    merged = F.slice(F.sort_array(F.flatten(F.collect_list("found"))), 1, k + 1)
    best = checkpoint(visited.groupBy("vec").agg(merged.alias("found")))

    # every query id takes its class's result without itself
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, xs = batch.columns
            yield pa.RecordBatch.from_arrays([ids, pa.array(quantised(xs, width), pa.binary())],
                                             names=["query_id", "vec"])

    queries = usable.filter("asks").select("id", "x").mapInArrow(keys, "query_id long, vec binary")
    others = F.slice(F.filter("found", lambda e: e["id"] != F.col("query_id")), 1, k)
    return (
        queries.distinct().join(best, "vec").select("query_id", F.posexplode(others).alias("pos", "e"))
        .select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("e.id").alias("vec_id"),
                (-F.col("e.loss")).alias("score")))
