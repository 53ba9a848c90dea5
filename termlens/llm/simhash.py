"""SimHash near-duplicates with BK-trees.

Fingerprint: XXH64 (seed 42) of every shingle of ``shingle`` words, a bit is 1 if more than
half of the hashes have it.  Distinct fingerprints within ``radius`` bits are linked, and a
document's class is its connected component.

Search: 64 bits are cut into ``radius + 2`` blocks; two fingerprints within the radius agree
on at least two whole blocks, so each fingerprint joins one shard per pair of blocks, keyed by
the pair and its bits.  Inside a shard a BK-tree is built (children keyed by the integer
Hamming distance to the parent) and queried by the shard's members, following only edges whose
distance lies within the radius of the query's own.  Shard trees go to the tasks whose
queries can match them by the shuffle on the shard key instead of a broadcast: all trees
together grow with the corpus and have no size bound.  A shard of more than ``MAX_QUERIES``
members is split: every part gets the tree and one slice of the queries.

A shard emits a spanning forest of its links, never all pairs.  The components of the links are
found by minimum labels and pointer jumping with a reliable checkpoint per round; the label of a
large component is a hot key, and its joins are salted.  Equal fingerprints are one class
from the start, so copies cost one row.

Defined results: a text without words (null, empty, blank) has fingerprint zero and is linked
like any other; a null id can be a row but is never a component's id unless all its ids are
null; repeated rows are rows of one class; an empty table gives no rows; a very long text is hashed
whole, in parts; ``keep_one`` hands on all columns, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termlens.llm.common import checkpoint, expand, tidy
from termlens.operators.skew import salted_join

SEED = 42
BLANK = re.compile(rb"[ \t\n\x0b\x0c\r]")
MAX_QUERIES = 8192
CHUNK_ROWS, FRONTIER = 1 << 18, 1 << 21


def word_parts(data: bytes, size: int = 1 << 18) -> Iterator[list[bytes]]:
    """The words between ASCII white space, about ``size`` bytes of text at a time."""
    at = 0
    while at < len(data):
        end = len(data)
        if end - at > size:
            blank = BLANK.search(data, at + size)
            end = blank.start() if blank else end
        yield data[at:end].split()
        at = end


def fingerprint(text: str | None, shingle: int) -> int:
    hash64 = xxhash.xxh64_intdigest
    ones, n_hashes, carried = np.zeros(64, dtype=np.int64), 0, []
    for words in word_parts((text or "").encode("utf-8", "surrogatepass").lower()):  # A-Z only
        words = carried + words
        n = len(words)
        if n >= shingle:
            data = b" ".join(words)
            lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
            ends = np.cumsum(lengths + 1) - 1
            starts = ends - lengths
            hashes = np.array([hash64(data[a:b], SEED) for a, b in
                               zip(starts[:n - shingle + 1].tolist(), ends[shingle - 1:].tolist())], dtype=np.uint64)
            bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
            n_hashes += len(hashes)
        carried = words[max(0, n - shingle + 1):] if shingle > 1 else []
    if not n_hashes:
        return hash64(b" ".join(carried), SEED) if carried else 0
    return int.from_bytes(np.packbits(2 * ones > n_hashes, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, fp): fp is the fingerprint as a signed 64-bit integer."""
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(2)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps.view(np.int64))],
                                             names=["doc_id", "text_hash", "fp"])

    return rows.mapInArrow(tidy(run), f"doc_id {dict(rows.dtypes)['doc_id']}, text_hash long, fp long")


def shard_masks(radius: int) -> list[int]:
    """For every pair of blocks, the mask of its bits."""
    cuts = np.linspace(0, 64, radius + 3).round().astype(int)
    blocks = [((1 << int(b - a)) - 1) << int(a) for a, b in zip(cuts, cuts[1:])]
    return [a | b for a, b in combinations(blocks, 2)]


class Forest:
    """The BK-trees of many shards at once: built and searched level by level in numpy."""

    def __init__(self, shard: np.ndarray, fp: np.ndarray):
        """Rows sorted by shard; fingerprints distinct within a shard."""
        self.fp = fp
        n = len(fp)
        first = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]]) if n else np.empty(0, np.int64)
        sizes = np.diff(np.r_[first, n])
        self.root = np.repeat(first, sizes)
        self.size = np.repeat(sizes, sizes)
        active = np.setdiff1d(np.arange(n), first, assume_unique=True)
        at = self.root[active]
        keys, children = [], []
        while len(active):
            edge = at * 65 + np.bitwise_count(fp[active] ^ fp[at])
            order = np.argsort(edge, kind="stable")
            ranked = edge[order]
            lead = np.r_[True, ranked[1:] != ranked[:-1]]
            head = order[lead]
            keys.append(edge[head])
            children.append(active[head])
            owner = active[head][np.cumsum(lead) - 1]
            active, at = active[order][~lead], owner[~lead]
        key = np.concatenate(keys) if keys else np.empty(0, np.int64)
        child = np.concatenate(children) if children else np.empty(0, np.int64)
        order = np.argsort(key)
        self.key, self.child = key[order], child[order]

    def search(self, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query, node) of members within the radius, some at a time."""
        cost = np.cumsum(self.size[queries])
        total = int(cost[-1]) if len(queries) else 0
        cuts = [*np.searchsorted(cost, np.arange(0, total, FRONTIER)).tolist(), len(queries)]
        for a, b in zip(cuts, cuts[1:]):
            q = queries[a:b]
            node = self.root[q]
            while len(q):
                d = np.bitwise_count(self.fp[q] ^ self.fp[node]).astype(np.int64)
                hit = (d <= radius) & (q != node)
                if hit.any():
                    yield q[hit], node[hit]
                low = np.searchsorted(self.key, node * 65 + np.maximum(d - radius, 0))
                count = np.searchsorted(self.key, node * 65 + np.minimum(d + radius, 64), side="right") - low
                q, node = np.repeat(q, count), self.child[expand(low, count)]

    def spanning(self, queries: np.ndarray, radius: int) -> np.ndarray:
        """For every member the smallest member it is linked to through found pairs."""
        label = np.arange(len(self.fp))
        for a, b in self.search(queries, radius):
            while True:
                while not np.array_equal(up := label[label], label):
                    label = up
                x, y = label[a], label[b]
                apart = x != y
                if not apart.any():
                    break
                a, b, x, y = a[apart], b[apart], x[apart], y[apart]
                np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(up := label[label], label):
            label = up
        return label


def links(fps: DataFrame, radius: int = 3, max_queries: int = MAX_QUERIES) -> DataFrame:
    """(a, b): spanning links between distinct fingerprints (column ``fp``) within the radius."""
    masks = shard_masks(radius)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys = F.array(*[F.xxhash64(F.lit(k), F.col("fp").bitwiseAND(F.lit(m).cast("long"))) for k, m in enumerate(signed)])
    members = fps.select("fp", F.explode(keys).alias("shard"))
    crowded = members.groupBy("shard").agg(F.count("*").alias("n")).filter(F.col("n") > max_queries).select(
        "shard", F.ceil(F.col("n") / max_queries).cast("int").alias("parts"))
    dealt = (
        members.join(crowded, "shard", "left")
        .withColumn("own", F.pmod(F.xxhash64("fp"), F.coalesce("parts", F.lit(1))).cast("int"))
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)))
        .select("shard", "part", "fp", (F.col("own") == F.col("part")).alias("asks"))
        .repartition("shard", "part").sortWithinPartitions("shard", "part", "fp")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(shard, part, fp, asks):
            # key shard and part together; neighbours with the same shard but another part differ
            new = np.r_[True, (shard[1:] != shard[:-1]) | (part[1:] != part[:-1])]
            run_id = np.cumsum(new)
            size = np.bincount(run_id)[run_id]
            many = size > 1  # a lone member has no partner in this shard
            if not many.any():
                return None
            run_id, fp, asks = run_id[many], fp[many], asks[many]
            forest = Forest(run_id, fp)
            label = forest.spanning(np.flatnonzero(asks), radius)
            tied = label != np.arange(len(fp))
            if not tied.any():
                return None
            pairs = np.unique(np.column_stack([fp[tied], fp[label[tied]]]).view(np.int64), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

        held: list[tuple] = []
        rows = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy(),
                         batch.column(2).to_numpy().view(np.uint64), batch.column(3).to_numpy(zero_copy_only=False)))
            rows += batch.num_rows
            if rows < CHUNK_ROWS:
                continue
            cols = [np.concatenate(x) for x in zip(*held)]
            # the last shard may go on in the next batch
            last = int(np.searchsorted(cols[0] == cols[0][-1], True)) if cols[0][0] != cols[0][-1] else 0
            if last and (out := found(*(c[:last] for c in cols))) is not None:
                yield out
            held = [tuple(c[last:] for c in cols)]
            rows = len(held[0][0])
        if held and (out := found(*(np.concatenate(x) for x in zip(*held)))) is not None:
            yield out

    return dealt.mapInArrow(tidy(run), "a long, b long").distinct()


def components(pairs: DataFrame) -> DataFrame:
    """(node, label): the connected components of undirected links (a, b); the label is a node
    of the component.  Minimum labels spread over links and jump to the label's own label; each
    round is checkpointed, so a lost executor costs one round at most."""
    links_ = checkpoint(pairs.select("a", "b").union(pairs.select("b", "a")).toDF("src", "dst"))
    labels = checkpoint(links_.groupBy(F.col("src").alias("node")).agg(
        F.least(F.min("dst"), F.first("src")).alias("label")))
    while True:
        heard = (
            links_.join(labels.select(F.col("node").alias("dst"), "label"), "dst")
            .groupBy(F.col("src").alias("node")).agg(F.min("label").alias("heard")))
        told = checkpoint(labels.join(heard, "node").select(
            "node", F.least("label", "heard").alias("label"), F.col("label").alias("was")))
        up = told.groupBy("label").agg(F.count("*").alias("n")).join(
            told.select(F.col("node").alias("label"), F.col("label").alias("up")), "label")
        jumped = checkpoint(
            salted_join(told, up, ["label"], "n", told.select(F.count("*")).scalar(), "node")
            .select("node", F.least("label", "up").alias("label"), "was"))
        labels = jumped.select("node", "label")
        if not jumped.filter("label <> was").limit(1).count():
            return labels


def classed(docs: DataFrame, shingle: int, radius: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text_hash, fp, label, component_id) of every row; ``label`` names the component
    even where ids repeat."""
    rows = checkpoint(fingerprints(docs, shingle, id_col, text_col))
    classes = checkpoint(rows.groupBy("fp").agg(F.min("doc_id").alias("smallest"), F.count("*").alias("copies")))
    labels = components(links(classes, radius)).withColumnRenamed("node", "fp")
    tied = checkpoint(classes.join(labels, "fp"))
    smallest = checkpoint(tied.groupBy("label").agg(F.min("smallest").alias("component_id"), F.count("*").alias("n")))
    joined = salted_join(tied, smallest, ["label"], "n", smallest.select(F.sum("n")).scalar(), "fp")
    alone = classes.join(labels, "fp", "left_anti").select("fp", F.col("fp").alias("label"), "smallest", "copies")
    named = checkpoint(joined.select("fp", "label", "component_id", "copies").union(alone))
    found = salted_join(rows, named, ["fp"], "copies", named.select(F.sum("copies")).scalar(), "doc_id")
    return found.select("doc_id", "text_hash", "fp", "label", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) of every row; component_id is the smallest id reachable."""
    return classed(docs, shingle, radius, id_col, text_col).select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 3, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """One row of each component, with all columns of ``docs``: that of its smallest id (nulls
    last; where an id repeats, the smallest text hash; of rows equal in both, any one)."""
    found = classed(docs, shingle, radius, id_col, text_col)
    chosen = found.groupBy("label").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("k")
    ).select(F.col("k.doc_id").alias("__id"), F.col("k.text_hash").alias("__hash"))
    keyed = docs.select(F.col(id_col).alias("__doc"), F.xxhash64(F.col(text_col).cast("string")).alias("__text_hash"),
                        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__data"))
    same = F.col("__doc").eqNullSafe(F.col("__id")) & (F.col("__text_hash") == F.col("__hash"))
    first = Window.partitionBy("__doc", "__text_hash").orderBy("__text_hash")
    return (
        keyed.join(checkpoint(chosen), same, "left_semi")
        .withColumn("__nth", F.row_number().over(first)).filter("__nth = 1")
        .select("__data.*")
    )
