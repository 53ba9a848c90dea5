"""Conversation prefix trie by time-forward processing.

A node is a distinct sequence of a conversation's first d turns; the conversations that start
with it are its members, its smallest member names it.  Every node gets its members, children,
leaves and the tokens that storing shared prefixes once would save, summed over its subtree.

1. Places.  Turns are ranged by (conversation, turn) over the cluster, numbered inside each
   (conversation, range) piece and offset by the counts of the pieces before, so one
   conversation with a third of all rows spreads over many tasks.
2. Nodes.  A prefix is identified by its length and two 63-bit sums of 64-bit hashes of
   (place, role, text): sums, because they too are taken per band of ``BAND`` turns and offset.
   Members are counted by a partial aggregate over all prefixes.
3. Shards.  A node begins a fragment where the depth is a multiple of ``BAND`` or where its number of
   members falls into another power of ``2**WEIGHT_BITS`` than its parent's.  A fragment holds at most
   ``2**WEIGHT_BITS`` nodes a level, so ``BAND * 2**WEIGHT_BITS`` in all, however many conversations
   share a prefix.  Fragments are dealt to shards by hash.
4. Across shard roots.  A fragment's own sum needs no order; the sums of all fragments below each
   shard root are gathered along parent pointers that double in every round, so a chain of a
   million bands takes twenty rounds.
5. Within shards.  Spark's external sort gives the nodes of a shard in reverse level order.  They
   pass through once: a node takes the messages of its children from a priority queue keyed
   like the sort (the roots of other fragments send theirs along as rows, summed by parent), and
   sends its subtree's totals forward to its parent.  The queue holds ``HELD`` messages; more are
   spilled as sorted runs into an unlinked file in the folder Spark gives this task for spills.

Defined results: null role or text is empty; a null turn comes first; rows that share a turn are
ordered by a hash of role and text; a null conversation id is no conversation, its rows take no
part; a repeated row is a further turn; no conversations, no nodes (not even the root); very long
texts enter as their hash and word count; columns of other names are not read.

The digest of a node's conversations that end there is one sequential hash by its definition: ids
are joined in pieces of at most ``2**ID_BITS`` by the aggregate, and one task streams a node's pieces.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termlens.llm.common import checkpoint, tidy
from termlens.operators.skew import salted_join

BAND, WEIGHT_BITS, ID_BITS, HELD = 64, 6, 12, 1 << 17
WORD = r"[^\x20\x09-\x0D]+"
NODE = ["depth", "a", "b"]


# --- paths ---------------------------------------------------------------------------------------

def numbered(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """(conv_id, place, content, words): every turn with its place in its conversation, from 1."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = conversations.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
        F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256).alias("content"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    ranged = checkpoint(
        rows.repartitionByRange("conv_id", "turn", "content").withColumn("piece", F.spark_partition_id()))
    sizes = ranged.groupBy("conv_id", "piece").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("conv_id", "piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("conv_id", "piece").orderBy("turn", "content")
    return checkpoint(
        ranged.withColumn("nth", F.row_number().over(within)).join(starts, ["conv_id", "piece"])
        .select("conv_id", (F.col("before") + F.col("nth")).alias("place"), "content", "words"))


def rebuilt(turns: DataFrame, family: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """Paths (conv_id, place, content, words) and (conv_id, length) of conversations that start like
    the first of their family: the first ``crc32(id) % heads`` turns of conversation
    ``id - id % family``, then the conversation's own turns after as many."""
    conv = F.col("conv_id")
    first = turns.filter((conv % family == 0) & (F.col("place") < heads)).groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("place", "content", "words"))).alias("first"))
    own = turns.groupBy("conv_id").agg(F.count("*").alias("own")).select(
        "conv_id", "own", (F.crc32(conv.cast("string")) % heads).cast("int").alias("h"), (conv - conv % family).alias("base"))
    lent = F.slice(F.coalesce("first", F.array().cast("array<struct<place: bigint, content: string, words: bigint>>")),
                   F.lit(1), F.col("h"))
    convs = checkpoint(
        own.join(first.withColumnRenamed("conv_id", "base"), "base", "left")
        .select("conv_id", "own", "h", lent.alias("lent")))
    kept = (
        salted_join(turns, convs.select("conv_id", "own", "h", F.size("lent").alias("k")), ["conv_id"], "own",
                    convs.select(F.sum("own")).scalar(), "place")
        .filter(F.col("place") > F.col("h"))
        .select("conv_id", (F.col("k") + F.col("place") - F.col("h")).alias("place"), "content", "words"))
    paths = kept.unionByName(convs.select("conv_id", F.explode("lent").alias("t")).select("conv_id", "t.*"))
    lengths = convs.select("conv_id", (F.size("lent") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).cast("long").alias("length"))
    return paths, lengths


def prefixes(paths: DataFrame, lengths: DataFrame) -> DataFrame:
    """Every prefix of every conversation, the empty one included: (conv_id, band, depth, a, b,
    parent_a, parent_b, words, ends)."""
    lane = lambda k: F.when(F.col("content").isNotNull(), F.xxhash64(F.lit(k), F.col("place"), F.col("content"))).otherwise(
        F.lit(0)).cast("decimal(20,0)")
    rows = paths.select("conv_id", F.col("place").cast("long").alias("place"), "content", "words").unionByName(
        lengths.select("conv_id", F.lit(0).cast("long").alias("place"), F.lit(None).cast("string").alias("content"),
                       F.lit(0).cast("long").alias("words")))
    laned = rows.select("conv_id", F.floor(F.col("place") / BAND).alias("band"), F.col("place").alias("depth"),
                        lane("a").alias("own_a"), lane("b").alias("own_b"), "words")
    before = Window.partitionBy("conv_id").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    sums = laned.groupBy("conv_id", "band").agg(F.sum("own_a").alias("sum_a"), F.sum("own_b").alias("sum_b")).select(
        "conv_id", "band", *[F.coalesce(F.sum(f"sum_{k}").over(before), F.lit(0)).alias(f"sum_{k}") for k in "ab"]
    ).join(lengths, "conv_id")
    upto = Window.partitionBy("conv_id", "band").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    folded = lambda c: F.pmod(c, F.lit(str(1 << 63)).cast("decimal(20,0)")).cast("long")
    running = laned.withColumn("run_a", F.sum("own_a").over(upto)).withColumn("run_b", F.sum("own_b").over(upto)).join(
        sums, ["conv_id", "band"])
    return checkpoint(running.select(
        "conv_id", "band", "depth", *[folded(F.col(f"sum_{k}") + F.col(f"run_{k}")).alias(k) for k in "ab"],
        *[folded(F.col(f"sum_{k}") + F.col(f"run_{k}") - F.col(f"own_{k}")).alias(f"parent_{k}") for k in "ab"],
        "words", (F.col("depth") == F.col("length")).alias("ends")))


# --- nodes and shards ------------------------------------------------------------------------------

def weight(n: Column) -> Column:
    """The power of ``2**WEIGHT_BITS`` that n falls into."""
    return F.floor((F.length(F.bin(n)) - 1) / WEIGHT_BITS)


def nodes(found: DataFrame) -> DataFrame:
    """One row per distinct prefix with its fragment (named by the fragment's first node), and for a
    fragment's first node the fragment of its parent (null at the root)."""
    distinct = checkpoint(found.groupBy(*NODE).agg(
        F.min("conv_id").alias("first"), F.count("*").alias("n_convs"), F.sum(F.col("ends").cast("long")).alias("n_ends")))
    rows = salted_join(found, distinct, NODE, "n_convs", distinct.select(F.sum("n_convs")).scalar(), "conv_id").withColumn(
        "weight", weight(F.col("n_convs")))
    along = Window.partitionBy("conv_id", "band").orderBy("depth")
    cut = (F.col("depth") % BAND == 0) | (F.col("weight") != F.lag("weight").over(along))
    marked = rows.withColumn("cut", cut).withColumn(
        "fragment", F.last(F.when(F.col("cut"), F.struct(*NODE)), ignorenulls=True).over(
            along.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    marked = checkpoint(marked.withColumn("above", F.lag(F.struct("fragment", F.col("first").alias("conv_id"))).over(along)))
    # the first node of a band has its parent in the band before
    last = marked.groupBy("conv_id", "band").agg(
        F.max_by(F.struct("fragment", F.col("first").alias("conv_id")), "depth").alias("band_above")
    ).withColumn("band", F.col("band") + 1)
    own = marked.filter(F.col("conv_id") == F.col("first"))
    inside, heads = own.filter(F.col("depth") % BAND != 0), own.filter(F.col("depth") % BAND == 0)
    heads = heads.join(last, ["conv_id", "band"], "left").withColumn("above", F.col("band_above")).drop("band_above")
    return checkpoint(inside.unionByName(heads).select(
        *NODE, "parent_a", "parent_b", "conv_id", F.col("above.conv_id").alias("parent_conv_id"), "n_convs", "n_ends",
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"), "fragment", "cut",
        F.when(F.col("cut"), F.col("above.fragment")).alias("up")))


def below(fragments: DataFrame) -> DataFrame:
    """(id, leaves, saved) summed over each fragment and all fragments below it, from (id, up,
    leaves, saved).  Pointers double: after round r a fragment has heard from all that are less
    than ``2**r`` below it."""
    state = checkpoint(fragments)
    while state.filter(F.col("up").isNotNull()).limit(1).count():
        asking = state.filter(F.col("up").isNotNull())
        heard = checkpoint(
            asking.groupBy("up").agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"), F.count("*").alias("n"))
            .join(state.select(F.col("id").alias("up"), F.col("up").alias("next")), "up"))
        moved = salted_join(asking.select("id", "up"), heard.select("up", "n", "next"), ["up"], "n",
                            heard.select(F.sum("n")).scalar(), "id").select("id", "next")
        state = checkpoint(
            state.drop("up").join(heard.select(F.col("up").alias("id"), "more_leaves", "more_saved"), "id", "left")
            .join(moved, "id", "left").select(
                "id", F.col("next").alias("up"), (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
                (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved")))
    return state.select("id", "leaves", "saved")


class SpillingQueue:
    """A priority queue of tuples that keeps ``held`` of them in memory and the rest as sorted runs in
    files that have no name, so that nothing is left behind."""

    CHUNK = 4096

    def __init__(self, held: int = HELD):
        self.limit = held
        self.heap: list[tuple] = []
        self.heads: list[tuple] = []  # (first tuple of a run, run)
        self.runs: list[Iterator[tuple]] = []

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.limit:
            self._spill()

    def _spill(self) -> None:
        folders = [d for d in os.environ.get("SPARK_LOCAL_DIRS", "").split(",") if d and os.path.isdir(d)]
        file = tempfile.TemporaryFile(dir=folders[len(self.runs) % len(folders)] if folders else None)
        self.heap.sort()
        for k in range(0, len(self.heap), self.CHUNK):
            pickle.dump(self.heap[k:k + self.CHUNK], file)
        file.seek(0)
        self.heap = []

        def read() -> Iterator[tuple]:
            with file:
                while True:
                    try:
                        yield from pickle.load(file)
                    except EOFError:
                        return

        self.runs.append(read())
        self._advance(len(self.runs) - 1)

    def _advance(self, run: int) -> None:
        if (head := next(self.runs[run], None)) is not None:
            heapq.heappush(self.heads, (head, run))

    def take(self, key: tuple) -> Iterator[tuple]:
        """Remove and return, in order, what begins with ``key`` (nothing smaller is left)."""
        n = len(key)
        while True:
            if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
                if self.heads[0][0][:n] != key:
                    return
                item, run = heapq.heappop(self.heads)
                self._advance(run)
                yield item
            elif self.heap and self.heap[0][:n] == key:
                yield heapq.heappop(self.heap)
            else:
                return


OUT = ("depth long, a long, b long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
       "saved_tokens long")
OUT_NAMES = [c.split()[0] for c in OUT.split(", ")]


def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one shard in reverse level order: messages (``is_node`` false) from other fragments,
    then their node.  Every node takes its messages and sends its totals to its parent."""
    queue = SpillingQueue(HELD)
    for batch in batches:
        out: list[tuple] = []
        for (depth, a, b, is_node, parent_a, parent_b, conv_id, parent_conv_id, n_convs, cut, children, leaves, saved
             ) in zip(*(c.to_pylist() for c in batch.columns)):
            if not is_node:
                queue.push((-depth, a, b, children, leaves, saved))
                continue
            for message in queue.take((-depth, a, b)):
                children, leaves, saved = children + message[3], leaves + message[4], saved + message[5]
            leaves = leaves if children else 1
            out.append((depth, a, b, conv_id, parent_conv_id, n_convs, children, leaves, saved))
            if not cut:
                queue.push((1 - depth, parent_a, parent_b, 1, leaves, saved))
        columns = list(zip(*out)) if out else [[]] * len(OUT_NAMES)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=OUT_NAMES)


def totals(found: DataFrame) -> DataFrame:
    """``OUT`` per node of ``nodes``."""
    fragments = found.groupBy("fragment").agg(
        F.sum((F.col("n_convs") == F.col("n_ends")).cast("long")).alias("leaves"), F.sum("saved").alias("saved"),
        F.max("up").alias("up")).withColumnRenamed("fragment", "id")
    sums = below(fragments.select("id", "up", "leaves", "saved"))
    sent = (
        found.filter(F.col("cut") & F.col("up").isNotNull()).select(F.struct(*NODE).alias("id"), "up", "depth", "parent_a", "parent_b")
        .join(sums, "id").groupBy(F.col("up").alias("fragment"), (F.col("depth") - 1).alias("depth"), F.col("parent_a").alias("a"),
                                  F.col("parent_b").alias("b"))
        .agg(F.count("*").alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")))
    none = F.lit(None).cast("long")
    messages = sent.select(
        "fragment", *NODE, F.lit(False).alias("is_node"), *[none.alias(c) for c in (
            "parent_a", "parent_b", "conv_id", "parent_conv_id", "n_convs")], F.lit(False).alias("cut"),
        "children", "leaves", "saved")
    own = found.select(
        "fragment", *NODE, F.lit(True).alias("is_node"), "parent_a", "parent_b", "conv_id", "parent_conv_id", "n_convs", "cut",
        F.lit(0).cast("long").alias("children"), F.lit(0).cast("long").alias("leaves"), "saved")
    shards = own.unionByName(messages).repartition("fragment").sortWithinPartitions(F.desc("depth"), "a", "b", "is_node")
    return shards.drop("fragment").mapInArrow(tidy(forward), OUT)


def ends(found: DataFrame) -> DataFrame:
    """(depth, a, b, ends_sha256) of the prefixes where conversations end."""
    pieces = found.filter("ends").groupBy(*NODE, F.shiftright("conv_id", ID_BITS).alias("piece")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda i: i.cast("string")), ",").alias("ids"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, hashed = None, None
        for batch in batches:
            out: list[tuple] = []
            for depth, a, b, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if (depth, a, b) != node:
                    if node:
                        out.append((*node, hashed.hexdigest()))
                    node, hashed = (depth, a, b), hashlib.sha256(ids.encode())
                else:
                    hashed.update(b"," + ids.encode())
            if out:
                yield made(out)
        if node:
            yield made([(*node, hashed.hexdigest())])

    def made(out: list[tuple]) -> pa.RecordBatch:
        *ids, digests = zip(*out)
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in ids), pa.array(digests, pa.string())],
                                          names=[*NODE, "ends_sha256"])

    ordered = pieces.repartition(*NODE).sortWithinPartitions(*NODE, "piece")
    return ordered.select(*NODE, "ids").mapInArrow(tidy(digest), "depth long, a long, b long, ends_sha256 string")


def trie(paths: DataFrame, lengths: DataFrame) -> DataFrame:
    """The trie of conversations given as (conv_id, place, content, words) and (conv_id, length):
    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)."""
    found = prefixes(paths, lengths)
    blank = hashlib.sha256(b"").hexdigest()
    return totals(nodes(found)).join(ends(found), NODE, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(blank)).alias("ends_sha256"))
