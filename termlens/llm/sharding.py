"""Uniform shuffle into shards of exact sizes, in DataFrame functions only.

Method: a hypergeometric communication matrix.  The source partitions' row counts and the
shards' exact sizes (at most one apart) are fixed; how many rows each partition sends to each
shard is drawn from the multivariate hypergeometric law a uniform permutation has.  Every
partition then permutes its rows locally and deals them out by its row of the matrix (which
is the exchange), and every shard permutes what it received.  Law: ``rows``.

A row is identified by its place in the input (partition and row number of the scan), kept in
one narrow checkpoint, so retried tasks see the same rows, and repeated rows, null ids or a
hot source make no difference.  A shard's second permutation orders by a random key; it is
ranked in ``(shard, key range)`` pieces of about ``piece_rows`` rows with counted offsets, so
no task ranks a whole shard.  The driver sees one count per partition, one per piece.

Defined results: null text has size 1 and crc32 0; an empty table gives no rows; other columns
are not read by the query and are carried through by ``shuffle_into_shards`` (the result's ``shard`` and
``slot`` stand beside them); repeated rows are rows of their own; a very long text enters the query as
its size and checksum.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termlens.llm.common import checkpoint

PIECE_ROWS = 20_000


def hypergeometric(good: int, bad: int, draws: int, rng: random.Random) -> int:
    """How many of ``draws`` rows, taken without replacement from ``good + bad``, are good."""
    if draws <= 0 or good <= 0:
        return 0
    if bad <= 0:
        return min(draws, good)
    if draws > (good + bad) // 2:
        return good - hypergeometric(good, bad, good + bad - draws, rng)
    import math

    low, high = max(0, draws - bad), min(draws, good)
    lg = math.lgamma

    def log_p(k: int) -> float:
        return (lg(good + 1) - lg(k + 1) - lg(good - k + 1) + lg(bad + 1) - lg(draws - k + 1)
                - lg(bad - draws + k + 1) - lg(good + bad + 1) + lg(draws + 1) + lg(good + bad - draws + 1))

    mode = min(high, max(low, (draws + 1) * (good + 1) // (good + bad + 2)))
    u = rng.random()
    # inversion outwards from the mode: about one standard deviation of steps
    p_left = p_right = math.exp(log_p(mode))
    left = right = mode
    u -= p_right
    while u > 0 and (left > low or right < high):
        if right < high:
            p_right *= (good - right) * (draws - right) / ((right + 1) * (bad - draws + right + 1))
            right += 1
            u -= p_right
            if u <= 0:
                return right
        if left > low:
            p_left *= left * (bad - draws + left) / ((good - left + 1) * (draws - left + 1))
            left -= 1
            u -= p_left
            if u <= 0:
                return left
    return mode


def communication_matrix(counts: list[int], n_shards: int, seed: int) -> list[list[int]]:
    """Rows: partitions; columns: shards; row sums ``counts``, column sums at most one apart."""
    rng = random.Random(seed)
    total = sum(counts)
    room = [total // n_shards + (s < total % n_shards) for s in range(n_shards)]
    matrix = []
    for n in counts:
        row, left, rest = [], n, sum(room)
        for s in range(n_shards):
            rest -= room[s]
            k = hypergeometric(room[s], rest, left, rng)
            row.append(k)
            left -= k
        room = [r - k for r, k in zip(room, row)]
        matrix.append(row)
    return matrix


def _key(salt: str, seed: int, *cols: Column) -> Column:
    return F.xxhash64(F.lit(f"{salt}-{seed}"), *cols)


def shuffle_into_shards(df: DataFrame, n_shards: int = 16, seed: int = 7, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """``df`` with the columns ``shard`` (0 to n_shards - 1) and ``slot`` (gapless from 0 in
    its shard).  Input columns named like the two are replaced; all others travel as one."""
    spark = df.sparkSession
    names = [c for c in df.columns if c not in ("shard", "slot")]
    data = F.struct(*[F.col(f"`{c}`") for c in names])
    rows = checkpoint(df.select(data.alias("__data"), F.monotonically_increasing_id().alias("__row"))
                      .withColumn("__part", F.shiftright("__row", 33)))
    counts = sorted((r["__part"], r["n"]) for r in rows.groupBy("__part").agg(F.count("*").alias("n")).collect())
    if not counts:
        return rows.select("__data.*", F.lit(None).cast("int").alias("shard"), F.lit(None).cast("long").alias("slot"))
    matrix = communication_matrix([n for _, n in counts], n_shards, seed)
    # one row per partition, n_shards cumulative counts: bounded by the number of input tasks
    ends = [(p, [sum(row[:s + 1]) for s in range(n_shards)]) for (p, _), row in zip(counts, matrix)]
    dealt = spark.createDataFrame(ends, "__part long, __ends array<long>")
    local = Window.partitionBy("__part").orderBy(_key("local", seed, F.col("__row")), "__row")
    sent = (
        rows.withColumn("__rank", F.row_number().over(local))
        .join(dealt, "__part")
        .withColumn("shard", F.size(F.filter("__ends", lambda e: e < F.col("__rank"))).cast("int"))
        .drop("__ends", "__rank")
    )
    total = sum(n for _, n in counts)
    pieces = max(1, -(-total // (n_shards * piece_rows)))
    key = _key("shard", seed, F.col("__row"))
    sent = sent.withColumn("__key", key).withColumn("__piece", F.pmod(F.shiftrightunsigned("__key", 11), F.lit(pieces)))
    sizes = sent.groupBy("shard", "__piece").agg(F.count("*").alias("__n"))
    offsets = sizes.select(
        "shard", "__piece",
        (F.sum("__n").over(Window.partitionBy("shard").orderBy("__piece")) - F.col("__n")).alias("__offset"))
    in_piece = Window.partitionBy("shard", "__piece").orderBy("__key", "__row")
    return (
        sent.withColumn("__place", F.row_number().over(in_piece) - 1)
        .join(offsets, ["shard", "__piece"])
        .select("__data.*", "shard", (F.col("__offset") + F.col("__place")).cast("long").alias("slot"))
    )
