"""Salted joins for hot keys.

A join of many rows to an *aggregate* keyed by the same column (doc-term pairs to the
per-term background, shingles to their owners) cannot be split by AQE's skew handling,
because the aggregate sits between the join and its shuffle.  A key held by a third of
all rows would then land in one task.  So hot keys are salted explicitly:

* a key is hot when its count is at least ``total / HOT_DENOMINATOR``; the counts of hot
  keys sum to at most ``total``, so there are at most ``HOT_DENOMINATOR`` of them;
* a hot key gets ``ceil(count * TARGET_TASKS / total)`` salts, its share of the tasks the
  join is meant to run in, so no task holds much more than ``total / TARGET_TASKS`` rows;
* the list of hot keys that is broadcast holds a 64-bit hash and the salt count per key,
  12 bytes a row whatever the keys are, at most ``HOT_DENOMINATOR`` rows (a key that
  shares a hot key's hash is salted like it, on both sides, which changes no result);
* big-side rows of hot keys get ``salt = pmod(xxhash64(spread_col), salts)``;
* aggregate-side rows of hot keys are copied once per salt value;
* the join runs on ``(key, salt)``.  Cold keys keep salt 0 and are not copied.

Whether a side is broadcast is left to Spark and AQE.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: skew handling ------------------------------------------------------
HOT_DENOMINATOR = 10_000   # hot: count >= total / this  =>  at most this many hot keys
TARGET_TASKS = 10_000      # tasks the rows of a join should spread over evenly
# ---------------------------------------------------------------------------------------

def hot_keys(agg: DataFrame, keys: list[str], count_col: str, total: Column,
             denominator: int = HOT_DENOMINATOR, target_tasks: int = TARGET_TASKS) -> DataFrame:
    """``(_hash, _salts)`` of the keys whose count is at least ``total / denominator``
    (at most ``denominator`` rows, since their counts sum to at most ``total``)."""
    hot = agg.where(F.col(count_col) * F.lit(denominator) >= total)
    salts = F.ceil(F.col(count_col) * F.lit(target_tasks) / total).cast("int")
    return hot.groupBy(F.xxhash64(*keys).alias("_hash")).agg(F.max(salts).alias("_salts"))


def salted_join(big: DataFrame, agg: DataFrame, keys: list[str], count_col: str, total: Column,
                spread_col: str, how: str = "inner", denominator: int = HOT_DENOMINATOR,
                target_tasks: int = TARGET_TASKS) -> DataFrame:
    """``big.join(agg, keys, how)`` with every hot key spread over its share of tasks.

    ``total`` is the sum of ``count_col`` over ``agg`` (a scalar column);
    ``spread_col`` is a column of ``big`` that varies within a hot key (the document
    id).  The broadcast list of hot keys is bounded by ``denominator`` rows."""
    hot = F.broadcast(hot_keys(agg, keys, count_col, total, denominator, target_tasks))
    salts = F.coalesce("_salts", F.lit(1))
    b = big.withColumn("_hash", F.xxhash64(*keys)).join(hot, "_hash", "left").withColumn(
        "_salt", F.when(F.col("_salts") > 1, F.pmod(F.xxhash64(spread_col), "_salts").cast("int")).otherwise(F.lit(0)))
    a = agg.withColumn("_hash", F.xxhash64(*keys)).join(hot, "_hash", "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    return b.drop("_hash", "_salts").join(a.drop("_hash", "_salts"), keys + ["_salt"], how).drop("_salt")
