"""Merging extraction results back into a document table.

Parquet tables have no ``MERGE``, so a merge is a join written to a new location
(never over the path being read).  A match flag, not ``coalesce``, decides which value
wins: an update that carries a null keyword list writes null.

A target row takes one update.  Where updates may repeat an id, name the column that orders
them (``order_col``): the last one counts (ties: the greatest values).  Without an order,
a repeated id is an error when the merge runs.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODES = ("update", "upsert")


def _fields(updates: DataFrame, id_col: str, fields: Iterable[str] | None) -> list[str]:
    return list(fields) if fields else [c for c in updates.columns if c != id_col]


def check_mode(mode: str) -> str:
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}; expected one of {MODES}")
    return mode


def one_per_id(updates: DataFrame, id_col: str = "doc_id", order_col: str | None = None) -> DataFrame:
    """One row per id, reduced before the shuffle: the last by ``order_col``; without an
    order an id that repeats raises."""
    rest = [c for c in updates.columns if c not in (id_col, order_col)]
    row = F.struct(*([order_col] if order_col else []), *rest)
    one = updates.groupBy(id_col).agg(F.max(row).alias("_r"), F.count(F.lit(1)).alias("_n"))
    if order_col is None:
        text = F.concat(F.lit("more than one update for id "), F.coalesce(F.col(id_col).cast("string"), F.lit("null")))
        one = one.withColumn("_r", F.when(F.col("_n") > 1, F.raise_error(text)).otherwise(F.col("_r")))
    return one.select(*[F.col(id_col) if c == id_col else F.col(f"_r.{c}").alias(c) for c in updates.columns])


def _merge(target: DataFrame, updates: DataFrame, id_col: str, fields, how: str, order_col: str | None) -> DataFrame:
    fields = [f for f in _fields(updates, id_col, fields) if f != order_col]
    updates = one_per_id(updates.select(id_col, *fields, *([order_col] if order_col else [])), id_col, order_col)
    u = updates.select(F.col(id_col).alias("_uid"), *[F.col(f).alias(f"_u_{f}") for f in fields],
                       F.lit(True).alias("_m"))
    t = target.withColumn("_t", F.lit(True))
    j = t.join(u, t[id_col] == u["_uid"], how)
    matched = F.coalesce(F.col("_m"), F.lit(False))
    cols = []
    for c in target.columns:
        if c == id_col:
            cols.append(F.coalesce(F.col(id_col), F.col("_uid")).alias(id_col))
        elif c in fields:
            cols.append(F.when(matched, F.col(f"_u_{c}")).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    cols += [F.when(matched, F.col(f"_u_{f}")).alias(f) for f in fields if f not in target.columns]
    status = (F.when(F.col("_t").isNull(), "inserted").when(matched, "updated").otherwise("unchanged"))
    return j.select(*cols, status.alias("_status"))


def apply_updates(target: DataFrame, updates: DataFrame, id_col: str = "doc_id",
                  fields: Iterable[str] | None = None, with_status: bool = False,
                  order_col: str | None = None) -> DataFrame:
    """Partial update; matched rows get the named fields replaced, other fields
    and unmatched rows stay as they are, no row is inserted."""
    out = _merge(target, updates, id_col, fields, "left", order_col)
    return out if with_status else out.drop("_status")


def upsert_updates(target: DataFrame, updates: DataFrame, id_col: str = "doc_id",
                   fields: Iterable[str] | None = None, with_status: bool = False,
                   order_col: str | None = None) -> DataFrame:
    """As U1, and updates with no target become new rows."""
    out = _merge(target, updates, id_col, fields, "full_outer", order_col)
    return out if with_status else out.drop("_status")


def rejected_updates(target: DataFrame, updates: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Updates whose id is not in the target."""
    return updates.join(target.select(id_col), id_col, "left_anti")


def merge(target: DataFrame, updates: DataFrame, mode: str = "update", id_col: str = "doc_id",
          fields: Iterable[str] | None = None, with_status: bool = False, order_col: str | None = None) -> DataFrame:
    """U4: choose the sink behaviour by name; an unknown mode is an error."""
    chosen = upsert_updates if check_mode(mode) == "upsert" else apply_updates
    return chosen(target, updates, id_col, fields, with_status, order_col)


def merge_modes(target: DataFrame, updates: DataFrame, id_col: str = "doc_id", fields: Iterable[str] | None = None,
                order_col: str | None = None) -> DataFrame:
    """The merged table of every mode, told apart by ``mode``, from one join of the updates."""
    merged = _merge(target, updates, id_col, fields, "full_outer", order_col)
    modes = F.when(F.col("_status") == "inserted", F.array(F.lit("upsert"))).otherwise(F.array(*map(F.lit, MODES)))
    return merged.select("*", F.explode(modes).alias("mode")).drop("_status")


def update_counts(target: DataFrame, updates: DataFrame, id_col: str = "doc_id", mode: str = "update",
                  fields: Iterable[str] | None = None, order_col: str | None = None) -> DataFrame:
    """Rows per status (updated / unchanged / inserted / rejected), from one join: what an
    upsert inserts, an update rejects."""
    check_mode(mode)
    merged = _merge(target, updates, id_col, fields, "full_outer", order_col)
    status = F.col("_status")
    if mode == "update":
        status = F.when(status == "inserted", "rejected").otherwise(status)
    counts = merged.groupBy(status.alias("status")).agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    if mode == "update":  # told even if there is none
        none = target.sparkSession.range(1).select(F.lit("rejected").alias("status"), F.lit(0).cast("bigint").alias("n"))
        counts = counts.unionByName(none).groupBy("status").agg(F.sum("n").alias("n"))
    return counts


def write_merged(target: DataFrame, updates: DataFrame, path: str, mode: str = "update",
                 id_col: str = "doc_id", fields: Iterable[str] | None = None, fmt: str = "parquet",
                 counts: bool = False, order_col: str | None = None):
    """Write the merged table to ``path`` (a new location).  With ``counts=True`` the
    per-status counts are observed during the same write (no second pass)."""
    merged = merge(target, updates, mode, id_col, fields, True, order_col)
    from pyspark.sql import Observation
    obs = Observation("merge_counts")
    merged = merged.observe(obs, *[F.sum(F.when(F.col("_status") == s, 1).otherwise(0)).alias(s)
                                   for s in ("updated", "unchanged", "inserted")])
    merged.drop("_status").write.mode("errorifexists").format(fmt).save(path)
    return obs.get if counts else None
