"""U1, U2 without rewriting the table: a bucketed base and small delta files, merged on read.

Layout under one folder:

* ``base/_gen=<g>``: the table, bucketed and sorted by id, one file per bucket;
* ``deltas/_gen=<g>/_mode=<mode>/_seq=<n>``: the updates of one call, with the names of the fields they set;
* ``meta/_gen=<g>``: id column and number of buckets, written last, so a generation counts once complete.

An update writes its own rows only.  Reading joins the base with the last value of every updated
field; the base is read bucket by bucket and is not exchanged, the deltas are.  ``compact``
writes the merged table as the next generation.

Deltas take effect in their order: an update for an id that is neither in the base nor was upserted
before is rejected, also if the id is upserted later.  Values written as null are null.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from .updates import check_mode, one_per_id

_SEQ = re.compile(r"/_mode=(\w+)/_seq=(\d+)/")


class DeltaTable:
    """A table under ``path``; open an existing one, or ``create`` it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        meta = spark.read.parquet(f"{path}/meta").orderBy(F.desc("_gen")).limit(1).collect()[0]
        self.gen, self.id_col, self.buckets = int(meta["_gen"]), meta["id_col"], int(meta["buckets"])

    @classmethod
    def create(cls, df: DataFrame, path: str, id_col: str = "doc_id", buckets: int = 200) -> "DeltaTable":
        """Write ``df`` as the first generation.  ``buckets`` is the number of tasks of a later read, not
        less than the shuffle partitions, or Spark deals the base anew; ids must be unique (a
        repeated one raises)."""
        _write_generation(df, path, 0, id_col, buckets)
        return cls(df.sparkSession, path)

    def _base(self) -> DataFrame:
        return open_bucketed(self.spark, f"{self.path}/base/_gen={self.gen}", self.id_col, self.buckets)

    def _deltas(self) -> tuple[DataFrame | None, list[tuple[str, int]]]:
        root = f"{self.path}/deltas/_gen={self.gen}"
        try:
            df = self.spark.read.option("mergeSchema", "true").option("basePath", root).parquet(root)
        except AnalysisException:  # none written yet
            return None, []
        return df, sorted({(m[1], int(m[2])) for f in df.inputFiles() if (m := _SEQ.search(f))})

    def update(self, updates: DataFrame, mode: str = "update", fields: Iterable[str] | None = None,
               order_col: str | None = None) -> int:
        """Add one delta: U1 (``update``) or U2 (``upsert``); returns its place in the order."""
        check_mode(mode)
        _, seen = self._deltas()
        fields = [f for f in (fields or updates.columns) if f not in (self.id_col, order_col)]
        seq = max((s for _, s in seen), default=-1) + 1
        rows = one_per_id(updates.select(self.id_col, *fields, *([order_col] if order_col else [])), self.id_col, order_col)
        rows.select(self.id_col, *fields, F.array(*map(F.lit, fields)).alias("_sets")).write.mode("errorifexists").parquet(
            f"{self.path}/deltas/_gen={self.gen}/_mode={mode}/_seq={seq}")
        return seq

    def read(self) -> DataFrame:
        """The merged table."""
        base, (deltas, seen) = self._base(), self._deltas()
        if deltas is None:
            return base
        idc = self.id_col
        fields = [c for c in deltas.columns if c not in (idc, "_sets", "_mode", "_seq")]
        aggs = [F.min(F.when(F.col("_mode") == "upsert", F.col("_seq"))).alias("_since")]
        for f in fields:
            at = F.when(F.array_contains("_sets", f), F.col("_seq"))
            aggs += [F.max_by(F.col(f"`{f}`"), at).alias(f"_u_{f}"), F.max(at).alias(f"_at_{f}")]
        last = deltas.groupBy(F.col(idc).alias("_uid")).agg(*aggs)
        # without an upsert nothing can be new
        new_rows = any(mode == "upsert" for mode, _ in seen)
        joined = base.withColumn("_held", F.lit(True)).join(last, F.col(idc) == F.col("_uid"), "full_outer" if new_rows else "left")
        known = F.coalesce(F.col("_held"), F.lit(False))
        joined = joined.where(known | F.col("_since").isNotNull())
        out = []
        for c in base.columns + [f for f in fields if f not in base.columns]:
            old = F.col(f"`{c}`") if c in base.columns else F.lit(None)
            if c == idc:
                out.append(F.coalesce(old, F.col("_uid")).alias(idc))
            elif c in fields:
                counts = F.col(f"_at_{c}").isNotNull() & (known | (F.col(f"_at_{c}") >= F.col("_since")))
                out.append(F.when(counts, F.col(f"_u_{c}")).otherwise(old).alias(c))
            else:
                out.append(old.alias(c))
        return joined.select(*out)

    def compact(self) -> "DeltaTable":
        """The merged table as the next generation, without deltas."""
        _write_generation(self.read(), self.path, self.gen + 1, self.id_col, self.buckets)
        return DeltaTable(self.spark, self.path)


def _write_generation(df: DataFrame, path: str, gen: int, id_col: str, buckets: int) -> None:
    write_bucketed(one_per_id(df, id_col), f"{path}/base/_gen={gen}", id_col, buckets)
    df.sparkSession.range(1).select(F.lit(id_col).alias("id_col"), F.lit(buckets).alias("buckets")).coalesce(1).write.mode(
        "overwrite").parquet(f"{path}/meta/_gen={gen}")


# --- bucketed files -------------------------------------------------------------------------

def _table(folder: str) -> str:
    return f"termlens_{hashlib.sha256(folder.encode()).hexdigest()[:24]}"


def write_bucketed(df: DataFrame, folder: str, id_col: str, buckets: int) -> None:
    """``df`` as a parquet folder bucketed and sorted by id, one file per bucket."""
    df.repartition(buckets, id_col).write.mode("overwrite").bucketBy(buckets, id_col).sortBy(id_col).format("parquet").option(
        "path", folder).saveAsTable(_table(folder))


def open_bucketed(spark: SparkSession, folder: str, id_col: str, buckets: int) -> DataFrame:
    """A bucketed folder, also one that another session wrote: joins and groupings by id take it as
    it lies."""
    if not spark.catalog.tableExists(_table(folder)):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(folder).schema.fields)
        spark.sql(f"CREATE TABLE {_table(folder)} ({columns}) USING parquet CLUSTERED BY (`{id_col}`) "
                  f"SORTED BY (`{id_col}`) INTO {buckets} BUCKETS LOCATION '{folder}'")
    return spark.table(_table(folder))
