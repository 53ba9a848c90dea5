"""The bucketed table with delta files: equal to the plain merges, small writes, no exchange of the base."""

import os

import pytest
from pyspark.sql import functions as F

from termlens.sinks import updates as U
from termlens.sinks.deltas import DeltaTable, _table


def rows(df):
    return sorted(map(str, df.collect()))


def size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def test_small_update_writes_little_and_moves_no_base_row(spark, tmp_path):
    base = spark.range(60_000).select(F.col("id").alias("doc_id"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    updates = base.where("doc_id % 1000 = 7").select("doc_id", F.array(F.lit("k"), F.lit(None)).alias("keywords"))
    table = DeltaTable.create(base, str(tmp_path / "t"), buckets=4)
    table.update(updates)
    assert size(tmp_path / "t/deltas") < size(tmp_path / "t/base") / 250
    got = table.read()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = table.read()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    base_side = plan[:plan.index("Bucketed: true")]
    assert plan.count("Exchange hashpartitioning") == 1 and "Exchange" not in base_side.split("FileScan")[0].split("SortMergeJoin")[-1]
    assert rows(got) == rows(U.apply_updates(base, updates))


def test_deltas_take_effect_in_order(spark, tmp_path):
    base = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, None, "z")], "doc_id long, k string, other string")
    table = DeltaTable.create(base, str(tmp_path / "t"), buckets=2)
    steps = [
        ("update", [(1, "a1"), (9, "lost")], "doc_id long, k string"),
        ("update", [(2, None)], "doc_id long, k string"),
        ("upsert", [(9, 5), (1, 6)], "doc_id long, n int"),
        ("update", [(9, "kept"), (8, "lost")], "doc_id long, k string"),
        ("upsert", [(7, None)], "doc_id long, other string"),
    ]
    want = base
    for mode, data, schema in steps:
        updates = spark.createDataFrame(data, schema)
        table.update(updates, mode)
        want = U.merge(want, updates, mode)
    # an id rejected first and upserted later starts without the rejected value
    assert rows(table.read().select(sorted(want.columns))) == rows(want.select(sorted(want.columns)))
    compacted = table.compact()
    assert compacted.gen == 1 and rows(compacted.read().select(sorted(want.columns))) == rows(want.select(sorted(want.columns)))
    spark.sql(f"DROP TABLE {_table(str(tmp_path / 't/base/_gen=1'))}")
    again = DeltaTable(spark, str(tmp_path / "t"))  # as another session opens it
    assert rows(again.read().select(sorted(want.columns))) == rows(want.select(sorted(want.columns)))


def test_bad_calls(spark, tmp_path):
    base = spark.createDataFrame([(1, "a")], "doc_id long, k string")
    table = DeltaTable.create(base, str(tmp_path / "t"), buckets=1)
    with pytest.raises(ValueError):
        table.update(base, "replace")
    with pytest.raises(Exception, match="more than one update"):
        table.update(base.union(base))
    with pytest.raises(Exception, match="more than one update"):
        DeltaTable.create(base.union(base), str(tmp_path / "u"), buckets=1)
