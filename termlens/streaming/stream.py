"""stream_extract: the batched read -> extract -> write loop as Structured Streaming.

* Source: a file stream (parquet by default) with ``maxFilesPerTrigger``.
* Background: computed once over the whole collection and *stored* (parquet in the
  shared checkpoint folder); micro-batches read the stored table instead of recounting the
  collection.
  The stored table is first cut down to the batch's terms, and terms it has never seen count
  with the batch.
* Each micro-batch runs the batch plan (``extract``) and writes its rows to
  ``<output>/_source=<id>/_epoch=<id>`` with overwrite.  Output and checkpoint belong to one
  source (``<output>/_checkpoint/<source id>`` unless another is named): a restart goes on
  with the next epoch, a replayed epoch replaces its own rows only, and several sources
  may feed one output.
* ``read_results`` keeps the latest row per document (upsert semantics) with one
  ``max_by`` aggregate on the document id.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import stats as ST
from ..plans import extract as E
from ..session import ensure_checkpoint_dir


def store_background(docs: DataFrame, cfg: E.ExtractConfig, path: str) -> str:
    """Write ``(term, bg_count)`` and the collection size to ``path`` (two folders)."""
    ST.background(docs, cfg.keyword_col, cfg.id_col, cfg.term_analyzer).write.mode("overwrite").parquet(f"{path}/bg")
    ST.corpus_size_df(docs, cfg.keyword_col).write.mode("overwrite").parquet(f"{path}/n")
    return path


def load_background(spark: SparkSession, path: str):
    bg = spark.read.parquet(f"{path}/bg")
    n = spark.read.parquet(f"{path}/n").select(F.max("n_docs")).scalar()
    return bg, n


def start_stream(spark: SparkSession, source_dir: str, schema, background_path: str, output_path: str,
                 cfg: E.ExtractConfig | None = None, checkpoint_path: str | None = None,
                 max_files_per_trigger: int = 1, fmt: str = "parquet", glob: str | None = None,
                 available_now: bool = True) -> StreamingQuery:
    """Start the streaming extraction; returns the running query."""
    cfg = cfg or E.ExtractConfig()
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    stream = reader.format(fmt).load(source_dir)

    source = hashlib.sha256(f"{source_dir}|{glob}".encode()).hexdigest()[:16]

    def run_batch(batch: DataFrame, epoch_id: int) -> None:
        bg, n = load_background(batch.sparkSession, background_path)
        res = E.extract(batch, cfg, background=bg, n_docs=n)
        out = res.withColumn("_written", F.current_timestamp())
        out.write.mode("overwrite").parquet(f"{output_path}/_source={source}/_epoch={epoch_id}")

    ckpt = checkpoint_path or f"{output_path}/_checkpoint/{source}"
    writer = stream.writeStream.foreachBatch(run_batch).option("checkpointLocation", ckpt)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def read_results(spark: SparkSession, output_path: str, cfg: E.ExtractConfig | None = None) -> DataFrame:
    """The result table: the row written last for every document."""
    cfg = cfg or E.ExtractConfig()
    out = spark.read.parquet(output_path)
    cols = [c for c in out.columns if c not in (cfg.id_col, "_source", "_epoch", "_written")]
    latest = out.groupBy(cfg.id_col).agg(F.max_by(F.struct(*cols), F.struct("_written", "_epoch")).alias("_r"))
    return latest.select(cfg.id_col, *[F.col(f"_r.{c}").alias(c) for c in cols])


def stream_extract(spark: SparkSession, source_dir: str, glob: str | None, background_docs: DataFrame,
                   cfg: E.ExtractConfig | None = None, work_dir: str | None = None,
                   max_files_per_trigger: int = 1) -> DataFrame:
    """Store the background, run the stream until the source is
    drained, and return the result table.  ``work_dir`` keeps background, output and
    checkpoint together: calling again with the same folder resumes it.  It defaults to a new
    folder in the shared checkpoint location."""
    cfg = cfg or E.ExtractConfig()
    work = work_dir or f"{ensure_checkpoint_dir(spark)}/termlens-stream-{uuid.uuid4().hex}"
    store_background(background_docs, cfg, f"{work}/background")
    schema = background_docs.schema
    q = start_stream(spark, source_dir, schema, f"{work}/background", f"{work}/output", cfg,
                     max_files_per_trigger=max_files_per_trigger, glob=glob)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return read_results(spark, f"{work}/output", cfg)
