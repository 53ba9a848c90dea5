"""Command line: extract keyterms from a document table and merge them back.

    python -m termlens INPUT KEYWORD_FIELD HIGHLIGHT_FIELD --output OUT [options]

INPUT is a parquet path (or ``--format``); the result is merged into the input rows
(``--mode update``) or upserted (``--mode upsert``) and written to OUT, a new location.
Flags are real switches (``--use-termvectors``), not strings parsed as booleans.
"""

from __future__ import annotations

import argparse
import json

from .operators.tokens import ANALYZERS
from .plans.extract import ExtractConfig, extract
from .session import build_session
from .sinks.updates import write_merged
from .sources.documents import read_documents


def parse(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="termlens", description=__doc__.splitlines()[0])
    p.add_argument("input")
    p.add_argument("keyword_field")
    p.add_argument("highlight_field")
    p.add_argument("--output", required=True)
    p.add_argument("--format", default="parquet")
    p.add_argument("--id-field", default="doc_id")
    p.add_argument("--body-field", default=None, help="VARIANT column that holds fields without a schema")
    p.add_argument("--mode", choices=("update", "upsert", "results"), default="update",
                   help="merge into the input rows, upsert, or write the result rows only")
    p.add_argument("--keywords-field-name", default="keywords")
    p.add_argument("--offsets-field-name", default="offsets")
    p.add_argument("--contexts-field-name", default="contexts")
    p.add_argument("--must-have-fields", nargs="*", default=[])
    p.add_argument("--must-not-have-fields", nargs="*", default=[])
    p.add_argument("--use-termvectors", action="store_true")
    p.add_argument("--termvectors-window-size", type=int, default=3)
    p.add_argument("--context-order", choices=("position", "vocabulary"), default="position")
    p.add_argument("--extract-contexts", action="store_true")
    p.add_argument("--max-doc-keyterms", type=int, default=16)
    p.add_argument("--min-bg-count", type=int, default=1)
    p.add_argument("--stopwords", default="en", help="'en' or 'none'")
    p.add_argument("--rule", choices=("rarest", "tfidf"), default="rarest")
    p.add_argument("--analyzer", choices=ANALYZERS, default=None, help="default: lower, or english with --use-termvectors")
    p.add_argument("--filter-before-topk", action="store_true")
    p.add_argument("--shard-size", type=int, default=100,
                   help="cap on a sampled foreground; no effect here, where a document is its own foreground")
    p.add_argument("--scan-partitions", type=int, default=None, help="deal the input into this many partitions")
    p.add_argument("--max-fragments", type=int, default=8)
    p.add_argument("--fragment-size", type=int, default=100)
    p.add_argument("--master", default=None, help="only for local runs; on a cluster use spark-submit")
    return p.parse_args(argv)


def config(a: argparse.Namespace) -> ExtractConfig:
    return ExtractConfig(
        keyword_col=a.keyword_field, highlight_col=a.highlight_field, id_col=a.id_field, body_col=a.body_field,
        use_termvectors=a.use_termvectors, max_doc_keyterms=a.max_doc_keyterms, min_bg_count=a.min_bg_count,
        keyword_stopwords=None if a.stopwords == "none" else a.stopwords,
        must_have_fields=tuple(a.must_have_fields), must_not_have_fields=tuple(a.must_not_have_fields),
        extract_contexts=a.extract_contexts, max_fragments=a.max_fragments, fragment_size=a.fragment_size,
        termvectors_window_size=a.termvectors_window_size, context_order=a.context_order, rule=a.rule,
        analyzer=a.analyzer, filter_before_topk=a.filter_before_topk, shard_size=a.shard_size, keywords_field=a.keywords_field_name, offsets_field=a.offsets_field_name,
        contexts_field=a.contexts_field_name)


def main(argv=None) -> dict:
    a = parse(argv)
    if a.master:
        spark = build_session(a.master)
    else:
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.appName("termlens").getOrCreate()
    cfg = config(a)
    docs = read_documents(spark, a.input, a.format, key=a.id_field, partitions=a.scan_partitions)
    res = extract(docs, cfg)
    if a.mode == "results":
        res.write.mode("errorifexists").parquet(a.output)
        counts = {}
    else:
        counts = write_merged(docs, res, a.output, a.mode, a.id_field, counts=True)
    print(json.dumps({"output": a.output, "mode": a.mode, **counts}))
    return counts


if __name__ == "__main__":
    main()
