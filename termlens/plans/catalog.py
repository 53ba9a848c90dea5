"""Registered queries: one per operator of the inventory, each ``(spark, sf_dir) ->
DataFrame`` over the given tables, with nested results flattened to scalar columns so
that they can be compared with the SQL in ``oracle.py``.

Shared settings: keyterms from ``documents.text`` (all rows are the background), 16 per
document, the English stop-word list, minimum background count 1, raw fragments of 100
characters (at most 8), word windows of 3.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import stopwords as SW
from ..functions import text as X
from ..operators import audit as AU
from ..operators import contexts as CX
from ..operators import hits as H
from ..operators import select as SEL
from ..operators import stats as ST
from ..operators import tokens as TK
from ..session import ensure_checkpoint_dir
from ..sinks import deltas as DT
from ..sinks import updates as U
from ..sources import documents as SRC
from . import extract as E

# --- fixed values: parameters of the registered queries ------------------------------
K = 16
FRAGMENT_SIZE = 100
MAX_FRAGMENTS = 8
WINDOW = 3
GROUP_MIN_DOCS = 2
GROUP_TOP = 10
SAMPLE_SIZE = 5
SAMPLE_SHARDS = 3
RANDOM_SEED = 7
SENTENCES_PER_DOC = 3
MIN_BG_FILTER = 5
NULL_RESULT_MIN_BG = 2
SHINGLE = 6
GROUP_SHARD = 20
UNKNOWN_ID_BASE = 1_000_000_000
STREAM_FILES = 3
STUB_CHARS = 200
# ---------------------------------------------------------------------------------------

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


_KEYS = {"documents": "doc_id", "pages": "page_id", "conversations": "conv_id"}


#: The caller's choice of scan partitions (see ``read_documents``); unset: the source's splits.
SCAN_PARTITIONS = "spark.termlens.scanPartitions"


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    if name in _KEYS:
        n = spark.conf.get(SCAN_PARTITIONS, None)
        return SRC.read_documents(spark, f"{sf}/{name}.parquet", key=_KEYS[name], partitions=int(n) if n else None)
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _docs(spark, sf):
    return _t(spark, sf, "documents")


RAW = E.ExtractConfig(max_doc_keyterms=K, keyword_stopwords="en", fragment_size=FRAGMENT_SIZE,
                      max_fragments=MAX_FRAGMENTS)
RAW_CTX = RAW.with_(extract_contexts=True)
LIGHT = RAW.with_(use_termvectors=True, analyzer="light", extract_contexts=True,
                  termvectors_window_size=WINDOW)
PORTER = LIGHT.with_(analyzer="english")


# --- T: tokens ---------------------------------------------------------------------------

@query("tokens_with_offsets")
def tokens_with_offsets(spark, sf):
    return TK.tokenize(_docs(spark, sf), analyzer="none").select("doc_id", "position", "surface", "start", "end")


@query("tokens_lowercase")
def tokens_lowercase(spark, sf):
    return TK.tokenize(_docs(spark, sf), analyzer="lower").select("doc_id", "position", "term")


@query("tokens_stemmed_light")
def tokens_stemmed_light(spark, sf):
    return TK.tokenize(_docs(spark, sf), analyzer="light").select("doc_id", "position", "term")


@query("tokens_stemmed_porter")
def tokens_stemmed_porter(spark, sf):
    return TK.tokenize(_docs(spark, sf), analyzer="english").select("doc_id", "position", "term")


@query("analyzed_tokens")
def analyzed_tokens(spark, sf):
    return TK.tokenize(_docs(spark, sf), analyzer="light").select("doc_id", "position", "surface", "term", "start", "end")


@query("tokens_standard")
def tokens_standard(spark, sf):
    """Words by the default word boundaries of Unicode, with offsets."""
    return TK.tokenize(_docs(spark, sf), analyzer="standard").select("doc_id", "position", "surface", "term", "start", "end")


@query("term_vectors")
def term_vectors(spark, sf):
    tv = TK.term_vectors(TK.tokenize(_docs(spark, sf), analyzer="lower", gathered=True))
    return tv.select("doc_id", "term", F.posexplode("occurrences").alias("occ", "o")).select(
        "doc_id", "term", F.col("occ").cast("bigint").alias("occ"),
        F.col("o.position").alias("position"), F.col("o.start").alias("start"), F.col("o.end").alias("end"))


@query("tokens_in_order")
def tokens_in_order(spark, sf):
    tv = TK.term_vectors(TK.tokenize(_docs(spark, sf), analyzer="lower", gathered=True), gathered=True)
    return TK.tokens_in_order(tv).select("doc_id", F.array_join("terms", " ").alias("terms"))


@query("expand_tokens_punct")
def expand_tokens_punct(spark, sf):
    d = _docs(spark, sf).where(F.col("text").isNotNull())
    words = F.regexp_extract_all("text", F.lit(r"\S+"), 0)
    return d.select("doc_id", F.explode(X.expand_punct(words)).alias("token"))


# --- A: statistics and keyterms ------------------------------------------------------------

@query("background_df")
def background_df(spark, sf):
    return ST.background(_docs(spark, sf))


@query("corpus_size")
def corpus_size(spark, sf):
    return ST.corpus_size_df(_docs(spark, sf))


@query("foreground_df")
def foreground_df(spark, sf):
    return ST.foreground(_docs(spark, sf), "source", min_doc_count=GROUP_MIN_DOCS)


@query("keyterms_per_doc")
def keyterms_per_doc(spark, sf):
    return E.keyterms(_docs(spark, sf), RAW).select("doc_id", "term", "bg_count", "rank")


@query("keyterms_tfidf")
def keyterms_tfidf(spark, sf):
    d = _docs(spark, sf)
    kt = SEL.keyterms(d, k=K, rule="tfidf", stopwords=SW.ENGLISH)
    return kt.select("doc_id", "term", "tf", "bg_count", F.round("score", 6).alias("score"), "rank")


@query("significant_terms_by_group")
def significant_terms_by_group(spark, sf):
    d = _docs(spark, sf)
    return ST.significant_terms(d, "source", min_doc_count=GROUP_MIN_DOCS, size=GROUP_TOP, heuristic="lift") \
        .select("source", "term", "fg_count", "bg_count", F.round("score", 6).alias("score"), "rank")


@query("significant_terms_llr")
def significant_terms_llr(spark, sf):
    d = _docs(spark, sf)
    return ST.significant_terms(d, "source", min_doc_count=GROUP_MIN_DOCS, size=GROUP_TOP, heuristic="llr") \
        .select("source", "term", "fg_count", "bg_count", F.round("score", 6).alias("score"), "rank")


@query("significant_terms_sampled")
def significant_terms_sampled(spark, sf):
    """Group significance as the original request composes it: sampler (A5), duplicate
    passages removed (A6), then lift against the whole collection."""
    d = _docs(spark, sf)
    return ST.significant_terms(d, "source", min_doc_count=GROUP_MIN_DOCS, size=GROUP_TOP, heuristic="lift",
                                shard_size=GROUP_SHARD, sample_score=F.col("n_chars"),
                                filter_duplicate_text=True, shingle=SHINGLE) \
        .select("source", "term", "fg_count", "bg_count", F.round("score", 6).alias("score"), "rank")


@query("sampled_foreground")
def sampled_foreground(spark, sf):
    d = _docs(spark, sf).where(F.col("text").isNotNull())
    return ST.sampled_foreground(d, "source", F.col("n_chars"), SAMPLE_SIZE).select("source", "doc_id")


@query("sampled_foreground_hits")
def sampled_foreground_hits(spark, sf):
    """The sampler as the request means it: per shard of each group, the documents with most hits."""
    d = _docs(spark, sf).where(F.col("text").isNotNull())
    scored = ST.hit_counts(d, _hits(spark, sf))
    return ST.sampled_foreground(scored, "source", F.col("hits"), SAMPLE_SIZE, shards=SAMPLE_SHARDS).select(
        "source", "doc_id", "hits")


@query("drop_duplicate_passages")
def drop_duplicate_passages(spark, sf):
    d = _docs(spark, sf)
    return ST.drop_duplicate_passages(ST.grouped_tokens(d, "lang"), "lang", SHINGLE).select("doc_id", "position", "term")


@query("stopword_filter")
def stopword_filter(spark, sf):
    return SEL.stopword_filter(TK.doc_terms(_docs(spark, sf)), SW.ENGLISH)


@query("min_bg_filter")
def min_bg_filter(spark, sf):
    return SEL.min_bg_filter(ST.background(_docs(spark, sf)), MIN_BG_FILTER)


# --- H: hits, offsets, marks ---------------------------------------------------------------

def _hits(spark, sf, cfg=RAW):
    d = _docs(spark, sf)
    kts = H.keyterm_sets(E.keyterms(d, cfg))
    base = E.eligible(d, cfg).select("doc_id", "text").join(kts, "doc_id")
    return H.keyterm_hits(base, "text", "doc_id", cfg.term_analyzer, "kt")


@query("keyterm_occurrences")
def keyterm_occurrences(spark, sf):
    return _hits(spark, sf).select("doc_id", "term", "position", "start", "end")


@query("keyterm_hits")
def keyterm_hits(spark, sf):
    return _hits(spark, sf).select("doc_id", "position", "surface", "term", "start", "end")


def _offset_rows(hits, key):
    """One row per offset of the nested lists."""
    return H.offsets_by(hits, key).select(
        "doc_id", key, "first_start", F.posexplode("offsets").alias("occ", "o")).select(
        "doc_id", key, "first_start", F.col("occ").cast("bigint").alias("occ"),
        F.col("o.start").alias("start"), F.col("o.end").alias("end"))


@query("offsets_by_surface")
def offsets_by_surface(spark, sf):
    return _offset_rows(_hits(spark, sf), "surface")


@query("offsets_by_term")
def offsets_by_term(spark, sf):
    return _offset_rows(_hits(spark, sf), "term")


def _marked(spark, sf):
    d = _docs(spark, sf)
    arr = H.hit_arrays(_hits(spark, sf))
    return d.select("doc_id", "text").join(arr, "doc_id")


@query("highlighted_text")
def highlighted_text(spark, sf):
    return _marked(spark, sf).select("doc_id", H.highlighted_text(F.col("text"), F.col("hits")).alias("marked"))


@query("marked_terms")
def marked_terms(spark, sf):
    m = _marked(spark, sf).select("doc_id", H.highlighted_text(F.col("text"), F.col("hits")).alias("marked"))
    return m.select("doc_id", F.posexplode(X.marked_terms("marked")).alias("i", "term")) \
        .withColumn("i", F.col("i").cast("bigint"))


@query("unmarked_text")
def unmarked_text(spark, sf):
    m = _marked(spark, sf).select("doc_id", H.highlighted_text(F.col("text"), F.col("hits")).alias("marked"))
    return m.select("doc_id", X.unmark("marked").alias("text"))


def _offset_strings(spark, sf):
    m = _marked(spark, sf)
    ranges = F.array_join(F.transform("hits", lambda h: F.concat_ws("-", h["start"].cast("string"), h["end"].cast("string"))), ",")
    return m.select("doc_id", "text", "hits",
                    F.concat_ws(":", F.lit("0"), ranges, F.length("text").cast("string")).alias("offset_string"))


@query("parse_offset_strings")
def parse_offset_strings(spark, sf):
    o = _offset_strings(spark, sf)
    return o.select("doc_id", F.posexplode(X.parse_offsets("offset_string")).alias("i", "r")).select(
        "doc_id", F.col("i").cast("bigint").alias("i"), F.col("r.start").alias("start"), F.col("r.end").alias("end"))


@query("zip_terms_offsets")
def zip_terms_offsets(spark, sf):
    o = _offset_strings(spark, sf)
    z = F.arrays_zip(X.marked_terms(H.highlighted_text(F.col("text"), F.col("hits"))).alias("t"),
                     X.parse_offsets("offset_string").alias("r"))
    return o.select("doc_id", F.posexplode(z).alias("i", "z")).select(
        "doc_id", F.col("i").cast("bigint").alias("i"), F.col("z.t").alias("term"),
        F.col("z.r.start").alias("start"), F.col("z.r.end").alias("end"))


# --- K, W: fragments and windows ------------------------------------------------------------

@query("first_fragments")
def first_fragments(spark, sf):
    per = E.per_document_hits(_docs(spark, sf), RAW).where(F.col("hits").isNotNull())
    fg = CX.fragment_groups(F.col("hits"), FRAGMENT_SIZE, MAX_FRAGMENTS)
    s = per.select("doc_id", "hits", fg.alias("fg"))
    return s.select("doc_id", F.size("fg.groups").cast("bigint").alias("n_fragments"),
                    F.size("hits").cast("bigint").alias("n_hits"),
                    F.size(F.filter("hits", lambda h: F.col("fg.cut").isNull() | (h["start"] < F.col("fg.cut"))))
                    .cast("bigint").alias("n_kept"))


@query("context_windows")
def context_windows(spark, sf):
    return CX.context_windows(_hits(spark, sf), WINDOW)


# --- E: end to end ----------------------------------------------------------------------------

@query("extract_raw")
def extract_raw(spark, sf):
    return E.flatten_result(E.extract(_docs(spark, sf), RAW_CTX), RAW_CTX)


@query("raw_contexts")
def raw_contexts(spark, sf):
    return E.flatten_contexts(E.extract(_docs(spark, sf), RAW_CTX), RAW_CTX)


@query("extract_analyzed")
def extract_analyzed(spark, sf):
    return E.flatten_result(E.extract(_docs(spark, sf), LIGHT), LIGHT)


@query("analyzed_contexts")
def analyzed_contexts(spark, sf):
    return E.flatten_contexts(E.extract(_docs(spark, sf), LIGHT), LIGHT)


@query("analyzed_contexts_vocab")
def analyzed_contexts_vocab(spark, sf):
    cfg = LIGHT.with_(context_order="vocabulary")
    return E.flatten_contexts(E.extract(_docs(spark, sf), cfg), cfg)


def _stored_vectors(spark, sf, cfg):
    folder = f"{ensure_checkpoint_dir(spark)}/termlens-vectors-{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    E.store_term_vectors(_docs(spark, sf), cfg, folder, buckets)
    return DT.open_bucketed(spark, folder, "doc_id", buckets)


@query("extract_stored_vectors")
def extract_stored_vectors(spark, sf):
    """Raw extraction from term vectors stored by id: each text is tokenised once, when stored."""
    return E.flatten_result(E.extract_stored(_stored_vectors(spark, sf, RAW), RAW), RAW)


@query("contexts_stored_vectors")
def contexts_stored_vectors(spark, sf):
    return E.flatten_contexts(E.extract_stored(_stored_vectors(spark, sf, LIGHT), LIGHT), LIGHT)


@query("extract_analyzed_porter")
def extract_analyzed_porter(spark, sf):
    return E.flatten_result(E.extract(_docs(spark, sf), PORTER), PORTER)


@query("docs_without_keyterms")
def docs_without_keyterms(spark, sf):
    cfg = RAW.with_(min_bg_count=NULL_RESULT_MIN_BG)
    return E.extract(_docs(spark, sf), cfg).where(F.col("keywords").isNull()).select("doc_id")


@query("cross_field_hits")
def cross_field_hits(spark, sf):
    pages = SRC.page_fields(_t(spark, sf, "pages"))
    cfg = RAW.with_(keyword_col="title", highlight_col="body", id_col="page_id")
    return E.flatten_result(E.extract(pages, cfg), cfg)


@query("cross_analyzer_hits")
def cross_analyzer_hits(spark, sf):
    """Keyterms parted by white space, located through another analyzer that cuts them into words."""
    cfg = RAW.with_(analyzer="whitespace", highlight_analyzer="lower")
    return E.flatten_result(E.extract(_docs(spark, sf), cfg), cfg)


@query("results_with_text")
def results_with_text(spark, sf):
    d = _docs(spark, sf)
    flat = E.flatten_result(E.extract(d, RAW), RAW).where(F.col("keyword").isNotNull())
    return flat.join(d.select("doc_id", "text", "lang", "n_chars"), "doc_id", "left").select(
        "doc_id", "keyword", "start", "end", "text", "lang", "n_chars")


def _labelled(spark, sf):
    return _docs(spark, sf).join(_t(spark, sf, "labels"), "doc_id", "left")


@query("incremental_extract")
def incremental_extract(spark, sf):
    # The previous run covered the labelled documents and stored its results; this run
    # fills in the rest.
    path = f"{ensure_checkpoint_dir(spark)}/termlens-previous-{uuid.uuid4().hex}"
    E.extract(_labelled(spark, sf), RAW.with_(must_have_fields=("quality",))).write.parquet(path)
    return E.flatten_result(E.incremental_extract(_docs(spark, sf), RAW, spark.read.parquet(path)), RAW)


@query("incremental_first_run")
def incremental_first_run(spark, sf):
    """No document has a keywords field yet, nor does the table: all are extracted for."""
    return E.flatten_result(E.incremental_extract(_docs(spark, sf), RAW), RAW)


def _json_docs(spark, sf):
    """The labelled documents as JSON objects in a VARIANT column; a null member is left out."""
    body = F.struct(F.struct("text").alias("content"), F.struct(
        "lang", F.struct("quality", "toxic").alias("audit"), F.array("source").alias("sources")).alias("meta"))
    return _labelled(spark, sf).select("doc_id", F.parse_json(F.to_json(body)).alias("doc"))


SCHEMALESS = RAW.with_(keyword_col="content.text", body_col="doc", must_have_fields=("meta.audit.quality", "meta.sources"),
                       must_not_have_fields=("keywords", "meta.audit.reviewed"))


@query("schemaless_eligible")
def schemaless_eligible(spark, sf):
    """Documents without a schema: dotted paths into a VARIANT column, fields nobody has."""
    d = _json_docs(spark, sf)
    return SRC.eligible_docs(d, ["content.text", "meta.audit.quality"], ["keywords", "meta.audit.reviewed"], "doc").select(
        "doc_id", SRC.field_text(d, "meta.lang", "doc").alias("lang"))


@query("schemaless_extract")
def schemaless_extract(spark, sf):
    return E.flatten_result(E.extract(_json_docs(spark, sf), SCHEMALESS), SCHEMALESS)


@query("extract_with_stored_background")
def extract_with_stored_background(spark, sf):
    """The background was stored when only the labelled documents were there; the terms that came
    with the others are unseen by it."""
    from ..streaming import stream as STR
    path = f"{ensure_checkpoint_dir(spark)}/termlens-background-{uuid.uuid4().hex}"
    known = _docs(spark, sf).join(_t(spark, sf, "labels").select("doc_id").distinct(), "doc_id", "left_semi")
    bg, n = STR.load_background(spark, STR.store_background(known, RAW, path))
    return E.flatten_result(E.extract(_docs(spark, sf), RAW, background=bg, n_docs=n), RAW)


# --- S, P: scans and predicates ---------------------------------------------------------------

@query("eligible_docs")
def eligible_docs(spark, sf):
    return SRC.eligible_docs(_labelled(spark, sf), ["text", "quality", "text"]).select(
        "doc_id", "lang", "source", "n_chars", "quality", "toxic")


@query("eligible_ids")
def eligible_ids(spark, sf):
    return SRC.eligible_ids(_docs(spark, sf), ["text"])


@query("must_have_fields")
def must_have_fields(spark, sf):
    return SRC.eligible_ids(_labelled(spark, sf), ["text", "quality"])


@query("must_not_have_fields")
def must_not_have_fields(spark, sf):
    return SRC.eligible_ids(_labelled(spark, sf), ["text"], ["quality"])


@query("random_order_docs")
def random_order_docs(spark, sf):
    return SRC.random_order(_docs(spark, sf), RANDOM_SEED).select("doc_id", "shuffle_key")


@query("docs_by_id")
def docs_by_id(spark, sf):
    ids = _t(spark, sf, "labels").where(F.col("toxic") == 1).select("doc_id")
    return SRC.docs_by_id(_docs(spark, sf), ids).select("doc_id", "n_chars")


@query("sentences_to_docs")
def sentences_to_docs(spark, sf):
    return SRC.sentences_to_docs(_t(spark, sf, "conversations"), SENTENCES_PER_DOC, "turn", "text",
                                 ["conv_id"], sep=" ")


# --- U: merges ---------------------------------------------------------------------------------

def _updates(spark, sf):
    """Updates keyed by id: labelled documents get their sorted keyterms joined by a
    space (toxic ones a null value, which must overwrite), and every benchmark item gives
    its own keyterms, against the benchmark, for an id that no document has."""
    d = _labelled(spark, sf)
    kt = E.keyterms(_docs(spark, sf), RAW).groupBy("doc_id").agg(
        F.array_join(F.sort_array(F.collect_list("term")), " ").alias("kw"))
    lab = (d.where(F.col("quality").isNotNull()).select("doc_id", "toxic").join(kt, "doc_id", "left")
           .select("doc_id", F.when(F.col("toxic") == 0, F.col("kw")).alias("keywords")))
    items = _t(spark, sf, "benchmark").select((F.col("item_id") + UNKNOWN_ID_BASE).alias("doc_id"), "text")
    bench = items.where(F.col("text").isNotNull()).select("doc_id").join(
        E.keyterms(items, RAW).groupBy("doc_id").agg(
            F.array_join(F.sort_array(F.collect_list("term")), " ").alias("keywords")), "doc_id", "left")
    return lab.unionByName(bench)


def _target(spark, sf):
    return _docs(spark, sf).select("doc_id", "lang", F.col("source").alias("keywords"))


@query("apply_updates")
def apply_updates(spark, sf):
    return U.apply_updates(_target(spark, sf), _updates(spark, sf), fields=["keywords"])


@query("upsert_updates")
def upsert_updates(spark, sf):
    return U.upsert_updates(_target(spark, sf), _updates(spark, sf), fields=["keywords"])


@query("rejected_updates")
def rejected_updates(spark, sf):
    return U.rejected_updates(_target(spark, sf), _updates(spark, sf))


@query("merge_by_mode")
def merge_by_mode(spark, sf):
    """U4: the same updates under either sink behaviour."""
    return U.merge_modes(_target(spark, sf), _updates(spark, sf), fields=["keywords"])


@query("update_counts")
def update_counts(spark, sf):
    return U.update_counts(_target(spark, sf), _updates(spark, sf), mode="update", fields=["keywords"])


def _delta_table(spark, sf):
    path = f"{ensure_checkpoint_dir(spark)}/termlens-deltas-{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return DT.DeltaTable.create(_target(spark, sf), path, "doc_id", buckets)


@query("delta_updates")
def delta_updates(spark, sf):
    """U1 as delta files beside a bucketed table, merged on read."""
    table = _delta_table(spark, sf)
    table.update(_updates(spark, sf), "update", ["keywords"])
    return table.read()


@query("delta_upserts")
def delta_upserts(spark, sf):
    """U2 in two deltas with the table compacted between them."""
    table = _delta_table(spark, sf)
    updates = _updates(spark, sf)
    table.update(updates.where(F.col("doc_id") < UNKNOWN_ID_BASE), "update", ["keywords"])
    table = table.compact()
    table.update(updates.where(F.col("doc_id") >= UNKNOWN_ID_BASE), "upsert", ["keywords"])
    return table.read()


# --- V: audits (invariants: zero violations, something checked) ---------------------------------

def _audit(df):
    return df.select("check", "violations", "checked")


@query("audit_offsets")
def audit_offsets(spark, sf):
    d = _docs(spark, sf)
    return _audit(AU.audit_offsets(E.extract(d, RAW_CTX), d))


@query("audit_keyterms")
def audit_keyterms(spark, sf):
    d = _docs(spark, sf)
    return _audit(AU.audit_keyterms(E.extract(d, RAW_CTX), d))


@query("audit_contexts")
def audit_contexts(spark, sf):
    return _audit(AU.audit_contexts(E.extract(_docs(spark, sf), RAW_CTX)))


@query("audit_keyterm_words")
def audit_keyterm_words(spark, sf):
    """V2 and V3 again, with words from a splitter that shares nothing with the tokeniser."""
    d = _docs(spark, sf)
    path = f"{ensure_checkpoint_dir(spark)}/termlens-audited-{uuid.uuid4().hex}"
    E.extract(d, RAW_CTX).write.parquet(path)
    res = spark.read.parquet(path)
    return _audit(AU.audit_keyterm_words(res, d)).unionByName(_audit(AU.audit_context_words(res)))


@query("audit_analyzed")
def audit_analyzed(spark, sf):
    d = _docs(spark, sf)
    return _audit(AU.audit_analyzed(E.extract(d, PORTER), d, analyzer="english"))


@query("audit_scope")
def audit_scope(spark, sf):
    d = _labelled(spark, sf)
    cfg = RAW.with_(must_have_fields=("quality",))
    return _audit(AU.audit_scope(E.extract(d, cfg), E.eligible(d, cfg)))


# --- streaming -----------------------------------------------------------------------------------

@query("stream_extract")
def stream_extract(spark, sf):
    from ..streaming import stream as STR
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    work = f"{ensure_checkpoint_dir(spark)}/termlens-stream-{uuid.uuid4().hex}"
    docs.repartition(STREAM_FILES, "doc_id").write.parquet(f"{work}/source")  # a micro-batch per file
    return E.flatten_result(STR.stream_extract(spark, f"{work}/source", None, docs, RAW, work), RAW)


@query("stream_live_background")
def stream_live_background(spark, sf):
    """No background beforehand: it is counted as the documents stream in.  Labelled documents come
    first as a stub of an earlier version, whose terms are taken back when the whole text comes."""
    from ..streaming import live as LV
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", F.lit(1).alias("version"))
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id").distinct()
    stubs = docs.join(labels, "doc_id", "left_semi").select(
        "doc_id", F.concat(F.lit("stub "), F.substring("text", 1, STUB_CHARS)).alias("text"), F.lit(0).alias("version"))
    work = f"{ensure_checkpoint_dir(spark)}/termlens-live-{uuid.uuid4().hex}"
    stubs.unionByName(docs).repartition(STREAM_FILES, "doc_id", "version").write.parquet(f"{work}/source")
    store = LV.Store(f"{work}/store", RAW, docs.schema, "version")
    q = LV.start_live_stream(spark, store, f"{work}/source")
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return E.flatten_result(store.results(spark), RAW)
