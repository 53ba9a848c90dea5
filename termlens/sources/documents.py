"""Document scans.

All scans are lazy DataFrame expressions over a parquet (or any) source; null tests
on plain columns are pushed into the parquet reader as ``IsNotNull`` / ``IsNull``
filters and only the selected columns are read.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_documents(spark: SparkSession, path: str, fmt: str = "parquet", key: str | None = "doc_id",
                   partitions: int | None = None, **options) -> DataFrame:
    """Any Spark source: parquet (default), orc, json, csv, a table name (``fmt='table'``).
    The scan keeps the source's splits unless the caller asks for ``partitions``: then the
    rows are hash-partitioned on ``key`` into that many (for a file whose single row group
    one task would read)."""
    df = spark.table(path) if fmt == "table" else spark.read.format(fmt).options(**options).load(path)
    if partitions is None:
        return df
    return df.repartition(partitions, key) if key and key in df.columns else df.repartition(partitions)


def _dedupe(fields: Iterable[str]) -> list[str]:
    """Each field once, first-seen order."""
    out: list[str] = []
    for f in fields or ():
        if f not in out:
            out.append(f)
    return out


def _descend(c: Column, dtype: T.DataType, parts: list[str]) -> tuple[Column, T.DataType] | None:
    """What the rest of a path names inside a value; None if the schema has no such place."""
    if not parts:
        return c, dtype
    if isinstance(dtype, T.StructType):
        for i in range(len(parts), 0, -1):  # a name may hold dots itself
            name = ".".join(parts[:i])
            if name in dtype.names:
                return _descend(c.getField(name), dtype[name].dataType, parts[i:])
        return None
    if isinstance(dtype, T.MapType) and isinstance(dtype.keyType, T.StringType):
        return _descend(F.try_element_at(c, F.lit(parts[0])), dtype.valueType, parts[1:])
    if isinstance(dtype, T.VariantType):
        if any("'" in p and '"' in p for p in parts):
            return None  # no path can name such a member
        keys = "".join(f"['{p}']" if "'" not in p else f'["{p}"]' for p in parts)
        return F.try_variant_get(c, "$" + keys, "variant"), dtype
    if isinstance(dtype, T.ArrayType):  # the values of all elements
        inner = _descend(F.lit(None).cast(dtype.elementType), dtype.elementType, parts)
        if inner is None:
            return None
        return F.transform(c, lambda x: _descend(x, dtype.elementType, parts)[0]), T.ArrayType(inner[1])
    return None


def field(df: DataFrame, path: str, body_col: str | None = None) -> tuple[Column, T.DataType] | None:
    """The value a field name stands for, and its type: a column of that name; else a dotted path
    into the longest column it begins with (structs, maps by key, arrays element by element,
    ``VARIANT`` objects); else a path into ``body_col``, the ``VARIANT`` column that holds documents
    without a schema.  None: no document can have such a field."""
    parts = path.split(".")
    for i in range(len(parts), 0, -1):
        name = ".".join(parts[:i])
        if name in df.columns:
            found = _descend(F.col(f"`{name}`"), df.schema[name].dataType, parts[i:])
            if found is not None:
                return found
    return _descend(F.col(f"`{body_col}`"), df.schema[body_col].dataType, parts) if body_col else None


def field_text(df: DataFrame, path: str, body_col: str | None = None) -> Column:
    """A field as text; null where a document has none, or something else than a scalar."""
    found = field(df, path, body_col)
    if found is None:
        return F.lit(None).cast("string")
    c, dtype = found
    if isinstance(dtype, T.VariantType):
        return F.when(~F.schema_of_variant(c).rlike("^(OBJECT|ARRAY)"), F.try_variant_get(c, "$", "string"))
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        raise TypeError(f"field {path!r} is {dtype.simpleString()}, not text")
    return c.cast("string")


# --- fixed value: the scalars and names of a JSON text, strings read whole ------------------
JSON_SCALARS = r'"(?:[^"\\]|\\.)*+":?|true|false|-?[0-9]'
# ----------------------------------------------------------------------------------------------


def _has_value(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.ArrayType):
        return F.coalesce(F.exists(c, lambda x: _has_value(x, dtype.elementType)), F.lit(False))
    if isinstance(dtype, T.MapType):
        return F.coalesce(F.exists(F.map_values(c), lambda x: _has_value(x, dtype.valueType)), F.lit(False))
    if isinstance(dtype, T.StructType):
        out = F.lit(False)
        for f in dtype.fields:
            out = out | _has_value(c.getField(f.name), f.dataType)
        return c.isNotNull() & out
    if isinstance(dtype, T.VariantType):
        # some scalar that is not a member's name and not null, at any depth
        scalars = F.regexp_extract_all(F.to_json(c), F.lit(JSON_SCALARS), F.lit(0))
        return F.coalesce(F.exists(scalars, lambda t: ~F.endswith(t, F.lit('":'))), F.lit(False))
    return c.isNotNull()


def field_exists(df: DataFrame, name: str, body_col: str | None = None) -> Column:
    """The document has a value in the field: not null, and for arrays, maps, structs and
    ``VARIANT`` values some value that is not null inside.  A field that no column and no path
    gives exists nowhere."""
    found = field(df, name, body_col)
    return F.lit(False) if found is None else _has_value(*found)


def field_missing(df: DataFrame, name: str, body_col: str | None = None) -> Column:
    """P2."""
    return ~field_exists(df, name, body_col)


def eligible_docs(docs: DataFrame, must_have: Iterable[str] = (), must_not_have: Iterable[str] = (),
                  body_col: str | None = None) -> DataFrame:
    """Documents where every field of ``must_have`` exists and none of
    ``must_not_have`` does (fields and paths as in ``field``)."""
    out = docs
    for f in _dedupe(must_have):
        out = out.where(field_exists(docs, f, body_col))
    for f in _dedupe(must_not_have):
        out = out.where(field_missing(docs, f, body_col))
    return out


def eligible_ids(docs: DataFrame, must_have: Iterable[str] = (), must_not_have: Iterable[str] = (),
                 id_col: str = "doc_id", body_col: str | None = None) -> DataFrame:
    """Ids only (column pruning reaches the scan)."""
    return eligible_docs(docs, must_have, must_not_have, body_col).select(id_col)


def read_json_documents(spark: SparkSession, path: str, id_path: str, id_col: str = "doc_id", id_type: str = "bigint",
                        body_col: str = "doc") -> DataFrame:
    """JSON documents without a schema: ``(id, body VARIANT)``, one row per line.  A document
    without an id, or with one of another type, has a null id."""
    docs = spark.read.option("singleVariantColumn", body_col).json(path)
    c, _ = _descend(F.col(f"`{body_col}`"), T.VariantType(), id_path.split("."))
    return docs.select(F.try_variant_get(c, "$", id_type).alias(id_col), body_col)


def random_order(docs: DataFrame, seed: int = 0, id_col: str = "doc_id") -> DataFrame:
    """S3: a seeded pseudo-random order that does not depend on partitioning: sort on
    ``md5(id || ':' || seed)`` (a range-partitioned global sort)."""
    key = F.md5(F.concat_ws(":", F.col(id_col).cast("string"), F.lit(str(seed))))
    return docs.withColumn("shuffle_key", key).orderBy("shuffle_key", id_col)


def docs_by_id(docs: DataFrame, ids, id_col: str = "doc_id") -> DataFrame:
    """Fetch by ids.  A Python list becomes an ``IN`` list (pushed to the scan);
    a DataFrame of ids is a ``left_semi`` join."""
    if isinstance(ids, DataFrame):
        return docs.join(ids.select(F.col(ids.columns[0]).alias(id_col)).distinct(), id_col, "left_semi")
    return docs.where(F.col(id_col).isin(list(ids)))


def sentences_to_docs(pieces: DataFrame, n: int = 5, seq_col: str = "turn", text_col: str = "text",
                      group_cols: Iterable[str] = (), sep: str = "", id_offset: int = 0) -> DataFrame:
    """Glue every ``n`` consecutive pieces (by the dense sequence ``seq_col``,
    within ``group_cols``) into one document.

    Output ``(group_cols..., doc_no, text, n_pieces)`` with ``doc_no = id_offset +
    seq div n``.  Each output group holds at most ``n`` pieces, so a group key that
    owns a third of all pieces still spreads over many small groups.
    """
    g = list(group_cols)
    chunk = (F.floor(F.col(seq_col) / n) + id_offset).cast("bigint").alias("doc_no")
    return (pieces.where(F.col(text_col).isNotNull())
            .groupBy(*g, chunk)
            .agg(F.sort_array(F.collect_list(F.struct(F.col(seq_col).alias("s"), F.col(text_col).alias("t")))).alias("_p"),
                 F.count(F.lit(1)).cast("bigint").alias("n_pieces"))
            .select(*g, "doc_no", F.array_join(F.transform("_p", lambda x: x["t"]), sep).alias("text"), "n_pieces"))


# --- fixed values: how a page's title and body are cut from its HTML -----------------
TITLE_PATTERN = r"(?is)<title[^>]*>(.*?)</title>"
BODY_PATTERN = r"(?is)<body[^>]*>(.*)</body>"
TAG_PATTERN = r"(?s)<[^>]*>"
# ---------------------------------------------------------------------------------------


def page_fields(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Two text fields of one page, for keyterms taken from one field and located in
    another: ``(id, title, body)``, tags replaced by a space."""
    h = F.col(html_col)
    return pages.select(
        id_col,
        F.regexp_extract(h, TITLE_PATTERN, 1).alias("title"),
        F.regexp_replace(F.regexp_extract(h, BODY_PATTERN, 1), TAG_PATTERN, " ").alias("body"),
    )
