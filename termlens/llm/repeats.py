"""Suffix-array dedup: longest-previous-factor arrays remove later copies of long passages.

Every byte covered by a string of ``min_length`` bytes that also starts earlier (in a smaller
id, or earlier in the same document) is removed; strings are judged on the input and never
cross documents.

A suffix array over the whole corpus fits no task, so equal strings are first brought together:

1. Anchors.  The anchor of a string is the place in it where a short hash (``anchor`` bytes) is
   smallest, so equal strings have equal anchors.  Consecutive starts with the same anchor
   place form a run; a run's context is all bytes of its strings.
2. The runs meet by anchor hash.  A context that occurred before is covered as a whole: of a
   group of copies only the first is compared further (copies within a task fall out before
   the shuffle).  A context no other context shares its anchor with has no copy.
3. The remaining contexts (partial overlaps: edges of passages, edited copies) meet by anchor
   hash with their bytes.  A task sorts the starts of its contexts into a suffix array of depth
   ``min_length`` (ties by position), finds for every suffix the previous and next smaller
   position in suffix order, and from them the longest previous factor: a start is removed if
   it reaches ``min_length``.
4. Every document takes back its runs and drops the bytes they cover.

Anchors found under many different contexts in a bounded sample (``SAMPLE_DOCS``) are hot: their
runs are split into single strings keyed by their own hash, which spreads the group and
decides each string alone.  The list only steers the layout, not the result.

The text is shuffled once, on the document; the three passes over it read the same exchange.

Defined results: null or empty text has no bytes; rows that repeat an id are parts of that id
in the order of their texts (a row equal to an earlier one is a copy); a null id sorts before
all others; an empty table gives no rows; other columns are carried through unread.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termlens.llm.common import blocks, expand, mix, tidy
from termlens.llm.pretokens import powers

MIN_LENGTH, ANCHOR = 100, 32
SAMPLE_DOCS, HOT_CONTEXTS = 20_000, 16
PLACE_BITS = 19
SEGMENT = 1 << (PLACE_BITS - 1)
CHUNK_BYTES = 1 << 20
SEEN_LIMIT = 1 << 20
NONE_ID = -(1 << 63)


class Runs:
    """Anchor runs of one block of texts (less than ``2**PLACE_BITS`` bytes in all)."""

    def __init__(self, data: np.ndarray, begins: np.ndarray, sizes: np.ndarray, min_length: int, anchor: int):
        n = len(data)
        self.min_length = min_length
        up, self.down = powers(n + 1)
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=self.total[1:])
        if n < min_length:
            self.lo = self.n = np.empty(0, np.int64)
            self.hash = self.context = np.empty(0, np.uint64)
            return
        hashes = mix((self.total[anchor:] - self.total[:-anchor]) * self.down[:n - anchor + 1])
        low_bits = np.uint64((1 << PLACE_BITS) - 1)
        least = (hashes & ~low_bits) | np.arange(len(hashes), dtype=np.uint64)
        width, size = min_length - anchor + 1, 1
        while 2 * size <= width:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if width > size:
            least = np.minimum(least[:size - width], least[width - size:])
        place = (least & low_bits).astype(np.int64)
        whole = np.ones(n, bool)  # strings that end inside their text
        short = np.minimum(sizes, min_length - 1)
        whole[expand(begins + sizes - short, short)] = False
        whole = whole[:len(place)]
        starts = np.flatnonzero(whole)
        new = np.ones(len(starts), bool)
        new[1:] = (place[starts[1:]] != place[starts[:-1]]) | (np.diff(starts) > 1)
        first = np.flatnonzero(new)
        self.lo = starts[first]
        self.n = np.diff(np.r_[first, len(starts)])
        at = place[self.lo]
        self.hash = hashes[at]
        self.context = mix(self.range_hash(self.lo, self.lo + self.n + min_length - 1)
                           + self.n.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def range_hash(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (self.total[b] - self.total[a]) * self.down[a]

    def split(self, hot: np.ndarray) -> None:
        """Turn runs with a hot anchor into single strings keyed by their own hash."""
        if not len(hot) or not len(self.lo):
            return
        k = np.minimum(np.searchsorted(hot, self.hash), len(hot) - 1)
        is_hot = hot[k] == self.hash
        if not is_hot.any():
            return
        lo = expand(self.lo[is_hot], self.n[is_hot])
        own = mix(self.range_hash(lo, lo + self.min_length) + np.uint64(1))
        cold = ~is_hot
        lo, n = np.r_[self.lo[cold], lo], np.r_[self.n[cold], np.ones(len(lo), np.int64)]
        order = np.argsort(lo)
        self.lo, self.n = lo[order], n[order]
        self.hash = np.concatenate([self.hash[cold], mix(own ^ np.uint64(0x5851F42D4C957F2D))])[order]
        self.context = np.concatenate([self.context[cold], own])[order]


def text_blocks(rows: Iterator[tuple[int, int, bytes]], min_length: int):
    """Blocks (data, begins, sizes, ids, offset of each text in its document).  A long text
    comes in segments that overlap by ``min_length - 1`` bytes."""
    parts, ids, offsets, held = [], [], [], 0

    def block():
        sizes = np.array([len(p) for p in parts], dtype=np.int64)
        return (np.frombuffer(b"".join(parts), dtype=np.uint8), np.cumsum(sizes) - sizes, sizes,
                np.array(ids, dtype=np.int64), np.array(offsets, dtype=np.int64))

    for doc, base, text in rows:
        for at in range(0, max(1, len(text) - min_length + 1), SEGMENT):
            part = text[at:at + SEGMENT + min_length - 1]
            if len(part) < min_length:
                continue
            if held + len(part) >= 1 << PLACE_BITS:
                yield block()
                parts, ids, offsets, held = [], [], [], 0
            parts.append(part)
            ids.append(doc)
            offsets.append(base + at)
            held += len(part)
    if parts:
        yield block()


def joined_runs(ids: np.ndarray, lo: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Adjacent runs of a document as one (input in order of document and start)."""
    if not len(ids):
        return ids, lo, n
    new = np.r_[True, (ids[1:] != ids[:-1]) | (lo[1:] != lo[:-1] + n[:-1])]
    first = np.flatnonzero(new)
    return ids[first], lo[first], np.add.reduceat(n, first)


def anchor_rows(rows: Iterator[tuple[int, int, bytes]], min_length: int, anchor: int, hot: np.ndarray):
    """Columns (hash, context, id, lo, n) of the runs to compare; runs whose context the task
    has seen before have no context: they are covered, and come joined."""
    seen = np.empty(0, np.uint64)
    for data, begins, sizes, ids, offsets in text_blocks(rows, min_length):
        runs = Runs(data, begins, sizes, min_length, anchor)
        runs.split(hot)
        if not len(runs.lo):
            continue
        owner = np.searchsorted(begins, runs.lo, side="right") - 1
        doc, lo = ids[owner], offsets[owner] + runs.lo - begins[owner]
        both = runs.hash ^ mix(runs.context)
        distinct, lead = np.unique(both, return_index=True)
        at = np.searchsorted(seen, distinct)
        fresh = np.ones(len(distinct), bool)
        inside = at < len(seen)
        fresh[inside] = seen[at[inside]] != distinct[inside]
        keep = np.zeros(len(both), bool)
        keep[lead[fresh]] = True
        if len(seen) + int(fresh.sum()) > SEEN_LIMIT:
            seen = seen[:0]
        seen = np.union1d(seen, distinct[fresh])
        yield runs.hash[keep].view(np.int64), runs.context[keep].view(np.int64), doc[keep], lo[keep], runs.n[keep]
        old = joined_runs(doc[~keep], lo[~keep], runs.n[~keep])
        if len(old[0]):
            yield mix(old[1].astype(np.uint64) ^ mix(old[0].view(np.uint64))).view(np.int64), None, *old


def previous_smaller(values: np.ndarray) -> np.ndarray:
    """For each place the nearest place before it with a smaller value, or -1 (all values
    distinct).  Candidates jump along each other: what lies between is larger."""
    n = len(values)
    found = np.arange(-1, n - 1)
    open_ = np.flatnonzero((found >= 0) & (values[found] > values))
    while len(open_):
        found[open_] = found[found[open_]]
        at = found[open_]
        open_ = open_[(at >= 0) & (values[at] > values[open_])]
    return found


def has_previous_factor(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Whether the longest previous factor at each of ``starts`` (ascending) is ``length`` or
    more, among the strings that begin at the given starts."""
    if not len(starts):
        return np.empty(0, bool)
    # ranks of strings by doubling: 1, 2, 4, ... bytes, the last step overlapping
    rank, size = data.astype(np.int64), 1
    packed = min(8, 1 << (length.bit_length() - 1))
    if packed == 8:
        wide = np.zeros(len(data) - 7, np.uint64)
        for k in range(8):
            wide |= data[k:len(data) - 7 + k].astype(np.uint64) << np.uint64(56 - 8 * k)
        rank, size = np.unique(wide, return_inverse=True)[1], 8
    while 2 * size < length:
        rank = np.unique(rank[:-size] * (int(rank.max()) + 1) + rank[size:], return_inverse=True)[1]
        size *= 2
    rest = length - size
    rank = np.unique(rank[starts] * (int(rank.max()) + 1) + rank[starts + rest], return_inverse=True)[1]
    order = np.argsort(rank, kind="stable")  # the suffix array, to the depth of ``length``
    before = previous_smaller(order)
    after = len(order) - 1 - previous_smaller(order[::-1])[::-1]
    sorted_rank = rank[order]
    # the factor reaches ``length`` if a neighbour of smaller position has the same string
    reach = (before >= 0) & (sorted_rank[before] == sorted_rank)
    inside = after < len(order)
    reach[inside] |= sorted_rank[after[inside]] == sorted_rank[inside]
    out = np.empty(len(order), bool)
    out[order] = reach
    return out


def hot_anchors(docs: DataFrame, text_col: str, min_length: int, anchor: int) -> np.ndarray:
    """Anchors with ``HOT_CONTEXTS`` different contexts or more in a sample of about
    ``SAMPLE_DOCS`` rows: at most the sample's anchors over ``HOT_CONTEXTS`` of them."""
    total = docs.count()
    share = min(1.0, SAMPLE_DOCS / max(total, 1))
    text = F.col(text_col).cast("string")
    sample = docs.filter(F.pmod(F.xxhash64(text, F.lit("anchors")), F.lit(1_000_000)) < share * 1_000_000).select(
        F.encode(text, "UTF-8").alias("bytes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((0, 0, b.as_py() or b"") for batch in blocks(batches, "bytes") for b in batch.column(0))
        for found, context, *_ in anchor_rows(rows, min_length, anchor, np.empty(0, np.uint64)):
            if context is not None:
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(context)], names=["hash", "context"])

    counted = (sample.mapInArrow(tidy(run), "hash long, context long").distinct().groupBy("hash")
               .agg(F.count("*").alias("n")).filter(F.col("n") >= HOT_CONTEXTS))
    return np.sort(np.array([r["hash"] for r in counted.collect()], dtype=np.int64).view(np.uint64))


def remove_repeats(docs: DataFrame, min_length: int = MIN_LENGTH, anchor: int = ANCHOR, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``docs`` without its text, with n_bytes, n_removed, n_spans (maximal removed runs) and kept
    (the remaining bytes).  Columns of ``docs`` named like these four are replaced."""
    return _removed(docs, min_length, anchor, id_col, text_col, False).drop("__null")


def without_repeats(docs: DataFrame, min_length: int = MIN_LENGTH, anchor: int = ANCHOR, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``docs`` with its columns, the text rid of later copies.  A character of which a byte is
    removed goes as a whole; a null text stays null."""
    found = _removed(docs, min_length, anchor, id_col, text_col, True)
    return found.withColumn(text_col, F.when(~F.col("__null"), F.col("kept"))).select(
        *[F.col(f"`{c}`") for c in docs.columns])


def union(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The maximal spans that intervals cover; intervals that touch are one."""
    order = np.argsort(starts)
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.flatnonzero(np.r_[True, starts[1:] > reach[:-1]])
    return starts[new], reach[np.r_[new[1:], len(starts)] - 1]


def without(data: bytes, starts: list[int], ends: list[int], whole_characters: bool) -> bytes:
    """``data`` without the spans, widened to whole UTF-8 characters if asked for."""
    parts, at = [], 0
    for a, b in zip(starts, ends):
        if whole_characters:
            while a and data[a] & 0xC0 == 0x80:
                a -= 1
            while b < len(data) and data[b] & 0xC0 == 0x80:
                b += 1
        parts.append(data[at:a])
        at = b
    parts.append(data[at:])
    return b"".join(parts)


def _removed(docs: DataFrame, min_length: int, anchor: int, id_col: str, text_col: str, as_text: bool) -> DataFrame:
    hot = hot_anchors(docs, text_col, min_length, anchor)
    text = F.coalesce(F.encode(F.col(text_col).cast("string"), "UTF-8"), F.lit(b""))
    made = {"n_bytes", "n_removed", "n_spans", "kept", "__null"} - ({id_col} if not as_text else set())
    names = [c for c in docs.columns if c != text_col and (as_text or c not in made)]
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NONE_ID)).alias("__id"), text.alias("__bytes"),
        F.struct(*[F.col(f"`{c}`") for c in names], F.col(text_col).isNull().alias("__null")).alias("__rest"))
    # the places of rows that repeat an id follow one another, with a gap no string crosses
    ahead = Window.partitionBy("__id").orderBy("__bytes").rowsBetween(Window.unboundedPreceding, -1)
    keyed = rows.withColumn("__base", F.coalesce(F.sum(F.length("__bytes") + 1).over(ahead), F.lit(0)).cast("long"))

    def texts(batches):
        for batch in blocks(batches, "__bytes"):
            yield from zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), batch.column(1).to_pylist())

    def runs_of(batch: pa.RecordBatch, *fields: str):
        """For each row its bytes and, as arrays, its runs: place in the text and the fields asked for."""
        lists = batch.column(4)
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        flat = lists.flatten()
        row = np.repeat(np.arange(len(sizes)), sizes)
        columns = [flat.field(f) for f in ("lo", "n", *fields)]
        lo = columns[0].to_numpy() - batch.column(3).to_numpy()[row]
        size = pc.binary_length(batch.column(1)).to_numpy()
        own = (lo >= 0) & (lo < size[row])  # an id's runs go to the one of its texts that holds them
        return row[own], lo[own], columns[1].to_numpy()[own], [c.filter(pa.array(own)) for c in columns[2:]]

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found, context, doc, lo, n in anchor_rows(texts(batches), min_length, anchor, hot):
            yield pa.RecordBatch.from_arrays([
                pa.array(found), pa.nulls(len(found), pa.int64()) if context is None else pa.array(context),
                pa.array(doc), pa.array(lo), pa.array(n)], names=["hash", "context", "__id", "lo", "n"])

    runs = (keyed.mapInArrow(tidy(anchors), "hash long, context long, __id long, lo long, n long")
            .repartition("hash").sortWithinPartitions("hash", "context", "__id", "lo"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Runs that are covered (no hash), and first runs of contexts that share an anchor."""
        names = ["__id", "lo", "n", "hash"]
        last = pending = None  # the row before this batch; a first run that may stay alone
        for batch in batches:
            done = batch.column(1).is_null().to_numpy(zero_copy_only=False)
            found, doc, lo, n = (batch.column(k).to_numpy() for k in (0, 2, 3, 4))
            if done.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x[done]) for x in (doc, lo, n)] + [pa.nulls(int(done.sum()), pa.int64())], names=names)
            open_ = ~done
            if not open_.any():
                continue
            context = batch.column(1).drop_null().to_numpy()
            found, doc, lo, n = found[open_], doc[open_], lo[open_], n[open_]
            new_hash, new = np.ones(len(found), bool), np.ones(len(found), bool)
            new_hash[1:] = found[1:] != found[:-1]
            new[1:] = new_hash[1:] | (context[1:] != context[:-1])
            if last is not None:
                new_hash[0] = found[0] != last[0]
                new[0] = new_hash[0] or context[0] != last[1]
            last = (found[-1], context[-1])
            lead = np.flatnonzero(new)
            shared = ~new_hash[lead]
            shared[:-1] |= found[lead[1:]] == found[lead[:-1]]
            if len(lead) and pending is not None:
                if found[lead[0]] == pending[3]:
                    yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in pending], names=names)
                pending = None
            if len(lead) and not shared[-1]:
                k = lead[-1]
                pending = (doc[k], lo[k], n[k], found[k])
            old, kept = ~new, lead[shared]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.r_[x[old], x[kept]]) for x in (doc, lo, n)]
                + [pa.concat_arrays([pa.nulls(int(old.sum()), pa.int64()), pa.array(found[kept])])], names=names)

    judged = runs.mapInArrow(tidy(judge), "__id long, lo long, n long, hash long")
    by_doc = judged.groupBy("__id").agg(F.collect_list(F.struct("lo", "n", "hash")).alias("__runs"))

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "__bytes"):
            row, at, n, (found,) = runs_of(batch, "hash")
            open_ = found.is_valid().to_numpy(zero_copy_only=False)
            row, at, n, found = row[open_], at[open_], n[open_], found.drop_null()
            data = batch.column(1).to_pylist()
            parts = [data[r][a:b] for r, a, b in zip(row.tolist(), at.tolist(), (at + n + min_length - 1).tolist())]
            yield pa.RecordBatch.from_arrays(
                [found, pa.array(batch.column(0).to_numpy()[row]), pa.array(at + batch.column(3).to_numpy()[row]),
                 pa.array(n), pa.array(parts, pa.binary())], names=["hash", "__id", "lo", "n", "bytes"])

    compare = (keyed.join(by_doc, "__id").select("__id", "__bytes", "__rest", "__base", "__runs")
               .mapInArrow(tidy(contexts), "hash long, __id long, lo long, n long, bytes binary")
               .repartition("hash").sortWithinPartitions("hash", "__id", "lo"))

    def factors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def removed(doc, lo, n, parts):
            sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
            begins = np.cumsum(sizes) - sizes
            starts = expand(begins, n)
            hit = has_previous_factor(np.frombuffer(b"".join(parts), dtype=np.uint8), starts, min_length)
            ids, at = np.repeat(doc, n)[hit], expand(lo, n)[hit]
            return pa.RecordBatch.from_arrays(
                [pa.array(x) for x in joined_runs(ids, at, np.ones(len(ids), np.int64))], names=["__id", "lo", "n"])

        held, size = [], 0
        for batch in batches:
            # whole groups only: the rows up to the last change of hash may be taken
            size += batch.get_total_buffer_size() if batch.num_rows < 64 else batch.column(4).nbytes
            held.append(batch)
            if size < CHUNK_BYTES:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            yield from _chunks(table, removed, False)
            held, size = _rest(table)
        if held:
            yield from _chunks(pa.Table.from_batches(held).combine_chunks(), removed, True)

    found = compare.mapInArrow(tidy(factors), "__id long, lo long, n long")
    cover = (judged.filter("hash is null").select("__id", "lo", "n").union(found)
             .groupBy("__id").agg(F.collect_list(F.struct("lo", "n")).alias("__runs")))

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "__bytes"):
            removed, spans, kept, sizes = [], [], [], []
            row, at, n, _ = runs_of(batch)
            cuts = np.searchsorted(row, np.arange(batch.num_rows + 1))
            for k, data in enumerate(batch.column(1).to_pylist()):
                sizes.append(len(data))
                if cuts[k] == cuts[k + 1]:
                    removed.append(0)
                    spans.append(0)
                    kept.append(data.decode("utf-8") if as_text else data)
                    continue
                mine = slice(cuts[k], cuts[k + 1])
                first, last = union(at[mine], (at + n)[mine] + min_length - 1)
                removed.append(int((last - first).sum()))
                spans.append(len(first))
                data = without(data, first.tolist(), last.tolist(), as_text)
                kept.append(data.decode("utf-8") if as_text else data)
            yield pa.RecordBatch.from_arrays(
                [batch.column(2), *(pa.array(x, pa.int64()) for x in (sizes, removed, spans)),
                 pa.array(kept, pa.string() if as_text else pa.binary())], names=["rest", "n_bytes", "n_removed", "n_spans", "kept"])

    schema = T.StructType([T.StructField("rest", keyed.schema["__rest"].dataType)] + [
        T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")] + [
        T.StructField("kept", T.StringType() if as_text else T.BinaryType())])
    return (keyed.join(cover, "__id", "left").select("__id", "__bytes", "__rest", "__base", "__runs")
            .mapInArrow(tidy(drop), schema).select(*(["rest.*"] if as_text else ["rest.*", "n_bytes", "n_removed", "n_spans"]),
                                             "kept"))


def _rest(table: pa.Table) -> tuple[list[pa.RecordBatch], int]:
    """The rows of the last, maybe unfinished, hash."""
    hashes = table.column(0).to_numpy()
    last = table.slice(int(np.searchsorted(hashes, hashes[-1])))
    batches = last.combine_chunks().to_batches()
    return batches, sum(b.column(4).nbytes for b in batches)


def _chunks(table: pa.Table, removed, final: bool) -> Iterator[pa.RecordBatch]:
    """Apply ``removed`` to whole hash groups, about ``CHUNK_BYTES`` of them at a time."""
    hashes = table.column(0).to_numpy()
    end = len(hashes) if final else int(np.searchsorted(hashes, hashes[-1]))
    if not end:
        return
    doc, lo, n = (table.column(k).to_numpy() for k in (1, 2, 3))
    parts = table.column(4).slice(0, end).to_pylist()
    size = np.cumsum(np.fromiter(map(len, parts), dtype=np.int64, count=end))
    at = 0
    while at < end:
        to = int(np.searchsorted(size, (size[at - 1] if at else 0) + CHUNK_BYTES)) + 1
        to = min(end, int(np.searchsorted(hashes[:end], hashes[min(to, end) - 1], side="right")))
        yield removed(doc[at:to], lo[at:to], n[at:to], parts[at:to])
        at = to
