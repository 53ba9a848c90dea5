"""Quality rules: an isolation forest on rule statistics.

1. ``rule_statistics`` counts, over every whole text, what quality rules look at.
2. ``fit`` grows isolation forests of ``N_TREES`` trees, each on ``SUBSAMPLE`` rows drawn from
   all rows that pass the base rules by a hash of the row and the tree's number, whatever the
   input's partitions: random feature, random split value, short paths mark what is easy to set
   apart.  One forest takes all rates together, one more each rate alone (``VIEWS``): what is
   rare in a harmless rate must not hide what is rare in a telling one.
3. The thresholds are calibrated from all labelled rows, one forest after the other: of all
   cuts that reject at most ``MAX_CLEAN_LOSS`` of the good rows, the one with the best
   difference of rejection rates is taken, then the next on the rows not rejected so far,
   until none gains ``MIN_GAIN``; the other forests reject nothing.  The driver sees a
   histogram of ``BINS`` bins per forest and label.
4. A document is kept if the base rules and all forests keep it.

Defined results: null or blank text has no words and fails the base rule; without usable
labels only the forest of all rates rejects, above ``DEFAULT_CUT``; a document labelled twice counts with its lowest
label; rows repeating an id are judged row by row, rows alike in id and counts are drawn as one; an empty table gives no rows.
A very long text is counted whole, in parts; ``judge`` reads no columns but its own, ``keep_good`` hands on all
columns, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termlens.llm.common import checkpoint, mix, tidy
from termlens.llm.simhash import word_parts

N_TREES, SUBSAMPLE, SEED = 128, 256, 17
BINS, MAX_CLEAN_LOSS, MIN_GAIN, DEFAULT_CUT = 1000, 0.001, 0.02, 0.75
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
PASSED = f"n_words >= {MIN_WORDS} and 100 * n_repeat_words <= {MAX_REPEAT_PERCENT} * n_words"
SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_distinct", "n_upper", "n_digits")


def count_text(text: str | None) -> tuple[int, ...]:
    """The rule statistics of one text, in the order of ``COUNTS``."""
    data = (text or "").encode("utf-8", "surrogatepass")

    def count(characters: bytes) -> int:
        return len(data) - len(data.translate(None, characters))

    ids: dict[bytes, int] = {}
    codes = np.concatenate([np.empty(0, np.int64), *(
        np.array([ids.setdefault(w, len(ids)) for w in words], dtype=np.int64) for words in word_parts(data))])
    n = len(codes)
    if not n:
        return (0, 0, count(SYMBOLS), 0, 0, 0, 0, 0, 0)
    chars = len(text) - count(b" \t\n\x0b\x0c\r")
    lines = [x for x in data.split(b"\n") if x.strip()]
    repeated = 0
    if n >= 4:
        width = len(ids)
        pairs = codes[:-2] * width + codes[1:-1]
        if width > 2_000_000:
            pairs = np.unique(pairs, return_inverse=True)[1]
        windows = pairs * width + codes[2:]
        order = np.argsort(windows, kind="stable")
        ranked = windows[order]
        same = ranked[1:] == ranked[:-1]
        twice = np.zeros(n - 2, bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        covered = np.zeros(n, bool)
        for k in range(3):
            covered[k:n - 2 + k] |= twice
        repeated = int(covered.sum())
    return (n, chars, count(SYMBOLS), len(lines) - len(set(lines)), repeated, len(lines), len(ids),
            count(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), count(b"0123456789"))


def rule_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, the counts) of every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = dict(rows.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = np.array([count_text(t.as_py()) for t in batch.column(1)], dtype=np.int64)
            table = table.reshape(-1, len(COUNTS))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(table[:, k]) for k in range(len(COUNTS)))],
                names=["doc_id", *COUNTS])

    return rows.mapInArrow(tidy(run), f"doc_id {kind}, " + ", ".join(f"{c} long" for c in COUNTS))


def features(counts: np.ndarray) -> np.ndarray:
    """Rates the rules look at, from a matrix of ``COUNTS``; none depends on mere length."""
    c = {name: counts[:, k].astype(float) for k, name in enumerate(COUNTS)}
    words, chars, lines = (np.maximum(c[k], 1) for k in ("n_words", "word_chars", "n_lines"))
    return np.column_stack([
        np.log1p(20 * c["n_symbols"] / words), c["n_dup_lines"] / lines, c["n_repeat_words"] / words,
        np.log(np.maximum(chars / words, 0.1)), c["n_upper"] / chars, c["n_digits"] / chars,
        c["n_distinct"] / np.sqrt(words),
    ])


#: The columns of ``features`` each forest sees.
VIEWS = ((0, 1, 2, 3, 4, 5, 6), (0,), (1,), (2,), (3,), (4,), (5,), (6,))


def failed_base(counts: np.ndarray) -> np.ndarray:
    words, repeat = counts[:, COUNTS.index("n_words")], counts[:, COUNTS.index("n_repeat_words")]
    return (words < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PERCENT * words)


def _expected(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search among ``n`` rows."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 3)
    long = 2 * (np.log(safe - 1) + 0.5772156649) - 2 * (safe - 1) / safe
    return np.where(n > 2, long, np.where(n == 2, 1.0, 0.0))


@dataclass
class Forest:
    """Trees as arrays: split feature (-1: leaf), split value, left child (right is next),
    path length at a leaf."""

    feature: list[np.ndarray]
    value: list[np.ndarray]
    left: list[np.ndarray]
    length: list[np.ndarray]
    subsample: int

    @staticmethod
    def fit(rows: np.ndarray, n_trees: int = N_TREES, subsample: int = SUBSAMPLE, seed: int = SEED) -> Forest:
        rng = np.random.default_rng(seed)
        size = min(subsample, len(rows))
        draws = (rows[rng.choice(len(rows), size, replace=False)] for _ in range(n_trees if size else 0))
        return Forest.grow(draws, size, rng)

    @staticmethod
    def grow(draws: Iterable[np.ndarray], size: int, rng: np.random.Generator) -> Forest:
        """One tree on each of the draws of ``size`` rows."""
        forest = Forest([], [], [], [], size)
        limit = int(np.ceil(np.log2(max(size, 2))))
        for rows in draws:
            nodes: list[list] = [[-1, 0.0, 0, 0.0]]
            todo = [(0, rows, 0)]
            while todo:
                at, part, depth = todo.pop()
                low, high = part.min(axis=0), part.max(axis=0)
                wide = np.flatnonzero(high > low)
                if depth >= limit or len(part) <= 1 or not len(wide):
                    nodes[at][3] = depth + float(_expected(len(part)))
                    continue
                f = int(rng.choice(wide))
                cut = min(float(rng.uniform(low[f], high[f])), float(np.nextafter(high[f], low[f])))
                below = part[:, f] <= cut
                nodes[at][:3] = [f, cut, len(nodes)]
                todo += [(len(nodes), part[below], depth + 1), (len(nodes) + 1, part[~below], depth + 1)]
                nodes += [[-1, 0.0, 0, 0.0], [-1, 0.0, 0, 0.0]]
            for kept, k, kind in ((forest.feature, 0, np.int32), (forest.value, 1, float),
                                  (forest.left, 2, np.int32), (forest.length, 3, float)):
                kept.append(np.array([x[k] for x in nodes], dtype=kind))
        return forest

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Anomaly score in (0, 1): 2 to the power of minus mean path over expected path."""
        if not self.feature or not len(rows) or self.subsample < 2:  # one row sets nothing apart
            return np.full(len(rows), 0.5)
        total = np.zeros(len(rows))
        at_rows = np.arange(len(rows))
        for feature, value, left, length in zip(self.feature, self.value, self.left, self.length):
            at = np.zeros(len(rows), dtype=np.int32)
            while True:
                f = feature[at]
                inner = f >= 0
                if not inner.any():
                    break
                step = left[at] + (rows[at_rows, np.maximum(f, 0)] > value[at])
                at = np.where(inner, step, at).astype(np.int32)
            total += length[at]
        norm = max(float(_expected(self.subsample)), 1e-9)
        return np.exp2(-total / len(self.feature) / norm)


@dataclass
class Model:
    forests: list[Forest]
    cuts: list[float]

    def scores(self, counts: np.ndarray) -> np.ndarray:
        """Anomaly scores: row x view."""
        rates = features(counts)
        return np.column_stack([f.score(rates[:, view]) for f, view in zip(self.forests, VIEWS)])

    def judge(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(base_failed, margin, kept): the margin is the largest excess of a score over its
        cut; a document with a positive one goes."""
        base = failed_base(counts)
        margin = (self.scores(counts) - np.array(self.cuts)).max(axis=1)
        return base, margin, ~base & (margin <= 0)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([batch.column(1 + k).to_numpy() for k in range(len(COUNTS))])


def scored(stats: DataFrame, model: Model) -> DataFrame:
    """``stats`` with base_failed, margin and kept."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, margin, kept = model.judge(_matrix(batch))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(base), pa.array(margin), pa.array(kept)],
                names=["doc_id", *COUNTS, "base_failed", "margin", "kept"])

    schema = T.StructType([*stats.select("doc_id", *COUNTS).schema,
                           T.StructField("base_failed", T.BooleanType()),
                           T.StructField("margin", T.DoubleType()), T.StructField("kept", T.BooleanType())])
    return stats.select("doc_id", *COUNTS).mapInArrow(tidy(run), schema)


def _histogram(marked: DataFrame, model: Model) -> np.ndarray:
    """Labelled rows the model keeps so far, by view, label and score bin; partial histograms
    are added up."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hist = np.zeros((len(VIEWS), 2, BINS + 1), dtype=np.int64)
        for batch in batches:
            good = batch.column(1 + len(COUNTS)).to_numpy(zero_copy_only=False).astype(int)
            scores = model.scores(_matrix(batch))
            kept = (scores <= np.array(model.cuts)).all(axis=1)
            bins = np.floor(scores * BINS).astype(int)
            for view in range(len(VIEWS)):
                np.add.at(hist[view], (good[kept], bins[kept, view]), 1)
        view, good, at = np.nonzero(hist)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (view, good, at, hist[view, good, at])],
                                         names=["view", "good", "bin", "n"])

    parts = marked.mapInArrow(tidy(run), "view long, good long, bin long, n long")
    total = np.zeros((len(VIEWS), 2, BINS + 1))
    for r in parts.groupBy("view", "good", "bin").agg(F.sum("n").alias("n")).collect():  # bounded by its keys
        total[r["view"], r["good"], r["bin"]] = r["n"]
    return total


def draw(stats: DataFrame) -> list[np.ndarray]:
    """The counts each tree grows on: of all rows that pass the base rules the ``SUBSAMPLE`` whose
    hash with the tree's number is smallest.  Tasks pass on what lies below a bound that about
    twice as many rows meet; the driver sees 2 * N_TREES * SUBSAMPLE rows."""
    rows = stats.filter(PASSED).select(F.xxhash64("doc_id", *COUNTS).alias("key"), *COUNTS)
    n = rows.agg(F.approx_count_distinct("key", 0.02).alias("n")).first()["n"]
    bound = np.uint64(min(2 * SUBSAMPLE / max(1, n), 1.0) * ((1 << 63) - 1024))
    trees = mix(np.arange(1, N_TREES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(SEED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column(0).to_numpy().view(np.uint64)
            for k, own in enumerate(trees):
                rank = mix(key ^ own) >> np.uint64(1)
                at = np.flatnonzero(rank <= bound)
                if len(at):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), k, np.int64)), pa.array(rank[at].view(np.int64)),
                         *(c.take(pa.array(at)) for c in batch.columns[1:])], names=["tree", "rank", *COUNTS])

    drawn = rows.mapInArrow(tidy(run), ", ".join(f"{c} long" for c in ("tree", "rank", *COUNTS))).distinct().toArrow()
    table = np.column_stack([c.to_numpy() for c in drawn.columns])
    table = table[np.lexsort(table.T[::-1])]
    parts = np.split(table[:, 2:], np.searchsorted(table[:, 0], np.arange(1, N_TREES)))
    return [p[:SUBSAMPLE] for p in parts if len(p)]


def fit(stats: DataFrame, labels: DataFrame | None) -> Model:
    """The forests, and their cuts calibrated on every labelled row."""
    draws = [features(rows) for rows in draw(stats)]
    size = max(map(len, draws), default=0)
    model = Model([Forest.grow([d[:, view] for d in draws], size, np.random.default_rng(SEED)) for view in VIEWS],
                  [DEFAULT_CUT] + [2.0] * (len(VIEWS) - 1))
    if labels is None:
        return model
    marks = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        (F.min("quality") > 0).alias("good"))
    marked = (stats.filter(PASSED)
              .select("doc_id", *COUNTS).join(marks, "doc_id"))
    cuts, total = [2.0] * len(VIEWS), None
    for _ in VIEWS:
        model.cuts = cuts
        hist = _histogram(marked, model)
        left = hist.sum(axis=2)[:, :, None]
        if total is None:
            total = left
            if not total.all():
                model.cuts = [DEFAULT_CUT] + cuts[1:]
                break
        above = (left - np.cumsum(hist, axis=2)) / total  # share of a label above a bin
        gain = np.where(above[:, 1] <= MAX_CLEAN_LOSS, above[:, 0] - above[:, 1], -1.0)
        view = int(gain.max(axis=1).argmax())
        if gain[view].max() < MIN_GAIN:
            break
        best = np.flatnonzero(gain[view] == gain[view].max())  # equally good cuts: the middle one
        cuts[view] = min(cuts[view], (best[0] + best[-1] + 2) / 2 / BINS)
    return model


def judge(docs: DataFrame, labels: DataFrame | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts, base_failed, margin, kept."""
    stats = checkpoint(rule_statistics(docs, id_col, text_col))
    return scored(stats, fit(stats, labels))


def keep_good(docs: DataFrame, labels: DataFrame | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns; nothing is shuffled."""
    model = fit(checkpoint(rule_statistics(docs, id_col, text_col)), labels)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = np.array([count_text(t.as_py()) for t in batch.column(at)], np.int64).reshape(-1, len(COUNTS))
            yield batch.filter(pa.array(model.judge(counts)[2]))

    return docs.mapInArrow(tidy(run), docs.schema)
