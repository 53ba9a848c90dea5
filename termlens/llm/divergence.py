"""Source divergence audit over a K-squared quadtree of the group-term count matrix.

Rows of the matrix are the (language, source) groups, columns the terms that ``min_docs`` documents
of the language hold at least, cells the occurrences.  Every group gives every column the share
``p = 1 + floor(10**9 * (count + 1) / (N + V))`` (``N``: the group's occurrences, ``V``: the
columns), and a pair of groups is priced ``sum of floor((p - q)**2 / q)`` over all columns.

1. Counts.  Each task counts terms of its own documents in dictionaries and hands on one row
   per (language, source, term); these partial counts are what is shuffled.
2. Tiles.  The columns of a language are dealt by hash into blocks of about ``BLOCK`` and its
   groups into tiles of about ``TILE``; a task gets one block of two tiles, at most about
   ``2 * TILE * BLOCK`` cells, whatever the corpus, the number of sources or one source's size.
3. Trees.  A tile of a block becomes a K-squared forest: squares are halved in both directions,
   one bit a quadrant tells whether it holds a count, and a nonzero quadrant's children lie at
   the rank of its bit.  Two forests are traversed jointly for all pairs of their groups: a pair of
   all-zero quadrants is priced at once (width times the price of two zero counts), a quadrant
   that is zero on one side only is carried as uniform, and nonzero leaves of 8 x 8 are computed.
   Columns that neither tile holds are one all-zero quadrant, priced at the end.

All arithmetic is exact in 64-bit integers: shares are divided in three steps of 1,000
(``N + V`` below 9e15); with the shares of a group summing to at most ``V + 10**9``, sums stay
below 2**63 up to two thousand million columns a language.

Defined results: null text, language and source count as ''; a text without terms still makes
its group occur; a language without columns prices every pair 0; equal prices rank by item in
UTF-8 order; repeated rows count again; an empty table gives no rows; other columns are not
read.  Very long texts are counted a part at a time.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termlens.llm.common import checkpoint, tidy
from termlens.operators.skew import salted_join

UNIT = 1_000_000_000
BLOCK, TILE, LEAF = 4096, 48, 8
PART_BYTES, HELD_TERMS, LEAF_PAIRS = 1 << 18, 1 << 16, 512
#: A-Z become a-z, letters and bytes of other scripts stay, everything else parts terms.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


# --- counts --------------------------------------------------------------------------------------

def term_parts(data: bytes, size: int = PART_BYTES) -> Iterator[list[bytes]]:
    """The terms of a text, from about ``size`` bytes of it at a time."""
    data = data.translate(FOLD)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + size) if len(data) - at > size else -1
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def count_terms(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents; the row of term '' counts the
    group's documents."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(blank(lang_col), blank(source_col), blank(text_col).cast("binary"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def flush() -> pa.RecordBatch:
            size = [len(docs_of) for _, docs_of in held.values()]
            keys = [pa.array(np.repeat(np.array([k[i] for k in held], dtype=object), size), pa.string()) for i in (0, 1)]
            terms = [t for _, docs_of in held.values() for t in docs_of]
            n = [occurrences[t] for occurrences, docs_of in held.values() for t in docs_of]
            d = [x for _, docs_of in held.values() for x in docs_of.values()]
            held.clear()
            return pa.RecordBatch.from_arrays(
                [*keys, pa.array(terms, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), pa.array(d, pa.int64())],
                names=["lang", "source", "term", "n", "docs"])

        for batch in batches:
            for lang, source, data in zip(*batch.columns):
                own: Counter = Counter()
                for terms in term_parts(data.as_py()):
                    own.update(terms)
                occurrences, docs_of = held.setdefault((lang.as_py(), source.as_py()), (Counter(), Counter()))
                occurrences.update(own)
                docs_of.update(own.keys())
                docs_of[b""] += 1
            if sum(len(d) for _, d in held.values()) > HELD_TERMS:
                yield flush()
        if held:
            yield flush()

    parts = rows.mapInArrow(tidy(run), "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def matrix(docs: DataFrame, min_docs: int = 3, lang_col: str = "lang", source_col: str = "source",
           text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The nonzero cells (lang, source, term, n, lang_n) and the groups (lang, source, total, cells,
    width, lang_total): ``total`` is N, ``width`` is V."""
    counts = checkpoint(count_terms(docs, lang_col, source_col, text_col))
    columns = checkpoint(
        counts.filter("term <> ''").groupBy("lang", "term")
        .agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"), F.count("*").alias("groups"))
        .filter(F.col("docs") >= min_docs).drop("docs"))
    everywhere = columns.select(F.sum("groups")).scalar()
    cells = checkpoint(
        salted_join(counts.drop("docs"), columns, ["lang", "term"], "groups", everywhere, "source").drop("groups"))
    sums = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("cells"))
    widths = columns.groupBy("lang").agg(F.count("*").alias("width"), F.sum("lang_n").alias("lang_total"))
    groups = (
        counts.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(widths, "lang", "left")
        .fillna(0, ["total", "cells", "width", "lang_total"]))
    return cells, checkpoint(groups)


def share(n: Column, total: Column) -> Column:
    """``1 + floor(10**9 * (n + 1) / total)``, exact."""
    wide = lambda c: c.cast("decimal(20,0)")
    return F.lit(1) + F.call_function("div", wide(n + 1) * F.lit(UNIT).cast("decimal(10,0)"), wide(total))


def price(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


# --- trees ---------------------------------------------------------------------------------------

def shares(n: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """``share`` over arrays: long division in base 1,000."""
    rest, p = n + 1, np.zeros_like(n)
    for _ in range(3):
        whole, rest = np.divmod(rest * 1000, total)
        p = p * 1000 + whole
    return p + 1


class Forest:
    """K-squared trees (k = 2) over the squares of a tile: ``size`` rows, a power of two, and
    ``squares`` times as many columns.  ``bits[l]`` has four flags per node of level l; the child of
    a set flag is the node of level l + 1 at the flag's rank.  Leaves hold shares, ``zero``
    (the share of count zero, by row) where there is no count."""

    def __init__(self, rows: np.ndarray, cols: np.ndarray, p: np.ndarray, zero: np.ndarray, squares: int):
        self.size = len(zero)
        self.levels = (self.size // LEAF).bit_length() - 1
        self.zero = np.repeat(zero.reshape(-1, LEAF)[:, :, None], LEAF, axis=2)
        path = cols // self.size
        for level in reversed(range(self.levels)):
            bit = LEAF << level
            path = path * 4 + 2 * (rows // bit % 2) + cols // bit % 2
        leaves, at = np.unique(path, return_inverse=True)
        nodes = [leaves]
        for _ in range(self.levels):
            nodes.insert(0, np.unique(nodes[0] >> 2))
        self.bits, self.rank = [], []
        for up, down in zip(nodes, nodes[1:]):
            flags = np.zeros(4 * len(up), dtype=bool)
            flags[4 * np.searchsorted(up, down >> 2) + (down & 3)] = True
            self.bits.append(flags)
            self.rank.append(np.cumsum(flags) - 1)
        self.roots = np.full(squares, -1)
        self.roots[nodes[0]] = np.arange(len(nodes[0]))
        first_row = np.zeros(len(leaves), dtype=np.int64)
        first_row[at] = rows // LEAF
        self.leaves = self.zero[first_row]
        self.leaves[at, rows % LEAF, cols % LEAF] = p

    def child(self, level: int, node: np.ndarray, digit: int) -> np.ndarray:
        """The child quadrant's node, -1 if it is all zero."""
        if not len(self.bits[level]):
            return np.full(len(node), -1)
        at = np.maximum(node, 0) * 4 + digit
        return np.where((node >= 0) & self.bits[level][at], self.rank[level][at], -1)

    def leaf(self, node: np.ndarray, row: np.ndarray) -> np.ndarray:
        out = self.zero[row]
        held = node >= 0
        out[held] = self.leaves[node[held]]
        return out


def joint(a: Forest, b: Forest) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For all pairs of rows: the prices of a against b and of b against a over the leaves that
    are nonzero on either side, and the number of columns in pairs of all-zero quadrants."""
    size, levels = a.size, a.levels
    empty = np.zeros((size, size), dtype=np.int64)
    n = size // LEAF
    ab, ba = (np.zeros((n, n, LEAF, LEAF), dtype=np.int64) for _ in range(2))
    x, y = a.roots, b.roots
    row_x = row_y = np.zeros(len(x), dtype=np.int64)
    for level in range(levels + 1):
        zero = (x < 0) & (y < 0)
        wide = size >> level
        grid = np.zeros((1 << level, 1 << level), dtype=np.int64)
        np.add.at(grid, (row_x[zero], row_y[zero]), wide)
        empty += np.kron(grid, np.ones((wide, wide), dtype=np.int64))
        x, y, row_x, row_y = x[~zero], y[~zero], row_x[~zero], row_y[~zero]
        if level < levels:
            kids = [(a.child(level, x, 2 * i + c), b.child(level, y, 2 * j + c), 2 * row_x + i, 2 * row_y + j)
                    for i in (0, 1) for j in (0, 1) for c in (0, 1)]
            x, y, row_x, row_y = (np.concatenate(k) for k in zip(*kids))
    for k in range(0, len(x), LEAF_PAIRS):
        some = slice(k, k + LEAF_PAIRS)
        p = a.leaf(x[some], row_x[some])[:, :, None, :]
        q = b.leaf(y[some], row_y[some])[:, None, :, :]
        squared = (p - q) ** 2
        np.add.at(ab, (row_x[some], row_y[some]), (squared // q).sum(axis=3))
        np.add.at(ba, (row_x[some], row_y[some]), (squared // p).sum(axis=3))
    flat = lambda m: m.transpose(0, 2, 1, 3).reshape(size, size)
    return flat(ab), flat(ba), empty


EMPTY = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("priced", pa.int64()),
                   ("columns", pa.int64()), ("unit", pa.int64()), ("width", pa.int64())]).empty_table()


def price_tiles(table: pa.Table) -> pa.Table:
    """One block of two tiles (rows without a term tell of a group: n is N, width is V): for every
    ordered pair of its groups the price over the block's columns that a tile holds, how many
    these are, and the price of a column that is zero in both."""
    lang, width = table["lang"][0], table["width"][0].as_py()
    low, high = table["low"][0].as_py(), table["high"][0].as_py()
    is_cell = pc.is_valid(table["term"])
    info, cells = table.filter(pc.invert(is_cell)), table.filter(is_cell)
    tiles = sorted({low, high})
    if set(info["tile"].to_pylist()) != set(tiles):  # a tile that no group fell into
        return EMPTY
    encoded = cells["term"].combine_chunks().dictionary_encode()
    col, n_cols = encoded.indices.to_numpy().astype(np.int64), len(encoded.dictionary)
    names = {t: sorted(zip(*(info.filter(pc.equal(info["tile"], t))[c].to_pylist() for c in ("source", "n")))) for t in tiles}
    size = max(LEAF, 1 << (max(map(len, names.values())) - 1).bit_length())
    row_of = {s: i for rows in names.values() for i, (s, _) in enumerate(rows)}
    row = np.array([row_of[s] for s in cells["source"].to_pylist()], dtype=np.int64)
    # columns in the order of their first row, so that rare terms leave large empty quadrants
    first = np.full(n_cols, size, dtype=np.int64)
    np.minimum.at(first, col, row)
    place = np.empty(n_cols, dtype=np.int64)
    place[np.argsort(first, kind="stable")] = np.arange(n_cols)
    col = place[col]
    squares = -(-n_cols // size)
    tile_of, n = cells["tile"].to_numpy(), cells["n"].to_numpy()
    forests = {}
    for t in tiles:
        totals = np.array([N + width for _, N in names[t]] + [UNIT] * (size - len(names[t])), dtype=np.int64)
        totals = np.maximum(totals, 1)
        own = tile_of == t
        forests[t] = Forest(row[own], col[own], shares(n[own], totals[row[own]]), shares(np.zeros_like(totals), totals), squares)
    a, b = forests[tiles[0]], forests[tiles[-1]]
    ab, ba, empty = joint(a, b)
    empty -= squares * size - n_cols  # columns that only fill the last square
    p, q = (f.zero[:, :, 0].reshape(-1) for f in (a, b))
    unit_ab, unit_ba = (p[:, None] - q) ** 2 // q, (p[:, None] - q) ** 2 // p[:, None]
    names_a, names_b = ([s for s, _ in names[t]] for t in (tiles[0], tiles[-1]))
    i, j = (m.reshape(-1) for m in np.meshgrid(np.arange(len(names_a)), np.arange(len(names_b)), indexing="ij"))
    sides = [(names_a, i, names_b, j, ab, unit_ab)]
    if len(tiles) > 1:
        sides.append((names_b, j, names_a, i, ba, unit_ba))
    out = []
    for sources, k, others, m, summed, unit in sides:
        apart = (i != j) if len(tiles) == 1 else np.ones(len(i), dtype=bool)
        total = (summed + empty * unit)[i, j][apart]
        out.append(pa.table({
            "lang": pa.array([lang.as_py()] * len(total), pa.string()),
            "source": pa.array(sources, pa.string()).take(pa.array(k[apart])),
            "item": pa.array(others, pa.string()).take(pa.array(m[apart])),
            "priced": total, "columns": np.full(len(total), n_cols, dtype=np.int64), "unit": unit[i, j][apart],
            "width": np.full(len(total), width, dtype=np.int64)}))
    return pa.concat_tables(out)


def pair_prices(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for every ordered pair of groups of one language."""
    tiled = groups.join(groups.groupBy("lang").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles")), "lang").select(
        "lang", "source", "total", "cells", "width", "tiles", F.pmod(F.xxhash64("source"), "tiles").cast("int").alias("tile"),
        F.greatest(F.lit(1), F.ceil(F.col("width") / BLOCK)).cast("int").alias("blocks"))
    placed = salted_join(
        cells.select("lang", "source", "term", "n"), tiled.drop("total"), ["lang", "source"], "cells",
        groups.select(F.sum("cells")).scalar(), "term")
    rows = placed.select(
        "lang", "source", "term", "n", "width", "tile", "tiles",
        F.pmod(F.xxhash64("term"), "blocks").cast("int").alias("block")
    ).unionByName(tiled.select(
        "lang", "source", F.lit(None).cast("string").alias("term"), F.col("total").alias("n"), "width", "tile", "tiles",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")))
    # each tile meets every tile of its language, itself included
    dealt = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select(
        "lang", "source", "term", "n", "width", "tile", "block",
        F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"))
    priced = dealt.groupBy("lang", "block", "low", "high").applyInArrow(
        price_tiles, "lang string, source string, item string, priced long, columns long, unit long, width long")
    sums = priced.groupBy("lang", "source", "item").agg(
        F.sum("priced").alias("priced"), F.sum("columns").alias("columns"), F.max("unit").alias("unit"),
        F.max("width").alias("width"))
    return sums.select("lang", "source", "item", (F.col("priced") + (F.col("width") - F.col("columns")) * F.col("unit")).alias("value"))


def term_prices(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): terms a group uses more than its language, by their price
    against it."""
    joined = salted_join(cells, groups, ["lang", "source"], "cells", groups.select(F.sum("cells")).scalar(), "term")
    both = joined.select(
        "lang", "source", F.col("term").alias("item"), share(F.col("n"), F.col("total") + F.col("width")).alias("p"),
        share(F.col("lang_n"), F.col("lang_total") + F.col("width")).alias("q"))
    return both.filter("p > q").select("lang", "source", "item", price(F.col("p"), F.col("q")).alias("value"))


def audit(docs: DataFrame, min_docs: int = 3, top_terms: int = 200, lang_col: str = "lang", source_col: str = "source",
          text_col: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` prices each group against every other
    source of its language, part ``term`` lists the ``top_terms`` terms it overuses most."""
    cells, groups = matrix(docs, min_docs, lang_col, source_col, text_col)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")

    def ranked(found: DataFrame, part: str) -> DataFrame:
        return found.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))

    return ranked(pair_prices(cells, groups), "pair").unionByName(
        ranked(term_prices(cells, groups), "term").filter(F.col("rank") <= top_terms))
