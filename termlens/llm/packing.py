"""Best-fit packing with Martello-Toth dominance reduction.

Documents become pieces of at most ``capacity`` tokens; only longer documents are cut.  What
packing needs to know of the pieces is the histogram of their lengths (``capacity`` numbers,
whatever the corpus), so the plan is made from the histogram and its size does not depend on
the number of pieces:

1. Reduction.  Going down the lengths, a set that provably dominates every other set holding
   the longest remaining piece is fixed: the piece alone if nothing fits beside it; the piece
   and one that fills the sequence exactly; the piece and the longest that fits, if no two
   others fit together, or no three and none of the fitting pairs is longer; and the piece with
   the best pair, if no three others fit and every fitting single and pair is dominated by that pair.
2. Best fit, longest first, of what is left: each piece goes to the fullest sequence that has
   room.  Equal pieces and equal sequences are handled together, with their multiplicity.

Each piece then finds its place from its rank among the pieces of its length: a running number
inside its task plus the counted offsets of the tasks before.  A hot length is spread like
any other, and no task sees more than its own pieces.

Defined results: a null or empty text is one piece holding the end id alone; repeated rows are
packed as rows; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termlens.llm.common import blocks, checkpoint, tidy
from termlens.llm.pretokens import WordCoder

CAPACITY, END_ID = 2048, 0


class WholeText:
    """Ids of a text by the library itself.  It also matches the file's added tokens inside a
    text; ``literals`` are what a text then holds, as written or in normal form."""

    def __init__(self, library):
        self.library = library
        tokens = [t.content for t in library.get_added_tokens_decoder().values()]
        if any(c.isspace() for t in tokens for c in t):
            raise ValueError("an added token holds white space, where long texts are cut")
        self.literals = sorted({*tokens, *map(normal, tokens)})

    def __call__(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids


class WordTokenizer:
    """A tokenizer file whose words end in ``</w>``: distinct words are encoded by the library,
    many at a time, and a text's ids are those of its words, unless it takes ``slow``."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.slow = WholeText(self.library)
        vocab = self.library.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lines = [" ".join(words[a:a + 512]) for a in range(0, len(words), 512)]
        flat = np.concatenate([np.array(e.ids, dtype=np.uint32)
                               for e in self.library.encode_batch_fast(lines, add_special_tokens=False)])
        stops = np.flatnonzero(self.ends[flat]) + 1
        if len(stops) != len(words):
            raise ValueError("the vocabulary does not mark the ends of words")
        return flat, np.diff(np.r_[0, stops])


@lru_cache(maxsize=2)
def tokenizer(path: str) -> WordTokenizer:
    """Loaded once per Python worker."""
    return WordTokenizer(path)


def normal(text: str) -> str:
    """The tokenizer's normal form but for white space, which its words never hold."""
    import unicodedata

    return unicodedata.normalize("NFC", text).lower()


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text",
           with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, task, nth[, ids]): ``nth`` counts the pieces of
    one length within the task."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        words = tokenizer(path)
        coder = WordCoder(words.encode_words)
        seen = np.zeros(capacity + 1, np.int64)
        for block in blocks(batches):
            raw = [t or "" for t in block.column(1).to_pylist()]
            row, nth_piece, start, length, crc, nth, ids = [], [], [], [], [], [], []
            for k, found in enumerate(coder.ids(raw, False, words.slow, normal)):
                data = np.append(found, END_ID).astype("<u4")
                for p, at in enumerate(range(0, len(data), capacity)):
                    part = data[at:at + capacity]
                    row.append(k)
                    nth_piece.append(p)
                    start.append(at)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
                    nth.append(seen[len(part)])
                    seen[len(part)] += 1
                    if with_ids:
                        ids.append(part.astype(np.int32))
            columns = [block.column(0).take(pa.array(row, pa.int64())), pa.array(nth_piece, pa.int32()),
                       pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                       pa.array(np.full(len(row), task, np.int64)), pa.array(nth, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(tidy(run), f"doc_id {dict(rows.dtypes)['doc_id']}, piece int, start long, length long, "
                                "ids_crc32 long, task long, nth long" + ", ids array<int>" * with_ids)


class Stock:
    """Counts of pieces by length, with the lengths present in ascending order."""

    def __init__(self, histogram: dict[int, int]):
        self.count = {k: v for k, v in histogram.items() if v > 0}
        self.lengths = sorted(self.count)

    def take(self, length: int, n: int) -> None:
        self.count[length] -= n
        if not self.count[length]:
            del self.count[length]
            self.lengths.pop(bisect_left(self.lengths, length))

    def longest_up_to(self, limit: int) -> int:
        k = bisect_left(self.lengths, limit + 1)
        return self.lengths[k - 1] if k else 0

    def smallest(self, n: int) -> list[int]:
        out: list[int] = []
        for length in self.lengths:
            out += [length] * min(self.count[length], n - len(out))
            if len(out) == n:
                break
        return out

    def best_pair(self, room: int) -> tuple[int, int]:
        """The longest two pieces that fit ``room`` together (first >= second), or (0, 0)."""
        best, low, high = (0, 0), 0, len(self.lengths) - 1
        while low <= high:
            a, b = self.lengths[high], self.lengths[low]
            if a + b > room or (low == high and self.count[a] < 2):
                high -= 1
                continue
            if a + b > sum(best):
                best = (a, b)
            low += 1
        return best


def reduce_histogram(histogram: dict[int, int], capacity: int) -> tuple[list[tuple[int, tuple[int, ...]]], dict[int, int]]:
    """(fixed sets as (how many, lengths), the histogram that is left)."""
    stock, fixed = Stock(histogram), []

    def fix(lengths: tuple[int, ...]) -> None:
        times = min(stock.count[x] // lengths.count(x) for x in lengths)
        fixed.append((times, lengths))
        for x in set(lengths):
            stock.take(x, times * lengths.count(x))

    for longest in sorted(histogram, reverse=True):
        while stock.count.get(longest, 0):
            room = capacity - longest
            stock.take(longest, 1)  # look at what else there is
            single = stock.longest_up_to(room)
            small = stock.smallest(3)
            triples = len(small) == 3 and sum(small) <= room
            pair = stock.best_pair(room) if len(small) > 1 and sum(small[:2]) <= room else (0, 0)
            stock.count[longest] = stock.count.get(longest, 0) + 1
            if longest not in stock.lengths:
                stock.lengths.insert(bisect_left(stock.lengths, longest), longest)
            if not single:
                fix((longest,))
            elif single == room or not sum(pair) or (not triples and single >= sum(pair)):
                fix((longest, single))
            elif sum(pair) == room and not triples and single <= pair[0] and _dominates(stock, longest, pair, room):
                fix((longest, *pair))
            else:
                break
    return fixed, dict(stock.count)


def _dominates(stock: Stock, longest: int, pair: tuple[int, int], room: int) -> bool:
    """Whether every fitting pair has its longer part within pair[0] and its shorter in pair[1]."""
    for a in stock.lengths:
        b = stock.longest_up_to(min(a, room - a))
        if b == a and stock.count[a] <= 1 + (a == longest):  # no second one: the next shorter
            b = stock.longest_up_to(a - 1)
        if b and (a > pair[0] or b > pair[1]):
            return False
    return True


def best_fit(histogram: dict[int, int], capacity: int) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """Best fit, longest first: (how many sequences, ((length, how many of it), ...))."""
    open_: dict[int, list[tuple[int, tuple]]] = {}  # room left -> sequences alike
    rooms: list[int] = []

    def put(room: int, times: int, content: tuple) -> None:
        if room not in open_:
            open_[room] = []
            rooms.insert(bisect_left(rooms, room), room)
        open_[room].append((times, content))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            k = bisect_left(rooms, length)
            if k == len(rooms):  # nowhere to go: open as many as are needed
                per = capacity // length
                full, rest = divmod(left, per)
                if full:
                    put(capacity - per * length, full, ((length, per),))
                if rest:
                    put(capacity - rest * length, 1, ((length, rest),))
                break
            room = rooms[k]
            times, content = open_[room].pop()
            if not open_[room]:
                del open_[room]
                rooms.pop(k)
            per = room // length
            full = min(times, left // per)
            if full:
                put(room - per * length, full, (*content, (length, per)))
                left -= full * per
            if full < times:
                rest = min(left, per) if left < per else 0
                if rest:
                    put(room - rest * length, 1, (*content, (length, rest)))
                    left -= rest
                if times - full - bool(rest):
                    put(room, times - full - bool(rest), content)
    return [x for alike in open_.values() for x in alike]


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Rows (length, first rank, pieces per sequence, first sequence, offset), by length and
    rank: where the pieces of a length go.  At most a few rows per length and pattern."""
    fixed, left = reduce_histogram(histogram, capacity)
    patterns = [(times, tuple((x, lengths.count(x)) for x in dict.fromkeys(lengths))) for times, lengths in fixed]
    used = dict.fromkeys(histogram, 0)
    rows, sequence = [], 0
    for times, content in patterns + best_fit(left, capacity):
        offset = 0
        for length, per in content:
            rows.append((length, used[length], per, sequence, offset))
            used[length] += times * per
            offset += per * length
        sequence += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def place(table: np.ndarray, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of pieces given their length and rank among equal lengths."""
    order = np.lexsort((rank, length))
    # merge the sorted pieces into the sorted plan, length by length
    sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
    for k in np.unique(length):
        rows = table[np.searchsorted(table[:, 0], k):np.searchsorted(table[:, 0], k, side="right")]
        mine = order[np.searchsorted(length[order], k):np.searchsorted(length[order], k, side="right")]
        row = rows[np.searchsorted(rows[:, 1], rank[mine], side="right") - 1]
        nth = rank[mine] - row[:, 1]
        sequence[mine] = row[:, 3] + nth // row[:, 2]
        offset[mine] = row[:, 4] + nth % row[:, 2] * k
    return sequence, offset


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text",
         with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids]) of every piece."""
    cut = checkpoint(pieces(docs, path, capacity, id_col, text_col, with_ids))
    counts = checkpoint(cut.groupBy("length", "task").agg(F.count("*").alias("n")))
    histogram = {r["length"]: r["n"] for r in
                 counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # capacity rows at most
    table = plan(histogram, capacity)
    before = counts.select("length", "task", (F.sum("n").over(
        Window.partitionBy("length").orderBy("task")) - F.col("n")).alias("before"))
    ranked = cut.join(before, ["length", "task"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("rank"),
        *["ids"] * with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = place(table, batch.column(3).to_numpy(), batch.column(5).to_numpy())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset), *batch.columns[6:]],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] + ["ids"] * with_ids)

    return ranked.mapInArrow(tidy(run), f"doc_id {dict(cut.dtypes)['doc_id']}, piece int, start long, length long, "
                                  "ids_crc32 long, sequence_id long, offset long" + ", ids array<int>" * with_ids)
