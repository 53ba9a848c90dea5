"""Byte-level BPE: corpus-level merge replay over a vocabulary of ranks.

A block of documents is cut into words by the vocabulary's pattern, and all its distinct words
are laid out as one array of byte tokens.  An inverted index maps the rank of a token pair to
the positions where the pair stands.  Ranks are taken in order; a merge rewrites its position,
unlinks the right neighbour and re-files only the two pairs it touches.  That equals merging
each word's lowest pair first: a pair that gets a rank not above the current one is taken
before the rest of the current rank's positions.

Words are remembered between the blocks of a task (a bounded number), so a word of the
vocabulary's long tail is replayed once a task at most as long as it stays known.

Defined results: a null or empty text has no tokens; other columns are not read; repeated rows
are coded row by row; a text holding characters the class tables are not sure of is cut by the
pattern itself; a very long text is cut and coded in parts; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termlens.llm.common import blocks, expand, tidy
from termlens.llm.pretokens import WordCoder

SHIFT = 20


class Vocabulary:
    """Ranks from a file of lines ``base64(token) rank``; ``pattern`` cuts texts into words."""

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.pattern = regex.compile(pattern)
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        self.pairs: dict[int, int] = {}
        for token, rank in self.ranks.items():
            for k in range(1, len(token)):
                left, right = self.ranks.get(token[:k]), self.ranks.get(token[k:])
                if left is not None and right is not None:
                    self.pairs[left << SHIFT | right] = rank
        self.byte_pairs = np.full((256, 256), -1, np.int64)
        for a in range(256):
            for b in range(256):
                self.byte_pairs[a, b] = self.ranks.get(bytes([a, b]), -1)
        size = max(self.ranks.values()) + 1
        self.token_size = np.zeros(size, np.int64)
        for token, rank in self.ranks.items():
            self.token_size[rank] = len(token)
        self.token_at = np.cumsum(self.token_size) - self.token_size
        by_rank = sorted((rank, token) for token, rank in self.ranks.items())
        self.token_bytes = np.frombuffer(b"".join(t for _, t in by_rank), dtype=np.uint8)

    def encode_words(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, ids per word) of distinct words: whole tokens first, the rest replayed."""
        data = [w.encode("utf-8") for w in words]
        whole = [self.ranks.get(d, -1) for d in data]
        rest = [d for d, r in zip(data, whole) if r < 0 and d]
        flat, size = self.replay(rest)
        sizes = np.array([1 if r >= 0 else 0 for r in whole], dtype=np.int64)
        ids = np.zeros(len(words), np.int64)
        is_rest = np.array([r < 0 and bool(d) for d, r in zip(data, whole)], dtype=bool)
        sizes[is_rest] = size
        ids[~is_rest] = [r for r, x in zip(whole, is_rest) if not x]
        out = np.empty(int(sizes.sum()), np.uint32)
        starts = np.cumsum(sizes) - sizes
        single = ~is_rest & (sizes > 0)
        out[starts[single]] = ids[single]
        out[expand(starts[is_rest], sizes[is_rest])] = flat
        return out, sizes

    def replay(self, words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All merges of all words, in rank order, over one inverted index."""
        if not words:
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        raw = np.frombuffer(b"".join(words), dtype=np.uint8)
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        starts = np.cumsum(sizes) - sizes
        n = len(raw)
        follow, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        follow[starts + sizes - 1] = -1
        before[starts] = -1
        pair = np.full(n, -1, np.int64)
        pair[:-1] = self.byte_pairs[raw[:-1], raw[1:]]
        pair[starts + sizes - 1] = -1
        order = np.argsort(pair, kind="stable")
        order = order[np.searchsorted(pair[order], 0):]
        kinds, at = np.unique(pair[order], return_index=True)
        index = {int(k): part.tolist() for k, part in zip(kinds, np.split(order, at[1:]))}
        queue = list(index)  # ascending: a heap
        token, rank_at = self.byte[raw].tolist(), pair.tolist()
        nxt, prv, find = follow.tolist(), before.tolist(), self.pairs.get
        while queue:
            rank = heapq.heappop(queue)
            todo = index.pop(rank, None)
            if todo is None:
                continue
            todo.sort()
            for done, i in enumerate(todo):
                if rank_at[i] != rank:
                    continue  # a neighbour's merge has taken it
                j = nxt[i]
                k = nxt[j]
                token[i], token[j], rank_at[j] = rank, -1, -1
                nxt[i] = k
                lowest = rank + 1
                if k >= 0:
                    prv[k] = i
                    made = find(rank << SHIFT | token[k], -1)
                    rank_at[i] = made
                    if made >= 0:
                        if made < lowest:
                            lowest = made
                        if made in index:
                            index[made].append(i)
                        else:
                            index[made] = [i]
                            heapq.heappush(queue, made)
                else:
                    rank_at[i] = -1
                p = prv[i]
                if p >= 0:
                    made = find(token[p] << SHIFT | rank, -1)
                    rank_at[p] = made
                    if made >= 0:
                        if made < lowest:
                            lowest = made
                        if made in index:
                            index[made].append(p)
                        else:
                            index[made] = [p]
                            heapq.heappush(queue, made)
                if lowest <= rank:  # that pair comes before what is left of this rank
                    index.setdefault(rank, []).extend(todo[done + 1:])
                    heapq.heappush(queue, rank)
                    break
        left = np.array(token, dtype=np.int64)
        kept = left >= 0
        return left[kept].astype(np.uint32), np.add.reduceat(kept.astype(np.int64), starts)

    def slow(self, text: str) -> np.ndarray:
        """Ids of a text cut by the pattern itself."""
        return self.encode_words(self.pattern.findall(text))[0]

    def decode(self, ids: np.ndarray) -> bytes:
        ids = ids.astype(np.int64)
        return self.token_bytes[expand(self.token_at[ids], self.token_size[ids])].tobytes()


@lru_cache(maxsize=2)
def vocabulary(path: str, pattern: str) -> Vocabulary:
    """Loaded once per Python worker."""
    return Vocabulary(path, pattern)


def _texts(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): the token ids of every whole text."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path, pattern)
        coder = WordCoder(vocab.encode_words)
        for block in blocks(batches):
            ids = coder.ids(_texts(block.column(1)), True, vocab.slow)
            offsets = pa.array(np.r_[0, np.cumsum([len(x) for x in ids])].astype(np.int32))
            flat = pa.array(np.concatenate(ids).astype(np.int32))
            yield pa.RecordBatch.from_arrays([block.column(0), pa.ListArray.from_arrays(offsets, flat)],
                                             names=["doc_id", "ids"])

    return rows.mapInArrow(tidy(run), f"doc_id {dict(rows.dtypes)['doc_id']}, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded): the bytes the ids stand for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path, pattern)
        for batch in blocks(batches, "ids", 1 << 18):
            ids = [np.asarray(x.values if x.is_valid else [], dtype=np.uint32) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(x) for x in ids], pa.int64()),
                pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids]),
                pa.array([vocab.decode(x) for x in ids], pa.binary()),
            ], names=["doc_id", "n_tokens", "ids_sha256", "decoded"])

    kind = dict(encoded.dtypes)["doc_id"]
    return encoded.select("doc_id", "ids").mapInArrow(
        tidy(run), f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded binary")
