"""Cutting texts into words the way byte-pair tokenizers do, for whole blocks in numpy.

Two cutting rules are offered: ``spaced`` is the pattern of ``public_tokenizers.PATTERN`` (one
blank may lead a word, white space is kept), ``plain`` the one of lower-cased word
vocabularies (white space dropped, digits apart).  Characters are classed by their Unicode
category where the Unicode 3.2 tables and today's give the same class, so that all libraries
agree on them; a text holding any other character is left to the caller's own slower, exact way.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np

from termlens.llm.common import expand, mix

OTHER, LETTER, NUMBER, SPACE, UNSURE = 0, 1, 2, 3, 9
# fixed values: code points with the Unicode property White_Space
WHITE_SPACE = (9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F,
               0x3000)
# fixed values: contractions of the patterns
SHORT, LONG = "stmd", ("re", "ve", "ll")
BASE = 0x9E3779B97F4A7C15
LONG_WORD = 256
TABLE = 1 << 20
PART = 1 << 19
BLANK = re.compile(r"(?<=\S) (?=\S)")


@lru_cache(maxsize=2)
def class_table(lowered: bool) -> np.ndarray:
    """Class of each code point; ``lowered`` also distrusts what lower-casing treats by
    context or writes as several characters."""
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.full(0x20001, UNSURE, np.uint8)
    for point in range(0x20000):
        c = chr(point)
        now = kinds.get(unicodedata.category(c)[0], OTHER)
        same = now == kinds.get(unicodedata.ucd_3_2_0.category(c)[0], OTHER)
        if same and unicodedata.category(c) != "Cn":
            table[point] = now
        if lowered and len(c.lower()) != 1:
            table[point] = UNSURE
    table[list(WHITE_SPACE)] = SPACE
    if lowered:
        table[[0x3A3, 0x3C2]] = UNSURE  # the sigma at a word's end
    return table


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(size, BASE, np.uint64)
    down = np.full(size, pow(BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``BASE`` and of its inverse modulo 2**64, ``n`` at least.  One table serves
    all blocks; only a text longer than a block makes a larger one."""
    return _powers(max(TABLE, 1 << int(n).bit_length()))


def cut(texts: Sequence[str], spaced: bool) -> tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(joined text, word starts, word ends, text of each word, whether each text is sure);
    words of sure texts only."""
    joined = "".join(texts)
    points = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
    n = len(points)
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    begins = np.cumsum(lengths) - lengths
    table = class_table(not spaced)
    kind = table[np.minimum(points, len(table) - 1)]
    sure = np.ones(len(texts), bool)
    odd = np.flatnonzero(kind == UNSURE)
    if len(odd):
        sure[np.searchsorted(begins + lengths, odd, side="right")] = False
    if not n:
        none = np.empty(0, np.int64)
        return joined, none, none, none, sure
    first = np.zeros(n, bool)
    first[begins[lengths > 0]] = True
    start = first.copy()
    start[1:] |= kind[1:] != kind[:-1]
    if not spaced:
        start |= kind == NUMBER
    # contractions: an apostrophe that opens a run of other characters
    opens = (points == 39) & start
    if spaced:
        opens[1:] &= (points[:-1] != 32) | first[1:]
    at = np.flatnonzero(opens)
    if len(at):
        tail = np.r_[points, 0, 0]
        inside = np.r_[~first, False, False]
        one, two = tail[at + 1], tail[at + 2]
        in_one = inside[at + 1]
        in_two = in_one & inside[at + 2]
        size = np.where(in_one & np.isin(one, [ord(c) for c in SHORT]), 2, 0)
        for pair in LONG:
            size = np.where(in_two & (one == ord(pair[0])) & (two == ord(pair[1])), 3, size)
        at, size = at[size > 0], size[size > 0]
        start[at + 1] = False
        after = at + size
        start[after[after < n]] = True
    if spaced:
        # the last of a run of white space before a word stands alone, or leads the word if a blank
        ends = np.flatnonzero((kind[1:] != SPACE) & (kind[:-1] == SPACE) & ~first[1:]) + 1
        start[ends - 1] = True
        start[ends[points[ends - 1] == 32]] = False
    starts = np.flatnonzero(start)
    stops = np.r_[starts[1:], n]
    if not spaced:
        word = kind[starts] != SPACE
        starts, stops = starts[word], stops[word]
    owner = np.searchsorted(begins + lengths, starts, side="right")
    if len(odd):
        known = sure[owner]
        starts, stops, owner = starts[known], stops[known], owner[known]
    return joined, starts, stops, owner, sure


def word_hashes(joined: str, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word: polynomial over its code points, finalised; words long
    enough for constructed collisions take a cryptographic hash."""
    points = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64) + np.uint64(1)
    up, down = powers(len(points) + 1)
    total = np.empty(len(points) + 1, np.uint64)
    total[0] = 0
    np.cumsum(points * up[:len(points)], out=total[1:])
    size = (stops - starts).astype(np.uint64)
    out = mix((total[stops] - total[starts]) * down[starts] + size * np.uint64(0xD6E8FEB86659FD93))
    for k in np.flatnonzero(size > LONG_WORD):
        digest = hashlib.blake2b(joined[starts[k]:stops[k]].encode(), digest_size=8).digest()
        out[k] = int.from_bytes(digest, "little")
    return out


def text_parts(text: str, size: int = PART) -> Iterator[str]:
    """The text cut into parts of about ``size`` characters, before single blanks between
    other characters: there a word of either rule begins."""
    at = 0
    while len(text) - at > size and (blank := BLANK.search(text, at + size)):
        yield text[at:blank.start()]
        at = blank.start()
    yield text[at:]


class WordCoder:
    """Ids of words, each distinct word of a block encoded once and remembered up to
    ``limit`` words.  ``encode(words) -> (flat ids, ids per word)`` does the work."""

    def __init__(self, encode, limit: int = 1 << 19):
        self.encode, self.limit = encode, limit
        self.hash = np.empty(0, np.uint64)
        self.at = self.size = np.empty(0, np.int64)
        self.flat = np.empty(0, np.uint32)

    def ids(self, texts: Sequence[str], spaced: bool, slow, normal=None) -> list[np.ndarray]:
        """The ids of every text, normalised by ``normal`` first; ``slow(text)`` serves texts the
        tables are not sure of and texts that hold one of ``slow.literals``, if it has any.  Long
        texts are coded in parts, about ``PART`` characters together."""
        parts = [list(text_parts(t)) for t in texts]
        flat = [p for own in parts for p in own]
        size = np.cumsum([len(p) for p in flat])
        cuts = [0, *(np.flatnonzero(np.diff(size // PART)) + 1).tolist(), len(flat)]
        found = [ids for a, b in zip(cuts, cuts[1:]) for ids in self._ids(flat[a:b], spaced, slow, normal)]
        out, at = [], 0
        for own in parts:
            out.append(found[at] if len(own) == 1 else np.concatenate(found[at:at + len(own)]))
            at += len(own)
        return out

    def _ids(self, raw: Sequence[str], spaced: bool, slow, normal) -> list[np.ndarray]:
        texts = [normal(t) for t in raw] if normal else raw
        literals = getattr(slow, "literals", ())
        held = np.array([any(x in t or x in r for x in literals) for t, r in zip(texts, raw)], bool)
        joined, starts, stops, owner, sure = cut(["" if h else t for t, h in zip(texts, held)], spaced)
        sure &= ~held
        hashes = word_hashes(joined, starts, stops)
        distinct, lead, back = np.unique(hashes, return_index=True, return_inverse=True)
        place = np.searchsorted(self.hash, distinct)
        known = place < len(self.hash)
        known[known] = self.hash[place[known]] == distinct[known]
        new = np.flatnonzero(~known)
        if len(new):
            if len(self.hash) + len(new) > self.limit:  # forget, and code this block's words anew
                self.hash, self.at, self.size = self.hash[:0], self.at[:0], self.size[:0]
                self.flat, new = self.flat[:0], np.arange(len(distinct))
            words = [joined[a:b] for a, b in zip(starts[lead[new]].tolist(), stops[lead[new]].tolist())]
            flat, size = self.encode(words)
            at = len(self.flat) + np.cumsum(size) - size
            self.flat = np.concatenate([self.flat, flat])
            merged = np.concatenate([self.hash, distinct[new]])
            order = np.argsort(merged)
            self.hash = merged[order]
            self.at = np.concatenate([self.at, at])[order]
            self.size = np.concatenate([self.size, size])[order]
            place = np.searchsorted(self.hash, distinct)
        size = self.size[place][back]
        flat = self.flat[expand(self.at[place][back], size)]
        per_text = np.bincount(owner, weights=size, minlength=len(texts)).astype(np.int64)
        cuts = np.r_[0, np.cumsum(per_text)]
        return [flat[a:b] if s else np.asarray(slow(t), dtype=np.uint32)
                for t, s, a, b in zip(raw, sure, cuts[:-1].tolist(), cuts[1:].tolist())]
