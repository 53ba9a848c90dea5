"""The Porter stemmer (M.F. Porter, "An algorithm for suffix stripping", 1980).

Follows the author's reference C release, including its two published departures from
the paper ("bli" -> "ble" instead of "abli" -> "able", and "logi" -> "log"), and leaves
words of one or two characters alone.  Any character other than a, e, i, o, u (and a
"y" after a vowel) counts as a consonant, so digits and apostrophes pass through.

The stemmer is a per-word helper.  Spark applies it through an Arrow UDF over arrays of
lower-cased words: each Arrow batch is dictionary-encoded, so Python stems each distinct
word of the batch once and the result is gathered back in Arrow.
"""

from __future__ import annotations

import sys

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


class _Word:
    __slots__ = ("b", "k", "j")

    def __init__(self, word: str):
        self.b = list(word)
        self.k = len(word) - 1
        self.j = 0

    def cons(self, i: int) -> bool:
        ch = self.b[i]
        if ch in "aeiou":
            return False
        if ch == "y":  # a consonant at the start or after a vowel; runs of y alternate
            first = i
            while first and self.b[first - 1] == "y":
                first -= 1
            at_first = first == 0 or self.b[first - 1] in "aeiou"
            return at_first if (i - first) % 2 == 0 else not at_first
        return True

    def m(self) -> int:
        """Number of vowel-consonant sequences in b[0..j]."""
        n, i, j = 0, 0, self.j
        while True:
            if i > j:
                return n
            if not self.cons(i):
                break
            i += 1
        i += 1
        while True:
            while True:
                if i > j:
                    return n
                if self.cons(i):
                    break
                i += 1
            i += 1
            n += 1
            while True:
                if i > j:
                    return n
                if not self.cons(i):
                    break
                i += 1
            i += 1

    def vowel_in_stem(self) -> bool:
        return any(not self.cons(i) for i in range(self.j + 1))

    def double_c(self, j: int) -> bool:
        return j >= 1 and self.b[j] == self.b[j - 1] and self.cons(j)

    def cvc(self, i: int) -> bool:
        if i < 2 or not self.cons(i) or self.cons(i - 1) or not self.cons(i - 2):
            return False
        return self.b[i] not in "wxy"

    def ends(self, s: str) -> bool:
        n = len(s)
        if n > self.k + 1:
            return False
        if "".join(self.b[self.k - n + 1:self.k + 1]) != s:
            return False
        self.j = self.k - n
        return True

    def set_to(self, s: str) -> None:
        self.b[self.j + 1:] = list(s)
        self.k = self.j + len(s)

    def r(self, s: str) -> None:
        if self.m() > 0:
            self.set_to(s)

    def step1ab(self) -> None:
        b = self.b
        if b[self.k] == "s":
            if self.ends("sses"):
                self.k -= 2
            elif self.ends("ies"):
                self.set_to("i")
            elif self.k >= 1 and b[self.k - 1] != "s":
                self.k -= 1
            del b[self.k + 1:]
        if self.ends("eed"):
            if self.m() > 0:
                self.k -= 1
        elif (self.ends("ed") or self.ends("ing")) and self.vowel_in_stem():
            self.k = self.j
            del b[self.k + 1:]
            if self.ends("at"):
                self.set_to("ate")
            elif self.ends("bl"):
                self.set_to("ble")
            elif self.ends("iz"):
                self.set_to("ize")
            elif self.double_c(self.k):
                self.k -= 1
                if b[self.k] in "lsz":
                    self.k += 1
            elif self.m() == 1 and self.cvc(self.k):
                self.set_to("e")
        del b[self.k + 1:]

    def step1c(self) -> None:
        if self.ends("y") and self.vowel_in_stem():
            self.b[self.k] = "i"

    # Suffix tables of steps 2-4 are fixed values of the algorithm, keyed by the
    # penultimate (steps 2, 4) or last (step 3) letter; the first suffix that matches
    # decides, whether or not its measure condition then holds.
    STEP2 = {
        "a": (("ational", "ate"), ("tional", "tion")),
        "c": (("enci", "ence"), ("anci", "ance")),
        "e": (("izer", "ize"),),
        "l": (("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous")),
        "o": (("ization", "ize"), ("ation", "ate"), ("ator", "ate")),
        "s": (("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous")),
        "t": (("aliti", "al"), ("iviti", "ive"), ("biliti", "ble")),
        "g": (("logi", "log"),),
    }
    STEP3 = {
        "e": (("icate", "ic"), ("ative", ""), ("alize", "al")),
        "i": (("iciti", "ic"),),
        "l": (("ical", "ic"), ("ful", "")),
        "s": (("ness", ""),),
    }
    STEP4 = {
        "a": ("al",),
        "c": ("ance", "ence"),
        "e": ("er",),
        "i": ("ic",),
        "l": ("able", "ible"),
        "n": ("ant", "ement", "ment", "ent"),
        "o": ("ion", "ou"),
        "s": ("ism",),
        "t": ("ate", "iti"),
        "u": ("ous",),
        "v": ("ive",),
        "z": ("ize",),
    }

    def _replace(self, table, key) -> None:
        for suffix, repl in table.get(key, ()):
            if self.ends(suffix):
                self.r(repl)
                return

    def step2(self) -> None:
        if self.k >= 1:
            self._replace(self.STEP2, self.b[self.k - 1])

    def step3(self) -> None:
        self._replace(self.STEP3, self.b[self.k])

    def step4(self) -> None:
        if self.k < 1:
            return
        for suffix in self.STEP4.get(self.b[self.k - 1], ()):
            if self.ends(suffix):
                if suffix == "ion" and not (self.j >= 0 and self.b[self.j] in "st"):
                    continue
                break
        else:
            return
        if self.m() > 1:
            self.k = self.j

    def step5(self) -> None:
        self.j = self.k
        if self.b[self.k] == "e":
            a = self.m()
            if a > 1 or (a == 1 and not self.cvc(self.k - 1)):
                self.k -= 1
        if self.b[self.k] == "l" and self.double_c(self.k) and self.m() > 1:
            self.k -= 1

    def result(self) -> str:
        return "".join(self.b[: self.k + 1])


def porter_stem(word: str) -> str:
    """Stem one lower-case word."""
    if word is None or len(word) <= 2:
        return word
    w = _Word(word)
    w.step1ab()
    if w.k >= 1:
        w.step1c()
        w.step2()
        del w.b[w.k + 1:]
        w.step3()
        del w.b[w.k + 1:]
        w.step4()
        del w.b[w.k + 1:]
        w.step5()
    return w.result()


_CACHE: dict = {}
_CACHE_LIMIT = 1 << 20


def _stem_dictionary(words: list) -> list:
    """Stems of a batch's distinct words, memoised per Python worker (bounded)."""
    if len(_CACHE) > _CACHE_LIMIT:
        _CACHE.clear()
    out = []
    for w in words:
        s = _CACHE.get(w)
        if s is None:
            s = _CACHE[w] = porter_stem(w)
        out.append(s)
    return out


@F.arrow_udf(T.ArrayType(T.StringType()))
def _stem_arrays(words: pa.Array) -> pa.Array:
    """Arrow in, Arrow out: the batch's words are dictionary-encoded, only the
    dictionary (its distinct words) is stemmed in Python, and the stems are gathered
    back into the original list layout."""
    flat = pc.list_flatten(words)
    enc = pc.dictionary_encode(flat).combine_chunks() if isinstance(flat, pa.ChunkedArray) \
        else pc.dictionary_encode(flat)
    stems = pa.array(_stem_dictionary(enc.dictionary.to_pylist()), pa.string())
    values = stems.take(enc.indices)
    offsets = pc.subtract(words.offsets, words.offsets[0])
    return pa.ListArray.from_arrays(offsets, values, mask=words.is_null())


# Ship this module's code with the UDF, so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def stem_words(words) -> Column:
    """Porter stems of an array<string> of lower-case words, element by element."""
    return _stem_arrays(F.col(words) if isinstance(words, str) else words)

