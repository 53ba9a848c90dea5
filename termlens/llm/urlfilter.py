"""URL filters: a bit-parallel wildcard automaton (Shift-And with wildcard loops).

Every rule is a glob over the canonical URL ``.host/path``.  ``*`` stands for any run of
characters without ``/``, ``**`` for any run at all.  The globs are packed one after the
other into multiword bit masks; one shift, one AND and one OR per character advance all of
them, and numpy advances all URLs of an Arrow batch together, so a row costs its own
length times the number of mask words, whatever the number of rules that match.

A host rule (``host``, ``path``) is the glob ``*.host`` + ``path`` + ``**`` over the
canonical URL with a leading dot: it fits the host and all its subdomains.  Of the rules
that match, the longest (``host`` + ``path``, then the smaller string) gives the verdict;
a URL no rule matches gets ``default``.

Defined results: a null URL, or one without ``://``, has an empty host and path, matches no
rule and gets ``default``; repeated rows each get their row; other columns of the input,
whatever their names, are not read; a very long URL is matched whole, one character a step; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOOP_NOT_SLASH, LOOP_ANY = 1, 2
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    @property
    def glob(self) -> str:
        return f"*.{self.host}{self.path}**"


class Automaton:
    """Shift-And masks of all globs.  Bit ``k`` of the state is set when the glob's first
    ``k`` characters (counted from its own initial bit) have been matched."""

    def __init__(self, globs: Sequence[str]):
        init, accept, loops = [], [], {}
        literal: dict[int, str] = {}
        n = 0
        for g in globs:
            init.append(n)
            i = 0
            while i < len(g):
                if g[i] == "*":
                    wide = g[i:i + 2] == "**"
                    loops[n] = max(loops.get(n, 0), LOOP_ANY if wide else LOOP_NOT_SLASH)
                    i += 1 + wide
                else:
                    n += 1
                    literal[n] = g[i]
                    i += 1
            accept.append(n)
            n += 1
        self.words = max(1, -(-n // 64))
        self.alphabet = {c: k for k, c in enumerate(sorted({*literal.values(), "/"}), start=1)}
        size = len(self.alphabet) + 1
        step, loop = np.zeros((size, self.words), np.uint64), np.zeros((size, self.words), np.uint64)
        for bit, c in literal.items():
            self._set(step[self.alphabet[c]], bit)
        for bit, kind in loops.items():
            for k in range(size):
                if kind == LOOP_ANY or k != self.alphabet["/"]:
                    self._set(loop[k], bit)
        self.step, self.loop, self.accept = step, loop, accept
        self.init = np.zeros(self.words, np.uint64)
        for bit in init:
            self._set(self.init, bit)

    @staticmethod
    def _set(mask: np.ndarray, bit: int) -> None:
        mask[bit // 64] |= np.uint64(1 << (bit % 64))

    def classes(self, urls: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """All code points as symbol classes in one array, and the length of each URL."""
        text = "".join(urls)
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        table = np.zeros(max(map(ord, self.alphabet)) + 2, np.uint8 if len(self.alphabet) < 255 else np.int32)
        for c, k in self.alphabet.items():
            table[ord(c)] = k
        return table[np.minimum(points, len(table) - 1)], np.array([len(u) for u in urls], dtype=np.int64)

    def match(self, urls: Sequence[str]) -> np.ndarray:
        """Boolean matrix: URL x glob."""
        symbols, lengths = self.classes(urls)
        order = np.argsort(-lengths, kind="stable")
        starts = (np.cumsum(lengths) - lengths)[order]
        longest = lengths[order]
        state = np.tile(self.init, (len(urls), 1))
        alive = len(urls)
        for t in range(int(longest[0]) if len(urls) else 0):
            while alive and longest[alive - 1] <= t:
                alive -= 1
            s = symbols[starts[:alive] + t]
            d = state[:alive]
            shifted = d << np.uint64(1)
            if self.words > 1:
                shifted[:, 1:] |= d[:, :-1] >> np.uint64(63)
            state[:alive] = (shifted & self.step[s]) | (d & self.loop[s])
        out = np.empty((len(urls), len(self.accept)), dtype=bool)
        for k, bit in enumerate(self.accept):
            out[order, k] = (state[:, bit // 64] >> np.uint64(bit % 64)) & np.uint64(1) == 1
        return out


def canonical(df: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path): the host is what stands after the first ``://`` up to ``/``,
    ``?``, ``#`` or the end, A-Z lower-cased; the path runs on to ``?``, ``#`` or the end."""
    url = F.col(url_col)
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))
    host = F.regexp_extract("rest", r"^[^/?#]*+", 0)
    return (
        df.select(F.col(id_col).alias("page_id"), F.coalesce(rest, F.lit("")).alias("rest"))
        .select("page_id", F.translate(host, UPPER, LOWER).alias("host"),
                F.regexp_extract("rest", r"^[^/?#]*+([^?#]*+)", 1).alias("path"))
    )


def judge(df: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url",
          default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict, n_matched) of every row."""
    ranked = sorted(rules, key=lambda r: (-len(r.name), r.name))
    globs = [r.glob for r in ranked]
    urls = canonical(df, id_col, url_col)
    kind = dict(urls.dtypes)["page_id"]
    names = [r.name for r in ranked]
    verdicts = [r.verdict for r in ranked]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(globs)
        for batch in batches:
            hosts, paths = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            hit = automaton.match([f".{h}{p}" if h or p else "" for h, p in zip(hosts, paths)])
            any_hit = hit.any(axis=1) if names else np.zeros(len(hosts), bool)
            first = hit.argmax(axis=1) if names else np.zeros(len(hosts), int)
            yield pa.RecordBatch.from_arrays([
                *batch.columns,
                pa.array([names[k] if a else None for a, k in zip(any_hit, first)], pa.string()),
                pa.array([verdicts[k] if a else default for a, k in zip(any_hit, first)], pa.string()),
                pa.array(hit.sum(axis=1), pa.int32()),
            ], names=["page_id", "host", "path", "rule", "verdict", "n_matched"])

    return urls.mapInArrow(run, f"page_id {kind}, host string, path string, rule string, verdict string, n_matched int")
