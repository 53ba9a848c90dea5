"""Language identification: scripts narrow, words score, Viterbi labels spans.

Training counts hashed character n-grams (1 to 3, with word edges) per language over a bounded
sample of the distinct labelled texts: about ``TRAIN_ROWS`` of each language, chosen by a hash
of the text; copies count once.  The ``MAX_LANGUAGES`` languages with most distinct texts are learned
(ties: the name that sorts first), so dirty labels do not grow the model.
The model is one table of log probabilities per language and bucket, the share of each
script in a language's letters, and the mean log probability of each language's own n-grams.

Prediction cuts a text into words (runs of letters).  A word's candidates are the languages
that use its script; its score for each is the mean log probability of its n-grams, times the square
root of its length.  A Viterbi pass over the words, paying ``SWITCH`` for a change of language,
labels every word; the spans are the runs of one label.  The text's language is the one with
most letters, its score that language's share of the letters.

All steps of a block of texts run together in numpy: the pass advances every text of the block
by one word at a time.

Defined results: a null text, or one without letters, is ``und`` with score 0; ties go to the
language that sorts first; without training rows every text is ``und``; null labels are not
learned; repeated rows are predicted row by row; the label, source and id are never read when
predicting; an empty table gives no rows.  A very long text is scored in parts and labelled by one
pass over all its words; ``identify`` reads no columns but its own, and ``keep_identified`` hands on
all columns, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termlens.llm.common import blocks, expand, tidy
from termlens.llm.pretokens import PART, text_parts

BUCKETS, TRAIN_ROWS, MAX_LANGUAGES, SWITCH, SMOOTH, MIN_SCRIPT = 1 << 16, 2000, 512, 6.0, 0.5, 0.01
#: A text of ``MIN_LETTERS`` letters or more is foreign if its n-grams are on average ``exp(MAX_LOSS)`` times
#: less likely than the n-grams of its languages' own training texts.
MIN_LETTERS, MAX_LOSS = 50, 2.0
UNKNOWN = "und"
# fixed values: first and last code points of the scripts told apart; all other letters are one more
SCRIPTS = (
    ("latin", 0x0041, 0x024F), ("greek", 0x0370, 0x03FF), ("cyrillic", 0x0400, 0x052F),
    ("armenian", 0x0530, 0x058F), ("hebrew", 0x0590, 0x05FF), ("arabic", 0x0600, 0x077F),
    ("devanagari", 0x0900, 0x097F), ("bengali", 0x0980, 0x09FF), ("tamil", 0x0B80, 0x0BFF),
    ("thai", 0x0E00, 0x0E7F), ("georgian", 0x10A0, 0x10FF), ("latin", 0x1E00, 0x1EFF),
    ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x9FFF), ("hangul", 0xAC00, 0xD7AF),
)
SCRIPT_NAMES = tuple(dict.fromkeys(["other", *(name for name, _, _ in SCRIPTS)]))


@lru_cache(maxsize=1)
def letter_tables() -> tuple[np.ndarray, np.ndarray]:
    """(is a letter, script) of each code point."""
    letters = np.array([chr(p).isalpha() for p in range(0x40000)] + [False])
    script = np.zeros(len(letters), np.int8)
    for name, low, high in SCRIPTS:
        script[low:high + 1] = SCRIPT_NAMES.index(name)
    return letters, script


@dataclass
class Words:
    """The words of a block of texts: place in the text, owner, script, hashed n-grams."""

    owner: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    script: np.ndarray
    grams: np.ndarray
    first_gram: np.ndarray
    n_texts: int

    @staticmethod
    def of(texts: list[str]) -> Words:
        letters, scripts = letter_tables()
        # a text's letters may change their number when lower-cased: spans refer to the lowered text
        low = [t.lower() for t in texts]
        points = np.frombuffer("\0".join([*low, ""]).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        sizes = np.fromiter(map(len, low), dtype=np.int64, count=len(low)) + 1
        begins = np.cumsum(sizes) - sizes
        inside = letters[np.minimum(points, len(letters) - 1)]
        edge = np.diff(np.r_[False, inside, False].astype(np.int8))
        start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        owner = np.searchsorted(begins, start, side="right") - 1
        # words with one mark on either side, one after the other
        size = stop - start
        width = size + 2
        at = np.cumsum(width) - width
        marked = np.full(int(width.sum()), 1, np.int64)
        marked[expand(at + 1, size)] = points[expand(start, size)]
        one = marked * 0x9E3779B1
        two = one[:-1] * 31 + marked[1:] * 0x85EBCA6B
        three = two[:-1] * 31 + marked[2:] * 0xC2B2AE35
        # n-grams of a word: its letters, its size + 1 pairs, its size triples
        count = 3 * size + 1
        first = np.cumsum(count) - count
        grams = np.empty(int(count.sum()), np.int32)
        for hashes, lead, shift, n in ((one, at + 1, 0, size), (two, at, size, size + 1), (three, at, 2 * size + 1, size)):
            value = hashes[expand(lead, n)]
            value = (value ^ (value >> 15)) * 0x2C1B3C6D
            grams[expand(first + shift, n)] = ((value ^ (value >> 17)) & (BUCKETS - 1)).astype(np.int32)
        return Words(owner, start - begins[owner], stop - begins[owner],
                     scripts[np.minimum(points[start], len(scripts) - 1)] if len(start) else np.empty(0, np.int8),
                     grams, first, len(texts))


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # language x bucket: log probability
    scripts: np.ndarray  # language x script: whether the language uses it
    own: np.ndarray  # language: mean log probability of an n-gram of its training texts

    def word_scores(self, words: Words) -> np.ndarray:
        """Language x word; a language that does not use the word's script is out unless no
        language uses it."""
        n = len(words.start)
        out = np.empty((len(self.languages), n), np.float32)
        letters = (words.stop - words.start).astype(np.float32)
        weight = np.sqrt(letters) / (3 * letters + 1)
        for k, row in enumerate(self.table):
            out[k] = np.add.reduceat(row[words.grams], words.first_gram) * weight if n else 0
        fits = self.scripts[:, words.script]
        out[~fits & fits.any(axis=0)] = -1e6
        return out

    def label(self, scores: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """The best path of every text.  Most texts keep one language throughout, which is
        proven without walking them: if no stretch of words gains another language more than
        a switch costs, and none at either end more than half of that, then no other path
        gains what its switches cost."""
        n = scores.shape[1]
        if not n:
            return np.empty(0, np.int64)
        new = np.r_[True, owner[1:] != owner[:-1]]
        first = np.flatnonzero(new)
        text = np.cumsum(new) - 1
        top = np.add.reduceat(scores.astype(float), first, axis=1).argmax(axis=0)
        label = top[text]
        own = scores[label, np.arange(n)].astype(float)
        mixed = np.zeros(len(first), bool)
        for row in scores:
            gain = np.cumsum(row - own)
            gain -= np.where(first > 0, gain[first - 1], 0)[text]
            before = gain - (row - own)
            apart = text * (np.ptp(before) + 1)  # a running minimum that starts anew with each text
            low = np.minimum.accumulate(before - apart) + apart
            total = gain[np.r_[first[1:], n] - 1]
            mixed |= ((np.maximum.reduceat(gain - low, first) > SWITCH)
                      | (np.maximum.reduceat(gain, first) > SWITCH / 2)
                      | (total - np.minimum.reduceat(before, first) > SWITCH / 2))
        walked = mixed[text]
        if walked.any():
            label[walked] = self.walk(scores[:, walked], text[walked])
        return label

    def walk(self, scores: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Viterbi over the words of each text, all texts side by side, one word at a time."""
        n_lang, n = scores.shape
        owner = np.unique(owner, return_inverse=True)[1]
        counts = np.bincount(owner)
        first = np.cumsum(counts) - counts
        order = np.argsort(-counts, kind="stable")
        lead, length = first[order], counts[order]
        alive = np.searchsorted(-length, -np.arange(1, int(length[0]) + 1 if n else 1), side="right")
        came = np.empty((n_lang, n), np.int8 if n_lang < 128 else np.int32)
        best = np.zeros((n_lang, len(counts)), np.float32)
        lanes = np.arange(n_lang)[:, None]
        for t in range(int(length[0]) if n else 0):
            m = alive[t]
            at = lead[:m] + t
            now = best[:, :m]
            if t:
                top = now.argmax(axis=0)
                now -= now.max(axis=0)  # only differences matter: keeps long texts exact
                stay = now >= -SWITCH
                came[:, at] = np.where(stay, lanes, top)
                np.maximum(now, -SWITCH, out=now)
            now += scores[:, at]
        label = np.empty(n, np.int32)
        state = best.argmax(axis=0)
        for t in range(int(length[0]) - 1 if n else -1, -1, -1):
            m = alive[t]
            at = lead[:m] + t
            label[at] = state[:m]
            if t:
                state[:m] = came[state[:m], at]
        return label

    def words_of(self, texts: list[str]) -> tuple[np.ndarray, ...]:
        """(owner, start, stop, scores) of all words, texts cut into parts of bounded size."""
        parts, of, shift = [], [], []
        for k, text in enumerate(texts):
            at = 0
            for part in text_parts(text.lower()):
                parts.append(part)
                of.append(k)
                shift.append(at)
                at += len(part)
        of, shift = np.array(of, np.int64), np.array(shift, np.int64)
        size = np.cumsum([len(p) for p in parts])
        cuts = [0, *(np.flatnonzero(np.diff(size // PART)) + 1).tolist(), len(parts)]
        found = []
        for a, b in zip(cuts, cuts[1:]):
            w = Words.of(parts[a:b])
            found.append((of[a:b][w.owner], w.start + shift[a:b][w.owner], w.stop + shift[a:b][w.owner], self.word_scores(w)))
        return tuple(np.concatenate(x, axis=-1) for x in zip(*found))

    def mostly_unknown(self, texts: list[str]) -> np.ndarray:
        """Whether more than half of a text's letters lie in scripts no learned language uses."""
        letters, scripts = letter_tables()
        unknown = ~self.scripts.any(axis=0)[scripts] & letters
        out = np.zeros(len(texts), bool)
        for k, text in enumerate(texts):
            strange = total = 0
            for part in text_parts(text.lower()):
                points = np.minimum(np.frombuffer(part.encode("utf-32-le"), dtype=np.uint32), len(letters) - 1)
                strange += int(unknown[points].sum())
                total += int(letters[points].sum())
            out[k] = 2 * strange > total
        return out

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, list[list[dict]]]:
        """(language, score, spans) of every text; a long text's words are scored in parts."""
        return self.judge(texts)[:3]

    def judge(self, texts: list[str]) -> tuple[list[str], np.ndarray, list[list[dict]], np.ndarray]:
        """As ``predict``, and whether the text is foreign to the languages it is labelled with."""
        nothing = np.zeros(len(texts))
        if not self.languages:
            return [UNKNOWN] * len(texts), nothing, [[] for _ in texts], nothing > 0
        owner, start, stop, scores = self.words_of(texts)
        n = len(start)
        if not n:
            return [UNKNOWN] * len(texts), nothing, [[] for _ in texts], nothing > 0
        label = self.label(scores, owner)
        letters = stop - start
        grams = 3 * letters + 1
        loss = (self.own[label] - scores[label, np.arange(n)] / np.sqrt(letters)) * grams
        size, lost, spelt = (np.bincount(owner, x, len(texts)) for x in (grams, loss, letters))
        foreign = (spelt >= MIN_LETTERS) & (lost > MAX_LOSS * size)
        share = np.zeros((len(texts), len(self.languages)), np.int64)
        np.add.at(share, (owner, label), letters)
        top, total = share.argmax(axis=1), share.sum(axis=1)
        score = share.max(axis=1) / np.maximum(total, 1)
        lang = [self.languages[k] if n_ else UNKNOWN for k, n_ in zip(top, total)]
        new = np.r_[True, (label[1:] != label[:-1]) | (owner[1:] != owner[:-1])]
        head = np.flatnonzero(new)
        tail = np.r_[head[1:], n] - 1
        spans: list[list[dict]] = [[] for _ in texts]
        for o, a, b, k in zip(owner[head].tolist(), start[head].tolist(), stop[tail].tolist(),
                              label[head].tolist()):
            spans[o].append({"start": a, "stop": b, "lang": self.languages[k]})
        return lang, score, spans, foreign


def _texts(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learn from the text and the label of rows whose label is not null.  The sample takes the
    same expected number of distinct texts of every language, by a hash of the text alone."""
    text, lang = F.col(text_col).cast("string"), F.col(lang_col).cast("string")
    rows = labelled.select(text.alias("text"), lang.alias("lang")).filter("text is not null and lang is not null")
    sizes = {r["lang"]: r["n"] for r in rows.select("lang", F.xxhash64("text").alias("h")).distinct()
             .groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((0, BUCKETS), np.float32), np.zeros((0, len(SCRIPT_NAMES)), bool), np.zeros(0))
    share = F.create_map(*[F.lit(x) for k in languages for x in (k, min(1.0, TRAIN_ROWS / sizes[k]))])
    draw = F.pmod(F.xxhash64("text"), F.lit(1_000_000)) / F.lit(1_000_000.0)
    sample = rows.filter(draw < F.coalesce(share[F.col("lang")], F.lit(0.0))).distinct()  # copies meet in the map tasks first
    index = {k: i for i, k in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = np.zeros((len(languages), BUCKETS), np.int64)
        scripts = np.zeros((len(languages), len(SCRIPT_NAMES)), np.int64)
        for block in blocks(batches):
            # (a labelled text longer than a block is counted whole: the sample is bounded)
            words = Words.of(_texts(block.column(0)))
            of = np.array([index[k] for k in block.column(1).to_pylist()])[words.owner]
            sizes_ = np.diff(np.r_[words.first_gram, len(words.grams)])
            np.add.at(grams, (np.repeat(of, sizes_), words.grams), 1)
            np.add.at(scripts, (of, words.script), words.stop - words.start)
        for kind, table in ((0, grams), (1, scripts)):
            k, at = np.nonzero(table)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(k), kind, np.int32)), pa.array(k.astype(np.int32)), pa.array(at.astype(np.int32)),
                 pa.array(table[k, at])], names=["kind", "lang", "bucket", "n"])

    grams = np.zeros((len(languages), BUCKETS))
    scripts = np.zeros((len(languages), len(SCRIPT_NAMES)))
    parts = sample.mapInArrow(tidy(count), "kind int, lang int, bucket int, n long")
    # languages x (buckets + scripts) rows at most, whatever the corpus
    for r in parts.groupBy("kind", "lang", "bucket").agg(F.sum("n").alias("n")).toLocalIterator():
        (scripts if r["kind"] else grams)[r["lang"], r["bucket"]] = r["n"]
    smooth = grams + SMOOTH
    table = np.log(smooth / smooth.sum(axis=1, keepdims=True)).astype(np.float32)
    own = (grams * table).sum(axis=1) / np.maximum(grams.sum(axis=1), 1)
    used = scripts / np.maximum(scripts.sum(axis=1, keepdims=True), 1) >= MIN_SCRIPT
    return Model(languages, table, used, own)


def held_out(id_col: Column) -> Column:
    """Whether a row is kept from training: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, spans); spans are code points of the lower-cased text."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages x buckets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            lang, score, spans = shared.value.predict(_texts(block.column(1)))
            yield pa.RecordBatch.from_arrays(
                [block.column(0), pa.array(lang, pa.string()), pa.array(score),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("lang", pa.string())])))],
                names=["doc_id", "lang_pred", "score", "spans"])

    schema = T.StructType([rows.schema["doc_id"], T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()), T.StructField("spans", T.ArrayType(T.StructType([
                               T.StructField("start", T.LongType()), T.StructField("stop", T.LongType()),
                               T.StructField("lang", T.StringType())])))])
    return rows.mapInArrow(tidy(run), schema)


def keep_identified(docs: DataFrame, min_score: float = 0.3, id_col: str = "doc_id", text_col: str = "text",
                    lang_col: str = "lang") -> DataFrame:
    """The rows whose text has a language holding at least ``min_score`` of its letters, at most half
    of them in scripts no learned language uses, and n-grams that are not foreign to its languages
    (``MAX_LOSS``: another language of the same script, random letters), with all columns of
    ``docs``; learned from the rows not held out."""
    model = train(docs.filter(~held_out(F.col(id_col))), text_col, lang_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text_col):
            texts = _texts(block.column(at))
            lang, score, _, foreign = shared.value.judge(texts)
            strange = shared.value.mostly_unknown(texts) | foreign
            yield block.filter(pa.array([k != UNKNOWN and s >= min_score and not x
                                         for k, s, x in zip(lang, score, strange.tolist())], pa.bool_()))

    return docs.mapInArrow(tidy(run), docs.schema)
