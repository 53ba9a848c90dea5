"""Byte-level BPE and packing against the tokenizer libraries and exact packings."""

import base64
import hashlib
import random
import zlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from termlens.llm import bpe, packing, pretokens
from termlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PARTS = ["'", "s", "t", "re", "ve", "m", "ll", "d", " ", "  ", "\n", "\t", " \n", "a", "B", "1", "23", "!", "''", "é", "ß", "中", "文",
         "\u200a", "\u3000", "😀", "Σ", "σ", "ς", "İ", "Ⅷ", "²", "े", "e\u0301", "x" * 40, "-", "==", "_", "\x1c", "\x85", "\xa0",
         "ǅ", "ﬁ", "Ꭰ", "ა", "Ა", "\u200b", "\u180e", "\U0001e900", "\0"]


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(autouse=True)
def short_parts(monkeypatch):
    """Long texts begin at 300 characters here, so that cutting them is tested too."""
    whole = pretokens.text_parts
    monkeypatch.setattr(pretokens, "text_parts", lambda text, size=300: whole(text, size))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    out = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    out += ["".join(rng.choice(PARTS[:24]) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    out += ["".join(rng.choice(PARTS) for _ in range(2000)) for _ in range(60)]
    return out + ["a" * 5000, "ab" * 3000, "", " ", "'s", "x's 's", "<|endoftext|>"]


def test_merge_replay_equals_the_library(library, texts):
    vocab = bpe.vocabulary(RANKS, public_tokenizers.PATTERN)
    coder = pretokens.WordCoder(vocab.encode_words, limit=5000)  # small: forgets between blocks
    for a in range(0, len(texts), 1000):
        part = texts[a:a + 1000]
        for text, ids in zip(part, coder.ids(part, True, vocab.slow)):
            assert ids.tolist() == library.encode_ordinary(text), text
            assert vocab.decode(ids) == text.encode()


def test_word_ids_equal_the_library(texts):
    words = packing.tokenizer(WORDS)
    coder = pretokens.WordCoder(words.encode_words)
    for text, ids in zip(texts, coder.ids(texts, False, words.slow, packing.normal)):
        assert list(ids) == words.library.encode(text, add_special_tokens=False).ids, text


def test_added_tokens_inside_a_text_equal_a_fresh_library(spark):
    fresh = Tokenizer.from_file(WORDS)
    assert fresh.encode("end <|endoftext|> of", add_special_tokens=False).ids == [806, 49407, 539]
    literals = ["<|endoftext|>", "<|startoftext|>"]
    texts = [t.replace("@", x) for x in literals for t in (
        "end @ of", "@", "a@b", "@@ @", "it's @'s", "e@\u0301", "some words " * 200 + "@ and " + "more words " * 200)]
    texts += ["<|ENDOFTEXT|> x", "<|endoftext |>", "<| endoftext|>", "<|endof text|>", "plain text", ""]
    want = [fresh.encode(t, add_special_tokens=False).ids for t in texts]
    words = packing.tokenizer(WORDS)
    coder = pretokens.WordCoder(words.encode_words)
    got = coder.ids(texts, False, words.slow, packing.normal)
    assert [list(ids) for ids in got] == want
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = packing.pack(df, WORDS, 2048, with_ids=True).collect()
    assert {r["doc_id"]: r["ids"] for r in rows} == {k: ids + [0] for k, ids in enumerate(want)}


def test_bpe_query_on_whole_texts(spark, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    got = QUERIES["op4_byte_bpe"](spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_bpe_edge_rows(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, None, "x"), (None, "", "y"), (2, "word " * 50000, "z")],
                               "doc_id long, text string, ids string")
    rules = (RANKS, public_tokenizers.PATTERN)
    got = bpe.decode(bpe.encode(df, *rules), *rules).collect()
    assert sorted((r["doc_id"] or 0, r["n_tokens"], len(r["decoded"])) for r in got) == [
        (0, 0, 0), (1, 0, 0), (1, 0, 0), (2, 50001, 250000)]
    assert bpe.decode(bpe.encode(df.limit(0), *rules), *rules).count() == 0


def check_packing(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by)


def test_packing_query(spark):
    lib = packing.tokenizer(WORDS).library
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    rows = QUERIES["op10_packing"](spark, SF).collect()
    used = check_packing(rows, 2048)
    assert used <= -(-sum(r["length"] for r in rows) // 2048) + 1
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    for doc, text in texts.items():
        ids = np.array(lib.encode(text, add_special_tokens=False).ids + [0], dtype="<u4")
        parts = sorted(by[doc], key=lambda r: r["piece"])
        assert [r["piece"] for r in parts] == list(range(-(-len(ids) // 2048)))
        for r in parts:
            own = ids[r["start"]:r["start"] + r["length"]]
            assert r["start"] == 2048 * r["piece"] and len(own) == r["length"] and zlib.crc32(own.tobytes()) == r["ids_crc32"]


def test_packing_edge_rows(spark):
    df = spark.createDataFrame([(1, None, 5), (1, None, 5), (None, "", 6), (2, "word " * 9000, 7), (3, "a b c", 8)],
                               "doc_id long, text string, length int")
    rows = packing.pack(df, WORDS, 64, with_ids=True).collect()
    check_packing(rows, 64)
    assert sorted(r["length"] for r in rows if r["doc_id"] != 2) == [1, 1, 1, 4]
    assert sum(r["length"] for r in rows if r["doc_id"] == 2) == 9001
    assert all(len(r["ids"]) == r["length"] for r in rows)
    assert packing.pack(df.limit(0), WORDS, 64).count() == 0


def fewest(items, capacity):
    """The fewest sequences, by search over the states of open sequences."""
    items = tuple(sorted(items, reverse=True))

    @lru_cache(maxsize=None)
    def go(at, rooms):
        if at == len(items):
            return 0
        best = 1 + go(at + 1, tuple(sorted((*rooms, capacity - items[at]))))
        for k, room in enumerate(rooms):
            if room >= items[at] and (k == 0 or rooms[k - 1] != room):
                best = min(best, go(at + 1, tuple(sorted((*rooms[:k], room - items[at], *rooms[k + 1:])))))
        return best

    return go(0, ())



def test_reduction_never_costs_a_sequence():
    rng = random.Random(2)
    for _ in range(150):
        capacity = rng.choice([10, 12, 17])
        items = [rng.randint(1, capacity) for _ in range(rng.randint(1, 9))]
        histogram = {x: items.count(x) for x in set(items)}
        fixed, left = packing.reduce_histogram(histogram, capacity)
        taken = [x for times, lengths in fixed for x in lengths * times]
        rest = [x for x, n in left.items() for _ in range(n)]
        assert sorted(taken + rest) == sorted(items)
        assert all(sum(lengths) <= capacity for _, lengths in fixed)
        assert sum(t for t, _ in fixed) + fewest(rest, capacity) == fewest(items, capacity), (capacity, items, fixed)


def reduced(items, capacity):
    """Sequences of the fixed sets and the fewest for the rest."""
    fixed, left = packing.reduce_histogram({x: items.count(x) for x in set(items)}, capacity)
    return sum(t for t, _ in fixed) + fewest([x for x, n in left.items() for _ in range(n)], capacity)


def test_reduction_looks_at_triples_and_shorter_partners():
    assert reduced([10, 8, 8, 4, 3, 3, 3], 20) == fewest([10, 8, 8, 4, 3, 3, 3], 20) == 2
    assert not packing._dominates(packing.Stock({12: 1, 6: 1, 4: 1, 3: 1, 2: 1}), 12, (6, 2), 8)
    assert packing._dominates(packing.Stock({12: 1, 6: 1, 4: 1, 2: 1}), 12, (6, 2), 8)
    rng = random.Random(5)
    for _ in range(300):
        capacity = rng.choice([20, 26])
        items = [rng.randint(2, capacity // 2 + 2) for _ in range(rng.randint(5, 11))]
        assert reduced(items, capacity) == fewest(items, capacity), (capacity, items)


def naive_best_fit(items, capacity):
    rooms = []
    for x in sorted(items, reverse=True):
        fits = [r for r in rooms if r >= x]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - x)
        else:
            rooms.append(capacity - x)
    return sorted(rooms)


def test_best_fit_in_bulk_equals_one_by_one():
    rng = random.Random(4)
    for _ in range(100):
        capacity = rng.choice([20, 64])
        items = [rng.randint(1, capacity) for _ in range(rng.randint(1, 200))]
        bulk = packing.best_fit({x: items.count(x) for x in set(items)}, capacity)
        rooms = sorted(capacity - sum(x * n for x, n in content) for times, content in bulk for _ in range(times))
        assert rooms == naive_best_fit(items, capacity)


def test_plan_places_every_piece_once():
    rng = random.Random(6)
    length = np.array([rng.choice([1, 1, 5, 9, 30, 63, 64]) for _ in range(2000)])
    rank = np.zeros(2000, np.int64)
    for x in np.unique(length):
        rank[length == x] = np.arange((length == x).sum())
    table = packing.plan({int(x): int((length == x).sum()) for x in np.unique(length)}, 64)
    sequence, offset = packing.place(table, length, rank)
    rows = [{"sequence_id": s, "offset": o, "length": n} for s, o, n in zip(sequence.tolist(), offset.tolist(), length.tolist())]
    assert check_packing(rows, 64) <= 1.02 * int(length.sum()) / 64
