"""SimHash components and suffix-array dedup against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from termlens.llm import repeats, simhash
from termlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain_fingerprint(text, n=3):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_components(fps, radius):
    fps = np.array(fps, dtype=np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius
    label = np.arange(len(fps))
    while True:
        least = np.array([label[row].min() for row in near])
        if (least == label).all():
            return label
        label = least


def test_simhash_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    fps = [plain_fingerprint(r["text"]) for r in docs]
    label = plain_components(fps, 3)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES["op7_simhash"](spark, SF).collect()}
    assert got == {r["doc_id"]: (f"{fp:016x}", docs[k]["doc_id"]) for r, fp, k in zip(docs, fps, label)}


def test_simhash_edge_rows(spark):
    df = spark.createDataFrame([(5, None, 1), (4, "", 1), (3, " \n", 1), (None, "", 2), (7, "One two", 1), (8, "one TWO", 1),
                                (7, "One two", 1), (9, "É É É É", 1)], "doc_id long, text string, fp int")
    got = sorted((r["doc_id"] or -1, r["component_id"]) for r in simhash.near_duplicates(df).collect())
    assert got == [(-1, 3), (3, 3), (4, 3), (5, 3), (7, 7), (7, 7), (8, 7), (9, 9)]
    assert simhash.near_duplicates(df.limit(0)).count() == 0
    df = df.withColumn("__text_hash", F.lit("mine"))
    assert simhash.keep_one(df).filter("__text_hash = 'mine'").count() == 3
    kept = sorted((r["doc_id"], r["text"]) for r in simhash.keep_one(df).collect())
    assert kept == [(3, " \n"), (7, "One two"), (9, "É É É É")]


@pytest.mark.parametrize("max_queries", [8192, 3])
def test_links_give_the_components_of_all_pairs(spark, max_queries):
    rng = random.Random(8)
    fps = []
    for _ in range(12):  # chains and clumps around random centres
        fp = rng.getrandbits(64)
        for _ in range(rng.randint(1, 12)):
            fps.append(fp)
            for _ in range(rng.choice([1, 2, 3, 3, 4])):
                fp ^= 1 << rng.randrange(64)
    fps = sorted(set(fps))
    signed = np.array(fps, dtype=np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    got = {r["node"]: r["label"] for r in simhash.components(simhash.links(df, 3, max_queries)).collect()}
    label = plain_components(fps, 3)
    for i, x in enumerate(signed):
        for j, y in enumerate(signed):
            same = x == y or (x in got and got[x] == got.get(y))
            assert same == (label[i] == label[j])


def test_bk_trees_find_all_pairs_within_the_radius():
    rng = np.random.default_rng(1)
    fp = np.unique(rng.integers(0, 1 << 12, 600, dtype=np.uint64))
    shard = np.sort(rng.integers(0, 4, len(fp)))
    forest = simhash.Forest(shard, fp)
    found = {(int(a), int(b)) for q, node in forest.search(np.arange(len(fp)), 3) for a, b in zip(q, node)}
    want = {(i, j) for i in range(len(fp)) for j in range(len(fp))
            if i != j and shard[i] == shard[j] and int(fp[i] ^ fp[j]).bit_count() <= 3}
    assert found == want


def test_long_chain_is_one_component(spark):
    pairs = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = simhash.components(pairs).select("label").distinct().collect()
    assert len(got) == 1
    assert simhash.components(pairs.limit(0)).count() == 0


def plain_repeats(rows, length):
    """rows: (id or None, text); returns by row (n_bytes, n_removed, n_spans, kept)."""
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0, (rows[k][1] or "").encode()))
    seen, out = set(), {}
    for k in order:
        data = (rows[k][1] or "").encode()
        marks = np.zeros(len(data) + 1, int)
        for p in range(len(data) - length + 1):
            s = data[p:p + length]
            if s in seen:
                marks[p] += 1
                marks[p + length] -= 1
            seen.add(s)
        gone = np.cumsum(marks)[:-1] > 0
        spans = int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(data) else 0
        out[k] = (len(data), int(gone.sum()), spans, bytes(np.frombuffer(data, np.uint8)[~gone]))
    return out


def test_repeats_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    want = plain_repeats([(r["doc_id"], r["text"]) for r in docs], 100)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
           for r in QUERIES["op3_suffix_dedup"](spark, SF).collect()}
    assert got == {r["doc_id"]: (*want[k][:3], hashlib.sha256(want[k][3]).hexdigest()) for k, r in enumerate(docs)}


def passages(rng, n):
    common = ["".join(rng.choice("abcé ") for _ in range(rng.randint(60, 300))) for _ in range(6)]
    rows = []
    for k in range(n):
        own = ["".join(rng.choice("abcdefgh é") for _ in range(rng.randint(0, 150))) for _ in range(3)]
        parts = own + [rng.choice(common)[rng.randint(0, 30):] for _ in range(rng.randint(0, 3))]
        rng.shuffle(parts)
        rows.append((k, "".join(parts)))
    return rows


def check_repeats(spark, rows, **kinds):
    want = plain_repeats(rows, 100)
    df = spark.createDataFrame([(*r, k, 0) for k, r in enumerate(rows)], "doc_id long, text string, row int, kept int")
    got = {r["row"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"]))
           for r in repeats.remove_repeats(df.repartition(3), **kinds).collect()}
    assert got == want


def test_repeats_of_random_passages(spark):
    check_repeats(spark, passages(random.Random(1), 80))


def test_repeats_with_hot_anchors_and_small_chunks(spark, monkeypatch):
    monkeypatch.setattr(repeats, "HOT_CONTEXTS", 4)
    monkeypatch.setattr(repeats, "CHUNK_BYTES", 2000)
    rng = random.Random(2)
    line = "a line that stands in every document, long enough to hold anchors of its own, more than 100 bytes in all......"
    rows = [(k, "".join(rng.choice("abcdef") for _ in range(200)) + line + "".join(rng.choice("abcdef") for _ in range(200)))
            for k in range(40)]
    assert len(repeats.hot_anchors(spark.createDataFrame(rows, "doc_id long, text string"), "text", 100, 32))
    check_repeats(spark, rows + passages(rng, 30))


def test_repeats_edge_rows(spark):
    long = "z" * 250
    text = "".join(random.Random(3).choices("abc", k=400))
    rows = [(1, None), (2, ""), (3, "short"), (4, long), (5, text), (6, text), (6, text + "tail"), (None, text[:150]), (None, None),
            (7, "é" * 120), (8, "x" + "é" * 120), (5, text)]
    want = plain_repeats(rows, 100)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"] or -1, r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"]))
                 for r in repeats.remove_repeats(df).collect())
    assert got == sorted((r[0] or -1, *want[k]) for k, r in enumerate(rows))
    assert repeats.remove_repeats(df.limit(0)).count() == 0


def test_repeats_of_a_text_longer_than_a_segment(spark):
    rng = random.Random(5)
    text = "".join(rng.choices("abcdefghij", k=700_000))
    rows = [(1, text), (2, text[300_000:650_000] + "fresh" * 50), (3, text[-400:] + text[:400])]
    check_repeats(spark, rows)


def test_texts_lose_whole_characters_and_keep_nulls(spark):
    base = "é" * 40 + "".join(random.Random(6).choices("abc", k=120))
    df = spark.createDataFrame([(1, base, 9), (2, "ñ" + base[1:] + "end", 9), (3, None, 9)], "doc_id long, text string, n int")
    out = {r["doc_id"]: r for r in repeats.without_repeats(df).collect()}
    assert out[1]["text"] == base and out[3]["text"] is None and out[2]["n"] == 9
    assert out[2]["text"] in ("ñend", "end", "ñéend")
    assert repeats.without_repeats(df).columns == df.columns


def test_previous_smaller():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 50, 300):
        values = rng.permutation(n)
        want = [max((j for j in range(i) if values[j] < values[i]), default=-1) for i in range(n)]
        assert repeats.previous_smaller(values).tolist() == want
    down = np.arange(1000)[::-1]
    assert (repeats.previous_smaller(down) == -1).all()


def test_previous_factors_equal_brute_force():
    rng = random.Random(7)
    for length in (9, 16, 37, 100):
        data = bytes(rng.choice(b"ab") for _ in range(600)) * 2
        starts = np.arange(0, len(data) - length + 1, 3)
        got = repeats.has_previous_factor(np.frombuffer(data, np.uint8), starts, length)
        seen, want = set(), []
        for p in starts:
            want.append(data[p:p + length] in seen)
            seen.add(data[p:p + length])
        assert got.tolist() == want


def test_queries_that_fill_the_frontier_are_all_searched(monkeypatch):
    fp = np.arange(4, dtype=np.uint64)
    for frontier in (4, 8, 16, 5, 7):  # one tree of four: costs 4, 8, 12, 16
        monkeypatch.setattr(simhash, "FRONTIER", frontier)
        found = [pair for q, node in simhash.Forest(np.zeros(4, np.int64), fp).search(np.arange(4), 64)
                 for pair in zip(q.tolist(), node.tolist())]
        assert sorted(found) == [(a, b) for a in range(4) for b in range(4) if a != b]
