"""Conversation prefix trie: the query against SQL, any table against brute force, the spilling
queue, edge rows."""

import hashlib
import random
import re
import zlib

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from termlens.llm import prefixtrie
from termlens.llm.oracle import ORACLE
from termlens.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    """All nodes by the definition, from (conv_id, turn, role, text) rows without ties."""
    turns = {}
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0)):
        turns.setdefault(c, []).append((role or "", text or ""))
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        built[c] = tuple(turns.get(base, [])[:h] + own[h:])
    members, ended = {}, {}
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members.setdefault(built[c][:d], []).append(c)
        ended.setdefault(built[c], []).append(c)
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    below = {}

    def total(p):
        leaves, saved = zip(*(below[k] for k in kids[p])) if p in kids else ((1,), (0,))
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        return sum(leaves), sum(saved) + (len(members[p]) - 1) * words

    for p in sorted(members, key=len, reverse=True):
        below[p] = total(p)
    sha = lambda ids: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    return sorted((m[0], len(p), members[p[:-1]][0] if p else None, len(m), len(kids.get(p, [])), *below[p], sha(ended.get(p, [])))
                  for p, m in members.items())


def built(df):
    found = prefixtrie.trie(*prefixtrie.rebuilt(prefixtrie.numbered(df)))
    return sorted(tuple(r) for r in found.collect())


def test_query_matches_sql_and_definition(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{sf}/conversations.parquet')")
    cur = con.execute(ORACLE["op12_prefix_trie"])
    cols = [d[0] for d in cur.description]
    got = sorted(tuple(r) for r in QUERIES["op12_prefix_trie"](spark, sf).select(*cols).collect())
    assert got == sorted(cur.fetchall())
    assert got == plain(con.execute("SELECT conv_id, turn, role, text FROM conversations").fetchall())


def shared_rows(rng, convs, depth, choices):
    return [(c, t, rng.choice("ua"), "w " * rng.randrange(choices)) for c in rng.sample(range(-50, 400), convs)
            for t in range(rng.randrange(1, depth))]


@pytest.mark.parametrize("band,bits,held", [(64, 10, 1 << 17), (3, 1, 2), (2, 2, 1)])
def test_fragments_and_spills_change_nothing(spark, monkeypatch, band, bits, held):
    monkeypatch.setattr(prefixtrie, "BAND", band)
    monkeypatch.setattr(prefixtrie, "WEIGHT_BITS", bits)
    monkeypatch.setattr(prefixtrie, "ID_BITS", 3)
    rng = random.Random(band)
    rows = shared_rows(rng, 90, 9, 2) + [(1000 + c, t, "u", "same turn") for c in range(30) for t in range(12)]
    assert built(spark.createDataFrame(rows, SCHEMA)) == plain(rows)
    # the queue alone, in one task of its own
    real = prefixtrie.SpillingQueue
    monkeypatch.setattr(prefixtrie, "SpillingQueue", lambda n: real(held))
    chain = [(d, 1, d, True, 1, d - 1, 7, 7, 2, d == 0, 0, 0, 5) for d in range(40, -1, -1)]
    names = ["depth", "a", "b", "is_node", "parent_a", "parent_b", "conv_id", "parent_conv_id", "n_convs", "cut", "children",
             "leaves", "saved"]
    batch = pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in chain])
    out = [r for b in prefixtrie.forward(iter([batch])) for r in b.to_pylist()]
    assert [(r["depth"], r["n_leaves"], r["saved_tokens"]) for r in out] == [(d, 1, 5 * (41 - d)) for d in range(40, -1, -1)]


def test_spilling_queue_is_a_priority_queue():
    rng = random.Random(5)
    items = [(rng.randrange(40), k) for k in range(500)]
    queue = prefixtrie.SpillingQueue(16)
    for item in items:
        queue.push(item)
    assert queue.runs
    got = []
    for key in range(40):
        got.extend(queue.take((key,)))
        if key == 20:  # later keys may still come in
            extra = (30, 999)
            queue.push(extra)
            items.append(extra)
    assert got == sorted(items)


def test_long_chain_shared_by_many(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "BAND", 8)
    rows = [(c, t, "u", f"turn {t}") for c in (4, 8, 12, 31) for t in range(150 + c)]
    assert built(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_edge_rows(spark):
    rows = [(1, None, None, None), (1, 0, "u", "a b"), (None, 0, "u", "lost"), (20, 0, "u", ""), (21, 5, "u", "é x y\n"),
            (40, 0, None, "t"), (41, 0, None, "t"), (45, 0, "", "t"), (-3, 1, "u", "n"), (62, 0, "u", "x"), (20, 1, "u", "long " * 200_000)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert built(df) == plain(rows)
    assert built(df.limit(0)) == []
    clash = df
    for name in ("place", "content", "words", "band", "piece", "_hash"):
        clash = clash.withColumn(name, F.lit("x"))
    assert built(clash) == plain(rows)
    # rows that tie on their turn: one fixed order, every row a turn
    ties = spark.createDataFrame([(7, 1, "u", "b"), (7, 1, "u", "a"), (7, 1, "u", "a"), (7, 1, "u", "b"), (7, 1, "a", "b")] * 2, SCHEMA)
    once, again = built(ties), built(ties.repartition(3))
    assert once == again and max(r[1] for r in once) == 10 - zlib.crc32(b"7") % 4
