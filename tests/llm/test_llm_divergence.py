"""Source divergence: trees and prices against brute force, the query against SQL, edge rows."""

import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from termlens.llm import divergence
from termlens.llm.oracle import ORACLE
from termlens.llm.queries import QUERIES

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain(rows, min_docs=3, top=200):
    """All results by the definition, from (lang, source, text) rows."""
    counts, held = {}, {}
    for i, (lang, source, text) in enumerate(rows):
        lang, source = lang or "", source or ""
        group = counts.setdefault((lang, source), {})
        for t in TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")):
            group[t] = group.get(t, 0) + 1
            held.setdefault((lang, t), set()).add(i)
    out = set()
    for lang in {k[0] for k in counts}:
        terms = sorted(t for (at, t), docs in held.items() if at == lang and len(docs) >= min_docs)
        groups = {s: [c.get(t, 0) for t in terms] for (at, s), c in counts.items() if at == lang}
        shares = lambda ns: [1 + 10**9 * (n + 1) // (sum(ns) + len(terms)) for n in ns]
        q_lang = shares([sum(ns) for ns in zip(*groups.values())])
        price = lambda p, q: (p - q) ** 2 // q
        for s, ns in groups.items():
            pairs = [(o, sum(price(p, q) for p, q in zip(shares(ns), shares(others)))) for o, others in groups.items() if o != s]
            overused = [(t, price(p, q)) for t, n, p, q in zip(terms, ns, shares(ns), q_lang) if n and p > q]
            for part, found, limit in (("pair", pairs, None), ("term", overused, top)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:limit]
                out |= {(lang, s, part, item, value, k) for k, (item, value) in enumerate(ranked, 1)}
    return out


def audited(spark, rows, **kw):
    df = spark.createDataFrame(rows, "lang string, source string, text string")
    return {tuple(r) for r in divergence.audit(df, **kw).collect()}


def test_query_matches_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    cur = con.execute(ORACLE["op11_source_divergence"])
    cols = [d[0] for d in cur.description]
    got = QUERIES["op11_source_divergence"](spark, sf)
    assert sorted(got.columns) == sorted(cols)
    assert sorted(tuple(r) for r in got.select(*cols).collect()) == sorted(cur.fetchall())


@pytest.mark.parametrize("seed", range(4))
def test_joint_traversal_prices_every_pair(seed):
    rng = np.random.default_rng(seed)
    size, n_cols = int(rng.choice([8, 16, 64])), int(rng.integers(1, 300))
    squares = -(-n_cols // size)
    forests, dense, zeros = [], [], []
    for density in (0.002, 0.2):
        zero = rng.integers(1, 50, size)
        full = np.repeat(zero[:, None], n_cols, axis=1)
        rows, cols = np.nonzero(rng.random((size, n_cols)) < density)
        p = rng.integers(1, 10**9, len(rows))
        full[rows, cols] = p
        forests.append(divergence.Forest(rows, cols, p, zero, squares))
        dense.append(full)
        zeros.append(zero)
    ab, ba, empty = divergence.joint(*forests)
    empty = empty - (squares * size - n_cols)
    p, q = dense
    square = (p[:, None, :] - q[None, :, :]) ** 2
    z = (zeros[0][:, None] - zeros[1]) ** 2
    assert np.array_equal(ab + empty * (z // zeros[1]), (square // q).sum(axis=2))
    assert np.array_equal(ba + empty * (z // zeros[0][:, None]), (square // p[:, None, :]).sum(axis=2))


def test_shares_are_exact_beyond_64_bits():
    n, total = np.array([0, 5, 10**13, 10**15]), np.array([7, 9, 10**13 + 5, 8 * 10**15])
    assert divergence.shares(n, total).tolist() == [1 + 10**9 * (a + 1) // b for a, b in zip(n.tolist(), total.tolist())]


def test_many_sources_blocks_and_tiles(spark, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK", 16)
    monkeypatch.setattr(divergence, "TILE", 5)
    rng = random.Random(1)
    words = ["w" + chr(97 + i % 26) + chr(97 + i // 26) for i in range(90)]
    rows = [(rng.choice(["xx", "yy"]), f"s{rng.randrange(23)}", " ".join(rng.choices(words, [1 / (i + 1) for i in range(90)], k=30)))
            for _ in range(150)]
    assert audited(spark, rows) == plain(rows)


def test_edge_rows(spark):
    rows = [("en", "a", "One two, one TWO 3 é"), ("en", "a", "one 2two"), ("en", "b", "One"), ("en", None, None), ("en", "", ""),
            (None, "a", "lone words"), (None, "b", ""), ("de", "only", "x x x"), ("en", "b", "One"), ("en", "c", "123 --")]
    assert audited(spark, rows) == plain(rows)
    assert audited(spark, rows, min_docs=1, top_terms=1) == plain(rows, 1, 1)
    assert audited(spark, []) == set()
    clash = spark.createDataFrame(rows, "lang string, source string, text string")
    for name in ("term", "n", "docs", "tile", "block", "_hash"):
        clash = clash.withColumn(name, F.lit("x"))
    assert {tuple(r) for r in divergence.audit(clash).collect()} == plain(rows)


def test_very_long_text_is_counted_whole(spark):
    long = "abc déf " * 150_000 + "q" * 600_000
    rows = [("en", "a", long), ("en", "b", "abc"), ("en", "c", "abc déf")]
    assert audited(spark, rows, min_docs=2) == plain(rows, 2)
