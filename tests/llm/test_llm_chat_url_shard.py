"""Chat formatting, URL filters and sharding: SQL twins, round trips, edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from termlens.llm import chat, sharding, urlfilter
from termlens.llm.queries import QUERIES, URL_RULES

SF = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn long, role string, text string"


def digest(turns):
    """By conversation: what reading back must give, straight from the rows."""
    out = {}
    for conv in {r[0] for r in turns}:
        rows = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in turns if c == conv))
        rows = [(r, x) for _, _, r, x in rows]
        replies = [x for r, x in rows if r == "assistant"]
        out[conv] = (len(rows), "".join(f"{r}\n{x}\n" for r, x in rows), "".join(replies), len(replies))
    return out


def read(spark, turns, schema=TURNS):
    df = spark.createDataFrame(turns, schema)
    got = chat.read_back(chat.expand_prefixes(df)).collect()
    return {r["conv_id"]: (r["n_turns"], r["said"], r["trained"], r["n_targets"]) for r in got}


def test_chat_reads_back_every_text(spark):
    hard = ["\\", "\\\\", "#", "<", "</turn>\n", "### a:\n", "\\h", "\\l\\", ":\n", "", None, "é😀\n", "\\### Assistant: </turn> ok"]
    rng = random.Random(3)
    turns = [(c, t, rng.choice(["user", "assistant", "a:b\n#", None]), "".join(rng.choice(hard[:10]) for _ in range(4)))
             for c in range(20) for t in range(rng.randint(1, 6))]
    turns += [(99, k, "assistant", x) for k, x in enumerate(hard)]
    assert read(spark, turns) == digest(turns)


def test_chat_edge_rows(spark):
    turns = [(1, None, "assistant", "x"), (1, 0, "user", "y"), (1, 0, "user", "y"), (None, 0, "assistant", None),
             (None, 1, "user", "z"), (3, 0, "system", "only"), (4, 0, "assistant", "long " * 20000)]
    assert read(spark, turns) == digest(turns)
    assert read(spark, []) == {}


def test_chat_examples_hold_all_preceding_turns_and_train_one_reply(spark):
    df = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "user", "c"), (1, 3, "assistant", "d"),
                                (1, 4, "user", "e")], TURNS)
    got = {r["example"]: r for r in chat.expand_prefixes(df.withColumn("ts", F.lit(1)).withColumn("reply", F.lit(2))).collect()}
    assert sorted(got) == [2, 4, 5]
    for n, reply in ((2, "b"), (4, "d")):
        r = got[n]
        assert r["formatted"].count("</turn>\n") == n
        assert r["formatted"][r["loss_start"]:r["loss_start"] + r["loss_chars"]] == reply
    assert got[5]["loss_chars"] is None and got[5]["formatted"].count("</turn>\n") == 5


def test_chat_query_has_the_probe_and_no_python(spark):
    df = QUERIES["op2_chat_formatting"](spark, SF)
    probe = df.filter("conv_id = -7").first()
    text = "\\### Assistant: </turn> ok"
    assert probe["turns_sha256"] == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert probe["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest() and probe["loss_chars"] == len(text)
    plan = df._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def glob_match(glob, url):
    out, i = "", 0
    while i < len(glob):
        if glob[i:i + 2] == "**":
            out, i = out + "(?s:.*)", i + 2
        elif glob[i] == "*":
            out, i = out + "[^/]*", i + 1
        else:
            out, i = out + re.escape(glob[i]), i + 1
    return re.fullmatch(out, url) is not None


def test_automaton_equals_regular_expressions():
    rng = random.Random(5)
    globs = ["".join(rng.choice(["a", "b", "/", "*", "**", ".", "é"]) for _ in range(rng.randint(1, 9))) for _ in range(60)]
    globs = [g.replace("***", "**") for g in globs if "***" not in g and "****" not in g]
    urls = ["".join(rng.choice("ab/.é?") for _ in range(rng.randint(0, 12))) for _ in range(300)] + [""]
    automaton = urlfilter.Automaton(globs)
    assert automaton.words > 1
    hit = automaton.match(urls)
    for i, u in enumerate(urls):
        for k, g in enumerate(globs):
            assert hit[i, k] == glob_match(g, u), (g, u)


def judge_one(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.name), default=None)
    return host, path, best and best.name, best.verdict if best else "allow"


def test_url_rules(spark):
    urls = ["http://example.org/es/1", "http://a.EXAMPLE.org/en/1x", "http://badexample.org/es/", "https://x.com/de/", "x.com/de/",
            None, "", "http://", "http://org", "http://org/", "http://x.net/a.org/", "ftp://X.COM/fr/?q#f", "http://x.com#/de/",
            "http://x.com\n/de/", "a://b://x.org/", "http://É.org/es/" + "z" * 5000, "http://x.com/de", "http://.com/de/x?y"]
    df = spark.createDataFrame([(i, u, 0, "q") for i, u in enumerate(urls)], "page_id long, url string, rest int, host string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urlfilter.judge(df, URL_RULES).collect()}
    assert got == {i: judge_one(u) for i, u in enumerate(urls)}
    assert urlfilter.judge(df.limit(0), URL_RULES).count() == 0
    assert urlfilter.judge(df, []).filter("verdict = 'allow'").count() == len(urls)


def test_communication_matrix_has_exact_margins():
    counts = [0, 5, 1000, 3, 77, 4096]
    matrix = sharding.communication_matrix(counts, 7, 1)
    assert [sum(row) for row in matrix] == counts
    columns = [sum(c) for c in zip(*matrix)]
    assert sum(columns) == sum(counts) and max(columns) - min(columns) <= 1


def test_hypergeometric_draws_follow_the_law():
    rng = random.Random(9)
    draws = Counter(sharding.hypergeometric(5, 7, 4, rng) for _ in range(20000))
    from math import comb
    for k in range(5):
        assert draws[k] / 20000 == pytest.approx(comb(5, k) * comb(7, 4 - k) / comb(12, 4), abs=0.015)


def test_shards_are_exact_and_gapless(spark):
    n = 1003
    df = spark.range(n, numPartitions=5).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.lit("x").alias("slot"),
                                              F.lit("y").alias("__rank"), F.lit("z").alias("__key"))
    rows = sharding.shuffle_into_shards(df, 16, piece_rows=20).collect()
    assert len(rows) == n and sum(r["doc_id"] is None for r in rows) == 335
    shards = Counter(r["shard"] for r in rows)
    assert sorted(shards) == list(range(16)) and max(shards.values()) - min(shards.values()) <= 1
    for s in shards:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(shards[s]))
    assert sharding.shuffle_into_shards(df.limit(0), 16).count() == 0


def test_shuffle_mixes_every_source_into_every_shard(spark):
    rows = sharding.shuffle_into_shards(spark.range(8000, numPartitions=4).toDF("doc_id"), 4).collect()
    cells = Counter((r["doc_id"] // 2000, r["shard"]) for r in rows)
    assert all(420 < cells[p, s] < 580 for p in range(4) for s in range(4))
    halves = Counter((r["doc_id"] // 2000, r["slot"] // 1000) for r in rows)
    assert all(880 < halves[p, h] < 1120 for p in range(4) for h in range(2))


def test_sharding_query_is_native(spark):
    df = QUERIES["op9_sharding"](spark, SF)
    assert not re.search("Python|Pandas|MapInArrow", df._jdf.queryExecution().toString())
    assert df.select("law").distinct().collect()[0][0] == "rows"


def test_sharding_query_rows_against_plain_python(spark, tmp_path):
    """size, text_crc32, shard and slot of the registered query, nulls, empty and very long texts and
    repeated rows included."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    odd = [(90_001, None), (90_002, ""), (90_003, "é" * 400_000), (90_004, "same"), (90_004, "same"), (None, "no id")]
    docs.unionByName(spark.createDataFrame(odd, docs.schema)).write.parquet(str(tmp_path / "documents.parquet"))
    want = Counter()
    for r in spark.read.parquet(str(tmp_path / "documents.parquet")).collect():
        data = (r["text"] or "").encode()
        want[r["doc_id"], len(data) + 1, zlib.crc32(data)] += 1
    rows = QUERIES["op9_sharding"](spark, str(tmp_path)).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    assert {(r["law"], r["grown_shard"]) for r in rows} == {("rows", None)}
    shards = Counter(r["shard"] for r in rows)
    assert sorted(shards) == list(range(16)) and max(shards.values()) - min(shards.values()) <= 1
    for s, n in shards.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(n))
