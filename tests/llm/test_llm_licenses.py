"""Licence scans: suffix automaton, phrases and chains against brute force; edge rows."""

import random
import re

from pyspark.sql import functions as F

from termlens.llm import licenses
from termlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain_base(words):
    places = {label: [i for i in range(len(words)) if words[i:i + len(p.split())] == p.split()]
              for label, p in licenses.PHRASES}
    starts = sorted(i for found in places.values() for i in found)
    return (len(starts), starts[0] if starts else None, starts[-1] if starts else None,
            ",".join(sorted(k for k, v in places.items() if v)))


def common_runs(words, template, shortest):
    """Every run of equal words that neither side can prolong: (start, end, template end)."""
    found = set()
    for i in range(len(words)):
        for j in range(len(template)):
            if words[i] == template[j] and not (i and j and words[i - 1] == template[j - 1]):
                n = 0
                while i + n < len(words) and j + n < len(template) and words[i + n] == template[j + n]:
                    n += 1
                if n >= shortest:
                    found.add((i, i + n, j + n))
    return found


def best_chain(runs, gap):
    """The most words any chain of runs covers, in order in both, overlaps counted once."""
    best = {}
    for start, end, to in sorted(runs, key=lambda r: (r[1], r[2])):
        covered = end - start
        for (p_start, p_end, p_to), c in best.items():
            fresh = end - max(start, p_end, start + p_to - (to - (end - start)))
            if start - p_end <= gap and p_end <= end and p_to <= to and fresh > 0:
                covered = max(covered, c + fresh)
        best[start, end, to] = covered
    return max(best.values(), default=0)


def test_automaton_finds_every_longest_suffix():
    rng = random.Random(3)
    for _ in range(60):
        given = [[rng.randrange(3) for _ in range(rng.randrange(1, 9))] for _ in range(rng.randrange(1, 5))]
        held = {tuple(s[i:j]) for s in given for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
        machine = licenses.SuffixAutomaton(given)
        text = [rng.randrange(4) for _ in range(40)]
        for i, (state, length) in enumerate(machine.statistics(text), 1):
            assert length == max(n for n in range(i + 1) if not n or tuple(text[i - n:i]) in held)
            match = text[i - length:i]
            if length:
                assert machine.places[state] == sorted(
                    (k, e) for k, s in enumerate(given) for e in range(length, len(s) + 1) if s[e - length:e] == match)


def test_chains_cover_what_brute_force_covers():
    rng = random.Random(8)
    names = list("abcdefg")
    for _ in range(150):
        templates = [(f"t{k}", " ".join(rng.choice(names) for _ in range(rng.randrange(4, 14)))) for k in range(3)]
        phrases = [("p", " ".join(rng.choice(names) for _ in range(rng.randrange(1, 4))))]
        words = [rng.choice([*names, "zz"]) for _ in range(30)]
        for _, t in templates[:2]:
            at = rng.randrange(len(words))
            words[at:at] = [w for w in t.split() if rng.random() < 0.9]
        got = licenses.Scanner(phrases, templates, 2, 3, 0.9).scan(" ".join(words).encode())
        shares = {label: best_chain(common_runs(words, t.split(), 2), 3) / len(t.split()) for label, t in templates}
        p = phrases[0][1].split()
        places = [i for i in range(len(words)) if words[i:i + len(p)] == p]
        assert got["n_base"] == len(places)
        assert got["labels"] == sorted([*(["p"] if places else []), *(k for k, v in shares.items() if v >= 0.9)])
        assert got["score"] == (1.0 if places else max(shares.values()))


def test_query_against_plain_phrases(spark):
    docs = {r["doc_id"]: plain_words(r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in QUERIES["op13_license_scan"](spark, SF).collect()}
    assert set(got) == set(docs)
    templates = [(label, plain_words(t)) for label, t in licenses.TEMPLATES]
    for i, words in docs.items():
        n, first, last, base = plain_base(words)
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (
            len(words), n, first, last, base)
        shares = [(label, best_chain(common_runs(words, t, licenses.MIN_MATCH), licenses.MAX_GAP) / len(t))
                  for label, t in templates]
        own = {label for label, share in shares if share >= licenses.MIN_COVER}
        assert r["labels"] == ",".join(sorted(own | set(base.split(",")) - {""}))
        assert abs(r["score"] - (1.0 if n else max(s for _, s in shares))) < 1e-9


def test_notices_and_clean_text():
    scanner = licenses.Scanner(licenses.PHRASES, licenses.TEMPLATES, licenses.MIN_MATCH, licenses.MAX_GAP, licenses.MIN_COVER)
    labels = lambda text: scanner.scan(text.encode())["labels"]
    assert labels("Code. Released under the MIT License.") == ["mit"]
    assert labels("This work is licensed under the GNU General Public License, version 3.") == ["gpl", "gpl-3.0"]
    assert labels("Licensed under CC BY-NC 4.0 and All Rights Reserved") == ["cc-by", "cc-by-nc-4.0", "reserved"]
    assert labels("the terms of the sale were published by the press under the new licence") == []
    mit = next(t for label, t in licenses.TEMPLATES if label == "mit" and len(t) > 200)
    assert labels(mit.replace("sublicense", "lend").replace("substantial", "large")) == ["mit"]
    assert labels(" ".join(plain_words(mit)[:60])) == []


def test_edge_rows_and_long_texts(spark):
    long = "é lorem " * 200_000
    rows = [(1, None, "x"), (2, "", "x"), (3, "  \n", "x"), (None, "All Rights  Reserved", "x"), (5, "cc by", "x"), (5, "cc by", "x"),
            (6, long + "all rights reserved " + long + "Cc-By", "x"), (7, "cc" + "a" * 600_000 + " cc by", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, labels string").withColumn("data", F.lit(1))
    got = sorted(licenses.scan(df).collect(), key=lambda r: r["doc_id"] or 0)
    assert [(r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in got] == [
        (None, 3, 1, 0, 0, ["reserved"]), (1, 0, 0, None, None, []), (2, 0, 0, None, None, []), (3, 0, 0, None, None, []),
        (5, 2, 1, 0, 0, ["cc-by"]), (5, 2, 1, 0, 0, ["cc-by"]),
        (6, 800_005, 2, 400_000, 800_003, ["cc-by", "reserved"]), (7, 3, 1, 1, 1, ["cc-by"])]
    assert licenses.scan(df.limit(0)).count() == 0
