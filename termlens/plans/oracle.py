"""DuckDB SQL twins of the registered queries (``catalog.py``), for the correctness gate.

Each statement runs on views named after the tables.  The SQL is written independently
of the Spark plans: tokens come from ``regexp_extract_all`` / ``regexp_split_to_array``
and a window sum, fragments from a recursive CTE that walks each document's hits.
Integers are cast to BIGINT, doubles rounded, so types and values compare exactly.
The Porter stemmer is a chain of CTEs over the distinct words (``porter``).
"""

from __future__ import annotations

from ..functions import stopwords as SW
from ..functions.stem import _Word as STEM
from ..functions import text as X
from ..sources import documents as SRC
from . import catalog as C

P = X.SQL_TOKEN_PATTERN.replace("'", "''")
W = X.WORD_CHAR
STOP = SW.sql_list()
PUNCT = X.PUNCTUATION.replace("'", "''")


def light(x: str) -> str:
    return (f"CASE WHEN regexp_matches({x}, '[^ea]ies$') THEN regexp_replace({x}, 'ies$', 'y') "
            f"WHEN regexp_matches({x}, '[^aeo]es$') THEN regexp_replace({x}, 'es$', 'e') "
            f"WHEN regexp_matches({x}, '[^us]s$') THEN regexp_replace({x}, 's$', '') ELSE {x} END")


def src(name="_src", table="documents", id_expr="doc_id", text_expr="text", where="TRUE") -> str:
    return f"{name} AS (SELECT {id_expr} AS doc_id, {text_expr} AS t FROM {table} WHERE {text_expr} IS NOT NULL AND {where})"


def tokens(source="_src", name="tokens", term="lower(surface)", pattern=P) -> str:
    return f"""{name}_a AS (SELECT doc_id, regexp_extract_all(t, '{pattern}') AS toks, regexp_split_to_array(t, '{pattern}') AS gaps FROM {source}),
{name}_u AS (SELECT doc_id, unnest(toks) AS surface, unnest(gaps) AS gap, unnest(range(len(gaps))) AS position FROM {name}_a),
{name}_e AS (SELECT doc_id, CAST(position AS BIGINT) AS position, surface,
    CAST(sum(length(gap) + length(surface)) OVER (PARTITION BY doc_id ORDER BY position
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS "end"
  FROM {name}_u WHERE surface IS NOT NULL),
{name} AS (SELECT doc_id, position, surface, {term} AS term, "end" - length(surface) AS start, "end" FROM {name}_e)"""


def keyterms(source="_src", elig="_src", k=C.K, min_bg=1, term="lower(x)", p="", dt=None, known=None) -> str:
    """dt, bg, nd, kt(doc_id, term, bg_count, rank), each name led by ``p``.  ``dt`` replaces the
    distinct (doc_id, term) pairs; with ``known`` (a relation of ids) the background holds
    those documents only, and other terms count with the documents at hand."""
    pairs = dt or (f"SELECT DISTINCT doc_id, {term} AS term FROM "
                   f"(SELECT doc_id, unnest(regexp_extract_all(t, '{P}')) AS x FROM {source})")
    counts = f"SELECT term, CAST(count(*) AS BIGINT) AS bg_count, TRUE AS seen FROM {p}dt GROUP BY term"
    docs = source
    if known:
        held = f"count(*) FILTER (doc_id IN (SELECT doc_id FROM {known}))"
        counts = (f"SELECT term, CAST(CASE WHEN {held} > 0 THEN {held} ELSE count(*) END AS BIGINT) AS bg_count, "
                  f"{held} > 0 AS seen FROM {p}dt GROUP BY term")
        docs = known
    return f"""{p}dt AS ({pairs}),
{p}bg AS ({counts}),
{p}nd AS (SELECT CAST(count(*) AS BIGINT) AS n FROM {docs}),
{p}kt_r AS (SELECT d.doc_id, d.term, b.bg_count,
           row_number() OVER (PARTITION BY d.doc_id ORDER BY b.bg_count, d.term) AS rank
         FROM {p}dt d JOIN {p}bg b USING (term)
         WHERE d.doc_id IN (SELECT doc_id FROM {elig}) AND (NOT b.seen OR b.bg_count < (SELECT n FROM {p}nd))),
{p}kt AS (SELECT doc_id, term, bg_count, CAST(rank AS BIGINT) AS rank FROM {p}kt_r
       WHERE rank <= {k} AND term NOT IN ({STOP}) AND bg_count >= {min_bg})"""


def _signs(w: str) -> str:
    """The word as v (vowel) and c: a y is a consonant at the start and after a vowel."""
    return (f"substr(list_reduce(list_prepend('|', regexp_extract_all({w}, '(?s).')), lambda a, x: a || CASE "
            "WHEN x IN ('a', 'e', 'i', 'o', 'u') THEN 'v' WHEN x = 'y' AND right(a, 1) = 'c' THEN 'v' ELSE 'c' END), 2)")


def porter(words: str) -> str:
    """CTEs up to ``stems(word, stem)`` over a relation of distinct ``word``: the Porter steps, a
    CTE each, on the word and its vowel signs."""
    def step(name, of, w, extra=""):
        return (f"{name}_w AS (SELECT word, {w} AS w{extra} FROM {of}),\n"
                f"{name} AS (SELECT *, {_signs('w')} AS s, length(w) AS n FROM {name}_w)")

    def m(cut):  # the measure of the word without its last ``cut`` letters
        return f"len(regexp_extract_all(substr(s, 1, n - {cut}), 'v+c+'))"

    def vowel(cut):
        return f"contains(substr(s, 1, n - {cut}), 'v')"

    def swaps(tables):
        whens = []
        for suffix, new in [x for table in tables.values() for x in table]:
            whens.append(f"WHEN ends_with(w, '{suffix}') THEN CASE WHEN {m(len(suffix))} > 0 "
                         f"THEN left(w, n - {len(suffix)}) || '{new}' ELSE w END")
        return "CASE " + " ".join(whens) + " ELSE w END"

    short = "n >= 3 AND right(s, 3) = 'cvc' AND right(w, 1) NOT IN ('w', 'x', 'y')"
    cut4 = " ".join(
        f"WHEN ends_with(w, '{x}')" + (" AND n > 3 AND substr(w, n - 3, 1) IN ('s', 't')" if x == "ion" else "")
        + f" THEN CASE WHEN {m(len(x))} > 1 THEN left(w, n - {len(x)}) ELSE w END"
        for table in STEM.STEP4.values() for x in table)
    return ",\n".join([
        step("p0", words, "word"),
        step("p1", "p0", "CASE WHEN ends_with(w, 'sses') THEN left(w, n - 2) WHEN ends_with(w, 'ies') THEN left(w, n - 3) || 'i' "
             "WHEN n >= 2 AND ends_with(w, 's') AND substr(w, n - 1, 1) <> 's' THEN left(w, n - 1) ELSE w END"),
        step("p2", f"(SELECT *, CASE WHEN ends_with(w, 'eed') THEN 0 WHEN ends_with(w, 'ed') THEN CASE WHEN {vowel(2)} THEN 2 ELSE 0 END "
             f"WHEN ends_with(w, 'ing') AND {vowel(3)} THEN 3 ELSE 0 END AS cut FROM p1)",
             f"CASE WHEN ends_with(w, 'eed') AND {m(3)} > 0 THEN left(w, n - 1) ELSE left(w, n - cut) END", ", cut"),
        step("p3", "p2", "CASE WHEN cut = 0 THEN w WHEN ends_with(w, 'at') OR ends_with(w, 'bl') OR ends_with(w, 'iz') THEN w || 'e' "
             "WHEN n >= 2 AND right(w, 1) = substr(w, n - 1, 1) AND right(s, 1) = 'c' THEN "
             "CASE WHEN right(w, 1) IN ('l', 's', 'z') THEN w ELSE left(w, n - 1) END "
             f"WHEN {m(0)} = 1 AND {short} THEN w || 'e' ELSE w END"),
        step("p4", "p3", f"CASE WHEN n >= 2 AND ends_with(w, 'y') AND {vowel(1)} THEN left(w, n - 1) || 'i' ELSE w END"),
        step("p5", "p4", swaps(STEM.STEP2)),
        step("p6", "p5", swaps(STEM.STEP3)),
        step("p7", "p6", f"CASE {cut4} ELSE w END"),
        step("p8", "p7", f"CASE WHEN ends_with(w, 'e') AND ({m(0)} > 1 OR ({m(0)} = 1 AND NOT (n >= 4 AND substr(s, n - 3, 3) = 'cvc' "
             "AND substr(w, n - 1, 1) NOT IN ('w', 'x', 'y')))) THEN left(w, n - 1) ELSE w END"),
        f"stems AS (SELECT word, CASE WHEN length(word) <= 2 THEN word WHEN ends_with(w, 'll') AND {m(0)} > 1 "
        "THEN left(w, n - 1) ELSE w END AS stem FROM p8)",
    ])


def hits(tok="tokens", name="hits") -> str:
    return f"""{name} AS (SELECT t.doc_id, t.position, t.surface, t.term, t.start, t."end"
  FROM {tok} t JOIN kt ON t.doc_id = kt.doc_id AND t.term = kt.term)"""


def fragments(h="hits", size=C.FRAGMENT_SIZE, maxf=C.MAX_FRAGMENTS) -> str:
    """hn (numbered hits), frag (recursive walk), kept, grp(doc_id, g, fs, fe)."""
    return f"""hn AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY start) AS hn FROM {h}),
frag AS (
  SELECT doc_id, hn, 1 AS g, start AS fs FROM hn WHERE hn = 1
  UNION ALL
  SELECT h.doc_id, h.hn,
         CASE WHEN h."end" - f.fs <= {size} THEN f.g ELSE f.g + 1 END,
         CASE WHEN h."end" - f.fs <= {size} THEN f.fs ELSE h.start END
  FROM frag f JOIN hn h ON h.doc_id = f.doc_id AND h.hn = f.hn + 1
  WHERE f.g <= {maxf}),
kept AS (SELECT h.*, f.g FROM hn h JOIN frag f USING (doc_id, hn) WHERE f.g <= {maxf}),
grp AS (SELECT doc_id, g, min(start) AS fs, max("end") AS fe FROM kept GROUP BY doc_id, g)"""


def flat_raw(elig="_src", kept="kept") -> str:
    return f"""kw AS (SELECT doc_id, surface, min(start) AS first_start FROM {kept} GROUP BY doc_id, surface),
kwr AS (SELECT doc_id, surface, dense_rank() OVER (PARTITION BY doc_id ORDER BY first_start) - 1 AS kw_rank FROM kw),
occ AS (SELECT k.doc_id, kwr.kw_rank, k.surface AS keyword,
          row_number() OVER (PARTITION BY k.doc_id, k.surface ORDER BY k.start) - 1 AS occ, k.start, k."end"
        FROM {kept} k JOIN kwr USING (doc_id, surface))
SELECT e.doc_id, CAST(kw_rank AS BIGINT) AS kw_rank, keyword, CAST(occ AS BIGINT) AS occ, start, "end"
FROM {elig} e LEFT JOIN occ USING (doc_id)"""


def raw_windows(source="_src", size=C.FRAGMENT_SIZE) -> str:
    left = (f"CASE WHEN ws3 > 0 AND regexp_matches(substr(t, ws3, 2), '^{W}{{2}}$') "
            f"THEN ws3 - length(regexp_extract(reverse(substr(t, 1, ws3)), '^{W}+')) ELSE ws3 END")
    right = (f"CASE WHEN we3 < n AND regexp_matches(substr(t, we3, 2), '^{W}{{2}}$') "
             f"THEN we3 + length(regexp_extract(substr(t, we3 + 1), '^{W}+')) ELSE we3 END")
    return f"""w0 AS (SELECT g.doc_id, g.g, g.fs, g.fe, s.t, length(s.t) AS n,
         lag(g.fe, 1, 0) OVER (PARTITION BY g.doc_id ORDER BY g.g) AS prev_end,
         greatest(0, CAST(floor(({size} - (g.fe - g.fs)) / 2) AS BIGINT)) AS pad
       FROM grp g JOIN {source} s USING (doc_id)),
w1 AS (SELECT *, fs - pad AS ws0, fe + pad AS we0 FROM w0),
w2 AS (SELECT *, CASE WHEN ws0 < 0 THEN 0 ELSE ws0 END AS ws1, CASE WHEN ws0 < 0 THEN {size} ELSE we0 END AS we1 FROM w1),
w3 AS (SELECT *, CASE WHEN we1 > n THEN n - {size} ELSE ws1 END AS ws2, CASE WHEN we1 > n THEN n ELSE we1 END AS we2 FROM w2),
w4 AS (SELECT *, greatest(ws2, 0) AS ws3, least(we2, n) AS we3 FROM w3),
w5 AS (SELECT doc_id, g, t, greatest({left}, prev_end) AS ws, {right} AS we FROM w4)"""


def islands(h="hits", w=C.WINDOW) -> str:
    return f"""isl_f AS (SELECT doc_id, position, CASE WHEN position - lag(position) OVER (PARTITION BY doc_id ORDER BY position) <= {2 * w} THEN 0 ELSE 1 END AS nw FROM {h}),
isl_n AS (SELECT doc_id, position, sum(nw) OVER (PARTITION BY doc_id ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM isl_f),
isl AS (SELECT doc_id, CAST(island AS BIGINT) AS island, CAST(greatest(min(position) - {w}, 0) AS BIGINT) AS lo,
          CAST(max(position) + {w} AS BIGINT) AS hi FROM isl_n GROUP BY doc_id, island)"""


def _raw_base() -> str:
    return ",\n".join([src(), tokens(), keyterms(), hits()])


SQL: dict[str, str] = {}

# --- T ------------------------------------------------------------------------------------
SQL["tokens_with_offsets"] = f"WITH {src()},\n{tokens()}\nSELECT doc_id, position, surface, start, \"end\" FROM tokens"
SQL["tokens_lowercase"] = f"WITH {src()},\n{tokens()}\nSELECT doc_id, position, term FROM tokens"
SQL["tokens_stemmed_light"] = f"WITH {src()},\n{tokens(term=light('lower(surface)'))}\nSELECT doc_id, position, term FROM tokens"
_STEMMED = f"""{src()},
{tokens(name='low')},
words AS (SELECT DISTINCT term AS word FROM low),
{porter('words')},
tokens AS (SELECT doc_id, position, surface, stem AS term, start, "end" FROM low JOIN stems ON low.term = stems.word)"""
SQL["tokens_stemmed_porter"] = f"WITH {_STEMMED}\nSELECT doc_id, position, term FROM tokens"
SQL["analyzed_tokens"] = (f"WITH {src()},\n{tokens(term=light('lower(surface)'))}\n"
                          "SELECT doc_id, position, surface, term, start, \"end\" FROM tokens")
SQL["term_vectors"] = (f"WITH {src()},\n{tokens()}\nSELECT doc_id, term, CAST(row_number() OVER "
                       "(PARTITION BY doc_id, term ORDER BY position) - 1 AS BIGINT) AS occ, position, start, \"end\" FROM tokens")
SQL["tokens_in_order"] = (f"WITH {src()},\n{tokens()}\n"
                          "SELECT doc_id, string_agg(term, ' ' ORDER BY position) AS terms FROM tokens GROUP BY doc_id")
# the word boundaries of Unicode for scripts that write words with letters and part them
_X = "[\\p{M}\\x{AD}\\x{200C}-\\x{200F}\\x{2060}]*"
_L = f"(?:[\\p{{Latin}}\\p{{Greek}}\\p{{Cyrillic}}\\p{{Armenian}}\\p{{Arabic}}\\p{{Devanagari}}\\p{{Hangul}}]{_X})+"
_N = f"(?:\\p{{Nd}}{_X})+"
_BODY = f"(?:{_L}(?:[:.\\x{{B7}}\\x{{2018}}\\x{{2019}}'']{_X}{_L})*|{_N}(?:[,;.\\x{{2018}}\\x{{2019}}'']{_X}{_N})*)+"
_JOIN = f"(?:[\\p{{Pc}}\\x{{202F}}]{_X})"
_STANDARD = f"{_JOIN}*{_BODY}(?:{_JOIN}+{_BODY})*{_JOIN}*"
SQL["tokens_standard"] = f"WITH {src()},\n{tokens(pattern=_STANDARD)}\nSELECT doc_id, position, surface, term, start, \"end\" FROM tokens"
SQL["expand_tokens_punct"] = f"""WITH w AS (SELECT doc_id, unnest(regexp_extract_all(text, '\\S+')) AS x FROM documents WHERE text IS NOT NULL)
SELECT DISTINCT doc_id, token FROM (
  SELECT doc_id, x AS token FROM w
  UNION ALL SELECT doc_id, unnest(regexp_extract_all(x, '[\\p{{L}}\\p{{N}}_]+|[.,!?;"'']')) FROM w
  UNION ALL SELECT doc_id, translate(x, '{PUNCT}', '') FROM w)"""

# --- A ------------------------------------------------------------------------------------
SQL["background_df"] = f"WITH {src()},\n{keyterms()}\nSELECT term, bg_count FROM bg"
SQL["corpus_size"] = "SELECT CAST(count(*) AS BIGINT) AS n_docs FROM documents WHERE text IS NOT NULL"
_FG = f"""gdt AS (SELECT DISTINCT d.source, d.doc_id, lower(x) AS term FROM (SELECT doc_id, source, unnest(regexp_extract_all(text, '{P}')) AS x FROM documents WHERE text IS NOT NULL) d),
fg AS (SELECT source, term, CAST(count(*) AS BIGINT) AS fg_count FROM gdt GROUP BY source, term HAVING count(*) >= {C.GROUP_MIN_DOCS})"""
SQL["foreground_df"] = f"WITH {_FG}\nSELECT source, term, fg_count FROM fg"
SQL["keyterms_per_doc"] = f"WITH {src()},\n{keyterms()}\nSELECT doc_id, term, bg_count, rank FROM kt"
SQL["keyterms_tfidf"] = f"""WITH {src()},
{keyterms()},
tf AS (SELECT doc_id, lower(x) AS term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT doc_id, unnest(regexp_extract_all(t, '{P}')) AS x FROM _src) GROUP BY 1, 2),
sc AS (SELECT tf.doc_id, tf.term, tf.tf, bg.bg_count, round(tf.tf * ln(CAST((SELECT n FROM nd) AS DOUBLE) / bg.bg_count), 9) AS score
       FROM tf JOIN bg USING (term)),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, term) AS rank FROM sc WHERE score > 0)
SELECT doc_id, term, tf, bg_count, round(score, 6) AS score, CAST(rank AS BIGINT) AS rank FROM r
WHERE rank <= {C.K} AND term NOT IN ({STOP}) AND bg_count >= 1"""


def _sig(score_sql: str) -> str:
    return f"""WITH {src()},
{keyterms()},
{_FG},
gn AS (SELECT source, CAST(count(*) AS BIGINT) AS fg_n FROM documents WHERE text IS NOT NULL GROUP BY source),
j AS (SELECT fg.source, fg.term, fg.fg_count, bg.bg_count, gn.fg_n,
        CAST(fg.fg_count AS DOUBLE) AS k11, CAST(bg.bg_count AS DOUBLE) AS c1, CAST(gn.fg_n AS DOUBLE) AS r1,
        CAST((SELECT n FROM nd) AS DOUBLE) AS nn
      FROM fg JOIN bg USING (term) JOIN gn USING (source)),
s AS (SELECT *, {score_sql} AS score FROM j WHERE k11 * nn > c1 * r1),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY round(score, 9) DESC, term) AS rank FROM s)
SELECT source, term, fg_count, bg_count, round(score, 6) AS score, CAST(rank AS BIGINT) AS rank FROM r WHERE rank <= {C.GROUP_TOP}"""


def _xl(k, row, col):
    return f"(CASE WHEN {k} > 0 THEN {k} * ln(({k} * nn) / ({row} * {col})) ELSE 0.0 END)"


SQL["significant_terms_by_group"] = _sig("(k11 * nn) / (r1 * c1)")
SQL["significant_terms_llr"] = _sig(
    "2.0 * (" + " + ".join([_xl("k11", "r1", "c1"), _xl("(r1 - k11)", "r1", "(nn - c1)"),
                            _xl("(c1 - k11)", "(nn - r1)", "c1"), _xl("(nn - r1 - c1 + k11)", "(nn - r1)", "(nn - c1)")]) + ")")
SQL["sampled_foreground"] = f"""SELECT source, doc_id FROM (
  SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS rn
  FROM documents WHERE text IS NOT NULL) WHERE rn <= {C.SAMPLE_SIZE}"""
_SH = C.SHINGLE
_SHARD = f"('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8))::BIGINT % {C.SAMPLE_SHARDS}"


def dedup(tl: str = "tl", grp: str = "lang", shingle: int = _SH) -> str:
    """CTEs sh .. dr over token rows ``tl(doc_id, position, term, grp)``; ``dr`` holds
    the (grp, doc_id, position) of tokens covered only by repeated passages.  A passage is known by
    a hash; one window over a document's positions tells what covers each token."""
    leads = ", ".join(f"lead(term, {i}) OVER w" for i in range(1, shingle))
    return f"""sh AS (SELECT {grp}, doc_id, position, CASE WHEN lead(term, {shingle - 1}) OVER w IS NOT NULL
          THEN md5_number(concat_ws(chr(1), term, {leads})) END AS passage
        FROM {tl} WINDOW w AS (PARTITION BY doc_id ORDER BY position)),
own AS (SELECT {grp}, passage, min((doc_id, position)) AS o FROM sh WHERE passage IS NOT NULL AND {grp} IS NOT NULL GROUP BY {grp}, passage),
fl AS (SELECT s.{grp}, s.doc_id, s.position, coalesce((s.doc_id, s.position) = o.o, FALSE) AS kept,
         coalesce((s.doc_id, s.position) <> o.o, FALSE) AS copied
       FROM sh s LEFT JOIN own o USING ({grp}, passage)),
dr AS (SELECT {grp}, doc_id, position FROM (
         SELECT *, max(copied) OVER v AS c, max(kept) OVER v AS k FROM fl
         WINDOW v AS (PARTITION BY doc_id ORDER BY position ROWS BETWEEN {shingle - 1} PRECEDING AND CURRENT ROW))
       WHERE c AND NOT k)"""


SQL["drop_duplicate_passages"] = f"""WITH {src()},
{tokens()},
tl AS (SELECT t.doc_id, t.position, t.term, d.lang FROM tokens t JOIN documents d USING (doc_id)),
{dedup()}
SELECT doc_id, position, term FROM tl ANTI JOIN dr USING (lang, doc_id, position)"""
SQL["significant_terms_sampled"] = f"""WITH {src()},
{keyterms()},
samp AS (SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS rn
         FROM documents WHERE text IS NOT NULL) WHERE rn <= {C.GROUP_SHARD}),
_ssrc AS (SELECT doc_id, t FROM _src WHERE doc_id IN (SELECT doc_id FROM samp)),
{tokens(source='_ssrc', name='stok')},
tl AS (SELECT t.doc_id, t.position, t.term, s.source FROM stok t JOIN samp s USING (doc_id)),
{dedup('tl', 'source')},
kept AS (SELECT * FROM tl ANTI JOIN dr USING (source, doc_id, position)),
fg AS (SELECT source, term, CAST(count(DISTINCT doc_id) AS BIGINT) AS fg_count FROM kept GROUP BY source, term
       HAVING count(DISTINCT doc_id) >= {C.GROUP_MIN_DOCS}),
gn AS (SELECT source, CAST(count(*) AS BIGINT) AS fg_n FROM samp GROUP BY source),
j AS (SELECT fg.source, fg.term, fg.fg_count, bg.bg_count,
        CAST(fg.fg_count AS DOUBLE) AS k11, CAST(bg.bg_count AS DOUBLE) AS c1, CAST(gn.fg_n AS DOUBLE) AS r1,
        CAST((SELECT n FROM nd) AS DOUBLE) AS nn
      FROM fg JOIN bg USING (term) JOIN gn USING (source)),
s AS (SELECT *, (k11 * nn) / (r1 * c1) AS score FROM j WHERE k11 * nn > c1 * r1),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY round(score, 9) DESC, term) AS rank FROM s)
SELECT source, term, fg_count, bg_count, round(score, 6) AS score, CAST(rank AS BIGINT) AS rank FROM r WHERE rank <= {C.GROUP_TOP}"""
SQL["stopword_filter"] = (f"WITH {src()},\n{keyterms()}\nSELECT doc_id, term FROM dt WHERE term NOT IN ({STOP})")
SQL["min_bg_filter"] = f"WITH {src()},\n{keyterms()}\nSELECT term, bg_count FROM bg WHERE bg_count >= {C.MIN_BG_FILTER}"

# --- H ------------------------------------------------------------------------------------
_BASE = _raw_base()
SQL["keyterm_occurrences"] = f"WITH {_BASE}\nSELECT doc_id, term, position, start, \"end\" FROM hits"
SQL["keyterm_hits"] = f"WITH {_BASE}\nSELECT doc_id, position, surface, term, start, \"end\" FROM hits"
SQL["sampled_foreground_hits"] = f"""WITH {_BASE},
nh AS (SELECT d.doc_id, d.source, (SELECT count(*) FROM hits h WHERE h.doc_id = d.doc_id) AS hits
       FROM documents d WHERE text IS NOT NULL)
SELECT source, doc_id, CAST(hits AS BIGINT) AS hits FROM (
  SELECT *, row_number() OVER (PARTITION BY source, {_SHARD} ORDER BY hits DESC, doc_id) AS rn FROM nh) WHERE rn <= {C.SAMPLE_SIZE}"""
for _key in ("surface", "term"):
    SQL[f"offsets_by_{_key}"] = (
        f"WITH {_BASE}\nSELECT doc_id, {_key}, min(start) OVER w AS first_start, "
        f"CAST(row_number() OVER (PARTITION BY doc_id, {_key} ORDER BY start) - 1 AS BIGINT) AS occ, start, \"end\" "
        f"FROM hits WINDOW w AS (PARTITION BY doc_id, {_key})")
_MARK = f"""{_BASE},
hd AS (SELECT DISTINCT doc_id FROM hits),
mk AS (SELECT t.doc_id, t.position, t.surface, t.start, t."end", h.doc_id IS NOT NULL AS is_hit,
         lag(t."end", 1, 0) OVER (PARTITION BY t.doc_id ORDER BY t.position) AS prev_end
       FROM tokens t LEFT JOIN hits h ON h.doc_id = t.doc_id AND h.position = t.position
       WHERE t.doc_id IN (SELECT doc_id FROM hd)),
marked AS (SELECT m.doc_id, string_agg(substr(s.t, m.prev_end + 1, m.start - m.prev_end) ||
             CASE WHEN m.is_hit THEN '<em>' || m.surface || '</em>' ELSE m.surface END, '' ORDER BY m.position)
             || substr(s.t, max(m."end") + 1) AS marked
           FROM mk m JOIN _src s USING (doc_id) GROUP BY m.doc_id, s.t)"""
SQL["highlighted_text"] = f"WITH {_MARK}\nSELECT doc_id, marked FROM marked"
SQL["marked_terms"] = (f"WITH {_MARK}\nSELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY start) - 1 AS BIGINT) AS i, "
                       "surface AS term FROM hits")
SQL["unmarked_text"] = f"WITH {_BASE}\nSELECT doc_id, t AS text FROM _src WHERE doc_id IN (SELECT doc_id FROM hits)"
SQL["parse_offset_strings"] = (f"WITH {_BASE}\nSELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY start) - 1 AS BIGINT) AS i, "
                               "start, \"end\" FROM hits")
SQL["zip_terms_offsets"] = (f"WITH {_BASE}\nSELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY start) - 1 AS BIGINT) AS i, "
                            "surface AS term, start, \"end\" FROM hits")

# --- K, W ----------------------------------------------------------------------------------
_FRAG = f"{_BASE},\n{fragments()}"
SQL["first_fragments"] = f"""WITH RECURSIVE {_FRAG},
nh AS (SELECT doc_id, CAST(count(*) AS BIGINT) AS n_hits FROM hits GROUP BY doc_id),
nk AS (SELECT doc_id, CAST(count(*) AS BIGINT) AS n_kept, CAST(max(g) AS BIGINT) AS n_fragments FROM kept GROUP BY doc_id)
SELECT doc_id, n_fragments, n_hits, n_kept FROM nh JOIN nk USING (doc_id)"""
SQL["context_windows"] = f"WITH {_BASE},\n{islands()}\nSELECT doc_id, island, lo, hi FROM isl"

# --- E ---------------------------------------------------------------------------------------
SQL["extract_raw"] = f"WITH RECURSIVE {_FRAG},\n{flat_raw()}"
SQL["raw_contexts"] = (f"WITH RECURSIVE {_FRAG},\n{raw_windows()}\n"
                       "SELECT doc_id, CAST(g - 1 AS BIGINT) AS ctx_rank, substr(t, ws + 1, we - ws) AS context FROM w5")
_LIGHT_BASE = ",\n".join([src(), tokens(term=light("lower(surface)")), keyterms(term=light("lower(x)")), hits()])
def flat_analyzed(base: str) -> str:
    return f"""WITH {base},
kwr AS (SELECT DISTINCT doc_id, term, dense_rank() OVER (PARTITION BY doc_id ORDER BY term) - 1 AS kw_rank FROM hits),
occ AS (SELECT h.doc_id, kwr.kw_rank, h.term AS keyword, row_number() OVER (PARTITION BY h.doc_id, h.term ORDER BY h.start) - 1 AS occ,
          h.start, h."end" FROM hits h JOIN kwr USING (doc_id, term))
SELECT e.doc_id, CAST(kw_rank AS BIGINT) AS kw_rank, keyword, CAST(occ AS BIGINT) AS occ, start, "end"
FROM _src e LEFT JOIN occ USING (doc_id)"""


_PORTER_BASE = ",\n".join([_STEMMED, keyterms(dt="SELECT DISTINCT doc_id, term FROM tokens"), hits()])
SQL["extract_analyzed"] = flat_analyzed(_LIGHT_BASE)
SQL["extract_analyzed_porter"] = flat_analyzed(_PORTER_BASE)
SQL["analyzed_contexts"] = f"""WITH {_LIGHT_BASE},
{islands()}
SELECT i.doc_id, CAST(i.island - 1 AS BIGINT) AS ctx_rank, string_agg(t.term, ' ' ORDER BY t.position) AS context
FROM isl i JOIN tokens t ON t.doc_id = i.doc_id AND t.position BETWEEN i.lo AND i.hi
GROUP BY i.doc_id, i.island"""
SQL["analyzed_contexts_vocab"] = f"""WITH {_LIGHT_BASE},
{islands()},
vocab AS (SELECT doc_id, term, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY term) - 1 AS BIGINT) AS vi
          FROM (SELECT DISTINCT doc_id, term FROM tokens WHERE doc_id IN (SELECT doc_id FROM hits)))
SELECT i.doc_id, CAST(i.island - 1 AS BIGINT) AS ctx_rank, coalesce(string_agg(v.term, ' ' ORDER BY v.vi), '') AS context
FROM isl i LEFT JOIN vocab v ON v.doc_id = i.doc_id AND v.vi >= i.lo AND v.vi < i.hi
GROUP BY i.doc_id, i.island"""
SQL["docs_without_keyterms"] = f"""WITH {",".join([src(), tokens(), keyterms(min_bg=C.NULL_RESULT_MIN_BG), hits()])}
SELECT doc_id FROM _src WHERE doc_id NOT IN (SELECT doc_id FROM hits)"""

_PAGES = (f"(SELECT page_id, regexp_extract(html, '{SRC.TITLE_PATTERN}', 1) AS title, "
          f"regexp_replace(regexp_extract(html, '{SRC.BODY_PATTERN}', 1), '{SRC.TAG_PATTERN}', ' ', 'g') AS body FROM pages)")
SQL["cross_field_hits"] = f"""WITH RECURSIVE pf AS {_PAGES},
_ksrc AS (SELECT page_id AS doc_id, title AS t FROM pf WHERE title IS NOT NULL),
_elig AS (SELECT page_id AS doc_id FROM pf WHERE title IS NOT NULL AND body IS NOT NULL),
_hsrc AS (SELECT page_id AS doc_id, body AS t FROM pf WHERE title IS NOT NULL AND body IS NOT NULL),
{tokens(source='_hsrc')},
{keyterms(source='_ksrc', elig='_elig')},
{hits()},
{fragments()},
{flat_raw(elig='_elig')}""".replace("SELECT e.doc_id,", "SELECT e.doc_id AS page_id,")
# every keyterm's words, the longest sequence at each token, then hits that do not overlap
SQL["cross_analyzer_hits"] = f"""WITH RECURSIVE {src()},
{tokens()},
{keyterms(dt="SELECT DISTINCT doc_id, lower(x) AS term FROM (SELECT doc_id, unnest(regexp_extract_all(t, '" + chr(92) + "S+')) AS x FROM _src)")},
ph AS (SELECT doc_id, term, list_transform(regexp_extract_all(term, '{P}'), lambda x: lower(x)) AS words FROM kt),
td AS (SELECT doc_id, list(term ORDER BY position) AS terms, list("end" ORDER BY position) AS ends FROM tokens GROUP BY doc_id),
ca AS (SELECT t.doc_id, t.position, t.start, td.ends[t.position + len(p.words)] AS "end", p.term, len(p.words) AS n
       FROM tokens t JOIN ph p ON p.doc_id = t.doc_id AND len(p.words) > 0 AND p.words[1] = t.term JOIN td ON td.doc_id = t.doc_id
       WHERE td.terms[t.position + 1 : t.position + len(p.words)] = p.words),
lo AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, position ORDER BY n DESC, term) AS rn FROM ca) WHERE rn = 1),
fo AS (SELECT doc_id, list_reduce(list({{'upto': "end", 'kept': [position]}} ORDER BY position), lambda a, c:
         CASE WHEN a.upto > starts[c.kept[1] + 1] THEN a ELSE {{'upto': c.upto, 'kept': list_concat(a.kept, c.kept)}} END).kept AS kept
       FROM (SELECT lo.*, s.starts FROM lo JOIN (SELECT doc_id, list(start ORDER BY position) AS starts FROM tokens GROUP BY doc_id) s USING (doc_id))
       GROUP BY doc_id, starts),
hits AS (SELECT lo.doc_id, lo.position, substr(s.t, lo.start + 1, lo."end" - lo.start) AS surface, lo.term, lo.start, lo."end"
         FROM lo JOIN fo ON fo.doc_id = lo.doc_id AND list_contains(fo.kept, lo.position) JOIN _src s ON s.doc_id = lo.doc_id),
{fragments()},
{flat_raw()}"""
# results_with_text / incremental: the flattened raw result joined or filtered.
SQL["results_with_text"] = f"""WITH RECURSIVE {_FRAG},
{flat_raw().rsplit('SELECT e.doc_id', 1)[0].rstrip().rstrip(',')}
SELECT o.doc_id, o.keyword, o.start, o."end", d.text, d.lang, d.n_chars FROM occ o LEFT JOIN documents d USING (doc_id)"""
_KNOWN = "known AS (SELECT doc_id FROM documents WHERE text IS NOT NULL AND doc_id IN (SELECT doc_id FROM labels))"
SQL["extract_with_stored_background"] = f"""WITH RECURSIVE {src()},
{_KNOWN},
{tokens()},
{keyterms(known='known')},
{hits()},
{fragments()},
{flat_raw()}"""
SQL["incremental_extract"] = f"""WITH RECURSIVE {_FRAG},
_elig AS (SELECT doc_id FROM _src WHERE doc_id NOT IN (
  SELECT doc_id FROM labels WHERE quality IS NOT NULL AND doc_id IN (SELECT doc_id FROM hits))),
{flat_raw(elig='_elig')}"""

SQL["incremental_first_run"] = SQL["extract_raw"]
SQL["schemaless_extract"] = f"""WITH RECURSIVE {_FRAG},
_elig AS (SELECT doc_id FROM _src WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality IS NOT NULL)
  AND doc_id IN (SELECT doc_id FROM documents WHERE source IS NOT NULL)),
{flat_raw(elig='_elig')}"""
SQL["schemaless_eligible"] = ("SELECT doc_id, lang FROM documents JOIN labels USING (doc_id) "
                              "WHERE text IS NOT NULL AND quality IS NOT NULL")

# --- S, P ------------------------------------------------------------------------------------
_LAB = "(SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id))"
SQL["eligible_docs"] = f"SELECT doc_id, lang, source, n_chars, quality, toxic FROM {_LAB} WHERE text IS NOT NULL AND quality IS NOT NULL"
SQL["eligible_ids"] = "SELECT doc_id FROM documents WHERE text IS NOT NULL"
SQL["must_have_fields"] = f"SELECT doc_id FROM {_LAB} WHERE text IS NOT NULL AND quality IS NOT NULL"
SQL["must_not_have_fields"] = f"SELECT doc_id FROM {_LAB} WHERE text IS NOT NULL AND quality IS NULL"
SQL["random_order_docs"] = f"SELECT doc_id, md5(CAST(doc_id AS VARCHAR) || ':{C.RANDOM_SEED}') AS shuffle_key FROM documents"
SQL["docs_by_id"] = "SELECT doc_id, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)"
SQL["sentences_to_docs"] = f"""SELECT conv_id, CAST(floor(turn / {C.SENTENCES_PER_DOC}) AS BIGINT) AS doc_no,
  string_agg(text, ' ' ORDER BY turn) AS text, CAST(count(*) AS BIGINT) AS n_pieces
FROM conversations WHERE text IS NOT NULL GROUP BY conv_id, floor(turn / {C.SENTENCES_PER_DOC})"""

# --- U ---------------------------------------------------------------------------------------
_UPD = f"""{src()},
{keyterms()},
{src('_bsrc', 'benchmark', f'item_id + {C.UNKNOWN_ID_BASE}')},
{keyterms('_bsrc', '_bsrc', p='b_')},
kws AS (SELECT doc_id, string_agg(term, ' ' ORDER BY term) AS kw FROM kt GROUP BY doc_id),
upd AS (SELECT l.doc_id, CASE WHEN l.toxic = 0 THEN k.kw END AS keywords
        FROM labels l JOIN documents d USING (doc_id) LEFT JOIN kws k USING (doc_id) WHERE l.quality IS NOT NULL
        UNION ALL
        SELECT b.doc_id, string_agg(k.term, ' ' ORDER BY k.term) AS keywords FROM _bsrc b LEFT JOIN b_kt k USING (doc_id) GROUP BY b.doc_id),
tgt AS (SELECT doc_id, lang, source AS keywords FROM documents)"""
SQL["apply_updates"] = f"""WITH {_UPD}
SELECT t.doc_id, t.lang, CASE WHEN u.doc_id IS NOT NULL THEN u.keywords ELSE t.keywords END AS keywords
FROM tgt t LEFT JOIN upd u USING (doc_id)"""
SQL["upsert_updates"] = f"""WITH {_UPD}
SELECT coalesce(t.doc_id, u.doc_id) AS doc_id, t.lang, CASE WHEN u.doc_id IS NOT NULL THEN u.keywords ELSE t.keywords END AS keywords
FROM tgt t FULL OUTER JOIN upd u ON t.doc_id = u.doc_id"""
SQL["merge_by_mode"] = f"""WITH {_UPD}
SELECT t.doc_id, t.lang, CASE WHEN u.doc_id IS NOT NULL THEN u.keywords ELSE t.keywords END AS keywords, 'update' AS mode
FROM tgt t LEFT JOIN upd u USING (doc_id)
UNION ALL
SELECT coalesce(t.doc_id, u.doc_id), t.lang, CASE WHEN u.doc_id IS NOT NULL THEN u.keywords ELSE t.keywords END, 'upsert'
FROM tgt t FULL OUTER JOIN upd u ON t.doc_id = u.doc_id"""
SQL["rejected_updates"] = f"WITH {_UPD}\nSELECT doc_id, keywords FROM upd WHERE doc_id NOT IN (SELECT doc_id FROM tgt)"
SQL["update_counts"] = f"""WITH {_UPD}
SELECT status, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT CASE WHEN u.doc_id IS NOT NULL THEN 'updated' ELSE 'unchanged' END AS status FROM tgt t LEFT JOIN upd u USING (doc_id)) GROUP BY status
UNION ALL
SELECT 'rejected', CAST(count(*) AS BIGINT) FROM upd WHERE doc_id NOT IN (SELECT doc_id FROM tgt)"""

# --- V: no violation, and as many things checked as the SQL extraction reports --------------
SQL["extract_stored_vectors"] = SQL["extract_raw"]
SQL["contexts_stored_vectors"] = SQL["analyzed_contexts"]
SQL["delta_updates"] = SQL["apply_updates"]
SQL["delta_upserts"] = SQL["upsert_updates"]

def _checked(name: str, counted: str) -> str:
    return f"SELECT '{name}' AS \"check\", CAST(0 AS BIGINT) AS violations, CAST(count(*) AS BIGINT) AS checked FROM {counted}"


SQL["audit_offsets"] = f"WITH RECURSIVE {_FRAG}\n{_checked('offsets', 'kept')}"
for _name in ("keyterms", "contexts"):
    SQL[f"audit_{_name}"] = f"WITH RECURSIVE {_FRAG}\n{_checked(_name, '(SELECT DISTINCT doc_id, surface FROM kept)')}"
SQL["audit_keyterm_words"] = (
    f"WITH RECURSIVE {_FRAG}\n{_checked('keyterm words', '(SELECT DISTINCT doc_id, surface FROM kept)')}\n"
    f"UNION ALL {_checked('context words', '(SELECT DISTINCT doc_id, surface FROM kept)')}")
SQL["audit_analyzed"] = f"WITH {_PORTER_BASE}\n{_checked('analyzed', '(SELECT DISTINCT doc_id FROM hits)')}"
SQL["audit_scope"] = _checked("scope", f"{_LAB} WHERE text IS NOT NULL AND quality IS NOT NULL")


# The stream drains the whole table against the stored background of the whole table, so
# its rows equal the batch extraction's.
SQL["stream_extract"] = SQL["extract_raw"]
SQL["stream_live_background"] = SQL["extract_raw"]


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in SQL.items() if k in C.QUERIES}
