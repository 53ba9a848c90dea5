"""Column-level text functions: tokens, case folding, stemming, marks, offset strings.

Everything here returns a ``Column`` built from native Spark expressions, so it runs in
the JVM.  The only Python on the hot path is the Porter stemmer (``functions.stem``), an
Arrow UDF that stems each distinct word of an Arrow batch once.
"""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -------------------------------------------------------------------
# Token pattern: runs of letters, digits and underscore, joined by a single apostrophe
# (straight or curly) or full stop when a word character follows.  "He'll" stays whole,
# "U.S." gives "U.S", "Ky." gives "Ky", "22-year-old" gives "22", "year", "old".
# Possessive quantifiers: Java's matcher recurses once per repeat of a group that may give
# back, and a token of a few thousand dotted parts would overflow the executor's stack.
TOKEN_PATTERN = r"[\p{L}\p{N}_]++(?:['’.][\p{L}\p{N}_]++)*+"
# The same tokens in the form the SQL twins need (no possessive quantifiers there).
SQL_TOKEN_PATTERN = r"[\p{L}\p{N}_]+(?:['’.][\p{L}\p{N}_]+)*"
# The audits' word splitter, first rule that applies.
SPLITTER_PATTERN = (
    r"[hH][tT][tT][pP][sS]?://[^\s<>\"]++"                       # URLs
    r"|(?:\p{L}\.){2,}+"                                        # abbreviations with their full stops
    r"|\p{Nd}++(?:[.,:]\p{Nd}++)*+"                            # numbers, times, decimals
    r"|[nN]['\u2019][tT](?![\p{L}\p{N}_])"                      # endings of contractions
    r"|['\u2019](?:[sSdDmM]|[rR][eE]|[vV][eE]|[lL][lL])(?![\p{L}\p{N}_])"
    r"|[\p{L}\p{M}\p{N}_]+?(?=[nN]['\u2019][tT](?![\p{L}\p{N}_]))"  # what stands before n't
    r"|[\p{L}\p{M}\p{N}_]++(?:-[\p{L}\p{M}\p{N}_]++)*+"       # words, joined by hyphens
    r"|\S")
# Tokens of the white-space analyzer.
WHITESPACE_PATTERN = r"\S+"
# A single word character, used to grow fragment windows to whole words.
WORD_CHAR = r"[\p{L}\p{N}_]"
# Marks put round hits by the highlighter.
LEFT_MARK = "<em>"
RIGHT_MARK = "</em>"
# Pieces of a token for the keyterm audit: words, and these marks each by itself.
MARKS = ".,!?;\"'"
PIECE_PATTERN = r"[\p{L}\p{N}_]+|[" + MARKS + "]"
# Python's string.punctuation, the set stripped from terms by the keyterm audit.
PUNCTUATION = string.punctuation
# -------------------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` as a lambda variable.

    An array expression referenced inside a higher-order function's lambda is evaluated
    again for every element; binding it first keeps per-document work linear."""
    return F.element_at(F.transform(F.array(_c(value)), body), 1)


def token_array(text, pattern: str = TOKEN_PATTERN) -> Column:
    """T1, no offsets: the tokens of ``text`` in order (array<string>)."""
    return F.regexp_extract_all(_c(text), F.lit(pattern), 0)


def gap_array(text, pattern: str = TOKEN_PATTERN) -> Column:
    """The strings between tokens: element i precedes token i, one more than tokens."""
    return F.split(_c(text), pattern, -1)


def lower_terms(tokens) -> Column:
    """T2 over an array column."""
    return F.transform(_c(tokens), lambda t: F.lower(t))


def light_stem(term) -> Column:
    """T3, native light option: the S-stemmer for English plurals (Harman 1991).

    Rules, first that applies: ``-ies`` (not ``-eies``/``-aies``) -> ``-y``;
    ``-es`` (not ``-aes``/``-ees``/``-oes``) -> ``-e``; ``-s`` (not ``-us``/``-ss``) -> drop.
    Each rule needs a character before the suffix.  Written with suffix tests and
    ``substring`` rather than regular expressions: it runs once per token.
    """
    t = _c(term)
    n = F.length(t)

    def before(k):  # the character just before a suffix of length k
        return F.substring(t, n - k, 1)

    def stem(k, repl):
        return F.concat(F.substring(t, F.lit(1), n - k), F.lit(repl))

    return (
        F.when((n > 3) & F.endswith(t, F.lit("ies")) & ~before(3).isin("e", "a"), stem(3, "y"))
        .when((n > 2) & F.endswith(t, F.lit("es")) & ~before(2).isin("a", "e", "o"), stem(2, "e"))
        .when((n > 1) & F.endswith(t, F.lit("s")) & ~before(1).isin("u", "s"), stem(1, ""))
        .otherwise(t)
    )


def strip_punct(term) -> Column:
    """Remove ASCII punctuation characters from a term."""
    return F.translate(_c(term), PUNCTUATION, "")


def expand_punct(tokens) -> Column:
    """Add to a token set its tokens' pieces and stripped forms.

    Pieces are runs of letters, digits and underscores, and every mark of ``MARKS`` by itself; a
    stripped form lacks all ASCII punctuation.  "22-year-old!" adds "22", "year", "old", "!" and
    "22yearold".
    """
    t = _c(tokens)
    pieces = F.flatten(F.transform(t, lambda x: F.regexp_extract_all(x, F.lit(PIECE_PATTERN), 0)))
    stripped = F.transform(t, strip_punct)
    return F.array_distinct(F.concat(t, pieces, stripped))


def split_words(text) -> Column:
    """An independent word splitter by rules, for audits: URLs, abbreviations and numbers stay whole,
    contractions are cut before their ending, hyphens join, every other mark is a word by itself."""
    return F.regexp_extract_all(_c(text), F.lit(SPLITTER_PATTERN), 0)


def mark_terms(text, hits) -> Column:
    """H3: splice ``<em>``/``</em>`` round each hit of ``hits`` (array<struct<start,end>>,
    sorted, disjoint, 0-based end-exclusive code-point offsets) into ``text``."""
    t = _c(text)

    def marked(h):
        def piece(x, i):
            prev_end = F.when(i == 0, F.lit(0)).otherwise(F.element_at(h, i)["end"])
            gap = F.substring(t, prev_end + 1, x["start"] - prev_end)
            word = F.substring(t, x["start"] + 1, x["end"] - x["start"])
            return F.concat(gap, F.lit(LEFT_MARK), word, F.lit(RIGHT_MARK))

        last_end = F.coalesce(F.try_element_at(h, F.lit(-1))["end"], F.lit(0))
        tail = F.substring(t, last_end + 1, F.length(t) - last_end + 1)
        return F.concat(F.array_join(F.transform(h, piece), ""), tail)

    return let(hits, marked)


def marked_terms(line) -> Column:
    """H4: the marked substrings, in order (no match across a line break)."""
    return F.regexp_extract_all(_c(line), F.lit(f"{LEFT_MARK}(.*?){RIGHT_MARK}"), 1)


def unmark(line) -> Column:
    """H5: drop the marks."""
    return F.regexp_replace(_c(line), f"{LEFT_MARK}|{RIGHT_MARK}", "")


def parse_offsets(line) -> Column:
    """H6: ``x:s-e,s-e,...:y`` -> array<struct<start:bigint,end:bigint>>."""
    ranges = F.split(F.split_part(_c(line), F.lit(":"), F.lit(2)), ",")
    return F.transform(
        ranges,
        lambda r: F.struct(
            F.split_part(r, F.lit("-"), F.lit(1)).cast("bigint").alias("start"),
            F.split_part(r, F.lit("-"), F.lit(2)).cast("bigint").alias("end"),
        ),
    )
