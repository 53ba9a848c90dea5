"""T1, standard segmentation: words by the default word boundaries of Unicode (UAX #29).

The boundary rules become one regular expression that Spark evaluates natively: a word is the
longest stretch without a boundary that holds a letter, digit or kana.  What the rules ignore
(combining marks, format characters, joiners: WB4) stays with the character before it, so a
decomposed ``é`` splits no word.  Ideographs and Hiragana are words of one character, as the
default rules have it; so are the characters of scripts that need a dictionary (Thai, Lao, Khmer,
Myanmar ...).  Emoji and flags are no words.

Quantifiers are possessive: a word never gives back, and Java's matcher does not recurse.
"""

from __future__ import annotations

# --- fixed values: the Word_Break classes of UAX #29, as Java character classes -----------------
EXTEND = r"\p{Mn}\p{Me}\p{Mc}\x{200C}\x{200D}\x{FF9E}\x{FF9F}\x{1F3FB}-\x{1F3FF}"
FORMAT = r"\x{00AD}\x{061C}\x{180E}\x{200E}\x{200F}\x{202A}-\x{202E}\x{2060}-\x{2064}\x{2066}-\x{206F}\x{FEFF}\x{FFF9}-\x{FFFB}\x{E0001}\x{E0020}-\x{E007F}"
HEBREW = r"[\p{IsHebrew}&&[\p{Lo}]]"
KATAKANA = r"\p{IsKatakana}\x{3031}-\x{3035}\x{309B}\x{309C}\x{30A0}\x{30FC}\x{FF70}"
COMPLEX = r"\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}\p{IsTai_Le}\p{IsNew_Tai_Lue}\p{IsTai_Tham}\p{IsTai_Viet}\p{IsAhom}"
LETTER = (r"[\p{IsAlphabetic}\x{02C2}-\x{02C5}\x{02D2}-\x{02D7}\x{02DE}\x{02DF}\x{02E5}-\x{02EB}\x{02ED}\x{02EF}-\x{02FF}\x{055A}-\x{055C}\x{055E}\x{058A}"
          r"\x{05F3}\x{A708}-\x{A716}\x{A720}\x{A721}\x{A789}\x{A78A}\x{AB5B}&&"
          rf"[^\p{{IsIdeographic}}\p{{IsHiragana}}\p{{Nd}}{KATAKANA}{COMPLEX}{EXTEND}]]")
NUMERIC = r"[\p{Nd}\x{066B}\x{0600}-\x{0605}\x{06DD}\x{070F}\x{0890}\x{0891}\x{08E2}\x{110BD}\x{110CD}]"
MID_LETTER = r":\x{00B7}\x{0387}\x{055F}\x{05F4}\x{2027}\x{FE13}\x{FE55}\x{FF1A}"
MID_NUMBER = r",;\x{037E}\x{0589}\x{060C}\x{060D}\x{066C}\x{07F8}\x{2044}\x{FE10}\x{FE14}\x{FE50}\x{FE54}\x{FF0C}\x{FF1B}"
MID_BOTH = r".\x{2018}\x{2019}\x{2024}\x{FE52}\x{FF07}\x{FF0E}'"
JOINER = r"[\p{Pc}\x{202F}]"
ASCII_OTHER = r"[\x00-\x2F\x3A-\x40\x5B-\x5E\x60\x7B-\x7F]"  # begins no word
ASCII_APART = r"[\x00-\x21\x23-\x26\x28-\x2B\x2D\x2F\x3C-\x40\x5B-\x5E\x60\x7B-\x7F]"  # nor is within one
SINGLE = rf"[\p{{IsIdeographic}}\p{{IsHiragana}}[{COMPLEX}&&[\p{{IsAlphabetic}}&&[^{EXTEND}]]]]"
# ---------------------------------------------------------------------------------------------------


def standard_pattern() -> str:
    skip = f"[{EXTEND}{FORMAT}]*+"  # WB4

    def some(cls: str) -> str:
        return f"(?:{cls}{skip})++"

    # the letters of ASCII first: the class of all letters is slow to test
    word_letters = f"(?:(?:[A-Za-z]++|{LETTER}){skip})++"
    after_hebrew = f"(?<={HEBREW}[{EXTEND}{FORMAT}]{{0,8}})"
    letters = (
        f"{word_letters}(?:(?:[{MID_LETTER}{MID_BOTH}]{skip}"  # WB5-7
        f"|(?=\"){after_hebrew}\"{skip}(?={HEBREW})){word_letters})*+")  # WB7b, c
    numbers = f"{some(NUMERIC)}(?:[{MID_NUMBER}{MID_BOTH}]{skip}{some(NUMERIC)})*+"  # WB8, 11, 12
    body = f"(?:(?:{letters}|{numbers})++|{some(f'[{KATAKANA}]')})"  # WB8-10, WB13
    joined = f"(?:{JOINER}{skip})"  # WB13a, b
    word = f"{joined}*+{body}(?:{joined}++{body})*+{joined}*+(?:(?='){after_hebrew}'{skip})?+"  # WB7a
    # most words: ASCII alone, and what follows joins nothing to them
    plain = f"_*+[0-9A-Za-z][0-9A-Za-z_]*+(?=[.,:;'\"]?+(?:{ASCII_APART}|\\z))"
    return f"(?!{ASCII_OTHER})(?:{plain}|{word}|{SINGLE}{skip})"


STANDARD_PATTERN = standard_pattern()
