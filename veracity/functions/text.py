"""Column expressions for per-review text signals.

Everything here returns a ``Column`` built from Spark's own string and regex
functions, so it runs inside whole-stage codegen with no Python in the task.
Regexes are Java patterns. Word boundaries are written as explicit
look-arounds over letters, digits and '_' (Unicode), the same rule the
original scripts got from Python's ``\\b``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from veracity.functions import lexicons as lx

WORD_CHAR = r"[\p{L}\p{N}_]"
# Python's str.split() whitespace: Unicode White_Space plus the four
# information separators U+001C..U+001F. Java's (?U)\s is the first part; the
# class below is an order of magnitude faster than listing every range.
TOKEN_PATTERN = r"(?U)[^\s\u001C-\u001F]+"
# The same set written out, for engines without a Unicode \s (the oracle).
WHITESPACE_CLASS = (r"\t\n\x0B\f\r\x1C-\x1F \x85\xA0\x{1680}\x{2000}-\x{200A}"
                    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")

# Every character Python's str.strip() removes (derived, not listed).
WHITESPACE_CHARS = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def strip(col: Column) -> Column:
    """Remove leading and trailing whitespace (Python's definition)."""
    return F.btrim(col, F.lit(WHITESPACE_CHARS))


def _alternation(words: Sequence[str]) -> str:
    # Lexicon entries are plain lowercase words and spaces: no escaping needed.
    for w in words:
        if not all(ch.isalnum() or ch == " " for ch in w):
            raise ValueError(f"lexicon entry needs escaping: {w!r}")
    return "|".join(words)


def _first_letters(words: Sequence[str]) -> str:
    # A look-ahead on the possible first letters: a necessary condition that
    # rejects most positions with one class test before the alternation runs
    # (about 2x faster on long texts; the matches are unchanged).
    return "(?=[" + "".join(sorted({w[0] for w in words})) + "])"


def bounded_pattern(words: Sequence[str]) -> str:
    """Case-insensitive, word-bounded alternation (Java regex)."""
    return f"(?iu)(?<!{WORD_CHAR}){_first_letters(words)}(?:{_alternation(words)})(?!{WORD_CHAR})"


def substring_pattern(words: Sequence[str]) -> str:
    """Case-insensitive substring alternation (the SQL summary's form)."""
    return f"(?iu){_first_letters(words)}(?:{_alternation(words)})"


# The letters beyond ASCII that a case-insensitive Unicode pattern takes for an ASCII letter.
ODD_LETTERS = "\u0130\u0131\u017f\u212a"


def _is_ascii(col: Column) -> Column:
    return F.octet_length(col) == F.length(col)


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def _odd(col: Column) -> Column:
    return ~_is_ascii(col) & _any([F.contains(col, F.lit(c)) for c in ODD_LETTERS])


def _found(col: Column, words: Sequence[str], pattern: str, bounded: bool, low: Column | None = None) -> Column:
    """Whether ``pattern``, the case-insensitive alternation of ``words``, occurs.

    A plain search in the lower-cased text for one word at a time is several times faster than a pattern
    at every position. Only where it finds a word are its bounds tested, by a pattern that begins with the
    word itself. Texts with one of the ``ODD_LETTERS`` take the whole pattern. ``low``: the lower-cased text,
    where the caller has it.
    """
    _alternation(words)
    low, odd = F.lower(col) if low is None else low, _odd(col)

    def one(w: str) -> Column:
        hit = F.contains(low, F.lit(w))
        return hit & matches(col, f"(?iu){w}(?!{WORD_CHAR})(?<!{WORD_CHAR}{w})") if bounded else hit
    return (odd & matches(col, pattern)) | (~odd & _any([one(w) for w in words]))


def matches(col: Column, pattern: str) -> Column:
    return F.regexp_like(col, F.lit(pattern))


def count_matches(col: Column, pattern: str) -> Column:
    return F.regexp_count(col, F.lit(pattern))


def char_length(col: Column) -> Column:
    return F.length(col)


def word_count(col: Column) -> Column:
    """Whitespace-separated tokens; 0 for an empty or blank text."""
    return count_matches(col, TOKEN_PATTERN).cast("int")


def fewer_words(col: Column, n: int) -> Column:
    """``word_count(col) < n``, read only as far as the ``n``-th word: mostly within the first characters,
    so that a long text is not even decoded."""
    space, word = r"[\s\u001C-\u001F]", r"[^\s\u001C-\u001F]"
    some = rf"(?U)\A{space}*+(?:{word}++{space}++){{{n - 1}}}{word}"
    return ~(matches(F.substring(col, 1, 24 * n), some) | matches(col, some))


def exclamation_count(col: Column) -> Column:
    return (F.octet_length(col) - F.octet_length(F.replace(col, F.lit("!"), F.lit("")))).cast("int")


def uppercase_count(col: Column) -> Column:
    return count_matches(col, r"\p{IsUppercase}")


def caps_ratio(col: Column, upper: Column | None = None) -> Column:
    """Uppercase letters over max(length, 1). ``upper``: their number, where the caller has it."""
    return (uppercase_count(col) if upper is None else upper).cast("double") / F.greatest(F.length(col), F.lit(1)).cast("double")


def has_url(col: Column) -> Column:
    return matches(col, lx.URL_PATTERN)


def spam_hit(col: Column, preset: str = "scoring") -> Column:
    """Spam-text test of one of the fixed presets."""
    if preset == "scoring":
        low = F.lower(col)      # no other letter than ASCII ones has h, t, p or s as its lower case
        return (lexicon_hit(col, lx.SPAM_PHRASES_SCORING + lx.SPAM_WORDS_SCORING)
                | F.contains(low, F.lit("http://")) | F.contains(low, F.lit("https://")))
    if preset == "loader":
        return lexicon_hit(col, lx.SPAM_WORDS_LOADER)
    if preset == "trainer":
        return lexicon_hit(col, lx.SPAM_WORDS_TRAINER)
    raise ValueError(f"unknown spam preset {preset!r}")


def lexicon_hit(col: Column, words: Sequence[str], form: str = "word", low: Column | None = None) -> Column:
    """True when any lexicon word occurs: ``word``-bounded or as a ``substring``."""
    if form == "word":
        return _found(col, words, bounded_pattern(words), bounded=True, low=low)
    if form == "substring":
        return _found(col, words, substring_pattern(words), bounded=False, low=low)
    raise ValueError(f"unknown lexicon form {form!r}")


def lexicon_count(col: Column, words: Sequence[str]) -> Column:
    """Number of word-bounded, non-overlapping lexicon hits."""
    return count_matches(col, bounded_pattern(words))
