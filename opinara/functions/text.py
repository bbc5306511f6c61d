"""Comment text to normalised text, unigrams, bigrams, trigrams and tokens.

Everything is a chain of built-in string functions, so the whole text stage
stays in the JVM. Every function takes the raw text column and gives a column;
NULL text gives NULL.

No lambda refers to a column: Catalyst inlines column definitions when it pushes
a filter down, and a text chain inlined into a lambda would run once per word.
To derive several columns from one text, use ``operators.words.with_text``,
which normalises once.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The marks that stand as tokens of their own, and the other
# characters the normaliser keeps.
MARKS = ".,:!?;"
KEPT_SYMBOLS = ".,:!?;'$%"

# The code points Python's str.strip and str.split treat as space.
UNICODE_SPACES = (
    [chr(c) for c in range(0x09, 0x0E)]
    + [chr(c) for c in range(0x1C, 0x21)]
    + [chr(0x85), chr(0xA0), chr(0x1680)]
    + [chr(c) for c in range(0x2000, 0x200B)]
    + [chr(c) for c in (0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
)

# The same set as a character class.
_SPACE = r"\t-\r\x1c-\x20\x85\p{Z}"
# Python's \w and \d, spelt with the classes that agree with it in Java. Each also
# names a letter or digit beyond U+FFFF, which it holds anyway: Java's look-behind
# steps over whole code points only if the pattern holds one literally.
_WORD = r"\p{L}\p{N}_" + "\U00010000"
_DIGIT = r"[\p{Nd}" + "\U0001d7ce]"
_OTHER = f"[^{KEPT_SYMBOLS}{_WORD}]"

REPEATED_MARK = r"([.!?,])\1+"
# A line break or tab, or a URL with the bracket before it up to the next space.
# The look-ahead only saves time: it passes by most characters with one check.
BREAK_OR_URL = rf"(?=[\r\n\t(hw])(?:[\r\n\t]|\(?(?:https?://|www\.)[^{_SPACE}]*)"
DETACHED_MARK = rf"([{MARKS}])(?= |\z)"
# Other symbols go unless one stands alone between two word characters and is no
# opening bracket; "$" goes without a digit after it, "%" without one before it.
# A run of what goes is one match. The repeated group is possessive, which Java
# matches in a loop; otherwise it would recurse once for each symbol of the run.
# The look-ahead only saves time: it passes by letters, digits and single spaces
# before them, which a match would replace by a space again.
_STRAY_SIGN = rf"\$(?!{_DIGIT})|%(?<!{_DIGIT}%)"
_GOES = f"(?:{_OTHER}|{_STRAY_SIGN})"
STRAY_SYMBOLS = (
    r"(?! ?+[\p{L}\p{N}])"
    rf"(?:{_OTHER}(?:{_GOES}++|(?![{_WORD}])|(?<![{_WORD}]{_OTHER}))"
    rf"|\(|(?:{_STRAY_SIGN}){_GOES}*+)"
)
SPACES = f"[{_SPACE}]+"
# Longer than any array Spark can hold; 2**31 - 1 overflows in ``slice``.
TO_THE_END = 2**30


def normalise(col: Column) -> Column:
    """Lower-cased text without URLs and stray symbols, end marks set apart."""
    text = F.regexp_replace(col, REPEATED_MARK, " $1 ")
    text = F.regexp_replace(text, BREAK_OR_URL, " ")
    text = F.trim(text, F.lit("".join(UNICODE_SPACES)))
    text = F.regexp_replace(text, DETACHED_MARK, " $1 ")
    text = F.regexp_replace(text, STRAY_SYMBOLS, " ")
    return F.lower(F.trim(text))


def unigrams_of(normalised: Column) -> Column:
    """Drop the marks that stand alone from normalised text.

    The scan does not overlap: in a run of lone marks every second one stays,
    as does a mark at the start of the text.
    """
    inner = F.regexp_replace(normalised, r" [.!?,;:] ", " ")
    return F.regexp_replace(inner, r" [.!?,;:]\z", "")


def word_tokens_of(normalised: Column) -> Column:
    """Split normalised text on any Unicode space, lone marks included."""
    return F.array_remove(F.split(normalised, SPACES), "")


def segment_words_of(normalised: Column) -> Column:
    """The words in order, with NULL in the place of every lone mark."""
    parts = F.split(normalised, SPACES)
    return F.transform(parts, lambda word: F.when(~word.isin(*MARKS), word))


def extend_grams(grams: Column, segment_words: Column, n: int) -> Column:
    """From the (n-1)-gram starting at each word to the n-gram starting there.

    The n-th word on is the same array shifted; a NULL on either side, for a
    lone mark or the end of the text, gives NULL.
    """
    following = F.slice(segment_words, n, TO_THE_END)
    return F.zip_with(grams, following, lambda gram, word: F.concat(gram, F.lit("_"), word))


def ngrams_of(segment_words: Column, n: int) -> Column:
    """The n-grams, joined by ``_``, as an array."""
    if n < 2:
        raise ValueError("n must be at least 2")
    grams = segment_words
    for step in range(2, n + 1):
        grams = extend_grams(grams, segment_words, step)
    return F.array_compact(grams)


def unigrams(col: Column) -> Column:
    return unigrams_of(normalise(col))


def word_tokens(col: Column) -> Column:
    return word_tokens_of(normalise(col))


def ngrams(col: Column, n: int) -> Column:
    return ngrams_of(segment_words_of(normalise(col)), n)


def combine(unigram_text: Column, bigrams: Column, trigrams: Column) -> Column:
    """The three parts with one space between; the spaces stay if a part is empty."""
    space = F.lit(" ")
    return F.concat(
        unigram_text, space, F.array_join(bigrams, " "), space, F.array_join(trigrams, " ")
    )


def combined(col: Column) -> Column:
    return combine(unigrams(col), ngrams(col, 2), ngrams(col, 3))


def vectorise(text: Column, drop_empty: bool = False) -> Column:
    """Split combined text on single spaces; empty tokens stay unless dropped."""
    parts = F.split(text, " ")
    return F.array_remove(parts, "") if drop_empty else parts


def combine_words(unigram_text: Column, bigrams: Column, trigrams: Column) -> Column:
    """``vectorise(combine(...))`` without building the long text in between.

    An empty part gives one empty token, as splitting an empty text does.
    """

    def at_least_one(grams: Column) -> Column:
        return F.when(F.size(grams) > 0, grams).otherwise(F.array(F.lit("")))

    return F.concat(vectorise(unigram_text), at_least_one(bigrams), at_least_one(trigrams))


def tokens(col: Column, drop_empty: bool = False) -> Column:
    words = combine_words(unigrams(col), ngrams(col, 2), ngrams(col, 3))
    return F.array_remove(words, "") if drop_empty else words
