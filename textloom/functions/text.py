"""Column functions on text. Everything here stays inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What Python's str.split() without an argument treats as white space.
WHITESPACE = r"[\s\x1c-\x1f\x85\p{Z}]+"
NOT_WORD = r"[^\p{L}\p{N}]+"


def once(value: Column) -> Column:
    """A column of the next select that is worked out once a row.

    Filters on an ordinary column are pushed below the projection that makes it, and
    its expression is then run again wherever it is used. A generated column is not
    pushed through. For regular expressions that are used several times this counts.
    """
    return F.explode(F.array(value))


def turkish_lower(text: Column) -> Column:
    """Lower case by Turkish rules: dotted and dotless i are kept apart."""
    return F.lower(F.translate(text, "İI", "iı"))


def collapse_space(text: Column) -> Column:
    """One blank for every run of white space, none at either end."""
    return F.trim(F.regexp_replace(text, WHITESPACE, " "))


def word_string(text: Column) -> Column:
    """The words (runs of letters and digits) in Turkish lower case, joined by one blank."""
    return F.trim(F.regexp_replace(turkish_lower(text), NOT_WORD, " "))


def letters_digits(text: Column) -> Column:
    """Letters and digits only, in order, in Turkish lower case."""
    return F.regexp_replace(turkish_lower(text), NOT_WORD, "")


def hash128(text: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes of a string."""
    return F.xxhash64(text), F.xxhash64(F.lit(0x5EED), text)


# ---- lines: cleaning, keys, reasons for rejection, quality flags ----

# Limits of a usable line.
MIN_CHARS, MAX_CHARS, MIN_SPACES, MIN_LETTER_SHARE = 20, 2000, 2, 0.5
# Letters that tell Turkish text.
TURKISH_LETTERS = "çğıöşüÇĞİÖŞÜ"
# Punctuation that counts as ordinary.
ORDINARY = r".,!?;:'\"()/-"


def count_letters(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"[^\p{L}]+", ""))


def count_char(text: Column, chars: str) -> Column:
    """How many of the characters of ``text`` are in ``chars``."""
    return F.length(text) - F.length(F.translate(text, chars, ""))


def reject_reason(line: Column, min_chars: int = MIN_CHARS, max_chars: int | None = MAX_CHARS) -> Column:
    """The first reason not to use a line: length, few_words, low_letters; null for a usable line."""
    n = F.length(line)
    out = n < min_chars if max_chars is None else (n < min_chars) | (n > max_chars)
    return (
        F.when(out, "length")
        .when(count_char(line, " ") < MIN_SPACES, "few_words")
        .when(count_letters(line) < n * MIN_LETTER_SHARE, "low_letters")
    )


def dedup_norm(line: Column) -> Column:
    """What two lines must share to be duplicates: letters and digits in (root locale) lower case, blanks collapsed."""
    return F.trim(F.regexp_replace(F.lower(line), r"[^\p{L}\p{N}]+", " "))


def has_replacement(line: Column) -> Column:
    return F.contains(line, F.lit("�"))


def all_caps(line: Column) -> Column:
    return (F.length(line) > 40) & (line == F.upper(line)) & (line != F.lower(line))


def low_variety(line: Column) -> Column:
    words = F.split(line, " ")
    return (F.size(words) >= 8) & (F.size(F.array_distinct(words)) < F.size(words) * 0.3)


def clip(line: Column, width: int = 600, tail: int = 200) -> Column:
    """A preview: whole where short, else up to the nearest sentence end in the next ``tail`` characters, else up to the last blank."""
    rest = F.substring(line, width + 1, tail)
    end = F.length(F.regexp_extract(rest, r"^[^.!?]*[.!?]", 0))
    head = F.substring(line, 1, width)
    blank = F.length(F.regexp_extract(head, r"^(?s:.+)(?= )", 0))
    return (
        F.when(F.length(line) <= width, line)
        .when(end > 0, F.substring(line, F.lit(1), F.lit(width) + end))
        .otherwise(F.concat(F.when(blank > 0, F.substring(line, F.lit(1), blank)).otherwise(head), F.lit(" ...")))
    )


def display(line: Column, width: int = 400) -> Column:
    """The beginning of a line, for reports."""
    return F.substring(line, 1, width)


def hash_fraction(text: Column, salt: str) -> Column:
    """A salted 60-bit number from SHA-256, the same in any engine: for splits and draws."""
    return F.conv(F.substring(F.sha2(F.concat(F.lit(salt), text), 256), 1, 15), 16, 10).cast("bigint")
