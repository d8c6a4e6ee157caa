"""Words of texts as 32-bit term numbers, whatever their case and diacritics. All of it stays in the JVM."""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions.text import NOT_WORD

# Letters with diacritics in Turkish text and their plain forms; capital dotted i goes first, before lower case is made.
TURKISH = {"ı": "i", "ş": "s", "ğ": "g", "ç": "c", "ö": "o", "ü": "u", "â": "a", "î": "i", "û": "u"}
MARKED = "[À-ɏ̀-ͯḀ-ỿ]"


def other_letters() -> tuple[str, str]:
    """Latin letters with diacritics and their base letters, by their canonical decomposition; combining marks have none."""
    pairs = [(c, unicodedata.normalize("NFKD", c)[0]) for c in map(chr, (*range(0xC0, 0x250), *range(0x1E00, 0x1F00))) if len(unicodedata.normalize("NFKD", c)) > 1]
    return "".join(a for a, _ in pairs) + "".join(map(chr, range(0x300, 0x370))), "".join(b for _, b in pairs)


def plain(text: Column) -> Column:
    """A text in lower case without diacritics."""
    x = F.lower(F.replace(text, F.lit("İ"), F.lit("i")))
    for a, b in TURKISH.items():
        x = F.replace(x, F.lit(a), F.lit(b))
    return F.when(x.rlike(MARKED), F.translate(x, *other_letters())).otherwise(x)


def plain_words(text: Column) -> Column:
    """The words of a text, plain, in order; an empty array for none."""
    return F.filter(F.split(F.regexp_replace(plain(text), NOT_WORD, " "), " "), lambda w: w != "")


def term_numbers(words: Column) -> Column:
    return F.transform(words, lambda w: F.hash(w))


def lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and row starts (one more than rows) of a list column; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False)
    n = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    return values, np.concatenate([[0], np.cumsum(n)])
