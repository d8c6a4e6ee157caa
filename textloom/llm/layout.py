"""What numpy can tell of lines from the bytes of their folded text: words, cells between delimiters, signs, endings."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa

from textloom.llm.sketch import mix

LETTER, DIGIT, SPACE, SIGN = 0, 1, 2, 3
BASE, ENDING = 28, 5
#: An odd factor and its inverse modulo 2**64.
FACTOR = 0x9E3779B97F4A7C15
INVERSE = pow(FACTOR, -1, 1 << 64)
#: A cell with a predicate is a clause from so many words on, or when it is the whole line.
CLAUSE_WORDS = 4


def table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


IS_LOWER, IS_DIGIT, IS_SPACE = table(bytes(range(97, 123))), table(b"0123456789"), table(b" \t\n\r\x0b\x0c")
# Signs that close a sentence, signs that don't divide a line into cells, and signs that stand within code, links and tags.
CLOSING, WITHIN, TECHNICAL = table(b".!?)"), table(b".,!?'\"()-"), table(b"_=/\\{}[]<>:@#")


# Turkish letters with diacritics and their plain forms, and quotes, dashes and blanks that are written in several ways.
PLAIN = dict(zip("ıİşŞğĞçÇöÖüÜâÂîÎûÛ", "iissggccoouuaaiiuu")) | {"’": "'", "‘": "'", "´": "'", "“": '"', "”": '"', "…": ".", "–": "-", "—": "-", "\u00a0": " "}


def fold_tables() -> tuple[np.ndarray, np.ndarray]:
    """What a character of two bytes (from U+0080 on), or of three bytes from U+2000 on, becomes; 0 for itself."""
    two, three = np.zeros(4 * 64, np.uint8), np.zeros(64, np.uint8)
    for c, plain in PLAIN.items():
        b = c.encode()
        if len(b) == 2:
            two[(b[0] - 0xC2) * 64 + b[1] - 0x80] = ord(plain)
        else:
            three[b[2] - 0x80] = ord(plain)
    return two, three


TWO, THREE = fold_tables()


def fold(data: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 text in lower case without Turkish diacritics, and where its rows then start."""
    data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    kept = np.ones(len(data), bool)
    lead = np.flatnonzero((data >= 0xC2) & (data <= 0xC5))
    plain = TWO[(data[lead].astype(np.int64) - 0xC2) * 64 + (data[lead + 1] & 0x3F)]
    lead, plain = lead[plain > 0], plain[plain > 0]
    data[lead], kept[lead + 1] = plain, False
    lead = np.flatnonzero(data == 0xE2)
    lead = lead[data[lead + 1] == 0x80]
    plain = THREE[data[lead + 2] & 0x3F]
    lead, plain = lead[plain > 0], plain[plain > 0]
    data[lead], kept[lead + 1], kept[lead + 2] = plain, False, False
    before = np.concatenate([[0], np.cumsum(kept)])
    return data[kept], before[start]


@dataclass
class Lines:
    """Lines as folded bytes, each ended by a line break, with what is worked out from them once."""

    data: np.ndarray
    start: np.ndarray  # one more than there are lines
    kind: np.ndarray
    row_of: np.ndarray
    token: np.ndarray
    word_lo: np.ndarray
    word_hi: np.ndarray
    word_row: np.ndarray

    @property
    def n(self) -> int:
        return len(self.start) - 1

    @classmethod
    def of(cls, column: pa.Array) -> Lines:
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        column = column.cast(pa.large_string())
        start = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        data = np.frombuffer(column.buffers()[2], np.uint8)[start[0] : start[-1]] if len(column) else np.zeros(0, np.uint8)
        data, start = fold(data, start - start[0])
        row_of = np.repeat(np.arange(len(start) - 1), np.diff(start))
        space = IS_SPACE[data]
        # Tokens are runs without a blank. A sign beyond ASCII is a letter in a token that has letters or digits, and a sign in others.
        new = ~space & np.append(True, space[:-1])[: len(data)]
        token = np.cumsum(new) - 1
        plain = IS_LOWER[data] | IS_DIGIT[data]
        written = np.bincount(token[plain], minlength=int(token[-1]) + 1 if len(token) else 0) > 0
        kind = np.full(len(data), SIGN, np.int8)
        kind[IS_LOWER[data]], kind[IS_DIGIT[data]], kind[space] = LETTER, DIGIT, SPACE
        high = np.flatnonzero(data >= 128)
        kind[high[written[token[high]]]] = LETTER
        word = kind <= DIGIT
        edge = np.diff(word.astype(np.int8), prepend=0, append=0)
        lo, hi = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        return cls(data, start, kind, row_of, token, lo, hi, row_of[lo])

    def per_row(self, at: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        """How many of the byte places ``at`` each line has."""
        return np.bincount(self.row_of[at], weights, self.n)

    def endings(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(which words, ending, unknown) of the words of at least three letters; unknown where the end isn't ASCII."""
        digits = np.concatenate([[0], np.cumsum(self.kind == DIGIT)])
        which = np.flatnonzero((self.word_hi - self.word_lo >= 3) & (digits[self.word_hi] == digits[self.word_lo]))
        lo, hi = self.word_lo[which], self.word_hi[which]
        code, unknown = np.zeros(len(which), np.int64), np.zeros(len(which), bool)
        for k in reversed(range(ENDING)):
            at = np.maximum(hi - 1 - k, 0)
            c = self.data[at]
            code = code * BASE + np.where(hi - 1 - k >= lo, np.where(c < 128, c.astype(np.int64) - 96, 27), 0)
            if k < 3:
                unknown |= c >= 128
        return which, code, unknown

    def closes(self, which: np.ndarray) -> np.ndarray:
        """Whether closing signs follow a word, at once or after one blank, and nothing but a blank follows them."""
        n = len(self.data)
        sign = self.kind == SIGN
        end = np.minimum.accumulate(np.where(sign, n - 1, np.arange(n))[::-1])[::-1] if n else np.zeros(0, np.int64)
        closing = np.concatenate([[0], np.cumsum(CLOSING[self.data])])
        at = np.minimum(self.word_hi[which], n - 1)
        at = np.where((self.kind[at] == SPACE) & (self.data[at] != 10), np.minimum(at + 1, n - 1), at)
        return sign[at] & (closing[end[at]] > closing[at]) & (self.kind[end[at]] == SPACE)

    @cached_property
    def word_hashes(self) -> np.ndarray:
        """Words as numbers: a polynomial over their bytes, taken from running sums over all bytes."""
        n = len(self.data)
        power, back = (np.multiply.accumulate(np.full(n, x, np.uint64)) for x in (FACTOR, INVERSE))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * power)])
        return mix((total[self.word_hi] - total[self.word_lo]) * back[self.word_lo]).view(np.int64)

    def bigrams(self) -> tuple[np.ndarray, np.ndarray]:
        """(place, pair of letters or of letter and edge)."""
        c = np.where(IS_LOWER[self.data], self.data.astype(np.int64) - 96, 0)
        pair = c[:-1] * 27 + c[1:] if len(c) else c
        at = np.flatnonzero(pair)
        return at, pair[at]

    def measure(self, predicate: np.ndarray, common: np.ndarray, odds: np.ndarray) -> dict[str, np.ndarray]:
        """Counts of every line; ``predicate`` and ``common`` mark words, ``odds`` are logarithms by pair of letters."""
        n, data, kind = self.n, self.data, self.kind
        lead = (data & 0xC0) != 0x80
        visible = lead & (kind != SPACE)
        count = lambda mask: self.per_row(np.flatnonzero(mask)).astype(np.int64)
        words = np.bincount(self.word_row, minlength=n)
        out = {"words": words, "chars": count(visible), "letters": count(visible & (kind == LETTER)), "digits": count(visible & (kind == DIGIT)), "symbols": count(visible & (kind == SIGN))}
        out["word_chars"] = np.bincount(self.word_row, self.word_hi - self.word_lo, n).astype(np.int64)
        out["common"] = np.bincount(self.word_row[common], minlength=n)
        out["predicates"] = np.bincount(self.word_row[predicate], minlength=n)
        # Cells are the stretches of words between delimiters; a dash divides only between blanks.
        blank_before, blank_after = np.append(True, kind[:-1] == SPACE)[: len(data)], np.append(kind[1:] == SPACE, True)[: len(data)]
        divides = (kind == SIGN) & lead & (~WITHIN[data] | ((data == 45) & blank_before & blank_after)) | (data == 10)
        cell = np.cumsum(divides)[self.word_lo] if len(self.word_lo) else np.zeros(0, np.int64)
        first = np.append(True, cell[1:] != cell[:-1])[: len(cell)]
        cell = np.cumsum(first) - 1
        row = self.word_row[first]
        in_cell, says = np.bincount(cell, minlength=len(row)), np.bincount(cell[predicate], minlength=len(row)) > 0
        cells = np.bincount(row, minlength=n)
        out["cells"] = cells
        out["written"] = np.bincount(row, in_cell * says, n).astype(np.int64)
        out["clause"] = (np.bincount(row[says & ((in_cell >= CLAUSE_WORDS) | (cells[row] == 1))], minlength=n) > 0).astype(np.int64)
        keys = np.sort((self.word_row.astype(np.int64) << 40) | (self.word_hashes & ((1 << 40) - 1)))
        out["repeated"] = np.bincount(keys[1:][keys[1:] == keys[:-1]] >> 40, minlength=n)
        # Words with letters and digits, or with signs of code inside.
        tokens = int(self.token[-1]) + 1 if len(self.token) else 0
        has = lambda mask: np.bincount(self.token[mask], minlength=tokens) > 0
        inner = TECHNICAL[data] & (np.append(kind[1:], SPACE)[: len(data)] != SPACE) & (kind == SIGN)
        letter, digit = has(IS_LOWER[data]), has(IS_DIGIT[data])
        token_row = np.zeros(tokens, np.int64)
        token_row[self.token[kind != SPACE]] = self.row_of[kind != SPACE]
        out["mixed"] = np.bincount(token_row[(letter & digit) | ((letter | digit) & has(inner))], minlength=n)
        at, pair = self.bigrams()
        out["pairs"], out["odds"] = self.per_row(at).astype(np.int64), self.per_row(at, odds[pair]).astype(float)
        # The last signs of a line close it when a closing one is among them.
        solid = np.flatnonzero(kind != SPACE)
        last = np.full(n, -1)
        last[self.row_of[solid]] = solid
        sign = kind == SIGN
        begin = np.maximum.accumulate(np.where(sign, -1, np.arange(len(data)))) if len(data) else np.zeros(0, np.int64)
        closing = np.concatenate([[0], np.cumsum(CLOSING[data])])
        some = last >= 0
        closed = np.zeros(n, np.int64)
        closed[some] = sign[last[some]] & (closing[last[some] + 1] > closing[np.maximum(begin[last[some]] + 1, self.start[:-1][some])])
        out["closed"] = closed
        lo = np.full(n, 0)
        lo[self.row_of[solid[::-1]]] = solid[::-1]
        out["indent"] = np.where(some, lo - self.start[:-1], 0)
        out["signature"] = self.signature(lo, some)
        return out

    def signature(self, lo: np.ndarray, some: np.ndarray) -> np.ndarray:
        """The delimiters of a line in order as one number; 0 for none. A number that counts lines off is a delimiter too."""
        data = self.data
        mark = (self.kind == SIGN) & (~WITHIN[data] | (data == 45)) | (data == 9)
        at = np.flatnonzero(mark)
        row = self.row_of[at]
        rank = np.arange(len(at)) - np.searchsorted(row, row)
        h = mix(data[at].astype(np.uint64) * np.uint64(0x100000001B3) + rank.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        out = np.zeros(self.n, np.uint64)
        np.add.at(out, row, h)
        first = np.flatnonzero(IS_DIGIT[data[np.minimum(lo, max(len(data) - 1, 0))]] & some) if len(data) else np.zeros(0, np.int64)
        for k in range(1, 4):
            p = np.minimum(lo[first] + k, len(data) - 1)
            numbered = first[(data[p] == 46) | (data[p] == 41)]
            out[numbered] += np.uint64(0x5851F42D4C957F2D)
            first = first[IS_DIGIT[data[p]]]
        return out.view(np.int64)
