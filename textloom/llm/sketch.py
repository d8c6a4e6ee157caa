"""Words of lines as multisets of 32-bit features, and what is computed from them with numpy."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions.text import once, word_string

#: The table of counts has a place for about PER_PLACE features, between 2**LEAST_BITS and 2**MOST_BITS of one byte each: 16 MB at most.
LEAST_BITS, MOST_BITS, PER_PLACE = 20, 24, 4
#: Counts below this are exact in the table, larger ones within a fifth.
EXACT = 128
CHUNK = 1 << 16


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (multiply and xor-shift)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x9FB21C651E98DF25)
    x ^= x >> np.uint64(28)
    x *= np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(32)
    return x


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and row lengths of a list column without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)


def starts_of(lengths: np.ndarray) -> np.ndarray:
    out = np.zeros(len(lengths), np.int64)
    np.cumsum(lengths[:-1], out=out[1:])
    return out


def occurrences(values: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every row its sorted values, and how often each has come before in that row."""
    row = np.repeat(np.arange(len(lengths)), lengths)
    order = np.lexsort((values, row))
    v, r = values[order], row[order]
    at = np.arange(len(v))
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (r[1:] != r[:-1])
    return v, at - np.maximum.accumulate(np.where(new, at, 0))


def multiset_features(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """32-bit features, rows in order: equal for the same word in the same occurrence.

    Two rows share exactly as many features as they have words in common, counted
    with repetition (up to collisions of 32 bits within one pair of rows).
    """
    v, times = occurrences(values.view(np.uint64), lengths)
    return (mix(v + times.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)


def parity_sketch(features: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64 parity bits a row. The Hamming distance of two sketches never exceeds the symmetric difference of the rows."""
    if not len(lengths):
        return np.zeros(0, np.int64)
    bits = np.left_shift(np.uint64(1), (features >> np.uint32(26)).astype(np.uint64))
    out = np.zeros(len(lengths), np.uint64)
    some = lengths > 0
    out[some] = np.bitwise_xor.reduceat(bits, starts_of(lengths)[some])
    return out.view(np.int64)


def held_by(features: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The count codes of features (or of the low bits of keys)."""
    return table[(features & features.dtype.type(len(table) - 1)).astype(np.int64)]


def count_code(n: np.ndarray) -> np.ndarray:
    """Counts as one byte: exact below EXACT, then four steps for every doubling. Larger counts never have smaller codes."""
    large = EXACT + np.floor(4 * np.log2(np.maximum(n, EXACT) / EXACT))
    return np.where(n < EXACT, n, np.minimum(large, 255)).astype(np.uint8)


def bits_for(features: int) -> int:
    return int(min(MOST_BITS, max(LEAST_BITS, np.ceil(np.log2(max(1, features) / PER_PLACE)))))


def word_lines(df: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """(id, text, words) of the lines with at least ``min_words`` words; words are 64-bit hashes in order."""
    lines = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).where(F.col("id").isNotNull() & F.col("text").isNotNull())
    # A line of n words has at least 2 n - 1 characters; this spares the short ones the regular expression.
    lines = lines.where(F.length("text") >= 2 * min_words - 1).select("id", "text", once(F.split(word_string(F.col("text")), " ")).alias("words"))
    return lines.where(F.size("words") >= min_words).withColumn("words", F.transform("words", lambda w: F.xxhash64(w)))


def count_table(df: DataFrame, column: str, bits: int, prepare: Callable | None = None) -> np.ndarray:
    """Codes of how many times a feature of each place occurs, over all rows: 2**bits bytes.

    ``prepare`` makes features from the values and row lengths of an array ``column``;
    without it the values are features. A place counts every feature that falls
    into it, so the true number of rows of a feature is never larger. The sums are made
    on the executors; the driver gets the finished bytes.
    """
    size = 1 << bits

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.uint32)
        for b in batches:
            if pa.types.is_list(b.column(0).type):
                f, n = flat(b.column(0))
                f = prepare(f, n) if prepare else f.view(np.uint32)
            else:
                f = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            place, n = np.unique(f & f.dtype.type(size - 1), return_counts=True)
            total[place.astype(np.int64)] += n.astype(np.uint32)
        at = np.flatnonzero(total)
        for i in range(0, len(at), 100_000):
            part = at[i : i + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(total[part].astype(np.int64))], names=["place", "n"])

    def dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            (place, n), (count, _) = flat(b.column("place")), flat(b.column("n"))
            first = np.concatenate([[0], np.cumsum(n)])
            for r in range(b.num_rows):
                out = np.zeros(min(CHUNK, size), np.uint8)
                out[place[first[r] : first[r + 1]]] = count_code(count[first[r] : first[r + 1]])
                yield pa.RecordBatch.from_arrays([b.column("chunk").slice(r, 1), pa.array([out.tobytes()], pa.binary())], names=["chunk", "codes"])

    counts = df.select(column).mapInArrow(partial, "place int, n bigint").groupBy("place").agg(F.sum("n").alias("n"))
    # A chunk has at most CHUNK places.
    chunks = counts.groupBy(F.floor(F.col("place") / CHUNK).cast("int").alias("chunk")).agg(F.collect_list(F.struct((F.col("place") % CHUNK).alias("p"), "n")).alias("x"))
    table = np.zeros(size, np.uint8)
    for r in chunks.select("chunk", F.col("x.p").alias("place"), F.col("x.n").alias("n")).mapInArrow(dense, "chunk int, codes binary").collect():
        part = np.frombuffer(r.codes, np.uint8)
        table[r.chunk * CHUNK : r.chunk * CHUNK + len(part)] = part
    return table
