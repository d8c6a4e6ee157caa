"""Problem 2: near-duplicate lines with small edits.

Method: covering locality-sensitive hashing. A line is a sparse bit vector over
(word, occurrence) coordinates; two lines are within the radius when they share
at least ``share`` of the words of the longer one, so at most t = n // 4 of a
line's own n coordinates are errors for ``share`` = 0.75. All coordinates are put
in one global order, rare ones first. The masks select coordinates of a line's
first t + 2 places, two at a time: this family of weight-2 masks is a covering
design, because whatever t of the t + 2 places are errors, some mask touches none
of them. A pair within the radius therefore collides in at least one table; there
is no chance of a miss. (Masks of constant weight are used rather than the dense
ones of the binary construction: those select half of all coordinates at random,
which for sparse vectors makes keys out of the most frequent words or of none.)

Two savings keep the guarantee: a coordinate that no other line has is an error
for every partner, so masks with it are not built; and a coordinate held by few
lines (at most ``rare`` in the count table) is a key by itself, so that the masks
of two are built over the frequent ones only.

A bucket of more than ``HOT`` rows isn't joined. Its lines get the masks of weight 3
over their first t + 3 places, which cover the same pairs by the same argument and
spread them over far more buckets. A key that more than ``LOCAL`` lines of one batch
have is known to be crowded where it is made: only a mark and its lines' ids are
sent, so a key that a third of all lines have doesn't meet in one task. What is
still large at weight 3 is joined as it is; no window stands before that join, so
adaptive execution can split it.

Copies are collapsed first, so a group of copies of any size enters the tables as
one row. Candidates are compared by a 64-bit parity sketch (a lower bound of the
distance) before their words are fetched, then exactly.

Defined results: null and blank texts and lines with fewer than ``min_words``
words have no partner; repeated rows with one id count once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions.text import hash128, letters_digits
from textloom.llm.components import components
from textloom.llm.copies import MIN_CHARS, field_string
from textloom.llm.sketch import bits_for, count_table, flat, held_by, mix, multiset_features, parity_sketch, starts_of, word_lines
from textloom.session import cut

MIN_WORDS = 20
SHARE = 0.75
RARE = 120
#: Rows of a bucket up to which all its lines are compared with one another.
HOT = 1000
#: Rows of a bucket within one batch from which on it is crowded without being counted any further.
LOCAL = 250

ROWS = "id bigint, k1 bigint, k2 bigint, f1 bigint, f2 bigint, chars int, n int, mh bigint, feats array<int>"


def feature_rows(df: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """One row a line: its keys as a copy (letters in order, sorted fields) and its word features."""
    lines = word_lines(df, id_col, text_col, min_words)
    letters, fields = letters_digits(F.col("text")), field_string(F.col("text"))
    k1, k2 = hash128(letters)
    f1, f2 = hash128(fields)
    keyed = lines.select("id", k1.alias("k1"), k2.alias("k2"), F.when(fields.isNotNull(), f1).alias("f1"), F.when(fields.isNotNull(), f2).alias("f2"), F.length(letters).alias("chars"), "words")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words, n = flat(b.column("words"))
            f = multiset_features(words, n)
            whole = np.add.reduceat(mix(f.astype(np.uint64)), starts_of(n)).view(np.int64) if len(n) else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.append(starts_of(n), n.sum()).astype(np.int32)), pa.array(f.view(np.int32)))
            yield pa.RecordBatch.from_arrays([*b.columns[:6], pa.array(n.astype(np.int32)), pa.array(whole), lists], names=[x.split()[0] for x in ROWS.split(", ")])

    return keyed.mapInArrow(features, ROWS)


def needed(n: np.ndarray | int, share: float) -> np.ndarray | int:
    """The least number of shared words that is at least ``share`` of n."""
    return np.ceil(np.asarray(n) * share - 1e-9).astype(np.int64)


@lru_cache(maxsize=256)
def choices(size: int, weight: int) -> np.ndarray:
    return np.array(list(combinations(range(size), weight)), np.int64).reshape(-1, weight)


def mask_keys(features: np.ndarray, n: np.ndarray, counts: np.ndarray, share: float, rare: int, weight: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) for every mask of every row."""
    row = np.repeat(np.arange(len(n)), n)
    held = held_by(features, counts).astype(np.int64)
    order = np.lexsort((features, held, row))
    f, c, r = features[order].astype(np.uint64), held[order], row[order]
    place = np.arange(len(f)) - np.repeat(starts_of(n), n)
    kept = (place < np.repeat(n - needed(n, share) + weight, n)) & (c > 1)
    alone = kept & (c <= rare)
    rows, keys = [r[alone]], [mix(f[alone])]
    both = kept & (c > rare)
    f, r = f[both], r[both]
    m = np.bincount(r, minlength=len(n))
    first = starts_of(m)
    for size in np.unique(m[m >= weight]):
        of = np.flatnonzero(m == size)
        masks = choices(int(size), weight)
        for part in np.array_split(of, max(1, len(of) * len(masks) // 2_000_000)):  # bounds what is held at once
            table = f[first[part][:, None] + np.arange(size)]
            key = np.zeros((len(part), len(masks)), np.uint64)
            for k in range(weight):
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + table[:, masks[:, k]])
            rows.append(np.repeat(part, len(masks)))
            keys.append(key.ravel())
    return np.concatenate(rows), np.concatenate(keys).view(np.int64)


def mask_table(units: DataFrame, counts: np.ndarray, share: float = SHARE, rare: int = RARE, weight: int = 2, local: int = LOCAL, only: np.ndarray | None = None) -> DataFrame:
    """(key, unit, n, sketch): the hash tables of all masks, as rows. ``units`` has unit and feats.

    Rows of keys that are crowded within a batch are replaced: n is 0 in a mark for
    the key, and below 0 in one row for each of its lines. ``only`` is a count table
    of keys; rows whose keys it doesn't hold are left out.
    """
    sent = units.sparkSession.sparkContext.broadcast((counts, only))
    names = ["key", "unit", "n", "sketch"]

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, only = sent.value
        for b in batches:
            unit, (f, n) = b.column("unit").to_numpy(), flat(b.column("feats"))
            f, first, parts = f.view(np.uint32), np.concatenate([[0], np.cumsum(n)]), []
            for lo in range(0, b.num_rows, 2000):
                hi = min(lo + 2000, b.num_rows)
                row, key = mask_keys(f[first[lo] : first[hi]], n[lo:hi], counts, share, rare, weight)
                if only is not None:
                    some = held_by(key.view(np.uint64), only) > 0
                    row, key = row[some], key[some]
                parts.append((row + lo, key))
            if not parts:
                continue
            row, key = (np.concatenate(x) for x in zip(*parts))
            sketch, n = parity_sketch(f, n), n.astype(np.int32)
            cols = [key, unit[row], n[row], sketch[row]]
            value, of, times = np.unique(key, return_inverse=True, return_counts=True)
            if len(times) and times.max() > local:
                crowd = np.unique(row[times[of] > local])
                marks = value[times > local]
                kept = times[of] <= local
                none = np.zeros(len(marks), np.int64)
                new = [np.concatenate([marks, mix(unit[crowd]).view(np.int64)]), np.concatenate([none, unit[crowd]]), np.concatenate([none.astype(np.int32), -n[crowd]]), np.concatenate([none, sketch[crowd]])]
                cols = [np.concatenate([x[kept], y]) for x, y in zip(cols, new)]
            for i in range(0, len(cols[0]), 200_000):
                yield pa.RecordBatch.from_arrays([pa.array(c[i : i + 200_000]) for c in cols], names=names)

    return units.select("unit", "feats").mapInArrow(keys, "key bigint, unit bigint, n int, sketch bigint")


def shared_needed(a: str, b: str, share: float):
    return F.ceil(F.greatest(F.col(a), F.col(b)) * F.lit(share) - F.lit(1e-9))


def within(a: str, b: str, share: float):
    """What the sizes and the sketches of two lines allow: true for every pair within the radius."""
    least = shared_needed(f"{a}.n", f"{b}.n", share)
    apart = F.bit_count(F.col(f"{a}.sketch").bitwiseXOR(F.col(f"{b}.sketch")))
    return (F.least(f"{a}.n", f"{b}.n") >= least) & (apart <= F.col(f"{a}.n") + F.col(f"{b}.n") - 2 * least)


def met_in(table: DataFrame, share: float, sides: bool) -> DataFrame:
    """(a, b): units with a key in common that sizes and sketches allow; a < b, or a even and b odd where there are ``sides``."""
    a, b = (table.where("unit % 2 = 0"), table.where("unit % 2 <> 0")) if sides else (table, table)
    order = F.lit(True) if sides else F.col("a.unit") < F.col("b.unit")
    met = a.alias("a").join(b.alias("b"), (F.col("a.key") == F.col("b.key")) & order & within("a", "b", share))
    return met.select(F.col("a.unit").alias("a"), F.col("b.unit").alias("b")).distinct()


def met_pairs(units: DataFrame, tables: Callable[[DataFrame, int], DataFrame], share: float = SHARE, hot: int = HOT, sides: bool = False) -> DataFrame:
    """(a, b): all candidates. ``tables`` gives the mask table of some units at a weight."""
    # The count uses the sorting by key that the join needs anyway; single rows go before the join.
    # The join needs keys that aren't null; said here, all that reads the table reads one shuffle.
    of_key = Window.partitionBy("key")
    table = tables(units, 2).where("key is not null").withColumns({"held": F.count(F.lit(1)).over(of_key), "marked": F.min(F.abs("n")).over(of_key) == 0})
    cold = table.where(F.col("held").between(2, hot) & ~F.col("marked") & (F.col("n") > 0))
    # All columns are kept, so that this reads the same shuffle as the join.
    crowded = table.where((F.col("n") < 0) | ((F.col("n") > 0) & ((F.col("held") > hot) | F.col("marked")))).groupBy("unit").agg(F.max("n").alias("n"), F.max("sketch").alias("sketch"))
    crowded = crowded.select(F.col("unit").alias("a"), F.lit(None).cast("bigint").alias("b"), "n", "sketch")
    met = met_in(cold, share, sides).withColumns({"n": F.lit(0), "sketch": F.lit(0).cast("bigint")})
    met = cut(met.unionByName(crowded), "met").select("a", "b")
    crowded, met = met.where("b is null").select(F.col("a").alias("unit")), met.where("b is not null")
    if crowded.limit(1).count():
        deep = tables(units.join(crowded, "unit", "left_semi"), 3)
        met = met.unionByName(met_in(deep, share, sides)).distinct()
    return met


def unit_pairs(units: DataFrame, share: float = SHARE, rare: int = RARE, hot: int = HOT, local: int = LOCAL) -> DataFrame:
    """(a, b), a < b: pairs of units that share enough words. No pair is missed."""
    counts = count_table(units, "feats", bits_for(units.agg(F.sum("n")).first()[0] or 0))
    none = np.iinfo(np.int64).max  # nothing is marked at weight 3
    met = met_pairs(units, lambda x, weight: mask_table(x, counts, share, rare, weight, local if weight == 2 else none), share, hot)
    side = lambda x: units.select(F.col("unit").alias(x), F.col("n").alias(f"n{x}"), F.col("feats").alias(f"feats{x}"))
    both = met.join(side("a"), "a").join(side("b"), "b")
    return both.where(F.size(F.array_intersect("featsa", "featsb")) >= shared_needed("na", "nb", share)).select("a", "b")


def make_units(df: DataFrame, id_col: str, text_col: str, min_words: int) -> tuple[DataFrame, DataFrame]:
    """(rows, units): every line, and one row for all lines with the same letters and the same words."""
    rows = cut(feature_rows(df, id_col, text_col, min_words), "lines")
    units = rows.groupBy("k1", "k2", "mh").agg(F.min("id").alias("unit"), *(F.first(c).alias(c) for c in ("n", "f1", "f2", "chars", "feats")))
    return rows, cut(units, "units")


def found(df: DataFrame, id_col: str = "line_id", text_col: str = "text", min_words: int = MIN_WORDS, share: float = SHARE, min_chars: int = MIN_CHARS) -> DataFrame:
    """(line_id_a, line_id_b): all pairs within the radius that are not copies of one another.

    The result lists every pair of lines, so a text with many copies beside another
    with many copies gives their product; ``groups`` says the same in one row a line.
    """
    rows, units = make_units(df, id_col, text_col, min_words)
    pairs = unit_pairs(units, share)
    # Copies: the same letters in order or the same fields; fields may be those of a third line with the same letters.
    fields = units.where("f1 is not null").groupBy("k1", "k2").agg(F.min(F.struct("f1", "f2")).alias("f"))
    keys = units.select("unit", "k1", "k2", "chars")
    for x in "ab":
        of = keys.select(F.col("unit").alias(x), F.col("k1").alias("k1"), F.col("k2").alias("k2"), F.col("chars").alias(f"chars{x}"))
        pairs = pairs.join(of, x).join(fields, ["k1", "k2"], "left").withColumnsRenamed({"k1": f"k1{x}", "k2": f"k2{x}", "f": f"f{x}"})
    same = ((F.col("k1a") == F.col("k1b")) & (F.col("k2a") == F.col("k2b"))) | F.coalesce(F.col("fa") == F.col("fb"), F.lit(False))
    pairs = pairs.where(~(same & (F.col("charsa") >= min_chars) & (F.col("charsb") >= min_chars))).select("a", "b")
    # Lines with fewer than min_chars letters are not copies, so the lines of one such unit are pairs themselves.
    member = rows.select("id", "k1", "k2", "mh").join(units.select("unit", "chars", "k1", "k2", "mh"), ["k1", "k2", "mh"]).select("unit", "id", "chars")
    of = lambda x: member.select(F.col("unit").alias(x), F.col("id").alias(f"id{x}"))
    lines = pairs.join(of("a"), "a").join(of("b"), "b").select("ida", "idb")
    short = member.where(F.col("chars") < min_chars)
    inner = short.alias("x").join(short.alias("y"), (F.col("x.unit") == F.col("y.unit")) & (F.col("x.id") < F.col("y.id"))).select(F.col("x.id").alias("ida"), F.col("y.id").alias("idb"))
    lines = lines.unionByName(inner)
    return lines.select(F.least("ida", "idb").alias("line_id_a"), F.greatest("ida", "idb").alias("line_id_b")).where("line_id_a < line_id_b").distinct()


def groups(df: DataFrame, id_col: str = "line_id", text_col: str = "text", min_words: int = MIN_WORDS, share: float = SHARE) -> DataFrame:
    """(line_id, group_id, n_links): every line in a group of at least two, with the links of its text.

    A link is a pair of different texts within the radius; lines with the same
    text are of one group without being expanded into pairs.
    """
    rows, units = make_units(df, id_col, text_col, min_words)
    pairs = cut(unit_pairs(units, share), "pairs")
    root = components(pairs)
    ends = pairs.select(F.explode(F.array("a", "b")).alias("unit")).groupBy("unit").agg(F.count(F.lit(1)).alias("n_links"))
    member = rows.select("id", "k1", "k2", "mh").distinct().join(units.select("unit", "k1", "k2", "mh"), ["k1", "k2", "mh"]).select("unit", "id")
    of = member.join(root.withColumnRenamed("id", "unit"), "unit", "left").join(ends, "unit", "left")
    of = of.select("id", F.coalesce("root", "unit").alias("group_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    several = of.groupBy("group_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("group_id")
    return of.join(several, "group_id", "left_semi").select(F.col("id").alias("line_id"), "group_id", "n_links")
