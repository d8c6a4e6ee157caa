"""Problem 6: the same or nearly the same records across splits.

Method: winnowing fingerprints. Every line gives rolling hashes over two words in
a row; of every two neighbouring hashes the lesser is selected, in an order that
puts rare hashes first, but those that occur once in both splits together last,
and is the same for all lines. Any three words in a row that two lines share thus
give both the same fingerprint, and so do two where what stands beside them is in
no other line. Fingerprints that occur once can't meet and are dropped. The selected
hashes are joined across the splits; the seeds of a pair are chained where they
are collinear, the chains are extended by alignment, and the words covered are
counted. Whether a pair counts is then decided exactly, by its words in common.

The definition knows no order of words, and a fingerprint that more than ``CROWDED``
lines hold would join too much. The rest is exact: lines meet across the splits by
the covering masks of ``neardup``, which lose no pair that shares enough words, in
whatever order and however often they stand in other lines. Masks of the train
split are made only where the held-out split has the same key.

Defined results: null and blank texts and lines with fewer than ``min_words``
words have no overlap; a missing source is reported as null; repeated rows with
one id count once; lines of one split with the same words in order are handled as
one and expanded at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.neardup import HOT, LOCAL, MIN_WORDS, RARE, SHARE, mask_table, met_pairs, shared_needed, within
from textloom.llm.sketch import bits_for, count_code, count_table, flat, held_by, mix, multiset_features, parity_sketch, starts_of, word_lines
from textloom.session import cut

GRAM = 2
WINDOW = 2
#: Rows up to which a hash is a fingerprint; pairs without a seed then meet by their masks.
CROWDED = 100
#: Keys a line is expected to have, for the size of the table of keys.
PER_LINE = 64
SCHEMA = "id bigint, n int, sketch bigint, whole bigint, whole2 bigint, seq array<int>, feats array<int>"


def sequences(df: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """(id, n, sketch, whole, whole2, seq, feats): the words of a line in order as 32-bit hashes, and as a multiset."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words, n = flat(b.column("words"))
            f = multiset_features(words, n)
            sketch = parity_sketch(f, n)
            w = words.view(np.uint64)
            at = (np.arange(len(w)) - np.repeat(starts_of(n), n)).astype(np.uint64)
            whole = [np.add.reduceat(mix(w + at * np.uint64(g)), starts_of(n)).view(np.int64) if len(n) else np.zeros(0, np.int64) for g in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)]
            seq, feats = (pa.ListArray.from_arrays(pa.array(np.append(starts_of(n), n.sum()).astype(np.int32)), pa.array(v.view(np.int32))) for v in ((mix(w) >> np.uint64(32)).astype(np.uint32), f))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(n.astype(np.int32)), pa.array(sketch), *map(pa.array, whole), seq, feats], names=[x.split()[0] for x in SCHEMA.split(", ")])

    return word_lines(df, id_col, text_col, min_words).select("id", "words").mapInArrow(rows, SCHEMA)


def grams(seq: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The rolling hash of GRAM words from each place on; places too near a row's end are marked by 0."""
    w = seq.view(np.uint32).astype(np.uint64)
    out = np.zeros(len(w), np.uint64)
    for k in range(GRAM):
        out[: len(w) - k] = out[: len(w) - k] * np.uint64(0x100000001B3) + w[k:]
    out = (mix(out) >> np.uint64(32)).astype(np.uint32)
    out[out == 0] = 1
    left = np.repeat(n, n) - (np.arange(len(w)) - np.repeat(starts_of(n), n))
    out[left < GRAM] = 0
    return out


def winnow(gram: np.ndarray, n: np.ndarray, counts: np.ndarray, crowded: int = CROWDED) -> np.ndarray:
    """The places selected: the least hash of every WINDOW in a row, rare hashes first, those held once last and then dropped."""
    held = held_by(gram, counts).astype(np.uint64)
    # Hashes that nothing else has come last, so that they don't take a window from one that can meet.
    order = (np.where(held > 1, held, np.uint64(1 << 31)) << np.uint64(32)) + gram
    place = np.arange(len(gram))
    end = np.repeat(starts_of(n) + n - GRAM + 1, n)
    lo = place.copy()
    for k in range(1, WINDOW):
        other = np.minimum(place + k, len(gram) - 1)
        lo = np.where((place + k < end) & (order[other] < order[lo]), other, lo)
    single = np.unique(lo[place[place + WINDOW <= end]])
    return single[(held[single] > 1) & (held[single] <= count_code(np.array([crowded]))[0])]


def fingerprints(units: DataFrame, counts: np.ndarray, crowded: int = CROWDED) -> DataFrame:
    """(key, unit, place, n, sketch) of the selected hashes that occur more than once."""
    sent = units.sparkSession.sparkContext.broadcast(counts)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seq, n = flat(b.column("seq"))
            gram = grams(seq, n)
            at = winnow(gram, n, sent.value, crowded)
            key = gram[at].astype(np.int64)
            row = np.repeat(np.arange(len(n)), n)[at]
            cols = [key, b.column("unit").to_numpy()[row], (at - starts_of(n)[row]).astype(np.int32), n[row].astype(np.int32), b.column("sketch").to_numpy()[row]]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, cols)), names=["key", "unit", "place", "n", "sketch"])

    return units.select("unit", "sketch", "seq").mapInArrow(rows, "key bigint, unit bigint, place int, n int, sketch bigint")


def chained(seeds: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which words of ``a`` are covered: collinear chains of seeds, the longest first, extended by alignment."""
    covered, used = np.zeros(len(a), bool), np.zeros(len(b), bool)
    seeds = seeds[np.lexsort((seeds[:, 1], seeds[:, 0]))]
    while len(seeds):
        # The longest chain in which both places rise.
        best, back = np.ones(len(seeds), int), np.full(len(seeds), -1)
        for i in range(1, len(seeds)):
            ok = np.flatnonzero((seeds[:i, 0] < seeds[i, 0]) & (seeds[:i, 1] < seeds[i, 1]))
            if len(ok):
                j = ok[np.argmax(best[ok])]
                best[i], back[i] = best[j] + 1, j
        i, chain = int(np.argmax(best)), []
        while i >= 0:
            chain.append(i)
            i = back[i]
        before = covered.sum()
        for i in chain:
            p, q = seeds[i]
            for step in (1, -1):
                x, y, missed = (p, q, 0) if step == 1 else (p - 1, q - 1, 0)
                while 0 <= x < len(a) and 0 <= y < len(b) and missed < 2:
                    if a[x] == b[y]:
                        if not covered[x] and not used[y]:
                            covered[x] = used[y] = True
                        missed = 0
                        x, y = x + step, y + step
                    elif 0 <= x + step < len(a) and a[x + step] == b[y]:
                        x += step
                    elif 0 <= y + step < len(b) and a[x] == b[y + step]:
                        y += step
                    else:
                        missed += 1
                        x, y = x + step, y + step
        if covered.sum() == before:
            break
        left = np.ones(len(seeds), bool)
        left[chain] = False
        seeds = seeds[left & ~covered[seeds[:, 0]]]
    return covered


def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the coverage of the line of the first split to candidate pairs."""
    for b in batches:
        share = []
        for seeds, x, y in zip(b.column("seeds").to_pylist(), b.column("seqh").to_pylist(), b.column("seqt").to_pylist()):
            x, y = np.array(x), np.array(y)
            if seeds:
                at = np.unique(np.array([[s["h"], s["t"]] for s in seeds]), axis=0)
            else:  # met by masks: the words that both have once
                (u, i, k), (v, j, m) = (np.unique(w, return_index=True, return_counts=True) for w in (x, y))
                _, p, q = np.intersect1d(u[k == 1], v[m == 1], return_indices=True)
                at = np.stack([i[k == 1][p], j[m == 1][q]], 1)
            share.append(float(chained(at, x, y).mean()))
        yield pa.RecordBatch.from_arrays([b.column("h"), b.column("t"), b.column("shared"), pa.array(share, pa.float64())], names=["h", "t", "shared", "coverage"])


def masked(units: DataFrame, bits: int, share: float, rare: int, hot: int) -> DataFrame:
    """(h, t): all pairs across the splits whose masks, sizes and sketches allow that they share enough words."""
    # The split goes with the id: even for held-out lines.
    sided = cut(units.select((F.col("unit") * 2 + (F.col("side") == "t").cast("int")).alias("unit"), "n", "feats"), "sided")
    counts = count_table(sided, "feats", bits)
    none = np.iinfo(np.int64).max

    def tables(x: DataFrame, weight: int) -> DataFrame:
        local = LOCAL if weight == 2 else none
        held, train = x.where("unit % 2 = 0"), x.where("unit % 2 <> 0")
        # Keys of the held-out split; places that several keys share only let a few more through.
        keys = mask_table(held, counts, share, rare, weight, none).select("key")
        some = count_table(keys, "key", bits_for(PER_LINE * held.count()))
        return mask_table(held, counts, share, rare, weight, local).unionByName(mask_table(train, counts, share, rare, weight, local, some))

    met = met_pairs(sided, tables, share, hot, sides=True)
    return met.select(F.shiftright("a", 1).alias("h"), F.shiftright("b", 1).alias("t"))


def overlaps(holdout: DataFrame, train: DataFrame, id_col: str = "line_id", text_col: str = "text", min_words: int = MIN_WORDS, share: float = SHARE, crowded: int = CROWDED, rare: int = RARE, hot: int = HOT) -> DataFrame:
    """(holdout_id, train_id, shared, coverage) of all pairs that share at least ``share`` of the longer line's words."""
    tagged = sequences(holdout, id_col, text_col, min_words).withColumn("side", F.lit("h")).unionByName(sequences(train, id_col, text_col, min_words).withColumn("side", F.lit("t")))
    rows = cut(tagged, "sequences")
    units = cut(rows.groupBy("side", "whole", "whole2").agg(F.min("id").alias("unit"), *(F.first(c).alias(c) for c in ("n", "sketch", "seq", "feats"))), "sequence-units")

    def only_grams(seq: np.ndarray, n: np.ndarray) -> np.ndarray:
        g = grams(seq, n)
        return g[g != 0]

    total = bits_for(units.agg(F.sum("n")).first()[0] or 0)
    counts = count_table(units, "seq", total, only_grams)
    prints = {s: fingerprints(units.where(F.col("side") == s), counts, crowded).alias(s) for s in "ht"}
    met = prints["h"].join(prints["t"], (F.col("h.key") == F.col("t.key")) & within("h", "t", share))
    seeded = met.groupBy(F.col("h.unit").alias("h"), F.col("t.unit").alias("t")).agg(F.collect_set(F.struct(F.col("h.place").alias("h"), F.col("t.place").alias("t"))).alias("seeds"))
    pairs = seeded.join(masked(units, total, share, rare, hot), ["h", "t"], "full_outer")
    for s in "ht":
        pairs = pairs.join(units.where(F.col("side") == s).select(F.col("unit").alias(s), F.col("n").alias(f"n{s}"), F.col("seq").alias(f"seq{s}")), s)
    # Words in common with repetition: every distinct word counts as often as the line with fewer of it has it.
    times = lambda seq: lambda w: F.size(F.filter(seq, lambda x: x == w))
    common = F.aggregate(
        F.array_intersect("seqh", "seqt"), F.lit(0),
        lambda total, w: total + F.least(times(F.col("seqh"))(w), times(F.col("seqt"))(w)),
    )
    pairs = pairs.withColumn("shared", common).where(F.col("shared") >= shared_needed("nh", "nt", share))
    scored = pairs.select("h", "t", "shared", "seeds", "seqh", "seqt").mapInArrow(align, "h bigint, t bigint, shared int, coverage double")
    member = rows.select("side", "whole", "whole2", "id").join(units.select("side", "whole", "whole2", "unit"), ["side", "whole", "whole2"])
    for s in "ht":
        scored = scored.join(member.where(F.col("side") == s).select(F.col("unit").alias(s), F.col("id").alias(f"id{s}")), s)
    return scored.select(F.col("idh").alias("holdout_id"), F.col("idt").alias("train_id"), "shared", "coverage").dropDuplicates(["holdout_id", "train_id"])


def found(holdout: DataFrame, train: DataFrame) -> DataFrame:
    return overlaps(holdout, train).select(F.col("holdout_id").alias("holdout_line_id"), F.col("train_id").alias("train_line_id"))


def report(holdout: DataFrame, train: DataFrame) -> DataFrame:
    """(split, source, lines, leaked, mean_coverage) of the held-out lines, a null source as its own group."""
    hit = overlaps(holdout, train).groupBy(F.col("holdout_id").alias("line_id")).agg(F.max("coverage").alias("coverage"))
    lines = holdout.select("line_id", "split", "source").dropDuplicates(["line_id"])
    joined = lines.join(hit, "line_id", "left")
    return joined.groupBy("split", "source").agg(F.count(F.lit(1)).alias("lines"), F.count("coverage").alias("leaked"), F.round(F.avg("coverage"), 4).alias("mean_coverage"))
