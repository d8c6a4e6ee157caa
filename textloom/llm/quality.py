"""Problem 3: text statistics for telling written prose from lists, tables and junk.

Method: lists and tables show in how the lines of a record stand to one another.
Neighbouring lines are compared: delimiters that stand one below the other in the
same order (vertical alignment), indentation that comes back (periodicity), and
line lengths that are even or take turns (autocorrelation at lags 1 and 2, and the
spread of lengths). They are combined with the ratios of words, symbols, digits,
closing punctuation and common words in a logistic score that decides.

Nothing is a list of words or a threshold on one kind of text; what a language
looks like is counted on the table itself (``Language``): how often an ending of up
to five letters stands before a closing sign (finite verbs end sentences, so their
endings do), which pairs of letters are usual, and which words are most common. A
stretch of words without a delimiter that has such an ending is a clause.

The score is fitted on the table itself as well, without labels: records with a
clear layout, or made of signs and digits, are examples of what isn't prose;
records whose lines are closed clauses without alignment are examples of prose. It
is fitted to all such records by Newton's method, whose sums are made where the
records are; then once more to all records that the first fit places without
doubt (``SURE``). It thus also places records of a single line, in which no
layout can be seen.

A record is never gathered as a whole: its lines are compared within blocks of
``BLOCK`` line numbers, each with the first lines of the next block added, and the
blocks' sums are added up. A record of any length is thus spread over many tasks.

Defined results: null and blank lines count as lines but carry no text; a record
without any text has null ratios and is never named; repeated rows count as often
as they come; in a table without examples of both kinds no record is named.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.layout import BASE, ENDING, Lines
from textloom.session import cut

BLOCK = 64
LAGS = 2
#: An ending is a predicate's if it closes sentences so many times as often as words in general.
LIFT = 2.0
#: Occurrences that the rate of the next shorter ending counts for.
BACKOFF = 20.0
COMMON_WORDS = 200
RIDGE = 1.0
STEPS = 6
SURE = 0.9
FEATURES = ("unsaid", "no_clause", "aligned", "indented", "regular", "symbols", "digits", "cells", "open", "unusual", "mixed", "repeated", "uncommon")
LAYOUT = ("aligned", "indented", "regular")
COUNTS = ("words", "chars", "letters", "digits", "symbols", "word_chars", "common", "predicates", "cells", "written", "clause", "repeated", "mixed", "pairs", "closed", "indent", "signature")
@dataclass
class Language:
    """What the table tells of its language; all tables are bounded by the alphabet or by a parameter."""

    endings: np.ndarray
    rates: np.ndarray
    base: float
    odds: np.ndarray
    common: np.ndarray

    def marks(self, lines: Lines) -> tuple[np.ndarray, np.ndarray]:
        """(predicates, common words) among the words of lines. An ending that isn't readable may be a predicate's."""
        which, ending, unknown = lines.endings()
        rate = np.full(len(which), self.base)
        for k in range(3, ENDING + 1):
            code = ending % BASE**k + (k << 32)
            place = np.minimum(np.searchsorted(self.endings, code), max(len(self.endings) - 1, 0))
            if len(self.endings):
                rate = np.where(self.endings[place] == code, self.rates[place], rate)
        predicate = which[unknown | (rate >= LIFT * self.base)]
        words = lines.word_hashes
        place = np.minimum(np.searchsorted(self.common, words), max(len(self.common) - 1, 0))
        return predicate, np.flatnonzero(self.common[place] == words) if len(self.common) else np.zeros(0, np.int64)


def lines_of(df: DataFrame, record_col: str, line_col: str, text_col: str) -> DataFrame:
    no = F.coalesce(F.col(line_col).cast("bigint"), F.lit(0))
    return df.where(F.col(record_col).isNotNull()).select(F.col(record_col).alias("rec"), no.alias("no"), F.concat(F.coalesce(F.col(text_col), F.lit("")), F.lit("\n")).alias("f"))


def learn(lines: DataFrame) -> Language:
    """Counts endings, pairs of letters and words over all lines.

    Endings and pairs are as many as the alphabet allows, and of endings only those
    seen more than once come to the driver; of the words the ``COMMON_WORDS`` most frequent.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[str, list] = {"e": [], "b": [], "w": []}
        for batch in batches:
            x = Lines.of(batch.column(0))
            which, ending, unknown = x.endings()
            closes, known = x.closes(which)[~unknown], ending[~unknown]
            for k in range(3, ENDING + 1):
                parts["e"].append((known % BASE**k + (k << 32), np.ones(len(known)), closes.astype(float)))
            _, pair = x.bigrams()
            parts["b"].append((pair, np.ones(len(pair)), np.zeros(len(pair))))
            words = x.word_hashes
            parts["w"].append((words, np.ones(len(words)), np.zeros(len(words))))
            for p in parts.values():
                p[:] = [added(p)]
        for kind, p in parts.items():
            if p:
                key, n, m = added(p)
                yield pa.RecordBatch.from_arrays([pa.array([kind] * len(key), pa.string()), pa.array(key), pa.array(n), pa.array(m)], names=["kind", "key", "n", "m"])

    counts = cut(lines.select("f").mapInArrow(count, "kind string, key bigint, n double, m double").groupBy("kind", "key").agg(F.sum("n").alias("n"), F.sum("m").alias("m")), "language")
    rows = counts.where("kind = 'e' and n > 1").select("key", "n", "m").toArrow().sort_by("key")
    key, n, m = (rows.column(c).to_numpy() for c in ("key", "n", "m"))
    size = key >> 32
    base = float(m[size == 3].sum() / max(1.0, n[size == 3].sum()))
    rates = np.full(len(key), base)
    for k in range(3, ENDING + 1):
        at = np.flatnonzero(size == k)
        shorter = np.full(len(at), base)
        if k > 3:
            code = (key[at] & 0xFFFFFFFF) % BASE ** (k - 1) + ((k - 1) << 32)
            shorter = rates[np.searchsorted(key, code)]  # seen at least as often
        rates[at] = (m[at] + BACKOFF * shorter) / (n[at] + BACKOFF)
    pairs = np.zeros(27 * 27)
    got = counts.where("kind = 'b'").select("key", "n").toArrow()
    pairs[got.column("key").to_numpy()] = got.column("n").to_numpy()
    pairs = pairs.reshape(27, 27)
    odds = np.log((pairs + 0.1) / (pairs.sum(1, keepdims=True) + 2.7)).ravel()
    common = counts.where("kind = 'w'").orderBy(F.desc("n"), "key").limit(COMMON_WORDS).select("key").toArrow()
    return Language(key, rates, base, odds, np.sort(common.column("key").to_numpy()))


def added(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted keys with their two sums."""
    key, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return key, *(np.bincount(at, np.concatenate([p[k] for p in parts]), len(key)) for k in (1, 2))


def line_statistics(lines: DataFrame, language: Language) -> DataFrame:
    """(rec, no, counts ..., odds) of every line."""
    sent = lines.sparkSession.sparkContext.broadcast(language)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = Lines.of(b.column("f"))
            m = x.measure(*sent.value.marks(x), sent.value.odds)
            cols = [pa.array(m[c].astype(np.int64)) for c in COUNTS]
            yield pa.RecordBatch.from_arrays([b.column("rec"), b.column("no"), *cols, pa.array(m["odds"])], names=["rec", "no", *COUNTS, "odds"])

    kind = lines.schema["rec"].dataType.simpleString()
    return lines.mapInArrow(of, f"rec {kind}, no bigint, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", odds double")


def record_sums(x: DataFrame) -> DataFrame:
    """One row a record: the sums of its lines' counts and of what its neighbouring lines share."""
    x = x.withColumns({c: F.when(F.col("clause") == 0, F.col(s)).otherwise(0) for c, s in (("bare_symbols", "symbols"), ("bare_digits", "digits"), ("bare_cells", "cells"), ("bare_mixed", "mixed"), ("bare_repeated", "repeated"))})
    x = x.withColumns({"text": (F.col("chars") > 0).cast("bigint"), "open": ((F.col("chars") > 0) & (F.col("closed") == 0) & (F.col("clause") == 0)).cast("bigint")})
    block = F.floor(F.col("no") / BLOCK)
    # A line also goes to the block before, as the other half of pairs that cross the border.
    x = x.withColumn("block", F.explode(F.when(F.pmod("no", F.lit(BLOCK)) < LAGS, F.array(block, block - 1)).otherwise(F.array(block))))
    x = x.withColumn("own", F.col("block") == block)
    summed = [c for c in (*COUNTS, "odds", "text", "open", "bare_symbols", "bare_digits", "bare_cells", "bare_mixed", "bare_repeated") if c not in ("indent", "signature")]
    own = lambda c: F.sum(F.when(F.col("own"), F.col(c)).otherwise(F.lit(0)))
    shape = F.struct("no", F.col("chars").cast("double").alias("c"), "indent", F.col("signature").alias("s"), "own")
    per = x.groupBy("rec", "block").agg(F.sum(F.col("own").cast("bigint")).alias("lines"), *(own(c).alias(c) for c in summed), F.sort_array(F.collect_list(shape)).alias("shape"))

    def pairs(lag: int, value) -> Column:
        """The sum over all pairs of own lines and the lines ``lag`` further."""
        a, b = F.col("shape"), F.slice("shape", lag + 1, F.greatest(F.size("shape") - lag, F.lit(0)))
        return F.aggregate(F.zip_with(a, b, lambda p, q: F.when(p.own & q.c.isNotNull(), value(p, q)).otherwise(F.lit(0.0))), F.lit(0.0), lambda t, v: t + v)

    one, returns = F.lit(1.0), lambda p, q: F.when((p.indent == q.indent) & (p.indent > 0), 1.0).otherwise(0.0)
    per = per.withColumns({
        "pairs1": pairs(1, lambda p, q: one), "pairs2": pairs(2, lambda p, q: one), "x1": pairs(1, lambda p, q: p.c * q.c), "x2": pairs(2, lambda p, q: p.c * q.c),
        "aligned": pairs(1, lambda p, q: F.when((p.s != 0) & (p.s == q.s), one).otherwise(0.0)),
        "indented": pairs(1, returns) + pairs(2, returns),
        "squares": F.aggregate(F.filter("shape", lambda p: p.own), F.lit(0.0), lambda t, p: t + p.c * p.c),
    }).drop("shape")
    sums = [c for c in per.columns if c not in ("rec", "block")]
    return per.groupBy("rec").agg(*(F.sum(c).alias(c) for c in sums))


def ratios(r: DataFrame) -> DataFrame:
    """Adds the ratios of a record; null where there is nothing to divide by."""
    ratio = lambda a, b: F.col(a) / F.when(F.col(b) > 0, F.col(b))
    mean = ratio("chars", "lines")
    variance = ratio("squares", "lines") - mean * mean
    lag = lambda k: F.when((F.col(f"pairs{k}") > 0) & (variance > 1e-9), (F.col(f"x{k}") / F.col(f"pairs{k}") - mean * mean) / variance)
    return r.withColumns({
        "mean_word_length": ratio("word_chars", "words"), "symbol_ratio": ratio("symbols", "chars"), "digit_ratio": ratio("digits", "chars"),
        "closed_ratio": ratio("closed", "text"), "common_ratio": ratio("common", "words"), "predicate_ratio": ratio("predicates", "words"), "written_ratio": ratio("written", "words"),
        "aligned_ratio": ratio("aligned", "pairs1"), "indent_ratio": F.least(ratio("indented", "pairs1"), F.lit(1.0)),
        "length_spread": F.when(mean > 0, F.sqrt(F.greatest(variance, F.lit(0.0))) / mean), "autocorrelation1": lag(1), "autocorrelation2": lag(2),
    })


def features(r: DataFrame) -> DataFrame:
    """Adds ``x``, the features of the score in the order of FEATURES, and the examples: 1 not prose, 0 prose, null neither."""
    known = lambda c: F.coalesce(c, F.lit(0.0))
    words, chars, text = (F.greatest(F.col(c), F.lit(1)).cast("double") for c in ("words", "chars", "text"))
    open_ = F.col("open") / text
    turns = F.greatest(-known(F.col("autocorrelation1")), known(F.col("autocorrelation2")), F.lit(0.0))
    regular = F.when(F.col("text") >= 3, open_ * F.greatest(1 / (1 + 3 * known(F.col("length_spread"))), F.least(turns, F.lit(1.0)))).otherwise(0.0)
    of = {
        "unsaid": 1 - F.col("written") / words, "no_clause": 1 - F.col("clause") / text, "aligned": known(F.col("aligned_ratio")), "indented": known(F.col("indent_ratio")), "regular": regular,
        "symbols": F.col("bare_symbols") / chars, "digits": F.col("bare_digits") / chars, "cells": F.least(2 * F.col("bare_cells") / words, F.lit(3.0)), "open": open_,
        "unusual": -F.col("odds") / F.greatest(F.col("pairs"), F.lit(1)), "mixed": F.least(2 * F.col("bare_mixed") / words, F.lit(1.0)), "repeated": F.least(2 * F.col("bare_repeated") / words, F.lit(1.0)),
        "uncommon": 1 - F.col("common") / words,
    }
    r = r.withColumn("x", F.array(*(of[c].cast("double") for c in FEATURES)))
    laid_out = (F.col("text") >= 3) & (((known(F.col("aligned_ratio")) >= 0.7) & (of["unsaid"] >= 0.7)) | ((known(F.col("indent_ratio")) >= 0.5) & (of["unsaid"] > 0.8)))
    signs = (F.col("text") >= 2) & (of["symbols"] + of["digits"] > 0.5)
    written = (F.col("text") > 0) & (open_ <= 0.34) & (of["unsaid"] < 0.3) & (known(F.col("aligned_ratio")) == 0)
    return r.withColumn("example", F.when(laid_out | signs, 1.0).when(written, 0.0))


@dataclass
class Score:
    """A logistic score over features brought to mean 0 and deviation 1."""

    mean: np.ndarray
    deviation: np.ndarray
    weights: np.ndarray

    def column(self, x: Column) -> Column:
        scaled = self.weights[:-1] / self.deviation
        return sum((x[k] * float(w) for k, w in enumerate(scaled)), F.lit(float(self.weights[-1] - (scaled * self.mean).sum())))


def newton(rows: DataFrame, score: Score, steps: int, sure: float | None = None) -> None:
    """Fits the weights to all rows (x, example) by Newton's method; only sums of a fixed size reach the driver.

    With ``sure`` the rows that the score has placed so surely are the examples.
    """
    width = len(score.weights)
    placed = Score(score.mean, score.deviation, score.weights.copy())
    if sure is not None:
        score.weights = np.zeros(width)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width + 1))
        for b in batches:
            x = np.append((b.column(0).flatten().to_numpy().reshape(b.num_rows, -1) - score.mean) / score.deviation, np.ones((b.num_rows, 1)), 1)
            if sure is None:
                y = b.column(1).to_numpy(zero_copy_only=False).astype(float)
                x, y = x[~np.isnan(y)], y[~np.isnan(y)]
            else:
                z = x @ placed.weights
                kept = np.abs(z) > np.log(sure / (1 - sure))
                x, y = x[kept], (z[kept] > 0).astype(float)
            p = 1 / (1 + np.exp(-np.clip(x @ score.weights, -30, 30)))
            total[:, :width] += (x * (p * (1 - p))[:, None]).T @ x
            total[:, width] += x.T @ (p - y)
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.float64()))], names=["s"])

    for _ in range(steps):
        total = sum((np.array(r.s) for r in rows.select("x", "example").mapInArrow(sums, "s array<double>").collect()), np.zeros(width * (width + 1))).reshape(width, width + 1)
        step = np.linalg.solve(total[:, :width] + RIDGE * np.eye(width), total[:, width] + RIDGE * score.weights)
        score.weights = score.weights - step
        if np.abs(step).max() < 1e-3:
            break


def fit(rows: DataFrame) -> Score | None:
    """The score of a feature table; null where it lacks examples of either kind."""
    some = rows.where("text > 0")
    seen = some.agg(F.sum(F.coalesce("example", F.lit(0.0))).alias("yes"), F.count("example").alias("n"), *(f(F.col("x")[k]).alias(f"{n}{k}") for k in range(len(FEATURES)) for n, f in (("m", F.avg), ("d", F.stddev_pop)))).first()
    if not seen.yes or seen.yes == seen.n:
        return None
    mean, deviation = (np.array([seen[f"{n}{k}"] for k in range(len(FEATURES))]) for n in "md")
    score = Score(mean, deviation + 1e-6, np.zeros(len(FEATURES) + 1))
    newton(some, score, STEPS)
    newton(some, score, STEPS, SURE)
    return score


def record_statistics(df: DataFrame, record_col: str = "rec_id", line_col: str = "line_no", text_col: str = "text") -> DataFrame:
    """One row a record: its sums and ratios, its features, and whether it is prose."""
    lines = lines_of(df, record_col, line_col, text_col)
    rows = cut(features(ratios(record_sums(line_statistics(lines, learn(lines))))), "records")
    score = fit(rows)
    return rows.withColumn("prose", F.when(F.col("text") > 0, score.column(F.col("x")) <= 0 if score else F.lit(True)))


def statistics(df: DataFrame, record_col: str = "rec_id", line_col: str = "line_no", text_col: str = "text") -> DataFrame:
    """(rec_id, lines, words, ratios ..., prose), floats rounded to six places."""
    r = record_statistics(df, record_col, line_col, text_col)
    floats = ["mean_word_length", "symbol_ratio", "digit_ratio", "closed_ratio", "common_ratio", "predicate_ratio", "written_ratio", "aligned_ratio", "indent_ratio", "length_spread", "autocorrelation1", "autocorrelation2"]
    return r.select(F.col("rec").alias("rec_id"), "lines", "words", "chars", *(F.round(c, 6).alias(c) for c in floats), "prose")


def found(df: DataFrame, record_col: str = "rec_id", line_col: str = "line_no", text_col: str = "text") -> DataFrame:
    """(rec_id): records that as a whole are not prose."""
    return record_statistics(df, record_col, line_col, text_col).where(~F.col("prose")).select(F.col("rec").alias("rec_id"))
